"""Secret scans with a recursive decoding worklist.

The text of a document is the first layer. Every layer is scanned for the three
kinds of secrets; then its encoded parts are unwrapped into further layers, which
wait on the worklist until none is left: percent escapes, Unicode, character and
octal escapes, numbered and named references (all replace the escapes within the
whole layer), base64 runs (standard and URL alphabets, at every offset), and
compressed data inside base64 or percent runs (gzip, zlib, bzip2, zstd, xz). A
layer seen before (same text from the same place) is not scanned again, and data
that unpack into data seen before are left, so cycles end. What unpacks beyond a
limit is read as a stream of overlapping pieces. Every layer carries, for each character, the span of the original
text it comes from; what is found deep inside is reported there.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import html.entities
import lzma
import re
import urllib.parse
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, text_or_empty

# The contract's kinds, in its order.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # greedy runs: the same as all runs without those under 16
HINT = re.compile(r"passw|secret|token|api_?key", re.ASCII | re.IGNORECASE)

# Escapes and base64 alphabets of the standards.
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\[nrt]|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&[A-Za-z][A-Za-z0-9]{1,31};")
OCTAL = re.compile(r"(?:\\[0-3][0-7]{2})+")
#: Percent escapes among the characters that such an encoder leaves as they are: bytes of any kind.
PERCENT_BYTES = re.compile(r"(?<![A-Za-z0-9._~()*!'+/-])(?:[A-Za-z0-9._~()*!'+/-]*+%[0-9A-Fa-f]{2})++[A-Za-z0-9._~()*!'+/-]*+")
SIGNATURES = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
BASE64 = (re.compile(r"[A-Za-z0-9+/]{12,}={0,2}"), re.compile(r"[A-Za-z0-9_-]{12,}={0,2}"))
#: Base64 over several lines: whole runs joined over single line breaks and leading blanks.
LINE_BREAK = re.compile(r"(?:\r\n?|\n)[\x20\t]*")
BASE64_LINES = tuple(re.compile(rf"(?<!{c}){c}{{12,}}+(?:{LINE_BREAK.pattern}{c}++)++={{0,2}}") for c in ("[A-Za-z0-9+/]", "[A-Za-z0-9_-]"))
#: Base64 runs from here on are also read from their second, third and fourth character (a shorter one holds no secret).
ANY_OFFSET = 22
#: What unpacks to more than this is read in pieces of this size, OVERLAP bytes of each again with the next; n_oversize counts such layers.
MAX_LAYER_BYTES = 64 << 20
OVERLAP = 64 << 10

CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f\ufffd]")
#: Stretches of UTF-16 of either byte order with characters that a pattern or an encoding can have; shorter ones hold no secret.
WIDE = (re.compile(rb"(?:\x00[\t\n\r\x20-\x7e]){12,}"), re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){12,}"))

_CLASS = np.zeros(256, dtype=np.uint8)
for _c in b"0123456789abcdef":
    _CLASS[_c] |= 1
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-":
    _CLASS[_c] |= 2
_STEP = 4


def base_spans(text: str, has_hex: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base matches of one layer."""
    out = []
    if HINT.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    if has_hex:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


class Layer:
    """Text with the original span of each character (None: the original itself,
    a pair: every character comes from one span, arrays: one span each)."""

    __slots__ = ("text", "origin")

    def __init__(self, text: str, origin=None):
        self.text, self.origin = text, origin

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.origin is None:
            return start, end
        if isinstance(self.origin, tuple):
            return self.origin
        starts, ends = self.origin
        return int(starts[start]), int(ends[end - 1])

    def replaced(self, parts: list[tuple[int, int, str]]) -> Layer:
        """The layer with (start, end) replaced by a text, in order; replaced characters keep the span of their escape."""
        out, starts, ends, at = [], [], [], 0
        mine = isinstance(self.origin, list)
        for a, b, new in [*parts, (len(self.text), len(self.text), "")]:
            out.append(self.text[at:a])
            if self.origin is None:
                starts.append(np.arange(at, a))
                ends.append(np.arange(at + 1, a + 1))
            elif mine:
                starts.append(self.origin[0][at:a])
                ends.append(self.origin[1][at:a])
            if new:
                s, e = self.span(a, b)
                out.append(new)
                starts.append(np.full(len(new), s))
                ends.append(np.full(len(new), e))
            at = b
        origin = self.origin if isinstance(self.origin, tuple) else [np.concatenate(starts), np.concatenate(ends)]
        return Layer("".join(out), origin)

    def key(self) -> tuple:
        origin = self.origin if self.origin is None or isinstance(self.origin, tuple) else tuple(hashlib.sha1(x.tobytes()).digest() for x in self.origin)
        return hashlib.sha1(self.text.encode("utf-8", "surrogatepass")).digest(), origin


def _byte_escapes(layer: Layer, runs: re.Pattern, unit: int, base: int) -> Layer | None:
    """Runs of escaped bytes (``unit`` characters each, its digits behind the first) read as UTF-8;
    bytes that don't fit stay as they are. Each character keeps its own escapes' span."""
    parts = []
    for m in runs.finditer(layer.text):
        data, at = bytes(int(m[0][i + 1:i + unit], base) for i in range(0, len(m[0]), unit)), m.start()
        i = 0
        while i < len(data):
            n = 1 if data[i] < 0x80 else 2 if 0xC2 <= data[i] < 0xE0 else 3 if 0xE0 <= data[i] < 0xF0 else 4 if 0xF0 <= data[i] < 0xF5 else 0
            try:
                char = data[i:i + n].decode("utf-8") if n and i + n <= len(data) else ""
            except UnicodeDecodeError:
                char = ""
            if char:
                parts.append((at + unit * i, at + unit * (i + n), char))
            i += n if char else 1
    return layer.replaced(parts) if parts else None


def _percent(layer: Layer) -> Layer | None:
    return _byte_escapes(layer, PERCENT, 3, 16)


def _octal(layer: Layer) -> Layer | None:
    return _byte_escapes(layer, OCTAL, 4, 8)


def _escapes(layer: Layer) -> Layer | None:
    parts, high = [], None
    for m in ESCAPE.finditer(layer.text):
        t = m[0]
        if t[0] == "\\" and t[1] in "nrt":
            parts.append((m.start(), m.end(), {"n": "\n", "r": "\r", "t": "\t"}[t[1]]))
            continue
        if t[0] == "&" and t[1] != "#":
            if named := html.entities.html5.get(t[1:]):
                parts.append((m.start(), m.end(), named))
            continue
        code = (int(t[3:-1], 16) if t[1] == "#" and t[2] in "xX" else int(t[2:-1]) if t[1] == "#" else int(t[3:-1], 16) if t[2] == "{" else int(t[2:], 16))
        if high and 0xDC00 <= code < 0xE000 and high[1] == m.start():
            parts.append((high[0], m.end(), chr(0x10000 + ((high[2] - 0xD800) << 10) + code - 0xDC00)))
            high = None
            continue
        high = (m.start(), m.end(), code) if 0xD800 <= code < 0xDC00 else None
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            parts.append((m.start(), m.end(), chr(code)))
    return layer.replaced(parts) if parts else None


class TooLarge(Exception):
    """A compressed layer unpacks beyond the limit."""


def unpack(data: bytes, limit: int = MAX_LAYER_BYTES) -> bytes | None:
    """Decompressed data of all members or frames, or None if it is in none of the formats."""
    def read(new) -> bytes:
        out, rest = b"", data
        while rest:
            d = new()
            try:
                part = d.decompress(rest, limit + 1 - len(out))
            except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError):
                if out:
                    break  # padding or other data behind the last member
                raise
            out += part
            if len(out) > limit:
                raise TooLarge
            if not d.eof:
                if rest is data:
                    raise ValueError("cut off")
                break
            rest = d.unused_data
        return out

    tries = []
    if data[:2] == b"\x1f\x8b" or len(data) > 2 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0:
        tries.append(lambda: read(lambda: zlib.decompressobj(47)))
    if data[:3] == b"BZh":
        tries.append(lambda: read(bz2.BZ2Decompressor))
    if data[:6] == b"\xfd7zXZ\x00":
        tries.append(lambda: read(lambda: lzma.LZMADecompressor(lzma.FORMAT_XZ)))
    if data[:4] == b"\x28\xb5\x2f\xfd":
        def zstd() -> bytes:
            out, rest = b"", memoryview(data)
            while rest and len(out) <= limit:
                d, at = zstandard.ZstdDecompressor().decompressobj(), 0
                try:
                    while at < len(rest) and not d.eof and len(out) <= limit:
                        out += d.decompress(rest[at:at + 256])  # little at once, as a few bytes can unpack to a block
                        at += 256
                except zstandard.ZstdError:  # other data behind the last frame
                    if not out:
                        raise
                    break
                rest = rest[min(at, len(rest)) - len(d.unused_data):]
            if len(out) > limit:
                raise TooLarge
            return out
        tries.append(zstd)
    for t in tries:
        try:
            return t()
        except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
            pass
    return None


def _stream(data: bytes):
    """Decompressed chunks of at most 1 MB, through all members or frames; ends where the data do or no longer fit."""
    if data[:4] == b"\x28\xb5\x2f\xfd":
        try:
            with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as r:
                while chunk := r.read(1 << 20):
                    yield chunk
        except zstandard.ZstdError:
            pass
        return
    new = (bz2.BZ2Decompressor if data[:3] == b"BZh" else (lambda: lzma.LZMADecompressor(lzma.FORMAT_XZ)) if data[:6] == b"\xfd7zXZ\x00" else lambda: zlib.decompressobj(47))
    rest = data
    try:
        while rest:
            d = new()
            while not d.eof:
                chunk = d.decompress(rest, 1 << 20)
                rest = d.unconsumed_tail if hasattr(d, "unconsumed_tail") else b""
                yield chunk
                if not chunk and not rest:
                    return
            rest = d.unused_data
    except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError):
        return


def pieces(data: bytes, limit: int):
    """What ``unpack`` finds too large, as overlapping pieces of about ``limit`` bytes."""
    held = bytearray()
    for chunk in _stream(data):
        held += chunk
        if len(held) >= limit:
            yield bytes(held)
            del held[:max(1, len(held) - min(OVERLAP, limit // 2))]
    if held:
        yield bytes(held)


def _as_text(data: bytes) -> str | None:
    """UTF-8 text without control characters other than white space."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and not CONTROL.search(text) else None


def _texts(data: bytes) -> list[str]:
    """The text, or of other data the printable stretches: as UTF-16 where every
    second byte is NUL, as UTF-8 or else Latin-1 between the other control characters."""
    if (text := _as_text(data)) is not None:
        return [text]
    out = [m[0][1 - k::2].decode("latin-1") for k, wide in enumerate(WIDE) for m in wide.finditer(data)]
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        text = data.decode("latin-1")
    return out + [t for t in CONTROL.split(text) if len(t) >= 12]


def _runs(text: str) -> list[tuple[int, int, str]]:
    """(start, end, characters) of the base64 runs: each line's own, every stretch
    of lines joined, and the lines of equal width in it with the one behind them,
    so that a word on the line before does not shift the rest."""
    # runs of either alphabet: a URL run may begin with many characters that both have
    out = {(*m.span(), m[0]) for alphabet in BASE64 for m in alphabet.finditer(text)}
    for lines in BASE64_LINES:
        for m in lines.finditer(text):
            cuts = [b.span() for b in LINE_BREAK.finditer(text, *m.span())]
            parts = list(zip([m.start(), *(e for _, e in cuts)], [*(s for s, _ in cuts), m.end()]))
            groups, first = [(0, len(parts))], 0
            for i in range(1, len(parts)):
                if parts[i][1] - parts[i][0] != parts[first][1] - parts[first][0]:
                    groups.append((first, i + 1))
                    first = i
            groups.append((first, len(parts)))
            for i, k in groups:
                if k - i > 1:
                    out.add((parts[i][0], parts[k - 1][1], "".join(text[s:e] for s, e in parts[i:k])))
    return sorted(out)


def _open(data: bytes, limit: int) -> tuple[list[str], bytes | None]:
    """Texts of data after all compression is taken off, and the data that unpack beyond the limit (None: none do)."""
    seen = set()
    try:
        while (inner := unpack(data, limit)) is not None:
            seen.add(hashlib.sha1(data).digest())
            if hashlib.sha1(inner).digest() in seen:  # archives that unpack into each other
                break
            data = inner
            if (text := _as_text(data)) is not None:
                return [text], None
    except TooLarge:
        return [], data
    return _texts(data), None


def _packed(layer: Layer, limit: int, has_base64: bool) -> tuple[list[Layer], list[tuple[bytes, tuple[int, int]]]]:
    """Layers inside base64 runs and compressed percent runs, and (data, span) of those too large to open at once."""
    out, large = [], []

    def take(data: bytes, span: tuple[int, int]) -> None:
        texts, over = _open(data, limit)
        out.extend(Layer(text, span) for text in texts)
        if over is not None:
            large.append((over, span))

    for start, end, run in _runs(layer.text) if has_base64 else ():
        run = run.rstrip("=").replace("-", "+").replace("_", "/")
        for skip in range(4 if len(run) >= ANY_OFFSET else 1):
            some = run[skip:]
            some = some[:len(some) - (len(some) % 4 == 1)]
            try:
                data = base64.b64decode(some + "=" * (-len(some) % 4), validate=True)
            except (binascii.Error, ValueError):
                continue
            take(data, layer.span(start, end))
    if "%" in layer.text:
        for m in PERCENT_BYTES.finditer(layer.text):
            data = urllib.parse.unquote_to_bytes(m[0])
            for sign in SIGNATURES.finditer(data):
                if unpackable(data[sign.start():], limit):
                    take(data[sign.start():], layer.span(*m.span()))
    return out, large


def unpackable(data: bytes, limit: int) -> bool:
    try:
        return unpack(data, limit) is not None
    except TooLarge:
        return True


def scan(text: str, has_hex: bool = True, has_base64: bool = True, limit: int = MAX_LAYER_BYTES) -> tuple[list, list, int, int]:
    """Base spans, all spans (each (start, kind number, end), sorted), layers opened, layers read in pieces."""
    base = sorted(base_spans(text, has_hex))
    if not has_base64 and "%" not in text and "\\" not in text and "&" not in text:
        return base, base, 1, 0
    found, first = set(base), Layer(text)
    work, seen, over, layers = deque([first]), set(), 0, 0

    def visit(layer: Layer) -> None:
        nonlocal over, layers
        layers += 1
        if layer is not first:
            for s, k, e in base_spans(layer.text):
                a, b = layer.span(s, e)
                found.add((a, k, b))
        children, large = _packed(layer, limit, layer is not first or has_base64)
        for unwrap, signs in ((_percent, "%"), (_escapes, "\\&"), (_octal, "\\")):
            if any(sign in layer.text for sign in signs) and (child := unwrap(layer)) is not None:
                children.append(child)
        for child in children:
            if (key := child.key()) not in seen:
                seen.add(key)
                work.append(child)
        for data, span in large:
            if (key := (hashlib.sha1(data).digest(), span)) not in seen:
                seen.add(key)
                over += 1
                for piece in pieces(data, limit):  # one at a time: only what they hold waits
                    for some in _texts(piece):
                        visit(Layer(some, span))

    while work:
        visit(work.popleft())
    return base, sorted(found), layers, over


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _long_runs(data: np.ndarray, bit: int, length: int) -> np.ndarray:
    """Positions inside runs of at least ``length`` bytes of a class: each such
    run holds length/step - 1 marks at the multiples of _STEP in a row."""
    marks = (_CLASS[data[::_STEP]] & bit).astype(bool)
    n = length // _STEP
    hit = marks[:max(0, len(marks) - n + 1)].copy()
    for k in range(1, n):
        hit &= marks[k:k + len(hit)]
    return np.flatnonzero(hit) * _STEP


OUT = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string()),
                 ("n_layers", pa.int64()), ("n_oversize", pa.int64())])


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_LAYER_BYTES) -> DataFrame:
    """One row per input row: doc_id; n_assign, n_access, n_hex (base matches);
    base_sha256 (of the base spans as kind:start:end by start, then kind,
    comma-joined); spans (base and decoded, joined alike); n_layers opened;
    n_oversize, compressed layers of more than ``limit`` bytes, read in pieces.

    Positions are code points, ends exclusive. A null text is the empty text.
    No shuffle; memory is bounded by the longest text and ``limit``. Empty input: no rows.
    """
    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                yield scanned(part.column(0), part.column(1))

    def scanned(ids, texts):
        # which texts hold a long run at all, from the bytes of the whole batch at once
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        body = texts.buffers()[2]
        data = np.frombuffer(body, dtype=np.uint8)[offsets[0]:offsets[-1]] if body is not None and offsets[-1] > offsets[0] else np.empty(0, dtype=np.uint8)
        has = []
        for bit, length in ((1, 16), (2, 12)):
            flag = np.zeros(len(texts), dtype=bool)
            at = _long_runs(data, bit, length)
            flag[np.searchsorted(offsets[1:] - offsets[0], at, side="right")] = True
            has.append(flag)
        out = []
        for t, has_hex, has_base64 in zip(texts.to_pylist(), *has):
            base, every, layers, over = scan(t, bool(has_hex), bool(has_base64), limit)
            n = [sum(1 for x in base if x[1] == k) for k in range(3)]
            out.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), layers, over))
        return pa.RecordBatch.from_arrays([ids, *[pa.array(c, f.type) for c, f in zip(zip(*out), list(OUT)[1:])]], schema=OUT)

    return rows.mapInArrow(run, ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in OUT))
