import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import pieces
from quarry.llm.queries import QUERIES, VOCABULARY
from tests.conftest import SF_CHECK

from . import awkward

SP = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)


@pytest.fixture(scope="module")
def voc():
    return pieces.vocabulary(VOCABULARY)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t▁ab.eintThe|-0é日😀\x00<s>"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_any_text_like_the_library(text):
    voc = pieces.vocabulary(VOCABULARY)
    ids = voc.encode(text)
    assert ids == SP.encode(text) and voc.decode(ids) == SP.decode(ids)


def test_heap_and_matrix_agree(voc):
    rng = random.Random(2)
    for n in (1, 2, 5, 9, 17, 40):
        units = ["▁" * rng.randrange(n) + "".join(rng.choice("abcdeinorst") for _ in range(n)) for _ in range(200)]
        units = [u[:n] for u in units]
        assert [voc.agenda(u) for u in units] == voc.agenda_matrix(units)


def test_long_units(voc):
    for text in ("x" * 3000, "ab" * 4000, " " * 300 + "end", "日本語" * 500, awkward.LONG):
        ids = voc.encode(text)
        assert ids == SP.encode(text) and voc.decode(ids) == SP.decode(ids)


def test_decode_any_ids(voc):
    rng = random.Random(4)
    for _ in range(300):
        ids = [rng.randrange(3, 300) for _ in range(rng.randrange(12))]
        assert voc.decode(ids) == SP.decode(ids), ids


def digest(i, t):
    ids = SP.encode(t or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (i, len(ids), sha(",".join(map(str, ids))), sha(SP.decode(ids)))


def test_awkward_rows(spark):
    got = pieces.encode_decode(awkward.frame(spark), VOCABULARY)
    assert sorted(map(tuple, got.collect()), key=str) == sorted((digest(r[0], r[1]) for r in awkward.rows()), key=str)
    assert pieces.encode_decode(awkward.empty(spark), VOCABULARY).count() == 0
    ids = pieces.encode(awkward.frame(spark), VOCABULARY)
    back = {(r.doc_id, r.text) for r in pieces.decode(ids, VOCABULARY).collect()}
    assert back == {(r[0], (r[1] or "").replace("▁", " ")) for r in awkward.rows()}


def test_query_like_the_library(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op10_sentencepiece"](spark, SF_CHECK)
    assert sorted(map(tuple, got.collect())) == sorted(digest(r.doc_id, r.text) for r in docs)


def test_cache_is_bounded_in_characters(voc, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ABCdef0123+/日") for _ in range(rng.randint(1, 3000))) for _ in range(60)]
    whole = [pieces._encoded(voc, "whole", [t], True)[0] for t in texts]
    monkeypatch.setattr(pieces, "CACHE_CHARS", 20_000)
    held = []
    for t, want in zip(texts, whole):
        assert pieces._encoded(voc, "bounded", [t], True)[0] == want
        held.append(pieces._UNITS["bounded"].chars)
    most = max(len(t) + len(ids) + len(text) for t, (_, ids, text) in zip(texts, whole)) + 10
    assert max(held) <= 20_000 + most and pieces._UNITS["whole"].chars > 3 * max(held)
    assert pieces._UNITS["bounded"].chars == sum(len(u) + len(i) + len(t) for u, (_, i, t) in pieces._UNITS["bounded"].items())


def test_a_full_cache_keeps_the_units_at_hand(voc, monkeypatch):
    known, fresh = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    want = pieces._encoded(voc, "large", [f"{known} {fresh}"], True)
    monkeypatch.setattr(pieces, "CACHE_UNITS", 50)
    pieces._encoded(voc, "full", [known], True)
    asked, encode = [], type(voc).encode_units
    monkeypatch.setattr(type(voc), "encode_units", lambda self, units: asked.extend(units) or encode(self, units))
    assert pieces._encoded(voc, "full", [f"{known} {fresh}"], True) == want
    assert sorted(asked) == sorted(voc.split(fresh))  # none of the known ones again
    assert pieces._encoded(voc, "full", ["c"], True)[0][0] > 0 and len(pieces._UNITS["full"]) == 1
