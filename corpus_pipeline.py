"""The corpus pipeline: five stages over documents, each on all that the one before kept.

Every stage is a function (spark, docs, sf_dir) -> DataFrame that calls one
operator of ``quarry.llm``; its result is written as Parquet below the shared
folder and read again as the next one's docs. All stages but the last return
the columns of documents.
"""

from __future__ import annotations

from quarry.llm import exact_dedup, mixing, pieces, simhash, toxicity
from quarry.llm.common import materialised
from quarry.llm.queries import VOCABULARY
from quarry.plans.tables import table


def drop_toxic(spark, docs, sf_dir):
    """Documents predicted toxic go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark, docs, sf_dir):
    """Of documents with equal text the one with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of each SimHash group (three-word shingles, three bits) the document with the smallest id stays."""
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def to_pieces(spark, docs, sf_dir):
    """Token count and digests of the ids and of the decoded text, one row per document and copy."""
    return pieces.encode_decode(docs, VOCABULARY)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash_near_dedup", drop_near_copies), ("mix", mix_sources), ("sentencepiece", to_pieces)]

#: Models, components and encodings have no SQL form: tests/llm/test_pipeline.py compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
