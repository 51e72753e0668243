"""Mixing sources to target weights by Pareto order sampling.

Every document of a source has the expected number of copies ``target /
source size`` of that source. Whole copies are certain; for the rest f a
document gets the ranking variable ``(u/(1-u)) / (f/(1-f))``, random odds over
inclusion odds, and the documents of smallest rank are taken until the source's
remaining words are met as nearly as whole documents allow (the sample's fixed
size is in words). u is a hash of the document's id, so reruns agree.

The cut is found without sorting a source in one task: words are summed in
bins of the ranking variable, and only the bin in which the target falls is
ordered, so a source with a third of all rows costs a few thousandths of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, text_or_empty

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
BINS = 1 << 14
SALTS = 64  # parts into which the documents of one source are dealt for the joins with its facts


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of an MD5 of the id (any engine can make it again)."""
    digest = F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(seed)).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target for a frame of (source, source_size).

    Weights repeat over the sources in code point order, null last. Targets
    share ``share`` of all words by weight; one above ``cap`` times its
    source's size stops there and its excess is reshared: sources are ordered
    by the level at which they stop, and the level is that of the first source
    that doesn't. One row per source passes through these windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("stops_at", "position")
    ws = F.array(*[F.lit(w) for w in weights])
    ranked = (sizes.withColumn("position", F.row_number().over(by_name))
              .withColumn("weight", F.element_at(ws, ((F.col("position") - 1) % len(weights) + 1).cast("int")).cast("double"))
              .withColumn("stop", (F.col("source_size") * cap).cast("double"))
              .withColumn("stops_at", F.col("stop") / F.col("weight")))
    all_rows = Window.partitionBy()
    level = (F.sum("source_size").over(all_rows) * F.lit(share) - (F.sum("stop").over(by_level) - F.col("stop"))) / \
        F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    filled = (ranked.withColumn("level", level)
              .withColumn("level", F.min(F.when(F.col("level") <= F.col("stops_at"), F.struct("stops_at", "position", "level"))).over(all_rows)["level"]))
    return filled.select("source", "source_size", F.coalesce(F.least(F.col("stop"), F.col("level") * F.col("weight")), F.col("stop")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = ":mix") -> DataFrame:
    """row (the input's columns, as a struct: their names can't clash), doc_id,
    size, source_size, target and copies.

    Null texts have size 0; a null source is a source of its own; a null id
    ranks as the empty id. Rows of equal id and size in a source rank alike and
    are taken together. A source without words has target 0 and no copies.
    Empty input: no rows.
    """
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.col(f"`{source_col}`").cast("string").alias("source"), words(text_or_empty(text_col)).alias("size"))
    narrow = sized.select("id", "source", "size")
    targets = source_targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")))
    plan = (targets.withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
            .withColumn("whole", F.floor("ratio")).withColumn("part", F.col("ratio") - F.col("whole"))
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    plan = plan.select(*[F.col(c).alias(f"p_{c}") for c in ("source", "source_size", "target", "whole", "part", "rest")])

    def ranked(df: DataFrame, facts: DataFrame) -> DataFrame:
        """With the facts of the row's source, its ranking variable q and bin. Documents
        of a source are salted by id, and the source's one row of facts is repeated per salt."""
        u = uniform(F.col("id"), seed)
        q = (u / (1 - u)) / (F.col("p_part") / (1 - F.col("p_part")))
        salted = facts.withColumn("p_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return (df.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
                .join(salted, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("salt") == F.col("p_salt")))
                .withColumn("q", F.when(F.col("p_part") > 0, q))
                .withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * BINS)))

    inner = ranked(narrow, plan).where("q is not null")
    sums = inner.groupBy("p_source", "p_rest", "bin").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("p_source").orderBy("bin"))
    cut_bin = (sums.withColumn("upto", upto).where("upto >= p_rest").groupBy("p_source")
               .agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("c"))
               .select(F.col("p_source").alias("b_source"), F.col("c.bin").alias("cut_bin"), F.col("c.before").alias("before")))
    key = [F.col("q"), F.coalesce(F.col("id"), F.lit(-(1 << 63))).alias("tie"), F.col("size")]
    at_cut = (inner.join(cut_bin, F.col("p_source").eqNullSafe(F.col("b_source")) & (F.col("bin") == F.col("cut_bin")))
              .groupBy("p_source", "p_rest", "before", *key).agg((F.count(F.lit(1)) * F.col("size")).alias("words")))
    done = F.sum("words").over(Window.partitionBy("p_source").orderBy("q", "tie", "size")) - F.col("words") + F.col("before")
    last = (at_cut.withColumn("done", done).where("2 * done + words <= 2 * p_rest")
            .groupBy("p_source").agg(F.max(F.struct("q", "tie", "size")).alias("last"))
            .select(F.col("p_source").alias("l_source"), "last"))
    cuts = (cut_bin.join(last, F.col("b_source").eqNullSafe(F.col("l_source")), "left")
            .select("b_source", "cut_bin", "last"))
    facts = plan.join(cuts, F.col("p_source").eqNullSafe(F.col("b_source")), "left")

    row_key = F.struct(*key)
    taken = F.col("q").isNotNull() & (F.col("cut_bin").isNull() | (F.col("bin") < F.col("cut_bin")) |
                                      ((F.col("bin") == F.col("cut_bin")) & F.coalesce(row_key <= F.col("last"), F.lit(False))))
    return ranked(sized, facts).select("row", F.col("id").alias("doc_id"), "size", F.col("p_source_size").alias("source_size"), F.col("p_target").alias("target"),
                      (F.col("p_whole") + taken.cast("long")).alias("copies"))


def mixed(docs: DataFrame, **names: str) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the input's columns."""
    return (mix(docs, **names).where("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*"))
