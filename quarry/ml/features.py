"""Feature building.

Vectors come from ``pyspark.ml`` transformers (JVM-side). Column-wise
scaling and the long-form TF-IDF are plain aggregates and joins, so they
have exact SQL equivalents and stay inside Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (IDF, PCA, HashingTF, IndexToString, StandardScaler, StringIndexer,
                                Tokenizer, VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import explode_words, tokens_regex
from ..operators.layout import written


def assemble(df: DataFrame, inputs: Sequence[str], output: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """M1: numeric columns -> one vector column (next to the others)."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output,
                           handleInvalid=handle_invalid).transform(df)


def array_features(df: DataFrame, array_col: str, output: str = "features") -> DataFrame:
    """An array<float|double> column as an ML vector."""
    return df.withColumn(output, array_to_vector(F.col(array_col)))


def vector_columns(df: DataFrame, vector_col: str, names: Sequence[str]) -> DataFrame:
    """Vector elements as plain double columns (for sinks and reports)."""
    arr = vector_to_array(F.col(vector_col))
    return df.select("*", *[arr[i].alias(n) for i, n in enumerate(names)]).drop(vector_col)


def zscore_columns(df: DataFrame, cols: Sequence[str], suffix: str = "_z",
                   constant_as: float | None = None) -> DataFrame:
    """M2, column form: ``(x - mean) / sd`` with the sample sd. Mean and sd
    are scalar subqueries over one aggregate (evaluated once, no join); a
    constant column gives null (or ``constant_as``, e.g. 0.0 as
    ``StandardScaler`` does, for model input), not a division by zero."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                   *[F.stddev_samp(c).alias(f"s_{c}") for c in cols])
    out = []
    for c in cols:
        mean = stats.select(f"m_{c}").scalar()
        sd = stats.select(f"s_{c}").scalar()
        z = F.try_divide(F.col(c) - mean, F.nullif(sd, F.lit(0.0)))
        if constant_as is not None:
            z = F.when(F.col(c).isNotNull(), F.coalesce(z, F.lit(float(constant_as))))
        out.append(z.alias(f"{c}{suffix}"))
    return df.select("*", *out)


def scale_vectors(df: DataFrame, input_col: str = "features", output: str = "scaled",
                  with_mean: bool = True, with_std: bool = True):
    """M2, vector form: ``StandardScaler`` (sample sd; 0 for a constant
    column). Returns (frame, fitted model)."""
    model = StandardScaler(inputCol=input_col, outputCol=output, withMean=with_mean,
                           withStd=with_std).fit(df)
    return model.transform(df), model


def at_least_zero(df: DataFrame, vector_col: str) -> DataFrame:
    """Vector elements below 0 as 0: what a min-max scaler fitted on the
    training part gives for smaller test values, and naive Bayes refuses."""
    floor = F.transform(vector_to_array(F.col(vector_col)), lambda x: F.greatest(x, F.lit(0.0)))
    return df.withColumn(vector_col, array_to_vector(floor))


def string_index(df: DataFrame, input_col: str, output: str, fit_on: DataFrame | None = None,
                 order: str = "frequencyDesc", handle_invalid: str = "keep"):
    """M3: category -> index by descending frequency, ties alphabetical.
    Returns (frame, fitted model); the model's ``labels`` feed M4."""
    model = StringIndexer(inputCol=input_col, outputCol=output, stringOrderType=order,
                          handleInvalid=handle_invalid).fit(fit_on if fit_on is not None else df)
    return model.transform(df), model


def label_ranks(df: DataFrame, input_col: str, name: str = "index") -> DataFrame:
    """M3's fitted labels as a table (label, index) instead of a list on the
    driver, for columns of any number of values: distinct non-null values
    numbered from 0 by descending frequency, ties in UTF-8 order.

    The counts are sorted over all tasks (a range exchange on (count, value),
    which are all different) and numbered inside each task; each task's rows
    are shifted by the rows of the tasks before it. Only the row counts of
    the tasks meet in one place. Written once, so that a lost task can't
    number anew."""
    counts = df.select(F.col(input_col).alias("label")).where(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    placed = counts.orderBy(F.desc("_n"), "label").withColumn("_at", F.monotonically_increasing_id())
    return _numbered(written(placed.select("label", "_at"), "labels"), "label", name).select("label", F.col(name).cast("double").alias(name))


def index_labels(df: DataFrame, input_col: str, output: str, labels: DataFrame, unseen: str = "keep") -> DataFrame:
    """M3 applied: the rows with the index of their value, by a join (one row per label; AQE broadcasts
    a small label table by its measured size and splits the partition of a hot value otherwise).
    Values that are null or not in ``labels``: ``keep`` gives the number of
    labels, ``skip`` drops the row, ``error`` fails."""
    known = labels.select(F.col("label").alias("_label"), F.col("index").alias("_index"))
    out = df.join(known, F.col(input_col) == F.col("_label"), "inner" if unseen == "skip" else "left")
    if unseen == "keep":
        value = F.coalesce("_index", labels.select(F.count(F.lit(1)).cast("double")).scalar())
    elif unseen == "skip":
        value = F.col("_index")
    elif unseen == "error":
        value = F.coalesce("_index", F.raise_error(F.lit(f"unseen value in {input_col}")).cast("double"))
    else:
        raise ValueError(unseen)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(output))


def labels_back(df: DataFrame, input_col: str, output: str, labels: DataFrame) -> DataFrame:
    """M4 applied: index -> label by a join; an index that no label has gives null."""
    known = labels.select(F.col("label").alias(output), F.col("index").alias("_index"))
    return df.join(known, F.col(input_col) == F.col("_index"), "left").select(*[F.col(f"`{c}`") for c in df.columns], output)


def _numbered(keys: DataFrame, key: str, name: str) -> DataFrame:
    """(key, number from 0) for written keys whose ``_at`` is monotonically_increasing_id: partition in the upper bits, row in the lower 33."""
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (keys.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    return keys.join(offsets, part == F.col("_part")).select(key, (F.col("_before") + row).alias(name))


def dense_ids(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    """(key, id): the distinct non-null keys numbered from 0 as int, for models
    that take int ids (ALS) of keys of any type or size.

    Keys are numbered inside each partition and shifted by the keys of the
    partitions before it; only the counts per partition pass through one task.
    The keys are written once, so that a lost task can't number them anew.
    More than 2^31 - 1 keys fail."""
    keys = written(df.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_at", F.monotonically_increasing_id()), "keys")
    number = F.col("_number")
    checked = F.when(number < (1 << 31), number).otherwise(F.raise_error(F.lit("more than 2^31 - 1 distinct keys")).cast("bigint"))
    return _numbered(keys, key, "_number").select(key, checked.cast("int").alias(name))


def index_to_string(df: DataFrame, input_col: str, output: str, labels: Sequence[str]) -> DataFrame:
    """M4: index -> category with the labels of a fitted indexer."""
    return IndexToString(inputCol=input_col, outputCol=output, labels=list(labels)).transform(df)


def pca(df: DataFrame, input_col: str, k: int, output: str = "pca"):
    """M5: first ``k`` principal components. Returns (frame, model)."""
    model = PCA(k=k, inputCol=input_col, outputCol=output).fit(df)
    return model.transform(df), model


# The JVM's \s: space, tab, newline, vertical tab, form feed, carriage return.
JVM_WHITESPACE = r"[ \t\n\x0B\f\r]"


# Text counted by one task: its tables of (document, term) counts take about 20 to 50 bytes for each byte of text.
TASK_BYTES = 8 << 20


def text_tasks(docs: DataFrame, text_col: str, task_bytes: int | None = None) -> int:
    """Tasks over which the text of ``docs`` is dealt, each with about ``task_bytes`` of it (``TASK_BYTES``),
    at least one per core: measured by one aggregate over the text, so that the number grows with the data."""
    size = docs.agg(F.sum(F.octet_length(text_col).cast("bigint")).alias("n")).first().n or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // (task_bytes or TASK_BYTES)))


def by_document(docs: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """``docs`` dealt by document over ``text_tasks`` tasks: counts per (document, term) then need no exchange of
    their own, and their memory in a task does not grow with the table. A number of shuffle partitions fixed by
    the session would make it grow, and AQE joins small partitions by the bytes of text, not of the counts."""
    return docs.repartition(text_tasks(docs, text_col), doc_col)


def tokenize(df: DataFrame, input_col: str, output: str = "tokens") -> DataFrame:
    """M6: the rule of ML's ``Tokenizer`` (lower-case, split on one white-space
    character, trailing empty tokens dropped) as built-in expressions, so it
    runs in generated code instead of a row-at-a-time Scala function."""
    return df.withColumn(output, tokens_regex(F.lower(F.col(input_col)), JVM_WHITESPACE))


def tokenizer_stage(input_col: str, output: str = "tokens") -> Tokenizer:
    """M6 as a pipeline stage (for ``Pipeline`` objects)."""
    return Tokenizer(inputCol=input_col, outputCol=output)


def hashed_tf(df: DataFrame, tokens_col: str = "tokens", output: str = "_tf",
              num_features: int = 1 << 18) -> DataFrame:
    """M7: hashed term frequencies as a sparse vector; nothing is fitted."""
    return HashingTF(inputCol=tokens_col, outputCol=output, numFeatures=num_features).transform(df)


def term_bucket(term, num_features: int):
    """M7's bucket of a term by a hash that any engine has: the first 32 bits of its md5."""
    first32 = F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint")
    return F.pmod(first32, F.lit(num_features))


def bucket_frequencies(df: DataFrame, doc_col: str, tokens_col: str, num_features: int = 1 << 18) -> DataFrame:
    """M7 in long form: (doc, bucket, tf), terms that share a bucket added up.
    Terms are counted before they are hashed, so a repeated term is hashed once per task."""
    tf = term_frequencies(df, doc_col, tokens_col)
    return (tf.groupBy(doc_col, term_bucket(F.col("term"), num_features).alias("bucket"))
            .agg(F.sum("tf").cast("bigint").alias("tf"), F.count(F.lit(1)).alias("terms")))


def sparse_rows(buckets: DataFrame, doc_col: str, num_features: int) -> DataFrame:
    """One sparse vector per document, as plain columns: size, indices (ascending) and values."""
    pairs = F.sort_array(F.collect_list(F.struct("bucket", "tf")))
    return (buckets.groupBy(doc_col).agg(pairs.alias("_p"))
            .select(doc_col, F.lit(num_features).alias("size"), F.col("_p.bucket").alias("indices"), F.col("_p.tf").alias("values")))


def fit_idf(train: DataFrame, tf_col: str = "_tf", output: str = "tfidf"):
    """M8: IDF fitted on ``train`` only."""
    return IDF(inputCol=tf_col, outputCol=output).fit(train)


def fit_hashed_tfidf(train: DataFrame, tokens_col: str = "tokens", output: str = "tfidf",
                     num_features: int = 1 << 18) -> PipelineModel:
    """M7 + M8 as vectors: hashed term frequencies and an IDF fitted on
    ``train`` only. Apply the model to any part (it adds ``_tf`` and ``output``)."""
    return Pipeline(stages=[HashingTF(inputCol=tokens_col, outputCol="_tf", numFeatures=num_features),
                            IDF(inputCol="_tf", outputCol=output)]).fit(train)


def hashed_tfidf(train: DataFrame, apply_to: DataFrame, tokens_col: str = "tokens",
                 output: str = "tfidf", num_features: int = 1 << 18):
    """Fit on ``train``, apply to ``apply_to``. Returns (frame, fitted model)."""
    model = fit_hashed_tfidf(train, tokens_col, output, num_features)
    return model.transform(apply_to).drop("_tf"), model


def term_frequencies(df: DataFrame, doc_col: str, tokens_col: str, also: Sequence[str] = ()) -> DataFrame:
    """(doc, term, tf): one row per distinct term of a document, with the
    document's own columns ``also`` beside it. The partial aggregate keeps a
    long document's repeats map-side."""
    gen, keep = explode_words(F.col(tokens_col), "term")
    return (df.select(doc_col, *also, gen).where(keep)
            .groupBy(doc_col, *also, "term").agg(F.count(F.lit(1)).alias("tf")))


def inverse_document_frequency(tf: DataFrame, doc_col: str, n_docs) -> DataFrame:
    """(term, idf) with the smoothed rule ``ln((N + 1) / (df + 1))`` of ML's IDF.
    ``n_docs`` is a Column (e.g. a scalar subquery) or a number."""
    n = n_docs if not isinstance(n_docs, (int, float)) else F.lit(n_docs)
    # documents holding the term = TF rows with tf > 0 (all of them)
    return (tf.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
            .select("term", F.log((n + F.lit(1)) / (F.col("df") + F.lit(1))).alias("idf")))


def tfidf_long(docs: DataFrame, doc_col: str, tokens_col: str,
               fit_docs: DataFrame | None = None, n_docs=None,
               materialize: bool = True) -> DataFrame:
    """M7 + M8 in long form, exact (no hashing): (doc, term, tf, idf, tfidf).

    Document frequencies come from ``fit_docs`` (the training part) when
    given; ``n_docs`` (a number or scalar Column) may give its size. With
    ``materialize`` the TF table is written once as Parquet below
    ``spark.checkpoint.dir``. The idf table has one row per term and is derived, so its size is
    checked at run time by AQE: broadcast when the shuffled vocabulary is
    small, otherwise a sort-merge join whose hot-term partitions AQE splits."""
    tf = term_frequencies(docs, doc_col, tokens_col)
    if materialize:
        # the TF table feeds both the document frequencies (which read only
        # its terms) and the output; written once, it is tokenised once
        # (AQE does not reuse the identical exchange) and its lineage is cut
        tf = written(tf, "tf")
    fit = fit_docs if fit_docs is not None else docs
    fit_tf = tf if fit_docs is None else term_frequencies(fit_docs, doc_col, tokens_col)
    if n_docs is None:
        n_docs = fit.select(F.count(F.lit(1))).scalar()
    idf = inverse_document_frequency(fit_tf, doc_col, n_docs)
    # a term unseen while fitting has df = 0
    out = tf.join(idf, "term", "left")
    idf_col = F.coalesce(F.col("idf"), F.log(n_docs + F.lit(1)))
    return out.select(doc_col, "term", "tf", idf_col.alias("idf"), (F.col("tf") * idf_col).alias("tfidf"))
