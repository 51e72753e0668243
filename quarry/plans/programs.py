"""The studied programs as plan functions: each takes the
program's raw lines (or typed frame) and returns lazy DataFrames, models only
where the program fits one. Parsing is one ``select`` of built-in expressions
per program; header lines are dropped as data, never fetched with ``first()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as qf
from ..ml import features as fe
from ..ml import models as mo
from ..operators import aggregates as agg
from ..operators import filters as flt
from ..operators import sets

# Car file field positions used by the programs.
CAR_MAKE, CAR_DOORS, CAR_BODY, CAR_DRIVE, CAR_HP, CAR_RPM, CAR_MPG_CITY = 0, 3, 4, 5, 7, 8, 9


def _f(value: str, sep: str, i: int) -> Column:
    return qf.field(value, sep, i)


# --- cars: operations demo, first program, clustering -------------------------

def cars_cleansed(lines: DataFrame, header: str, value: str = "value") -> DataFrame:
    """doors ``two`` -> ``2`` else ``4`` (full match), drive upper-cased,
    line re-joined; header lines dropped (every copy)."""
    data = flt.drop_header(lines, value, header)
    parts = qf.split_literal(value, ",")
    fixed = F.transform(parts, lambda x, i: F.when(i == CAR_DOORS, qf.recode_full_match(x, "two", "2", "4"))
                        .when(i == CAR_DRIVE, F.upper(x)).otherwise(x))
    return data.select(F.array_join(fixed, ",").alias(value))


def cars_tab_separated(lines: DataFrame, value: str = "value") -> DataFrame:
    """every comma replaced by a tab."""
    return lines.select(qf.replace_all(value, ",", "\t").alias(value))


def cars_metrics(lines: DataFrame, header: str, value: str = "value") -> dict[str, DataFrame]:
    """The operations demo's actions as frames: counts, body-type counts
    (one pass, A13), shortest line (A3), integer average city MPG (A4),
    integer average HP per make (A6), distinct makes (A12), toyota words (P5, F19)."""
    data = flt.drop_header(lines, value, header)
    toyota = flt.where_contains(data, value, "toyota")
    return {
        "lines": agg.count_rows(lines),
        "data_lines": agg.count_rows(data),
        "body_counts": agg.conditional_counts(data, {"sedan": F.contains(value, F.lit("sedan")),
                                                     "hatchback": F.contains(value, F.lit("hatchback"))}),
        "shortest": agg.shortest(data, value),
        "avg_mpg_city": agg.int_avg(data, qf.parse_int_or_zero(value, _f(value, ",", CAR_MPG_CITY))),
        "avg_hp_by_make": agg.int_avg_by_key(data.select(_f(value, ",", CAR_MAKE).alias("make"), value),
                                             "make", _f(value, ",", CAR_HP).try_cast("bigint")),
        "makes": agg.distinct_values(data.select(_f(value, ",", CAR_MAKE).alias("make")), "make"),
        "toyota_lines": agg.count_rows(toyota),
        "toyota_words": agg.count_rows(qf.explode_tokens(toyota, value, ",")),
    }


def cars_for_clustering(lines: DataFrame, header_marker: str = "FUELTYPE", value: str = "value") -> DataFrame:
    """Km: DOORS (``two`` -> 0 else 1), BODY (``sedan`` -> 0 else 1), HP, RPM, city MPG."""
    data = flt.where_not_contains(lines, value, header_marker)
    return data.select(qf.recode_contains(_f(value, ",", CAR_DOORS), "two").alias("DOORS"),
                       qf.recode_contains(_f(value, ",", CAR_BODY), "sedan").alias("BODY"),
                       _f(value, ",", CAR_HP).try_cast("double").alias("HP"),
                       _f(value, ",", CAR_RPM).try_cast("double").alias("RPM"),
                       _f(value, ",", CAR_MPG_CITY).try_cast("double").alias("MPG"))


def cluster(df: DataFrame, cols: Sequence[str], k: int = 4, seed: int = 1) -> dict[str, DataFrame]:
    """Centre and scale with the sample sd (scalar subqueries, no collect),
    then k-means; group sizes and assignments."""
    z = fe.zscore_columns(df, list(cols), constant_as=0.0)
    v = fe.assemble(z, [f"{c}_z" for c in cols])
    pred = mo.kmeans(v, "features", k=k, seed=seed).transform(v)
    return {"sizes": agg.group_count(pred, "prediction"), "assignments": pred.drop("features")}


# --- fuel use: linear regression -----------------------------------------------

# The columns of the studied regression.
FUEL_FEATURES = ("CYLINDERS", "HP", "ACCELERATION", "MODELYEAR")


def fuel_frame(lines: DataFrame, header_marker: str = "CYLINDERS", hp_default: float = 80.0,
               value: str = "value") -> DataFrame:
    """Lr: MPG, CYLINDERS, HP (``?`` -> a default, F12), ACCELERATION, MODELYEAR."""
    data = flt.where_not_contains(lines, value, header_marker)
    return data.select(_f(value, ",", 0).try_cast("double").alias("MPG"),
                       _f(value, ",", 1).try_cast("double").alias("CYLINDERS"),
                       qf.impute_sentinel(_f(value, ",", 3), "?", hp_default).alias("HP"),
                       _f(value, ",", 5).try_cast("double").alias("ACCELERATION"),
                       _f(value, ",", 6).try_cast("double").alias("MODELYEAR"))


def fuel_regression(fuel: DataFrame, seed: int = 42, train_fraction: float = 0.9,
                    key: Sequence[str] = ("MPG", "CYLINDERS", "HP", "ACCELERATION", "MODELYEAR")):
    """Correlations with MPG, linear regression on the training part, R2 on
    the test part. Returns (correlations, model, test R2 frame)."""
    corr = agg.corr_with_label(fuel, "MPG", list(FUEL_FEATURES) + ["MPG"])
    v = fe.assemble(fuel, list(FUEL_FEATURES))
    train, test = sets.split_by_key(v, list(key), train_fraction, seed)
    model = mo.linear_regression(train, "features", "MPG", max_iter=10)
    return corr, model, mo.r2(model.transform(test), "MPG", "prediction")


# --- iris: decision tree ---------------------------------------------------------

# The columns of the studied tree.
IRIS_FEATURES = ("SEPAL_LENGTH", "SEPAL_WIDTH", "PETAL_LENGTH", "PETAL_WIDTH")


def iris_frame(lines: DataFrame, header_marker: str = "Sepal", value: str = "value") -> DataFrame:
    data = flt.where_not_contains(lines, value, header_marker)
    return data.select(_f(value, ",", 4).alias("SPECIES"),
                       *[_f(value, ",", i).try_cast("double").alias(n) for i, n in enumerate(IRIS_FEATURES)])


def iris_tree(iris: DataFrame, max_depth: int = 2, seed: int = 42, key: Sequence[str] = IRIS_FEATURES):
    """Dt: index species by frequency, tree of depth 2, predictions named back
    with the indexer's labels; accuracy and confusion matrix on the test part."""
    indexed, si = fe.string_index(iris, "SPECIES", "INDEXED")
    v = fe.assemble(indexed, list(IRIS_FEATURES))
    train, test = sets.split_by_key(v, list(key), 0.7, seed)
    model = mo.decision_tree(train, "features", "INDEXED", max_depth=max_depth, seed=seed)
    pred = fe.index_to_string(model.transform(test), "prediction", "PREDICTED_SPECIES", si.labels)
    return {"index": agg.group_count(indexed, "SPECIES", "INDEXED"),
            "accuracy": mo.accuracy(pred, "INDEXED", "prediction"),
            "confusion": agg.confusion_matrix(pred, "SPECIES", "PREDICTED_SPECIES"),
            "model": model}


# --- bank: indicators, PCA, random forest ----------------------------------------

# The columns of the studied forest.
BANK_FEATURES = ("AGE", "SINGLE", "MARRIED", "DIVORCED", "PRIMARY", "SECONDARY", "TERTIARY",
                 "DEFAULT", "BALANCE", "LOAN")


def bank_frame(lines: DataFrame, header: str, outcome_positive: str = "no", value: str = "value") -> DataFrame:
    """Rf: ``;``-separated, quoted values. Indicators match the unquoted value
    exactly (``unknown`` is not ``no``); the outcome's polarity is a parameter;
    balance stays numeric."""
    data = flt.drop_header(lines, value, header)
    uq = lambda i: F.regexp_replace(_f(value, ";", i), '^"|"$', "")
    yes = lambda i, v: (uq(i) == F.lit(v)).cast("double")
    return data.select(yes(16, outcome_positive).alias("OUTCOME"), uq(0).try_cast("double").alias("AGE"),
                       yes(2, "single").alias("SINGLE"), yes(2, "married").alias("MARRIED"),
                       yes(2, "divorced").alias("DIVORCED"), yes(3, "primary").alias("PRIMARY"),
                       yes(3, "secondary").alias("SECONDARY"), yes(3, "tertiary").alias("TERTIARY"),
                       yes(4, "no").alias("DEFAULT"), uq(5).try_cast("double").alias("BALANCE"),
                       yes(7, "no").alias("LOAN"))


def bank_forest(bank: DataFrame, k: int = 3, seed: int = 42):
    """Correlations with the outcome, PCA to ``k`` components, random forest
    on the training part; accuracy and confusion matrix on the test part."""
    corr = agg.corr_with_label(bank, "OUTCOME", list(BANK_FEATURES))
    keyed = bank.withColumn("_row", F.xxhash64(*[F.col(c) for c in bank.columns]))
    v = fe.assemble(keyed, list(BANK_FEATURES))
    reduced, _ = fe.pca(v, "features", k, "pca")
    train, test = sets.split_by_key(reduced, ["_row", "AGE", "BALANCE"], 0.7, seed)
    model = mo.random_forest(train, "pca", "OUTCOME", seed=seed)
    pred = model.transform(test)
    return {"correlations": corr, "accuracy": mo.accuracy(pred, "OUTCOME", "prediction"),
            "confusion": agg.confusion_matrix(pred, "OUTCOME", "prediction")}


# --- messages: naive Bayes text pipeline -------------------------------------------

def message_frame(lines: DataFrame, header_marker: str = "type,text", value: str = "value") -> DataFrame:
    """Nb: label = 1.0 for ``spam`` (exact), message = everything after the
    first comma (a message may hold commas)."""
    data = flt.where_not_contains(lines, value, header_marker)
    parts = qf.split_literal(value, ",", 2)
    return data.select((F.get(parts, 0) == F.lit("spam")).cast("double").alias("LABEL"),
                       F.get(parts, 1).alias("MESSAGE"))


def message_bayes(messages: DataFrame, seed: int = 42):
    """Tokenizer -> TF -> IDF -> naive Bayes pipeline fitted on the training
    part (IDF sees training messages only); accuracy and confusion."""
    keyed = messages.withColumn("_row", F.xxhash64("LABEL", "MESSAGE"))
    train, test = sets.split_by_key(keyed, ["_row"], 0.7, seed)
    model = mo.fit_text_classifier(train, "MESSAGE", "LABEL")
    pred = model.transform(test)
    return {"accuracy": mo.accuracy(pred, "LABEL", "prediction"),
            "confusion": agg.confusion_matrix(pred, "LABEL", "prediction")}


# --- ratings: ALS ------------------------------------------------------------------

def ratings_frame(lines: DataFrame, value: str = "value") -> DataFrame:
    """Als: ``user,item,rating`` without a header; a pair rated twice keeps
    the mean of its ratings."""
    typed = lines.select(_f(value, ",", 0).try_cast("int").alias("user"),
                         _f(value, ",", 1).try_cast("int").alias("item"),
                         _f(value, ",", 2).try_cast("double").alias("rating"))
    ok = typed.where(F.col("user").isNotNull() & F.col("item").isNotNull() & F.col("rating").isNotNull())
    return ok.groupBy("user", "item").agg(F.avg("rating").alias("rating"))


def ratings_als(ratings: DataFrame, rank: int = 10, max_iter: int = 5, seed: int = 42):
    """ALS on 90 % of the pairs; predictions for the rest (NaN where the user
    or the item is unseen in training)."""
    train, test = sets.split_by_key(ratings, ["user", "item"], 0.9, seed)
    model = mo.als(train, "user", "item", "rating", rank=rank, max_iter=max_iter, seed=seed)
    return model, model.transform(test)
