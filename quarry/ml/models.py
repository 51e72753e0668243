"""Models and their evaluation.

Fitting is ``pyspark.ml`` (distributed); every random step takes a seed.
Metrics are one-row DataFrames computed by aggregates over the prediction
frame, never values pulled to the driver in the middle of a pipeline.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import attach_scalars
from ..operators.layout import cached
from ..session import checkpoint_root


def linear_regression(train: DataFrame, features: str = "features", label: str = "label",
                      max_iter: int = 10, reg_param: float = 0.0):
    """Least squares (normal equations for few features)."""
    return LinearRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                            regParam=reg_param).fit(train)


def regression_facts(spark: SparkSession, model) -> DataFrame:
    """Coefficients, intercept and training R2 as a one-row frame."""
    s = model.summary
    return spark.createDataFrame(
        [(list(map(float, model.coefficients)), float(model.intercept), float(s.r2),
          int(s.totalIterations))],
        "coefficients array<double>, intercept double, r2 double, iterations int")


def decision_tree(train: DataFrame, features: str = "features", label: str = "label",
                  max_depth: int = 4, seed: int = 42, prediction: str = "prediction"):
    """M11."""
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth,
                                  seed=seed, predictionCol=prediction).fit(train)


def tree_facts(spark: SparkSession, model) -> DataFrame:
    """M18 for trees: node count and depth."""
    return spark.createDataFrame([(int(model.numNodes), int(model.depth))],
                                 "num_nodes int, depth int")


def random_forest(train: DataFrame, features: str = "features", label: str = "label",
                  num_trees: int = 20, max_depth: int = 5, seed: int = 42,
                  prediction: str = "prediction"):
    """M12."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed,
                                  predictionCol=prediction).fit(train)


def naive_bayes(train: DataFrame, features: str = "features", label: str = "label",
                smoothing: float = 1.0, prediction: str = "prediction"):
    """Multinomial naive Bayes (features must be >= 0)."""
    return NaiveBayes(featuresCol=features, labelCol=label, smoothing=smoothing,
                      predictionCol=prediction).fit(train)


def kmeans(df: DataFrame, features: str = "features", k: int = 4, seed: int = 1,
           max_iter: int = 20, prediction: str = "prediction"):
    """K-means (k-means|| start)."""
    return KMeans(featuresCol=features, k=k, seed=seed, maxIter=max_iter,
                  predictionCol=prediction).fit(df)


def als(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 10,
        max_iter: int = 5, reg_param: float = 0.1, seed: int = 42,
        cold_start: str = "nan", checkpoint_interval: int = 10, blocks: int = 10):
    """Explicit-feedback ALS. Lineage is cut every
    ``checkpoint_interval`` iterations in the session's shared checkpoint
    folder, so a lost executor does not recompute every iteration.

    ``blocks`` is the number of user and of item blocks (ALS runs one task
    per block and step; every rating task holds a buffer per pair of blocks, so
    it should grow with the data, not with the cluster). Pairs with a user or
    item unknown to the model are predicted NaN; ``cold_start="drop"`` drops them."""
    checkpoint_root(ratings.sparkSession)
    n = blocks
    return ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, maxIter=max_iter,
               regParam=reg_param, seed=seed, coldStartStrategy=cold_start,
               checkpointInterval=checkpoint_interval, numUserBlocks=n,
               numItemBlocks=n).fit(ratings)


def text_classifier(text_col: str = "text", label: str = "label", num_features: int = 1 << 18,
                    smoothing: float = 1.0) -> Pipeline:
    """M9: tokenizer -> hashed TF -> IDF -> naive Bayes, as one pipeline."""
    return Pipeline(stages=[
        Tokenizer(inputCol=text_col, outputCol="_tokens"),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        NaiveBayes(featuresCol="_tfidf", labelCol=label, smoothing=smoothing),
    ])


def fit_text_classifier(train: DataFrame, text_col: str = "text", label: str = "label",
                        num_features: int = 1 << 18, smoothing: float = 1.0) -> PipelineModel:
    """M9 fitted with one pass over the texts: the first two stages learn
    nothing, so their output is computed once and kept while IDF and naive
    Bayes, which read it several times, are fitted. Same model as
    ``text_classifier(...).fit(train)``."""
    tokenizer, tf, *fitted = text_classifier(text_col, label, num_features, smoothing).getStages()
    with cached(tf.transform(tokenizer.transform(train)).select(label, "_tf")) as vectors:
        rest = Pipeline(stages=fitted).fit(vectors)
    return PipelineModel([tokenizer, tf, *rest.stages])


def term_naive_bayes(tf: DataFrame, docs: DataFrame, label: str, classes: Sequence,
                     smoothing: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """M13 in long form, exact (no hashing): multinomial naive Bayes over
    (doc, term, tf) rows with a label column.

    ``tf`` and ``docs`` are the training part: one row per document and term,
    and one per document. Returns (terms, priors): per training term its
    smoothed log probability in each class (``lp_0``, ``lp_1``, ... in the
    order of ``classes``), and one row of log priors by the same names. Both
    are partial aggregates; the class totals come in as scalar subqueries.
    """
    def in_class(value, k):
        return F.sum(F.when(F.col(label) == F.lit(classes[k]), value).otherwise(0.0))

    n = range(len(classes))
    counts = tf.groupBy("term").agg(*[(in_class(F.col("tf"), k) + F.lit(smoothing)).alias(f"n_{k}") for k in n])
    totals = counts.agg(*[F.sum(f"n_{k}").alias(f"t_{k}") for k in n])
    terms = attach_scalars(counts, totals).select(
        "term", *[(F.log(f"n_{k}") - F.log(f"t_{k}")).alias(f"lp_{k}") for k in n])
    priors = docs.agg(*[F.log((in_class(F.lit(1.0), k) + smoothing) / (F.count(F.lit(1)) + smoothing * len(classes)))
                        .alias(f"lp_{k}") for k in n])
    return terms, priors


def term_scores(tf: DataFrame, docs: DataFrame, doc: str, terms: DataFrame, priors: DataFrame,
                n_classes: int) -> DataFrame:
    """Log score of every document in each class (``score_0``, ...) under a
    ``term_naive_bayes`` model, next to the columns of ``docs``. Terms unknown
    to the model say nothing; a document without known terms gets the priors.
    The join is on the term (one row per term on the model's side, hot terms
    are split by AQE), the sums are partial before the shuffle by document."""
    n = range(n_classes)
    sums = (tf.select(doc, "term", "tf").join(terms, "term")
            .groupBy(doc).agg(*[F.sum(F.col("tf") * F.col(f"lp_{k}")).alias(f"_s{k}") for k in n]))
    out = docs.join(sums, doc, "left")
    prior = [priors.select(f"lp_{k}").scalar() for k in n]
    return out.select(*docs.columns, *[(prior[k] + F.coalesce(F.col(f"_s{k}"), F.lit(0.0))).alias(f"score_{k}") for k in n])


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction",
             name: str = "accuracy") -> DataFrame:
    """Share of rows with prediction = label (one aggregate)."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return pred.agg(F.avg(hit).alias(name))


def r2(pred: DataFrame, label: str = "label", prediction: str = "prediction",
       name: str = "r2") -> DataFrame:
    """``1 - SS_res / SS_tot``; the label mean is a scalar subquery."""
    y = F.col(label).cast("double")
    mean = pred.select(F.avg(y)).scalar()
    # deviations are projected first: a model's output column may be
    # non-deterministic to the analyzer, which then refuses it inside sum()
    dev = pred.select(((y - F.col(prediction)) ** 2).alias("_res"), ((y - mean) ** 2).alias("_tot"))
    return dev.agg((F.lit(1.0) - F.try_divide(F.sum("_res"), F.sum("_tot"))).alias(name))


def r2_of_group_means(df: DataFrame, label: str, keys: Sequence[str], name: str = "r2") -> DataFrame:
    """M17 for the prediction "mean label of the row's group", without joining
    the means back: ``SS_res = sum_g n_g * var_pop_g`` and
    ``SS_tot = N * var_pop``. One scan: grouping sets give the per-group and
    the overall moments from the same partial (map-side) aggregate, so a group
    holding a third of the rows costs nothing extra, where a join back on the
    group key would be skewed."""
    y = F.col(label).cast("double")
    moments = (df.groupingSets([list(keys), []], *keys)
               .agg(F.grouping_id().alias("_gid"), F.count(y).alias("_n"), F.var_pop(y).alias("_v")))
    ss = F.col("_n") * F.col("_v")
    return moments.agg((F.lit(1.0) - F.try_divide(F.sum(F.when(F.col("_gid") == 0, ss)),
                                                   F.sum(F.when(F.col("_gid") != 0, ss)))).alias(name))


def compare_classifiers(train: DataFrame, test: DataFrame,
                        estimators: Mapping[str, Estimator], label: str = "label",
                        prediction: str = "prediction") -> DataFrame:
    """Fit each estimator (a short, fixed list) on one split and return
    one row per model: (model, accuracy). The training part is kept while the
    models are fitted (each reads it many times); the test part is read once,
    every model adding its own prediction column to the same rows."""
    names = list(estimators)
    with cached(train) as kept:
        models = [estimators[n].copy({estimators[n].getParam(p): f"_{i}_{p}" for p in
                                      ("predictionCol", "rawPredictionCol", "probabilityCol")}).fit(kept)
                  for i, n in enumerate(names)]
    pred = test
    for m in models:
        pred = m.transform(pred)
    # a model's column may be non-deterministic to the analyzer, which refuses it inside avg()
    hits = pred.select(*[(F.col(label).cast("double") == F.col(f"_{i}_predictionCol")).cast("double").alias(f"_hit{i}")
                         for i in range(len(names))])
    shares = hits.agg(*[F.avg(f"_hit{i}").alias(f"_hit{i}") for i in range(len(names))])
    rows = [F.struct(F.lit(n).alias("model"), F.col(f"_hit{i}").alias("accuracy")) for i, n in enumerate(names)]
    return shares.select(F.inline(F.array(*rows)))


def default_classifiers(features: str = "features", label: str = "label", seed: int = 42,
                        nb_features: str | None = None) -> dict[str, Estimator]:
    """The three classifiers of the credit job: tree (depth 4), forest, naive Bayes."""
    return {
        "decision_tree": DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=4, seed=seed),
        "random_forest": RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed),
        "naive_bayes": NaiveBayes(featuresCol=nb_features or features, labelCol=label),
    }


def with_predictions(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Apply a model and keep the named columns plus ``prediction``."""
    return model.transform(df).select(*keep, "prediction")
