"""Models: topics, Naive Bayes, linear SVM and clusterings.

Fitting is left to ``pyspark.ml`` but for the topic model; every fit takes an explicit seed, and rows
keep their id through ``transform``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LinearSVC
from pyspark.ml.clustering import LDA, BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import lookup_join, materialize, scratch_path, task_count
from .class_gains import block_gains
from .topic_model import TopicModel, fit_topics

# Settings of the standard jobs.
LDA_TOPICS = 50
LDA_ITERATIONS = 10
LDA_PRIOR = 10.0
LDA_SEED = 50
SVM_ITERATIONS = 200
SPLIT_SEED = 12345
SPLIT_TRAIN = 0.6
KMEANS_ITERATIONS = 100
LABEL_SWEEP = (8, 9, 10)
PROFILE_K = 11
MIXTURE_K = 2
MIXTURE_BUCKETS = 20
# Entries of the rows that a task scores at once, and of the least block that is worth a task of its own.
SCORE_ENTRIES = 1 << 21
LEAST_SCORED = 1 << 17


def fit_lda(
    df: DataFrame,
    k: int = LDA_TOPICS,
    max_iter: int = LDA_ITERATIONS,
    doc: float = LDA_PRIOR,
    topic: float = LDA_PRIOR,
    seed: int = LDA_SEED,
    optimizer: str = "em",
):
    """Topic model; by default expectation maximisation, which :func:`fit_topics` runs over blocks of documents."""
    if optimizer == "em":
        return fit_topics(df, k, max_iter, doc, topic, seed)
    return LDA(
        k=k,
        maxIter=max_iter,
        docConcentration=[doc],
        topicConcentration=topic,
        seed=seed,
        optimizer=optimizer,
        featuresCol="features",
    ).fit(df)


def lda_tables(model) -> tuple[DataFrame, DataFrame]:
    """The weights that a topic model was trained to, as tables: ``(idx, weights)`` of terms, ``(weights)`` of documents.

    A document without words has no row. A model of ``pyspark.ml`` is saved and its tables are read, so neither
    goes through the driver: vertices with a negative number are terms, the others documents. An error is raised
    if the tables do not agree with the model.
    """
    if isinstance(model, TopicModel):
        check_topic_terms(model, model.terms)
        return model.terms, model.documents
    spark = SparkSession.active()
    path = scratch_path(spark, "lda")
    model.write().save(path)
    counts = spark.read.parquet(f"{path}/oldModel/data/topicCounts").select(
        "id", vector_to_array("topicWeights").alias("weights")
    )
    terms = counts.where("id < 0").select((-1 - F.col("id")).alias("idx"), "weights")
    check_topic_terms(model, terms)
    return terms, counts.where("id >= 0").select("weights")


def check_topic_terms(model, terms: DataFrame, n: int = 5, tolerance: float = 1e-6) -> None:
    """Stop with an error unless ``(idx, weights)`` are the weights of the model.

    The saved tables have no public layout, so the n terms that the model itself describes each topic by are
    compared: their share of the topic, and that no other term of the table has a larger one.
    """
    told = model.describeTopics(n).select("topic", F.explode(F.arrays_zip("termIndices", "termWeights")).alias("t"))
    told = materialize(told.select("topic", F.col("t.termIndices").cast("bigint").alias("idx"), F.col("t.termWeights").alias("share")), "topics")
    each = terms.select(F.col("idx").cast("bigint").alias("idx"), F.posexplode("weights").alias("topic", "weight"))
    totals = each.groupBy("topic").agg(F.sum("weight").alias("total"), F.max("weight").alias("most"))
    own = each.join(told.select("topic", "idx"), ["topic", "idx"])
    both = told.join(own, ["topic", "idx"], "left").join(totals, "topic", "left")
    share = F.col("weight") / F.col("total")
    wrong = F.coalesce(F.abs(share - F.col("share")) > tolerance, F.lit(True))
    lower = F.max("weight") < F.max("most") * (1 - tolerance)
    found = both.groupBy("topic").agg(F.count_if(wrong).alias("wrong"), F.coalesce(lower, F.lit(True)).alias("lower"))
    bad = found.where("wrong > 0 or lower").count()
    if bad:
        raise RuntimeError(f"the saved tables of the topic model differ from its topics in {bad} topics")


def _class_terms(long: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``(label, idx, n)``: sum of the values of each term in a class; stored."""
    counts = long.join(labels.select(id_col, "label"), id_col).groupBy("label", "idx").agg(F.sum("value").alias("n"))
    return materialize(counts, "class_terms")


def naive_bayes_terms(
    long: DataFrame, labels: DataFrame, n_terms: int, smoothing: float = 1.0, id_col: str = "doc_id"
) -> DataFrame:
    """Log probability of each term seen in a class: ``(label, idx, log_prob)``."""
    return _term_probabilities(_class_terms(long, labels, id_col), n_terms, smoothing)


def _term_probabilities(counts: DataFrame, n_terms: int, smoothing: float) -> DataFrame:
    totals = counts.groupBy("label").agg(F.sum("n").alias("total"))
    return lookup_join(counts, totals, ["label"], ["idx"]).select(
        "label",
        "idx",
        (F.log(F.col("n") + smoothing) - F.log(F.col("total") + smoothing * n_terms)).alias("log_prob"),
    )


def naive_bayes_priors(labels: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """Log prior of each class over all labelled rows: ``(label, log_prior)``."""
    counts = materialize(labels.groupBy("label").agg(F.count("*").alias("n")), "classes")
    whole = counts.agg(F.count("*").alias("classes"), F.sum("n").alias("rows")).first()
    total = (whole["rows"] or 0) + smoothing * whole["classes"]
    return counts.select("label", (F.log(F.col("n") + smoothing) - F.log(F.lit(float(total)))).alias("log_prior"))


@dataclass(frozen=True)
class NaiveBayesTables:
    """A multinomial model as tables: ``terms(label, idx, log_prob)`` of the terms seen in a class, and
    ``classes(label, log_prior, unseen)`` with the log probability of any other term of the vocabulary."""

    terms: DataFrame
    classes: DataFrame


def fit_naive_bayes(
    long: DataFrame, labels: DataFrame, n_terms: int, smoothing: float = 1.0, id_col: str = "doc_id"
) -> NaiveBayesTables:
    """Multinomial Naive Bayes with additive smoothing; rows without known words count in the priors."""
    seen = _class_terms(long, labels, id_col)
    terms = materialize(_term_probabilities(seen, n_terms, smoothing), "bayes_terms")
    counts = seen.groupBy("label").agg(F.sum("n").alias("total"))
    priors = naive_bayes_priors(labels, smoothing)
    unseen = F.log(F.lit(smoothing)) - F.log(F.coalesce("total", F.lit(0.0)) + smoothing * n_terms)
    classes = priors.join(counts, "label", "left").select("label", "log_prior", unseen.alias("unseen"))
    return NaiveBayesTables(terms, materialize(classes, "bayes_classes"))


def _gains(model: NaiveBayesTables, long: DataFrame, id_col: str) -> DataFrame:
    """(id, label, gain): what the terms of a row that a class has seen add to its score; no other class is listed.

    Rows are dealt into blocks. A term is sent once to each block that holds it, with all classes that have seen it,
    and the entries meet them there, so no row is made per entry and class. The work of a block is bounded by its
    entries; a null id names no row and is left out.
    """
    extra = lookup_join(model.terms, model.classes.select("label", "unseen"), ["label"], ["idx"])
    gained = F.struct("label", (F.col("log_prob") - F.col("unseen")).alias("more"))
    by_term = extra.groupBy("idx").agg(F.collect_list(gained).alias("c")).select(
        "idx", F.col("c.label").alias("labels"), F.col("c.more").alias("more")
    )
    entries = long.where(F.col(id_col).isNotNull()).select(id_col, "idx", F.col("value").cast("double").alias("value"))
    total = entries.count()
    blocks = max(-(-total // SCORE_ENTRIES), min(task_count(long.sparkSession), -(-total // LEAST_SCORED)), 1)
    dealt = entries.withColumn("block", F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int"))
    held = dealt.select(F.col("block").alias("part"), F.col("idx").alias("term")).groupBy("term").agg(F.collect_set("part").alias("parts"))
    sent = held.join(by_term.withColumnRenamed("idx", "term"), "term").select(F.explode("parts").alias("part"), "term", "labels", "more")
    schema = T.StructType([long.schema[id_col], model.terms.schema["label"], T.StructField("gain", T.DoubleType())])
    return dealt.groupBy("block").cogroup(sent.groupBy("part")).applyInArrow(block_gains(id_col), schema)


def _sizes(long: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """(id, size): known words of every id, 0 for one without any."""
    sizes = long.groupBy(id_col).agg(F.sum("value").alias("size"))
    return ids.select(id_col).distinct().join(sizes, id_col, "left").select(id_col, F.coalesce("size", F.lit(0.0)).alias("size"))


def class_scores(model: NaiveBayesTables, long: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Log score of each class for every id of ``ids``: ``(id, scores)``, an array of (label, score).

    A row without known words is scored by the priors. Terms and classes stay tables; the list of all classes
    is one row that is read by the tasks. The result has as many scores as rows times classes; where the best
    classes are enough, :func:`top_classes` does not build it.
    """
    seen = _gains(model, long, id_col).groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.struct("label", "gain"))).alias("gain")
    )
    # A subquery of one row, so the plan holds no literal per class.
    listed = model.classes.agg(F.sort_array(F.collect_list(F.struct("label", "log_prior", "unseen")))).scalar()
    rows = _sizes(long, ids, id_col).join(seen, id_col, "left").withColumn("_classes", listed)
    scores = F.transform(
        "_classes",
        lambda c: F.struct(
            c["label"].alias("label"),
            (c["log_prior"] + F.col("size") * c["unseen"] + F.coalesce(F.try_element_at("gain", c["label"]), F.lit(0.0))).alias("score"),
        ),
    )
    return rows.select(id_col, scores.alias("scores"))


def leading_classes(model: NaiveBayesTables, sizes: DataFrame, k: int) -> DataFrame:
    """(size, label, score): the k best classes of each row size when no term of the row was seen in a class.

    Of classes with equal priors only the k with the best score of an unseen word can be among them, whatever
    the size, so these few are all that is compared.
    """
    rank = Window.partitionBy("log_prior").orderBy(F.desc("unseen"), F.asc("label"))
    few = model.classes.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k)
    listed = few.agg(F.collect_list(F.struct("label", "log_prior", "unseen"))).scalar()
    scored = F.transform(
        "_classes", lambda c: F.struct((-(c["log_prior"] + F.col("size") * c["unseen"])).alias("neg"), c["label"].alias("label"))
    )
    best = F.slice(F.sort_array(scored), 1, k)
    told = sizes.select("size").distinct().withColumn("_classes", listed).select("size", F.explode(best).alias("c"))
    return told.select("size", F.col("c.label").alias("label"), (-F.col("c.neg")).alias("score"))


def top_classes(model: NaiveBayesTables, long: DataFrame, ids: DataFrame, k: int = 1, id_col: str = "doc_id") -> DataFrame:
    """The k best classes of every id as rows ``(id, rank, label, score)``; equal scores are ranked by label.

    A class that has seen a term of the row is scored from its gains. The others differ by their priors and the
    size of the row alone, so their best k depend on the size only. Scores are never built for all classes, so
    the work grows with the terms of the rows and not with rows times classes.
    """
    sized = materialize(_sizes(long, ids, id_col), "sizes")
    gains = lookup_join(_gains(model, long, id_col), model.classes, ["label"], [id_col])
    seen = gains.join(sized, id_col).select(
        id_col, "label", (F.col("log_prior") + F.col("size") * F.col("unseen") + F.col("gain")).alias("score")
    )
    other = lookup_join(sized, leading_classes(model, sized, k), ["size"], [id_col]).select(id_col, "label", "score")
    # A gain is never negative, so the higher score of a class is the true one.
    every = seen.unionByName(other).groupBy(id_col, "label").agg(F.max("score").alias("score"))
    if k == 1:
        best = every.groupBy(id_col).agg(F.max(F.struct("score", (-F.col("label")).alias("neg"))).alias("best"))
        return best.select(id_col, F.lit(1).alias("rank"), (-F.col("best.neg")).alias("label"), F.col("best.score").alias("score"))
    order = Window.partitionBy(id_col).orderBy(F.desc("score"), F.asc("label"))
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(id_col, "rank", "label", "score")


def class_probabilities(scores: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Probability of each class per row, as rows ``(id, cls, p)``."""
    top = F.array_max(F.transform("scores", lambda c: c["score"]))
    shares = F.transform("scores", lambda c: F.struct(c["label"].alias("cls"), F.exp(c["score"] - F.col("top")).alias("x")))
    total = F.aggregate("shares", F.lit(0.0), lambda s, c: s + c["x"])
    return (
        scores.withColumn("top", top)
        .select(id_col, shares.alias("shares"))
        .select(id_col, total.alias("total"), F.explode("shares").alias("c"))
        .select(id_col, F.col("c.cls").cast("int").alias("cls"), (F.col("c.x") / F.col("total")).alias("p"))
    )


def predict_class(scores: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Most likely class per row of scores of all classes, the first of equal ones."""
    best = F.array_max(F.transform("scores", lambda c: F.struct(c["score"].alias("score"), (-c["label"]).alias("neg"))))
    return scores.select(id_col, (-best["neg"]).cast("int").alias("predicted"))


def fit_linear_svm(df: DataFrame, max_iter: int = SVM_ITERATIONS, reg: float = 0.0):
    """Binary linear classifier with hinge loss."""
    return LinearSVC(maxIter=max_iter, regParam=reg).fit(df)


def margin_scores(model, df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Raw margin of class 1 beside the label and the features."""
    return model.transform(df).select(
        id_col, F.element_at(vector_to_array("rawPrediction"), 2).alias("score"), "label", "features"
    )


def linear_weights(model) -> DataFrame:
    """Weights of a linear model as a table ``(idx, weight)``; their number is bounded by the selected features."""
    rows = [(i, float(w)) for i, w in enumerate(model.coefficients.toArray()) if w != 0.0]
    return SparkSession.active().createDataFrame(rows, "idx int, weight double")


def sparse_margins(long: DataFrame, weights: DataFrame, intercept: float, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Margin ``(id, score)`` of every id from its features ``(id, idx, value)``; without features it is the intercept."""
    parts = lookup_join(long, weights, ["idx"], [id_col]).groupBy(id_col).agg(
        F.sum(F.col("value") * F.col("weight")).alias("part")
    )
    return ids.select(id_col).join(parts, id_col, "left").select(
        id_col, (F.lit(float(intercept)) + F.coalesce("part", F.lit(0.0))).alias("score")
    )


def split(df: DataFrame, train: float = SPLIT_TRAIN, seed: int = SPLIT_SEED, id_col: str = "doc_id"):
    """Repeatable random split by row id: ``(training rows, test rows)``.

    Depends on the id only, not on partitions or on the order of the rows.
    """
    bucket = split_bucket(seed, id_col)
    limit = F.lit(int(round(train * 100)))
    return df.where(bucket < limit), df.where(bucket >= limit)


def split_bucket(seed: int, id_col: str):
    """Number from 0 to 99 drawn from the row id and the seed."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(100))


def fit_kmeans(df: DataFrame, k: int, max_iter: int = KMEANS_ITERATIONS, features_col: str = "scaled", seed: int = 1):
    return KMeans(k=k, maxIter=max_iter, featuresCol=features_col, seed=seed).fit(df)


def fit_bisecting(df: DataFrame, k: int, features_col: str = "scaled", seed: int = 1):
    return BisectingKMeans(k=k, featuresCol=features_col, seed=seed).fit(df)


def fit_gmm(df: DataFrame, k: int = MIXTURE_K, features_col: str = "normed", seed: int = 1):
    return GaussianMixture(k=k, featuresCol=features_col, seed=seed).fit(df)


def assign_clusters(model, df: DataFrame, id_col: str = "member") -> DataFrame:
    """Hard label per row; the id is kept."""
    return model.transform(df).select(
        F.col(id_col).alias("member"), F.col("prediction").cast("int").alias("cluster")
    )


def soft_membership(model, df: DataFrame, id_col: str = "member") -> DataFrame:
    """Component probabilities per row, as an array."""
    return model.transform(df).select(
        F.col(id_col).alias("member"), vector_to_array("probability").alias("p")
    )


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(kind, path: str):
    """``kind`` is the model class, e.g. ``KMeansModel``."""
    return kind.load(path)


def stored_model(kind, path: str | None, fit):
    """The model at ``path``, or the one that ``fit`` gives, which is then saved there; None stores nothing.

    A model counts as saved when its last part was written.
    """
    if path is None:
        return fit()
    spark = SparkSession.active()
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return load_model(kind, path)
    model = fit()
    save_model(model, path)
    return model
