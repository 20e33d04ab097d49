"""Feature vectors in long form ``(id, idx, value)`` and as sparse ML vectors.

The long form shuffles and aggregates like any table. It becomes a vector column
only where a model needs one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    DCT,
    IDF,
    PCA,
    CountVectorizerModel,
    HashingTF,
    MinMaxScaler,
    Normalizer,
    StandardScaler,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rows import explode_once
from ..runtime import fits_broadcast, keyed_join, lookup_join, materialize


def lookup_vocabulary(
    tokens: DataFrame, vocabulary: DataFrame, spread_by: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Append the dimension ``idx`` of each token; unknown tokens are dropped."""
    return lookup_join(tokens, vocabulary.select("term", "idx"), ["term"], spread_by)


def count_vectors(tokens: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """How often each vocabulary term occurs in each record."""
    words = tokens.select(id_col, "term")
    terms = vocabulary.select("term", "idx")
    if fits_broadcast(terms):
        return (
            words.join(F.broadcast(terms), "term")
            .groupBy(id_col, "idx")
            .agg(F.count("*").cast("double").alias("value"))
        )
    counted = words.groupBy(id_col, "term").agg(F.count("*").cast("double").alias("value"))
    return keyed_join(counted, terms, ["term"], [id_col], small=False).select(id_col, "idx", "value")


def binary_vectors(tokens: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """1 for each vocabulary term that occurs in the record."""
    found = lookup_vocabulary(tokens.select(id_col, "term"), vocabulary, [id_col])
    return found.select(id_col, "idx").distinct().withColumn("value", F.lit(1.0))


def one_hot(df: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per record with a single term: a 1 at the index of the term."""
    return lookup_vocabulary(df.select(id_col, "term"), vocabulary, [id_col]).select(
        id_col, "idx", F.lit(1.0).alias("value")
    )


def profile_vectors(
    profiles: DataFrame,
    weighted: DataFrame,
    id_col: str = "member",
    ones: Sequence[str] = ("tags", "groups"),
    weighted_field: str = "words",
) -> DataFrame:
    """Tags and groups set 1, words set the weight of the list and win over 1.

    ``profiles`` has one array column per field; ``weighted`` is
    ``(term, idx, weight)``. Only values above 0 are kept.
    """
    def ranked(name: str, priority: int) -> Column:
        terms = F.array_distinct(F.coalesce(F.col(name), F.array().cast("array<string>")))
        return F.transform(
            terms, lambda term: F.struct(F.lit(priority).alias("priority"), term.alias("term"))
        )

    flat = F.concat(*[ranked(name, 0) for name in ones], ranked(weighted_field, 1))
    tokens = explode_once(profiles, [id_col], flat, "t").select(id_col, "t.term", "t.priority")
    known = lookup_join(tokens, weighted.select("term", "idx", "weight"), ["term"], [id_col])
    value = F.when(F.col("priority") == 1, F.col("weight")).otherwise(F.lit(1.0))
    return (
        known.groupBy(id_col, "idx")
        .agg(F.max_by(value, F.col("priority")).alias("value"))
        .where(F.col("value") > 0)
    )


def drop_thin_rows(
    long: DataFrame, id_col: str = "member", min_chars: int = 40, min_nonzero: int = 1
) -> DataFrame:
    """Drop records whose line ``label index:value ...`` would be too short."""
    pair = (
        F.length((F.col("idx") + 1).cast("string"))
        + F.lit(1)
        + F.length(F.col("value").cast("double").cast("string"))
        + F.lit(1)
    )
    # The rows of a record meet once; an aggregate that is joined back would work out and shuffle the rows twice.
    record = Window.partitionBy(id_col)
    sized = long.where(F.col(id_col).isNotNull()).select(
        "*", (F.sum(pair).over(record) + F.lit(2)).alias("_chars"), F.count("*").over(record).alias("_nonzero")
    )
    thick = sized.where((F.col("_chars") >= min_chars) & (F.col("_nonzero") >= min_nonzero))
    return thick.select(id_col, *[c for c in long.columns if c != id_col])


def sparse_vectors(
    long: DataFrame, size: int, id_col: str = "doc_id", out: str = "features", ids: DataFrame | None = None
) -> DataFrame:
    """One sparse vector per record, without Python and without a driver-side vocabulary.

    The parts of a vector are stored as plain columns and read back with the
    vector type. With ``ids`` every one of them has a vector, an empty one if the
    record has no entries.
    """
    entries = F.sort_array(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), "value")))
    gathered = long.groupBy(id_col).agg(entries.alias("_e"))
    if ids is not None:
        gathered = ids.select(id_col).distinct().join(gathered, id_col, "left")
    parts = gathered.select(
        id_col,
        F.struct(
            F.lit(0).cast("byte").alias("type"),
            F.lit(int(size)).alias("size"),
            F.coalesce("_e.idx", F.array().cast("array<int>")).alias("indices"),
            F.coalesce("_e.value", F.array().cast("array<double>")).alias("values"),
        ).alias(out),
    )
    schema = T.StructType([long.schema[id_col], T.StructField(out, VectorUDT())])
    return materialize(parts, "vectors", schema)


def stored_values(vectors: Column | str) -> Column:
    """The values that sparse vectors hold, in the order of their indices.

    An array as long as the entries of the row; ``vector_to_array`` gives one as long as the vocabulary.
    """
    return F.unwrap_udt(F.col(vectors) if isinstance(vectors, str) else vectors)["values"]


def dense_vectors(df: DataFrame, values: str, out: str = "features") -> DataFrame:
    """Array of numbers to a vector column."""
    return df.withColumn(out, array_to_vector(F.col(values).cast("array<double>")))


def array_long(df: DataFrame, id_col: str, values: str) -> DataFrame:
    """Array column to long form, zeros left out."""
    return df.select(id_col, F.posexplode(values).alias("idx", "value")).select(
        id_col, "idx", F.col("value").cast("double").alias("value")
    ).where(F.col("value") != 0)


def fit_count_vectorizer(
    tokens: DataFrame, vocab_size: int = 10000, min_df: int = 5, id_col: str = "doc_id"
) -> DataFrame:
    """The most frequent terms that occur in enough records: ``(term, n, df)``.

    Counted per record first, so both numbers come from one pass.
    """
    per_record = tokens.groupBy(id_col, "term").agg(F.count("*").alias("n"))
    return (
        per_record.groupBy("term")
        .agg(F.sum("n").alias("n"), F.count("*").alias("df"))
        .where(F.col("df") >= min_df)
        .orderBy(F.desc("n"), F.asc("term"))
        .limit(vocab_size)
    )


def count_vectorizer_model(
    chosen: DataFrame, input_col: str = "terms", output_col: str = "features", binary: bool = False
) -> CountVectorizerModel:
    """ML stage for a vocabulary that ``fit_count_vectorizer`` has bounded."""
    terms = [row.term for row in chosen.orderBy(F.desc("n"), F.asc("term")).select("term").collect()]
    return CountVectorizerModel.from_vocabulary(terms, input_col, output_col, binary=binary)


def hashing_tf(df: DataFrame, n: int = 20, terms: str = "terms", out: str = "tf") -> DataFrame:
    """Term frequency in ``n`` hash buckets."""
    return HashingTF(inputCol=terms, outputCol=out, numFeatures=n).transform(df)


def idf(df: DataFrame, column: str = "tf", out: str = "tfidf") -> DataFrame:
    """Weight by ln((m + 1) / (df + 1))."""
    return IDF(inputCol=column, outputCol=out).fit(df).transform(df)


def idf_long(long: DataFrame, n_docs: int, id_col: str = "doc_id") -> DataFrame:
    """Long-form twin of :func:`idf`."""
    weights = long.groupBy("idx").agg(
        F.log((F.lit(n_docs) + 1.0) / (F.count("*") + 1.0)).alias("_w")
    )
    weights = materialize(weights, "weights")
    return lookup_join(long, weights, ["idx"], [id_col]).select(
        id_col, "idx", (F.col("value") * F.col("_w")).alias("value")
    )


def standard_scale(df: DataFrame, column: str = "features", out: str = "scaled") -> DataFrame:
    """Divide by the sample deviation, without centring."""
    scaler = StandardScaler(inputCol=column, outputCol=out, withStd=True, withMean=False)
    return scaler.fit(df).transform(df)


def deviation_long(long: DataFrame, n_rows: int) -> DataFrame:
    """Sample deviation of each dimension; rows left out of the long form are zero."""
    value = F.col("value")
    mean = F.sum(value) / F.lit(n_rows)
    variance = (F.sum(value * value) - F.lit(n_rows) * mean * mean) / F.lit(n_rows - 1)
    return long.groupBy("idx").agg(F.sqrt(F.greatest(variance, F.lit(0.0))).alias("sd"))


def scale_long(long: DataFrame, deviation: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Divide by a fitted deviation; a constant dimension becomes zero."""
    scaled = F.when(F.col("sd") > 0, F.col("value") / F.col("sd")).otherwise(F.lit(0.0))
    deviation = materialize(deviation, "deviation")
    return lookup_join(long, deviation, ["idx"], [id_col]).select(
        id_col, "idx", scaled.alias("value")
    )


def standard_scale_long(long: DataFrame, n_rows: int, id_col: str = "doc_id") -> DataFrame:
    """Long-form twin of :func:`standard_scale`."""
    return scale_long(long, deviation_long(long, n_rows), id_col)


def normalize(df: DataFrame, p: float = 1.0, column: str = "tfidf", out: str = "normed") -> DataFrame:
    """Divide each row by its p-norm."""
    return Normalizer(inputCol=column, outputCol=out, p=p).transform(df)


def normalize_long(long: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Long-form twin of :func:`normalize` for p = 1."""
    # One shuffle of the rows, as in :func:`drop_thin_rows`.
    norm = F.sum(F.abs("value")).over(Window.partitionBy(id_col))
    return long.where(F.col(id_col).isNotNull()).select(id_col, "idx", "value", norm.alias("_norm")).select(
        id_col,
        "idx",
        F.when(F.col("_norm") > 0, F.col("value") / F.col("_norm")).otherwise(F.lit(0.0)).alias("value"),
    )


def min_max_scale(df: DataFrame, column: str = "features", out: str = "scaled") -> DataFrame:
    """Map each dimension to 0..1."""
    return MinMaxScaler(inputCol=column, outputCol=out).fit(df).transform(df)


def pca(df: DataFrame, k: int, column: str = "features", out: str = "pca") -> DataFrame:
    """First ``k`` principal components."""
    return PCA(inputCol=column, outputCol=out, k=k).fit(df).transform(df)


def dct(df: DataFrame, column: str = "features", out: str = "dct", inverse: bool = False) -> DataFrame:
    """Cosine transform of each vector."""
    return DCT(inputCol=column, outputCol=out, inverse=inverse).transform(df)


def chi_square_scores(long: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Chi-square of each dimension against the label: ``(idx, chi2, dof)``.

    Each distinct value is a category and rows left out of the long form are the
    category zero, whose cells follow from the class totals:
    chi2 = N * (sum(observed^2 / (row total * class total)) - 1).
    """
    labels = labels.select(id_col, "label")
    totals = materialize(labels.groupBy("label").agg(F.count("*").alias("n_label")), "classes")
    n, n_classes = totals.agg(F.sum("n_label"), F.count("*")).first()
    cells = (
        long.join(labels, id_col).groupBy("idx", "value", "label").agg(F.count("*").alias("o"))
    )
    cells = materialize(lookup_join(cells, totals, ["label"], ["idx"]), "cells")
    observed = F.col("o") * F.col("o") / F.col("n_label")
    rows = cells.groupBy("idx", "value").agg(
        F.sum("o").alias("r"), (F.sum(observed) / F.sum("o")).alias("part")
    )
    per_class = cells.groupBy("idx", "label", "n_label").agg(F.sum("o").alias("z"))
    zero = per_class.groupBy("idx").agg(
        F.sum("z").alias("nz"),
        F.sum(F.col("z") * F.col("z") / F.col("n_label")).alias("z2"),
    )
    filled = rows.groupBy("idx").agg(F.sum("part").alias("parts"), F.count("*").alias("n_values"))
    r0 = F.lit(n) - F.col("nz")
    zero_part = F.when(r0 > 0, (F.lit(n) - 2 * F.col("nz") + F.col("z2")) / r0).otherwise(F.lit(0.0))
    categories = F.col("n_values") + F.when(r0 > 0, 1).otherwise(0)
    return filled.join(zero, "idx").select(
        "idx",
        (F.lit(n) * (F.col("parts") + zero_part - 1)).alias("chi2"),
        ((categories - 1) * F.lit(n_classes - 1)).alias("dof"),
    )


def chi_square_select(long: DataFrame, labels: DataFrame, n: int = 5000, id_col: str = "doc_id"):
    """Keep the n dimensions with the largest chi-square, numbered anew from 0.

    Returns ``(selected long form, chosen(idx, new_idx))``; ``chosen`` has n rows at most.
    """
    from .terms import rank_desc
    from ..runtime import dense_index

    best = rank_desc(chi_square_scores(long, labels, id_col), "chi2", "idx").limit(n)
    chosen = dense_index(best.select("idx"), [F.asc("idx")], "new_idx")
    kept = lookup_join(long, chosen, ["idx"], [id_col]).select(
        id_col, F.col("new_idx").alias("idx"), "value"
    )
    return kept, chosen
