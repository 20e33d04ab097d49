"""Vectors, scalings, models, topics, clusters."""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import models as M
from ..operators.clusters import (
    accuracy_report,
    cluster_centres,
    cluster_members,
    cluster_sizes,
    cluster_tag_counts,
    cluster_words,
    clustering_cost,
    compare_labelings,
    labels_across_k,
    members_with_rows,
    order_by_key,
    predictions_with_text,
    squared_distance,
    top_tags,
)
from ..operators.terms import build_vocabulary, frequent_terms, term_counts
from ..operators.topics import hot_topics, top_topics_per_document, topic_popularity, topic_terms
from ..operators.vectors import (
    binary_vectors,
    chi_square_scores,
    chi_square_select,
    count_vectors,
    dct,
    dense_vectors,
    fit_count_vectorizer,
    hashing_tf,
    idf,
    idf_long,
    lookup_vocabulary,
    min_max_scale,
    normalize,
    normalize_long,
    one_hot,
    pca,
    profile_vectors,
    sparse_vectors,
    standard_scale,
    standard_scale_long,
    stored_values,
)
from ..functions.fields import profile_tag_array
from ..functions.text import words
from ..plans.affinity_classifier import model_store, classifier_report, profile_fields
from ..plans.category_scores import fit_category_lines, fit_category_model, predict_tokens, score_texts, score_tokens
from ..plans.profile_clusters import (
    cluster_profiles,
    label_sweep,
    mixture_features,
    mixture_words,
    profile_features,
    profile_report,
)
from ..plans.term_clusters import cluster_terms, document_lists, leading_components, row_sums
from ..plans.topics import topic_report
from ..plans.word_graph import build_index
from ..runtime import dense_index, lookup_join, materialize, scratch_path
from .base import SQL_LABELLED, SQL_POSTINGS, SQL_PROFILES, SQL_TOKENS, SQL_WORDS, query

DOC_WORDS = SQL_WORDS.format("text")

# Vocabulary of frequent terms over all documents, most frequent first.
SQL_VOCABULARY = f"""{SQL_TOKENS},
tc AS (SELECT term, count(*) AS n FROM toks GROUP BY 1 HAVING count(*) > 3 AND length(term) > 1),
voc AS (SELECT term, row_number() OVER (ORDER BY n DESC, term) - 1 AS idx, n FROM tc),
long AS (SELECT doc_id, idx, CAST(count(*) AS DOUBLE) AS value FROM toks JOIN voc USING (term) GROUP BY 1, 2)"""


def _vocabulary(t):
    return materialize(build_vocabulary(frequent_terms(term_counts(t.tokens()))), "vocabulary")


def _long(t):
    vocabulary = _vocabulary(t)
    return vocabulary, materialize(count_vectors(t.tokens(), vocabulary), "counts")


def _six(df, column="value"):
    return df.withColumn(column, F.round(F.col(column), 6) + F.lit(0.0))


def _points(t):
    return dense_vectors(
        t.embeddings.select(F.col("vec_id").alias("member"), "embedding", F.col("label").alias("cluster")),
        "embedding",
    )


def _entries(df, column, id_col="member"):
    """Vector column as rounded rows."""
    return _six(
        df.select(id_col, F.posexplode(vector_to_array(column)).alias("idx", "value")).withColumn(
            "idx", F.col("idx").cast("bigint")
        )
    )


SQL_ENTRIES = """e AS (SELECT vec_id AS member, label, unnest(list_transform(embedding, lambda x: x::DOUBLE)) AS value,
  generate_subscripts(embedding, 1) - 1 AS idx FROM embeddings)"""


# Joins to a vocabulary and long-form vectors.


@query(
    "jn1_lookup_vocabulary",
    f"""WITH {SQL_VOCABULARY} SELECT idx, count(*) AS n, count(DISTINCT doc_id) AS docs
      FROM toks JOIN voc USING (term) GROUP BY 1""",
)
def _(t):
    return (
        lookup_vocabulary(t.tokens(), _vocabulary(t))
        .groupBy("idx")
        .agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))
    )


@query("fe1_count_vectors", f"WITH {SQL_VOCABULARY} SELECT doc_id, idx, value FROM long")
def _(t):
    return count_vectors(t.tokens(), _vocabulary(t))


@query("fe1_sparse_vectors", f"WITH {SQL_VOCABULARY} SELECT doc_id, count(*) AS nonzero, sum(value) AS total FROM long GROUP BY 1")
def _(t):
    vocabulary, long = _long(t)
    vectors = sparse_vectors(long, vocabulary.count())
    values = F.filter(stored_values("features"), lambda x: x != 0)
    return vectors.select(
        "doc_id",
        F.size(values).cast("bigint").alias("nonzero"),
        F.aggregate(values, F.lit(0.0), lambda s, x: s + x).alias("total"),
    )


@query("fe2_binary_vectors", f"WITH {SQL_VOCABULARY} SELECT doc_id, idx, CAST(1 AS DOUBLE) AS value FROM long")
def _(t):
    return binary_vectors(t.tokens(), _vocabulary(t))


@query(
    "fe3_one_hot",
    """WITH v AS (SELECT p_type AS term, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx FROM part GROUP BY 1)
      SELECT p_partkey, idx, CAST(1 AS DOUBLE) AS value FROM part JOIN v ON p_type = term""",
)
def _(t):
    rows = t.part.select("p_partkey", F.col("p_type").alias("term"))
    return one_hot(rows, materialize(build_vocabulary(term_counts(rows)), "vocabulary"), "p_partkey")


# Weighted terms: each frequent word of the labelled documents with its share of class 1.
SQL_WEIGHTED = f"""{SQL_LABELLED % ('quality', DOC_WORDS)},
ac AS (SELECT term, CAST(sum(label) AS BIGINT) AS pos, count(*) AS n FROM rec GROUP BY 1),
weighted AS (SELECT term, row_number() OVER (ORDER BY n DESC, term) - 1 AS idx, pos / n AS weight FROM ac WHERE n > 5)"""


def _weighted(t):
    records = t.labelled("quality")
    counts = records.select(F.explode(F.array_distinct("terms")).alias("term"), "label").groupBy("term").agg(
        F.sum("label").alias("pos"), F.count("*").alias("n")
    ).where(F.col("n") > 5)
    vocabulary = build_vocabulary(counts.select("term", "n"))
    shares = counts.select("term", (F.col("pos") / F.col("n")).alias("weight"))
    return materialize(vocabulary.join(shares, "term").select("term", "idx", "weight"), "weighted")


@query(
    "fe4_profile_vectors",
    rf"""WITH {SQL_WEIGHTED},
      p AS (SELECT d.doc_id, list_distinct([lang, source]) AS tags,
        {SQL_WORDS.format("string_split(translate(text, '<>', '  '), chr(10))[1]")} AS groups,
        {SQL_WORDS.format("text")} AS words FROM documents d JOIN labels USING (doc_id)),
      tk AS (SELECT doc_id, unnest(tags) AS term, 0 AS pr FROM p UNION ALL SELECT doc_id, unnest(groups), 0 FROM p
        UNION ALL SELECT doc_id, unnest(words), 1 FROM p),
      best AS (SELECT doc_id, term, max(pr) AS pr FROM tk GROUP BY 1, 2)
      SELECT doc_id, idx, round(CASE WHEN pr = 1 THEN weight ELSE 1 END, 6) AS value
      FROM best JOIN weighted USING (term) WHERE CASE WHEN pr = 1 THEN weight ELSE 1 END > 0""",
)
def _(t):
    fields = profile_fields(t.labelled_lines(), "<sex>m</sex>", "doc_id")
    return _six(profile_vectors(fields, _weighted(t), "doc_id"))


@query(
    "fe5_fit_count_vectorizer",
    f"""WITH {SQL_TOKENS} SELECT term, count(*) AS n, count(DISTINCT doc_id) AS df FROM toks GROUP BY 1
      HAVING count(DISTINCT doc_id) >= 5 ORDER BY n DESC, term LIMIT 10000""",
)
def _(t):
    return fit_count_vectorizer(t.tokens())


@query(
    "fe5_count_vectorizer_transform",
    f"""WITH {SQL_PROFILES}, v AS (SELECT tag, count(*) AS n, count(DISTINCT member) AS df FROM ptags GROUP BY 1
        HAVING count(DISTINCT member) >= 5)
      SELECT member, CAST(count(*) AS DOUBLE) AS total FROM ptags JOIN v USING (tag) GROUP BY 1""",
)
def _(t):
    features = profile_features(t.profile_lines())
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda s, x: s + x)
    return features.select("member", total.alias("total"))


@query("fe6_hashing_tf", f"SELECT doc_id, CAST(len({DOC_WORDS}) AS DOUBLE) AS total FROM documents")
def _(t):
    # Every word of a document falls into one bucket.
    terms = t.documents.select("doc_id", words(F.col("text")).alias("terms"))
    total = F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda n, x: n + x)
    return hashing_tf(terms).select("doc_id", total.alias("total"))


SQL_IDF = f"""{SQL_VOCABULARY},
m AS (SELECT count(*) AS m FROM documents),
w AS (SELECT idx, ln(((SELECT m FROM m) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) AS w FROM long GROUP BY 1),
tfidf AS (SELECT doc_id, idx, value * w AS value FROM long JOIN w USING (idx))"""


@query("fe7_idf", f"WITH {SQL_IDF} SELECT doc_id, idx, round(value, 6) AS value FROM tfidf")
def _(t):
    return _six(idf_long(_long(t)[1], t.documents.count()))


@query(
    "fe7_idf_stage",
    f"""WITH {SQL_ENTRIES}, w AS (SELECT idx, ln((count(*) + 1.0::DOUBLE) / (count_if(value > 0) + 1.0::DOUBLE)) AS w
        FROM e GROUP BY 1)
      SELECT member, idx, round(value * w, 6) + 0.0 AS value FROM e JOIN w USING (idx)""",
)
def _(t):
    return _entries(idf(_points(t), "features", "out"), "out")


@query(
    "fe8_standard_scale",
    f"""WITH {SQL_ENTRIES}, s AS (SELECT idx, stddev_samp(value) AS sd FROM e GROUP BY 1)
      SELECT member, idx, round(CASE WHEN sd > 0 THEN value / sd ELSE 0 END, 6) + 0.0 AS value FROM e JOIN s USING (idx)""",
)
def _(t):
    return _entries(standard_scale(_points(t)), "scaled")


@query(
    "fe8_standard_scale_long",
    f"""WITH {SQL_VOCABULARY}, m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM documents),
      s AS (SELECT idx, sqrt(greatest((sum(value * value) - sum(value) * sum(value) / (SELECT m FROM m))
        / ((SELECT m FROM m) - 1), 0)) AS sd FROM long GROUP BY 1)
      SELECT doc_id, idx, round(CASE WHEN sd > 0 THEN value / sd ELSE 0 END, 6) AS value FROM long JOIN s USING (idx)""",
)
def _(t):
    return _six(standard_scale_long(_long(t)[1], t.documents.count()))


@query(
    "fe9_normalize",
    f"""WITH {SQL_ENTRIES}, s AS (SELECT member, sum(abs(value)) AS s FROM e GROUP BY 1)
      SELECT member, idx, round(value / s, 6) + 0.0 AS value FROM e JOIN s USING (member)""",
)
def _(t):
    return _entries(normalize(_points(t), 1.0, "features", "normed"), "normed")


@query(
    "fe9_normalize_long",
    f"""WITH {SQL_IDF}, s AS (SELECT doc_id, sum(abs(value)) AS s FROM tfidf GROUP BY 1)
      SELECT doc_id, idx, round(CASE WHEN s > 0 THEN value / s ELSE 0 END, 6) AS value FROM tfidf JOIN s USING (doc_id)""",
)
def _(t):
    return _six(normalize_long(idf_long(_long(t)[1], t.documents.count())))


SQL_CHI = f"""{SQL_VOCABULARY},
lab AS (SELECT doc_id, quality AS label FROM labels),
cls AS (SELECT label, CAST(count(*) AS DOUBLE) AS c FROM lab GROUP BY 1),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM lab),
have AS (SELECT DISTINCT idx FROM long SEMI JOIN lab USING (doc_id)),
pres AS (SELECT h.idx, c.label, c.c, count(l.doc_id) AS o1 FROM have h CROSS JOIN cls c
  LEFT JOIN (SELECT long.doc_id, idx, label FROM long JOIN lab USING (doc_id)) l ON l.idx = h.idx AND l.label = c.label
  GROUP BY 1, 2, 3),
marg AS (SELECT idx, CAST(sum(o1) AS DOUBLE) AS r1 FROM pres GROUP BY 1),
chi AS (SELECT idx, sum((o1 - r1 * c / n) ** 2 / (r1 * c / n)
    + CASE WHEN n > r1 THEN ((c - o1) - (n - r1) * c / n) ** 2 / ((n - r1) * c / n) ELSE 0 END) AS chi2,
    CASE WHEN max(n) > max(r1) THEN 1 ELSE 0 END AS dof
  FROM pres JOIN marg USING (idx) CROSS JOIN tot GROUP BY 1)"""


def _binary(t):
    vocabulary = _vocabulary(t)
    return materialize(binary_vectors(t.tokens(), vocabulary), "binary")


@query("fe10_chi_square_scores", f"WITH {SQL_CHI} SELECT idx, round(chi2, 6) + 0.0 AS chi2, CAST(dof AS BIGINT) AS dof FROM chi")
def _(t):
    labels = t.labels.select("doc_id", F.col("quality").alias("label"))
    return _six(chi_square_scores(_binary(t), labels), "chi2").withColumn("dof", F.col("dof").cast("bigint"))


@query(
    "fe10_chi_square_select",
    f"""WITH {SQL_CHI}, pick AS (SELECT idx FROM chi ORDER BY round(chi2, 9) DESC, idx LIMIT 500)
      SELECT doc_id, count(*) AS n FROM long SEMI JOIN pick USING (idx) GROUP BY 1""",
)
def _(t):
    labels = t.labels.select("doc_id", F.col("quality").alias("label"))
    kept, _ = chi_square_select(_binary(t), labels, 500)
    return kept.groupBy("doc_id").agg(F.count("*").alias("n"))


@query(
    "fe11_min_max_scale",
    f"""WITH {SQL_ENTRIES}, s AS (SELECT idx, min(value) AS lo, max(value) AS hi FROM e GROUP BY 1)
      SELECT member, idx, round((value - lo) / (hi - lo), 6) + 0.0 AS value FROM e JOIN s USING (idx)""",
)
def _(t):
    return _entries(min_max_scale(_points(t)), "scaled")


@query(
    "fe12_pca",
    f"WITH {SQL_ENTRIES} SELECT member, round(sum(value * value), 4) AS square FROM e GROUP BY 1",
)
def _(t):
    # All components together are a rotation, so lengths stay.
    turned = pca(_points(t), 64)
    square = F.aggregate(vector_to_array("pca"), F.lit(0.0), lambda n, x: n + x * x)
    return turned.select("member", F.round(square, 4).alias("square"))


@query(
    "fe13_dct",
    f"""WITH {SQL_ENTRIES}, ks AS (SELECT unnest(range(64)) AS k)
      SELECT member, k AS idx, round(sum(value * cos(pi() / 64 * (idx + 0.5) * k))
        * CASE WHEN k = 0 THEN sqrt(1.0 / 64) ELSE sqrt(2.0 / 64) END, 6) + 0.0 AS value
      FROM e CROSS JOIN ks GROUP BY 1, 2""",
)
def _(t):
    return _entries(dct(_points(t)), "dct")


# Topics. The embeddings stand in for topic weights where a report needs given ones.

SQL_TOP = f"""{SQL_ENTRIES},
top AS (SELECT member, idx AS topic, value, row_number() OVER (PARTITION BY member ORDER BY value DESC, idx) AS rank FROM e
  QUALIFY rank <= 10)"""


def _weights(t):
    return t.embeddings.select(F.col("vec_id").alias("member"), F.col("embedding").alias("weights"))


def _top(t):
    return top_topics_per_document(_weights(t), id_col="member")


@query("top4_top_topics_per_document", f"WITH {SQL_TOP} SELECT member, topic, rank, round(value, 6) + 0.0 AS weight FROM top")
def _(t):
    return _six(_top(t), "weight").withColumn("rank", F.col("rank").cast("bigint")).withColumn(
        "topic", F.col("topic").cast("bigint")
    )


@query("ag10_topic_popularity", f"WITH {SQL_TOP} SELECT topic, count(*) AS n_docs FROM top GROUP BY 1")
def _(t):
    return topic_popularity(_top(t)).withColumn("topic", F.col("topic").cast("bigint"))


@query(
    "top1_hot_topics",
    f"""WITH {SQL_TOP} SELECT topic, count(*) AS n_docs FROM top GROUP BY 1 ORDER BY n_docs DESC, topic LIMIT 6""",
)
def _(t):
    return hot_topics(topic_popularity(_top(t))).withColumn("topic", F.col("topic").cast("bigint"))


def _topic_tables(t):
    """Weights of terms and of documents of a model trained on all documents, and its vocabulary."""
    vocabulary = _vocabulary(t)
    vectors = sparse_vectors(count_vectors(t.tokens(), vocabulary), vocabulary.count())
    return (*M.lda_tables(M.fit_lda(vectors)), vocabulary)


@query(
    "ml1_lda_topic_report",
    f"""WITH {SQL_VOCABULARY} SELECT CAST(50 AS BIGINT) AS topics, (SELECT count(*) FROM voc) AS n_terms,
      count(DISTINCT doc_id) AS n_docs, 10 * count(DISTINCT doc_id) AS places,
      round(sum(value), 2) AS tokens FROM long""",
)
def _(t):
    # Every token of the documents has one topic, so the weights of the terms add up to the tokens.
    terms, documents, _ = _topic_tables(t)
    popularity = topic_popularity(top_topics_per_document(documents.withColumn("doc_id", F.monotonically_increasing_id())))
    sizes = terms.agg(
        F.max(F.size("weights")).cast("bigint").alias("topics"), F.count("*").alias("n_terms"),
        F.round(F.sum(F.aggregate("weights", F.lit(0.0), lambda n, x: n + x)), 2).alias("tokens"),
    )
    return sizes.select(
        "topics", "n_terms", "tokens", F.lit(documents.count()).alias("n_docs"),
        F.lit(popularity.agg(F.sum("n_docs")).first()[0]).alias("places"),
    )


@query(
    "top2_topic_terms",
    f"""WITH {SQL_VOCABULARY} SELECT unnest(range(50)) AS topic, CAST(least(100, (SELECT count(*) FROM voc)) AS BIGINT) AS n_terms,
      CAST(0 AS BIGINT) AS gaps, CAST(0 AS BIGINT) AS rising""",
)
def _(t):
    # Ranks go from 1 without gaps and weights do not rise.
    terms, _, vocabulary = _topic_tables(t)
    found = topic_terms(terms, vocabulary)
    before = F.lag("weight").over(Window.partitionBy("topic").orderBy("rank"))
    return found.withColumn("before", before).groupBy(F.col("topic").cast("bigint").alias("topic")).agg(
        F.count_distinct("term").alias("n_terms"),
        (F.max("rank") - F.count_distinct("rank")).cast("bigint").alias("gaps"),
        F.count_if(F.col("weight") > F.col("before")).alias("rising"),
    )


@query(
    "plan_topic_report",
    f"""WITH {SQL_VOCABULARY} SELECT CAST(6 AS BIGINT) AS n_topics,
      6 * CAST(least(100, (SELECT count(*) FROM voc)) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS gaps""",
)
def _(t):
    report = topic_report(t.documents.select("doc_id", "text"))
    return report.agg(
        F.count_distinct("topic").alias("n_topics"), F.count("*").alias("n_rows"),
        (F.max("rank") - F.count_distinct("rank")).cast("bigint").alias("gaps"),
    )


# Naive Bayes: the language is the class.

def _language(t):
    """Languages as classes, numbered in their order."""
    named = t.documents.where("lang is not null")
    codes = dense_index(named.select("lang").distinct(), [F.asc("lang")], "code")
    return lookup_join(named.select("doc_id", "lang"), codes, ["lang"], ["doc_id"]).select(
        "doc_id", F.col("code").cast("double").alias("label")
    )


SQL_BAYES = f"""{SQL_VOCABULARY},
codes AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS c FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
lab AS (SELECT doc_id, CAST(c AS DOUBLE) AS label FROM documents JOIN codes USING (lang)),
v AS (SELECT CAST(count(*) AS DOUBLE) AS v FROM voc),
ct AS (SELECT label, idx, CAST(count(*) AS DOUBLE) AS n FROM long JOIN lab USING (doc_id) GROUP BY 1, 2),
tt AS (SELECT label, sum(n) AS total FROM ct GROUP BY 1),
prior AS (SELECT label, ln(count(*) + 1.0::DOUBLE) - ln((SELECT count(*) FROM lab) + (SELECT count(*) FROM codes) + 0.0::DOUBLE) AS lp
  FROM lab GROUP BY 1)"""


@query(
    "ml2_naive_bayes_terms",
    f"""WITH {SQL_BAYES} SELECT label, idx, round(ln(n + 1) - ln(total + (SELECT v FROM v)), 6) AS log_prob
      FROM ct JOIN tt USING (label)""",
)
def _(t):
    vocabulary = _vocabulary(t)
    long = binary_vectors(t.tokens(), vocabulary)
    return _six(M.naive_bayes_terms(long, _language(t), vocabulary.count()), "log_prob")


SQL_SCORES = f"""{SQL_BAYES},
sc AS (SELECT documents.doc_id, tt.label, sum(value * (coalesce(ln(n + 1), 0) - ln(total + (SELECT v FROM v)))) AS s
  FROM documents CROSS JOIN tt LEFT JOIN long ON long.doc_id = documents.doc_id
  LEFT JOIN ct ON ct.idx = long.idx AND ct.label = tt.label GROUP BY 1, 2),
joint AS (SELECT doc_id, label, coalesce(s, 0) + lp AS s FROM sc JOIN prior USING (label)),
mx AS (SELECT doc_id, max(s) AS m FROM joint GROUP BY 1),
ex AS (SELECT doc_id, label, s, exp(s - m) AS x FROM joint JOIN mx USING (doc_id))"""


def _scored(t):
    labels = _language(t)
    tokens = t.tokens().select("doc_id", "term")
    model, vocabulary = fit_category_model(tokens, labels, _vocabulary(t))
    return model, vocabulary, tokens, t.documents.select("doc_id")


@query(
    "ml3_class_probabilities",
    f"""WITH {SQL_SCORES} SELECT doc_id, CAST(label AS INT) AS cls,
      round(x / sum(x) OVER (PARTITION BY doc_id), 6) AS p FROM ex""",
)
def _(t):
    return _six(score_texts(*_scored(t)), "p")


@query(
    "ml4_predict_class",
    f"WITH {SQL_SCORES} SELECT doc_id, CAST(max_by(label, s) AS INT) AS predicted FROM joint GROUP BY 1",
)
def _(t):
    best = predict_tokens(*_scored(t))
    return best.select("doc_id", F.col("label").cast("int").alias("predicted"))


@query(
    "plan_category_scores",
    f"""WITH codes AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS cls FROM (SELECT DISTINCT source FROM documents)),
      tags AS (SELECT DISTINCT source, unnest({DOC_WORDS}) AS term FROM documents),
      ct AS (SELECT cls, term FROM tags JOIN codes USING (source)),
      tt AS (SELECT cls, count(*) AS total FROM ct GROUP BY 1), v AS (SELECT CAST(count(DISTINCT term) AS DOUBLE) AS v FROM ct),
      wd AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({DOC_WORDS}) AS term FROM documents)
        SEMI JOIN ct USING (term) GROUP BY 1, 2),
      size AS (SELECT doc_id, sum(n) AS size FROM wd GROUP BY 1),
      seen AS (SELECT doc_id, cls, sum(n) AS m FROM wd JOIN ct USING (term) GROUP BY 1, 2),
      sc AS (SELECT d.doc_id, tt.cls, coalesce(m, 0) * ln(2.0::DOUBLE) - coalesce(size, 0) * ln(total + (SELECT v FROM v)) AS s
        FROM documents d CROSS JOIN tt LEFT JOIN size USING (doc_id) LEFT JOIN seen ON seen.doc_id = d.doc_id AND seen.cls = tt.cls)
      SELECT doc_id, count(*) AS classes, round(sum(s), 4) AS total FROM sc GROUP BY 1""",
)
def _(t):
    # The words of all texts of a source are its line of category words, without repeats.
    tagged = t.documents.select("source", F.explode(F.array_distinct(words(F.col("text")))).alias("term")).distinct()
    codes = dense_index(tagged.select("source").distinct(), [F.asc("source")], "label")
    lines = materialize(lookup_join(tagged, codes, ["source"], ["term"]).select("label", "term"), "lines")
    model, vocabulary = fit_category_lines(lines)
    tokens = t.tokens().select("doc_id", "term")
    scores = score_tokens(model, vocabulary, tokens, t.documents.select("doc_id"))
    # Every class is one line, so the priors are equal and only shift the scores.
    prior = model.classes.first()["log_prior"]
    total = F.aggregate("scores", F.lit(0.0), lambda n, c: n + c["score"] - prior)
    return scores.select("doc_id", F.size("scores").cast("bigint").alias("classes"), F.round(total, 4).alias("total"))


# Linear classifier.


@query(
    "ml5_linear_svm_scores",
    """SELECT CAST(0 AS BIGINT) AS outside_split, CAST(0 AS BIGINT) AS other_scores, CAST(0 AS BIGINT) AS wrong_labels""",
)
def _(t):
    # Scores from the weight table are those of the model, of test rows only, beside the labels of the lines.
    lines = materialize(t.labelled_lines(), "lines")
    model, scored = classifier_report(lines, "<sex>m</sex>", "doc_id", store=model_store(lines, "svm", "doc_id"))
    own = M.margin_scores(model, scored, "doc_id").select("doc_id", F.col("score").alias("own"))
    labels = t.labels.select("doc_id", F.col("quality").cast("double").alias("quality"))
    return scored.join(own, "doc_id").join(labels, "doc_id").agg(
        F.count_if(M.split_bucket(M.SPLIT_SEED, "doc_id") < 60).alias("outside_split"),
        F.count_if(F.abs(F.col("own") - F.col("score")) > 1e-6 * (1 + F.abs("score"))).alias("other_scores"),
        F.count_if(F.col("label") != F.col("quality")).alias("wrong_labels"),
    )


@query("ml6_margin_accuracy", "SELECT CAST(1 AS INT) AS consistent")
def _(t):
    # The accuracy is the mean of those of the classes, weighted by their rows.
    lines = materialize(t.labelled_lines(), "lines")
    _, scored = classifier_report(lines, "<sex>m</sex>", "doc_id", store=model_store(lines, "svm", "doc_id"))
    scored = materialize(scored.select("score", "label"), "scores")
    share = scored.agg(F.avg(F.when(F.col("label") == 1, 1.0).otherwise(0.0)).alias("pos"))
    mixed = F.coalesce("accuracy_pos", F.lit(0.0)) * F.col("pos") + F.coalesce("accuracy_neg", F.lit(0.0)) * (1 - F.col("pos"))
    report = accuracy_report(scored).crossJoin(F.broadcast(share))
    return report.select((F.abs(F.col("accuracy") - mixed) < 1e-9).cast("int").alias("consistent"))


@query(
    "ml7_split",
    """SELECT doc_id, CAST(CASE WHEN CAST(('0x' || substr(md5('12345:' || doc_id), 1, 8)) AS BIGINT) % 100 < 60
      THEN 1 ELSE 0 END AS INT) AS train FROM documents""",
)
def _(t):
    train, test = M.split(t.documents.select("doc_id"))
    return train.withColumn("train", F.lit(1)).unionByName(test.withColumn("train", F.lit(0)))


@query(
    "ag16_accuracy_report",
    """SELECT round(avg(CASE WHEN (e > 0) = (y = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
      round(avg(CASE WHEN y = 1 THEN CASE WHEN e > 0 THEN 1.0 ELSE 0.0 END END), 6) AS accuracy_pos,
      round(avg(CASE WHEN y = 0 THEN CASE WHEN e > 0 THEN 0.0 ELSE 1.0 END END), 6) AS accuracy_neg
      FROM (SELECT embedding[1] AS e, label % 2 AS y FROM embeddings)""",
)
def _(t):
    scored = t.embeddings.select(F.col("embedding")[0].alias("score"), (F.col("label") % 2).alias("label"))
    report = accuracy_report(scored)
    return report.select(*[F.round(c, 6).alias(c) for c in report.columns])


# Clusters.


def _assign(t):
    return t.embeddings.select(F.col("vec_id").alias("member"), F.col("label").alias("cluster"))


def _sources(t):
    """A given clustering of the documents: their source."""
    return t.documents.select(F.col("doc_id").alias("member"), F.col("source").alias("cluster"))


def _nearest(model, points, assign, column):
    """Per member: whether its centre is the nearest of the model's centres."""
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    far = F.transform(centres, lambda c: squared_distance(vector_to_array(column), c))
    joined = points.join(assign, "member").withColumn("far", far)
    near = F.try_element_at("far", F.col("cluster") + 1) <= F.array_min("far") + 1e-9
    return joined.select("member", near.cast("int").alias("nearest"))


@query("ml8_kmeans", "SELECT c_custkey AS member, CAST(1 AS INT) AS nearest FROM customer")
def _(t):
    features = profile_features(t.profile_lines())
    model, assign = cluster_profiles(features, M.PROFILE_K)
    return _nearest(model, features, assign, "scaled")


@query("ml9_bisecting_kmeans", "SELECT c_custkey AS member, CAST(1 AS INT) AS in_range, CAST(1 AS INT) AS cost_falls FROM customer")
def _(t):
    # Leaves are reached by splits, so a member's leaf need not be the nearest one.
    features = profile_features(t.profile_lines())
    model, assign = cluster_profiles(features, M.PROFILE_K, bisecting=True)
    two, _ = cluster_profiles(features, 2, bisecting=True)
    falls = int(model.summary.trainingCost <= two.summary.trainingCost)
    return assign.select(
        "member", F.col("cluster").between(0, M.PROFILE_K - 1).cast("int").alias("in_range"), F.lit(falls).alias("cost_falls")
    )


@query("ml10_assign_clusters", "SELECT vec_id AS member, CAST(1 AS INT) AS nearest FROM embeddings")
def _(t):
    points = materialize(_points(t).select("member", "features"), "points")
    model = M.fit_kmeans(points, 10, features_col="features")
    return _nearest(model, points, M.assign_clusters(model, points), "features")


@query("plan_profile_report", """SELECT unnest(['bisecting', 'kmeans']) AS model, (SELECT count(*) FROM customer) AS n,
  CAST(1 AS INT) AS same_cost""")
def _(t):
    # Sizes add up to all members, and the cost is that of the training.
    return profile_report(profile_features(t.profile_lines())).groupBy("model").agg(
        F.sum("n").alias("n"), F.max((F.abs(F.col("cost") - F.col("trained")) < 1e-6 * F.col("trained")).cast("int")).alias("same_cost")
    )


@query(
    "ml11_gaussian_mixture",
    "SELECT doc_id AS member, CAST(2 AS INT) AS components, 1.0::DOUBLE AS total FROM documents",
)
def _(t):
    features = mixture_features(t.documents.select(F.col("doc_id").alias("member"), "text"))
    model = M.fit_gmm(features)
    total = F.aggregate("p", F.lit(0.0), lambda n, x: n + x)
    return M.soft_membership(model, features).select("member", F.size("p").alias("components"), F.round(total, 6).alias("total"))


@query(
    "ml12_mixture_tags",
    r"""WITH w AS (SELECT unnest(string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s')) AS term FROM documents)
      SELECT term, count(*) AS n, CAST(0 AS BIGINT) AS wrong_top FROM w GROUP BY 1""",
)
def _(t):
    # Counts of the clusters add up to those of all texts, and the tags reported are counted right.
    counted = materialize(mixture_words(t.documents.select(F.col("doc_id").alias("member"), "text")), "counted")
    best = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("n"), F.asc("term")))
    want = counted.withColumn("place", best).where("place <= 3").select("cluster", "term", F.col("n").alias("m"))
    wrong = top_tags(counted).join(want, ["cluster", "term"], "left").groupBy("term").agg(
        F.count_if(~F.col("n").eqNullSafe(F.col("m"))).alias("wrong_top")
    )
    return counted.groupBy("term").agg(F.sum("n").alias("n")).join(wrong, "term", "left").na.fill(0, ["wrong_top"])


@query(
    "ml13_cluster_terms",
    f"""WITH {SQL_POSTINGS}, size AS (SELECT group_id, doc_id, count(*) AS n FROM post GROUP BY 1, 2),
      whole AS (SELECT term, CAST(sum(n) AS BIGINT) AS row_sum FROM post JOIN size USING (group_id, doc_id) GROUP BY 1)
      SELECT term, row_sum, CAST(1 AS INT) AS in_range, CAST(1 AS INT) AS settled FROM whole""",
)
def _(t):
    # The first value of the scaled matrix is known to be 1, and the residuals of all components are measured.
    index = materialize(build_index(t.comments()), "postings")
    components, values, residuals = leading_components(index)
    settled = abs(values[0] - 1) < 1e-3 and max(residuals) < 0.05
    numbered, lists = document_lists(index, F.collect_list)
    rows = lookup_join(numbered, row_sums(lists), ["v"], []).select("term", F.col("n").alias("row_sum"))
    clusters = cluster_terms(index, components=components).select("term", F.col("cluster").between(0, 4).cast("int").alias("in_range"))
    return rows.join(clusters, "term").withColumn("settled", F.lit(int(settled)))


@query("ml14_compare_labelings", "SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2")
def _(t):
    return compare_labelings(t.documents, "lang", "source")


@query("ag11_cluster_sizes", "SELECT label AS cluster, count(*) AS n FROM embeddings GROUP BY 1")
def _(t):
    return cluster_sizes(_assign(t))


@query("so2_order_by_key", "SELECT label AS cluster, count(*) AS n FROM embeddings GROUP BY 1 ORDER BY 1")
def _(t):
    return order_by_key(cluster_sizes(_assign(t)))


SQL_SEGMENTS = f"""{SQL_PROFILES}, asg AS (SELECT c_custkey AS member, c_nationkey % 5 AS cluster FROM customer)"""


def _segments(t):
    return t.customer.select(F.col("c_custkey").alias("member"), (F.col("c_nationkey") % 5).alias("cluster"))


def _tagged(t):
    return t.profile_lines().select("member", profile_tag_array(F.col("raw")).alias("tags"))


@query(
    "jn4_members_with_rows",
    f"""WITH {SQL_SEGMENTS} SELECT member, cluster, len(tags) AS n_tags FROM asg JOIN taglist USING (member)""",
)
def _(t):
    return members_with_rows(_segments(t), _tagged(t)).select(
        "member", "cluster", F.size("tags").cast("bigint").alias("n_tags")
    )


@query(
    "jn5_predictions_with_text",
    "SELECT doc_id, source AS cluster, length(text) AS chars FROM documents",
)
def _(t):
    predicted = t.documents.select("doc_id", F.col("source").alias("prediction"), "text")
    kept = predictions_with_text(predicted, "prediction")
    return kept.select("doc_id", "cluster", F.length("text").cast("bigint").alias("chars"))


@query(
    "ag12_cluster_tag_counts",
    f"WITH {SQL_SEGMENTS} SELECT cluster, tag, count(*) AS n FROM asg JOIN ptags USING (member) GROUP BY 1, 2",
)
def _(t):
    return cluster_tag_counts(_segments(t), _tagged(t))


SQL_SOURCE_WORDS = f"""sw AS (SELECT source AS cluster, term, count(*) AS n
  FROM (SELECT source, unnest({DOC_WORDS}) AS term FROM documents) GROUP BY 1, 2)"""


def _source_words(t):
    return cluster_words(t.documents.select(F.col("source").alias("cluster"), words(F.col("text")).alias("terms")))


@query("ag13_cluster_words", f"WITH {SQL_SOURCE_WORDS} SELECT cluster, term, n FROM sw")
def _(t):
    return _source_words(t)


@query(
    "top3_top_tags",
    f"""WITH {SQL_SOURCE_WORDS} SELECT cluster, term, n,
      row_number() OVER (PARTITION BY cluster ORDER BY n DESC, term) AS rank FROM sw QUALIFY rank <= 3""",
)
def _(t):
    return top_tags(_source_words(t)).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "ag14_cluster_members",
    """SELECT label AS cluster, vec_id AS member,
      row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM embeddings""",
)
def _(t):
    return cluster_members(_assign(t))


@query(
    "ag15_labels_across_k",
    """SELECT vec_id AS member, concat_ws(' ', label % 8, label % 9, label % 10) AS labels FROM embeddings""",
)
def _(t):
    labelled = t.embeddings.select(
        F.col("vec_id").alias("member"), F.explode(F.array(F.lit(10), F.lit(8), F.lit(9))).alias("k"), "label"
    )
    return labels_across_k(labelled.withColumn("cluster", F.col("label") % F.col("k")))


@query("ag15_label_sweep", "SELECT c_custkey AS member, CAST(3 AS INT) AS n_labels, CAST(1 AS INT) AS in_range FROM customer")
def _(t):
    labels = F.transform(F.split("labels", " "), lambda x: x.cast("int"))
    swept = label_sweep(profile_features(t.profile_lines())).withColumn("l", labels)
    inside = F.forall(F.zip_with("l", F.array(F.lit(8), F.lit(9), F.lit(10)), lambda x, k: (x >= 0) & (x < k)), lambda x: x)
    return swept.select("member", F.size("l").alias("n_labels"), inside.cast("int").alias("in_range"))


@query(
    "ag17_clustering_cost",
    f"""WITH {SQL_ENTRIES}, c AS (SELECT label, idx, avg(value) AS c FROM e GROUP BY 1, 2)
      SELECT round(sum((value - c) ** 2), 4) AS cost, count(DISTINCT member) AS n FROM e JOIN c USING (label, idx)""",
)
def _(t):
    points = _points(t)
    cost = clustering_cost(points.withColumnRenamed("embedding", "values"), cluster_centres(points))
    return cost.select(F.round("cost", 4).alias("cost"), "n")


@query("src14_save_and_load_model", "SELECT vec_id AS member, CAST(1 AS INT) AS same, CAST(1 AS INT) AS nearest FROM embeddings")
def _(t):
    points = materialize(_points(t).select("member", "features"), "points")
    path = scratch_path(t.spark, "model")
    fitted = M.fit_kmeans(points, 10, features_col="features")
    M.save_model(fitted, path)
    loaded = M.load_model(KMeansModel, path)
    before = M.assign_clusters(fitted, points).withColumnRenamed("cluster", "before")
    after = M.assign_clusters(loaded, points)
    near = _nearest(loaded, points, after, "features")
    return before.join(after, "member").join(near, "member").select(
        "member", (F.col("before") == F.col("cluster")).cast("int").alias("same"), "nearest"
    )
