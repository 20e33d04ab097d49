import math

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiweave.operators import models as M
from lexiweave.operators.clusters import (
    accuracy_report,
    assign_soft,
    cluster_centres,
    cluster_members,
    cluster_sizes,
    cluster_tag_counts,
    cluster_words,
    clustering_cost,
    labels_across_k,
    top_tags,
)
from lexiweave.operators.topics import hot_topics, top_topics_per_document, topic_popularity
from lexiweave.operators.vectors import (
    binary_vectors,
    chi_square_scores,
    chi_square_select,
    count_vectorizer_model,
    count_vectors,
    drop_thin_rows,
    fit_count_vectorizer,
    idf_long,
    normalize_long,
    one_hot,
    profile_vectors,
    sparse_vectors,
    standard_scale,
    standard_scale_long,
    stored_values,
)
from lexiweave.plans.affinity_classifier import classifier_report
from lexiweave.plans.category_scores import fit_category_lines, fit_category_model, predict_tokens, score_texts, score_tokens
from lexiweave.plans.profile_clusters import cluster_profiles, label_sweep, mixture_tags, profile_features
from lexiweave.plans.term_clusters import cluster_terms, leading_components
from lexiweave.plans.topics import topic_report

LONG = "doc_id bigint, idx bigint, value double"


@pytest.fixture
def tokens(spark):
    return spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "zz"), (3, "b")], "doc_id bigint, term string")


@pytest.fixture
def vocabulary(spark):
    return spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "term string, idx bigint")


def test_count_binary_and_one_hot(tokens, vocabulary, monkeypatch):
    assert rows(count_vectors(tokens, vocabulary), "doc_id", "idx", "value") == [(1, 0, 2.0), (1, 1, 1.0), (3, 1, 1.0)]
    assert rows(binary_vectors(tokens, vocabulary), "doc_id", "idx", "value") == [(1, 0, 1.0), (1, 1, 1.0), (3, 1, 1.0)]
    assert rows(one_hot(tokens.where("doc_id = 3"), vocabulary)) == [(3, 1, 1.0)]
    monkeypatch.setattr("lexiweave.operators.vectors.fits_broadcast", lambda df: False)
    assert rows(count_vectors(tokens, vocabulary), "doc_id", "idx", "value") == [(1, 0, 2.0), (1, 1, 1.0), (3, 1, 1.0)]


def test_sparse_vectors_are_ml_vectors(spark):
    long = spark.createDataFrame([(1, 4, 2.0), (1, 0, 1.0), (2, 3, 5.0)], LONG)
    got = {r.doc_id: r.features for r in sparse_vectors(long, 6).collect()}
    assert got == {1: Vectors.sparse(6, {0: 1.0, 4: 2.0}), 2: Vectors.sparse(6, {3: 5.0})}


def test_profile_vectors_words_win_and_zero_weights_go(spark):
    profiles = spark.createDataFrame(
        [(1, ["t", "both"], ["g"], ["both", "w", "zero", "w"]), (2, None, None, ["unknown"])],
        "member bigint, tags array<string>, groups array<string>, words array<string>",
    )
    weighted = spark.createDataFrame(
        [("t", 0, 0.9), ("both", 1, 0.7), ("g", 2, 0.8), ("w", 3, 0.6), ("zero", 4, 0.0)],
        "term string, idx bigint, weight double",
    )
    assert rows(profile_vectors(profiles, weighted), "member", "idx", "value") == [
        (1, 0, 1.0), (1, 1, 0.7), (1, 2, 1.0), (1, 3, 0.6),
    ]


def test_drop_thin_rows_counts_rendered_characters(spark):
    # "1 " and pairs such as "10:0.5 ": 2 + 5 * 7 = 37 and 2 + 6 * 7 = 44 characters.
    long = spark.createDataFrame([(1, 9 + i, 0.5) for i in range(5)] + [(2, 9 + i, 0.5) for i in range(6)], LONG)
    assert rows(drop_thin_rows(long, "doc_id").select("doc_id").distinct()) == [(2,)]


def test_count_vectorizer_orders_by_count_then_name(spark):
    tokens = spark.createDataFrame(
        [(d, t) for d in range(5) for t in ("b", "a", "c", "c")] + [(0, "rare")] * 50, "doc_id bigint, term string"
    )
    chosen = fit_count_vectorizer(tokens, 2)
    assert [tuple(r) for r in chosen.collect()] == [("c", 10, 5), ("a", 5, 5)]
    model = count_vectorizer_model(chosen)
    df = spark.createDataFrame([(["c", "a", "c", "x"],)], "terms array<string>")
    assert model.transform(df).first()["features"] == Vectors.sparse(2, {0: 2.0, 1: 1.0})


def test_idf_and_norm(spark):
    long = spark.createDataFrame([(1, 0, 2.0), (2, 0, 1.0), (1, 1, 3.0)], LONG)
    weighted = idf_long(long, 3)
    got = {(r.doc_id, r.idx): r.value for r in weighted.collect()}
    assert got[(1, 0)] == pytest.approx(2 * math.log(4 / 3)) and got[(1, 1)] == pytest.approx(3 * math.log(4 / 2))
    total = normalize_long(weighted).groupBy("doc_id").agg(F.sum("value").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in total)


def test_scaling_twin_equals_the_stage(spark):
    data = [(1, [1.0, 0.0, 5.0]), (2, [1.0, 2.0, 0.0]), (3, [1.0, 4.0, 1.0]), (4, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in data], ["doc_id", "features"])
    stage = {r.doc_id: list(r.scaled) for r in standard_scale(df).select("doc_id", "scaled").collect()}
    long = spark.createDataFrame([(i, j, x) for i, v in data for j, x in enumerate(v) if x], LONG)
    for r in standard_scale_long(long, 4).collect():
        assert r.value == pytest.approx(stage[r.doc_id][r.idx])


def test_chi_square_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 3, size=(60, 5)).astype(float)
    labels = rng.integers(0, 3, size=60)
    values[:, 4] = 1.0
    long = spark.createDataFrame(
        [(i, j, float(values[i, j])) for i in range(60) for j in range(5) if values[i, j]], LONG
    )
    label_df = spark.createDataFrame([(i, int(c)) for i, c in enumerate(labels)], "doc_id bigint, label int")
    got = {r.idx: (r.chi2, r.dof) for r in chi_square_scores(long, label_df).collect()}
    for j in range(5):
        kinds = np.unique(values[:, j])
        table = np.array([[np.sum((values[:, j] == k) & (labels == c)) for c in range(3)] for k in kinds])
        expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / 60
        assert got[j][0] == pytest.approx(float(((table - expected) ** 2 / expected).sum()), abs=1e-9)
        assert got[j][1] == (len(kinds) - 1) * 2
    kept, chosen = chi_square_select(long, label_df, 2)
    assert chosen.count() == 2 and {r.idx for r in kept.select("idx").distinct().collect()} == {0, 1}


def test_soft_assignment(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.49, 0.26, 0.25]), (3, [0.1, 0.9])], "member bigint, p array<double>")
    assert rows(assign_soft(df), "member", "cluster") == [(1, 0), (2, -1), (3, 1)]


def test_cluster_reports(spark):
    assign = spark.createDataFrame([(3, 0), (1, 0), (2, 1)], "member bigint, cluster int")
    assert rows(cluster_sizes(assign)) == [(0, 2), (1, 1)]
    assert rows(cluster_members(assign)) == [(0, 0, 1), (0, 1, 3), (1, 0, 2)]
    tags = spark.createDataFrame([(1, ["x", "y"]), (2, ["x"]), (3, ["x", "z"])], "member bigint, tags array<string>")
    assert rows(cluster_tag_counts(assign, tags)) == [(0, "x", 2), (0, "y", 1), (0, "z", 1), (1, "x", 1)]
    counts = cluster_words(assign.join(tags.withColumnRenamed("tags", "terms"), "member"))
    assert rows(top_tags(counts, 2), "cluster", "rank", "term") == [(0, 1, "x"), (0, 2, "y"), (1, 1, "x")]


def test_labels_across_k(spark):
    df = spark.createDataFrame([(1, 10, 5), (1, 8, 3), (1, 9, 4), (2, 8, 0), (1, 11, 7)], "member bigint, k int, cluster int")
    assert rows(labels_across_k(df)) == [(1, "3 4 5"), (2, "0")]


def test_accuracy_report(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (-1.0, 1.0), (2.0, 0.0)], "score double, label double")
    assert rows(accuracy_report(df)) == [(0.5, 0.5, 0.5)]
    assert accuracy_report(df.where("label = 1")).first()["accuracy_neg"] is None


def test_cost_of_given_centres(spark):
    points = spark.createDataFrame(
        [(1, 0, [0.0, 0.0]), (2, 0, [2.0, 0.0]), (3, 1, [5.0, 5.0])], "member bigint, cluster int, values array<double>"
    )
    from pyspark.ml.functions import array_to_vector

    centres = cluster_centres(points.withColumn("features", array_to_vector("values")))
    assert rows(clustering_cost(points, centres)) == [(2.0, 3)]


def test_topic_reports_use_at_most_what_exists(spark):
    df = spark.createDataFrame([(1, [0.2, 0.5, 0.3]), (2, [0.4, 0.4, 0.2])], "doc_id bigint, weights array<double>")
    top = top_topics_per_document(df, 2)
    assert rows(top, "doc_id", "rank", "topic") == [(1, 1, 1), (1, 2, 2), (2, 1, 0), (2, 2, 1)]
    assert [tuple(r) for r in hot_topics(topic_popularity(top), 6).collect()] == [(1, 2), (0, 1), (2, 1)]


def test_split_depends_on_the_id_only(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    train, test = M.split(df)
    again, _ = M.split(df.repartition(7))
    assert rows(train) == rows(again) and train.count() + test.count() == 1000
    assert 540 < train.count() < 660


def test_category_lines_give_class_probabilities(spark):
    lines = spark.createDataFrame(
        [(0, 0, "cat"), (0, 1, "dog"), (1, 0, "car"), (1, 1, "bus"), (1, 2, "dog")], "label bigint, pos int, term string"
    )
    model, vocabulary = fit_category_lines(lines)
    asked = spark.createDataFrame(
        [(7, "cat"), (7, "nothing"), (8, "bus"), (8, "car"), (9, "nothing")], "doc_id bigint, term string"
    )
    ids = spark.createDataFrame([(7,), (8,), (9,), (10,)], "doc_id bigint")
    got = {(r.doc_id, r.cls): r.p for r in score_texts(model, vocabulary, asked, ids).collect()}
    # Texts without known words are scored by the priors.
    assert all(got[(i, c)] == pytest.approx(0.5) for i in (9, 10) for c in (0, 1))
    assert got[(7, 0)] + got[(7, 1)] == pytest.approx(1.0)
    # Priors 1/2 each; cat: (1+1)/(2+4) in class 0 and (0+1)/(3+4) in class 1.
    assert got[(7, 0)] == pytest.approx((2 / 6) / (2 / 6 + 1 / 7))
    assert got[(8, 1)] > got[(8, 0)]


def profile_lines(spark):
    def line(i):
        kind = i % 2
        return (i, f"<age>{20 + i % 3}</age><sex>{'mf'[kind]}</sex><group>g{kind},h{kind},x{i % 5}</group><collection>c{kind}</collection>")

    return spark.createDataFrame([line(i) for i in range(60)] + [(100, "<sex>m</sex>"), (101, "<sex>m</sex>")], "member bigint, raw string")


def test_profile_clusters_keep_every_member(spark):
    features = profile_features(profile_lines(spark))
    assert features.count() == 62
    model, assign = cluster_profiles(features, 2, bisecting=True)
    label = {r.member: r.cluster for r in assign.collect()}
    assert len(label) == 62 and label[100] == label[101]
    assert len({label[i] for i in range(0, 60, 2)}) == 1 and label[0] != label[1]
    kmeans, assign = cluster_profiles(features, 3)
    centres = np.array(kmeans.clusterCenters())
    points = features.select("member", vector_to_array("scaled").alias("v")).collect()
    label = {r.member: r.cluster for r in assign.collect()}
    for p in points:
        distance = ((centres - np.array(p.v)) ** 2).sum(1)
        assert distance[label[p.member]] <= distance.min() + 1e-9
    sweep = label_sweep(features, ks=(2, 3))
    assert sweep.count() == 62 and all(len(r.labels.split()) == 2 for r in sweep.collect())


def test_classifier_learns_a_separable_class(spark):
    def line(i):
        man = i % 2
        own = "red green blue" if man else "oak elm ash"
        return (i, f"<sex>{'m' if man else 'f'}</sex><tag>t{man},n{i % 3}</tag><group>{own}</group><words>{own} common w{i % 4}</words>")

    lines = spark.createDataFrame([line(i) for i in range(80)], "member bigint, raw string")
    _, scored = classifier_report(lines, "<sex>m</sex>", max_iter=20, min_chars=20)
    report = accuracy_report(scored).first()
    assert report.accuracy == 1.0 and scored.count() > 10


def test_topic_report_and_mixture(spark):
    docs = [(i, "ship sea wave salt sea ship" if i % 2 else "tree leaf root bark leaf tree") for i in range(24)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    report = topic_report(df, k=3, max_iter=3, n_topics=2, n_terms=4)
    assert report.count() == 8 and {r.topic for r in report.collect()} <= {0, 1, 2}
    tags = mixture_tags(df.withColumnRenamed("doc_id", "member"))
    assert sum(r.n for r in tags.where("rank = 1").collect()) > 0


@pytest.mark.parametrize("k", [1, 3])
def test_top_classes_equal_the_scores_of_all_classes(spark, k):
    import random

    rng = random.Random(k)
    tokens, labels = [], []
    for label in range(40):
        for _ in range(rng.choice([1, 1, 2])):
            line = len(labels)
            labels.append((line, label))
            tokens += [(line, f"t{rng.randrange(60)}") for _ in range(rng.randrange(0, 6))]
    tokens = spark.createDataFrame(sorted(set(tokens)), "doc_id bigint, term string")
    model, vocabulary = fit_category_model(tokens, spark.createDataFrame(labels, "doc_id bigint, label bigint"))
    asked = [(i, f"t{rng.randrange(70)}") for i in range(50) for _ in range(rng.randrange(0, 5))]
    texts = spark.createDataFrame(asked, "doc_id bigint, term string")
    ids = spark.createDataFrame([(i,) for i in range(50)], "doc_id bigint")
    got = {}
    for r in predict_tokens(model, vocabulary, texts, ids, k=k).collect():
        got.setdefault(r.doc_id, {})[r["rank"]] = (r.label, round(r.score, 9))
    for r in score_tokens(model, vocabulary, texts, ids).collect():
        scores = {c["label"]: round(c["score"], 9) for c in r.scores}
        mine = [got[r.doc_id][n + 1] for n in range(k)]
        assert [s for _, s in mine] == sorted(scores.values(), reverse=True)[:k]
        assert all(scores[label] == s for label, s in mine) and len({label for label, _ in mine}) == k


def test_many_classes_stay_a_table(spark):
    # One line per class: 20,000 classes, each text is best in the class that has its two terms.
    lines = spark.range(5_000).select(
        F.col("id").alias("label"), F.explode(F.array(F.concat(F.lit("a"), F.col("id")), F.concat(F.lit("b"), F.floor(F.col("id") / 2)))).alias("term")
    )
    model, vocabulary = fit_category_lines(lines)
    asked = [(i, t) for i in (7, 4_998) for t in (f"a{i}", f"b{i // 2}")] + [(3, "unknown")]
    texts = spark.createDataFrame(asked, "doc_id bigint, term string")
    best = predict_tokens(model, vocabulary, texts, texts.select("doc_id").distinct())
    assert len(best._jdf.queryExecution().logical().toString()) < 200_000
    assert {r.doc_id: r.label for r in best.collect()} == {7: 7, 4_998: 4_998, 3: 0}


def test_sparse_margins_equal_the_model_and_one_training_serves_all(spark):
    import uuid

    lines = [(i, f"<sex>{'m' if i % 2 else 'f'}</sex><words>{('up run far ' if i % 2 else 'down sit near ') * 6}w{i % 5}</words>") for i in range(60)]
    df = spark.createDataFrame(lines, "member bigint, raw string")
    store = f"{spark.conf.get('spark.checkpoint.dir')}/models/{uuid.uuid4().hex}"
    model, scored = classifier_report(df, "<sex>m</sex>", min_chars=1, max_iter=20, store=store)
    own = {r.member: r.score for r in M.margin_scores(model, scored, "member").collect()}
    first = {r.member: r.score for r in scored.collect()}
    assert first and all(first[i] == pytest.approx(own[i], abs=1e-9) for i in first)
    again, rescored = classifier_report(df, "<sex>m</sex>", min_chars=1, max_iter=20, store=store)
    assert again.uid == model.uid
    assert {r.member: r.score for r in rescored.collect()} == pytest.approx(first)


def test_topic_tables_agree_with_the_model(spark):
    texts = [(i, Vectors.dense([float((i * 7 + j * 3) % 5) for j in range(12)])) for i in range(30)]
    model = M.fit_lda(spark.createDataFrame(texts, ["doc_id", "features"]), k=3, max_iter=5, doc=2.0, topic=2.0)
    terms, documents = M.lda_tables(model)
    assert terms.count() == 12 and documents.count() == 30
    for wrong in (
        terms.withColumn("weights", F.transform("weights", lambda w: w + 1)),
        terms.withColumn("idx", 11 - F.col("idx")),
        terms.where("idx > 0").unionByName(terms.where("idx = 0").select((F.col("idx") + 50).alias("idx"), "weights")).where("idx <> 3"),
    ):
        with pytest.raises(RuntimeError):
            M.check_topic_terms(model, wrong)


def test_leading_components_equal_a_dense_decomposition(spark):
    import random

    rng = random.Random(12)
    groups = [[f"{g}{i}" for i in range(8)] for g in "abcd"]
    index = [("g", d, t) for d in range(150) for t in set(rng.sample(groups[d % 4], 5) + rng.sample([x for g in groups for x in g], 2))]
    names = sorted({t for _, _, t in index})
    b = np.zeros((150, len(names)))
    for _, d, t in index:
        b[d, names.index(t)] = 1
    m = b.T @ b
    scale = 1 / np.sqrt(m.sum(axis=1))
    a = scale[:, None] * m * scale[None, :]
    values, axes = np.linalg.eigh(a)
    df = spark.createDataFrame(index + index[:20], "group_id string, doc_id bigint, term string")
    found, got, residuals = leading_components(df, 4, spare=4, tolerance=1e-4)
    assert got == pytest.approx(values[::-1][:4], abs=1e-6) and got[0] == pytest.approx(1.0)
    rows_ = {r.term: [r.c0, r.c1, r.c2, r.c3] for r in found.collect()}
    q = np.array([rows_[t] for t in names])
    assert np.allclose(q.T @ q, np.eye(4), atol=1e-8)
    measured = np.linalg.norm(a @ q - q * got, axis=0)
    assert np.allclose(measured, residuals, atol=1e-6) and measured.max() <= 1e-4
    assert np.allclose(np.abs((q * (axes[:, ::-1][:, :4])).sum(axis=0)), 1.0, atol=1e-3)
    clusters = {r.term: r.cluster for r in cluster_terms(df, k=4, components=found).collect()}
    assert sorted(clusters) == names


def test_more_components_than_terms(spark):
    index = spark.createDataFrame([("g", 1, "a"), ("g", 1, "b"), ("g", 2, "b")], "group_id string, doc_id bigint, term string")
    found, values, residuals = leading_components(index, 10)
    assert found.count() == 2 and values[0] == pytest.approx(1.0) and max(residuals) < 1e-6


def test_values_of_long_sparse_vectors_are_not_filled_up(spark):
    # As a dense array a row of this size would not fit any task.
    long = spark.createDataFrame([(1, 5, 2.0), (1, 2**31 - 2, 3.0), (2, 0, 1.0)], "doc_id bigint, idx bigint, value double")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "doc_id bigint")
    found = sparse_vectors(long, 2**31 - 1, ids=ids).select("doc_id", stored_values("features").alias("v"))
    assert rows(found) == [(1, [2.0, 3.0]), (2, [1.0]), (3, [])]


def test_rows_of_a_record_are_shuffled_once(spark):
    long = spark.createDataFrame([(1, 0, 1.0), (1, 1, 3.0), (2, 0, 0.0), (None, 4, 1.0)], "doc_id bigint, idx bigint, value double")
    normed, thick = normalize_long(long), drop_thin_rows(long, "doc_id", min_chars=1, min_nonzero=2)
    assert rows(normed) == [(1, 0, 0.25), (1, 1, 0.75), (2, 0, 0.0)]
    assert rows(thick) == [(1, 0, 1.0), (1, 1, 3.0)]
    for df in (normed, thick):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_topic_model_equals_a_plain_loop_however_rows_are_dealt(spark):
    from lexiweave.operators import topic_model as T

    rng = np.random.default_rng(3)
    values = rng.integers(0, 3, (40, 15)).astype(float)
    values[7] = 0.0
    texts = [(i, Vectors.dense(v) if i % 2 else Vectors.sparse(15, {int(j): v[j] for j in np.flatnonzero(v)})) for i, v in enumerate(values)]
    df = spark.createDataFrame(texts, ["doc_id", "features"])
    doc, topic, k, seed = 2.5, 1.5, 4, 9
    share = np.zeros((40, 15, k))
    for d, v in enumerate(values):
        idx = np.flatnonzero(v)
        if len(idx):
            share[d, idx] = T._start(idx.astype("<i4"), v[idx], k, seed)
    for _ in range(6):
        by_doc, by_term, total = share.sum(axis=1), share.sum(axis=0), share.sum(axis=(0, 1))
        p = (by_term[None] + topic - 1) * (by_doc[:, None] + doc - 1) / (total + 15 * (topic - 1))
        share = values[:, :, None] * p / p.sum(axis=2, keepdims=True)
    for parts in (1, 9):
        terms, documents = M.lda_tables(M.fit_lda(df.repartition(parts), k, 6, doc, topic, seed))
        got = {r.idx: r.weights for r in terms.collect()}
        assert np.allclose([got[i] for i in range(15)], share.sum(axis=0), rtol=1e-5)
        own = sorted(tuple(r.weights) for r in documents.collect())
        assert np.allclose(own, sorted(map(tuple, np.delete(share.sum(axis=1), 7, axis=0).tolist())), rtol=1e-5)
        assert sum(map(sum, own)) == pytest.approx(values.sum(), abs=1e-9)


def test_a_term_is_sent_once_to_a_block(spark, monkeypatch):
    # Parts of the input do not multiply the weights: 60 terms, 5 blocks of two packs or less, 40 parts.
    from lexiweave.operators import topic_model as T

    monkeypatch.setattr(T, "PACK_ENTRIES", 60)
    monkeypatch.setattr(T, "BLOCK_ENTRIES", 480)
    df = spark.range(40).select("id", F.transform(F.sequence(F.lit(0), F.lit(59)), lambda x: (x + 1).cast("double")).alias("v"))
    df = df.select(F.col("id").alias("doc_id"), array_to_vector("v").alias("features")).repartition(40)
    sent = []
    kept = T.materialize
    monkeypatch.setattr(T, "materialize", lambda rows, name: sent.append((name, kept(rows, name))) or sent[-1][1])
    M.fit_lda(df, k=2, max_iter=2, doc=2.0, topic=2.0)
    weights = [rows for name, rows in sent if name == "topic_weights"]
    assert [rows.where(F.col("kind") == T._TERMS).count() for rows in weights] == [5 * 60] * 3
