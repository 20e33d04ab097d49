"""The pipeline on small tables."""

import random

import corpus_pipeline
from lexiweave.llm import simhash


def test_stages_keep_clean_documents(spark, tmp_path):
    rng = random.Random(21)
    words = {"aa": [f"kato{k}" for k in range(90)], "bb": [f"schlu{k}" for k in range(90)]}
    texts = [(k, " ".join(rng.choice(words[l]) for _ in range(60)), l) for k in range(60) for l in ("aa", "bb")]
    rows = [(2 * k + (l == "bb"), t, l) for k, t, l in texts]
    item = " ".join(rng.choice(words["aa"]) for _ in range(25))
    rows += [
        (1000, rows[0][1], "aa"), (1001, rows[7][1] + " kato1 " + item, "aa"), (1002, "12 ## 13", "aa"), (1003, None, "aa"), (1004, "", "bb"),
        (1005, " ".join(rng.choice(words["bb"]) for _ in range(60)) + " token = 0123456789abcdef0123456789abcdef", "bb"), (None, rows[4][1] + " kato5", "aa"),
    ]
    table = spark.createDataFrame([(i, t, l, "s0", len(t or "")) for i, t, l in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, sizes = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == table.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        sizes[name] = {r.doc_id: r for r in docs.collect()}
    assert set(sizes["language_id"]) == {r[0] for r in rows} - {1002, 1003, 1004}
    assert 1000 not in sizes["simhash_near_dedup"] and 0 in sizes["simhash_near_dedup"] and None in sizes["simhash_near_dedup"]
    found = simhash.near_duplicates(spark.read.parquet(f"{tmp_path}/language_id")).collect()
    assert set(sizes["simhash_near_dedup"]) == {r.component_id for r in found} | {None}
    assert set(sizes["benchmark_decontamination"]) == set(sizes["simhash_near_dedup"]) - {1001}
    hidden = sizes["secret_scans"][1005]
    assert "0123456789abcdef" not in hidden.text and hidden.n_chars == len(hidden.text)
    assert sizes["secret_scans"][2].text == sizes["benchmark_decontamination"][2].text
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(sizes["secret_scans"])
