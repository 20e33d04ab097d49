"""Operators of the text preparation subpackage against brute force and on edge cases."""

import itertools
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from lexiweave.llm import decontaminate, langid, multiindex, packing, quality, secrets, simhash, substrings, tokencounts, toxicity
from lexiweave.llm.batches import one_row_per_id
from lexiweave.llm.components import components

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a   b \n\n c", "it's we'll 'tis ''s 's's rock'n'roll 're x'really", "a <|endoftext|> b  <|endo",
    "½²٣ 12ab", "\t\tfoo\n", "é'll 'LL", "日本語 'd'd 🙂🙂", "<|endoftext|><|endoftext|>", "q  <|endoftext|>  r", "ab\n\n\ncd \n ef",
]


def docs_of(spark, rows):
    """Documents with a clashing extra column."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, id string"
    return spark.createDataFrame([(i, t, l, "s", len(t or ""), "keep", "x") for i, t, l in rows], schema)


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_components_of_a_random_graph(spark):
    rng = random.Random(3)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(99, 99), (None, 1)]
    want = {x: x for a, b in links if a is not None for x in (a, b)}
    for _ in links:
        for a, b in links:
            if a is not None:
                want[a] = want[b] = min(want[a], want[b])
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.id: r.component_id for r in got} == want


def test_simhash_equals_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(400)]
    base = [sentence(rng, words, n) for n in (3, 5, 60, 200, 200)]
    texts = [None, "", "   ", "A b", "a B", *base]
    for t in base[2:]:
        for _ in range(12):
            parts = t.split()
            parts[rng.randrange(len(parts))] = "zz"
            texts.append(" ".join(parts))
    rows = [(k, t, "en") for k, t in enumerate(texts)] + [(None, "lost", "en"), (5, base[0], "en")]

    def value(text):
        parts = (text or "").encode().lower().split()
        if not parts:
            return 0
        shingles = [b" ".join(parts[i : i + 4]) for i in range(max(1, len(parts) - 3))]
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {k: value(t) for k, t, _ in rows if k is not None}
    want = dict(zip(prints, prints))
    for _ in range(len(prints)):
        for a, b in itertools.combinations(prints, 2):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                want[a] = want[b] = min(want[a], want[b])
    for options in ({}, {"block_rows": 3}, {"key_bytes": 3}):
        got = simhash.near_duplicates(docs_of(spark, rows), **options).collect()
        assert len(got) == len(rows) - 1
        assert {r.doc_id: int(r.fingerprint, 16) for r in got} == prints
        assert {r.doc_id: r.component_id for r in got} == want
    kept = simhash.keep_one(docs_of(spark, rows))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*set(want.values()), None], key=str)
    assert kept.columns == docs_of(spark, []).columns
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_every_pair_within_four_bits_shares_a_posting_list():
    for bits, size in itertools.product(range(8), (1, 2, 3)):
        sets = simhash.position_sets(bits, size)
        for shared in itertools.combinations(range(8), 8 - bits):
            assert any(set(s) <= set(shared) for s in sets)


def test_prefix_counts_are_those_of_the_library(tokenizer):
    counter = tokencounts.PrefixCounter(PATH)
    for text, counts in zip(ODD, counter.counts(ODD), strict=True):
        want = [len(e.ids) for e in tokenizer.encode_batch([text[:k] for k in range(len(text) + 1)], add_special_tokens=False)]
        assert counts.tolist() == want
        assert tokencounts.restored(tokencounts.stored(counts)).tolist() == want
        for budget in (0, 1, 3):
            assert tokencounts.longest_prefix(counts, budget) == max(k for k, c in enumerate(want) if c <= budget)


def test_token_counts_of_rows(spark, tokenizer):
    rows = [(k, t, "en") for k, t in enumerate([*ODD, None, "long word " * 3000])] + [(0, ODD[2], "en"), (None, "x", "en")]
    got = tokencounts.token_counts(docs_of(spark, rows), with_prefixes=True).collect()
    assert len(got) == len(rows)
    for r, (k, t, _) in zip(got, rows, strict=True):
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        assert (r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) == (k, len((t or "").encode()), n, n > 1024)
        assert tokencounts.restored(r.prefix_counts)[-1] == n


def test_piece_table_starts_anew_without_other_results(tokenizer):
    encoder = packing.Encoder(PATH)
    encoder.table.max_pieces = 3
    for text in ODD * 2:
        flat, counts = encoder.ids([text, text])
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert flat.tolist() == want * 2 and counts.tolist() == [len(want)] * 2


def test_packing_round_trip(spark, tokenizer):
    rng = random.Random(7)
    rows = [(k, sentence(rng, ["alpha", "beta", "gamma"], rng.randrange(40)), "en") for k in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "word " * 500, "en"), (3, "again", "en"), (None, "x", "en")]
    got = packing.pack(docs_of(spark, rows), capacity=64, group_pieces=20, with_ids=True).collect()
    placed = {}
    for r in got:
        assert len(r.ids) == r.length and r.offset + r.length <= 64
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in placed.values():
        spans.sort()
        assert all(s == sum(n for _, n in spans[:k]) for k, (s, _) in enumerate(spans))
    by_doc = {}
    for r in sorted(got, key=lambda r: r.piece):
        by_doc.setdefault(r.doc_id, []).append(r)
    for k, t, _ in rows:
        if k in (3,):
            continue
        want = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        pieces = by_doc[k]
        assert [x for p in pieces for x in p.ids] == want
        assert [p.start for p in pieces] == list(itertools.accumulate([0] + [p.length for p in pieces[:-1]]))
        assert all(p.length == 64 for p in pieces[1:])
    total = sum(r.length for r in got)
    assert len(placed) <= -(-total // 64) + 8
    assert packing.pack(docs_of(spark, [])).count() == 0


def test_pack_lengths_is_close_to_the_bound():
    lengths = np.random.default_rng(2).integers(1, 2049, 4000)
    sequence, offset = packing.pack_lengths(lengths)
    assert np.bincount(sequence, weights=lengths).max() <= 2048
    assert sequence.max() + 1 <= 1.01 * lengths.sum() / 2048 + 1
    assert (offset + lengths <= 2048).all()


def test_secret_patterns_and_offsets(spark):
    hexes = "0123456789abcdef" * 2
    texts = [
        None, "", 'é PassWord = "abc123" x', "token: short", f"token = \"{hexes}\" and AKIA{'A1' * 8} end", "AKIAABC",
        "ſecret=abcdefgh Kapi_key:xx.yy-zz", "token==abcdef",
    ]
    rows = [(k, t, "en") for k, t in enumerate(texts)] + [(1, "again token=abcdefg", "en")]
    got = secrets.scan(docs_of(spark, rows), secrets.Field()).collect()
    spans = [r.spans for r in got]
    assert spans[2] == "assign:2:20"
    assert spans[4] == "assign:0:41,hex:9:41,access:47:67"
    assert [(r.n_assign, r.n_access, r.n_hex) for r in got] == [(0, 0, 0)] * 2 + [(1, 0, 0), (0, 0, 0), (1, 1, 1), (0, 0, 0), (1, 0, 0), (1, 0, 0), (1, 0, 0)]
    clean = secrets.redact(docs_of(spark, rows), secrets.Field()).collect()
    assert clean[0].text is None and clean[2].text == 'é <secret>" x' and clean[3].text == "token: short"
    assert clean[4].text == "<secret>\" and <secret> end"


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        field = secrets.Field()
        field.move = rng.normal(size=(3, 3)) * 1.5
        text = np.repeat(np.arange(4), rng.integers(1, 6, 4))
        score = rng.normal(size=(len(text), 3)) * 2
        score[:, 0] += rng.choice([0, 4, 8], len(text))
        tags = field.decode(score, text)

        def value(rows, path):
            return sum(score[i, y] for i, y in zip(rows, path)) + sum(field.move[a, b] for a, b in zip(path, path[1:]))

        for k in range(4):
            rows = np.flatnonzero(text == k)
            best = max(value(rows, p) for p in itertools.product(range(3), repeat=len(rows)))
            assert value(rows, tags[rows]) == pytest.approx(best)


def test_field_finds_a_secret_without_its_key_word(spark):
    rng = random.Random(4)
    words = ["the", "of", "and", "river", "stone", "light"]

    def secret():
        return "".join(rng.choice("0123456789abcdef") for _ in range(40))

    rows = [(k, f"{sentence(rng, words, 30)} token = {secret()} {sentence(rng, words, 30)}", "en") for k in range(120)]
    rows += [(k, sentence(rng, words, 60), "en") for k in range(200, 320)]
    field = secrets.train(docs_of(spark, rows))
    hidden = secret().upper()[:38]
    asked = [(1, f"{sentence(rng, words, 20)} token = {hidden} {sentence(rng, words, 20)}", "en"), (2, sentence(rng, words, 50), "en")]
    got = {r.doc_id: r for r in secrets.scan(docs_of(spark, asked), field).collect()}
    assert got[1].n_assign == 1 and got[2].spans == ""


def test_gradients_of_the_network_by_differences():
    model = langid.BiGru(["a", "b"], hidden=3)
    for name in model.names:
        setattr(model, name, getattr(model, name).astype(np.float64))
    rng = np.random.default_rng(1)
    data, labels = rng.integers(97, 123, (4, 9)), np.array([0, 1, 1, 0])
    _, slopes = model.gradients(data, labels)
    for name in model.names:
        weight = getattr(model, name)
        at = np.unravel_index(np.abs(slopes[name]).argmax(), weight.shape)
        weight[at] += 1e-4
        high = model.gradients(data, labels)[0]
        weight[at] -= 2e-4
        low = model.gradients(data, labels)[0]
        weight[at] += 1e-4
        assert slopes[name][at] == pytest.approx((high - low) / 2e-4, rel=1e-2)


def test_language_identification(spark):
    rng = random.Random(5)
    alphabets = {"aa": ["kato", "moki", "tami"], "bb": ["zerf", "schlu", "grund"]}
    rows = [(k, sentence(rng, alphabets[l], 30), l) for k in range(120) for l in ("aa", "bb")]
    model = langid.train(docs_of(spark, rows), sample_windows=100, steps=60)
    asked = [(1, "kato moki tami kato moki", None), (2, "grund zerf schlu grund", None), (3, None, None), (4, "", None), (5, "12 %% 3", None), (1, "kato " * 4000, None)]
    got = langid.predict(docs_of(spark, asked), model).collect()
    assert [r.lang_pred for r in got] == ["aa", "bb", "und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in got) and got[2].score == 0
    kept = langid.keep_known(docs_of(spark, asked), model)
    assert [r.doc_id for r in kept.collect()] == [1, 2, 1] and kept.columns == docs_of(spark, []).columns
    assert {r.score for r in kept.collect()} == {"keep"}
    assert langid.train(docs_of(spark, [])) is None
    assert langid.predict(docs_of(spark, asked), None).where("lang_pred <> 'und'").count() == 0
    assert langid.keep_known(docs_of(spark, asked), None).count() == 3


def test_templates_find_changed_questions(spark):
    item = "Anna has 12 apples and gives Peter 5 apples, how many apples does she keep if Anna started with 12 apples?"
    same = "Well. Maria has 31 apples and gives Klaus 7 apples, how many apples does she keep if Maria started with 31 apples?"
    other = same.replace("if Maria started with 31", "if Jo started with 99")
    rows = [(1, item, "en"), (2, same, "en"), (3, other, "en"), (4, None, "en"), (5, "", "en"), (6, item.upper() + " more", "en"), (7, "apples are good", "en"), (1, item, "en")]
    items = spark.createDataFrame([(10, item), (11, None), (12, "so short"), (13, "one two three four five")], "item_id bigint, text string")
    got = decontaminate.leaks(docs_of(spark, rows), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 10), (2, 10)] and {r.consistency for r in got} == {1.0}
    kept = decontaminate.decontaminate(docs_of(spark, rows), items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7] and kept.columns == docs_of(spark, []).columns
    assert decontaminate.leaks(docs_of(spark, []), items).count() == 0
    assert decontaminate.leaks(docs_of(spark, rows), items.limit(0)).count() == 0


def test_short_and_plain_items_are_found(spark):
    rng = random.Random(8)
    words = [f"wort{k}" for k in range(500)]
    text = sentence(rng, words, 30)
    rows = [(1, f"{sentence(rng, words, 40)} {text} {sentence(rng, words, 40)}", "en"), (2, sentence(rng, words, 90), "en"), (3, "say one two three four five now", "en")]
    items = spark.createDataFrame([(10, text), (13, "one two three four five")], "item_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs_of(spark, rows), items).collect()) == [(1, 10), (3, 13)]


@pytest.mark.parametrize("block", [3, 1024])
def test_vectors_equal_brute_force(spark, block):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 8))
    values = [(c + 0.12 * rng.normal(size=8)).tolist() for c in centres for _ in range(9)]
    values += [values[0]] * 5 + [(2.5 * np.array(values[1])).tolist()]
    bad = [None, [], [0.0] * 8, [float("nan")] * 8, [1.0, None] * 4, [1.0, 2.0]]
    rows = [(k, v, 0) for k, v in enumerate([*values, *bad])] + [(None, values[0], 0)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r for r in multiindex.near_duplicates(table, codewords=4, block_rows=block).collect()}
    unit = np.array(values) / np.linalg.norm(values, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    n, label = len(values), np.arange(len(values))
    for _ in range(n):
        label = np.array([label[near[k]].min() for k in range(n)])
    assert len(got) == n + len(bad)
    found = sum(got[k].n_links for k in range(n))
    assert 0.9 * (near.sum() - n) <= found <= near.sum() - n
    assert np.mean([got[k].component_id == label[k] for k in range(n)]) > 0.9
    assert all(got[k].kept and got[k].n_links == 0 and got[k].component_id == k for k in range(n, n + len(bad)))
    assert multiindex.near_duplicates(table.limit(0)).count() == 0


def test_walk_visits_cells_in_order():
    rng = np.random.default_rng(2)
    index = multiindex.Index(rng.normal(size=(200, 6)), codewords=5)
    vectors = rng.normal(size=(20, 6))
    first, second = index.distances(vectors)
    for a, b, cells in zip(first, second, index.visited(vectors, 25), strict=True):
        sums = [a[c // 5] + b[c % 5] for c in cells]
        assert len(set(cells)) == 25 and sums == sorted(sums)


def test_toxicity_learns_from_documents_and_locates_sentences(spark):
    rng = random.Random(11)
    words = [f"word{k}" for k in range(60)]

    def text(bad):
        parts = [sentence(rng, words, 8) for _ in range(5)]
        if bad:
            parts[rng.randrange(5)] += " nasty fool"
        return ". ".join(parts) + "."

    rows = [(k, text(k % 3 == 0), "en") for k in range(300)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)] + [(1, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs_of(spark, rows), labels)
    calm, bad = sentence(rng, words, 8), "é you nasty fool"
    got = toxicity.score(docs_of(spark, [(1, f"{calm}. {bad}. {calm}.", "en"), (2, f"{calm}. {calm}.", "en"), (3, None, "en"), (4, "", "en"), (1, "x " * 9000, "en")]), model).collect()
    assert [r.predicted for r in got] == [1, 0, 0, 0, 0] and all(0 <= r.score <= 1 for r in got)
    assert [(s.start, s.end) for s in got[0].offending] == [(len(calm) + 2, len(calm) + 3 + len(bad))]
    empty = toxicity.train(docs_of(spark, []), labels.limit(0))
    assert toxicity.score(docs_of(spark, []), empty).count() == 0


def test_quality_shrinks_sparse_sites(spark):
    rng = random.Random(12)
    words = [f"word{k}" for k in range(80)]
    rows = [(k, sentence(rng, words, 40) if k % 4 else sentence(rng, ["##$%", "|", "@@"], 40), f"l{k % 5}") for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(400)], "doc_id bigint, quality int")
    model = quality.train(docs_of(spark, rows), labels)
    more = rows + [(900, None, None), (901, "", "rare"), (0, rows[0][1], "l0")]
    got = quality.posteriors(docs_of(spark, more), model, "source", "lang").collect()
    assert len(got) == len(more)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[k] == (k % 4 > 0) for k in range(400))
    rates = {r.doc_id: r for r in got}
    # A site of one document has the rate of its host.
    assert rates[901].path_rate == pytest.approx(rates[901].host_rate)
    assert quality.posteriors(docs_of(spark, []), model, "source", "lang").count() == 0


def test_passages_equal_brute_force(spark):
    rng = random.Random(13)

    def fresh(n):
        return ["".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(2, 7))) for _ in range(n)]

    shared, short = fresh(70), fresh(30)
    changed = shared[:20] + ["XX"] + shared[21:45] + ["YY", "ZZ"] + shared[46:]
    texts = [fresh(100) + shared + fresh(50), fresh(10) + shared + fresh(80), fresh(30) + changed, fresh(200), fresh(40) + short + fresh(40), short]
    rows = [(k + 1, " ".join(t), "en") for k, t in enumerate(texts)] + [(7, None, "en"), (8, "", "en"), (9, "a b", "en"), (1, " ".join(texts[0]), "en"), (None, " ".join(shared), "en")]
    got = {r.doc_id: r for r in substrings.repeated_passages(docs_of(spark, rows)).collect()}
    assert sorted(got) == [1, 2, 3]
    assert [(got[k].start_word, got[k].end_word, got[k].partner_id) for k in (1, 2, 3)] == [(100, 170, 2), (10, 80, 1), (30, 101, 1)]
    assert substrings.repeated_passages(docs_of(spark, [])).count() == 0


def test_chains_rise_in_both_texts():
    rng = np.random.default_rng(3)
    x = np.concatenate([np.arange(0, 100, 5), rng.integers(0, 100, 15)])
    y = np.concatenate([np.arange(40, 140, 5), rng.integers(0, 400, 15)])
    found = substrings.chains(x, y)
    used = np.concatenate(found)
    assert len(set(used.tolist())) == len(used)
    for one in found:
        assert (np.diff(x[one]) > 0).all() and (np.diff(y[one]) > 0).all()
    assert max(len(one) for one in found) >= 20


def test_fenwick_tree_is_a_prefix_maximum():
    rng = random.Random(2)
    tree, best = substrings.Fenwick(20), [0.0] * 20
    for k in range(100):
        at, value = rng.randrange(20), rng.random()
        tree.raise_to(at, value, k)
        best[at] = max(best[at], value)
        stop = rng.randrange(21)
        assert tree.before(stop)[0] == max([0.0, *best[:stop]])


def test_alignment_is_a_longest_common_subsequence():
    rng = np.random.default_rng(4)
    for _ in range(40):
        a, b = rng.integers(0, 4, rng.integers(0, 9)), rng.integers(0, 4, rng.integers(0, 9))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert substrings.align(a, b).sum() == table[-1, -1]


def test_one_row_per_id(spark):
    got = one_row_per_id(docs_of(spark, [(1, "a", "en"), (1, "a", "en"), (2, "b", "en"), (None, "c", "en"), (None, "c", "en")]), "doc_id", "text")
    assert sorted((str(r.doc_id) for r in got.collect())) == ["1", "2", "None", "None"]


def test_different_texts_under_one_id(spark):
    texts = ["a red fox ran over the hill", None, "", "ten ships sailed north in the cold wind"]
    got = [one_row_per_id(docs_of(spark, [(7, t, "en") for t in order]), "doc_id", "text").collect() for order in (texts, texts[::-1])]
    assert len(got[0]) == 1 and got[0] == got[1]
    # The id of a text of its own is not lost, although another row of that id repeats an earlier text.
    rows = [(3, texts[0], "en"), (5, texts[0], "en"), (5, texts[3], "en"), (6, texts[0], "en"), (6, texts[0], "en")]
    assert sorted(r.doc_id for r in simhash.keep_one(docs_of(spark, rows)).collect()) == [3, 5]


def test_single_matches_beside_a_chain():
    # One seed stands at many places of a text: its matches are single, the rising ones beside them are a chain.
    x = np.array([*range(0, 900, 9), 1000, 1008, 1016])
    y = np.array([40] * 100 + [60, 68, 76])
    long = [one.tolist() for one in substrings.chains(x, y) if len(one) > 1]
    assert long == [[100, 101, 102]]


def test_slices_hold_whole_texts():
    from lexiweave.llm.batches import text_slices, words

    texts = ["aa b", None, "", "c" * 50, " d  e\tf "]
    found = []
    for first, end, data, offsets in text_slices(pa.array(["skip", *texts]).slice(1), limit=10):
        starts, ends, heads = words(data, offsets)
        for k in range(end - first):
            found.append([data[s:e].tobytes().decode() for s, e in zip(starts[heads[k] : heads[k + 1]], ends[heads[k] : heads[k + 1]])])
    assert found == [(t or "").split() for t in texts]
