"""Operators against plain loops that follow the text of their method."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lexiweave.llm import decontaminate, langid, packing, quality, toxicity
from lexiweave.llm.batches import text_slices

WORDS = "red oak river stone lamp cloud paper chair window garden music bread salt wind boat field".split()


# Benchmark decontamination.


def plain_template(text):
    """(type or word, value) of the tokens of a plain ASCII text."""
    tokens, opens, before = [], True, None
    for raw in text.split():
        core = re.sub(r"^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "", raw)
        here, opens = opens, raw[-1] in ".!?:;"
        if not core:
            continue
        low = core.lower()
        if core[0].isdigit():
            kind = "#"
        elif before == "#" and low in decontaminate.UNITS:
            kind = "%"
        elif core[0].isupper() and len(core) > 1 and not core[1].isupper() and not (here and low in decontaminate.OPENERS):
            kind = "@"
        else:
            kind = low
        # Names in a row are one name, within a sentence.
        if not (kind == "@" and tokens and tokens[-1][0] == "@" and before == "@" and not here):
            tokens.append((kind, low))
        before = kind
    return tokens


def plain_leaks(docs, items):
    found = set()
    size_of = decontaminate.WINDOW
    for item_id, item in items:
        want = plain_template(item)
        size = min(len(want), size_of)
        if size < decontaminate.LEAST_LITERALS:
            continue
        windows = [p for p in range(len(want) - size + 1) if sum(k not in "#%@" for k, _ in want[p : p + size]) >= min(decontaminate.LEAST_LITERALS, size)]
        for doc_id, text in docs:
            have = plain_template(text)
            places = set()
            for shift in range(-len(want), len(have)):
                hit = [p for p in windows if 0 <= p + shift <= len(have) - size and [k for k, _ in want[p : p + size]] == [k for k, _ in have[p + shift : p + shift + size]]]
                pairs = {(want[p + o][1], have[p + shift + o][1]) for p in hit for o in range(size) if want[p + o][0] in "#%@"}
                consistent = len({a for a, _ in pairs}) / len(pairs) if pairs else 1.0
                if consistent >= decontaminate.MIN_CONSISTENCY:
                    places |= set(hit)
            if windows and len(places) / len(windows) >= decontaminate.MIN_COVERAGE:
                found.add((doc_id, item_id, len(places)))
    return found


def test_decontamination_equals_plain_templates_over_all_pairs(spark):
    rng = random.Random(3)

    def filled(shape):
        names, numbers = rng.sample(["Maria", "Paul", "Karen", "Oskar", "Ines"], 3), [str(rng.randrange(2, 90)) for _ in range(3)]
        return " ".join(names[int(t[1])] if t[0] == "@" else numbers[int(t[1])] if t[0] == "#" else t for t in shape)

    shapes = []
    for _ in range(12):
        shape = [rng.choice(WORDS) for _ in range(rng.choice([5, 7, 9, 14, 22]))]
        for _ in range(rng.randrange(0, 6)):
            shape.insert(rng.randrange(1, len(shape)), rng.choice(["@0", "@1", "@2", "#0", "#1", "#2", "#0 kg"]).split()[0])
        shapes.append(shape)
    items = [(k, filled(s)) for k, s in enumerate(shapes)]
    docs = []
    for k in range(120):
        shape = list(rng.choice(shapes))
        text = filled(shape)
        if rng.random() < 0.3:
            # Values that are not replaced alike everywhere.
            text = " ".join(str(rng.randrange(2, 90)) if w.isdigit() and rng.random() < 0.6 else w for w in text.split())
        if rng.random() < 0.3:
            parts = text.split()
            parts[rng.randrange(len(parts))] = "other"
            text = " ".join(parts)
        around = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 12))) for _ in range(2)]
        docs.append((k, f"{around[0]} {text} {around[1]}".strip()))
    least, size_of = decontaminate.LEAST_LITERALS, decontaminate.WINDOW
    templated = set()
    for i, text in items:
        kinds = [k for k, _ in plain_template(text)]
        size = min(len(kinds), size_of)
        if any(sum(k not in "#%@" for k in kinds[p : p + size]) >= least for p in range(len(kinds) - size + 1)):
            templated.add(i)
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    # Items whose windows all lack literal words are matched by value and are not part of the plain form.
    got = {(r.doc_id, r.item_id, r.n_windows) for r in decontaminate.leaks(table, bench).collect() if r.item_id in templated}
    want = plain_leaks(docs, items)
    assert got == want and len(want) > 40


# Quality classifier.


def test_quality_equals_plain_loops_over_hosts_and_paths(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 40))) + rng.choice([".", "###", ""]), rng.choice(["a", "a", "b", None]), rng.choice(["x", "y", None])) for k in range(90)]
    rows += [(200, None, "c", "x"), (201, "", "c", "x")]
    texts = [t or "" for _, t, _, _ in rows]
    x = np.concatenate([quality.features(data, offsets) for _, _, data, offsets in text_slices(pa.array(texts))])
    model = quality.Classifier()
    model.fit(x, np.array([float(len(t) > 60) for t in texts]))
    evidence = model.evidence(x).tolist()
    logit = math.log(model.rate / (1 - model.rate))
    p = [1 / (1 + math.exp(-(e + logit))) for e in evidence]
    site = [(h or "\0", s or "\0") for _, _, h, s in rows]

    def sums(keys):
        good, n = Counter(), Counter()
        for key, v in zip(keys, p, strict=True):
            good[key] += v
            n[key] += 1
        return good, n

    def strength(good, n, above):
        total = sum(n.values())
        noise = sum(above[k] * (1 - above[k]) for k in n)
        spread = sum(n[k] * (good[k] / n[k] - above[k]) ** 2 for k in n)
        between = max((spread - noise) / max(total, 1.0), 1e-9)
        mean = sum(good.values()) / total
        return min(max(mean * (1 - mean) / between - 1, quality._STRENGTH[0]), quality._STRENGTH[1])

    host_good, host_n = sums([h for h, _ in site])
    path_good, path_n = sums(site)
    mean = (sum(p) + 1) / (len(p) + 2)
    weight = strength(host_good, host_n, {h: mean for h in host_n})
    host_rate = {h: (host_good[h] + weight * mean) / (host_n[h] + weight) for h in host_n}
    inner = strength(path_good, path_n, {k: host_rate[k[0]] for k in path_n})
    df = spark.createDataFrame(rows, "doc_id bigint, text string, host string, path string")
    got = {r.doc_id: r for r in quality.posteriors(df, model, "host", "path").collect()}
    for (i, *_), e, own, key in zip(rows, evidence, p, site, strict=True):
        rate = (path_good[key] - own + inner * host_rate[key[0]]) / (path_n[key] - 1 + inner)
        rate = min(max(rate, 1e-6), 1 - 1e-6)
        score = 1 / (1 + math.exp(-(e + math.log(rate / (1 - rate)))))
        assert got[i].score == pytest.approx(score, abs=1e-9) and got[i].host_rate == pytest.approx(host_rate[key[0]], abs=1e-9)


# Toxicity.


def parts_of(texts):
    found = []
    for first, _, data, offsets in text_slices(pa.array(texts)):
        bag = toxicity.bags(data, offsets)
        found.append((bag, toxicity.Part(first, bag["word"].astype(np.int32), bag["sentence"].astype(np.int32), bag["text"].astype(np.int32))))
    return found


def plain_scores(model, bag, count):
    """Noisy-or sentence by sentence."""
    silent = [1.0] * count
    seen = [False] * count
    for s, text in enumerate(bag["text"].tolist()):
        logit = model.bias + sum(float(model.weights[w]) for w, at in zip(bag["word"].tolist(), bag["sentence"].tolist(), strict=True) if at == s)
        silent[text] *= 1 - 1 / (1 + math.exp(-logit))
        seen[text] = True
    empty = 1 / (1 + math.exp(-model.bias))
    return [1 - q if f else empty for q, f in zip(silent, seen, strict=True)]


def test_noisy_or_and_its_slope_equal_plain_sums():
    rng = random.Random(6)
    texts = [". ".join(" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 5))) for _ in range(12)]
    (bag, part), = parts_of(texts)
    model = toxicity.Model()
    model.weights = np.random.default_rng(2).normal(size=toxicity.BUCKETS).astype(np.float32)
    model.bias = -1.0
    got = model.texts(model.sentences(bag), bag, len(texts))
    assert np.allclose(got, plain_scores(model, bag, len(texts)), atol=1e-6)
    labels = np.array([k % 2 for k in range(len(texts))])

    def loss(weights, bias):
        one = toxicity.Model()
        one.weights, one.bias = weights, bias
        p = plain_scores(one, bag, len(texts))
        return -sum(math.log(q if y else 1 - q) for q, y in zip(p, labels.tolist(), strict=True)) / len(texts)

    # The first step of the training goes against the slope of the loss by the full rate.
    one = toxicity.Model()
    one.fit([part], labels, steps=1, rate=0.1, decay=0.0)
    start = math.log(0.5 / max(1.0, len(bag["text"]) / len(texts)))
    zero = np.zeros(toxicity.BUCKETS, np.float64)
    for w in sorted(set(bag["word"].tolist())):
        up, down = zero.copy(), zero.copy()
        up[w], down[w] = 1e-4, -1e-4
        slope = (loss(up, start) - loss(down, start)) / 2e-4
        if abs(slope) > 1e-3:
            assert one.weights[w] == pytest.approx(-0.1 * math.copysign(1, slope), abs=1e-3)
    slope = (loss(zero, start + 1e-4) - loss(zero, start - 1e-4)) / 2e-4
    assert one.bias - start == pytest.approx(-0.1 * math.copysign(1, slope), abs=1e-3)


# Language ID.


def test_pooled_probabilities_equal_a_scalar_loop():
    model = langid.BiGru(["a", "b", "c"], hidden=4, seed=3)
    texts = ["", "a", "ab" * 70, "é zz top" * 20, "x" * langid.WINDOW]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got = model.pooled(data, offsets)

    def sigma(v):
        return 1 / (1 + math.exp(-v))

    def read(way, window):
        state, states = [0.0] * 4, []
        for byte in window:
            z = [sigma(model.wz[way, byte, h] + sum(state[k] * model.uz[way, k, h] for k in range(4))) for h in range(4)]
            r = [sigma(model.wr[way, byte, h] + sum(state[k] * model.ur[way, k, h] for k in range(4))) for h in range(4)]
            new = [math.tanh(model.wn[way, byte, h] + sum(r[k] * state[k] * model.un[way, k, h] for k in range(4))) for h in range(4)]
            state = [s + a * (n - s) for s, a, n in zip(state, z, new, strict=True)]
            states.append(state)
        return states

    for k, text in enumerate(texts):
        raw, total = text.encode(), [0.0] * 3
        for at in range(0, len(raw), langid.WINDOW):
            size = len(raw[at : at + langid.WINDOW])
            # Short windows end in blanks, whose positions do not count.
            window = raw[at : at + langid.WINDOW].ljust(langid.WINDOW)
            ahead, behind = read(0, window), read(1, window[::-1])[::-1]
            for x, y in list(zip(ahead, behind, strict=True))[:size]:
                scores = [float(model.bias[c]) + sum(x[h] * model.out[0, h, c] + y[h] * model.out[1, h, c] for h in range(4)) for c in range(3)]
                top = max(scores)
                whole = sum(math.exp(s - top) for s in scores)
                total = [t + math.exp(s - top) / whole for t, s in zip(total, scores, strict=True)]
        assert np.allclose(got[k], [t / max(len(raw), 1) for t in total], atol=1e-4)


def test_a_text_is_read_alike_beside_any_other():
    model = langid.BiGru(["a", "b"], hidden=4, seed=4)

    def pooled(texts):
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        return model.pooled(data, np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]))

    alone = pooled(["some short text"])[0]
    for beside in (["x" * 95], ["zz"], ["other words " * 30, ""]):
        assert np.allclose(pooled(["some short text", *beside])[0], alone, atol=1e-5)
        assert np.allclose(pooled([*beside, "some short text"])[-1], alone, atol=1e-5)


# Best-fit packing.


def plain_fills(lengths, capacity):
    """Token sums of the sequences of greedy filling with the best exchange of the smallest piece for two."""
    left, fills = Counter(lengths), []
    while +left:
        held, room = [], capacity
        while fitting := [x for x in left if left[x] and x <= room]:
            held.append(max(fitting))
            left[held[-1]] -= 1
            room -= held[-1]
        if room:
            smallest, best = held[-1], (0, 0)
            for a in sorted(x for x in left if left[x]):
                for b in sorted((x for x in left if left[x] and x <= a), reverse=True):
                    if a + b <= room + smallest and (a != b or left[a] > 1):
                        best = max(best, (a, b), key=sum) if a + b > sum(best) else best
                        break
            if sum(best) > smallest:
                held.pop()
                left[smallest] += 1
                held += best
                left.subtract(best)
        fills.append(sorted(held))
    return fills


@pytest.mark.parametrize("seed", range(6))
def test_packing_equals_a_naive_search(seed):
    rng = random.Random(seed)
    lengths = [rng.randrange(1, rng.choice([20, 60, 101])) for _ in range(rng.randrange(1, 150))]
    sequence, offset = packing.pack_lengths(np.array(lengths), 100)
    got = {}
    for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths, strict=True):
        got.setdefault(s, []).append((o, n))
    for pieces in got.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 100
    assert [sorted(n for _, n in got[s]) for s in sorted(got)] == plain_fills(lengths, 100)
