"""Counts and weights of the toxicity models against plain Python, and what may choose their settings."""

import random
import zlib
from collections import Counter, defaultdict
from math import exp, log

import numpy as np
import pytest

from dockflow.llm import toxicity
from dockflow.llm.toxicity import Settings

HOW = Settings(slots=1 << 16, least_g2=2.0, least_weights=(0.5, 1.0), neutrals=(10, 40))


def corpus(n=300, seed=4):
    draw = random.Random(seed)
    usual = ["".join(draw.choices("abcdefgh", k=draw.randrange(2, 8))) for _ in range(60)]
    rows = []
    for i in range(n):
        words = draw.choices(usual, k=draw.randrange(0, 25))
        if i % 4 == 0 and words:
            words[draw.randrange(len(words))] = draw.choice(("vile", "vilest", "Ñoño's"))
        rows.append((i, " ".join(words) if words or i % 2 else None, int(i % 4 == 0)))
    return rows


def plain_weights(rows, how):
    """Weight of every slot by the module's definition, one count at a time."""
    find = toxicity._finder()
    seen, classes = defaultdict(lambda: [0, 0]), defaultdict(set)
    for _, text, y in rows:
        words = find((text or "").lower())
        for h, w in {(zlib.crc32(v.encode()) % how.histories, w) for v, w in zip(["", *words], words)}:
            for form in [w + "$", *(w[:n] for n in range(how.shortest, min(how.longest, len(w)) + 1))]:
                slot = zlib.crc32(form.encode()) % how.slots
                seen[slot][1 - y] += 1
                classes[slot].add(h)
    totals = [sum(c[i] for c in seen.values()) for i in (0, 1)]
    n_c, log_p = sum(map(len, classes.values())), defaultdict(list)
    for i in (0, 1):
        n1, n2, n3, n4 = (max(1, Counter(c[i] for c in seen.values()).get(k, 0)) for k in (1, 2, 3, 4))
        d = [k - (k + 1) * n1 / (n1 + 2 * n2) * b / a for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
        d = [0.0] + [min(k - 0.05, max(0.1, x)) for k, x in enumerate(d, 1)]
        mass = sum(d[min(3, c[i])] for c in seen.values()) / totals[i]
        for slot, c in seen.items():
            shared = (len(classes[slot]) + 0.5) / (n_c + 0.5 * how.slots)
            log_p[slot].append(log((c[i] - d[min(3, c[i])]) / totals[i] + mass * shared))
    out = {}
    for slot, c in seen.items():
        expected = [sum(c) * t / sum(totals) for t in totals]
        g2 = 2 * sum(n * log(n / e) for n, e in zip(c, expected) if n)
        weight = log_p[slot][0] - log_p[slot][1]
        if g2 >= how.least_g2 and abs(weight) >= min(how.least_weights):
            out[slot] = weight
    return out


def test_weights_by_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    slots, weights = toxicity.weigh(toxicity.expression_counts(df, "text", "toxic", HOW), HOW)
    expected = plain_weights(rows, HOW)
    assert expected and sorted(expected) == slots.tolist()
    np.testing.assert_allclose(weights, [expected[s] for s in sorted(expected)], atol=1e-9)


def test_score_by_brute_force(spark):
    rows = corpus()
    table = plain_weights(rows, HOW)
    slots = np.array(sorted(table))
    curve = (np.array([-0.5, 0.0, 0.5]), np.array([0.1, 0.3, 0.9]))
    model = toxicity.Model(slots, np.array([table[s] for s in slots]), 10, curve)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model, how=HOW).collect()}
    for key, text, _ in rows:
        words, total = toxicity._finder()((text or "").lower()), 0.0
        for w in words:
            forms = [w + "$", *(w[:n] for n in range(min(HOW.longest, len(w)), HOW.shortest - 1, -1))]
            total += next((table[s] for s in (zlib.crc32(f.encode()) % HOW.slots for f in forms) if s in table), 0.0)
        x = total / (len(words) + 10)
        assert got[key] == pytest.approx(0.98 * np.interp(x, *curve) + 0.02 / (1 + exp(-10 * x)), abs=1e-6)


def test_held_out_labels_change_nothing(spark):
    rows = corpus(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    held = lambda key: zlib.crc32(str(key).encode()) % 3 == 1
    turned = spark.createDataFrame([(k, 1 - y if held(k) else y) for k, _, y in rows], "doc_id long, toxic int")
    one, other = (toxicity.train(docs.select("doc_id", "text"), y, how=HOW) for y in (docs.select("doc_id", "toxic"), turned))
    assert one.neutral == other.neutral and len(one.slots) > 0
    for a, b in zip((one.slots, one.weights, *one.curve), (other.slots, other.weights, *other.curve)):
        np.testing.assert_array_equal(a, b)


def test_texts_without_words_count_nowhere(spark):
    rows = corpus() + [(1000 + i, ("", None, " ,")[i % 3], 1) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    slots, weights = toxicity.weigh(toxicity.expression_counts(df, "text", "toxic", HOW), HOW)
    expected = plain_weights(corpus(), HOW)
    assert sorted(expected) == slots.tolist()
    np.testing.assert_allclose(weights, [expected[s] for s in sorted(expected)], atol=1e-9)


def test_choice_follows_the_labels():
    draw = np.random.default_rng(3)
    y = np.repeat([0.0, 1.0], 200)
    noise, signal = draw.normal(size=400), y + draw.normal(scale=0.1, size=400)
    n, part = np.full(400, 50.0), np.arange(400) % 5
    assert toxicity.choose(n, np.stack([noise, signal], 1), y, part, HOW)[0] == 1
    assert toxicity.choose(n, np.stack([signal, noise], 1), y, part, HOW)[0] == 0
    assert toxicity.choose(np.zeros(0), np.zeros((0, 2)), np.zeros(0), np.zeros(0), HOW) == (0, 0)
