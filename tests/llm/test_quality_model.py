from __future__ import annotations

import random

import numpy as np

from ridemill.llm import quality_model as op

from . import cases

LABELS = "doc_id long, quality int, toxic int, note string, label int, body string"


def labelled(rows):
    return [(d, q, 0, "n", 9, "x") for d, q in rows]


def made(seed, count):
    """Good texts are prose; bad ones have signs at their words, or repeat words that stand nowhere else."""
    rnd = random.Random(seed)
    rows = []
    for doc_id in range(count):
        words = cases.prose(seed * 10_000 + doc_id, rnd.randrange(20, 90)).split()
        good = rnd.random() < 0.7
        if not good and rnd.random() < 0.5:
            words = [w + "$$" for w in words]
        elif not good:
            words = [w for _ in range(6) for w in [f"q{rnd.random()}"] * 9]
        rows.append((doc_id, " ".join(words), int(good)))
    return rows


def test_held_out_texts(spark):
    train, held_out = made(1, 500), made(2, 200)
    docs = cases.table(spark, [(d, t) for d, t, _ in train])
    labels = spark.createDataFrame(labelled((d, y) for d, _, y in train), LABELS)
    weights = op.learned(docs, labels)
    found = {r.doc_id: r for r in op.quality_scores(cases.table(spark, [(d, t) for d, t, _ in held_out]), weights).collect()}
    right = [found[d].predicted == y for d, _, y in held_out]
    assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    # The same rows in other partitions give the same weights to the last bit.
    assert np.array_equal(weights, op.learned(docs.repartition(5), labels.repartition(3)))


def test_an_update_is_that_of_the_formula():
    places, values = np.array([3, 9]), np.array([0.6, 0.8], np.float32)
    z, n = np.zeros(op.BIAS + 1), np.zeros(op.BIAS + 1)
    rows = [(places, values, 1), (places[:1], values[:1], 0), (places, values, 1)]
    op.follow(z, n, iter(rows))
    state = {}
    for own, x, label in rows:
        pairs = [*zip(own.tolist(), x.tolist(), strict=True), (op.BIAS, 1.0)]
        w = {}
        for i, _ in pairs:
            zi, ni = state.get(i, (0.0, 0.0))
            w[i] = 0.0 if abs(zi) <= op.L1 else -(zi - np.sign(zi) * op.L1) / ((op.BETA + ni**0.5) / op.ALPHA + op.L2)
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in pairs)))
        for i, v in pairs:
            zi, ni = state.get(i, (0.0, 0.0))
            g = (p - label) * v
            state[i] = (zi + g - ((ni + g * g) ** 0.5 - ni**0.5) / op.ALPHA * w[i], ni + g * g)
    for i, (zi, ni) in state.items():
        assert np.isclose(z[i], zi, atol=1e-6) and np.isclose(n[i], ni, atol=1e-6)


def test_scores_are_dot_products(spark):
    texts = cases.odd_texts()
    weights = np.random.default_rng(1).normal(size=op.BIAS + 1)
    found = op.quality_scores(cases.table(spark, texts), weights).collect()
    assert len(found) == len(texts)
    wanted = []
    for doc_id, text in texts:
        tokens = op.TOKEN.findall((text or "").encode())
        counts = {}
        hashes = op.token_hashes()
        for i, token in enumerate(tokens):
            grams = [hashes[token]]
            if i:
                before = hashes[tokens[i - 1]]
                grams.append(int(op.TWICE) if tokens[i - 1] == token else (before * int(op.PAIR) ^ hashes[token] + int(op.PAIR)) % 2**64)
            for gram in grams:
                place = gram * int(op.SPREAD) % 2**64 >> 64 - op.BITS
                counts[place] = counts.get(place, 0) + 1
        length = sum(counts.values()) ** 0.5
        total = sum(n**0.5 / length * np.float32(weights[p]) for p, n in counts.items()) + weights[op.BIAS]
        wanted.append((repr(doc_id), 1 / (1 + np.exp(-total))))
    assert np.allclose([s for _, s in sorted(wanted)], [s for _, s in sorted((repr(r.doc_id), r.score) for r in found)], atol=1e-5)


def test_labels_that_teach_nothing(spark):
    docs = cases.table(spark, cases.odd_texts())
    for rows in ([], [(None, 1), (1, 1), (6, 1), (6, 0), (7, None), (8, 2), (999, 0)]):
        weights = op.learned(docs, spark.createDataFrame(labelled(rows), LABELS))
        assert not weights.any()
    assert {r.score for r in op.quality_scores(docs, weights).collect()} == {0.5}
    assert op.quality_scores(cases.table(spark, []), weights).collect() == []
    assert not op.learned(cases.table(spark, []), spark.createDataFrame(labelled([(1, 1)]), LABELS)).any()


def test_the_sample_is_bounded_and_repeated_ids_count_once(spark):
    docs = cases.table(spark, [(i % 400, f"text {i}") for i in range(800)])
    labels = spark.createDataFrame(labelled((i % 400, i % 400 % 2) for i in range(1200)), LABELS)
    assert op.training_rows(docs, labels).count() == 400
    assert 60 < op.training_rows(docs, labels, sample=100).count() < 140
