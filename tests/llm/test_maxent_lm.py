from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridemill.llm import maxent_lm as op
from ridemill.llm.language_id import is_held_out

from . import cases


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def scores(spark, texts, updates=3):
    part = is_held_out(5, 1)
    return op.lm_scores(cases.table(spark, texts), ~part, updates).withColumn("held_out", part).collect()


def test_base_scores_and_counts(spark, monkeypatch):
    monkeypatch.setattr(op, "SHARED_WORDS", 40)  # the others meet their counts by the join
    texts = cases.odd_texts() + [(200 + i, cases.prose(i, 40)) for i in range(30)]
    counts = Counter(w for d, t in texts if not held_out(d) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    wanted = []
    for d, t in texts:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens(t))
        wanted.append((d, held_out(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(base, 6)))
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scores(spark, texts)]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_probabilities_add_up_to_one(spark):
    texts = [(i, cases.prose(i, 30, 60)) for i in range(40)]
    counts = op.word_counts(cases.table(spark, texts))
    vocab = op.vocabulary(counts)
    by_class = Counter()
    for row in counts.collect():
        code = vocab.packed(bytes(row.word))
        own = 0 < code >> 16 <= op.OWN_CLASSES
        by_class[code >> 8 & 255] += 1.0 if own else (row.c + 0.5) / 10 ** vocab.class_logs[code >> 8 & 255]
    for kind, total in by_class.items():
        unknown = 0 if kind < op.OWN_CLASSES else 0.5 / 10 ** vocab.class_logs[kind]
        assert math.isclose(total + unknown, 1)


def test_model_beats_single_words_on_held_out_text(spark):
    phrases = [cases.prose(i, 12, 300) for i in range(40)]
    texts = [(i, " ".join(phrases[(i * 7 + k * k) % 40] for k in range(6))) for i in range(200)]
    own = [r for r in scores(spark, texts, op.UPDATES) if r.held_out]
    assert own and sum(r.score for r in own) > sum(r.base_score for r in own)


def test_empty_tables_and_nothing_to_learn_from(spark):
    assert scores(spark, []) == []
    rows = op.lm_scores(cases.table(spark, [(1, "a b"), (2, None)]), F.lit(False), 1).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in rows} == {(1, 3, 0, 0), (2, 1, 0, 0)}


def follows(texts):
    """(word before, word): how often, over all of `texts`."""
    found = Counter()
    for _, text in texts:
        before = None
        for word in tokens(text):
            found[before, word] += 1
            before = word
    return found


def bigram_weights(texts, vocab, counts):
    """Weights by (before, word) and normalisers by (before, class), worked out one context at a time."""
    contexts = defaultdict(dict)
    for (before, word), n in follows(texts).items():
        if word not in own_words(vocab):
            contexts[before, op.hashed_class(word)][word] = n
    weights, wholes = {}, {}
    for (before, kind), seen in contexts.items():
        total = sum(seen.values())
        share = {w: (counts[w] + 0.5) / 10 ** vocab.class_logs[kind] for w, n in seen.items() if n >= op.SEEN}
        if not share:
            continue
        own = {w: math.log((seen[w] - op.DISCOUNT) / (total * share[w])) for w in share}
        for turn in range(op.BIGRAM_UPDATES + 1):
            whole = 1 + sum(share[w] * (math.exp(own[w]) - 1) for w in share)
            if turn < op.BIGRAM_UPDATES:
                for w in share:
                    shown, expected = seen[w] - op.DISCOUNT, total * share[w] * math.exp(own[w]) / whole
                    own[w] += (shown - expected) / max(shown, expected)
        weights |= {(before, w): own[w] for w in share}
        wholes[before, kind] = whole
    return weights, wholes


def own_words(vocab):
    return {w for w, i in vocab.words.items() if i < op.OWN_CLASSES}


@pytest.mark.parametrize("places", [op.PLACES, 8])
def test_scores_are_those_of_a_softmax_worked_out_token_by_token(spark, monkeypatch, places):
    monkeypatch.setattr(op, "PLACES", places)  # with few places most weights meet the texts by the join
    monkeypatch.setattr(op, "SHARED_WORDS", 60)
    phrases = [cases.prose(i, 5, 40) for i in range(12)]
    texts = [(i, " ".join(phrases[(i * 7 + k * k) % 12] for k in range(5))) for i in range(60)] + cases.odd_texts()
    learned = [(d, t) for d, t in texts if not held_out(d)]
    counts = Counter(w for _, t in learned for w in tokens(t))
    docs = cases.table(spark, texts)
    table = op.word_counts(docs.where(~is_held_out(5, 1)))
    vocab = op.vocabulary(table)
    seen = op.context_counts(docs.where(~is_held_out(5, 1)), spark.sparkContext.broadcast(vocab))
    cells = seen.where(f"word = {op.CELL}").selectExpr("int(context div 64) AS pair", "int(context % 64) AS class", "n")
    class_weights = op.trained(cells, 3)
    weights, wholes = bigram_weights(learned, vocab, counts)
    assert weights and any(w > 0 for w in weights.values())

    def log_probability(words):
        found, start = 0.0, vocab.packed(op.END) & 255
        buckets = [start, start] + [vocab.packed(w) & 255 for w in words]
        for i, word in enumerate(words):
            kind = vocab.packed(word) >> 8 & 255
            logits = class_weights[op.ACTIVE[:, buckets[i + 1] * op.BUCKETS + buckets[i]]].sum(axis=0)
            found += (logits[kind] - math.log(np.exp(logits).sum())) / math.log(10)
            if word not in own_words(vocab):
                before = words[i - 1] if i else None
                share = (counts[word] + 0.5) / 10 ** vocab.class_logs[kind]
                found += math.log10(share * math.exp(weights.get((before, word), 0.0)) / wholes.get((before, kind), 1.0))
        return found

    wanted = sorted(((d, log_probability(tokens(t))) for d, t in texts), key=repr)
    got = sorted(((r.doc_id, r.score) for r in scores(spark, texts)), key=repr)
    assert [d for d, _ in got] == [d for d, _ in wanted]
    assert all(math.isclose(a, b, rel_tol=1e-4, abs_tol=1e-3) for (_, a), (_, b) in zip(sorted(got, key=lambda r: (str(r[0]), r[1])), sorted(wanted, key=lambda r: (str(r[0]), r[1])), strict=True))
    for (before, kind), whole in wholes.items():
        inside = [w for w in counts if w not in own_words(vocab) and op.hashed_class(w) == kind]
        shares = {w: (counts[w] + 0.5) / 10 ** vocab.class_logs[kind] for w in inside}
        unknown = 0.5 / 10 ** vocab.class_logs[kind]
        assert math.isclose(sum(shares[w] * math.exp(weights.get((before, w), 0.0)) for w in inside) + unknown, whole)


def test_weights_grow_with_the_training_rows(spark):
    def weights(n):
        docs = cases.table(spark, [(i, cases.prose(i % (n // 2), 40, 2000)) for i in range(n)])
        words = op.word_counts(docs)
        vocab = op.vocabulary(words)
        return op.in_class_values(op.context_counts(docs, spark.sparkContext.broadcast(vocab)), words, vocab).count()

    assert weights(80) > 1.7 * weights(40)
