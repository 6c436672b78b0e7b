from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from ridemill.llm import periodic_runs as op
from ridemill.llm.queries import planted_words

from . import cases


def brute(words):
    """All runs by comparing the words with themselves, shifted by each period."""
    found = []
    for q in range(1, len(words) // op.LEAST_PERIODS + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= max(op.LEAST_WORDS, op.LEAST_PERIODS * q):
                part = words[start : start + length]
                if not any(part[s:] == part[:-s] for s in range(1, q)):
                    found.append((start, length, q))
            start = end + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def texts_with_runs(seed):
    rnd = random.Random(seed)
    names = [f"w{i}" for i in range(rnd.choice((1, 2, 3, 40)))]
    words = []
    while len(words) < rnd.choice((0, 23, 24, 25, 60, 160)):
        if rnd.random() < 0.4:
            words += rnd.choices(names, k=rnd.randrange(1, 9))
        else:
            period = rnd.choices(names, k=rnd.randrange(1, 14))
            words += (period * 12)[: rnd.randrange(1, 9 * len(period))]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_brute_force(seed):
    words = texts_with_runs(seed)
    own = [w.encode() for w in words]
    runs = op.periodic(own)
    assert runs == brute(words)
    assert op.collapsed(own, runs) == [w.encode() for w in brute_collapsed(words, runs)]


def test_every_run_of_short_words():
    """Random words of two symbols, without the reduction to stretches."""
    rnd = np.random.default_rng(7)
    for _ in range(60):
        symbols = rnd.integers(1, 3, rnd.integers(24, 70))
        assert sorted(op.runs_in(symbols)) == sorted(brute(symbols.tolist()))


def test_extensions_are_common_prefixes():
    rnd = np.random.default_rng(3)
    for size in (1, 2, 17, 90):
        text = rnd.integers(1, 4, size).tolist()
        tree = op.SuffixTree([*text, 0], 3)
        depths, places, suffixes = tree.tour()
        assert suffixes == sorted(range(size + 1), key=lambda i: [*text[i:], 0])
        assert tree.reversed_order() == sorted(range(size + 1), key=lambda i: [*(3 - x + 1 for x in text[i:]), 0])
        one, other = (x.ravel() for x in np.indices((size, size + 1)))
        differs = one != other
        found = op.extensions(tree, depths, places, one[differs], other[differs])
        for i, j, n in zip(one[differs], other[differs], found, strict=True):
            same = 0
            while max(i, j) + same < size and text[i + same] == text[j + same]:
                same += 1
            assert n == same


def test_the_strongest_run_is_compared_exactly():
    assert op.strongest([]) is None
    assert op.strongest([(5, 40, 10), (1, 24, 6), (9, 48, 12)]) == (5, 40, 10)
    assert op.strongest([(0, 10**17 + 1, 10**8), (1, 10**17 + 2, 10**8)])[0] == 1


def test_rows_of_odd_tables(spark):
    texts = cases.odd_texts() + [(40 + i, " ".join(texts_with_runs(i))) for i in range(20)] + [(90, "again and " * 4000), (91, "x " * 24)]
    found = op.periodic_runs(cases.table(spark, texts)).collect()
    assert len(found) == len(texts)
    wanted = []
    for doc_id, text in texts:
        words = (text or "").encode().split()
        runs = brute(words) if doc_id not in (10, 90) else op.periodic(words)
        best = op.strongest(runs) or (None, None, None)
        digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        wanted.append((doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], digest, hashlib.sha256(b" ".join(brute_collapsed(words, runs)) if doc_id not in (10, 90) else b" ".join(op.collapsed(words, runs))).hexdigest()))
    own = [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in found]
    assert sorted(own, key=repr) == sorted(wanted, key=repr)
    by_id = {r.doc_id: r for r in found}
    assert [tuple(run) for run in by_id[90].runs] == [(0, 8000, 2)] and by_id[90].kept_text == "again and"
    assert [tuple(run) for run in by_id[91].runs] == [(0, 24, 1)]
    assert op.periodic_runs(cases.table(spark, [])).collect() == []


def test_planted_words_repeat_by_the_id():
    words = [f"w{i}".encode() for i in range(300)]
    changed = 0
    for doc_id in range(200):
        found = planted_words(doc_id, b" ".join(words))
        assert len(found) == len(words)
        if found != words:
            changed += 1
            assert op.periodic(found) == brute(found)
    assert 8 < changed < 40
    assert planted_words(None, b"a b") == [b"a", b"b"] and planted_words(1, b"") == []
