from __future__ import annotations

import hashlib
import random

import pytest

from ridemill.llm import substring_dedup as op

from . import cases


def brute(texts, length):
    worded = [(d, (t or "").encode().split()) for d, t in texts]
    first = {}
    for d, words in worded:
        if d is not None:
            for i in range(len(words) - length + 1):
                key = tuple(words[i : i + length])
                first[key] = min(first.get(key, d), d)
    result = []
    for d, words in worded:
        gone = {i + k for i in range(len(words) - length + 1) if d is not None and first[tuple(words[i : i + length])] < d for k in range(length)}
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        result.append((d, len(words), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(result, key=repr)


def mosaic(seed, count):
    """Documents glued together from shared passages of all lengths around the threshold."""
    rnd = random.Random(seed)
    passages = [cases.prose(100 + i, rnd.randint(5, 40), 30) for i in range(12)]
    return [(rnd.randint(0, 10_000), " ".join(rnd.choice(passages) if rnd.random() < 0.6 else cases.prose(rnd.random(), 8, 50) for _ in range(rnd.randint(1, 9)))) for _ in range(count)]


@pytest.mark.parametrize("length", [13, 7])
def test_removes_what_windows_cover(spark, length):
    texts = cases.odd_texts() + mosaic(length, 120)
    found = op.substring_dedup(cases.table(spark, texts), length).collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == brute(texts, length)
    for r in found:
        assert sum(s.words for s in r.spans) == r.n_removed
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_hot_passage(spark):
    passage = cases.prose(7, 30)
    texts = [(i, f"{cases.prose(1000 + i, 20)} {passage} {cases.prose(5000 + i, 20)}") for i in range(300)]
    found = op.substring_dedup(cases.table(spark, texts).repartition(8)).collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == brute(texts, 13)


def test_cut_leaves_other_white_space(spark):
    passage = cases.prose(8, 20)
    docs = cases.table(spark, [(1, f"Start.\n\n{passage}\nEnd."), (2, f"  Own\ttext,\n{passage}\nand   its end."), (3, None), (4, "")])
    left = op.cut_repeats(docs)
    assert left.columns == docs.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: f"Start.\n\n{passage}\nEnd.", 2: "  Own\ttext,\nand   its end.", 3: None, 4: ""}


def test_empty_table(spark):
    assert op.substring_dedup(cases.table(spark, [])).collect() == []
    assert op.cut_repeats(cases.table(spark, [])).collect() == []
