from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from ridemill.llm import exact_dedup as op

from . import cases


def brute(texts):
    groups = defaultdict(list)
    for d, t in texts:
        groups[t or ""].append(d)
    result = []
    for d, t in texts:
        known = [x for x in groups[t or ""] if x is not None]
        keep = max(known) if known else None
        result.append((d, keep, len(groups[t or ""]), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(result, key=repr)


@pytest.mark.parametrize("primes", [op.PRIMES, (2, 3)], ids=["usual", "collisions"])
def test_groups_of_equal_texts(spark, primes):
    texts = cases.odd_texts() + [(100 + i, f"{i % 7:03d}") for i in range(40)]
    found = op.exact_groups(cases.table(spark, texts), primes).collect()
    assert sorted(map(tuple, found), key=repr) == brute(texts)


def test_fingerprints_compose():
    rnd = random.Random(4)
    for size in (0, 1, 4095, 4096, 4097, 50_000):
        text = rnd.randbytes(size)
        for prime in op.PRIMES:
            whole = op.fingerprint(text, prime, op.powers(prime))
            assert whole == sum(b * pow(op.BASE, size - 1 - i, prime) for i, b in enumerate(text)) % prime
            cut = size // 3
            parts = [op.fingerprint(p, prime, op.powers(prime)) for p in (text[:cut], text[cut:])]
            assert whole == op.joined(*parts, size - cut, prime)


def test_dedup_keeps_all_columns_of_the_rows_that_stay(spark):
    texts = cases.odd_texts()
    docs = cases.table(spark, texts)
    left = op.exact_dedup(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((r[0] for r in brute(texts) if r[3]), key=repr)


def test_empty_table(spark):
    assert op.exact_groups(cases.table(spark, [])).collect() == []
    assert op.exact_dedup(cases.table(spark, [])).collect() == []


def test_repeated_ids_go_by_their_own_text_and_names_may_clash(spark):
    rows = [(5, "a", 1, "x"), (5, "b", 2, "x"), (7, "b", 3, "x"), (7, "b", 3, "x"), (None, None, 4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id int, kept_text string")
    assert sorted(op.exact_dedup(docs).collect(), key=repr) == sorted(docs.where("kept_id != 2").collect(), key=repr)


def test_grouping_takes_no_texts_back_from_the_tasks(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 3}" if i else None) for i in range(2_000)], "doc_id long, text string").coalesce(1)
    asked, made = [], op.fingerprints

    def noting(rows, *more, **named):
        found = made(rows, *more, **named)
        asked.append(found.columns)
        return found

    monkeypatch.setattr(op, "fingerprints", noting)
    groups = {r.group_size for r in op.exact_groups(docs).collect()}
    assert groups == {1, 666, 667}
    assert "body" not in asked[0] and "body" in asked[1]
