from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import pytest

from ridemill.llm import filter_audit as op

from . import cases

LABELS = "doc_id long, quality int, toxic int, part string, key string"


def brute(rows, labels):
    """`rows`: doc_id, text, lang."""
    rows = [(d, t or "", lang or "") for d, t, lang in rows]
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, x in labels if x == 1 and d is not None}
    judged = []
    for d, text, part in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        fails = ""
        fails += "A" if len(words) < 200 else ""
        fails += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
        fails += "D" if re.search("[#$%&*|]", text) else ""
        fails += "E" if d is not None and any(t == text and x is not None and x < d for x, t, _ in rows) else ""
        judged.append((part, fails, d in good, d in toxic))
    found = {}
    shapley = Counter()
    for part in {p for p, *_ in judged}:
        own = [j for j in judged if j[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, name in enumerate(order):
                gone = [j for j in left if name in j[1]]
                left = [j for j in left if name not in j[1]]
                redundant = sum(name in j[1] for j in own) - len(gone)
                unique = sum(j[1] == name for j in own)
                found[part, order, step + 1] = [len(left), len(gone), redundant, unique, sum(j[2] for j in gone), sum(j[3] for j in gone)]
                shapley[part, name] += len(gone)
    return {(*key, *values, shapley[key[0], key[1][key[2] - 1]]) for key, values in found.items()}


def result(df):
    names = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def rows_with_failures():
    long = cases.prose(5, 260, vocabulary=3000)
    rows = [(d, t, lang) for (d, t), lang in zip(cases.odd_texts(), ["en", "fr", None, ""] * 4, strict=True)]
    rows += [(100 + i, long + f" n{i}", "en") for i in range(4)] + [(110, long.upper(), "en"), (111, long + " #", "fr"), (112, long + " #", "en"), (None, long + " #", "en")]
    rows += [(113, "again and again " * 100, "en"), (114, "again and again " * 100, "de"), (3, "again and again " * 100, "de"), (114, long + " n0", "de")]
    return rows


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (6, 1, 1), (6, 0, None), (7, None, 1), (112, 1, 0), (113, 1, 1), (None, 1, 1), (999, 1, 1)]])
def test_every_order_equals_brute_force(spark, labels):
    rows = rows_with_failures()
    docs = spark.createDataFrame([(d, t, lang, "x", True, 1, 5) for d, t, lang in rows], "doc_id long, text string, lang string, key string, good boolean, step int, n long")
    known = spark.createDataFrame([(*x, "p", "k") for x in labels], LABELS)
    assert result(op.filter_audit(docs, known)) == brute(rows, labels)


def test_no_id_table_stays(spark):
    before = {t.name for t in spark.catalog.listTables()}
    docs = spark.createDataFrame([(1, "a # b", "en")], "doc_id long, text string, lang string")
    found = result(op.filter_audit(docs, spark.createDataFrame([], LABELS)))
    assert len(found) == 600 and ("en", "ABCDE", 1, 0, 1, 0, 0, 0, 0, 60) in found
    assert {t.name for t in spark.catalog.listTables()} == before


def test_the_id_tables_meet_without_a_shuffle(spark):
    ids = op.Buckets(spark, "key", 4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        stored = [ids.store(spark.range(1000 * (i + 1)).selectExpr("cast(id as string) AS key").repartition(4, "key")) for i in range(2)]
        for kind, wanted in (("left_anti", 1000), ("left_semi", 1000)):
            joined = stored[1].join(stored[0], "key", kind)
            assert joined.count() == wanted
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        ids.close()


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert op.filter_audit(none, spark.createDataFrame([], LABELS)).collect() == []
