from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from ridemill.llm import sharding as op

from . import cases


def check(texts, rows, shards=8):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))


def test_even_counts_and_few_cut_links(spark):
    texts = [(i, f"copy {i // 4}" if i < 400 else f"single {i}") for i in range(1003)]
    rows = op.balanced_shards(cases.table(spark, texts)).collect()
    check(texts, rows)
    shards = defaultdict(set)
    for r in rows:
        shards[texts[r.doc_id][1]].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 12


def test_a_group_beyond_a_shard_fills_several(spark):
    texts = [(i, None if i % 3 == 0 else f"text {i}") for i in range(900)]
    rows = op.balanced_shards(cases.table(spark, texts).repartition(5)).collect()
    check(texts, rows)
    held = Counter(r.shard for r in rows if texts[r.doc_id][1] is None)
    assert len(held) <= 8 and sum(held.values()) == 300


def test_few_rows_and_nulls(spark):
    for texts in ([(1, "a"), (2, "a"), (3, None)], [(5, "x")] * 9):
        check(texts, op.balanced_shards(cases.table(spark, texts)).collect())
    rows = op.balanced_shards(cases.table(spark, [(None, "a"), (None, "a"), (4, "b")])).collect()
    assert Counter((r.shard, r.slot) for r in rows).most_common(1)[0][1] == 1
    assert op.balanced_shards(cases.table(spark, [])).collect() == []


def test_runs_without_python(spark):
    import io
    from contextlib import redirect_stdout

    shown = io.StringIO()
    with redirect_stdout(shown):
        op.balanced_shards(cases.table(spark, [(1, "a"), (2, "a")])).explain()
    assert "Python" not in shown.getvalue() and "Arrow" not in shown.getvalue()


def test_copies_only_keep_together(spark):
    for n in (4000, 4003):
        texts = [(i, f"copy {i // 4}") for i in range(n)]
        rows = op.balanced_shards(cases.table(spark, texts)).collect()
        check(texts, rows)
        shards = defaultdict(set)
        for r in rows:
            shards[texts[r.doc_id][1]].add(r.shard)
        assert sum(len(s) > 1 for s in shards.values()) <= 24
