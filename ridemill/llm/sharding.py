"""Shards of even row counts that keep linked documents together: balanced label propagation.

Documents with equal texts are linked.  Linked documents start in shards by their
id; in each round a document asks to move to a shard that holds some of its group, at
first the one with most, and as many moves are granted as the quota of that shard has
room for, with the room that documents make which leave it.  Rounds go on until one
does not lower the number of documents in cut groups.  Groups that are cut then leave
as a whole, each shard gives up what exceeds its quota, and free documents fill the
rest group by group, so that counts are at most one apart.  Groups only meet as counts for each shard: a
group that holds a third of the rows is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import BUCKET_ROWS, ranked, written

SHARDS = 8
GROUP = ("text_crc32", "text_hash")


def linked_rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    sizes = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("group_size"))
    return rows.join(sizes, list(GROUP))


def by_shard(rows: DataFrame, column: str, shards: int) -> list[int]:
    """Rows of each shard: as many numbers as there are shards come to the driver."""
    found = dict(rows.groupBy(column).count().collect())
    return [found.get(s, 0) for s in range(shards)]


def chosen(column: str, values: list) -> Column:
    """The value at the place that `column` names."""
    return F.element_at(F.array(*map(F.lit, values)), F.col(column) + 1)


def shares(load: list[int], quota: list[int], flows: dict[tuple[int, int], int]) -> list[float]:
    """The part of the moves into each shard to grant: the largest with which none exceeds its quota.

    flows: moves wanted, by shards from and to.  Moves out make room for moves in.
    """
    shards = range(len(quota))
    into = [sum(n for (_, goal), n in flows.items() if goal == s) for s in shards]
    found = [1.0] * len(quota)
    for _ in range(1000):
        out = [sum(n * found[goal] for (own, goal), n in flows.items() if own == s) for s in shards]
        last, found = found, [min(1.0, max(0.0, (quota[s] - load[s] + out[s]) / into[s])) if into[s] else 0.0 for s in shards]
        if max(abs(x - y) for x, y in zip(last, found, strict=True)) < 1e-9:
            break
    return found


def propagated(members: DataFrame, quota: list[int]) -> DataFrame:
    """`members` with a shard each, after the moves of all rounds; null for groups that are cut but would fit a shard."""
    shards = len(quota)
    spread = F.col("group_size") > min(quota)
    label = F.pmod(F.xxhash64("doc_id", *GROUP), F.lit(shards)).cast("int")
    members = written(members.withColumn("shard", label), "shard-labels")
    turn, before = 0, None
    while True:
        held = members.groupBy(*GROUP, "group_size", "shard").agg(F.count(F.lit(1)).alias("n"))
        # Where the shard with most had no room, a group tries another one that it has.
        rank = F.struct(F.when(spread | F.lit(turn == 0), F.col("n")).otherwise(0), F.xxhash64(F.lit(turn), *GROUP, "shard"), "shard")
        goals = held.groupBy(*GROUP).agg(F.max(rank).getField("shard").alias("goal"), (F.count(F.lit(1)) > 1).alias("cut"))
        asking = members.join(goals, list(GROUP)).withColumn("cut", F.col("cut") & ~spread)
        counts = asking.groupBy("shard", "goal").agg(F.count(F.lit(1)), F.sum(F.col("cut").cast("long"))).collect()
        flows = {(own, goal): n for own, goal, n, _ in counts if own != goal}
        cut = sum(row[3] for row in counts)
        if not flows or (before is not None and cut >= before):
            return asking.withColumn("shard", F.when(~F.col("cut"), F.col("shard"))).drop("goal", "cut")
        load = [sum(row[2] for row in counts if row[0] == s) for s in range(shards)]
        # A group asks as one, save where it exceeds a shard: then document by document.
        draw = F.when(spread, F.xxhash64(F.lit(turn), "doc_id")).otherwise(F.xxhash64(F.lit(turn), *GROUP))
        granted = F.pmod(draw, F.lit(1 << 30)) < chosen("goal", shares(load, quota, flows)) * (1 << 30)
        members = written(asking.withColumn("shard", F.when(granted, F.col("goal")).otherwise(F.col("shard"))).drop("goal", "cut"), "shard-labels")
        turn, before = turn + 1, cut


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of `docs`; counts of shards are at most one apart.

    size is the bytes of the text plus 1; a null text counts as empty.  A group larger
    than a shard fills several; one that finds no room is cut at a shard's end.
    Repeated rows and rows with a null doc_id are rows like any other and get slots of
    their own.  An empty table gives an empty result.
    """
    rows = written(linked_rows(docs), "shard-rows")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    buckets = max(32, total // BUCKET_ROWS)
    salt = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("group_size") / BUCKET_ROWS))
    bucket = F.pmod(F.xxhash64(*GROUP, salt), F.lit(buckets))
    order = [*GROUP, "doc_id", "size"]
    members = written(propagated(rows.where("group_size > 1"), quota), "shard-labels")
    placed, homeless = members.where("shard IS NOT NULL"), members.where("shard IS NULL")
    # In its shard a group has one range of ranks, so that few groups are cut where the quota ends.
    placed = written(ranked(placed, ["shard"], order, bucket, "slot"), "shard-slots")
    stays = F.col("slot") < chosen("shard", quota)
    kept = [min(n, q) for n, q in zip(by_shard(placed, "shard", shards), quota, strict=True)]
    free = placed.where(~stays).drop("shard", "slot").unionByName(homeless.drop("shard")).unionByName(rows.where("group_size = 1")).withColumn("all", F.lit(0))
    # Documents that had to leave come first and stay together; those without links fill up.
    free = ranked(free, ["all"], order, bucket + F.when(F.col("group_size") > 1, 0).otherwise(buckets), "place").drop("all")
    ends, fills = [], []
    for own, most in zip(kept, quota, strict=True):
        fills.append((ends[-1] if ends else 0) - own)
        ends.append((ends[-1] if ends else 0) + most - own)
    shard = sum((F.when(F.col("place") >= F.lit(end), 1).otherwise(0) for end in ends), F.lit(0))
    free = free.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("place") - chosen("shard", fills)).drop("place")
    columns = ["doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot")]
    return placed.where(stays).select(*columns).unionByName(free.select(*columns))
