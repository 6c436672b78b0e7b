"""How filters act on each other: what each removes in every order, and what others would have removed.

Each filter has a relation of the documents that fail it, stored in buckets of the
document's key.  Left-anti and left-semi joins with the others' relations, bucket by
bucket and without a shuffle, part it by who else would have removed a document.  What
comes before a filter matters only as a set, so the counts of the parts give what it removes
after any set of others, and with that all 120 orders of five filters.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import Buckets, written

WORDS_LEAST = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 3
SYMBOLS = "[#$%&*|]"
#: Rows of a bucket of an id table.
BUCKET_ROWS = 2_000_000


def words_in(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """key, doc_id, part, good, toxic and the failures a, b, c, d, e of every row of `docs`, written once.

    `key` is the id with a digest of the text, so that rows that repeat an id are judged
    each by its own text.  Only a row with an id can repeat a smaller one's text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("body"),
        words_in(text).alias("words"),
    )
    n_words, n_chars = F.size("words"), F.length("body")
    capitals = n_chars - F.length(F.regexp_replace("body", "[A-Z]", ""))
    digest = F.sha2(F.col("body").cast("binary"), 256)
    rows = rows.select(
        F.concat_ws("/", F.col("doc_id").cast("string"), digest).alias("key"),
        "doc_id",
        "part",
        digest.alias("digest"),
        (n_words < WORDS_LEAST).alias("a"),
        (F.lit(100) * F.size(F.array_distinct("words")) < F.lit(DISTINCT_PERCENT) * n_words).alias("b"),
        (F.lit(100) * capitals.cast("long") > F.lit(CAPITALS_PERCENT) * n_chars.cast("long")).alias("c"),
        F.col("body").rlike(SYMBOLS).alias("d"),
    )
    rows = written(rows, "audit-rows")
    # Of equal texts only the least id passes; it is told by its key, so no join meets a hot text.
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL")
    firsts = firsts.select(F.concat_ws("/", F.col("doc_id").cast("string"), "digest").alias("key"), F.lit(False).alias("e"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marked = rows.join(marks, "doc_id", "left").join(firsts, "key", "left")
    return written(
        marked.select(
            "key",
            "doc_id",
            "part",
            *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")),
            *"abcd",
            (F.coalesce("e", F.lit(True)) & F.col("doc_id").isNotNull()).alias("e"),
        ),
        "audit-judged",
    )


def overlaps(failing: dict[str, DataFrame], buckets: int) -> DataFrame:
    """part, filter, others, n, good, toxic: how many rows fail a filter and just the others with a bit in `others`.

    `failing` has for each filter the key, part, good and toxic of the rows that fail it; the bits
    follow its order.  The relations together are parted by one filter after the other: left-semi
    joined with it are the rows that it fails too, left-anti joined those that it does not.
    """
    names = list(failing)
    ids = Buckets(next(iter(failing.values())).sparkSession, "key", buckets)
    try:
        stored = {n: ids.store(rows.select("key", "part", "good", "toxic").repartition(buckets, "key")) for n, rows in failing.items()}
        every = None
        for name, rows in stored.items():
            rows = rows.select("*", F.lit(name).alias("filter"), F.lit(0).alias("others"))
            every = rows if every is None else every.unionAll(rows)
        for bit, name in enumerate(names):
            own, rest, keys = every.where(F.col("filter") == name), every.where(F.col("filter") != name), stored[name].select("key")
            both = rest.join(keys, "key", "left_semi").withColumn("others", F.col("others").bitwiseOR(1 << bit))
            parted = own.unionByName(both).unionByName(rest.join(keys, "key", "left_anti"))
            every = ids.store(parted) if bit + 1 < len(names) else parted
        counts = every.groupBy("part", "filter", "others").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("good"), F.sum(F.col("toxic").cast("long")).alias("toxic")
        )
        return written(counts, "audit-overlaps")
    finally:
        ids.close()


def removals(counts: DataFrame, names: list[str]) -> DataFrame:
    """part, filter, earlier, removed, good, toxic: what a filter removes after each set of others, from `overlaps`."""
    sets = sorted({(step[3], step[4]) for step in orders(names)})
    sets = counts.sparkSession.createDataFrame(sets, "filter string, earlier int")
    rows = counts.join(F.broadcast(sets), "filter").where(F.col("others").bitwiseAND(F.col("earlier")) == 0)
    return rows.groupBy("part", "filter", "earlier").agg(F.sum("n").alias("removed"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def orders(names: list[str]) -> list[tuple]:
    """number, filter_order, step, filter and earlier of each step of each order of the filters."""
    found = []
    for order in permutations(names):
        earlier = 0
        for step, name in enumerate(order):
            found.append((len(found), "".join(order), step + 1, name, earlier))
            earlier |= 1 << names.index(name)
    return found


def audited(totals: DataFrame, counts: DataFrame, names: list[str]) -> DataFrame:
    """The report from `totals` (part, documents) and the counts of `removals`, zeros included."""
    spark = totals.sparkSession
    # One row for each step of each order, whatever the input.
    steps = spark.createDataFrame(orders(names), "number int, filter_order string, step int, filter string, earlier int")
    size = len(orders(names))
    rows = totals.withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(size - 1)))).join(F.broadcast(steps), "number")
    rows = rows.join(counts, ["part", "filter", "earlier"], "left").na.fill(0, ["removed", "good", "toxic"])
    rows = written(rows, "audit-steps")
    everything = (1 << len(names)) - 1
    alone = F.col("earlier") == F.lit(everything) - F.element_at(F.create_map(*(F.lit(x) for n in names for x in (n, 1 << names.index(n)))), F.col("filter"))
    own = rows.groupBy("part", "filter").agg(
        F.sum("removed").alias("shapley"),
        F.max(F.when(F.col("earlier") == 0, F.col("removed"))).alias("fails"),
        F.max(F.when(alone, F.col("removed"))).alias("unique_fails"),
    )
    gone = rows.groupBy("part", "filter_order").agg(F.sort_array(F.collect_list(F.struct("step", "removed"))).alias("gone"))
    so_far = F.aggregate(F.filter("gone", lambda x: x.step <= F.col("step")), F.lit(0).cast("long"), lambda total, x: total + x.removed)
    rows = rows.join(own, ["part", "filter"]).join(gone, ["part", "filter_order"])
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - so_far).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        "shapley",
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters in all their orders: a row for each lang value, order and step.

    A: under 200 words.  B: fewer distinct words than half.  C: capitals in over three per
    cent of the characters.  D: a symbol of `#$%&*|`.  E: equal to a smaller id's text.  A null
    text counts as empty, a null lang as an empty part.  Each row of `docs` counts, repeated
    ones too; a row with a null id never fails E and has no label.  Of repeated labels any
    1 counts.  An empty table gives an empty result.
    """
    rows = judged(docs, labels)
    totals = written(rows.groupBy("part").agg(F.count(F.lit(1)).alias("documents")), "audit-parts")
    count = totals.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    buckets = max(docs.sparkSession.sparkContext.defaultParallelism, -(-count // BUCKET_ROWS))
    counts = overlaps({name.upper(): rows.where(name) for name in "abcde"}, buckets)
    return audited(totals, removals(counts, list("ABCDE")), list("ABCDE"))
