"""Quality of texts by a logistic regression over hashed word n-grams.

A text's features are its words and pairs of neighbouring words, hashed to places of one
weight each; the roots of their counts are scaled to a vector of length one.  The weights are learned by
follow-the-regularised-leader updates (per-coordinate rates, l1 and l2), in blocks of
the training rows: each block goes on from the common state, and each coordinate takes the
mean of what the blocks that met it changed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import Buckets, Memo, bodies, in_batches, rows_of, written

#: Words, and runs of other signs: signs that stand at a word make a pair with it.
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x09-\x0d\x20]+")
BITS = 18
BIAS = 1 << BITS
ALPHA, BETA, L1, L2 = 5.0, 1.0, 0.02, 0.0
#: Rounds of all blocks, and passes of a block over its rows in each.
ROUNDS, PASSES = 3, 2
#: Labelled rows that are learned from, about: the labels with the least hashes of their ids, from all of the table.
SAMPLE = 20_000
BLOCKS = 8
#: A text is judged good from this score on.
GOOD_FROM = 0.3
#: Changes are summed as whole multiples of 1 / STEPS, so that their sum is the same in any order.
STEPS = float(1 << 32)
#: The pair of any word with itself is one n-gram, so that it is known for words never met.
TWICE = np.uint64(0xA24BAED4963EE407)
PAIR, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def token_hashes() -> Memo:
    return Memo(lambda token: xxhash.xxh64_intdigest(token), most=300_000)


def features(body: bytes, hashes: Memo) -> tuple[np.ndarray, np.ndarray]:
    """The places of a text's n-grams, each once, and how often each stands in it."""
    tokens = TOKEN.findall(body)
    single = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    pairs = np.where(single[:-1] == single[1:], TWICE, (single[:-1] * PAIR) ^ (single[1:] + PAIR))
    grams = np.concatenate((single, pairs))
    places, counts = np.unique((grams * SPREAD) >> np.uint64(64 - BITS), return_counts=True)
    return places.astype(np.int32), counts.astype(np.int32)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Roots of the counts, over their length: a vector of length one, or empty."""
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that the state (z, n) stands for."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def chance(total: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def follow(z: np.ndarray, n: np.ndarray, rows: Iterator[tuple[np.ndarray, np.ndarray, int]]) -> None:
    """One update of the state for each row (places, values, label), in their order."""
    for places, values, label in rows:
        places, values = np.append(places, BIAS), np.append(values, np.float32(1))
        own, squares = weights(z[places], n[places]), n[places]
        gradient = (chance(own @ values) - label) * values
        rates = (np.sqrt(squares + gradient**2) - np.sqrt(squares)) / ALPHA
        z[places] += gradient - rates * own
        n[places] = squares + gradient**2


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """block, turn, label, places and counts of the rows to learn from.

    A label is 0 or 1; ids whose labels differ teach nothing.  Of repeated ids one text, the one
    with the least hash, is learned.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled"))
    known = known.agg(F.min("quality").alias("label"), F.max("quality").alias("most")).where("label = most").drop("most")
    drawn = F.pmod(F.xxhash64("labelled"), F.lit(1 << 30))
    rows = known.count()
    # The drawn ids are bounded by `sample`, whatever the tables are, so they go to the texts.
    known = written(known.where(drawn < int((1 << 30) * min(1.0, sample / max(1, rows)))), "quality-labels")
    texts = bodies(docs).where("body IS NOT NULL").join(F.broadcast(known), F.col("doc_id") == F.col("labelled"))
    texts = texts.groupBy("doc_id", "label").agg(F.min_by("body", F.struct(F.xxhash64("body"), "body")).alias("body"))
    schema = pa.schema([("block", pa.int32()), ("turn", pa.int64()), ("label", pa.int32()), ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        hashes = token_hashes()
        for doc_id, label, body in rows_of(batches):
            turn = xxhash.xxh64_intdigest(str(doc_id).encode(), 1) >> 1
            yield turn % BLOCKS, turn, label, *features(body, hashes)

    return texts.mapInArrow(lambda b: in_batches(run(b), schema, 256), "block int, turn long, label int, places array<int>, counts array<int>")


def block_update(state: Broadcast) -> Callable[[pa.Table], pa.Table]:
    """What a block of rows changes in the state, at the places it meets."""
    schema = pa.schema([("place", pa.int32()), ("dz", pa.int64()), ("dn", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        before_z, before_n = state.value
        z, n = before_z.copy(), before_n.copy()
        rows = table.sort_by([("turn", "ascending")]).select(["places", "counts", "label"]).to_batches(256)
        for _ in range(PASSES):
            follow(z, n, ((np.array(p, np.int64), scaled(np.array(c)), label) for p, c, label in rows_of(iter(rows))))
        met = np.flatnonzero((n != before_n) | (z != before_z))
        changes = (np.rint((after[met] - before[met]) * STEPS).astype(np.int64) for after, before in ((z, before_z), (n, before_n)))
        return pa.Table.from_arrays([pa.array(met, pa.int32()), *map(pa.array, changes)], schema=schema)

    return run


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """The weights, the bias last; all are 0 where nothing can be learned."""
    spark = docs.sparkSession
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
    stored = Buckets(spark, "block", BLOCKS)
    try:
        # All rounds read the blocks from where they are stored; none shuffles them again.
        rows = stored.store(training_rows(docs, labels, sample).repartition(BLOCKS, "block"))
        for _ in range(rounds):
            now = spark.sparkContext.broadcast((z, n))
            # A block holds a share of the bounded sample; the state has one entry for each place.
            changed = rows.groupBy("block").applyInArrow(block_update(now), "place int, dz long, dn long")
            sums = changed.groupBy("place").agg(F.sum("dz").alias("dz"), F.sum("dn").alias("dn"), F.count(F.lit(1)).alias("blocks")).toArrow()
            places, blocks = sums["place"].to_numpy(), sums["blocks"].to_numpy()
            z[places] += sums["dz"].to_numpy() / STEPS / blocks
            n[places] = np.maximum(0, n[places] + sums["dn"].to_numpy() / STEPS / blocks)
            now.unpersist()
    finally:
        stored.close()
    return weights(z, n)


def quality_scores(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score (0 to 1, higher: good is likelier) and predicted (1 from GOOD_FROM on) of every row of `docs`.

    A score is a sparse dot product over the whole text.  A null text and one without words have
    no features: their score is that of the bias.  Repeated rows and null ids are scored each for
    itself; an empty table gives an empty result.
    """
    known = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        own, hashes = known.value, token_hashes()
        for doc_id, body in rows_of(batches):
            places, counts = features(body or b"", hashes)
            score = chance(float(own[places] @ scaled(counts)) + float(own[BIAS]))
            yield doc_id, score, int(score >= GOOD_FROM)

    return bodies(docs).mapInArrow(lambda batches: in_batches(run(batches), schema), "doc_id long, score double, predicted int")
