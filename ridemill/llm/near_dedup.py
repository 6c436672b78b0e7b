"""One document of each group of near-duplicates, found by SimHash and confirmed by similarity.

The similarity of two documents is that of their sets of word shingles (Jaccard).
At 0.8 whole-document fingerprints differ in ten bits and more, far beyond what
anchors reach.  Therefore a document also has fingerprints of small parts: its
shingles are dealt into groups by their hash, a handful to each, and each of the
first PARTS groups gets a SimHash of its own.  Similar documents have equal groups
among these: a group of g shingles stays whole with probability 0.8 ** g.
Documents that share a part's fingerprint, or whose whole fingerprints are linked,
are candidates; candidates are compared exactly.  Before their texts meet, their marks
do: the parities of their shingles by place, in which two documents cannot differ more
often than their sets do.  Only pairs whose marks allow the similarity are gathered.

Groups may all differ, and not every pair of a bucket is compared.  So what these
leave unconnected goes by an exact rule: of n shingles a similar document has all but
a fifth, so two similar documents share one of the first n / 5 + 1 in any order
common to all documents.  The order puts shingles of hot passages last; every pair
that shares such a shingle, can reach the similarity and is not connected is compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import Memo, Scratch, bodies, in_batches, rows_of, small_batches, written
from .simhash import MIX_PART, MOST_BITS, close_pairs, shingle_hashes, simhash

WORDS_EACH = 5
SIMILARITY = 0.8
PARTS = 24
#: Shingles of a group: from this number to twice it.
GROUP_SHINGLES = 3
#: Counters that order the shingles: four megabytes for any input.  Equal counters cost candidates, never links.
COUNTERS = 1 << 20
#: Places of the least mark.
LEAST_PLACES = 64
#: First shingles meet in so many jobs one after the other, each with the shuffle files of its share only.
SLICES = 2


def part_fingerprints(hashes: np.ndarray, similarity: float) -> np.ndarray:
    """A key for each group of the document's distinct shingle hashes.

    The number of groups is a power of two that follows the number of shingles.  Where
    a similar document may have the next power, the groups of both are given.
    """
    found = [np.empty(0, np.uint64)]
    level = max(0.0, np.log2(max(1, len(hashes)) / GROUP_SHINGLES))
    for power in {int(level), int(level - np.log2(similarity))}:
        groups = hashes & np.uint64((1 << power) - 1)
        own = np.flatnonzero(groups < PARTS)
        if not len(own):
            continue
        own = own[np.argsort(groups[own], kind="stable")]
        numbers, starts, sizes = np.unique(groups[own], return_index=True, return_counts=True)
        # The SimHash of each group: the bits that over half of its hashes have.
        bits = np.unpackbits(hashes[own].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        over = 2 * np.add.reduceat(bits, starts, axis=0, dtype=np.int64) > sizes[:, None]
        codes = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
        found.append(codes ^ (numbers + np.uint64(power * PARTS + 1)) * np.uint64(MIX_PART))
    return np.concatenate(found).view(np.int64)


def mark(hashes: np.ndarray) -> bytes:
    """For each place, by the low bits of the distinct `hashes`, whether an odd number of them is there.

    The places are a power of two, one for each hash at least; the halves of a mark, added up, are that of half its places.
    """
    places = max(LEAST_PLACES, 1 << max(0, len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_be_similar(size: int, own: bytes, other_size: int, other: bytes) -> bool:
    """Whether sets of these sizes and marks can have a similarity of SIMILARITY: never False for sets that have it."""
    short, long = sorted((own, other), key=len)
    folded = np.bitwise_xor.reduce(np.frombuffer(long, np.uint8).reshape(-1, len(short)), axis=0)
    # Of what only one of the two sets has, each one changes the parity of one place.
    apart = max(abs(size - other_size), int(np.bitwise_count(folded ^ np.frombuffer(short, np.uint8)).sum()))
    return apart * (1 + SIMILARITY) <= (size + other_size) * (1 - SIMILARITY) + 1e-6


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, `parts`, and number of shingles with their `mark`, of every document with a word and an id."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64()), ("parts", pa.list_(pa.int64())), ("size", pa.int32()), ("mark", pa.binary())])

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, body in rows_of(batches):
            hashes = shingle_hashes(body, WORDS_EACH)
            if doc_id is not None and len(hashes):
                own = np.unique(hashes)
                yield doc_id, simhash(hashes), part_fingerprints(own, SIMILARITY), len(own), mark(own)

    return bodies(docs).mapInArrow(lambda b: in_batches(sketches(b), schema), "doc_id long, fingerprint long, parts array<long>, size int, mark binary")


def possible(marks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those `pairs` (a, b: doc_ids) that may be similar by their `marks` (doc_id, size, mark)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for a, b, *sketches in rows_of(batches):
            if may_be_similar(*sketches):
                yield a, b

    pairs = pairs.join(marks.select(F.col("doc_id").alias("a"), "size", "mark"), "a")
    pairs = pairs.join(marks.select(F.col("doc_id").alias("b"), F.col("size").alias("other_size"), F.col("mark").alias("other_mark")), "b")
    columns = pairs.select("a", "b", "size", "mark", "other_size", "other_mark")
    return columns.mapInArrow(lambda batches: in_batches(similar(batches), schema), "a long, b long").distinct()


def confirmed(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those `pairs` (a, b: doc_ids) whose shingle sets have a similarity of SIMILARITY or more."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        sets = Memo(lambda body: np.unique(shingle_hashes(body, WORDS_EACH)), most=64)  # one text often has many pairs in a row
        for a, b, one, other in rows_of(batches):
            left, right = sets[one], sets[other]
            both = len(np.intersect1d(left, right, assume_unique=True))
            if both >= SIMILARITY * (len(left) + len(right) - both):
                yield a, b

    pairs = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("body").alias("one")), "a")
    pairs = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("body").alias("other")), "b")
    columns = pairs.select("a", "b", "one", "other")
    return columns.mapInArrow(lambda batches: in_batches(similar(batches), schema), "a long, b long")


def counters(docs: DataFrame) -> np.ndarray:
    """How often shingles fall on each of COUNTERS places."""
    schema = pa.schema([("place", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(COUNTERS, np.int64)
        for (body,) in rows_of(batches):
            np.add.at(found, np.unique(shingle_hashes(body, WORDS_EACH)) & np.uint64(COUNTERS - 1), 1)
        places = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(found[places])], schema=schema)

    counts = bodies(docs).select("body").mapInArrow(count, "place int, n long")
    counts = counts.groupBy("place").agg(F.least(F.sum("n"), F.lit(2**31 - 1)).cast("int").alias("n")).toArrow()
    found = np.zeros(COUNTERS, np.int32)
    found[counts["place"].to_numpy()] = counts["n"].to_numpy()
    return found


def first_shingles(docs: DataFrame) -> DataFrame:
    """bucket, doc_id, size, left: the shingles of which a similar document must have one.

    `size` are the document's distinct shingles, `left` those from this one on.
    """
    schema = pa.schema([("bucket", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()), ("left", pa.int32())])
    known = docs.sparkSession.sparkContext.broadcast(counters(docs))

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, body in rows_of(iter([batch])):
                hashes = np.unique(shingle_hashes(body, WORDS_EACH))
                if doc_id is None or not len(hashes):
                    continue
                size = len(hashes)
                most = size - int(np.ceil(SIMILARITY * size - 1e-6)) + 1
                order = np.lexsort((hashes, known.value[hashes & np.uint64(COUNTERS - 1)]))[:most]
                columns = (hashes[order].view(np.int64), np.full(most, doc_id), np.full(most, size), size - np.arange(most))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return bodies(docs).mapInArrow(firsts, "bucket long, doc_id long, size int, left int")


def open_pairs(firsts: DataFrame, links: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """a, b: all pairs that `links` do not connect and that may be similar by their first shingles; and the table they are read from."""
    roots = components(links)
    rows = firsts.join(roots, firsts.doc_id == roots.node, "left").select("bucket", "doc_id", "size", "left", F.coalesce("root", "doc_id").alias("group"))
    every = scratch.written(rows, "near-firsts")
    rows = scratch.written(every.join(in_several(every, "group"), "bucket"), "near-firsts")
    scratch.drop(every)
    others = rows.select("bucket", *(F.col(c).alias(f"other_{c}") for c in ("doc_id", "size", "left", "group")))
    # At the first shingle that two documents share, no more than what is left of both can be equal.
    enough = F.least("left", "other_left") >= SIMILARITY / (1 + SIMILARITY) * (F.col("size") + F.col("other_size")) - 1e-6
    pairs = rows.join(others, (rows.bucket == others.bucket) & (F.col("doc_id") < F.col("other_doc_id")) & (F.col("group") != F.col("other_group")) & enough)
    return pairs.select(F.col("doc_id").alias("a"), F.col("other_doc_id").alias("b")).distinct(), rows


def near_links(docs: DataFrame) -> DataFrame:
    """a, b: pairs of similar documents that connect each group of near-duplicates.

    In each pass the documents of a bucket (equal part fingerprint, linked whole
    fingerprints, or an equal first shingle) that are not connected yet are compared
    with one of them, another one in each pass; passes go on until one finds nothing
    new.  So large groups are connected without all their pairs.  What is left then is
    settled pair by pair, all members of each group with those of the others.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.written(sketched(docs), "sketches")
    codes = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    whole = components(close_pairs(codes, MOST_BITS))
    whole = rows.join(whole, rows.fingerprint == whole.node, "left").select("doc_id", F.xxhash64(F.lit(0), F.coalesce("root", "fingerprint")).alias("bucket"))
    every = scratch.written(first_shingles(docs), "near-firsts")
    slices = [every.where(F.pmod("bucket", F.lit(SLICES)) == i) for i in range(SLICES)]
    slices = [scratch.written(own.join(in_several(own, "doc_id"), "bucket"), "near-firsts") for own in slices]
    firsts = reduce(DataFrame.unionByName, slices)
    scratch.drop(every)
    buckets = rows.select("doc_id", F.explode("parts").alias("bucket")).unionByName(whole).unionByName(firsts.select("doc_id", "bucket"))
    now = unfinished(buckets.withColumn("group", F.col("doc_id")), scratch)
    marks = scratch.written(rows.select("doc_id", "size", "mark").join(now.select("doc_id").distinct(), "doc_id", "left_semi").distinct(), "near-marks")
    scratch.drop(rows)
    # Only texts that have a candidate are compared; they are gathered once.
    texts = scratch.written(bodies(docs).join(now.select("doc_id").distinct(), "doc_id", "left_semi"), "near-texts")
    links = tried = docs.sparkSession.createDataFrame([], "a long, b long")
    turn = 0
    while True:
        draw = F.xxhash64(F.lit(turn), "bucket", "doc_id")
        chosen = now.groupBy("bucket").agg(F.min_by(F.struct("doc_id", "group"), draw).alias("one"))
        pairs = now.join(chosen, "bucket").where("group != one.group")
        ends = (F.least(F.struct("doc_id", "group"), "one").alias("low"), F.greatest(F.struct("doc_id", "group"), "one").alias("high"))
        pairs = pairs.select(*ends).select(F.col("low.doc_id").alias("a"), F.col("high.doc_id").alias("b"), F.col("low.group").alias("ga"), F.col("high.group").alias("gb"))
        pairs = scratch.written(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "near-pairs")
        near = scratch.written(possible(marks, pairs.select("a", "b")), "near-possible")
        new = written(confirmed(texts, near), "near-links")
        scratch.drop(near)
        tried = tried.unionByName(pairs.select("a", "b"))
        if new.isEmpty():
            break
        links = links.unionByName(new)
        joined = pairs.join(new, ["a", "b"], "left_semi").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
        roots = components(joined)
        moved = now.join(roots, now["group"] == roots.node, "left")
        before, now = now, unfinished(moved.select("bucket", "doc_id", F.coalesce("root", "group").alias("group")), scratch)
        scratch.drop(before)
        turn += 1
    scratch.drop(now)
    pairs, read = open_pairs(firsts, links, scratch)
    scratch.drop(*slices)
    rest = scratch.written(possible(marks, pairs.join(tried, ["a", "b"], "left_anti")), "near-pairs")
    scratch.drop(read)
    links = links.unionByName(written(confirmed(texts, rest), "near-links"))
    # What is left of the scratch are the texts and the pairs; the links are tables of their own.
    scratch.drop(*scratch.paths)
    return links


def in_several(rows: DataFrame, by: str) -> DataFrame:
    """The buckets that have more than one value of `by`."""
    return rows.groupBy("bucket").agg(F.min(by).alias("low"), F.max(by).alias("high")).where("low < high").select("bucket")


def unfinished(buckets: DataFrame, scratch: Scratch) -> DataFrame:
    """bucket, group, doc_id: one document of each group in each bucket that has more groups than one."""
    every = scratch.written(buckets.groupBy("bucket", "group").agg(F.min("doc_id").alias("doc_id")), "near-buckets")
    rows = scratch.written(every.join(in_several(every, "group"), "bucket"), "near-buckets")
    scratch.drop(every)
    return rows


def near_dedup(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all their columns, that stay: of each group of similar documents the one with the least id.

    Documents without words, null texts and null ids are never similar to another.
    Rows that repeat a doc_id stay or go together.  An empty table gives an empty result.
    """
    with small_batches(docs.sparkSession):
        links = near_links(docs)
    gone = components(links).where("node != root").select(F.col("node").alias("gone_id"))
    # Inside a struct, columns of `docs` cannot clash with those of the join.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("row_id"))
    return rows.join(gone, F.col("row_id") == F.col("gone_id"), "left_anti").select("row.*")
