"""Substring deduplication by seed and extend.

A repeat is a window of consecutive words that also starts in a document with a
smaller id.  Each window has an anchor, the word group in it with the least hash;
equal windows have equal anchors, so documents need only be joined on these.
Neighbouring windows with one anchor form a run, the anchor extended both ways.

1. Runs meet by anchor.  A run that a smaller document has as a whole is repeated
   whole: one comparison settles all its windows.  Where an anchor has different
   runs, which happens where a repeat begins or ends, one document of each run is
   marked for a closer look.
2. The windows of marked runs meet by their own hash; the smallest document wins.
3. Each document drops the words that its repeated windows cover.  Windows that
   follow one another give the maximal repeats.

Runs are told apart by 112 bits of hash, windows of marked runs by 64.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import WHITE_SPACE, Memo, bodies, in_batches, rows_of, small_batches, written

LENGTH = 13
#: Words of an anchor; each window of LENGTH words has LENGTH - ANCHOR + 1 of them.
ANCHOR = 5
STEP = 0xBF58476D1CE4E5B9
MIX = np.uint64(0x9E3779B97F4A7C15)
ANCHOR_BITS = np.uint64((1 << 48) - 1)
#: Size of the filter of runs: eight megabytes.
FILTER_BITS, FILTER_SHIFT = 1 << 26, 26
WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
WORDS = Memo(xxhash.xxh64_intdigest)


@lru_cache(maxsize=4)
def powers(size: int, base: int) -> np.ndarray:
    return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base, np.uint64))))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


class Windows:
    """The windows of one document's words, their anchors and runs."""

    def __init__(self, words: list[bytes], length: int):
        self.length, self.count = length, max(0, len(words) - length + 1)
        if not self.count:
            return
        own = np.fromiter(map(WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
        size = 1 << len(words).bit_length()
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(own * powers(size, STEP)[: len(words)])))
        anchors = mixed(self.span(np.arange(len(words) - ANCHOR + 1), ANCHOR))
        place = np.lib.stride_tricks.sliding_window_view(anchors, length - ANCHOR + 1).argmin(axis=1) + np.arange(self.count)
        self.first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
        self.last = np.concatenate((self.first[1:], [self.count])) - 1
        self.anchor = (anchors[place[self.first]] & ANCHOR_BITS).view(np.int64)
        self.run = mixed(self.span(self.first, self.last - self.first + length)).view(np.int64)

    def span(self, starts: np.ndarray, lengths) -> np.ndarray:
        """A hash of `lengths` words from each start."""
        undo = powers(1 << int(len(self.sums) - 1).bit_length(), pow(STEP, -1, 1 << 64))
        return (self.sums[starts + lengths] - self.sums[starts]) * undo[starts]

    def inside(self, runs: np.ndarray) -> np.ndarray:
        """The starts of all windows of the runs that are chosen."""
        edges = np.zeros(self.count + 1, np.int64)
        np.add.at(edges, self.first[runs], 1)
        np.add.at(edges, self.last[runs] + 1, -1)
        return np.flatnonzero(np.cumsum(edges)[:-1])

    def hashes(self, starts: np.ndarray) -> np.ndarray:
        return mixed(self.span(starts, self.length)).view(np.int64)


def text_runs(docs: DataFrame, length: int) -> DataFrame:
    """anchor, run, doc_id of each run; documents of one batch with the same run share a row and its `others`."""
    schema = pa.schema([("anchor", pa.int64()), ("run", pa.int64()), ("doc_id", pa.int64()), ("others", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, runs, ids = [], [], []
            for doc_id, body in rows_of(iter([batch])):
                own = Windows((body or b"").split(), length)
                if own.count and doc_id is not None:
                    anchors.append(own.anchor)
                    runs.append(own.run)
                    ids.append(np.full(len(own.run), doc_id))
            if not ids:
                continue
            anchor, hashed, doc = map(np.concatenate, (anchors, runs, ids))
            order = np.lexsort((doc, anchor, hashed))
            anchor, hashed, doc = anchor[order], hashed[order], doc[order]
            starts = np.flatnonzero(np.concatenate(([True], (hashed[1:] != hashed[:-1]) | (anchor[1:] != anchor[:-1]))))
            ends = np.concatenate((starts[1:], [len(doc)]))
            others: list = [None] * len(starts)
            for i in np.flatnonzero(ends - starts > 1).tolist():
                others[i] = np.unique(doc[starts[i] + 1 : ends[i]])
            columns = (anchor[starts], hashed[starts], doc[starts], others)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return bodies(docs).mapInArrow(run, "anchor long, run long, doc_id long, others array<long>")


def told_runs(docs: DataFrame, length: int) -> DataFrame:
    """run, doc_id, repeated: runs of a document that a smaller one has whole (repeated), or that need a closer look."""
    runs = text_runs(docs, length)
    anchor, whole = Window.partitionBy("anchor"), Window.partitionBy("anchor", "run")
    runs = runs.withColumns(
        {
            "holder": F.min("doc_id").over(whole),
            "apart": (F.min("run").over(anchor) != F.max("run").over(anchor))
            & (F.min("doc_id").over(anchor) != F.max(F.greatest("doc_id", F.array_max("others"))).over(anchor)),
        }
    )
    told = runs.where(F.col("apart") | (F.col("holder") < F.col("doc_id")) | F.col("others").isNotNull())
    each = F.explode(F.concat(F.array("doc_id"), F.coalesce("others", F.array().cast("array<long>")))).alias("doc_id")
    told = told.select("run", "holder", "apart", each)
    return told.where("apart OR holder < doc_id").select("run", "doc_id", F.expr("holder < doc_id").alias("repeated"))


def run_filter(runs: DataFrame) -> np.ndarray:
    """A Bloom filter of the runs, of FILTER_BITS bits for any input."""
    places = F.expr(f"array(run & {FILTER_BITS - 1}, shiftrightunsigned(run, {FILTER_SHIFT}) & {FILTER_BITS - 1})")
    places = runs.select(F.explode(places).alias("place"))
    bits = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    found = places.groupBy((F.col("place") / 64).cast("long").alias("word")).agg(F.bit_or(bits).alias("bits")).toArrow()
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words


def may_hold(words: np.ndarray, runs: np.ndarray) -> np.ndarray:
    def bit(places: np.ndarray) -> np.ndarray:
        return words[places >> 6] >> (places & 63) & 1

    mask = FILTER_BITS - 1
    return (bit(runs & mask) & bit((runs.view(np.uint64) >> np.uint64(FILTER_SHIFT)).astype(np.int64) & mask)).astype(bool)


def repeated_windows(docs: DataFrame, closer: DataFrame, length: int) -> DataFrame:
    """doc_id and `windows`: hashes of windows in the runs `closer` that start in a smaller document too.

    Documents are scanned again; a filter of fixed size tells which windows to send.
    The more runs it holds, the more windows it lets pass beyond those; it misses none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64())])
    known = docs.sparkSession.sparkContext.broadcast(run_filter(closer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for doc_id, body in rows_of(iter([batch])):
                own = Windows((body or b"").split(), length)
                if own.count and doc_id is not None and (chosen := may_hold(known.value, own.run)).any():
                    hashes.append(own.hashes(own.inside(chosen)))
                    ids.append(np.full(len(hashes[-1]), doc_id))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(hashes))], schema=schema)

    windows = written(bodies(docs).mapInArrow(run, "doc_id long, hash long"), "windows")
    holders = windows.groupBy("hash").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("latest")).where("holder < latest")
    found = windows.join(holders, "hash").where("holder < doc_id")
    return found.groupBy("doc_id").agg(F.collect_set("hash").alias("windows"))


def repeats(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, `repeated` (runs) and `windows` (hashes) of documents that have any: what is to be removed from them."""
    with small_batches(docs.sparkSession):
        told = written(told_runs(docs, length), "runs")
        windows = repeated_windows(docs, told.where("NOT repeated"), length)
    whole = told.where("repeated").groupBy("doc_id").agg(F.collect_set("run").alias("repeated"))
    return whole.join(windows, "doc_id", "full")


def removed(words: list[bytes], length: int, repeated: list[int] | None, windows: list[int] | None) -> np.ndarray:
    """For each word whether it goes."""
    edges = np.zeros(len(words) + 1, np.int64)
    if repeated or windows:
        own = Windows(words, length)
        gone = np.zeros(own.count, bool)
        if repeated:
            gone[own.inside(np.isin(own.run, np.array(repeated, np.int64)))] = True
        if windows:
            gone |= np.isin(own.hashes(np.arange(own.count)), np.array(windows, np.int64))
        starts = np.flatnonzero(gone)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + length, -1)
    return np.cumsum(edges)[:-1] > 0


def substring_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans and kept_text of every row of `docs`.

    A word goes if a window of `length` words that covers it also starts in a document
    with a smaller doc_id; all windows are those of the input.  spans are the maximal
    runs of removed words (start, words); kept_text is the kept words joined by spaces.
    Null and short texts lose nothing; a null doc_id is neither smaller nor larger, so
    its row neither loses nor takes words; rows that repeat a doc_id are the same
    document and get a row each.  An empty table gives an empty result.
    """
    rows = bodies(docs).join(repeats(docs, length), "doc_id", "left")
    span = pa.struct([("start", pa.int64()), ("words", pa.int64())])
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(span)), ("kept_text", pa.string())]
    schema = pa.schema(fields)

    def kept(doc_id, body, repeated, windows) -> tuple:
        words = (body or b"").split()
        covered = removed(words, length, repeated, windows)
        turns = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8))).reshape(-1, 2)
        spans = [{"start": a, "words": b - a} for a, b in turns.tolist()]
        left = [w for w, c in zip(words, covered.tolist(), strict=True) if not c] if spans else words
        text = b" ".join(left)
        return doc_id, len(words), len(words) - len(left), hashlib.sha256(text).hexdigest(), spans, text.decode("utf-8", "replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from in_batches((kept(*row) for row in rows_of(iter([batch]))), schema, 1024)

    columns = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, words: long>>, kept_text string"
    return rows.mapInArrow(run, columns)


def cut_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of `docs`, all their columns, texts without the words that `substring_dedup` removes.

    A word goes with the white space after it; other texts, null ones too, stay as they
    are.  `n_chars`, where it is a column, follows the text.
    """
    at, counted = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    names = docs.columns
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = rows.join(repeats(docs, length), "doc_id", "left").select("row", "repeated", "windows")

    def cut(text: str | None, repeated: list[int] | None, windows: list[int] | None) -> str | None:
        if text is None or not (repeated or windows):
            return text
        parts = WORD.findall(text.encode())
        gone = removed([p.rstrip(WHITE_SPACE) for p in parts], length, repeated, windows)
        lead = text[: len(text) - len(text.lstrip(WHITE_SPACE.decode()))]
        return lead + b"".join(p for p, g in zip(parts, gone.tolist(), strict=True) if not g).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column(0).flatten()
            texts = list(map(cut, columns[at].to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            columns[at] = pa.array(texts, columns[at].type)
            if counted is not None:
                lengths = [n if t is None else len(t) for n, t in zip(columns[counted].to_pylist(), texts, strict=True)]
                columns[counted] = pa.array(lengths, columns[counted].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, docs.schema)
