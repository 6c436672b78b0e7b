"""Near-duplicates by SimHash, found at anchor points.

The 64 bits of a fingerprint are two halves.  If two fingerprints differ in at most
three bits, one of their halves differs in one bit at most.  Anchors of a half are
the words of the perfect Hamming code of length 31, with one free bit: any half lies
within one bit of an anchor, its home.  A fingerprint is sent to its home and, as a
visitor, to each anchor within the covering radius plus the threshold, two bits;
so one of each close pair visits the other's home.  There they are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import bodies, in_batches, rows_of, written

SEED = 42
LINK_BITS = 2
#: The halves tell apart pairs of up to so many differing bits.
MOST_BITS = 3
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
#: Odd number that keeps the keys of parts apart.
MIX_PART = 0x9E3779B97F4A7C15
PLACES = np.arange(8, dtype=np.int64) * 256
VALUES = np.uint64(1) << np.arange(64, dtype=np.uint64)


def shingle_hashes(body: bytes | None, words_each: int) -> np.ndarray:
    """XXH64 of each run of `words_each` words, repeats included; of the whole sequence if it is shorter."""
    words = (body or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    text = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[: len(ends) - words_each])]
    digest = xxhash.xxh64_intdigest
    ends = ends[words_each - 1 :] or ends[-1:]
    return np.fromiter((digest(text[a:b], SEED) for a, b in zip(starts, ends, strict=True)), dtype=np.uint64, count=len(ends))


def simhash(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have, as a signed long; 0 for none."""
    if not len(hashes):
        return 0
    cells = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + PLACES).ravel(), minlength=2048).reshape(8, 256)
    over = 2 * (cells @ BYTE_BITS).ravel() > len(hashes)
    return int(VALUES[over].sum(dtype=np.uint64).astype(np.int64))


def fingerprints(docs: DataFrame, words_each: int) -> DataFrame:
    """doc_id and fingerprint of every row; a text without words, or null, has fingerprint 0."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(((d, simhash(shingle_hashes(b, words_each))) for d, b in rows_of(batches)), schema)

    return bodies(docs).mapInArrow(run, "doc_id long, fingerprint long")


def half_anchors(half: int) -> list[int]:
    """Anchors within two bits of 32 bits, the home first."""
    free, low, wrong = 1 << 31, half & 0x7FFFFFFF, 0
    while low:
        bit = low & -low
        wrong ^= bit.bit_length()
        low ^= bit
    if not wrong:
        return [half, half ^ free]
    home = half ^ (1 << (wrong - 1))
    pairs = [half ^ (1 << (i - 1)) ^ (1 << ((i ^ wrong) - 1)) for i in range(1, 32) if i < i ^ wrong]
    return [home, home ^ free, *pairs]


def anchored(codes: DataFrame) -> DataFrame:
    """fingerprint, anchor and is_home: a row for each anchor of each half of each fingerprint."""
    schema = pa.schema([("fingerprint", pa.int64()), ("anchor", pa.int64()), ("is_home", pa.bool_())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (code,) in rows_of(batches):
            for side in (0, 1):
                for place, anchor in enumerate(half_anchors(code >> 32 * side & 0xFFFFFFFF)):
                    yield code, side << 32 | anchor, place == 0

    return codes.select("fingerprint").mapInArrow(lambda batches: in_batches(spread(batches), schema), "fingerprint long, anchor long, is_home boolean")


def close_pairs(codes: DataFrame, bits: int = LINK_BITS) -> DataFrame:
    """a < b: all pairs of distinct fingerprints of `codes` that differ in at most `bits` bits.

    Only fingerprints meet, not documents: copies share one.  A fingerprint has at most
    43,744 others within three bits (2,080 within two), so a hot anchor yields a bounded
    number of pairs for each of its fingerprints, and the join splits it.
    """
    if not 0 <= bits <= MOST_BITS:
        raise ValueError(f"the anchors find pairs of up to {MOST_BITS} differing bits")
    spread = written(anchored(codes), "anchors")
    homes = spread.where("is_home").select("anchor", F.col("fingerprint").alias("a"))
    visitors = spread.select("anchor", F.col("fingerprint").alias("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    return homes.join(visitors, (homes.anchor == visitors.anchor) & near).select("a", "b").distinct()


def simhash_components(docs: DataFrame, words_each: int = 3, bits: int = LINK_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of `docs`.

    component_id is the least doc_id that can be reached over links of at most `bits`
    differing bits, its own included.  Null texts and texts without words have
    fingerprint zero, which links like any other.  Repeated rows keep a row each; a
    null doc_id is never a component's id unless the component has no other.
    """
    rows = written(fingerprints(docs, words_each), "fingerprints")
    codes = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "codes")
    roots = components(close_pairs(codes, bits))
    codes = codes.join(roots, codes.fingerprint == roots.node, "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    ids = codes.groupBy("root").agg(F.min("least").alias("component_id"))
    known = codes.join(ids, "root").select("fingerprint", "component_id")
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return rows.join(known, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")
