"""Exact deduplication by composable polynomial fingerprints.

A text's fingerprint is its value as a polynomial over its bytes, modulo two
primes.  The fingerprint of two joined parts follows from those of the parts and
the length of the second (`joined`), so a huge text is hashed in chunks.  Texts
with one fingerprint and one length are then compared chunk by chunk: of each chunk
the least and the greatest are kept as the texts stream by, and must be the same.
Only where they are not, each text is compared with the one that stays, and what
differs forms new groups, until nothing differs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import bodies, in_batches, parts_of, rows_of, small_batches, written

PRIMES = (2147483647, 2147483629)
BASE = 1_000_003
CHUNK = 4096
#: Bytes of a text that are compared at once.
COMPARED = 65_536
KEY = ("fp1", "fp2", "n_bytes", "split")


def joined(left: int, right: int, right_length: int, prime: int) -> int:
    """The fingerprint of two texts one after the other, from theirs."""
    return (left * pow(BASE, right_length, prime) + right) % prime


def powers(prime: int, count: int = CHUNK) -> np.ndarray:
    found = [1]
    for _ in range(count - 1):
        found.append(found[-1] * BASE % prime)
    return np.array(found[::-1], dtype=np.uint64)


def fingerprint(text: bytes, prime: int, falling: np.ndarray) -> int:
    """`falling`: powers of the base from CHUNK - 1 down to 0, modulo `prime`."""
    values = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
    whole = len(values) // CHUNK
    # A byte times a power stays under 2**39, a chunk's sum under 2**51.
    chunks = (values[: whole * CHUNK].reshape(whole, CHUNK) * falling).sum(axis=1) % prime if whole else ()
    rest = values[whole * CHUNK :]
    lengths = [CHUNK] * whole + [len(rest)]
    hashes = [*map(int, chunks), int((rest * falling[CHUNK - len(rest) :]).sum() % prime)]
    while len(hashes) > 1:  # neighbours join in any order, here as a tree
        pairs = range(0, len(hashes) - 1, 2)
        odd = (hashes[-1:], lengths[-1:]) if len(hashes) % 2 else ([], [])
        hashes = [joined(hashes[i], hashes[i + 1], lengths[i + 1], prime) for i in pairs] + odd[0]
        lengths = [lengths[i] + lengths[i + 1] for i in pairs] + odd[1]
    return hashes[0]


def fingerprints(docs: DataFrame, primes: Sequence[int] = PRIMES, with_body: bool = True) -> DataFrame:
    """doc_id, body, n_bytes, fp1, fp2, text_sha256 of every row; a null text counts as empty.

    Texts go back only `with_body`: where nothing compares them they would be copied for nothing.
    """
    own = [("body", pa.binary())] if with_body else []
    schema = pa.schema([("doc_id", pa.int64()), *own, ("n_bytes", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("text_sha256", pa.string())])
    tables = [(p, powers(p)) for p in primes]

    def run(batches):
        for batch in parts_of(batches):  # a batch out for each part, so that no second copy of many texts is held
            found = []
            for doc_id, body in rows_of(iter([batch])):
                body = body or b""
                found.append((doc_id, *([body] if with_body else ()), len(body), *(fingerprint(body, p, t) for p, t in tables), hashlib.sha256(body).hexdigest()))
            yield from in_batches(iter(found), schema)

    columns = f"doc_id long, {'body binary, ' if with_body else ''}n_bytes long, fp1 long, fp2 long, text_sha256 string"
    return bodies(docs).mapInArrow(run, columns)


def grouped(rows: DataFrame) -> DataFrame:
    """`rows` with keep_id, keep_sha256 and group_size of their group by KEY; the join splits a hot group."""
    last = F.max(F.struct("doc_id", "text_sha256"))
    groups = rows.groupBy(*KEY).agg(last.alias("last"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select(*KEY, F.col("last.doc_id").alias("keep_id"), F.col("last.text_sha256").alias("keep_sha256"), "group_size")
    return rows.join(groups, list(KEY))


def chunked(df: DataFrame) -> DataFrame:
    """A row for each COMPARED bytes of `body`: `at` and `part`."""
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), ((F.col("n_bytes") - 1) / COMPARED).cast("int"))))
    return df.withColumn("at", at).withColumn("part", F.expr(f"substring(body, at * {COMPARED} + 1, {COMPARED})")).drop("body")


def differing(docs: DataFrame, rows: DataFrame, primes: Sequence[int]) -> DataFrame:
    """KEY and text_sha256 of rows whose bytes differ from those of the row that stays in their group."""
    same_text = ["fp1", "fp2", "n_bytes", "text_sha256"]
    copies = grouped(rows).where("group_size > 1").select(*same_text, "split", "keep_id", "keep_sha256").distinct()
    texts = fingerprints(docs, primes).join(copies, same_text)
    texts = texts.withColumn("stays", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_sha256") == F.col("keep_sha256")))
    parts = chunked(texts)
    uneven = parts.groupBy(*KEY, "at").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low != high")
    uneven = written(uneven.select(*KEY).distinct(), "exact-uneven")
    if uneven.isEmpty():
        return uneven.withColumn("text_sha256", F.lit(""))
    parts = chunked(texts.join(uneven, list(KEY)))
    stays = parts.where("stays").groupBy(*KEY, "at").agg(F.min("part").alias("kept_part"))
    others = parts.where("NOT stays").join(stays, [*KEY, "at"])
    return others.where("part != kept_part").select(*KEY, "text_sha256").distinct()


def exact_groups(docs: DataFrame, primes: Sequence[int] = PRIMES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of `docs`.

    Texts are equal when their bytes are; a null text counts as empty.  Of equal
    texts the row with the largest doc_id stays.  A repeated row gets a row of its
    own, counts in group_size, and stays or goes with its doc_id and text.  A null doc_id is
    less than any other; a group with null ids only keeps its rows and has a null
    keep_id.  An empty table gives an empty result.
    """
    with small_batches(docs.sparkSession):
        rows = fingerprints(docs, primes, with_body=False).withColumn("split", F.lit(0))
        rows = written(rows, "exact-rows")
        while True:
            apart = written(differing(docs, rows, primes), "exact-differing")
            if apart.isEmpty():
                break
            moved = rows.join(apart.withColumn("moved", F.lit(1)), [*KEY, "text_sha256"], "left")
            rows = written(moved.withColumn("split", F.col("split") + F.coalesce("moved", F.lit(0))).drop("moved"), "exact-rows")
    return grouped(rows).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all their columns, that stay in their group of equal texts: those with its largest doc_id.

    A null text counts as empty, a null doc_id is less than any other.  Rows that repeat a doc_id
    are judged each by its own text; repeated rows stay or go together.  An empty table gives an
    empty result.
    """
    kept = exact_groups(docs).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_text")).distinct()
    # Inside a struct, columns of `docs` cannot clash with those of the join.
    text = F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("row_id"), text.alias("row_text"))
    same = F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_text") == F.col("kept_text"))
    return rows.join(kept, same, "left_semi").select("row.*")
