"""Batch metrics gathered while the batch is written."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ridemill import schema as S


def observe_batch(clean: DataFrame, name: str = "batch") -> tuple[DataFrame, Observation]:
    """The frame to write, and its row count with first and last start date.

    Read `observation.get` only after an action on the returned frame; it waits
    for one.  On an empty batch the count is 0 and the dates are null.
    """
    observation = Observation(name)
    observed = clean.observe(
        observation,
        F.count(F.lit(1)).alias("clean_count"),
        F.min(F.to_date("start_time")).cast("string").alias("start_date"),
        F.max(F.to_date("start_time")).cast("string").alias("end_date"),
    )
    return observed, observation


PRINT = ("rows", "total", "xor")
#: The column that holds a row's hash while it is observed.
HASHED = "_row_hash"


def row_hash(columns: list[str]) -> Column:
    return F.xxhash64(*(F.col(f"`{c}`") for c in sorted(columns)))


def fingerprint(hashed: str, prefix: str = "", where: str = "true") -> list[Column]:
    """`rows`, `total` and `xor`: number of rows, sum and xor of their hashes, the same for the same rows in any order and number of files.

    `hashed` is the column with the `row_hash`.
    """
    row = f"CASE WHEN {where} THEN `{hashed}` END"
    return [
        F.expr(f"count({row}) AS `{prefix}rows`"),
        F.expr(f"cast(coalesce(sum(cast({row} AS decimal(38,0))), 0) AS string) AS `{prefix}total`"),
        F.expr(f"coalesce(bit_xor({row}), 0) AS `{prefix}xor`"),
    ]


def observe_fingerprints(rows: DataFrame, parts: dict[str, str], name: str = "fingerprints") -> tuple[DataFrame, Observation]:
    """The rows to write, and an observation of the fingerprint of each of a bounded number of parts, given by conditions.

    A row is hashed once, not for each part and kind.
    """
    observation = Observation(name)
    columns = [c for part, where in parts.items() for c in fingerprint(HASHED, f"{part}_", where)]
    return rows.withColumn(HASHED, row_hash(rows.columns)).observe(observation, *columns).drop(HASHED), observation


def noted_fingerprints(observation: Observation, parts: Iterable[str]) -> dict[str, list]:
    """What was observed of each part, once the rows have been written."""
    found = observation.get
    return {part: [found[f"{part}_{kind}"] for kind in PRINT] for part in parts}


def observe_reasons(bad: DataFrame, name: str = "reasons") -> tuple[DataFrame, Observation]:
    """The rejected rows to write, and how many have each reason."""
    observation = Observation(name)
    reason = F.col(S.REASON_COLUMN)
    counts = [F.count_if(reason == text).alias(text) for text in S.REASONS]
    return bad.observe(observation, *counts), observation
