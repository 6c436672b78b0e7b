"""CSV files whose headers differ: columns are matched by name, types joined over all files.

A census reads the first line of each file, in one job, and groups the files by their header.
Files of one header are read together with a schema in the order of that header.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemill import schema as S
from ridemill.sources.csv_trips import LANDING_OPTIONS, discover_csv_schema, read_trips_csv, with_corrupt_column

_SPLIT, _OPEN = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
#: From narrow to wide; a number found with another kind of value makes a text.
_NUMBERS = (T.IntegerType, T.LongType, T.DecimalType, T.DoubleType)

Census = dict[tuple[str, ...], list[str]]


def header_census(spark: SparkSession, paths: str | Iterable[str]) -> Census:
    """The files at the paths by their header; an empty file has the empty header.

    Each file is a partition of its own for this job, and a task ends after its file's first
    rows, so the files are opened but not read.
    """
    files = [paths] if isinstance(paths, str) else sorted(set(paths))
    schema = pa.schema([("file", pa.string()), ("line", pa.string())])

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            if batch.column(1)[0].as_py() == 0:
                yield pa.RecordBatch.from_arrays([batch.column(0)[:1], batch.column(2)[:1]], schema=schema)
            return

    before = {key: spark.conf.get(key) for key in (_SPLIT, _OPEN)}
    try:
        # A file opened costs a whole partition, so that no partition has two.
        spark.conf.set(_OPEN, before[_SPLIT])
        rows = spark.read.options(**LANDING_OPTIONS).text(files)
        heads = rows.select(F.input_file_name(), F.input_file_block_start(), "value").mapInArrow(first_line, "file string, line string")
        found = heads.collect()
        known = rows.inputFiles()
    finally:
        spark.conf.set(_OPEN, before[_OPEN])
    census: Census = {}
    heads = dict(map(tuple, found))
    for file in sorted(known):
        line = heads.get(file, "")
        census.setdefault(tuple(name.strip() for name in next(csv.reader([line.removeprefix("﻿")]), [])), []).append(unquote(file))
    return census


def read_trips_by_name(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType = S.RAW_TRIPS) -> DataFrame:
    """All `.csv` files at the paths, each column found by its name in the file's own header.

    Names are compared without regard to case.  Columns that a file lacks are null, those that
    the schema does not know are left out.  A line with more or fewer values than its own file's header
    has names is corrupt.
    """
    wanted, parts = {f.name.lower(): f for f in schema}, []
    for header, files in header_census(spark, paths).items():
        fields, taken = [], set()
        for place, name in enumerate(header):
            known = wanted.get(name.lower())
            if known is None or known.name in taken:
                fields.append(T.StructField(f"unknown_{place}", T.StringType()))
            else:
                taken.add(known.name)
                fields.append(known)
        if not taken:
            continue
        rows = read_trips_csv(spark, files, T.StructType(fields))
        lacking = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in taken}
        parts.append(rows.select(*[lacking.get(f.name, F.col(f.name)) for f in schema], S.CORRUPT_COLUMN, S.LINEAGE_COLUMN))
    if not parts:
        return spark.createDataFrame([], with_corrupt_column(schema)).withColumn(S.LINEAGE_COLUMN, F.lit(None).cast("string"))
    every = parts[0]
    for rows in parts[1:]:
        every = every.unionByName(rows)
    return every


def discover_by_name(spark: SparkSession, paths: str | Iterable[str], sampling_ratio: float = 1.0) -> T.StructType:
    """Column names and types over files with different headers: a job for each header, types joined by name.

    Columns come in the order in which they are first met.  A type holds the values of all files:
    whole numbers widen to larger ones and to fractions, everything else that differs is text.
    """
    found: dict[str, T.StructField] = {}
    for header, files in header_census(spark, paths).items():
        if not header:
            continue
        for field in discover_csv_schema(spark, files, sampling_ratio):
            before = found.get(field.name.lower())
            kind = field.dataType if before is None else joined_type(before.dataType, field.dataType)
            found[field.name.lower()] = T.StructField(before.name if before else field.name, kind)
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType) for f in found.values()])


def joined_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if isinstance(one, _NUMBERS) and isinstance(other, _NUMBERS):
        if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
            whole = max(one.precision - one.scale, other.precision - other.scale)
            scale = max(one.scale, other.scale)
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
        wide = max(one, other, key=lambda t: next(i for i, kind in enumerate(_NUMBERS) if isinstance(t, kind)))
        if isinstance(wide, T.DecimalType) and wide.precision - wide.scale < 19:
            return T.DoubleType() if wide.scale > 19 else T.DecimalType(19 + wide.scale, wide.scale)
        return wide
    return T.StringType()
