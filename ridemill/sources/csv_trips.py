"""Raw trip rows from CSV files, a file stream, or lines in a column.

Lines that do not fit the schema are kept whole in `_corrupt_record`.  A query
that reads few columns must not take faulty lines for good ones: column pruning
is off, so that every line is split and its fields counted, and the corrupt
column brings the typed columns with it, so that their values are converted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemill import schema as S

CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": S.CORRUPT_COLUMN,
    "columnPruning": "false",
}
#: Spark skips files that are older than the newest one by more than this; here none is.
ANY_AGE = "36500d"
LANDING_OPTIONS = {"pathGlobFilter": "*.csv", "recursiveFileLookup": "true"}


def read_trips_csv(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType = S.RAW_TRIPS) -> DataFrame:
    """All `.csv` files at the paths; a path given twice is read once."""
    files = [paths] if isinstance(paths, str) else sorted(set(paths))
    reader = spark.read.schema(with_corrupt_column(schema)).options(**CSV_OPTIONS, **LANDING_OPTIONS)
    return _with_lineage(reader.csv(files), schema)


def stream_trips_csv(
    spark: SparkSession,
    landing: str,
    schema: T.StructType = S.RAW_TRIPS,
    max_files: int = 50,
    archive: str | None = None,
) -> DataFrame:
    """The landing folder as a stream, at most `max_files` new files per batch.

    A file is read however old its time stamp is.  With `archive`, files that are done
    are moved there, so that neither the folder nor the list of known files grows
    without end; it must not lie inside `landing`.
    """
    reader = spark.readStream.schema(with_corrupt_column(schema)).options(**CSV_OPTIONS, **LANDING_OPTIONS)
    reader = reader.options(maxFilesPerTrigger=max_files, maxFileAge=ANY_AGE)
    if archive is not None:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    return _with_lineage(reader.csv(landing), schema)


def parse_trip_lines(lines: DataFrame, column: str = "value", schema: T.StructType = S.RAW_TRIPS) -> DataFrame:
    """Raw trip rows from CSV lines that are already in a column."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COLUMN}
    row = F.from_csv(column, with_corrupt_column(schema).toDDL(), options)
    return lines.select(row.alias("row")).select("row.*")


def discover_csv_schema(
    spark: SparkSession,
    paths: str | list[str],
    sampling_ratio: float = 1.0,
) -> T.StructType:
    """Column names from the header and types from the values.

    Times stay text, so that an unreadable one is rejected by the time check
    and not taken for a corrupt line.
    """
    found = (
        spark.read.options(
            header="true",
            inferSchema="true",
            samplingRatio=str(sampling_ratio),
            ignoreLeadingWhiteSpace="true",
            ignoreTrailingWhiteSpace="true",
            **LANDING_OPTIONS,
        )
        .csv(paths)
        .schema
    )
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, times) else f.dataType) for f in found]
    )


def distinct_paths(paths: DataFrame, column: str = "path") -> DataFrame:
    """Each announced path once."""
    return paths.select(column).dropDuplicates()


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    if S.CORRUPT_COLUMN in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(S.CORRUPT_COLUMN, T.StringType())])


def _with_lineage(rows: DataFrame, schema: T.StructType) -> DataFrame:
    corrupt = _read_with(_typed_columns(schema) or schema.names[:1])
    fields = [corrupt if c == S.CORRUPT_COLUMN else F.col(c) for c in rows.columns]
    return rows.select(*fields, F.col("_metadata.file_path").alias(S.LINEAGE_COLUMN))


def _typed_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not isinstance(f.dataType, T.StringType)]


def _read_with(names: list[str]) -> Column:
    """The corrupt text, by way of a condition on other columns that always holds.

    An int is never below the smallest int, but the optimiser does not fold
    that, so the columns stay in the scan wherever the corrupt text is read.
    """
    always = F.hash(*names) >= F.lit(-(2**31))
    return F.when(always, F.col(S.CORRUPT_COLUMN)).alias(S.CORRUPT_COLUMN)
