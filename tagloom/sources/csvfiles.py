"""CSV in and out. Quotes are doubled inside fields; texts may span lines.

A CSV file with line breaks inside fields cannot be split, so large collections should come as
many files of moderate size; everything the library writes for itself is Parquet.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom import fixed
from tagloom.operators.clean import unique_override
from tagloom.session import bounded_list

RECORD_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in fixed.RECORD_COLUMNS])
OVERRIDE_SCHEMA = T.StructType([T.StructField("ids", T.StringType()), T.StructField("plots", T.StringType())])
FILE_ORDER = ["_file", "_start", "_row"]


def csv_reader(spark: SparkSession, multi_line: bool = True):
    return (
        spark.read.option("header", True).option("multiLine", multi_line)
        .option("escape", '"').option("quote", '"').option("encoding", "UTF-8")
    )


def list_files(spark: SparkSession, pattern: str, limit: int = 1 << 20) -> list[str]:
    """Paths that match a glob pattern; only the listing is read, no content."""
    return bounded_list(spark.read.format("binaryFile").load(pattern).select("path"), limit)


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of one file, all read as strings; only its first line is parsed."""
    return csv_reader(spark).option("inferSchema", False).csv(path).columns


def with_file_order(df: DataFrame) -> DataFrame:
    """Add (_file, _start, _row): a sortable position of each row in its file."""
    return df.withColumns({
        "_file": F.col("_metadata.file_path"),
        "_start": F.col("_metadata.file_block_start"),
        "_row": F.monotonically_increasing_id(),
    })


def scan_union(spark: SparkSession, paths: list[str], schema: T.StructType | None = None,
               order: bool = False, multi_line: bool = True) -> DataFrame:
    """Union of CSV files whose column sets may differ; absent columns are null. Files with the
    same columns are read by one scan, so the plan grows with the number of layouts.

    ``schema`` keeps those columns only; without it all columns come as strings."""
    if not paths:
        raise ValueError("no files to read")
    layouts: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(max_workers=16) as pool:
        for path, columns in zip(paths, pool.map(lambda p: header_columns(spark, p), paths)):
            layouts.setdefault(tuple(columns), []).append(path)
    parts = []
    for columns, files in layouts.items():
        file_schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        part = csv_reader(spark, multi_line).schema(file_schema).csv(files)
        parts.append(with_file_order(part) if order else part)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if schema is None:
        return df
    present = set(df.columns)
    wanted = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*wanted, *(FILE_ORDER if order else []))


def read_override(spark: SparkSession, path: str) -> DataFrame:
    """ids/plots file -> unique (movie_id, description): "NaN" is null, incomplete rows go, the
    first row of an id stays."""
    df = csv_reader(spark).option("nullValue", "NaN").schema(OVERRIDE_SCHEMA).csv(path)
    return unique_override(with_file_order(df), FILE_ORDER)


def write_csv_all_quoted(df: DataFrame, path: str, quote_all: bool = True) -> None:
    """CSV with every field quoted. Arrays are written as ``['a' 'b']`` / ``[0 1]`` strings, the
    form that parse_label_list reads back."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            items = c.cast("array<string>")
            if isinstance(f.dataType.elementType, T.StringType):
                items = F.transform(items, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
            c = F.concat(F.lit("["), F.array_join(items, " "), F.lit("]"))
        columns.append(c.alias(f.name))
    (
        df.select(*columns).write.option("header", True).option("quoteAll", quote_all)
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(path)
    )


def write_predictions(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """(movie_id, y_pred, y_true) as Parquet, or as CSV with array strings."""
    rows = df.select("movie_id", "y_pred", "y_true")
    if kind == "csv":
        write_csv_all_quoted(rows, path, quote_all=False)
    elif kind == "parquet":
        rows.write.parquet(path)
    else:
        raise ValueError(f"unknown kind {kind!r}")
