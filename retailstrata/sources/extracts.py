"""Scans of raw Parquet extracts, with or without the header among the data."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import SchemaMismatch, check_schema


def read_extract(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan Parquet files at any Hadoop path; with ``schema`` the declared columns must be there.

    The file's own schema is used for the scan: reading under a declared one would turn an absent
    column into nulls without a word.
    """
    df = spark.read.parquet(path)
    return df if schema is None else check_schema(df, schema, path)


def extract_files(spark: SparkSession, path: str) -> list[str]:
    """The names of the files of an extract in order, from a listing; no file is opened."""
    listing = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    return sorted(r["file"] for r in listing.collect())


@dataclass(frozen=True)
class FileGroup:
    """Files of an extract with the same columns in the same types."""

    files: tuple[str, ...]
    schema: T.StructType

    def lacks(self, expected: T.StructType) -> list[str]:
        there = {f.name.lower() for f in self.schema.fields}
        return [f.name for f in expected.fields if f.name.lower() not in there]


def file_groups(spark: SparkSession, path: str) -> list[FileGroup]:
    """The files of an extract by their schemas, which are read from the footers, one small job for each file."""
    files = extract_files(spark, path)
    with ThreadPoolExecutor(8) as pool:
        schemas = list(pool.map(lambda f: spark.read.parquet(unquote(f)).schema, files))
    groups: dict[str, tuple[list[str], T.StructType]] = {}
    for file, schema in zip(files, schemas):
        shape = str(sorted((f.name.lower(), f.dataType.simpleString()) for f in schema.fields))
        groups.setdefault(shape, ([], schema))[0].append(file)
    return [FileGroup(tuple(names), schema) for names, schema in groups.values()]


def missing_columns(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``file`` and ``column`` for every declared column that a file of the extract lacks."""
    rows = [(f, c) for g in file_groups(spark, path) for f in g.files for c in g.lacks(schema)]
    return spark.createDataFrame(rows, "file string, column string")


def _as_text(f: T.StructField) -> Column:
    """A column of any atomic type as the text an extract of texts would have; whole numbers without a point."""
    c = F.col("`" + f.name.replace("`", "``") + "`")
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
        return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def read_mixed_extract(spark: SparkSession, path: str, schema: T.StructType, lacking: bool = False) -> DataFrame:
    """An extract whose files differ in types or columns, as the declared columns in their declared types.

    Files of one shape are one scan; the scans are united as text. Names compare without case. A declared column that
    a file lacks is an error that names every such file, or, with ``lacking``, null there. Other columns are left out.
    """
    parts, problems = [], []
    for group in file_groups(spark, path):
        absent = group.lacks(schema)
        if absent and not lacking:
            problems += [f"{unquote(file)}: missing columns: {', '.join(absent)}" for file in group.files]
        own = T.StructType([f for f in schema.fields if f.name not in absent])
        scan = spark.read.schema(group.schema).parquet(*map(unquote, group.files))
        try:
            check_schema(scan, own, ", ".join(map(unquote, group.files)))
        except SchemaMismatch as error:
            problems.append(str(error))
        there = {f.name.lower(): f for f in group.schema.fields}
        columns = [(F.lit(None).cast("string") if f.name in absent else _as_text(there[f.name.lower()])).cast(f.dataType).alias(f.name) for f in schema.fields]
        parts.append(scan.select(*columns))
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def promote_header(spark: SparkSession, path: str) -> DataFrame:
    """Scan Parquet files whose very first row holds the column names.

    The header is row 0 of the lexically first file with rows; other files' first rows are data. It is
    found and left out by file and row position, which the scan itself provides, so the rest stays an
    ordinary distributed scan in the declared types.
    """
    scan = spark.read.parquet(path)
    for first_file in extract_files(spark, path):
        is_header = (F.col("_metadata.file_path") == first_file) & (F.col("_metadata.row_index") == 0)
        # The filter on the file path prunes this scan to that one file.
        header = scan.where(is_header).head()
        if header is not None:
            break
    else:
        raise ValueError(f"no header row in {path}")
    names = [str(value).strip() for value in header]
    return scan.where(~is_header).toDF(*names)
