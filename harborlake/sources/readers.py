"""Scans. Every path may be a file, a directory or a glob, on any Hadoop file system."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from harborlake.versions import is_versioned, read_version

Paths = str | Sequence[str]


def _discovery(reader, suffix: str | None, recursive: bool):
    if suffix is not None:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader


def _csv(reader, header: bool, sep: str):
    # A file whose header differs from the expected names is an error, not shifted data.
    return reader.option("header", header).option("sep", sep).option("enforceSchema", not header)


def read_delimited(
    spark: SparkSession,
    paths: Paths,
    *,
    schema: T.StructType | str | None = None,
    infer: bool = False,
    types: Mapping[str, str] | None = None,
    sep: str = ",",
    header: bool = True,
    suffix: str | None = None,
    recursive: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """Delimited files as one DataFrame.

    * ``schema`` declares everything: no job runs before the action.
    * without it, names come from the header and all columns are strings; ``types`` then
      casts some of them by name (text that does not fit becomes null). This keeps
      columns nobody has declared, and costs one read of one line.
    * ``infer`` reads all files once more to guess the types.

    ``file_column`` adds the path of the file each row comes from.
    """
    reader: DataFrameReader = _discovery(_csv(spark.read, header, sep), suffix, recursive)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    if file_column is not None:
        df = df.withColumn(file_column, F.col("_metadata.file_path"))
    return with_types(df, types) if types else df


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _typed(name: str, kind: str) -> Column:
    """Text as a value of a type, else null; a whole number may be written with a fraction of zeros (``1000.0``)."""
    column = F.col(f"`{name}`")
    if kind not in _WHOLE:
        return column.try_cast(kind)
    number = column.try_cast("decimal(38,10)")
    return F.coalesce(column.try_cast(kind), F.when(number == F.floor(number), number).try_cast(kind))


def with_types(df: DataFrame, types: Mapping[str, str], *, strict: bool = False) -> DataFrame:
    """Cast text columns by name; text that does not fit becomes null, as it does in a typed CSV scan.

    Columns that are not text have a type already and keep it. With ``strict``, text that does not fit is an error when its
    row is read; blank text is missing, not misfitting.
    """
    casts = {}
    for name, kind in _text_columns(df, types).items():
        typed = _typed(name, kind)
        if strict:
            what = F.concat(F.lit(f"{name} is no {kind}: "), F.col(f"`{name}`"))
            typed = F.when(_misfits(name, kind), F.raise_error(what).cast(kind)).otherwise(typed)
        casts[name] = typed
    return df.withColumns(casts) if casts else df


def _text_columns(df: DataFrame, types: Mapping[str, str]) -> dict[str, str]:
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return {name: kind for name, kind in types.items() if name in texts}


def _misfits(name: str, kind: str) -> Column:
    return F.coalesce(F.trim(F.col(f"`{name}`")) != "", F.lit(False)) & _typed(name, kind).isNull()


def type_misfits(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """(column, misfits, example): how many texts ``with_types`` turns into nulls, per column that has any, in one pass."""
    columns = _text_columns(df, types)
    counts = [F.struct(F.count_if(_misfits(n, k)).alias("n"), F.min(F.when(_misfits(n, k), F.col(f"`{n}`"))).alias("x")).alias(n) for n, k in columns.items()]
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, misfits bigint, example string")
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"`{n}`.n").alias("misfits"), F.col(f"`{n}`.x").alias("example")) for n in columns])
    return df.agg(*counts).select(F.inline(rows)).where("misfits > 0")


def read_texts(spark: SparkSession, paths: Paths, *, whole: bool = True) -> DataFrame:
    """Text files: one row per file with its whole text, or one row per line."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=whole)


def read_any(
    spark: SparkSession,
    fmt: str,
    paths: Paths,
    *,
    schema: T.StructType | str | None = None,
    suffix: str | None = None,
    recursive: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files of any format Spark knows, built in or from a package on the class path."""
    reader = _discovery(spark.read.format(fmt).options(**(options or {})), suffix, recursive)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths if isinstance(paths, str) else list(paths))


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A Parquet table, flat or partitioned, by its directory; of a table with versions, the newest one.

    Reading the directory, not a glob of its files, is what keeps partition columns.
    With ``schema`` no file is opened to learn it, partition columns have the given types
    instead of guessed ones, and a table without files is empty rather than an error.
    """
    if is_versioned(spark, path):
        return read_version(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def stream_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    sep: str = ",",
    header: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Delimited files that keep arriving in a folder, as a stream."""
    reader = _csv(spark.readStream.schema(schema), header, sep)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)
