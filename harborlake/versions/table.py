"""Tables of immutable batches, and a small pointer file for each version that names the batches it consists of.

::

    <table>/__batch=000000000001-<id>/...    rows, as one write left them, by partition if any
    <table>/_versions/000000000001.json      what belongs to version 1

A writer puts its rows into a folder that no version names yet and then creates the next pointer, which the file system
grants to one writer only. Nothing is renamed or overwritten: readers resolve the newest pointer, so they see the version before or
the one after, at every moment and also when a writer dies; older versions can be read until they are expired. A pointer
that its writer did not finish is no version. The rows of replaced or retracted batches are deleted by ``expire`` alone.

Rows can be taken back without touching a file: a ``Void`` says that rows of the batches up to one, whose column holds one of
the values in a small folder of their own, no longer count.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from harborlake.sinks import paths
from harborlake.sinks.writers import balanced

BATCH = "__batch"
_POINTERS = "_versions"
_VALUES = "_voids"


class VersionConflict(RuntimeError):
    """Another writer has made the next version."""


@dataclass(frozen=True)
class Void:
    """Rows of batches up to ``until`` whose ``column`` is among the values in ``folder`` do not count."""

    column: str
    folder: str
    until: str


@dataclass(frozen=True)
class Version:
    """What a pointer says.

    ``rows`` counts stored rows, voids not taken off. ``applied`` has the last batch number of each source, so that a batch which comes
    again is recognised, ``added`` the batches that this version took in from it, ``notes`` folders of small tables kept beside the rows.
    """

    number: int
    base: int
    schema: str
    partition_by: tuple[str, ...]
    batches: tuple[str, ...]
    rows: int
    operation: str
    voids: tuple[Void, ...] = ()
    applied: Mapping[str, int] = field(default_factory=dict)
    added: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    notes: Mapping[str, str] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def _pointer(table: str, number: int) -> str:
    return f"{table}/{_POINTERS}/{number:012d}.json"


def _load(spark: SparkSession, table: str, number: int) -> Version | None:
    """None for a pointer that is not finished."""
    try:
        found = json.loads(paths.read_file(spark, _pointer(table, number)))
    except ValueError:
        return None
    for name in ("partition_by", "batches"):
        found[name] = tuple(found[name])
    found["voids"] = tuple(Void(**v) for v in found["voids"])
    found["added"] = {k: tuple(v) for k, v in found["added"].items()}
    return Version(**found)


def _numbers(spark: SparkSession, table: str) -> list[int]:
    names = paths.names(spark, f"{table}/{_POINTERS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def is_versioned(spark: SparkSession, table: str) -> bool:
    return paths.exists(spark, f"{table.rstrip('/')}/{_POINTERS}")


def latest(spark: SparkSession, table: str) -> Version | None:
    """The newest finished version; None for a table without any."""
    table = table.rstrip("/")
    return next((v for n in reversed(_numbers(spark, table)) if (v := _load(spark, table, n))), None)


def history(spark: SparkSession, table: str) -> list[Version]:
    """Versions from the newest back, as far as their pointers are kept."""
    found, version = [], latest(spark, table)
    while version is not None:
        found.append(version)
        version = _load(spark, table.rstrip("/"), version.base) if version.base in _numbers(spark, table.rstrip("/")) else None
    return found


def new_batch(base: Version | None) -> str:
    """A name for a batch that sorts behind all those of ``base``."""
    return f"{base.number + 1 if base else 1:012d}-{uuid.uuid4().hex}"


def write_batch(df: DataFrame, table: str, batch: str, partition_by: Sequence[str] = ()) -> int:
    """Write the rows of a batch, which no version names yet; returns how many were sent and are stored."""
    spark, folder, sent = df.sparkSession, f"{table.rstrip('/')}/{BATCH}={batch}", Observation()
    rows = balanced(df, partition_by) if partition_by else df
    writer = rows.observe(sent, F.count(F.lit(1)).alias("rows")).write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    stored = spark.read.schema(df.schema).parquet(folder).count()
    if stored != sent.get["rows"]:
        raise OSError(f"{folder}: {sent.get['rows']} rows sent, {stored} stored")
    return stored


def commit(spark: SparkSession, table: str, version: Version) -> Version:
    """Make ``version`` the next one after its base, unless another writer was faster.

    The number after the base may be taken by a pointer that was never finished; the next free one is used then.
    """
    table = table.rstrip("/")
    numbers = _numbers(spark, table)
    newer = [n for n in numbers if n > version.base]
    if any(_load(spark, table, n) for n in newer):
        raise VersionConflict(f"{table}: version {version.base} is not the newest")
    number = max([version.base, *newer]) + 1
    found = Version(**{**version.__dict__, "number": number})
    text = json.dumps(asdict(found))
    if not paths.create_file(spark, _pointer(table, number), text):
        raise VersionConflict(f"{table}: version {number} is being written by another")
    faster = [n for n in _numbers(spark, table) if version.base < n < number and _load(spark, table, n)]
    if faster:  # a pointer that seemed dead was finished in between: the other writer knows of no conflict, so this one gives way
        paths.delete(spark, _pointer(table, number))
        raise VersionConflict(f"{table}: version {faster[0]} was finished in between")
    return found


def read_batches(spark: SparkSession, table: str, version: Version, batches: Sequence[str], *, with_batch: bool = False) -> DataFrame:
    """Rows of some batches of a version, those that do not count included."""
    table, schema = table.rstrip("/"), version.struct
    if not batches:
        found = spark.createDataFrame([], schema).withColumn(BATCH, F.lit(""))
    else:
        whole = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
        found = spark.read.schema(whole).option("basePath", table).parquet(*[f"{table}/{BATCH}={b}" for b in batches])
    return found.select(*[_quoted(n) for n in schema.names], *([BATCH] if with_batch else []))


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def read_version(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The rows of a version, the newest unless its number is given."""
    table = table.rstrip("/")
    version = latest(spark, table) if number is None else _load(spark, table, number)
    if version is None:
        raise FileNotFoundError(f"{table} has no version {number or ''}".rstrip())
    found = read_batches(spark, table, version, version.batches, with_batch=bool(version.voids))
    for n, void in enumerate(version.voids):
        # The values are a small reference table; whether it is broadcast is Spark's choice.
        kind = version.struct[void.column].dataType
        values = spark.read.schema(T.StructType([T.StructField("value", kind)])).parquet(f"{table}/{_VALUES}/{void.folder}").alias(f"v{n}")
        gone = _quoted(void.column).eqNullSafe(F.col(f"v{n}.value")) & (F.col(BATCH) <= void.until)
        found = found.join(values, gone, "left_anti")
    return found.drop(BATCH)


def void_values(values: DataFrame, table: str, column: str, until: str) -> Void:
    """Store the values (one column) whose rows of batches up to ``until`` are to be taken back."""
    folder = uuid.uuid4().hex
    values.toDF("value").distinct().write.parquet(f"{table.rstrip('/')}/{_VALUES}/{folder}")
    return Void(column, folder, until)


def write_version(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    *,
    append: bool = False,
    allow_empty: bool = True,
    source: tuple[str, int] | None = None,
    attempts: int = 5,
) -> Version:
    """Make a version of the rows of ``df``, alone or after those of the newest one (``append``).

    An append has the columns of the table, in any order. ``source`` (name, batch number) makes it repeatable: a batch with a number that was applied already changes nothing. Versions
    that others make meanwhile are taken into account by an append and superseded by a replacement.
    """
    spark, table, base = df.sparkSession, table.rstrip("/"), latest(df.sparkSession, table)
    if base is not None and source is not None and base.applied.get(source[0], -1) >= source[1]:
        return base
    if append and base is not None:
        df = df.select(*[_quoted(n) for n in base.struct.names])
    batch = new_batch(base)
    rows = write_batch(df, table, batch, partition_by)
    if rows == 0 and not allow_empty:
        paths.delete(spark, f"{table}/{BATCH}={batch}")
        raise ValueError("no rows")
    for attempt in range(attempts):
        kept = base if append and base is not None else None
        version = Version(
            number=0,
            base=base.number if base else 0,
            schema=df.schema.json() if kept is None else kept.schema,
            partition_by=tuple(partition_by),
            batches=(*(kept.batches if kept else ()), *([batch] if rows else [])),
            rows=rows + (kept.rows if kept else 0),
            operation="append" if append else "replace",
            voids=kept.voids if kept else (),
            applied={**(kept.applied if kept else {}), **({source[0]: source[1]} if source else {})},
            added={source[0]: (batch,) if rows else ()} if source else {},
            notes=kept.notes if kept else {},
        )
        try:
            return commit(spark, table, version)
        except VersionConflict:
            if attempt + 1 == attempts:
                raise
            base = latest(spark, table)
    raise AssertionError("unreachable")


def compact(spark: SparkSession, table: str) -> Version:
    """Rewrite the newest version as one batch, without the rows that do not count."""
    table = table.rstrip("/")
    base = latest(spark, table)
    if base is None or (len(base.batches) < 2 and not base.voids):
        return base
    batch = new_batch(base)
    rows = write_batch(read_version(spark, table, base.number), table, batch, base.partition_by)
    changed = {"base": base.number, "batches": (batch,) if rows else (), "rows": rows, "operation": "compact", "voids": (), "added": {}}
    return commit(spark, table, Version(**{**base.__dict__, **changed}))


def expire(spark: SparkSession, table: str, *, keep: int = 1, min_age_seconds: float = 86_400) -> list[str]:
    """Delete pointers older than the ``keep`` newest versions, and folders that none of those name.

    What is younger than ``min_age_seconds`` stays: a writer may be about to name it, a reader still be reading. Returns what was deleted.
    """
    table = table.rstrip("/")
    versions = history(spark, table)[: max(1, keep)]
    if not versions:
        return []
    named = {f"{BATCH}={b}" for v in versions for b in v.batches} | {f"{BATCH}={b}" for v in versions for added in v.added.values() for b in added}
    folders = {v.folder for version in versions for v in version.voids} | {n for version in versions for n in version.notes.values()}
    old = time.time() - min_age_seconds
    gone = [f"{table}/{n}" for n, at in paths.names(spark, table).items() if n.startswith(f"{BATCH}=") and n not in named and at <= old]
    gone += [f"{table}/{_VALUES}/{n}" for n, at in paths.names(spark, f"{table}/{_VALUES}").items() if n not in folders and at <= old]
    pointers = paths.names(spark, f"{table}/{_POINTERS}")
    gone += [f"{table}/{_POINTERS}/{n}" for n, at in pointers.items() if n < _pointer("", versions[-1].number).rpartition("/")[2] and at <= old]
    for path in gone:
        paths.delete(spark, path)
    return gone
