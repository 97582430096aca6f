"""Loads that only ever append: new rows are told from known ones by digests, and no stored file is rewritten.

The raw table has every distinct source row once, with a digest of 128 bits beside it. Of a batch of files, the rows whose digest
is not among those of the partitions they belong to become a batch of the table (``harborlake.versions``); of stored rows just the
digests of those partitions are read, and rows of partitions that are new are compared with nothing. The table's pointer is the
ledger: which batch of which source it holds, and what that added.

The fact follows: what a raw batch added is joined with the ports and appended. When ports have changed since the last
batch, the fact's rows of those ports are taken back by a void, and all raw rows of those ports are joined anew; other
ports' files stay as they are.

A batch that comes again after a cut changes nothing that is done already and goes on with the rest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from harborlake.functions import row_digest, sas_date
from harborlake.operators import dedupe
from harborlake.plans.tables import build_arrivals
from harborlake.sinks import delete, paths
from harborlake.sources import stream_delimited
from harborlake.versions import Version, Void, commit, latest, new_batch, read_batches, read_version, write_batch

DIGEST = ("__a", "__b")
_PORTS = "ports"


def _in_same_partition(left: str, right: str, partition_by: Sequence[str]) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in partition_by]


def _unknown(arrived: DataFrame, stored: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows whose digest is not among the stored ones of their partition."""
    same = [F.col(f"n.{c}") == F.col(f"s.{c}") for c in DIGEST] + _in_same_partition("n", "s", partition_by)
    return arrived.alias("n").join(stored.alias("s"), reduce(Column.__and__, same), "left_anti")


def append_distinct(rows: DataFrame, table: str, partition_by: Sequence[str] = (), *, source: tuple[str, int] | None = None) -> Version:
    """Append the rows that the table does not have yet, once each; returns the version that has them all.

    ``partition_by`` must be functions of the row, so that equal rows lie in the same partition. A batch for a partitioned table is
    written twice (once as it came, to learn its partitions and be read from there), stored rows never. Rows of partitions that the
    table has nothing of yet are appended without a join. Equal digests count as equal rows: with 128 bits that is wrong
    once in 10**14 tables of 10**12 rows.
    """
    spark, table, base = rows.sparkSession, table.rstrip("/"), latest(rows.sparkSession, table)
    if base is not None and source is not None and base.applied.get(source[0], -1) >= source[1]:
        return base
    batch, schema = new_batch(base), T.StructType([*rows.schema.fields, *[T.StructField(c, T.LongType()) for c in DIGEST]])
    once = dedupe(rows)
    fresh = once.select("*", *row_digest(once, DIGEST))  # after the shuffle, which digests would only make larger
    staged = f"{table}/_arrived/{uuid.uuid4().hex}"
    if base is not None and base.batches:
        stored = read_batches(spark, table, base, base.batches).select(*partition_by, *DIGEST)
        if partition_by:  # as many as the batch has partitions, each of which is a folder anyway
            fresh.write.parquet(staged)
            arrived = spark.read.schema(schema).parquet(staged)
            touched = arrived.select(*partition_by).distinct().collect()
            stored = stored.where(in_partitions(touched, partition_by))
            met = stored.select(*partition_by).distinct().collect()
            is_met = F.coalesce(in_partitions(met, partition_by), F.lit(False))
            fresh = _unknown(arrived.where(is_met), stored, partition_by)
            if len(met) < len(touched):  # rows of partitions that the table has nothing of need no look at it
                fresh = arrived.where(~is_met).unionByName(fresh)
        else:
            fresh = _unknown(fresh, stored, partition_by)
    added = write_batch(fresh, table, batch, partition_by)
    delete(spark, staged)
    known = base.batches if base else ()
    return commit(
        spark,
        table,
        Version(
            number=0,
            base=base.number if base else 0,
            schema=schema.json(),
            partition_by=tuple(partition_by),
            batches=(*known, batch) if added else known,
            rows=added + (base.rows if base else 0),
            operation="append",
            applied={**(base.applied if base else {}), **({source[0]: source[1]} if source else {})},
            added={source[0]: (batch,) if added else ()} if source else {},
        ),
    )


def in_partitions(values: Sequence, partition_by: Sequence[str]) -> Column:
    """Filter on constants, so the scan lists these partitions only; null is a partition too."""
    name, *deeper = partition_by
    if not deeper:
        known = F.col(name).isin([v[name] for v in values if v[name] is not None])
        return known | F.col(name).isNull() if any(v[name] is None for v in values) else known
    below: dict = {}
    for value in values:
        below.setdefault(value[name], []).append(value)
    return _any([F.col(name).eqNullSafe(F.lit(v)) & in_partitions(rows, deeper) for v, rows in below.items()])


def _any(conditions: list[Column]) -> Column:
    """Disjunction as a balanced tree: a chain of hundreds is too deep for the optimizer."""
    if len(conditions) < 2:
        return conditions[0] if conditions else F.lit(False)
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ between two editions of a reference table, in number or content."""
    gone, come = old.exceptAll(new.select(*old.columns)), new.select(*old.columns).exceptAll(old)
    return gone.select(key).union(come.select(key)).where(F.col(key).isNotNull()).distinct()


def _store_small(df: DataFrame, table: str) -> str:
    folder = uuid.uuid4().hex
    df.write.parquet(f"{table}/_voids/{folder}")
    return folder


def refresh_fact(
    spark: SparkSession,
    raw_table: str,
    fact_table: str,
    ports: DataFrame,
    *,
    source: tuple[str, int],
    partition_by: Sequence[str] = ("year",),
) -> Version:
    """Append to the fact what a source's batch added to the raw table, and redo the rows of ports that have changed.

    The outcome equals a build over the whole raw table with these ports, whatever they were before.
    """
    raw_table, fact_table = raw_table.rstrip("/"), fact_table.rstrip("/")
    raw, base = latest(spark, raw_table), latest(spark, fact_table)
    if base is not None and base.applied.get(source[0], -1) >= source[1]:
        return base
    # A raw version without a note of what the batch added (it was compacted since), or a fact that missed one: build it all again.
    follows = base is not None and base.applied.get(source[0], -1) == source[1] - 1 and source[0] in raw.added
    kinds = {f.name: f.dataType for f in ports.schema}
    void: Void | None = None

    def built(batches: Sequence[str], known: DataFrame | None = None) -> DataFrame:
        rows = read_batches(spark, raw_table, raw, batches)
        if known is not None:
            rows = rows.join(known.select(F.col("port_id").alias("i94port")), "i94port", "left_semi")
        return build_arrivals(rows, ports, already_distinct=True)

    if not follows:
        fact = built(raw.batches)
        edition = _store_small(ports, fact_table)
    else:
        fact = built(raw.added[source[0]])
        edition = base.notes[_PORTS]
        folder = f"{fact_table}/_voids/{edition}"
        before = spark.read.schema(T.StructType([T.StructField(n, k) for n, k in kinds.items()])).parquet(folder)
        changed = changed_keys(before, ports, "port_id")
        if not changed.isEmpty():
            values = _store_small(changed.select(F.col("port_id").alias("value")), fact_table)
            changed = spark.read.schema(T.StructType([T.StructField("value", kinds["port_id"])])).parquet(f"{fact_table}/_voids/{values}")
            earlier = [b for b in raw.batches if b not in raw.added[source[0]]]
            fact = fact.unionByName(built(earlier, changed.toDF("port_id")))
            void = Void("i94port", values, base.batches[-1]) if base.batches else None
            edition = _store_small(ports, fact_table)
    batch = new_batch(base)
    added = write_batch(fact, fact_table, batch, partition_by)
    kept = base if follows else None
    batches = (batch,) if added else ()
    return commit(
        spark,
        fact_table,
        Version(
            number=0,
            base=base.number if base else 0,
            schema=fact.schema.json(),
            partition_by=tuple(partition_by),
            batches=(*(kept.batches if kept else ()), *batches),
            rows=added + (kept.rows if kept else 0),
            operation="append" if kept else "replace",
            voids=(*(kept.voids if kept else ()), *([void] if void else [])),
            applied={**(base.applied if base else {}), source[0]: source[1]},
            added={source[0]: batches},
            notes={_PORTS: edition},
        ),
    )


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a stream, which its checkpoint keeps."""
    return json.loads(paths.read_file(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def ingest_arrivals(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    raw_table: str,
    fact_table: str,
    ports: DataFrame,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = ("year",),
    files_per_batch: int | None = None,
) -> None:
    """Take in new arrival files: append their new distinct raw rows, and what follows from them to the fact.

    ``raw_table`` holds every distinct source row, partitioned by arrival year and month. The outcome equals a full build
    over all files seen so far with the present ``ports``, which may differ from those of the last call. A call without new files
    leaves everything as it is, other ports or not. Both tables are read with ``read_table`` or ``read_version``.
    """
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def refresh(batch: DataFrame, batch_id: int) -> None:
        applied = (stream_name(spark, checkpoint), batch_id)
        arrived_on = sas_date("arrdate")
        dated = batch.withColumns({"arrival_year": F.year(arrived_on), "arrival_month": F.month(arrived_on)})
        append_distinct(dated, raw_table, ["arrival_year", "arrival_month"], source=applied)
        refresh_fact(spark, raw_table, fact_table, ports, source=applied, partition_by=partition_by)

    stream = stream_delimited(spark, source, columns, files_per_batch=files_per_batch)
    query = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def raw_rows(spark: SparkSession, raw_table: str) -> DataFrame:
    """The rows of a table of ``append_distinct`` without their digests."""
    return read_version(spark, raw_table).drop(*DIGEST)
