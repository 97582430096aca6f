"""De-duplication of a stream with bounded state: copies that come within the delay are dropped, rows that come later are kept aside."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from harborlake.sinks import paths
from harborlake.streaming.appending import stream_name
from harborlake.versions import latest, read_version, write_version

_SEEN = "__seen"
LATE = "late"


def _late_before(spark: SparkSession, checkpoint: str, batch_id: int) -> datetime:
    """Rows of this event time or an earlier one are late for Spark in a batch.

    It is the watermark of the batch before, unless stateful operators may not follow each other; the checkpoint notes each batch's
    watermark before the batch runs.
    """
    chained = spark.conf.get("spark.sql.streaming.statefulOperator.allowMultiple", "true").lower() == "true"
    number = batch_id - chained
    if number < 0:
        return datetime.fromtimestamp(0, timezone.utc)
    _, metadata, *_ = paths.read_file(spark, f"{checkpoint.rstrip('/')}/offsets/{number}").splitlines()
    return datetime.fromtimestamp(json.loads(metadata)["batchWatermarkMs"] / 1000, timezone.utc)


def ingest_distinct(
    stream: DataFrame, target: str, checkpoint: str, *, keys: Sequence[str], event_time: str, delay: str
) -> StreamingQuery:
    """Append what has arrived in ``stream`` to a table of versions, one row per key, then stop; returns the ended query.

    A row whose key came with an event time less than ``delay`` away is a copy and dropped; the state store holds the keys of that
    time only, however long the stream runs. A row that is older by ``delay`` or more than the newest event time known when the batch before
    began can no longer be compared: it goes to the ``late`` part of the table, in the same commit, as does one without event time.
    A batch that comes again after a cut is recognised by its number.
    """
    spark = stream.sparkSession
    moment = F.col(event_time)
    seen = stream.withColumn(_SEEN, F.lit(True))
    kept = stream.where(moment.isNotNull()).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    both = seen.unionByName(kept.withColumn(_SEEN, F.lit(False)))

    def store(batch: DataFrame, batch_id: int) -> None:
        passed = F.lit(_late_before(batch.sparkSession, checkpoint, batch_id)).cast("timestamp")
        late = F.col(_SEEN) & (moment.isNull() | (moment.cast("timestamp") <= passed))
        rows = batch.where(~F.col(_SEEN) | late).withColumnRenamed(_SEEN, LATE)
        source, done = (stream_name(spark, checkpoint), batch_id), latest(spark, target)
        if done is not None and done.applied.get(source[0], -1) >= batch_id:
            rows.write.format("noop").mode("overwrite").save()  # its rows are stored, the state of the batch may not be
        else:
            write_version(rows, target, [LATE], append=True, source=source)

    query = both.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def on_time(spark: SparkSession, target: str) -> DataFrame:
    """One row per key."""
    return read_version(spark, target).where(~F.col(LATE)).drop(LATE)


def late_rows(spark: SparkSession, target: str) -> DataFrame:
    """Rows that came too late to be compared, as they came."""
    return read_version(spark, target).where(F.col(LATE)).drop(LATE)
