"""Tasks that die after they have passed on all their rows must not change any result."""

from pyspark.sql import functions as F

from conftest import rows
from harborlake.operators import dedupe
from harborlake.plans import build_arrivals, unmatched_report, write_checked
from harborlake.sinks import overwrite_partitions
from harborlake.sources import read_table
from harborlake.streaming import upsert_partitions


def lossy(df):
    def dying(batches):
        """All rows, then death, in the first attempt of every second task."""
        from pyspark import TaskContext

        yield from batches
        context = TaskContext.get()
        if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
            raise RuntimeError("lost")

    return df.mapInPandas(dying, df.schema)


def arrivals(spark):
    """A third of the rows are copies of one row."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, 3000, 1, 6).select(
        F.when(hot, "0.0").otherwise(F.col("id").cast("string")).alias("cicid"),
        F.when(hot, "NYC").otherwise(F.concat(F.lit("P"), F.col("id") % 7)).alias("i94port"),
        F.when(hot, "20573.0").otherwise(F.concat(F.col("id") + 15000, F.lit(".0"))).alias("arrdate"),
    )


def ports(spark):
    data = [("NYC", "NEW YORK, NY", "new york", "NY"), *((f"P{i}", f"C{i}", f"c{i}", None) for i in range(5))]
    return spark.createDataFrame(data, "port_id string, city_state string, city string, state string")


def test_checked_writes(spark, tmp_path):
    raw = arrivals(spark)
    assert write_checked(lossy(raw), str(tmp_path / "flat")).sent == 3000
    assert write_checked(lossy(raw.withColumn("p", F.lit(1))), str(tmp_path / "parts"), ["p"]).sent == 3000


def test_fact(spark, tmp_path):
    raw = arrivals(spark)
    expected = build_arrivals(raw, ports(spark))
    fact = build_arrivals(lossy(raw), ports(spark))
    written = write_checked(fact, str(tmp_path / "imm"), ["year"])
    assert written.sent == written.stored == expected.count()
    assert rows(read_table(spark, str(tmp_path / "imm")).select(*expected.columns)) == rows(expected)


def test_keyed_dedupe_is_the_same_every_time(spark):
    raw = arrivals(spark)
    assert rows(dedupe(lossy(raw), ["i94port"])) == rows(dedupe(raw.repartition(11, "cicid"), ["i94port"]))


def test_reports_and_upserts(spark, tmp_path):
    raw, known = arrivals(spark), ports(spark)
    assert rows(unmatched_report(lossy(raw), known, "i94port", "port_id")) == rows(
        unmatched_report(raw, known, "i94port", "port_id")
    )
    target = str(tmp_path / "t")
    overwrite_partitions(raw.distinct().where("i94port <> 'P1'"), target, ["i94port"])
    upsert_partitions(lossy(raw), target, ["i94port"])
    assert rows(read_table(spark, target).select(*raw.columns)) == rows(raw.distinct())
