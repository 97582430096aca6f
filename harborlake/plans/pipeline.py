"""The whole run: ports first, then the four tables that need them or stand alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, types as T

from harborlake import schemas
from harborlake.plans.quality import check_ports, write_checked_version
from harborlake.plans.tables import (
    RECENT_DAYS,
    build_airports,
    build_arrivals,
    build_city_demographics,
    build_land_temperatures,
    build_ports,
)
from harborlake.sinks import land, preview, write_delimited
from harborlake.sources import read_any, read_delimited, read_table, read_texts, with_types


@dataclass(frozen=True)
class Locations:
    """Where everything is: one place, so that landing and builds cannot disagree."""

    landing: str
    tables: str

    @property
    def ports(self) -> str:
        return self.landed("ports")

    def landed(self, name: str) -> str:
        """Folder of a source: labels, airport, city_demo, imm, land_temp, and the derived ports."""
        return f"{self.landing}/{name}"

    def table(self, name: str) -> str:
        return f"{self.tables}/{name}"


@dataclass(frozen=True)
class Extract:
    """Source files that are landed before their table is built, found at any depth below ``path``."""

    path: str
    fmt: str
    suffix: str | None = None
    schema: T.StructType | str | None = None
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class TableResult:
    """Outcome of one build; ``error`` is None when it went well."""

    table: str
    rows: int | None
    error: str | None


def land_extracts(
    spark: SparkSession, extract: Extract, target: str, *, fmt: str = "parquet", sep: str = ","
) -> DataFrame:
    """Land all files of an extract as one dataset, replacing the previous one; returns a preview row.

    They are read and written in one job, so no file replaces another's rows. Parquet keeps every text as it is;
    ``fmt="csv"`` trims blanks, makes empty texts null and lets line ends break rows. ``land_files`` keeps the bytes of the files.
    """
    rows = read_any(
        spark,
        extract.fmt,
        extract.path,
        schema=extract.schema,
        suffix=extract.suffix,
        recursive=True,
        options=extract.options,
    )
    if fmt == "csv":
        write_delimited(rows, target, sep=sep)
    else:
        land(rows, target, fmt)
    return preview(rows)


def read_ports(spark: SparkSession, path: str) -> DataFrame:
    """The port reference folder, every part file of it."""
    return read_delimited(spark, path, schema=schemas.ddl(schemas.PORTS))


def register_views(spark: SparkSession, locations: Locations) -> None:
    """Make the built tables and the ports known to Spark SQL as temporary views."""
    read_ports(spark, locations.ports).createOrReplaceTempView("ports")
    for name, columns in schemas.TABLES.items():
        table = read_table(spark, locations.table(name), schemas.ddl(columns))
        table.createOrReplaceTempView(name)


def run_pipeline(
    spark: SparkSession,
    locations: Locations,
    *,
    as_of: date | None = None,
    max_days: int = RECENT_DAYS,
    concurrency: int = 3,
    extracts: Mapping[str, Extract] | None = None,
    sources: Mapping[str, DataFrame] | None = None,
) -> list[TableResult]:
    """Build every table from its landed source and report on each of them.

    A failing port build stops the run, since three tables depend on it; a failing table
    does not stop the others. ``extracts`` (airport, city_demo, imm, land_temp) are landed
    first, as Parquet; ``sources`` (these and labels) replaces landed CSV folders by other DataFrames.
    Every table gets a new version (``harborlake.versions``), which ``read_table`` finds; older ones stay until they are expired.
    """
    given = dict(sources or {})
    to_land = dict(extracts or {})

    def source(name: str, **read) -> DataFrame:
        if name in given:
            return given[name]
        folder = locations.landed(name)
        if name not in to_land:
            return read_delimited(spark, folder, **read)
        land_extracts(spark, to_land[name], folder)
        landed = read_table(spark, folder)
        return with_types(landed, read["types"]) if "types" in read else landed

    def ports() -> DataFrame:
        return read_ports(spark, locations.ports)

    def airport() -> DataFrame:
        return build_airports(source("airport"))

    def city_demo() -> DataFrame:
        return build_city_demographics(
            source("city_demo", sep=";", types=schemas.DEMOGRAPHICS_TYPES), ports()
        )

    def imm() -> DataFrame:
        return build_arrivals(source("imm"), ports())

    def land_temp() -> DataFrame:
        return build_land_temperatures(
            source("land_temp", types=schemas.TEMPERATURE_TYPES), ports(), as_of=as_of, max_days=max_days
        )

    builds = {
        "airport": (airport, ()),
        "city_demo": (city_demo, ()),
        "imm": (imm, ("year",)),
        "land_temp": (land_temp, ("dt",)),
    }

    def build(name: str) -> TableResult:
        spark.sparkContext.setJobDescription(f"build {name}")
        # With FAIR scheduling the tables share the cluster instead of queueing for it.
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        make, partition_by = builds[name]
        try:
            written = write_checked_version(make(), locations.table(name), partition_by)
        except Exception as error:  # reported, so that the other tables are still built
            return TableResult(name, None, f"{type(error).__name__}: {error}")
        return TableResult(name, written.rows, None)

    labels = given["labels"] if "labels" in given else read_texts(spark, locations.landed("labels"))
    write_delimited(build_ports(labels), locations.ports)
    check_ports(labels, ports())
    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(build), name) for name in builds]
        return [run.result() for run in runs]


def pipeline_report(spark: SparkSession, results: Sequence[TableResult]) -> DataFrame:
    """One row (table, rows, error) per build."""
    rows = [(r.table, r.rows, r.error) for r in results]
    return spark.createDataFrame(rows, "table string, rows bigint, error string")
