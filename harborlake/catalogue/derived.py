"""Raw sources in the shape the builds expect, derived by Spark from the driver's tables.

Every source keeps the size of its table: orders become arrivals, lineitem becomes
temperature measurements, customer becomes demographics rows, part becomes airports and
nation becomes the port labels.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborlake.plans import build_ports

AS_OF = date(2001, 12, 1)
MAX_DAYS = 900

# Which race a market segment stands for.
SEGMENT_RACES = {
    "AUTOMOBILE": "American Indian and Alaska Native",
    "BUILDING": "Asian",
    "FURNITURE": "Black or African-American",
    "HOUSEHOLD": "Hispanic or Latino",
    "MACHINERY": "White",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column) -> F.Column:
    return F.col(column).cast("string") if isinstance(column, str) else column.cast("string")


def label_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label text per nation: two port codes with the same city, between two other blocks."""
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        F.format_string(
            "/* I94CIT */\n   582 =  'MEXICO Air Sea'\n;\n/* I94PORT - valid codes */\r\n"
            "   'P%1$d'\t=\t'%2$s, %1$d          '\r\n   'Q%1$d'\t=\t'%2$s, X%3$d  '\n   'R%1$d' = 'NO CITY %1$d   '\n;\n"
            "/* I94MODE */\n   1 = 'Air'\n;\n",
            "n_nationkey",
            "n_name",
            "n_regionkey",
        ).alias("value")
    )


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_ports(label_texts(spark, sf_dir))


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns only; finished orders occur twice, some ports are unknown or missing, some dates too."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.concat(text("o_orderkey"), F.lit(".0")).alias("cicid"),
        F.concat(text(F.year("o_orderdate")), F.lit(".0")).alias("i94yr"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("P"), text(F.col("o_custkey") % 30))).alias(
            "i94port"
        ),
        F.when(
            F.col("o_orderpriority") != "4-NOT SPECIFIED",
            F.concat(text(F.datediff("o_orderdate", F.lit(date(1960, 1, 1)))), F.lit(".0")),
        ).alias("arrdate"),
        F.col("o_orderstatus").alias("status"),
    )
    copies = F.when(F.col("status") == "F", 2).otherwise(1)
    return rows.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy", "status")


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    group = (F.col("c_custkey") % 4).cast("int")
    race = F.create_map(*[F.lit(v) for pair in SEGMENT_RACES.items() for v in pair])[F.col("c_mktsegment")]
    return customer.select(
        F.concat(F.lit("Nation_"), text("c_nationkey")).alias("City"),
        F.concat(F.lit("State "), text(group)).alias("State"),
        (group + F.lit(30.5)).alias("Median Age"),
        (group * 1000).alias("Male Population"),
        (group * 1100).alias("Female Population"),
        (group * 2100).alias("Total Population"),
        F.nullif(group * 10, F.lit(10)).alias("Number of Veterans"),
        (group * 7).alias("Foreign-Born"),
        F.nullif(group / F.lit(2.0), F.lit(0.5)).alias("Average Household Size"),
        text((F.col("c_custkey") % 4) * 5 + F.col("c_nationkey") % 5).alias("State Code"),
        race.alias("Race"),
        F.floor("c_acctbal").cast("int").alias("Count"),
    )


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large parts occur twice; small ones have a region without a second part."""
    part = table(spark, sf_dir, "part")
    rows = part.select(
        text("p_partkey").alias("ident"),
        F.col("p_type").alias("type"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") < 5, F.lit("Brand"))
        .otherwise(F.concat_ws("-", F.translate("p_brand", "#", "-"), text("p_size")))
        .alias("iso_region"),
        "p_size",
    )
    copies = F.when(F.col("p_size") > 25, 2).otherwise(1)
    return rows.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy", "p_size")


def raw_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines of an order occur twice; other cities than the ports' are measured, too."""
    lineitem = table(spark, sf_dir, "lineitem")
    copies = F.when(F.col("l_linenumber") == 1, 2).otherwise(1)
    return lineitem.select(
        F.col("l_shipdate").cast("date").alias("dt"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("AverageTemperature"),
        F.col("l_discount").alias("AverageTemperatureUncertainty"),
        F.concat(F.lit("Nation_"), text(F.col("l_suppkey") % 30)).alias("City"),
        F.col("l_linestatus").alias("Country"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    ).drop("copy")
