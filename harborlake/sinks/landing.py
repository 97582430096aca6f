"""Files landed byte for byte, whatever their format, with a manifest of what has been landed.

A landed file is one or more rows (path, modified, length, sha256, piece, pieces, content) of a table of versions; a piece has
``PIECE_BYTES`` at most, so that rows and pages stay small. A file that was landed already, with the same length and time of
modification, is not read again; one that has changed since is landed again, and the newer edition counts.
Files without a single byte are nothing to Spark's scans and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborlake.versions import Version, is_versioned, latest, read_version, write_version

PIECE_BYTES = 64 << 20
_FILE = ("path", "modified", "length")


def _listed(spark: SparkSession, paths, suffix: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffix is not None:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(paths).withColumnRenamed("modificationTime", "modified")


def land_files(
    spark: SparkSession, source: str, target: str, *, suffix: str | None = None, piece_bytes: int = PIECE_BYTES
) -> Version:
    """Land the files below ``source`` that ``target`` does not have yet, and return the version that has them.

    A file is read by one task as one value (``spark.sql.sources.binaryFile.maxLength`` bounds it, 2 GB at most). A run that was
    cut leaves the previous version; files that another run has landed are left out of the next.
    """
    files = _listed(spark, source, suffix).select(*_FILE)
    if is_versioned(spark, target) and latest(spark, target) is not None:
        files = files.join(manifest(spark, target).select(*_FILE), list(_FILE), "left_anti")
    new = [r.path for r in files.select("path").collect()]  # the driver has listed them for the scan
    content = _listed(spark, new, None) if new else _listed(spark, source, suffix).where("1 = 0")
    pieces = F.greatest(F.lit(1), F.ceil(F.col("length") / piece_bytes)).cast("int")
    rows = content.select(*_FILE, F.sha2("content", 256).alias("sha256"), pieces.alias("pieces"), "content")
    rows = rows.select(
        *_FILE,
        "sha256",
        "pieces",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("pieces") - 1),
                lambda n: F.struct(n.alias("piece"), F.substring(F.col("content"), n * piece_bytes + 1, F.lit(piece_bytes)).alias("content")),
            )
        ).alias("part"),
    )
    return write_version(rows.select(*_FILE, "sha256", "pieces", "part.piece", "part.content"), target, append=True)


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """(path, modified, length, sha256, pieces) of the newest edition of each landed file; no content is read."""
    first = read_version(spark, target).where("piece = 0")
    newest = F.max(F.struct("modified", "length", "sha256", "pieces")).alias("newest")
    return first.groupBy("path").agg(newest).select("path", "newest.*")


def landed_files(spark: SparkSession, target: str) -> DataFrame:
    """(path, modified, length, sha256, content) of the newest edition of each landed file, put together again.

    A file whose bytes don't have the digest of the manifest is an error.
    """
    rows = read_version(spark, target).join(manifest(spark, target).select("path", "modified"), ["path", "modified"], "left_semi")
    parts = F.array_sort(F.collect_list(F.struct("piece", "content")))
    whole = rows.groupBy("path", "modified", "length", "sha256").agg(parts.alias("parts"))
    content = F.aggregate("parts", F.lit(b""), lambda all_of, p: F.concat(all_of, p.content))
    whole = whole.select("path", "modified", "length", "sha256", content.alias("content"))
    intact = (F.sha2("content", 256) == F.col("sha256")) & (F.octet_length("content") == F.col("length"))
    broken = F.raise_error(F.concat(F.lit("landed bytes differ from their digest: "), "path")).cast("binary")
    return whole.withColumn("content", F.when(intact, F.col("content")).otherwise(broken))


def landed_texts(spark: SparkSession, target: str, charset: str = "UTF-8") -> DataFrame:
    """(path, value): landed files as texts, as ``read_texts`` gives them."""
    return landed_files(spark, target).select("path", F.decode("content", charset).alias("value"))
