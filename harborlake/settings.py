"""Session settings that depend on the amount of data."""

from __future__ import annotations

MB = 1 << 20

# What one task should get: small enough to stay in the memory of an executor core with
# room for hash tables, large enough that task start-up does not count.
TASK_BYTES = 128 * MB
# With very much data the number of tasks is the limit: the driver keeps a bit per pair of
# map task and reducer. Tasks grow instead, and sort or hash to disk what does not fit.
MOST_PARTITIONS = 40_000
LARGEST_SPLIT = 1024 * MB
FEW_CORES = 64


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a session that reads ``input_bytes`` (uncompressed) on ``cores`` executor cores.

    The widest shuffle here carries the full source rows, so shuffles start with one
    partition per ``TASK_BYTES`` of input; adaptive execution merges those that turn out
    small and splits hot ones. Pass the result to ``SparkSession.builder.config(map=...)``.
    """
    partitions = min(max(cores, -(-input_bytes // TASK_BYTES)), MOST_PARTITIONS)
    split = min(max(TASK_BYTES, input_bytes // MOST_PARTITIONS), LARGEST_SPLIT)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{min(split, LARGEST_SPLIT // 2) // MB}MB",
        "spark.sql.shuffle.partitions": str(partitions),
        # Creating a file takes longer than filling a small one, so a small table with many
        # partition directories is written by all cores; many cores would leave too many files.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB" if cores <= FEW_CORES else "1MB",
        "spark.sql.files.maxPartitionBytes": f"{split // MB}MB",
        # Files are compressed; a table is broadcast only if it is small when it is not.
        "spark.sql.sources.fileCompressionFactor": "5.0",
        # Tables that are built at the same time share the cores.
        "spark.scheduler.mode": "FAIR",
        # A table with a directory per date is listed by this many tasks, not one per directory.
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(cores),
    }
