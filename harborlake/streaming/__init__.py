from harborlake.streaming.appending import append_distinct, ingest_arrivals, raw_rows, refresh_fact
from harborlake.streaming.bounded import ingest_distinct, late_rows, on_time
from harborlake.streaming.incremental import ingest_new_files, upsert_partitions

__all__ = [
    "append_distinct",
    "ingest_arrivals",
    "ingest_distinct",
    "ingest_new_files",
    "late_rows",
    "on_time",
    "raw_rows",
    "refresh_fact",
    "upsert_partitions",
]
