from harborlake.sources.readers import (
    read_any,
    read_delimited,
    read_table,
    read_texts,
    stream_delimited,
    type_misfits,
    with_types,
)

__all__ = ["read_any", "read_delimited", "read_table", "read_texts", "stream_delimited", "type_misfits", "with_types"]
