"""Code = 'label' pairs out of SAS label texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harborlake.functions.text import strip

# Where the port block starts, and how far it goes (the first semicolon).
PORT_BLOCK_MARKER = "I94PORT"
_BLOCK = r"(?s)%s.+?;"
# Fixed value: a pair is split at the last equals sign of its line; only \n ends a line.
_PAIR = r"(?s)^(.+)=(.+)$"


def label_pairs(texts: DataFrame, text_column: str = "value", marker: str = PORT_BLOCK_MARKER) -> DataFrame:
    """``code`` and ``label`` of every pair in the first marked block of each text.

    Columns of ``texts`` other than the text itself are carried along. One text is one
    row, so texts are spread over the cluster and only the small block is exploded.
    """
    carried = [c for c in texts.columns if c != text_column]
    block = F.regexp_extract(F.col(text_column), _BLOCK % marker, 0)
    lines = texts.select(*carried, F.explode(F.split(block, "\n")).alias("__line"))
    return lines.where(F.col("__line").rlike(_PAIR)).select(
        *carried,
        strip(F.regexp_extract("__line", _PAIR, 1)).alias("code"),
        strip(F.regexp_extract("__line", _PAIR, 2)).alias("label"),
    )
