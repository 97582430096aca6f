"""Text column expressions. All are Spark built-ins, so they stay in generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str

# Fixed value: white space as Python's str.strip() sees it. (?U) makes \s Unicode-aware;
# the four information separators count as white space in Python but not in Java.
_WHITESPACE = r"[\s\x1c-\x1f]"


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def part_of(value: ColumnOrName, separator: str, index: int) -> Column:
    """Zero-based part of a separated text; null when the text has no such part.

    The split stops right after the wanted part, and ``get`` gives null where ``[]``
    raises under ANSI mode.
    """
    pattern = re.sub(r"([][\\.^$|?*+(){}])", r"\\\1", separator)
    return F.get(F.split(as_column(value), pattern, index + 2), F.lit(index))


def strip(value: ColumnOrName) -> Column:
    """Remove white space of every kind (tabs, line ends) at both ends; ``trim`` removes blanks only."""
    return F.regexp_replace(as_column(value), f"(?U)^{_WHITESPACE}+|{_WHITESPACE}+$", "")


def unquote(value: ColumnOrName) -> Column:
    """Drop the first and the last character, whatever they are; empty when shorter than three."""
    text = as_column(value)
    return F.substring(text, F.lit(2), F.length(text) - 2)


def without_chars(value: ColumnOrName, chars: str) -> Column:
    """Remove every occurrence of the given characters."""
    return F.translate(as_column(value), chars, "")


def lower_key(value: ColumnOrName) -> Column:
    """Conformed form of a name, used as a join key."""
    return F.lower(as_column(value))
