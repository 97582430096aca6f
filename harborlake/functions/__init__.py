from harborlake.functions.dates import calendar_parts, day_difference, exact_avg, sas_date
from harborlake.functions.digests import row_digest
from harborlake.functions.text import lower_key, part_of, strip, unquote, without_chars

__all__ = [
    "calendar_parts",
    "day_difference",
    "exact_avg",
    "lower_key",
    "part_of",
    "row_digest",
    "sas_date",
    "strip",
    "unquote",
    "without_chars",
]
