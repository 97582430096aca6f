"""The library's operators and jobs, run on the driver's tables, with SQL for the same results."""

from harborlake.catalogue import loads  # noqa: F401  (registers its queries)
from harborlake.catalogue.oracles import ORACLES
from harborlake.catalogue.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
