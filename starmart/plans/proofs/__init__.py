"""Proof queries: every operator run on the driver's tables, each with a DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (SQL over the tables as
views).  Column names are aliased identically on both sides.  Money sums use exact decimals
and floating statistics are rounded on both sides, so the two engines agree value by value.
Queries that write (round trips, refreshes, star tables) write under the shared checkpoint
folder.  Importing the submodules registers their queries, in this order.
"""

from . import core  # noqa: F401  (registration, in this order)
from . import io  # noqa: F401
from . import builds  # noqa: F401
from . import versions  # noqa: F401
from . import analyses  # noqa: F401
from . import trends  # noqa: F401
from . import summaries  # noqa: F401
from .registry import ORACLE, QUERIES, query  # noqa: F401

__all__ = ["QUERIES", "ORACLE", "query"]
