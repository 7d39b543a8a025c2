"""Every operator as a query over the given tables, with the SQL it must equal."""

from . import (  # noqa: F401
    aggregates,
    cleaning,
    endtoend,
    marts,
    matching,
    quality,
    scans,
    scoring,
    sketched,
    streams,
    temporal,
    terms,
)
from .registry import ORACLES, QUERIES  # noqa: F401
