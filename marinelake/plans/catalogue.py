"""All registered queries."""

from marinelake.plans import (
    instrument_queries,
    job_queries,
    line_queries,
    output_queries,
    record_queries,
    stream_queries,
)
from marinelake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
