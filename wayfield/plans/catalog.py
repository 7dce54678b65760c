"""All registered queries."""

from . import (  # noqa: F401
    cell_queries,
    join_queries,
    knn_queries,
    range_queries,
    stream_queries,
    text_queries,
    trajectory_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
