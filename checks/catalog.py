"""All queries."""

from . import (  # noqa: F401
    alignment_queries,
    annotation_queries,
    read_queries,
    source_queries,
    taxonomy_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
