"""All queries of the subpackage."""

from . import queries_audits, queries_learned, queries_native, queries_spans  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
