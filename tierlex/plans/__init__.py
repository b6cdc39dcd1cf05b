"""All queries of the engine."""

from . import inputs, lexicon, membership, records, reefs, reports, streams  # noqa: F401
from .catalog import ORACLE_SQL, QUERIES  # noqa: F401
