"""All queries of the engine by name, with their DuckDB equivalents."""

from __future__ import annotations

from tracklake.plans import behaviour, curation, detection, frames

FLAGSHIP = "track_events"
QUERIES = curation.QUERIES | detection.QUERIES | behaviour.QUERIES | frames.QUERIES
ORACLE_SQL = curation.ORACLE_SQL | detection.ORACLE_SQL | behaviour.ORACLE_SQL | frames.ORACLE_SQL
