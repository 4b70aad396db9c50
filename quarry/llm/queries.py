"""The queries of this subpackage and the SQL that DuckDB can check them with."""

from __future__ import annotations

from . import ann, decontaminate, filter_audit, language_id, license_scan, lm_score, mix, near_dedup, packing, runs, shard, token_counts, url_filter

_MODULES = (decontaminate, mix, near_dedup, license_scan, language_id, url_filter, ann, lm_score, shard, token_counts, filter_audit, packing, runs)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
