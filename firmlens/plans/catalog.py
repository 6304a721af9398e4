"""Every query over the driver's tables, by name, with its DuckDB SQL."""

from __future__ import annotations

from firmlens.plans import calls, completion, enrichment, matching, office, people, ranking, runs, streams, tables, tasks, web

_ALL = web.QUERIES | people.QUERIES | matching.QUERIES | tables.QUERIES | runs.QUERIES | calls.QUERIES | ranking.QUERIES | completion.QUERIES | tasks.QUERIES | office.QUERIES | streams.QUERIES | enrichment.QUERIES

QUERIES = {name: query for name, (query, _) in _ALL.items()}
ORACLE_SQL = {name: sql for name, (_, sql) in _ALL.items() if sql}
