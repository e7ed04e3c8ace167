"""Every query of the library by name, with the SQL that must give the same rows."""

from __future__ import annotations

from .plans import automaton_queries, braking_queries, drive_queries, kpi_queries, report_queries, signal_queries, start_queries, streaming_queries, topic_queries

QUERIES: dict = {**signal_queries.QUERIES, **kpi_queries.QUERIES, **automaton_queries.QUERIES, **drive_queries.QUERIES, **start_queries.QUERIES, **braking_queries.QUERIES, **report_queries.QUERIES, **topic_queries.QUERIES, **streaming_queries.QUERIES}
ORACLE: dict[str, str] = {**signal_queries.ORACLE, **kpi_queries.ORACLE, **automaton_queries.ORACLE, **drive_queries.ORACLE, **start_queries.ORACLE, **braking_queries.ORACLE, **report_queries.ORACLE, **topic_queries.ORACLE, **streaming_queries.ORACLE}
