"""Names of all registered queries with their Spark plan and DuckDB oracle."""

from varspan.plans import flow_queries, record_queries, table_queries

QUERIES: dict = {**record_queries.QUERIES, **table_queries.QUERIES, **flow_queries.QUERIES}
ORACLES: dict[str, str] = {**record_queries.ORACLES, **table_queries.ORACLES, **flow_queries.ORACLES}
