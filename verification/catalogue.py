"""All registered queries and the SQL each is checked against."""

from __future__ import annotations

from verification import ingest_queries, metric_queries, oracle_ingest, oracle_metrics

QUERIES = {**metric_queries.QUERIES, **ingest_queries.QUERIES}

ORACLE = {
    key: oracle_metrics.with_views(sql)
    for key, sql in {**oracle_metrics.METRICS, **oracle_ingest.RAW}.items()
}
