"""Every query of the engine on the given tables, and the SQL that states what it must return."""

from folioflow.catalog import (
    guide_queries, invoice_queries, landed_queries, listing_queries, monitoring_queries, operations_queries, stream_queries,
)

QUERIES = {
    **listing_queries.QUERIES,
    **guide_queries.QUERIES,
    **invoice_queries.QUERIES,
    **operations_queries.QUERIES,
    **stream_queries.QUERIES,
    **landed_queries.QUERIES,
    **monitoring_queries.QUERIES,
}
ORACLE = {
    **listing_queries.ORACLE,
    **guide_queries.ORACLE,
    **invoice_queries.ORACLE,
    **operations_queries.ORACLE,
    **stream_queries.ORACLE,
    **landed_queries.ORACLE,
    **monitoring_queries.ORACLE,
}
