"""Named queries over the supplied tables, each with the oracle's SQL where SQL can express it."""

from ticketmill.queries import clusters, marts, tables, texts

QUERIES = tables.QUERIES
ORACLE = tables.ORACLE

__all__ = ["ORACLE", "QUERIES", "clusters", "marts", "texts"]
