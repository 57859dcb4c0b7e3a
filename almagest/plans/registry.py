"""All queries and their SQL; importing it registers the modules that hold them."""

from almagest.plans import audits, documents, queries, raw  # noqa: F401

QUERIES, ORACLE = queries.QUERIES, queries.ORACLE
