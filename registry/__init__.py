"""Every registered query: (spark, folder) -> DataFrame over the supplied tables."""

from registry import growth, ingest, people, serving

QUERIES = {**growth.QUERIES, **ingest.QUERIES, **serving.QUERIES, **people.QUERIES}
