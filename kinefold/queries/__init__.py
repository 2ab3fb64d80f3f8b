"""Registered queries and their SQL."""

from . import image_queries, vector_queries

QUERIES = {**vector_queries.QUERIES, **image_queries.QUERIES}


def queries():
    return {name: spark_side for name, (spark_side, _) in QUERIES.items()}


def oracle_sql():
    return {name: text for name, (_, text) in QUERIES.items() if text}
