"""Operators for building a training corpus: thirteen operators, their queries and their SQL."""


def all_queries():
    """(queries, SQL counterparts) by name."""
    from aerometer.llm import queries

    return queries.QUERIES, queries.SQL
