"""Views over the given tables and the registered queries."""


def all_queries():
    """(queries, SQL counterparts) by name."""
    from aerometer.plans import registry
    from aerometer.plans import (flight_queries, load_queries, meter_queries, model_queries, point_queries,  # noqa: F401
                                 store_queries, stream_queries)

    return registry.QUERIES, registry.SQL
