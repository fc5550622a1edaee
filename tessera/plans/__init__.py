"""Registered queries over the driver's tables, and the engine facade."""


def all_queries():
    """(queries, SQL) of every module of queries."""
    from tessera.plans import queries_documents, queries_edit, queries_gates, queries_graph, queries_lifecycle, queries_sources, queries_text, registry

    assert queries_graph and queries_text and queries_edit and queries_gates and queries_sources and queries_lifecycle and queries_documents
    return dict(registry.QUERIES), dict(registry.ORACLE_SQL)
