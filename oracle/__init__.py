"""SQL counterparts of the registered queries, for comparison in DuckDB."""


def statements() -> dict[str, str]:
    from oracle import measures, models, reports

    return {**models.Q, **reports.Q, **measures.Q}
