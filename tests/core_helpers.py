"""Helpers of the core tests."""


def rows(df, *columns):
    """Collected rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
