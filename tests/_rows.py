"""Helper of the operator tests."""


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive compare)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
