"""Rows of a frame in a form that tests compare."""

def rows(df, *order):
    """Rows as sorted tuples, missing values last."""
    out = [tuple(r) for r in df.select(*(order or df.columns)).collect()]
    return sorted(out, key=lambda r: [(v is None, v if v is not None else 0) for v in r])
