"""Small helpers of several test modules."""


def values(df, *columns):
    """Sorted tuples of a frame."""
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
