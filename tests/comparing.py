"""What the test modules share."""


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (all by default)."""
    got = [tuple(r) for r in df.collect()]
    at = [df.columns.index(c) for c in order] or range(len(df.columns))
    return sorted(got, key=lambda r: [(r[i] is not None, r[i]) for i in at])
