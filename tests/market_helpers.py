def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.select(*order).collect()), key=lambda r: [(x is not None, x) for x in r]) if order else sorted(map(tuple, df.collect()), key=repr)
