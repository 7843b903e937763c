"""What several test modules use."""


def collected(df, *columns):
    """All rows as plain tuples, in a fixed order."""
    frame = df.select(*columns) if columns else df
    values = [tuple(row) for row in frame.collect()]
    return sorted(values, key=lambda row: [(v is not None, str(v)) for v in row])
