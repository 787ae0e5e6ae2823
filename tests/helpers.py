"""Shared by the tests."""


def bag(df):
    """The rows of a DataFrame as a sorted list of tuples, columns by name."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
