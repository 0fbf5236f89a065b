"""Helpers that tests import by name; a module of its own, since several folders have a ``conftest``."""


def bag(df, *columns):
    """The rows of a DataFrame as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.select(*(columns or df.columns)).collect()), key=repr)
