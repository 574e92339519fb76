"""Helpers of the tests."""


def rows(df):
    """The rows of a DataFrame as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def around_cells(df):
    """The optimized plan above and below the place where lines become cells."""
    above, below = df._jdf.queryExecution().optimizedPlan().toString().split("Generate explode", 1)
    return above, below
