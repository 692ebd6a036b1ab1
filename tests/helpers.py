"""Small helpers shared by the tests."""


def rows(df, *columns):
    """Rows as tuples, in a stable order."""
    shown = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in shown.collect()), key=repr)


def close(got, want, digits=9):
    def plain(value):
        return round(value, digits) if isinstance(value, float) else value

    def settle(table):
        return sorted((tuple(plain(v) for v in r) for r in table), key=repr)

    assert settle(got) == settle(want)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
