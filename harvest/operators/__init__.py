"""DataFrame operators: each is ``f(df, ...) -> DataFrame`` and builds a lazy plan."""
