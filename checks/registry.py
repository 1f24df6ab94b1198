"""Registry of queries and of the SQL each must agree with."""

from pyspark.sql import functions as F

from .views import Views, inline

QUERIES, ORACLES = {}, {}

# Views that only the SQL side uses (operators it has to spell out), by name.
SQL_VIEWS = {}


def check(name, sql=None):
    """Register ``fn(views) -> DataFrame`` and the SQL giving the same rows."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Views(spark, folder))
        if sql is not None:
            ORACLES[name] = inline(sql, "duckdb", SQL_VIEWS)
        return fn

    return register


def rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


def joined(df, *columns, sep=","):
    """Arrays as text, so that both engines give plain values."""
    return df.withColumns({c: F.array_join(F.col(c), sep) for c in columns})
