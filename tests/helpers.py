"""Small tables by name, with the declared column types."""

from budgetloom.sources.schemas import SCHEMAS, columns


def table(spark, name, *rows, **defaults):
    """Rows as dicts; columns not given are NULL."""
    names = columns(name)
    return spark.createDataFrame([tuple({**defaults, **r}.get(c) for c in names) for r in rows], SCHEMAS[name])
