"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row global aggregate (e.g. totals) to every row of ``df``.

    Each column becomes a scalar subquery (computed once, no join), the plan
    form of "total = (SELECT sum(...) FROM ...)".
    """
    return df.select("*", *[one_row.select(F.col(c)).scalar().alias(c) for c in one_row.columns])
