"""Archive-index responses: a JSON array of arrays whose first row is the header."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_cdx(responses: DataFrame, column: str = "body") -> DataFrame:
    """One row per index entry: the other columns of ``responses``, ``position`` and fields.

    Responses that are malformed, empty or only a header yield nothing.
    """
    rows = F.from_json(F.col(column), "array<array<string>>")
    entries = F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))
    others = [c for c in responses.columns if c != column]
    return (
        responses.select(*others, F.posexplode(entries).alias("position", "_row"))
        .select(
            *others,
            "position",
            F.get("_row", 0).alias("timestamp"),
            F.get("_row", 1).alias("original"),
            F.get("_row", 2).alias("statuscode"),
        )
    )


def status_ok(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("statuscode") == "200")
