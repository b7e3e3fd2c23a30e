"""The typed layer: final casts of the cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.functions import columns as C


def cast_silver(table: str, df: DataFrame) -> DataFrame:
    """Cast to the silver types in table order; text that does not fit fails the job."""
    from_text = {name for name, kind in df.dtypes if kind == "string"}
    typed = []
    for name, kind in schemas.silver_types(table).items():
        if kind == "boolean" and name in from_text:
            value = C.boolean_word(F.col(name), schemas.BOOLEAN_ELSE.get((table, name)))
        elif kind in ("date", "timestamp_ntz") and name in from_text:
            value = C.strict(F.col(name), kind)
        else:
            value = F.col(name).cast(kind)
        typed.append(value.alias(name))
    return df.select(*typed)
