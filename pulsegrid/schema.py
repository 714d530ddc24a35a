"""Explicit schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

from pulsegrid.catalogue import CATALOGUE

RECORD = "record"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def document_schema(metric_keys=tuple(m.key for m in CATALOGUE)) -> T.StructType:
    """Profile strings plus one array of sample strings per metric."""
    return T.StructType(
        _strings("identifier", "age", "gender", "bloodstype", "zip", "loaddate")
        + [T.StructField(k, T.ArrayType(T.StringType())) for k in metric_keys]
    )


SAMPLE = T.StructType(
    [T.StructField("value", T.DoubleType())]
    + _strings("unit", "uuid", "source", "version", "start_time", "end_time")
    + [
        T.StructField(
            "metadata", T.StructType(_strings("foodImageName", "foodType", "USDANumber", "meal"))
        )
    ]
)

GRADED_DIET = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("CAL_DIFF", "CARBS", "FAT", "PROTEIN")]
    + [T.StructField(n, T.DoubleType()) for n in ("CHOL", "SALT", "SUGAR")]
    + [T.StructField("GRADE", T.IntegerType())]
)
