"""Fields of messages that the schema doesn't know: which there are, and making one a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.schemas import EXTRA, WITH_EXTRA
from tellerbook.sources.bronze import read_bronze


def read_bronze_with_extra(spark: SparkSession, root: str, file_format: str = "parquet") -> DataFrame:
    """Accepted events with ``extra``; batches ingested without it give NULL."""
    return read_bronze(spark, root, added=WITH_EXTRA, file_format=file_format)


def unknown_fields(rows: DataFrame) -> DataFrame:
    """One row: how many rows have unknown fields, and the schema that fits them all.

    The schemas of rows are merged in the tasks before any exchange.
    """
    return rows.agg(
        F.count(EXTRA).alias("rows"),
        F.schema_of_variant_agg(EXTRA).alias("fields"),
    )


def promote_field(rows: DataFrame, path: str, kind: str, name: str) -> DataFrame:
    """Add a column from ``extra``, in all batches that kept it, old ones too.

    ``path`` is a JSON path such as ``$.device.os``. Where the field is absent, or its
    value is none of the type ``kind``, the column is NULL.
    """
    if name in rows.columns:
        raise ValueError(f"there is a column {name} already")
    return rows.withColumn(name, F.try_variant_get(EXTRA, path, kind))
