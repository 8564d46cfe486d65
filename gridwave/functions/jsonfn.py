"""JSON in and out with fixed schemas (no inference)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridwave.schemas import DECODED_RECORDING


def parse_json(text: Column, schema: StructType = DECODED_RECORDING) -> Column:
    """JSON text (or binary) -> struct; missing fields -> null."""
    return F.from_json(text.cast("string"), schema)


def render_json(struct_col: Column) -> Column:
    return F.to_json(struct_col)
