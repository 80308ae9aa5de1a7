"""JSON payloads to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import schemas

_BAD = "_corrupt_record"


def _parsed(df: DataFrame, ddl: str, column: str, keep: tuple[str, ...]) -> DataFrame:
    """Payload columns next to ``keep``. A one-element ``inline`` parses each record once,
    also when a filter on the parsed columns follows."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    row = F.from_json(column, f"{ddl}, {_BAD} string", options)
    return df.select(*keep, F.inline(F.array(row)))


def decode(df: DataFrame, ddl: str, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns of ``ddl`` read from a JSON text column, by field name.

    Unknown fields are ignored and missing ones become null. Records that are
    no JSON object of these types are left out here and returned by
    :func:`undecodable`.
    """
    present = df.where(F.col(column).isNotNull())
    return _parsed(present, ddl, column, keep).where(F.col(_BAD).isNull()).drop(_BAD)


def undecodable(df: DataFrame, ddl: str, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The values :func:`decode` leaves out."""
    value = F.col(column).alias("_value")
    rows = _parsed(df.withColumn("_value", value), ddl, column, ("_value", *keep))
    return rows.where(F.col("_value").isNull() | F.col(_BAD).isNotNull()).select(F.col("_value").alias(column), *keep)
