"""Schemas of the market tables."""

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType


def _fields(**kinds) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in kinds.items()])


RAW_TRADE = _fields(symbol=StringType(), price=DoubleType(), volume=DoubleType(), timestamp=LongType())
BRONZE = _fields(symbol=StringType(), price=DoubleType(), volume=DoubleType(), timestamp=LongType(), event_time=TimestampType())
DEAD_LETTER = StructType([*BRONZE.fields, StructField("dq_reason", StringType()), StructField("ingested_at", TimestampType())])
BAR = _fields(window_start=TimestampType(), window_end=TimestampType(), symbol=StringType(), open=DoubleType(), high=DoubleType(), low=DoubleType(), close=DoubleType(), total_volume=DoubleType())
FEATURE = StructType([*BAR.fields[:-1], StructField("total_volume", LongType()), *_fields(rolling_avg_close=DoubleType(), rolling_volatility_close=DoubleType(), event_timestamp=TimestampType()).fields])
CANDLES = "struct<t: array<bigint>, o: array<double>, h: array<double>, l: array<double>, c: array<double>, v: array<double>>"
"""One provider answer: arrays of equal length."""
