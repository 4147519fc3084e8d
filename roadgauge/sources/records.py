"""JSON records: decoding, bad-record split and stream sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

_BAD = "_corrupt"


def identity(schema: StructType) -> list[str]:
    """Fields that a record needs to be known again: its event and what it is about."""
    about = "delivery_id" if "delivery_id" in schema.fieldNames() else "vehicle_id"
    return [name for name in ("event_id", about) if name in schema.fieldNames()]


def parse_json(df: DataFrame, text: Column, schema: StructType) -> DataFrame:
    """Add ``data`` (fields per schema) and ``error`` (null for a good record).

    A record is bad if it is no JSON object of the schema, its timestamp does not parse, or it
    lacks an id.
    """
    wide = StructType([*schema.fields, StructField(_BAD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = df.withColumn("raw", text).withColumn("data", F.from_json("raw", wide, options))
    stamp = F.try_to_timestamp(F.col("data.timestamp"))
    error = (
        F.when(F.col("raw").isNull(), "no payload")
        .when(F.col("data").isNull() | F.col(f"data.{_BAD}").isNotNull(), "malformed JSON")
        .when(stamp.isNull(), "bad timestamp")
    )
    for name in identity(schema):
        error = error.when(F.trim(F.col(f"data.{name}").cast("string")).isin("") | F.col(f"data.{name}").isNull(), f"no {name}")
    return parsed.withColumn("event_timestamp", stamp).withColumn("error", error)


def unwrap(df: DataFrame, payload: str, schema: StructType) -> DataFrame:
    """Decode base64-wrapped JSON payloads."""
    text = F.try_to_binary(F.col(payload), F.lit("base64")).cast("string")
    return parse_json(df, text, schema)


def good(parsed: DataFrame, schema: StructType) -> DataFrame:
    """The fields of good records and their event_timestamp."""
    return parsed.where("error is null").select(
        *[F.col(f"data.{name}").alias(name) for name in schema.fieldNames()], "event_timestamp",
    )


def bad(parsed: DataFrame) -> DataFrame:
    """Raw text and error of bad records."""
    return parsed.where("error is not null").select("raw", "error")


def counted(parsed: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """Count good and bad records in the pass that writes them."""
    seen = Observation(name)
    return parsed.observe(
        seen, F.count_if(F.col("error").isNull()).alias("processed"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    ), seen


def read_stream(spark: SparkSession, source: str, options: dict[str, str], schema: StructType,
                value: str = "value") -> DataFrame:
    """Parsed record stream of any source with a binary or text value column.

    ``source`` is "kafka", "text" (files of JSON lines) or another installed format; a
    broker source should start at "latest" unless its options say otherwise.
    """
    raw = spark.readStream.format(source).options(**options).load()
    return parse_json(raw, F.col(value).cast("string"), schema)
