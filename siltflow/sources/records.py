"""Change records in the JSON converter's form: {"schema": ..., "payload": ...}."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltflow.functions.convert import json_schema, of_json, to_json_value
from siltflow.functions.types import wire_schema
from siltflow.operators.quality import envelopes


def _complete(col: Column, schema: T.StructType) -> Column:
    """Whether required fields are there, in nested structs as well (an absent struct is fine if optional)."""
    ok = F.lit(True)
    for f in schema:
        if not f.nullable:
            ok = ok & col[f.name].isNotNull()
        if isinstance(f.dataType, T.StructType):
            ok = ok & (col[f.name].isNull() | _complete(col[f.name], f.dataType))
    return ok


def decode(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds record (a struct of schema) and ok (it parsed, and has what is required), from payload or else from value."""
    shape = json_schema(schema)
    corrupt = "__corrupt"
    if "payload" not in records.columns:
        records = envelopes(records).drop("head")
    parsed = F.from_json("payload", T.StructType([*shape.fields, T.StructField(corrupt, T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = records.withColumn("__parsed", parsed).drop("payload")
    rows = rows.withColumn("record", of_json(F.col("__parsed"), schema))
    ok = F.coalesce(F.col("__parsed")[corrupt].isNull() & _complete(F.col("record"), schema), F.lit(False))
    return rows.withColumn("ok", ok).drop("__parsed")


def encode(rows: DataFrame, topic: Column, partition: Column, offset: Column, schema: T.StructType | None = None) -> DataFrame:
    """Rows as change records (topic, partition, offset, value)."""
    schema = schema or rows.schema
    head = json.dumps(wire_schema(schema), separators=(",", ":"))
    payload = F.to_json(F.struct(*(to_json_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema)), {"ignoreNullFields": "false"})
    value = F.concat(F.lit('{"schema":' + head + ',"payload":'), payload, F.lit("}"))
    return rows.select(topic.cast("string").alias("topic"), partition.cast("int").alias("partition"), offset.cast("long").alias("offset"), value.alias("value"))


def read_records(spark: SparkSession, path: str, topics: list[str] | None = None, pattern: str | None = None) -> DataFrame:
    """Stored records of a subscription: some topics, or all that match a pattern as a whole."""
    return subscribe(spark.read.parquet(path), topics, pattern)


def subscribe(records: DataFrame, topics: list[str] | None = None, pattern: str | None = None) -> DataFrame:
    if topics:
        return records.filter(F.col("topic").isin(topics))
    return records.filter(F.col("topic").rlike(f"^(?:{pattern})$")) if pattern else records


def kafka_records(spark: SparkSession, servers: str, topics: list[str] | None = None, pattern: str | None = None, streaming: bool = True, **options: str) -> DataFrame:
    """Records of a Kafka subscription; needs Spark's Kafka package on the class path."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").option("kafka.bootstrap.servers", servers).options(**options)
    reader = reader.option("subscribe", ",".join(topics)) if topics else reader.option("subscribePattern", pattern)
    return reader.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
