"""Unusable records, and rows that a table has already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = ("topic", "partition")


OPEN, BETWEEN = '{"schema":', ',"payload":'


def envelopes(records: DataFrame) -> DataFrame:
    """Adds head (all before the payload) and payload (a text) of values {"schema": struct, "payload": object}; nulls for others.

    Converters write the two without blanks and in this order. Such values are cut at the fixed
    text between them; only others are parsed.
    """
    value, head, rest = F.col("value"), F.col("head"), F.col("rest")
    cut = records.withColumns({"head": F.substring_index(value, BETWEEN, 1), "rest": F.substring_index(value, BETWEEN, -1)})
    once = F.octet_length(head) + F.octet_length(rest) + F.lit(len(BETWEEN)) == F.octet_length(value)
    plain = F.coalesce(once & head.startswith(OPEN + "{") & rest.startswith("{") & rest.endswith("}}"), F.lit(False))
    cut = cut.withColumn("plain", plain)
    schema, payload = F.get_json_object(value, "$.schema"), F.get_json_object(value, "$.payload")
    ok = (F.get_json_object(schema, "$.type") == "struct") & F.ltrim(payload).startswith("{")
    return cut.withColumns({
        "head": F.when(F.col("plain"), head).when(ok, F.concat(F.lit(OPEN), schema)),
        "payload": F.when(F.col("plain"), F.substring(rest, F.lit(1), F.length(rest) - 1)).when(ok, payload),
    }).drop("rest", "plain")


def schemas(records: DataFrame, part: tuple[str, ...] = PART) -> DataFrame:
    """For each topic, partition (all of part) and head (null: none): the first and last offset, the rows, and in `wanted` the
    schema without blanks if it is a struct's. One row a distinct text, so only these are parsed."""
    found = envelopes(records).groupBy(*part, "head").agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count("*").alias("n"))
    schema = F.get_json_object(F.concat("head", F.lit("}")), "$.schema")
    return found.withColumn("wanted", F.when(F.get_json_object(schema, "$.type") == "struct", schema))


def reference_schemas(records: DataFrame, part: tuple[str, ...] = PART) -> DataFrame:
    """For each topic and partition (all of part) the first usable schema by offset, the last offset, the rows, and by their hashes the heads that
    say the same as the reference, with their rows.

    Every step is an aggregate that merges: by head, by what the heads say, by partition. So the records are read once, and
    only the distinct heads are parsed; a join with the reference would let the optimiser parse each record for its key.
    """
    said = schemas(records, part).groupBy(*part, "wanted").agg(
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"), F.sum("n").alias("n"), F.collect_list(F.when(F.col("wanted").isNotNull(), F.xxhash64("head"))).alias("heads")
    )
    first = F.min_by(F.struct("wanted", "heads", "n"), F.when(F.col("wanted").isNotNull(), F.col("first_offset")))
    own = said.groupBy(*part).agg(first.alias("r"), F.max("last_offset").alias("last_offset"), F.sum("n").alias("n"))
    return own.select(*part, F.col("r.wanted").alias("reference"), "last_offset", "n", F.coalesce("r.heads", F.expr("cast(array() as array<long>)")).alias("heads"), F.coalesce("r.n", F.lit(0)).alias("fit"))


def fits(heads: Column) -> Column:
    """Whether a record with its head is of the wanted schema: others are tombstones, values without a schema, other schemas."""
    return F.coalesce(F.array_contains(heads, F.xxhash64("head")) & F.col("head").isNotNull(), F.lit(False))


def app_id(name: str) -> Column:
    return F.concat(F.lit(f"{name}:"), F.col("topic"), F.lit("-"), F.col("partition").cast("string"))


def not_applied(records: DataFrame, applied: dict[str, int], name: str, key: Column | None = None) -> DataFrame:
    """Records whose offset is beyond what is applied for their topic and partition."""
    if not applied:
        return records
    pairs = [F.lit(x) for kv in applied.items() for x in kv]
    last = F.element_at(F.create_map(*pairs), key if key is not None else app_id(name))
    return records.filter(F.coalesce(F.col("offset") > last, F.lit(True)))
