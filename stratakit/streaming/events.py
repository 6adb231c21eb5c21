"""Events as JSON envelopes: encoding, parsing, and the dead-letter classifier.

A message is ``value`` (bytes) with ``topic, partition, offset``.  Its envelope
has ``event_id, event_type, event_timestamp, payload``; the payload is JSON
text, or an object.  One CASE expression names the first reject class that
holds; the rest of the messages are valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Reject classes in the order they are tried (fixed values).
EMPTY, UNDECODABLE, BAD_ENVELOPE, ENVELOPE_SHAPE, MISSING_FIELDS, BAD_PAYLOAD, PAYLOAD_SHAPE, MISSING_KEYS = (
    "bronze_kafka_empty_value",
    "bronze_kafka_decode_error",
    "bronze_invalid_envelope_json",
    "bronze_invalid_envelope_shape",
    "bronze_missing_event_fields",
    "bronze_invalid_payload_json",
    "bronze_invalid_payload_shape",
    "bronze_missing_natural_keys",
)
REASONS = {
    EMPTY: "the message has no value",
    UNDECODABLE: "the value isn't UTF-8",
    BAD_ENVELOPE: "the envelope isn't JSON",
    ENVELOPE_SHAPE: "the envelope isn't an object",
    MISSING_FIELDS: "the event id or the payload is missing",
    BAD_PAYLOAD: "the payload isn't JSON",
    PAYLOAD_SHAPE: "the payload isn't an object",
    MISSING_KEYS: "a natural key is missing",
}
LINEAGE = ("_event_id", "_kafka_partition", "_kafka_offset", "_ingestion_timestamp")


def encode(rows: DataFrame, event_id: Column, event_type: str, event_time: Column, columns: list[str] | None = None, year: Column | None = None, year_column: str = "ano") -> DataFrame:
    """``value``: each row as an envelope, its ``columns`` (all) as payload;
    ``year`` fills a missing year."""
    names = columns or rows.columns
    filled = {c: F.col(c) for c in names}
    if year is not None:
        filled[year_column] = F.coalesce(filled[year_column], year) if year_column in filled else year
    payload = F.to_json(F.struct(*[c.alias(n) for n, c in filled.items()]), {"ignoreNullFields": "false"})
    envelope = F.struct(event_id.cast("string").alias("event_id"), F.lit(event_type).alias("event_type"), event_time.cast("string").alias("event_timestamp"), payload.alias("payload"))
    return rows.select(F.to_json(envelope).cast("binary").alias("value"))


def _falsy(text: Column) -> Column:
    """JSON of nothing, empty text, zero, false, or an empty list or object."""
    return text.isNull() | text.isin('""', "null", "false", "[]", "{}") | F.coalesce(~text.startswith('"') & (text.try_cast("double") == 0), F.lit(False))


def _opening(json: Column) -> Column:
    """The character that tells what kind of value a JSON text is."""
    return F.substring(F.ltrim(json, F.lit(" \t\r\n")), 1, 1)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row.

    A generator keeps the optimiser from copying the expressions, JSON parsing
    among them, into every filter and column above.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def classified(messages: DataFrame, keys: tuple[str, ...], year_column: str = "ano") -> DataFrame:
    """``messages`` plus ``_rule`` (null: valid), ``_env`` and ``_body`` variants."""
    text = F.col("value").cast("string")
    env = messages.withColumn("_text", F.when(F.is_valid_utf8(text), text))
    env = computed(env, _env=F.try_parse_json("_text"))
    get = lambda name, kind: F.try_variant_get("_env", f"$.{name}", kind)
    env = computed(env, _object=F.col("_env").isNotNull() & (_opening(F.col("_text")) == "{"), _id=F.to_json(get("event_id", "variant")), _payload=F.to_json(get("payload", "variant")), _inner=get("payload", "string"), _year=get(year_column, "string"))
    # A payload that is text holds JSON; one that is an object is JSON itself.
    kind, inner = F.substring("_payload", 1, 1), F.when(F.substring("_payload", 1, 1) == '"', F.col("_inner")).when(F.substring("_payload", 1, 1) == "{", F.col("_payload"))
    env = computed(env, _payload_kind=kind, _body=F.try_parse_json(inner), _body_opens=_opening(inner))
    env = computed(env, _falsy=_falsy(F.col("_id")), _body_object=F.coalesce(F.col("_body").isNotNull() & (F.col("_body_opens") == "{"), F.lit(False)), **{f"_key_{c}": F.try_variant_get("_body", f"$.{c}", "string") for c in keys})
    present = F.lit(True)
    for c in keys:
        value = F.coalesce(F.col(f"_key_{c}"), F.col("_year")).try_cast("double").try_cast("int") if c == year_column else F.col(f"_key_{c}")
        present = present & value.isNotNull()
    rule = (
        F.when(F.col("value").isNull(), EMPTY)
        .when(F.col("_text").isNull(), UNDECODABLE)
        .when(F.col("_env").isNull(), BAD_ENVELOPE)
        .when(~F.col("_object"), ENVELOPE_SHAPE)
        .when(F.col("_falsy") | F.col("_payload").isNull() | (F.col("_payload") == "null"), MISSING_FIELDS)
        .when((F.col("_payload_kind") == '"') & F.col("_body").isNull(), BAD_PAYLOAD)
        .when(~F.col("_body_object"), PAYLOAD_SHAPE)
        .when(~present, MISSING_KEYS)
    )
    return computed(env, _rule=rule).select(*messages.columns, "_text", "_env", "_object", "_body", "_rule")


def valid_rows(done: DataFrame, schema: T.StructType, ingested_at: str, year_column: str = "ano") -> DataFrame:
    """Payload columns of ``schema``, all other payload keys as JSON in
    ``_extra``, and lineage; the year falls back to the envelope's."""

    def value(f: T.StructField) -> Column:
        own = F.try_variant_get("_body", f"$.{f.name}", "string")
        if f.name == year_column:
            own = F.coalesce(own, F.try_variant_get("_env", f"$.{f.name}", "string"))
        if isinstance(f.dataType, T.IntegralType):  # as it stands, or else from a number with a point
            return F.coalesce(own.try_cast(f.dataType), own.try_cast("double").try_cast(f.dataType)).alias(f.name)
        return own.try_cast(f.dataType).alias(f.name)

    known = [f.name for f in schema]
    rest = F.map_filter(F.try_variant_get("_body", "$", "map<string,string>"), lambda k, _: ~k.isin(*known))
    found = computed(done.where(F.col("_rule").isNull()), _rest=rest)
    return found.select(
        *[value(f) for f in schema],
        F.when(F.size("_rest") > 0, F.to_json("_rest")).alias("_extra"),
        F.try_variant_get("_env", "$.event_id", "string").alias("_event_id"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.lit(ingested_at).alias("_ingestion_timestamp"),
    )


def rejects(done: DataFrame, ingested_at: str, year_column: str = "ano") -> DataFrame:
    """The dead letters, with the reason and what could be read of them."""
    reason = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    field = lambda name: F.when(F.col("_object"), F.try_variant_get("_env", f"$.{name}", "string"))
    return done.where(F.col("_rule").isNotNull()).select(
        F.col("_rule").alias("_dlq_rule_id"),
        F.element_at(reason, F.col("_rule")).alias("_dlq_reason"),
        F.coalesce(F.col("_text"), F.base64("value")).alias("_raw_payload"),
        field("event_id").alias("_event_id"),
        field("event_type").alias("_event_type"),
        field("event_timestamp").alias("_event_timestamp"),
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.lit(ingested_at).alias("_ingestion_timestamp"),
        F.coalesce(F.try_variant_get("_body", f"$.{year_column}", "string"), field(year_column)).try_cast("double").try_cast("int").alias(year_column),
    )


def parse(messages: DataFrame, schema: T.StructType, keys: tuple[str, ...], ingested_at: str, year_column: str = "ano") -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejects of the messages."""
    done = classified(messages, keys, year_column)
    return valid_rows(done, schema, ingested_at, year_column), rejects(done, ingested_at, year_column)
