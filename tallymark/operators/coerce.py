"""Raw messages to typed rows, and the quarantine for what does not fit.

A message relation has `value` (binary, one JSON document) and `topic`. A document is parsed
into a variant, which keeps JSON types, so a number sent for a text field is seen as a mismatch
instead of being turned into text. The types of all its fields are one text, its shape: where that
is the shape the schema asks for, the whole record is read from the variant at once. Only other
documents are looked at field by field, to find the fault or what may still be made of them.

One bad message never stops the run. A message that is not JSON, holds a value of the
wrong type or lacks a required field goes to quarantine with the kind of fault only:
parser texts can repeat sensitive input, so they are never kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tallymark.schemas import QUARANTINE_MAX_BYTES

STAMP = "ingested_at"  # set by the ingester, never read from a message
ISO_TIME = (
    r"\A\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?\z"
)


def _first(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.coalesce(*columns)


def _value(raw: Column, kind: Column, dtype: DataType) -> Column:
    """The typed value, null when absent or not representable."""
    if isinstance(dtype, StringType):
        return F.when(kind == "STRING", F.try_variant_get(raw, "$", "string"))
    if isinstance(dtype, (LongType, IntegerType)):
        whole = (kind == "BIGINT") | (kind.startswith("DECIMAL") & kind.endswith(",0)"))
        return F.when(whole, F.try_variant_get(raw, "$", dtype.simpleString()))
    if isinstance(dtype, DoubleType):
        number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
        return F.when(number, F.try_variant_get(raw, "$", "double"))
    return _time(F.when(kind == "STRING", F.try_variant_get(raw, "$", "string")), dtype)


def _time(text: Column, dtype: DataType) -> Column:
    text = F.when(text.rlike(ISO_TIME), text)
    if isinstance(dtype, TimestampType):
        return F.regexp_replace(text, ",", ".").try_cast("timestamp")
    if isinstance(dtype, DateType):
        return F.substring(text, 1, 10).try_cast("date")
    raise TypeError(f"no rule for {dtype}")


def _fault(kind: Column, value: Column, dtype: DataType) -> Column:
    """Name of the fault when a value is present but unusable."""
    unusable = kind.isNotNull() & (kind != "VOID") & value.isNull()
    if isinstance(dtype, (TimestampType, DateType)):
        return F.when(unusable, F.when(kind == "STRING", "ValueError").otherwise("TypeError"))
    return F.when(unusable, "SchemaMismatch")


#: Types in a shape that each kind of field takes as it is.
_SHAPES = (
    (StringType, "STRING"),
    ((LongType, IntegerType), "BIGINT"),
    (DoubleType, r"(?:BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"),
    ((TimestampType, DateType), "STRING"),
)


def fitting_shape(fields: list[StructField]) -> str:
    """A pattern of the shapes of one-element arrays whose element holds the declared fields in
    their types. A shape lists fields by name; undeclared ones may stand between them, unless they
    are objects or arrays. Optional fields may lack or be null."""
    end = r"(?:, |(?=>>))"
    declared = "|".join(f.name for f in fields)
    other = rf"(?:(?!(?:{declared}): )(?:`(?:[^`]|``)*`|\w+): [A-Z]+(?:\(\d+,\d+\))?{end})*+"
    parts = [other]
    for f in sorted(fields, key=lambda f: f.name):
        (shape,) = (shape for kinds, shape in _SHAPES if isinstance(f.dataType, kinds))
        if f.nullable:
            parts.append(rf"(?:{f.name}: (?:{shape}|VOID){end})?{other}")
        else:
            parts.append(rf"{f.name}: {shape}{end}{other}")
    return rf"\AARRAY<OBJECT<{''.join(parts)}>>\z"


def _read_as(dtype: DataType) -> str:
    """What a field is read as before times and short numbers are checked."""
    if isinstance(dtype, (TimestampType, DateType)):
        return "string"
    return "bigint" if isinstance(dtype, IntegerType) else dtype.simpleString()


def _finished(read: Column, dtype: DataType) -> Column:
    if isinstance(dtype, (TimestampType, DateType)):
        return _time(read, dtype)
    return read.try_cast("int") if isinstance(dtype, IntegerType) else read


def coerce(messages: DataFrame, schema: StructType) -> DataFrame:
    """Add `record` (struct of the declared fields) and `error_type` (null when good).

    Undeclared fields are dropped and absent ones are null. All columns of `messages`
    stay, with `value` made non-null.
    """
    fields = [f for f in schema if f.name != STAMP]
    variants = StructType()
    for f in fields:
        variants = variants.add(f.name, "variant")

    payload = F.coalesce(F.col("value"), F.lit(b""))
    # Wrapped in an array, text after the document makes the whole thing invalid.
    wrapped = F.concat(F.lit("["), "_text", F.lit("]"))
    whole = ", ".join(f"{f.name}: {_read_as(f.dataType)}" for f in fields)
    single = F.try_variant_get("_whole", "$[1]", "variant").isNull()
    read = F.try_variant_get("_whole", "$[0]", f"struct<{whole}>")
    known = (
        messages.withColumn("_null", F.col("value").isNull())
        .withColumn("value", payload)
        .withColumn("_utf8", F.is_valid_utf8(F.col("value").cast("string")))
        .withColumn("_text", F.when(F.col("_utf8"), F.col("value").cast("string")))
        .withColumn("_whole", F.try_parse_json(wrapped))
        .withColumn("_shaped", F.schema_of_variant("_whole").rlike(fitting_shape(fields)) & single)
        .withColumn("_read", F.when(F.col("_shaped"), read))
        .withColumns({f"_done_{f.name}": _finished(F.col("_read")[f.name], f.dataType) for f in fields})
    )
    whole_read = reduce(
        lambda a, b: a & b,
        [
            F.col(f"_done_{f.name}").isNotNull() | F.col("_read")[f.name].isNull()
            for f in fields
            if _read_as(f.dataType) != f.dataType.simpleString()
        ],
        F.col("_read").isNotNull(),
    )
    # what follows is null, and costs nothing, for a record that has been read
    parsed = (
        known.withColumn("_good", F.coalesce(whole_read, F.lit(False)))
        .withColumn("_left", F.when(~F.col("_good"), wrapped))
        .withColumn("_docs", F.from_json("_left", f"array<{variants.simpleString()}>"))
        .withColumn("_doc", F.when(F.size("_docs") == 1, F.get("_docs", F.lit(0))))
    )
    kind = {f.name: F.col(f"_kind_{f.name}") for f in fields}
    value = {f.name: F.col(f"_value_{f.name}") for f in fields}
    typed = parsed.withColumns(
        {f"_kind_{f.name}": F.schema_of_variant(F.col("_doc")[f.name]) for f in fields}
    ).withColumns(
        {
            f"_value_{f.name}": _value(F.col("_doc")[f.name], kind[f.name], f.dataType)
            for f in fields
        }
    )

    looks_like_object = F.regexp_replace(F.col("_text"), r"\A\s+", "").startswith("{")
    faults = [_fault(kind[f.name], value[f.name], f.dataType) for f in fields]
    times = [
        fault
        for f, fault in zip(fields, faults, strict=True)
        if isinstance(f.dataType, (TimestampType, DateType))
    ]
    required = [value[f.name].isNull() for f in fields if not f.nullable]
    missing = reduce(lambda a, b: a | b, required)
    error = (
        F.when(F.col("_good"), None)
        .when(F.col("_null"), "TypeError")
        .when(~F.col("_utf8"), "UnicodeDecodeError")
        .when(
            F.col("_doc").isNull(),
            F.when(
                ~looks_like_object & F.try_parse_json(F.col("_text")).isNotNull(), "AttributeError"
            ).otherwise("JSONDecodeError"),
        )
        .otherwise(_first([*times, *faults, F.when(missing, "MissingRequired")]))
    )
    chosen = [F.when(F.col("_good"), F.col(f"_done_{f.name}")).otherwise(value[f.name]) for f in fields]
    record = F.struct(*[column.alias(f.name) for column, f in zip(chosen, fields, strict=True)])
    # The one-element explode is a fence. Without it the optimizer pushes a later filter on
    # error_type below the parse and evaluates the whole parse once more per reference.
    outcome = F.explode(F.array(F.struct(record.alias("record"), error.alias("error_type"))))
    return typed.select(*messages.columns, outcome.alias("_outcome")).select(
        *messages.columns, "_outcome.record", "_outcome.error_type"
    )


def accepted(coerced: DataFrame, schema: StructType, ingested_at: Column) -> DataFrame:
    """Good rows in the declared column order, stamped with one ingestion time."""
    return (
        coerced.where(F.col("error_type").isNull())
        .select("record.*", ingested_at.cast("timestamp").alias(STAMP))
        .select(*schema.names)
    )


def quarantined(coerced: DataFrame, ingested_at: Column) -> DataFrame:
    """One bounded record per bad message. The bound counts bytes, not characters."""
    head = F.substring(F.col("value"), 1, QUARANTINE_MAX_BYTES).cast("string")
    return coerced.where(F.col("error_type").isNotNull()).select(
        F.col("topic").alias("source_topic"),
        ingested_at.cast("timestamp").alias(STAMP),
        "error_type",
        F.make_valid_utf8(head).alias("raw_payload"),
        (F.octet_length("value") > QUARANTINE_MAX_BYTES).alias("payload_truncated"),
    )


def drain_counts(coerced: DataFrame) -> DataFrame:
    """consumed, written and malformed in one pass."""
    return coerced.agg(
        F.count("*").alias("consumed"),
        F.count_if(F.col("error_type").isNull()).alias("written"),
        F.count_if(F.col("error_type").isNotNull()).alias("malformed"),
    )


def require_rows(written: dict[str, int]) -> None:
    """An ingest run that wrote nothing over all its datasets must fail."""
    if sum(written.values()) == 0:
        raise RuntimeError(
            "ingest wrote 0 rows: nothing was published, or this checkpoint has already "
            "read everything; use a new checkpoint to read from the start"
        )
