"""JSON message codec: typed rows ↔ ``(key, value)`` messages, one JSON object per message.

Decoding is source-agnostic: it works on any DataFrame with a ``value`` column (string or binary),
from Kafka, text files or a batch table, and runs entirely in ``from_json`` (JVM side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollstate.spec import Table

CORRUPT = "_corrupt_record"
REASON = "reject_reason"

# Timestamps travel as ISO-8601 text with microseconds.  Spark's default JSON format
# keeps only milliseconds, so both formats are always given explicitly; parsing accepts the text with
# or without the fraction.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_WRITE_OPTIONS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_FORMAT}


class TooManyRejects(RuntimeError):
    """A batch had more malformed messages than the allowed ``max_bad``."""


def value_column(table: Table) -> Column:
    """One JSON object with every declared column, timestamps with microseconds."""
    return F.to_json(F.struct(*[F.col(f"`{c.name}`") for c in table.all_columns]), JSON_WRITE_OPTIONS)


def encode(df: DataFrame, table: Table) -> DataFrame:
    """``key`` = the id as text, ``value`` = one JSON object with every declared column."""
    return df.select(F.col(f"`{table.id}`").cast("string").alias("key"), value_column(table).alias("value"))


def _schema_with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def parse(value: Column, schema: T.StructType) -> Column:
    """``from_json`` in PERMISSIVE mode: a malformed or mistyped message keeps its raw text in
    ``_corrupt_record``; a missing field is NULL; unknown extra fields are ignored."""
    return F.from_json(
        value.cast("string"),
        _schema_with_corrupt(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def _objects(value: Column) -> Column:
    """The JSON values of one message as an array of texts; NULL when any part of it is not JSON.

    A message may hold one object, objects on lines of their own, or an array of objects.  A line
    break cannot stand inside a JSON string, so a brace, a break and a brace always end one object
    and start the next.  ``from_json`` alone would read the first object and drop the rest.

    The common message, whose only closing brace is its last character, can hold but one flat object:
    it is taken as it is, and parsed only once, with its types.
    """
    plain = F.trim(value.cast("string"))
    flat = plain.startswith("{") & (F.instr(plain, "}") == F.char_length(plain))
    text = F.trim(F.regexp_replace(value.cast("string"), r"\}[ \t\r]*\n\s*\{", "},{"))
    parsed = F.from_json(F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))), "array<string>")
    return F.when(flat, F.array(value.cast("string"))).otherwise(parsed)


#: What ``fill_missing`` puts in place of a missing measure, by Spark type; other types get 0.
DEFAULTS = {T.StringType: "", T.DateType: "1970-01-01", T.TimestampNTZType: "1970-01-01 00:00:00"}


def decode(df: DataFrame, table: Table, fill_missing: bool = False) -> DataFrame:
    """Decode ``value`` into the table's columns plus ``reject_reason`` (NULL for a good row) and the
    raw text of what was rejected: one row per object of a message, none is dropped.

    A message that is not JSON from its first to its last character is rejected as a whole; an object
    is rejected when it has a wrongly typed field or lacks the id or the time.  A ``key`` column is
    kept.  With ``fill_missing`` a missing measure becomes its type's default instead of NULL.
    """
    keys = [c for c in df.columns if c == "key"]
    raw = F.col("value").cast("string")
    each = df.select(*keys, raw.alias("_message"), _objects(F.col("value")).alias("_objects"))
    each = each.select(*keys, "_message", F.size("_objects").alias("_n"), F.explode_outer("_objects").alias("_object"))
    # A single object is parsed from its own text; a message without any object is malformed.
    alone = F.col("_object").isNull() | ((F.col("_n") == 1) & ~F.ltrim("_message").startswith("["))
    text = F.when(alone, F.col("_message")).otherwise(F.col("_object"))
    each = each.select(*keys, text.alias("_raw"), F.col("_object").isNotNull().alias("_found"))
    parsed = each.select(*keys, F.when(F.col("_found"), parse(F.col("_raw"), table.schema)).alias("_r"), "_raw")

    def measure(name: str, kind: T.DataType) -> Column:
        col = F.col(f"_r.`{name}`")
        return (F.coalesce(col, F.lit(DEFAULTS.get(type(kind), 0)).cast(kind)) if fill_missing else col).alias(name)

    ident, time = F.col(f"_r.`{table.id}`"), F.col(f"_r.`{table.ts}`")
    reason = (
        F.when(F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull(), F.lit("malformed"))
        .when(ident.isNull(), F.lit("missing id"))
        .when(time.isNull(), F.lit("missing time"))
    )
    return parsed.select(
        *keys,
        ident.alias(table.id),
        time.alias(table.ts),
        *[measure(c.name, c.dtype) for c in table.columns],
        reason.alias(REASON),
        F.when(reason.isNotNull(), F.col("_raw")).alias(CORRUPT),
    )


def good(decoded: DataFrame, table: Table) -> DataFrame:
    return decoded.where(F.col(REASON).isNull()).select(*[F.col(f"`{c.name}`") for c in table.all_columns])


def rejects(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(REASON).isNotNull()).select(REASON, CORRUPT)


def check_rejects(decoded: DataFrame, max_bad: int | None) -> int:
    """Count rejects of one (micro-)batch; raise when above ``max_bad`` (None = unlimited).

    ``max_bad=0`` is the strict variant.  The count is one distributed aggregation.
    """
    if max_bad is None:
        return -1
    n_bad = decoded.where(F.col(REASON).isNotNull()).count()
    if n_bad > max_bad:
        raise TooManyRejects(f"{n_bad} malformed messages in batch, at most {max_bad} allowed")
    return n_bad
