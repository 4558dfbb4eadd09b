"""Messages that are broken or have drifted from the schema (OP-J1).

A text is parsed once, to a VARIANT. From it come the typed columns the flatteners read, the reason
why a message is unusable or in part, and the fields that the fixed schema does not know.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.cleaning import as_columns

#: Reasons, worst first. A message with ``BAD_FIELDS`` alone is usable: its bad fields are NULL.
EMPTY, NOT_JSON, NOT_OBJECT, MISSING, BAD_FIELDS = "empty", "not_json", "not_an_object", "missing", "bad_fields"
REQUIRED = ("header", "entity")


def _none() -> Column:
    return F.array().cast("array<string>")


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _there(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v)


def _bad(v: Column, at: str, typed: Column, kind: T.DataType, path: str) -> Column:
    """Paths of values the type cannot hold, at and below ``at`` in the VARIANT ``v``. ``typed`` is the same place after the
    cast: only where it is NULL the VARIANT is asked whether something is there."""
    if isinstance(kind, T.StructType):
        parts = [f for f in kind.fields if not isinstance(f.dataType, T.StringType)]  # any value has a text
        below = [_bad(v, f"{at}.{f.name}", typed[f.name], f.dataType, f"{path}.{f.name}".lstrip(".")) for f in parts]
        found = F.concat(*below) if below else _none()
    elif isinstance(kind, T.ArrayType):
        each = lambda x, i: _bad(x, "$", F.get(typed, i), kind.elementType, f"{path}[]")
        found = F.flatten(F.transform(_get(v, at, "array<variant>"), each))
    else:
        found = _none()
    return F.when(typed.isNotNull(), found).when(_there(_get(v, at)), F.array(F.lit(path))).otherwise(_none())


def _once(df: DataFrame, *columns: Column) -> DataFrame:
    """Columns that are worked out once: a filter on a plain column would be pushed below and work them out
    again, but not one on what a generator gives."""
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def judge_messages(
    messages: DataFrame, schema: str, text: str = "json_str", required: Sequence[str] = REQUIRED
) -> DataFrame:
    """Messages with ``message`` (VARIANT), ``reason`` (NULL if nothing is wrong), ``fields`` (what is missing
    or has a value its type cannot hold) and ``usable``."""
    kind = T.StructType.fromDDL(schema)
    v, typed = F.col("message"), F.col("__typed")
    there = [typed[c].isNotNull() if c in kind.names else F.lit(False) for c in required]
    missing = F.filter(
        F.array(*[F.when(~(seen | F.coalesce(_there(_get(v, f"$.{c}")), F.lit(False))), c) for c, seen in zip(required, there, strict=True)]),
        lambda c: c.isNotNull(),
    )
    blank = F.col(text).isNull() | (F.trim(text) == "")
    rows = _once(messages, F.try_parse_json(text).alias("message"))
    # NULL for anything but an object.
    rows = _once(rows, _get(v, "$", kind.simpleString()).alias("__typed"))
    bad = F.array_distinct(_bad(v, "$", typed, kind, ""))
    rows = _once(
        rows,
        F.when(typed.isNotNull(), missing).otherwise(_none()).alias("__missing"),
        F.when(typed.isNotNull(), bad).otherwise(_none()).alias("__bad"),
    )
    reason = (
        F.when(blank, EMPTY)
        .when(v.isNull(), NOT_JSON)
        .when(typed.isNull(), NOT_OBJECT)
        .when(F.size("__missing") > 0, MISSING)
        .when(F.size("__bad") > 0, BAD_FIELDS)
    )
    rows = rows.withColumns({"reason": reason, "fields": F.when(F.size("__missing") > 0, F.col("__missing")).otherwise(F.col("__bad"))})
    return rows.withColumn("usable", F.coalesce(F.col("reason") == BAD_FIELDS, F.lit(True))).drop("__missing", "__bad", "__typed")


def typed_messages(judged: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """OP-J1: the typed columns of usable messages, for the flatteners. Nothing is parsed again."""
    kind = T.StructType.fromDDL(schema).simpleString()
    return _once(judged.filter("usable"), _get(F.col("message"), "$", kind).alias("m")).select("m.*", *as_columns(keep))


def quarantined(judged: DataFrame, text: str = "json_str") -> DataFrame:
    """Messages with anything wrong, as they came, with the reason. The rows of a quarantine table."""
    return judged.filter("reason IS NOT NULL").drop("message")


def _paths(kind: T.DataType, path: str = "") -> Iterator[tuple[str, T.DataType]]:
    if isinstance(kind, T.StructType):
        if path:
            yield path, kind
        for f in kind.fields:
            yield from _paths(f.dataType, f"{path}.{f.name}".lstrip("."))
    elif isinstance(kind, T.ArrayType):
        yield path, kind
        yield from _paths(kind.elementType, f"{path}[]")
    else:
        yield path, kind


def message_drift(judged: DataFrame, schema: str, by: str = "topic") -> DataFrame:
    """``by``, path, kind, seen, messages: how messages differ from the schema.

    Kind ``unknown`` is a field the schema does not have, with the type seen in messages that are right otherwise
    (VARIANT where they differ); kinds ``missing`` and ``bad_fields`` are fields that are not there or hold
    a value of another type, with the number of such messages. Messages are judged once: schemas and numbers come from
    the same partial sums in Spark. The driver gets a schema per topic and a row per topic and field of the schema.
    """
    known = dict(_paths(T.StructType.fromDDL(schema)))
    right = F.col("reason").isNull()
    paths = F.when(right, F.array(F.lit(None).cast("string"))).otherwise(F.col("fields"))
    found = (
        judged.filter(right | F.col("reason").isin(MISSING, BAD_FIELDS))
        .select(F.col(by).cast("string").alias(by), F.col("reason").alias("kind"), F.when(right, F.col("message")).alias("m"), F.explode(paths).alias("path"))
        .groupBy(by, "path", "kind")
        .agg(F.schema_of_variant_agg("m").alias("schema"), F.count(F.lit(1)).alias("messages"))
        .collect()
    )
    out = []
    for topic, path, kind, text, messages in found:
        if kind is not None:
            out.append((topic, path, kind, None, messages))
            continue
        under: tuple[str, ...] = ()  # below an unknown field all is unknown
        for path, kind in _paths(T.StructType.fromDDL("m " + text.replace("OBJECT<", "STRUCT<"))["m"].dataType):
            if path not in known and not path.startswith(under or "\0"):
                out.append((topic, path, "unknown", kind.simpleString(), None))
                under += (f"{path}.", f"{path}[")
    return judged.sparkSession.createDataFrame(out, f"{by} string, path string, kind string, seen string, messages bigint")
