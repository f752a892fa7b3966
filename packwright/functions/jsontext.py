"""Recover JSON from chatty text, strictly, and keep what fails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where JSON lies in a reply.
LIST_PATTERN = r"(?s)\[.*\]"
OBJECT_PATTERN = r"(?s)\{.*\}"
FENCED_OBJECT_PATTERN = r"(?s)```(json)?\s*(\{.*?\})\s*```"

OK, QUARANTINED = "ok", "quarantined"

_CORRUPT = "__corrupt"
_STRICT = {
    "allowSingleQuotes": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
}


def _parses(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def is_strict_json(text: Column) -> Column:
    """True when the whole text is one JSON value.

    Spark's JSON readers ignore what follows a complete value. Wrapping the text in an array
    and in an object turns such a tail into an error, so both wraps have to parse. ``NaN``
    and repeated keys are rejected.
    """
    in_array = F.concat(F.lit("["), text, F.lit("]"))
    in_object = F.concat(F.lit('{"v":'), text, F.lit("}"))
    whole = _parses(in_array) & (F.json_array_length(in_array) == 1) & _parses(in_object)
    return F.coalesce(whole, F.lit(False))


def json_list_text(text: Column) -> Column:
    """Widest ``[...]`` in the text, null when there is none."""
    return F.nullif(F.regexp_extract(text, LIST_PATTERN, 0), F.lit(""))


def json_object_text(text: Column) -> Column:
    """Widest ``{...}`` in the text, null when there is none."""
    return F.nullif(F.regexp_extract(text, OBJECT_PATTERN, 0), F.lit(""))


def fenced_object_text(text: Column) -> Column:
    """Object inside the first JSON fence, else the widest object, else the text itself."""
    fenced = F.nullif(F.regexp_extract(text, FENCED_OBJECT_PATTERN, 2), F.lit(""))
    return F.coalesce(fenced, json_object_text(text), text)


def _recover(df: DataFrame, json_text: Column, schema: str) -> DataFrame:
    """Parse and judge; a value that does not fit its type in the schema is no valid value."""
    # A column of its own, or every use of it would parse the text again.
    judged = df.withColumn("json_text", json_text).withColumn("__valid", is_strict_json(F.col("json_text")))
    is_valid = F.col("__valid")
    # The reader reports a field of a wrong type only through a column for corrupt records,
    # which needs a struct around the value.
    wrapped = F.concat(F.lit('{"value":'), F.col("json_text"), F.lit("}"))
    columns = f"value {schema}, {_CORRUPT} string"
    parsed = F.when(is_valid, F.from_json(wrapped, columns, _STRICT))
    judged = judged.withColumn("__parsed", parsed)
    fits = F.col(f"__parsed.{_CORRUPT}").isNull()
    status = F.when(is_valid & fits, OK).otherwise(QUARANTINED)
    reason = (
        F.when(F.col("json_text").isNull(), "no json found")
        .when(~is_valid, "invalid json")
        .when(~fits, "wrong type")
    )
    return (
        judged.withColumns({"status": status, "reason": reason})
        .withColumn("value", F.when(F.col("status") == OK, F.col("__parsed.value")))
        .drop("__parsed", "__valid")
    )


def recover_list(df: DataFrame, text: str, element: T.DataType | str) -> DataFrame:
    """Add ``json_text, status, reason, value``; ``value`` is the parsed array of ``element``.

    Rows that fail stay in the output with ``status = 'quarantined'`` and keep their text, so
    one pass can be written out and filtered into good rows and quarantine afterwards.
    """
    inner = element if isinstance(element, str) else element.simpleString()
    return _recover(df, json_list_text(F.col(text)), f"array<{inner}>")


def recover_object(
    df: DataFrame, text: str, schema: T.DataType | str, fenced: bool = False
) -> DataFrame:
    """Like :func:`recover_list` for one object; ``fenced=True`` prefers a JSON fence.

    An object has to start with a brace: other JSON values are quarantined.
    """
    extract = fenced_object_text if fenced else json_object_text
    inner = schema if isinstance(schema, str) else schema.simpleString()
    out = _recover(df, extract(F.col(text)), inner if inner.startswith("struct<") else f"struct<{inner}>")
    is_object = F.startswith(F.ltrim(F.col("json_text")), F.lit("{"))
    bad = F.col("reason").isNull() | (F.col("reason") == "wrong type")
    bad = bad & ~is_object
    return (
        out.withColumn("reason", F.when(bad, "not an object").otherwise(F.col("reason")))
        .withColumn("value", F.when(~bad, F.col("value")))
        .withColumn("status", F.when(bad, QUARANTINED).otherwise(F.col("status")))
    )


def good_rows(recovered: DataFrame) -> DataFrame:
    """Rows whose JSON was valid."""
    return recovered.filter(F.col("status") == OK)


def quarantine(recovered: DataFrame) -> DataFrame:
    """Rows kept aside, with the reason."""
    return recovered.filter(F.col("status") == QUARANTINED)


def explode_items(recovered: DataFrame, keep: Sequence[str], position: str = "position") -> DataFrame:
    """One row per list element of the good rows, with its 0-based position."""
    return good_rows(recovered).select(
        *keep, F.posexplode("value").alias(position, "item")
    ).select(*keep, position, "item.*")


def key_differences(
    text: Column, required: Sequence[str], optional: Sequence[str] = ()
) -> tuple[Column, Column]:
    """(missing, unknown) keys of a JSON object, each a sorted array.

    Keys are compared rather than values, because a parsed null does not tell an absent key
    from an explicit null.
    """
    keys = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    needed = F.array(*[F.lit(k) for k in required])
    allowed = F.array(*[F.lit(k) for k in [*required, *optional]])
    return (
        F.array_sort(F.array_except(needed, keys)),
        F.array_sort(F.array_except(keys, allowed)),
    )
