"""JSON values as VARIANT columns: strict parsing, type tests, truthiness, text form.

Records have no fixed schema and field names that differ only by case, so they are held as
VARIANT; a struct type inferred from the data could not hold them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantVal

from .json_variant import variant_bytes
from .text import is_blank

# Text of booleans and of zero: the same text can be a string.
_OTHER_TEXT = r"^(true|false|-?0(\.0*)?([eE][+-]?[0-9]+)?)$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    Inside conditions the optimizer does not share common parts of expressions; a bound variable
    does.
    """
    return F.transform(F.array(value), body).getItem(0)


def _marked_parse(text: Column, mark: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")))


def _only_value(parsed: Column, mark: Column) -> Column:
    exact = (F.try_variant_get(parsed, "$[1]", "bigint") == mark) & F.variant_get(
        parsed, "$[2]", "variant"
    ).isNull()
    return F.when(exact, F.variant_get(parsed, "$[0]", "variant"))


def strict_json(text: Column) -> Column:
    """Parse a text that must be exactly one JSON value; NULL if it is not.

    The parser stops after the first value and ignores what follows.  Parsing ``[text, h]`` with
    ``h`` a hash of the text makes trailing garbage visible: the array then ends early, or has a
    wrong length, or does not parse.  One parse is enough.
    """
    mark = F.xxhash64(text)
    return let(_marked_parse(text, mark), lambda parsed: _only_value(parsed, mark))


@cache
def _second_parse() -> Callable[[Column], Column]:
    """A second opinion on texts that the JVM's parser refuses."""

    def parse(texts: pd.Series) -> pd.Series:
        found = [None if t is None else variant_bytes(t) for t in texts]
        return pd.Series([None if f is None else VariantVal(*f) for f in found], dtype=object)

    return F.pandas_udf(parse, "variant")


def with_strict_json(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add the value of a text that must be exactly one JSON value as a column; NULL if it is not.

    Two tiers: the JVM parses every text, and only texts that it refuses go to Python, where neither
    long strings and numbers nor deep nesting are refused (``json_variant``); for all other rows a
    null is sent.  A value over 128 MiB, which no VARIANT can hold, is NULL too.

    Rows whose text is blank are left out.  The row filter is part of the generator at the end: a
    filter of its own would be moved down and have the text computed twice, and later filters on
    the value would be turned into a second parse.
    """
    steps = df.withColumn("_text", text).withColumn("_mark", F.xxhash64("_text"))
    steps = steps.withColumn("_parsed", _marked_parse(F.col("_text"), F.col("_mark")))
    steps = steps.select(*df.columns, "_text", _only_value(F.col("_parsed"), F.col("_mark")).alias("_value"))
    blank = is_blank(F.col("_text"))
    refused = F.when(F.col("_value").isNull() & ~blank, F.col("_text"))
    steps = steps.withColumn("_late", _second_parse()(refused))
    value = F.array(F.coalesce(F.col("_value"), F.col("_late")))
    nothing = F.array().cast("array<variant>")
    kept = F.when(F.col("_value").isNull() & blank, nothing).otherwise(value)
    return steps.select(*df.columns, F.explode(kept).alias(name))


def field(record: Column, key: str) -> Column:
    """The value under ``key`` as VARIANT; SQL NULL when the key is missing."""
    return F.variant_get(record, field_path(key), "variant")


def field_path(key: str) -> str:
    """The variant path of a top-level key."""
    quote = '"' if "'" in key else "'"
    if quote in key:
        raise ValueError(f"key with both kinds of quotes: {key!r}")
    return f"$[{quote}{key}{quote}]"


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "struct<a:variant>").isNotNull()


def as_array(v: Column) -> Column:
    """``array<variant>``, or NULL for anything but a JSON array."""
    return F.try_variant_get(v, "$", "array<variant>")


def is_json_string(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def as_text(v: Column) -> Column:
    """Text as the variant itself prints; NULL for a missing value and for JSON null."""
    return F.try_variant_get(v, "$", "string")


def _nested(v: Column) -> Column:
    return as_array(v).isNotNull() | is_object(v)


def may_differ(text: Column) -> Column:
    """Whether the text could be that of something other than a truthy string.

    Looks at the first character and the length first, so long texts cost nothing.
    """
    return F.substring(text, 1, 1).isin("[", "{") | (
        (F.octet_length(text) <= 40) & F.rlike(text, F.lit(_OTHER_TEXT))
    )


def pick_text(
    record: Column, path: str, truthy_only: bool, nested_source: Column | None = None
) -> Column:
    """A field as text: strings as they are, ``True``/``False``, numbers, nested values as JSON.

    NULL for missing and null and, with ``truthy_only``, for every falsy value.
    ``nested_source`` replaces the JSON of nested values.  One extraction decides nearly every
    row; the value's type is only looked at when its text is ambiguous.
    """
    v = F.try_variant_get(record, path, "variant")

    def of_text(text: Column) -> Column:
        plain = F.when(text != "", text) if truthy_only else text
        in_brackets = F.substring(text, 1, 1).isin("[", "{")
        nested = text if nested_source is None else nested_source
        if truthy_only:
            nested = F.when(~text.isin("[]", "{}"), nested)
        scalar = F.when(text == "true", F.lit("True"))
        scalar = scalar if truthy_only else scalar.when(text == "false", F.lit("False")).otherwise(text)
        return (
            F.when(~may_differ(text), plain)
            .when(in_brackets, F.when(_nested(v), nested).otherwise(text))
            .otherwise(F.when(is_json_string(v), text).otherwise(scalar))
        )

    return let(F.try_variant_get(record, path, "string"), of_text)


def truthy(v: Column) -> Column:
    """False for missing, null, ``""``, 0, false, ``[]`` and ``{}``; true for all else."""
    return pick_text(v, "$", truthy_only=True).isNotNull()


def text_of(v: Column) -> Column:
    """Text of a value: strings as they are, booleans ``True``/``False``, nested values as JSON.

    NULL for a missing key and for JSON null.
    """
    return pick_text(v, "$", truthy_only=False)
