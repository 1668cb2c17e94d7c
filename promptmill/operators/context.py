"""Template contexts: which text, and which truth value, a record gives each variable."""

from __future__ import annotations

import json
import operator
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from dataclasses import field as dataclass_field
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import py_strip
from ..functions.variants import field, field_path, is_json_string, may_differ, pick_text

# Field names that stand for each variable, first non-empty one wins.
QUESTION_KEYS = ("question", "NATURAL_LANGUAGE_QUESTION", "natural_language_question")
SQL_KEYS = ("sql", "POSTGRESQL_QUERY", "answer", "query")
ANSWER_KEYS = ("answer", "sql", "POSTGRESQL_QUERY", "query")
SCHEMA_KEYS = ("schema", "SCHEMA_JSON", "schema_json")
EXPECTED_KEYS = ("answer", "sql")
TRAINING_KEYS = QUESTION_KEYS + SQL_KEYS + ANSWER_KEYS + SCHEMA_KEYS


@dataclass(frozen=True)
class Value:
    """A context value: its text (NULL stands for null) and whether a condition holds for it.

    The condition is only built when a template asks for it.
    """

    text: Column
    holds: Callable[[], Column]

    @property
    def truthy(self) -> Column:
        return self.holds()

    @classmethod
    def of_text(cls, text: Column) -> Value:
        return cls(text, lambda: F.coalesce(text != "", F.lit(False)))


Context = Mapping[str, Value]


@F.pandas_udf(StringType())
def _python_text(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """``str()`` of the Python value a JSON text stands for."""
    for texts in values:
        yield texts.map(lambda t: None if t is None else str(json.loads(t)), na_action="ignore")


@dataclass(frozen=True)
class Fields:
    """Records with the texts of some of their fields, all taken out of the JSON in one pass."""

    frame: DataFrame
    keys: tuple[str, ...]
    raw: Column | None
    _picked: dict[tuple[str, bool], Column] = dataclass_field(default_factory=dict)

    def text(self, key: str) -> Column:
        return F.col("_fields").getField(f"k{self.keys.index(key)}")

    def source(self, key: str) -> Column | None:
        """The field in the record's own JSON text, with its key order and digits."""
        return None if self.raw is None else F.get_json_object(self.raw, field_path(key))

    def value(self, key: str) -> Column:
        return field(F.col("rec"), key)

    def pick(self, key: str, truthy_only: bool) -> Column:
        """The field as printed; with ``truthy_only`` NULL for every falsy value.

        The plain text decides nearly every row; only an ambiguous one is looked at again.
        """
        if (key, truthy_only) not in self._picked:
            text = self.text(key)
            again = pick_text(F.col("rec"), field_path(key), truthy_only, self.source(key))
            empty = F.when(text == "", None if truthy_only else text)
            self._picked[key, truthy_only] = empty.when(~may_differ(text), text).when(
                text.isNotNull(), again
            )
        return self._picked[key, truthy_only]

    def json_source(self, key: str) -> Column:
        """The JSON source of a number, list or object; NULL for all else."""
        looks_so = F.substring(self.text(key), 1, 1).isin(*"-0123456789[{I")
        return F.when(looks_so & ~is_json_string(self.value(key)), self.source(key))


def read_fields(records: DataFrame, keys: Sequence[str] = TRAINING_KEYS) -> Fields:
    """Take fields out of ``rec``.  A ``raw`` column, if there, is the record's JSON text."""
    keys = tuple(dict.fromkeys(keys))
    wanted = ", ".join(f"`{k}`: string" for k in keys)
    # Renamed by position: field names may differ only by case.
    renamed = ", ".join(f"k{i}: string" for i in range(len(keys)))
    fields = F.try_variant_get("rec", "$", f"struct<{wanted}>").cast(f"struct<{renamed}>")
    raw = F.col("raw") if "raw" in records.columns else None
    return Fields(records.withColumn("_fields", fields), keys, raw)


def _as_python(text: Column, json_source: Column) -> Column:
    """Print numbers, lists and objects the way Python does: a Python step for those only."""
    return F.coalesce(_python_text(json_source), text)


def value_text(fields: Fields, key: str, python_text: bool = False) -> Column:
    """Text of one field, null when it is missing or null.

    Values other than strings print as JSON, and with ``python_text`` the way Python prints them.
    """
    text = fields.pick(key, truthy_only=False)
    if not python_text or fields.raw is None:
        return text
    return _as_python(text, fields.json_source(key))


def first_truthy(
    fields: Fields, keys: Sequence[str], default: str | None = None, python_text: bool = False
) -> Value:
    """The first field that is not empty in the sense of ``truthy``.

    With no ``default`` the last field is the answer whatever it holds, so it may be null, 0 or
    an empty list; a missing one gives null.
    """
    guarded = [fields.pick(k, truthy_only=True) for k in keys]
    if default is not None:
        text = F.coalesce(*guarded, F.lit(default))
        # No truthy value prints as nothing.
        holds = partial(operator.ne, text, "")
    else:
        text = F.coalesce(*guarded[:-1], fields.pick(keys[-1], truthy_only=False))
        holds = F.coalesce(*guarded).isNotNull
    if python_text and fields.raw is not None:
        # The JSON source of the field that was chosen, not of a later one: a chosen string has none.
        source = F.lit(None).cast("string") if default is not None else fields.json_source(keys[-1])
        for k, found in reversed(list(zip(keys, guarded))[: None if default is not None else -1]):
            source = F.when(found.isNotNull(), fields.json_source(k)).otherwise(source)
        text = _as_python(text, source)
    return Value(text, holds)


def training_context(fields: Fields, python_text: bool = False) -> dict[str, Value]:
    """The four variables of a training template, from any of their field names."""
    return {
        "question": first_truthy(fields, QUESTION_KEYS, None, python_text),
        "sql": first_truthy(fields, SQL_KEYS, None, python_text),
        "answer": first_truthy(fields, ANSWER_KEYS, None, python_text),
        "schema": first_truthy(fields, SCHEMA_KEYS, "", python_text),
    }


def evaluation_context(
    fields: Fields, variables: Sequence[str], python_text: bool = False
) -> dict[str, Value]:
    """The named fields and no aliases: a missing one is empty text, a null one stays null."""
    context = {}
    for name in variables:
        # Only a value without text can be missing rather than null.
        missing = F.when(fields.value(name).isNull(), F.lit(""))
        context[name] = Value(
            F.coalesce(value_text(fields, name, python_text), missing),
            fields.pick(name, truthy_only=True).isNotNull,
        )
    return context


def column_context(df: DataFrame, variables: Sequence[str], strip: bool = False) -> dict[str, Value]:
    """Variables from typed columns of the same names; a column that is not there is empty text."""
    context = {}
    for name in variables:
        text = F.col(name).cast("string") if name in df.columns else F.lit("")
        context[name] = Value.of_text(py_strip(text) if strip else text)
    return context


def context_struct(context: Context) -> Column:
    """The context as one struct column of texts."""
    return F.struct(*[v.text.alias(name) for name, v in context.items()])


def expected_answer(fields: Fields) -> Column:
    """What the prediction is compared with: ``answer``, else ``sql``, else empty; stripped."""
    return py_strip(first_truthy(fields, EXPECTED_KEYS, "").text)


def record_text(rec: Column) -> Column:
    """Text of a record that has no messages: its ``text`` field, or all of it as JSON."""
    return F.coalesce(pick_text(rec, field_path("text"), truthy_only=True), F.to_json(rec))
