"""Prompt templates as column expressions.

A template is a JSON document whose strings hold ``{{ variable }}`` and
``{% if variable %} ... {% endif %}``.  It is compiled once, on the driver, to plain ``concat`` and
``when`` expressions, so rendering stays inside generated code.  Other markup is refused.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import MESSAGES_TYPE, ChatFormat, prompt_from_turns
from ..functions.variants import as_array, field, is_object, let, strict_json
from ..sources.chat import normalize_messages
from .context import Context

_MARKUP = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_VARIABLE = re.compile(r"\{\{\s*([A-Za-z_]\w*)\s*\}\}")
_IF = re.compile(r"\{%\s*if\s+([A-Za-z_]\w*)\s*%\}")
_ENDIF = re.compile(r"\{%\s*endif\s*%\}")


class TemplateError(ValueError):
    """Markup that is not supported or not closed."""


@dataclass(frozen=True)
class Variable:
    name: str


@dataclass(frozen=True)
class Condition:
    name: str
    body: tuple[Any, ...]


def parse_markup(source: str) -> tuple[Any, ...]:
    """A string as a sequence of literal texts, variables and conditions."""
    open_blocks: list[tuple[str, list]] = [("", [])]
    for token in _MARKUP.split(source):
        nodes = open_blocks[-1][1]
        if m := _VARIABLE.fullmatch(token):
            nodes.append(Variable(m.group(1)))
        elif m := _IF.fullmatch(token):
            open_blocks.append((m.group(1), []))
        elif _ENDIF.fullmatch(token):
            if len(open_blocks) == 1:
                raise TemplateError("endif without if")
            name, body = open_blocks.pop()
            open_blocks[-1][1].append(Condition(name, tuple(body)))
        elif _MARKUP.fullmatch(token) or "{{" in token or "{%" in token or "{#" in token:
            raise TemplateError(f"unsupported markup: {token[:60]}")
        elif token:
            nodes.append(token)
    if len(open_blocks) > 1:
        raise TemplateError(f"if {open_blocks[-1][0]} is not closed")
    return tuple(open_blocks[0][1])


def _names(nodes: tuple[Any, ...]) -> set[str]:
    found: set[str] = set()
    for node in nodes:
        if isinstance(node, Variable):
            found.add(node.name)
        elif isinstance(node, Condition):
            found |= {node.name} | _names(node.body)
    return found


def _render(nodes: tuple[Any, ...], context: Context, null_text: str) -> Column:
    """Nodes as one string column.  A variable the context does not know is empty and false."""

    def one(node: Any) -> Column:
        if isinstance(node, str):
            return F.lit(node)
        value = context.get(node.name)
        if isinstance(node, Variable):
            return F.lit("") if value is None else F.coalesce(value.text, F.lit(null_text))
        if value is None:
            return F.lit("")
        return F.when(value.truthy, _render(node.body, context, null_text)).otherwise(F.lit(""))

    columns = [one(n) for n in nodes]
    if not columns:
        return F.lit("")
    return columns[0] if len(columns) == 1 else F.concat(*columns)


def _quoted(text: Column) -> Column:
    """A JSON string literal: an array of one string, printed as JSON, less its brackets."""
    return F.btrim(F.to_json(F.array(text)), F.lit("[]"))


class Template:
    """A compiled template.

    ``render_raw`` puts values into the JSON text as they are, null as ``None``; a value with a
    quote, a line break or a backslash then breaks or changes the JSON.  ``render_safe`` and
    ``messages`` escape values and print null as nothing.
    """

    def __init__(self, document: Any):
        self.document = document
        self._raw_nodes = parse_markup(json.dumps(document))
        self.variables: list[str] = sorted(_names(self._raw_nodes))

    def render_raw(self, context: Context) -> Column:
        return _render(self._raw_nodes, context, "None")

    def render_safe(self, context: Context) -> Column:
        """The document as JSON text, same layout, with every value escaped."""
        parts: list[Column] = []
        literal: list[str] = []

        def flush() -> None:
            if literal:
                parts.append(F.lit("".join(literal)))
                literal.clear()

        def walk(node: Any) -> None:
            if isinstance(node, str):
                nodes = parse_markup(node)
                if _names(nodes):
                    flush()
                    parts.append(_quoted(_render(nodes, context, "")))
                else:
                    literal.append(json.dumps(node))
            elif isinstance(node, dict):
                literal.append("{")
                for i, (key, value) in enumerate(node.items()):
                    literal.append((", " if i else "") + json.dumps(key) + ": ")
                    walk(value)
                literal.append("}")
            elif isinstance(node, list):
                literal.append("[")
                for i, value in enumerate(node):
                    literal.append(", " if i else "")
                    walk(value)
                literal.append("]")
            else:
                literal.append(json.dumps(node))

        walk(self.document)
        flush()
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    def turns(self, context: Context) -> list[tuple[Column, Column]]:
        """(role, content) columns of each message, values as they are."""
        found = self.document["messages"]
        return [
            tuple(
                _render(parse_markup(str(message.get(key, ""))), context, "")
                for key in ("role", "content")
            )
            for message in found
        ]

    def messages(self, context: Context) -> Column:
        """The messages as an array of (role, content) structs."""
        turns = self.turns(context)
        if not turns:
            return F.array().cast(MESSAGES_TYPE)
        return F.array(
            *[F.struct(r.alias("role"), c.alias("content")) for r, c in turns]
        )

    def prompt(
        self,
        context: Context,
        chat_format: ChatFormat | None = None,
        add_generation_prompt: bool = False,
    ) -> Column:
        """The prompt text straight from the template, without building messages."""
        return prompt_from_turns(self.turns(context), chat_format, add_generation_prompt)


def messages_from_text(rendered: Column, on_error: str = "fail") -> Column:
    """The messages in a rendered JSON text.

    Text that is not JSON, or has no list of message objects under ``messages``, is an error, or
    NULL with ``on_error="quarantine"``.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")

    def read(doc: Column) -> Column:
        items = as_array(field(doc, "messages"))
        sound = items.isNotNull() & F.forall(items, is_object)
        failed = (
            F.raise_error(F.concat(F.lit("no messages in rendered text: "), rendered)).cast(MESSAGES_TYPE)
            if on_error == "fail"
            else F.lit(None).cast(MESSAGES_TYPE)
        )
        return F.when(sound, normalize_messages(items)).otherwise(failed)

    return let(strict_json(rendered), read)


def is_valid_render(rendered: Column) -> Column:
    """Whether a rendered text is exactly one JSON value."""
    return strict_json(rendered).isNotNull()


def load_template(spark: SparkSession, path: str) -> Template:
    """Read a template file from any file system the session can reach."""
    text = spark.read.text(path, wholetext=True).first()
    return Template(json.loads(text[0] if text else ""))
