"""Chat messages: the message type, prompt text from messages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


@dataclass(frozen=True)
class ChatFormat:
    """How a model wants its turns written, given as data.

    One turn is ``turn_open + role + role_close + content + turn_close``.  ``generation`` is
    added at the end when the model is asked to answer.
    """

    begin: str = ""
    turn_open: str = ""
    role_close: str = ""
    turn_close: str = ""
    generation: str = ""

    def turn(self, role: Column, content: Column) -> Column:
        return F.concat(
            F.lit(self.turn_open), role, F.lit(self.role_close), content, F.lit(self.turn_close)
        )


def _content(message: Column, null_content: str) -> Column:
    content = message.getField("content")
    if null_content == "empty":
        return F.coalesce(content, F.lit(""))
    if null_content == "fail":
        return F.coalesce(content, F.raise_error(F.lit("message content is null")).cast("string"))
    raise ValueError(f"null_content must be 'fail' or 'empty', not {null_content!r}")


def prompt_text(
    messages: Column,
    chat_format: ChatFormat | None = None,
    add_generation_prompt: bool = False,
    null_content: str = "fail",
) -> Column:
    """One prompt text from an array of messages.

    Without a format the contents are joined by line breaks.  Null content is an error by
    default, because a plain join would drop the message without a word.
    """
    if chat_format is None:
        parts = F.transform(messages, lambda m: _content(m, null_content))
        return F.array_join(parts, "\n")
    turns = F.transform(
        messages,
        lambda m: chat_format.turn(
            F.coalesce(m.getField("role"), F.lit("")), _content(m, null_content)
        ),
    )
    tail = chat_format.generation if add_generation_prompt else ""
    return F.concat(F.lit(chat_format.begin), F.array_join(turns, ""), F.lit(tail))


def prompt_from_turns(
    turns: Sequence[tuple[Column, Column]],
    chat_format: ChatFormat | None = None,
    add_generation_prompt: bool = False,
) -> Column:
    """As :func:`prompt_text`, for a fixed list of (role, content) columns.

    Templates have a fixed number of messages, so their prompt is one flat ``concat`` that stays
    inside generated code, with no array in between.
    """
    if chat_format is None:
        parts: list[Column] = []
        for i, (_, content) in enumerate(turns):
            parts += [F.lit("\n"), content] if i else [content]
        return F.concat(*parts) if parts else F.lit("")
    tail = chat_format.generation if add_generation_prompt else ""
    return F.concat(
        F.lit(chat_format.begin), *[chat_format.turn(r, c) for r, c in turns], F.lit(tail)
    )
