"""Text functions on string columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point str.strip() removes (29 of them).
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Anything but letters, digits, "_" and "-".
_UNSAFE_NAME = r"[^\p{L}\p{N}_-]"


def py_strip(text: Column) -> Column:
    """``str.strip()``: both ends, all Unicode whitespace."""
    return F.ltrim(py_rstrip(text), F.lit(PY_WHITESPACE))


def py_rstrip(text: Column) -> Column:
    """``str.rstrip()``: right end, all Unicode whitespace.

    Trimming at the right end works through the whole text, so it is only done where the last
    character asks for it.
    """
    ends_in_space = F.substring(text, -1, 1).isin(*PY_WHITESPACE)
    return F.when(ends_in_space, F.rtrim(text, F.lit(PY_WHITESPACE))).otherwise(text)


def is_blank(text: Column) -> Column:
    """True for an empty or whitespace-only line."""
    return F.ltrim(text, F.lit(PY_WHITESPACE)) == ""


def safe_name(name: Column) -> Column:
    """A file-safe form of a display name: unsafe characters become ``_``."""
    return F.regexp_replace(name, _UNSAFE_NAME, "_")


def run_stamp(moment: Column | None = None) -> Column:
    """Run id of the form ``20260131_235959`` (now, unless a timestamp is given)."""
    return F.date_format(F.current_timestamp() if moment is None else moment, "yyyyMMdd_HHmmss")


def _checked(stops: Sequence[str]) -> list[str]:
    stops = list(stops)
    for s in stops:
        if not isinstance(s, str) or s == "":
            raise ValueError(f"a stop sequence must be a non-empty string, not {s!r}")
    return stops


def cut_at_stop(text: Column, stops: Sequence[str]) -> Column:
    """Cut before the first occurrence of the first *listed* sequence that occurs at all.

    List order decides, not position in the text: a sequence listed later is only looked at
    when none before it occurs.
    """
    stops = _checked(stops)
    if not stops:
        return text
    cut = reduce(
        lambda chain, s: chain.when(F.contains(text, F.lit(s)), F.substring_index(text, s, 1)),
        stops,
        F,
    )
    return cut.otherwise(text)


def halt_at_stop(text: Column, stops: Sequence[str]) -> Column:
    """Keep the text up to and including the stop sequence that completes earliest."""
    stops = _checked(stops)
    if not stops:
        return text
    ends = [
        F.when(F.contains(text, F.lit(s)), F.instr(text, s) + F.lit(len(s) - 1)) for s in stops
    ]
    end = ends[0] if len(ends) == 1 else F.least(*ends)
    return F.when(end.isNull(), text).otherwise(text.substr(F.lit(1), end))
