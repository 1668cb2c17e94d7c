"""Strict JSON of any nesting and number length as the bytes of a VARIANT.

The parser of the JVM has limits (strings of 20 million characters, numbers of 1,000 characters, 1,000
levels).  Lines that it refuses are parsed here: one pass over the tokens with a stack of its own,
values put together from the inside.  The layout of the bytes is that of the public VARIANT format.
"""

from __future__ import annotations

import json
import re
from decimal import Decimal
from itertools import islice, takewhile

import numpy as np

#: Spark reads no larger VARIANT.
MOST_BYTES = 128 << 20

#: A run of opening or of closing brackets is one token.
_TOKEN = re.compile(
    r'[ \t\n\r]*(?:(\[(?:[ \t\n\r]*+\[)*+|\](?:[ \t\n\r]*+\])*+|[{},:])|("[^"\\\x00-\x1f]*+(?:\\.[^"\\\x00-\x1f]*+)*+")|'
    r"(-?(?:0|[1-9][0-9]*+)(\.[0-9]++)?([eE][+-]?[0-9]++)?(?![0-9.eE+-]))|(true|false|null)(?![a-z]))"
)
_REST = re.compile(r"[ \t\n\r]*\Z")
_LITERALS = {"null": b"\x00", "true": b"\x04", "false": b"\x08"}
_MOST_DIGITS = 38


def _size(n: int) -> int:
    """Bytes that hold numbers up to ``n``."""
    return max(1, (n.bit_length() + 7) // 8)


def _string(text: str) -> bytes:
    data = text.encode("utf-8", "replace")
    if len(data) < 64:
        return bytes([len(data) << 2 | 1]) + data
    return b"\x40" + len(data).to_bytes(4, "little") + data


def _whole(n: int) -> bytes | None:
    for kind, size in ((3, 1), (4, 2), (5, 4), (6, 8)):
        if -(1 << 8 * size - 1) <= n < 1 << 8 * size - 1:
            return bytes([kind << 2]) + n.to_bytes(size, "little", signed=True)
    return None


def _double(text: str) -> bytes:
    import struct

    return b"\x1c" + struct.pack("<d", float(text))


def _number(text: str, fraction: str | None, exponent: str | None) -> bytes:
    """A whole number if it fits into 8 bytes, a decimal of up to 38 digits, else a double."""
    digits = len(text.lstrip("-").replace(".", "").lstrip("0"))
    if exponent or digits > _MOST_DIGITS or len(fraction or "") > _MOST_DIGITS + 1:
        return _double(text)
    if not fraction and (whole := _whole(int(text))) is not None:
        return whole
    sign, figures, power = Decimal(text).as_tuple()
    unscaled = int("".join(map(str, figures))) * (-1 if sign else 1)
    for kind, size, most in ((8, 4, 9), (9, 8, 18), (10, 16, _MOST_DIGITS)):
        if max(digits, -power) <= most:
            return bytes([kind << 2, -power]) + unscaled.to_bytes(size, "little", signed=True)
    return _double(text)


def _numbers(values: list[int], size: int) -> bytes:
    return b"".join(v.to_bytes(size, "little") for v in values)


def _offsets(parts: list[bytes]) -> list[int]:
    ends = [0]
    for part in parts:
        ends.append(ends[-1] + len(part))
    return ends


def _array(parts: list[bytes]) -> bytes:
    ends = _offsets(parts)
    wide, size = len(parts) > 255, _size(ends[-1])
    head = bytes([wide << 4 | size - 1 << 2 | 3]) + len(parts).to_bytes(4 if wide else 1, "little")
    return b"".join([head, _numbers(ends, size), *parts])


def _wrapped(value: bytes, levels: int) -> bytes | None:
    """``value`` as the only item of an array that is the only item of another, ``levels`` times; None if
    too large.  The heads are joined in one go, so nothing is copied level by level."""
    parts, length = [value], len(value)
    while levels:
        # Heads of one size: each array is longer than the one inside by its head.
        size = _size(length)
        head, limit = 2 + 2 * size, min(1 << 8 * size, MOST_BYTES + 1)
        alike = min(levels, -(-(limit - length) // head))
        heads = np.zeros((alike, head), np.uint8)
        heads[:, :2] = size - 1 << 2 | 3, 1
        lengths = length + head * np.arange(alike - 1, -1, -1)
        heads[:, 2 + size :] = lengths.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :size]
        parts.append(heads.tobytes())
        levels -= alike
        length += head * alike
        if length > MOST_BYTES:
            return None
    return b"".join(reversed(parts))


def _lone_levels(open_parts: list, most: int) -> int:
    """How many of the innermost open containers, at most ``most``, are arrays whose only item is the
    container inside; the innermost one holds its item already."""
    if isinstance(open_parts[-1], dict) or len(open_parts[-1]) != 1:
        return 0
    # An empty list is none that holds an earlier item.
    outer = takewhile([].__eq__, islice(reversed(open_parts), 1, most))
    return 1 + sum(1 for _ in outer)


def _object(fields: dict[str, bytes], ids: dict[str, int]) -> bytes:
    keys = sorted(fields, key=lambda k: k.encode("utf-16-be", "replace"))
    parts = [fields[k] for k in keys]
    ends, numbers = _offsets(parts), [ids[k] for k in keys]
    wide, size, id_size = len(parts) > 255, _size(ends[-1]), _size(max(numbers, default=0))
    head = bytes([wide << 6 | id_size - 1 << 4 | size - 1 << 2 | 2]) + len(parts).to_bytes(4 if wide else 1, "little")
    return b"".join([head, _numbers(numbers, id_size), _numbers(ends, size), *parts])


def _metadata(ids: dict[str, int]) -> bytes:
    names = [k.encode("utf-8", "replace") for k in ids]
    ends = _offsets(names)
    size = _size(max(ends[-1], len(names)))
    return b"".join([bytes([1 | size - 1 << 6]), len(names).to_bytes(size, "little"), _numbers(ends, size), *names])


def variant_bytes(text: str) -> tuple[bytes, bytes] | None:
    """(value, metadata) of a text that is exactly one JSON value; None if it is not, or too large.

    The last of two equal keys wins.
    """
    ids: dict[str, int] = {}
    # Open containers: an array's parts, or an object's fields and the key that waits for its value.
    open_parts: list[list[bytes] | dict[str, bytes]] = []
    keys: list[str | None] = []
    done: bytes | None = None
    # What may come next: a value, the first value or end of an array, the first key or end, a key,
    # a colon, a comma or end.
    state, at = "value", 0

    while done is None:
        token = _TOKEN.match(text, at)
        if token is None:
            return None
        at = token.end()
        sign, string, number, fraction, exponent, literal = token.groups()
        value: bytes | None = None
        # Closing brackets that follow the first one.
        closing = sign.count("]") - 1 if sign and sign[0] == "]" else 0
        sign = sign and sign[0]
        if state in ("key", "first key"):
            if string is not None:
                keys[-1] = json.loads(string)
                ids.setdefault(keys[-1], len(ids))
                state = "colon"
                continue
            if sign != "}" or state == "key":
                return None
            keys.pop()
            value = _object(open_parts.pop(), ids)
        elif state == "colon":
            if sign != ":":
                return None
            state = "value"
            continue
        elif state == "comma":
            inside = open_parts[-1]
            if sign == ",":
                state = "key" if isinstance(inside, dict) else "value"
                continue
            if sign != ("}" if isinstance(inside, dict) else "]"):
                return None
            keys.pop()
            open_parts.pop()
            value = _object(inside, ids) if isinstance(inside, dict) else _array(inside)
        elif sign == "{":
            open_parts.append({})
            keys.append(None)
            state = "first key"
            continue
        elif sign == "[":
            opening = text.count("[", token.start(), at)
            open_parts.extend([] for _ in range(opening))
            keys.extend([None] * opening)
            state = "first value"
            continue
        elif sign is not None:
            if sign != "]" or state != "first value":
                return None
            keys.pop()
            value = _array(open_parts.pop())
        elif string is not None:
            try:
                value = _string(json.loads(string))
            except ValueError:
                return None
        else:
            value = _LITERALS[literal] if literal else _number(number, fraction, exponent)
        while done is None:
            if value is None or len(value) > MOST_BYTES:
                return None
            inside = open_parts[-1] if open_parts else None
            if closing and not isinstance(inside, list):
                return None
            state = "comma"
            if inside is None:
                done = value
            elif isinstance(inside, dict):
                inside[keys[-1]] = value
            else:
                inside.append(value)
            if not closing:
                break
            lone = _lone_levels(open_parts, closing)
            closed = max(lone, 1)
            value = _wrapped(value, lone) if lone else _array(inside)
            del open_parts[-closed:], keys[-closed:]
            closing -= closed
    if not _REST.match(text, at):
        return None
    metadata = _metadata(ids)
    return (done, metadata) if len(done) + len(metadata) <= MOST_BYTES else None
