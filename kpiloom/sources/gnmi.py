"""gNMI subscribe responses (serialised protocol buffers) to series.

Only the few message fields that carry updates are read: notification prefix,
update paths with keys, and numeric values.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.schema import SERIES


def fields(buffer: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(number, wire type, value) of a message's fields."""
    at, n = 0, len(buffer)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            if at >= n or shift > 63:
                raise ValueError("truncated message")
            b = buffer[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < n:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, kind, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError("unknown wire type")
        size = {1: 8, 5: 4}.get(kind) or varint() if kind != 2 else varint()
        if at + size > n:
            raise ValueError("truncated message")
        yield tag >> 3, kind, buffer[at : at + size]
        at += size


def _path(message: bytes) -> tuple[list[str], dict[str, str]]:
    names, keys = [], {}
    for number, _, value in fields(message):
        if number == 3:
            for part, _, content in fields(value):
                if part == 1:
                    names.append(content.decode())
                elif part == 2:
                    pair = {k: v.decode() for k, _, v in fields(content)}
                    keys[pair.get(1, "")] = pair.get(2, "")
    return names, keys


def _number(message: bytes) -> float | None:
    """A typed value as a double; text, booleans and bytes give none."""
    for number, _, value in fields(message):
        if number == 2:
            return float(value - (1 << 64) if value >> 63 else value)
        if number == 3:
            return float(value)
        if number == 6:
            return float(struct.unpack("<f", value)[0])
        if number == 14:
            return struct.unpack("<d", value)[0]
    return None


def decode(response: bytes) -> list[tuple[int, str, dict | None, float, str]]:
    """(seq, path, labels, value, type) of an update response; other responses give none."""
    out: list[tuple[int, str, dict | None, float, str]] = []
    for number, kind, note in fields(response):
        if number != 1 or kind != 2:
            continue
        prefix: tuple[list[str], dict[str, str]] = ([], {})
        updates = []
        for part, _, value in fields(note):
            if part == 2:
                prefix = _path(value)
            elif part == 4:
                updates.append(value)
        for u in updates:
            own, number_found = ([], {}), None
            for part, _, value in fields(u):
                if part == 1:
                    own = _path(value)
                elif part == 3:
                    number_found = _number(value)
            if number_found is not None:
                labels = prefix[1] | own[1]
                out.append((len(out), "/" + "/".join(prefix[0] + own[0]), labels or None, number_found, "untyped"))
    return out


def series(payload: Column) -> Column:
    """A struct of the payload's series and, where it is malformed, an error."""

    @F.pandas_udf(f"series {SERIES}, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ("seq", "name", "labels", "value", "type")
        for payloads in batches:
            rows = []
            for p in payloads:
                try:
                    rows.append(([dict(zip(names, r, strict=True)) for r in decode(bytes(p or b""))], None))
                except (ValueError, UnicodeDecodeError, struct.error) as e:
                    rows.append(([], f"gnmi: {e}"))
            yield pd.DataFrame(rows, columns=["series", "error"])

    return run(payload)


def field(number: int, content: bytes) -> bytes:
    return bytes([number << 3 | 2]) + varint(len(content)) + content


def varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def encode(updates: list[tuple[str, dict[str, str], float]], prefix: str = "") -> bytes:
    """An update response with double values, for fixtures and the simulator's sink."""

    def path(text: str, keys: dict[str, str]) -> bytes:
        parts = [p for p in text.split("/") if p]
        out = b""
        for i, p in enumerate(parts):
            pairs = b"".join(field(2, field(1, k.encode()) + field(2, v.encode())) for k, v in keys.items()) if i == len(parts) - 1 else b""
            out += field(3, field(1, p.encode()) + pairs)
        return out

    note = field(2, path(prefix, {})) if prefix else b""
    for text, keys, value in updates:
        typed = bytes([14 << 3 | 1]) + struct.pack("<d", value)
        note += field(4, field(1, path(text, keys)) + field(3, typed))
    return field(1, note)
