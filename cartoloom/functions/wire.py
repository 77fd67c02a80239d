"""Protocol-buffer bytes: runs of numbers by array arithmetic, messages as their values by field."""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterable

import numpy as np

#: Bytes of a value by its kind, where the kind fixes them.
WIDTHS = {1: 8, 5: 4}


def numbers(data: bytes) -> np.ndarray:
    """All numbers of bytes that hold nothing else, as unsigned 64-bit values."""
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    if len(raw) and (not len(last) or last[-1] != len(raw) - 1):
        raise ValueError("a number breaks off")
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    place = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    parts = (raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.add.reduceat(parts, first) if len(first) else parts


def signed(values: np.ndarray) -> np.ndarray:
    """Numbers whose lowest bit is the sign."""
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


def running(data: bytes) -> np.ndarray:
    """Numbers kept as signed differences."""
    return np.cumsum(signed(numbers(data)))


def number_bytes(values: Iterable[int]) -> bytes:
    """Numbers (not negative), one after the other, as ``numbers`` reads them."""
    v = np.array(list(values), np.uint64)
    size = np.ones(len(v), np.int64)
    for bits in range(7, 64, 7):
        size += v >> np.uint64(bits) > 0
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out = np.repeat(v, size) >> (7 * place).astype(np.uint64) & np.uint64(127)
    out[place + 1 < np.repeat(size, size)] |= np.uint64(128)
    return out.astype(np.uint8).tobytes()


@functools.lru_cache(maxsize=1 << 14)
def _head(*values: int) -> bytes:
    return number_bytes(values)


def message(*parts: tuple[int, int | float | bytes | None]) -> bytes:
    """A message of (field, value): whole numbers, 8-byte floats or bytes; None leaves the field out."""
    out = []
    for field, value in parts:
        if isinstance(value, int):
            out.append(_head(field * 8, value))
        elif isinstance(value, float):
            out += [_head(field * 8 + 1), struct.pack("<d", value)]
        elif value is not None:
            out += [_head(field * 8 + 2, len(value)), value]
    return b"".join(out)


class Message:
    """The values of a message by field, in order: whole numbers, and parts of its bytes for all else."""

    def __init__(self, data: bytes | memoryview):
        self._view, self._at = memoryview(data), 0
        self.values: dict[int, list] = {}
        while self._at < len(self._view):
            field, kind = divmod(self._number(), 8)
            if kind == 0:
                value = self._number()
            else:
                size = self._number() if kind == 2 else WIDTHS.get(kind)
                if size is None:
                    raise ValueError(f"field {field} is of kind {kind}")
                value = self._view[self._at : self._at + size]
                self._at += size
            self.values.setdefault(field, []).append(value)

    def _number(self) -> int:
        end = self._at
        while self._view[end] > 127:
            end += 1
        own = self._view[self._at : end + 1]
        self._at = end + 1
        return own[0] if len(own) == 1 else sum((b & 127) << 7 * i for i, b in enumerate(own))

    def all(self, field: int) -> list:
        return self.values.get(field, [])

    def last(self, field: int, default=None):
        return self.values.get(field, [default])[-1]

    def numbers(self, field: int) -> np.ndarray:
        """Numbers of a field that holds runs of them, or one by one."""
        runs = [np.array([v], np.uint64) if isinstance(v, int) else numbers(v) for v in self.all(field)]
        return np.concatenate(runs) if runs else np.zeros(0, np.uint64)
