"""64-bit hashes of many stretches of bytes at once, in numpy."""

from __future__ import annotations

import numpy as np

from fleetmart.llm.shared import process_cache

_U = np.uint64
#: Odd, and 3 modulo 8, so that powers differ in many low bits.
BASE = 0x9E6C63D0676A9A9B
_table = np.random.default_rng(20_260_101).integers(0, 1 << 64, 256, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(kind: str, base: int, n: int) -> np.ndarray:
    powers = process_cache("powers", dict)
    known = powers.get(kind)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        steps[0] = 1
        known = powers[kind] = np.cumprod(steps)
    return known[:n]


class Stretches:
    """Hashes of stretches of one array of bytes: equal bytes have equal hashes wherever they lie."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_table[data] * _power("up", BASE, n), out=self.sums[1:])
        self.back = _power("down", pow(BASE, -1, 1 << 64), n + 1)

    def raw(self, starts, ends) -> np.ndarray:
        """Before mixing; indices or slices."""
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed(self.raw(starts, ends) + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary Arrow column without nulls, and where each value begins and ends."""
    import pyarrow as pa

    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, places, values = column.buffers()
    ends = np.frombuffer(places, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8)[ends[0] : ends[-1]] if values is not None else np.empty(0, dtype=np.uint8)
    return data, ends - ends[0]
