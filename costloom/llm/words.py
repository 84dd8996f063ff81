"""Words of a batch of texts as 64-bit hashes, shared by the operators on shingles and windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Words whose hashes a worker remembers before it starts anew; a matter of speed only.
REMEMBERED = 150_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word to hash, filled on demand."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well mixed function of unsigned 64-bit values (the splitmix64 finaliser), one per seed."""
    x = values + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` values; of the whole sequence if it is shorter; empty if it is."""
    n = len(hashes)
    if not n:
        return hashes
    take = min(width, n)
    # A polynomial in _STEP, built by doubling: `total` has the runs of `done` values.
    total, done, step = hashes.copy(), 1, int(_STEP)
    for bit in bin(take)[3:]:
        total = total[: len(total) - done] * np.uint64(step) + total[done:]
        done, step = 2 * done, step * step & 0xFFFFFFFFFFFFFFFF
        if bit == "1":
            total = total[:-1] * _STEP + hashes[done:]
            done, step = done + 1, step * int(_STEP) & 0xFFFFFFFFFFFFFFFF
    total += np.uint64(take)
    return mixed(total)


def texts(column: pa.Array) -> list[bytes]:
    """Values of a string column as UTF-8, nulls as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def lists(values: list[np.ndarray], dtype: str = "int64") -> pa.ListArray:
    """An Arrow list column of arrays."""
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values).astype(np.uint64).view(np.int64) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(dtype)))
