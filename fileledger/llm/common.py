"""What the operators of this subpackage share: the scratch folder, joins by a
checked size, and word shingles as 64-bit hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import remove, scratch_path

#: Most rows of a (long, long) table that are sent to every executor; a row is under 32 bytes, so under 32 MB.
BROADCAST_ROWS = 1_000_000


_OPEN: list[list[Scratch]] = []


class Scratch:
    """Tables written to the shared folder, which cut lineage and survive lost executors; deleted when the driver's process ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self.paths: dict[int, str] = {}
        self.kept: list[DataFrame] = []
        self.n = 0
        if _OPEN:
            _OPEN[-1].append(self)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.kept.append(out)  # an id must not be given to another frame
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        """Delete tables that no later step reads."""
        for df in frames:
            if df is not None and (path := self.paths.pop(id(df), None)):
                remove(self.spark, path)


@contextmanager
def passing_tables() -> Iterator[None]:
    """Tables that operators write to the shared folder in this block are deleted at its end, when their result has been written elsewhere."""
    _OPEN.append([])
    try:
        yield
    finally:
        for scratch in _OPEN.pop():
            remove(scratch.spark, scratch.root)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, marked for broadcast if a count shows that it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def strings(column, rows: int = 128) -> Iterator[str | None]:
    """The values of an Arrow column, a few at a time: a batch of long texts isn't held as Python strings as well."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def text_key(text) -> list:
    """128 bits of a text, as two columns."""
    return [F.xxhash64(text), F.xxhash64(F.lit("b"), text)]


# --- word shingles ---------------------------------------------------------------------------------------------

#: Words of more bytes than this are hashed by BLAKE2b.
LONG_WORD = 255
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20_240_501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[[9, 10, 11, 12, 13, 32]] = 0  # white space
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_PLACES = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text, in order, with A-Z lower-cased.

    A polynomial modulo 2**64 has known colliding strings from about a thousand characters on, so long words are hashed by BLAKE2b.
    """
    data = text.encode("utf-8", "surrogatepass").lower()
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    values = _BYTES[raw]
    inside = np.concatenate(([0], (values != 0).view(np.int8), [0]))
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, inverse = powers(len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up, dtype=np.uint64)))
    out = mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of the whole sequence if it has fewer words; else empty."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        out += words[i : i + n] * _PLACES[i % 64] + np.uint64(i)
    return np.unique(mix64(out))
