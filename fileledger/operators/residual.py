"""Integer codes as predicted blocks: fixed linear predictors and Rice-coded residuals.

A signal's codes are cut into blocks by index, so that one long signal spreads over all tasks. In each block the differences
of order 0 to 4 are tried, and the order with the least sum of magnitudes is kept: a smooth signal's differences are small.
The differences are folded to natural numbers and Rice-coded with the parameter that costs fewest bits. The parts above and
below the parameter stand in two bit strings, so that both are read and written by array operations, without a loop over samples.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
ORDERS = 4
_FIELDS = "block bigint, n int, first_idx bigint, gaps binary, predictor int, rice int, warm array<bigint>, bits bigint, payload binary"
#: Bytes of a block beside its payload, gaps and warm-up values: block, n, first_idx, predictor, rice and lengths.
HEADER = 24


class Packed(NamedTuple):
    """A block's codes: predictor order, Rice parameter, first differences of orders below the predictor's, bits used, bytes."""

    predictor: int
    rice: int
    warm: list[int]
    bits: int
    payload: bytes


def fold(x: np.ndarray) -> np.ndarray:
    """0, -1, 1, -2, ... to 0, 1, 2, 3, ..."""
    return ((x << np.int64(1)) ^ (x >> np.int64(63))).view(np.uint64)


def unfold(z: np.ndarray) -> np.ndarray:
    return (z >> np.uint64(1)).view(np.int64) ^ -(z & np.uint64(1)).view(np.int64)


def rice_parameter(z: np.ndarray) -> tuple[int, int]:
    """The parameter with the fewest bits, the least of several, and these bits."""
    top = int(z.max()).bit_length() if len(z) else 0
    cost = [len(z) * (k + 1) + float((z >> np.uint64(k)).sum(dtype=np.float64)) for k in range(top + 1)]
    k = int(np.argmin(cost))
    return k, len(z) * (k + 1) + int((z >> np.uint64(k)).sum())


def pack(codes: np.ndarray) -> Packed:
    """A block of 64-bit codes; differences wrap around, so any codes come back."""
    x = codes.astype(np.int64)
    rows = [x]
    for _ in range(ORDERS):
        rows.append(np.diff(rows[-1]))
    # magnitudes where every order has a difference
    sums = [float(np.abs(r[ORDERS - p :].astype(np.float64)).sum()) for p, r in enumerate(rows)] if len(x) > ORDERS else [0.0]
    p = int(np.argmin(sums))
    z = fold(rows[p])
    k, bits = rice_parameter(z)
    high = (z >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(high.sum()) + len(z), np.uint8)
    unary[np.cumsum(high + 1) - 1] = 1
    low = (z[:, None] >> np.arange(k, dtype=np.uint64)[None, :]).astype(np.uint8) & 1
    return Packed(p, k, [int(r[0]) for r in rows[:p]], bits, np.packbits(unary).tobytes() + np.packbits(low).tobytes())


def unpack(n: int, predictor: int, rice: int, warm: list[int], bits: int, payload: bytes) -> np.ndarray:
    """The ``n`` codes of a block."""
    m = n - predictor
    raw = np.frombuffer(payload, np.uint8)
    wide = bits - m * rice
    split = -(-wide // 8)
    ends = np.flatnonzero(np.unpackbits(raw[:split], count=wide)) if wide else np.empty(0, np.int64)
    z = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(rice)
    if rice and m:
        low = np.unpackbits(raw[split:], count=m * rice).reshape(m, rice).astype(np.uint64)
        z |= (low << np.arange(rice, dtype=np.uint64)[None, :]).sum(axis=1, dtype=np.uint64)
    x = unfold(z)
    for first in reversed(warm):
        x = np.cumsum(np.concatenate((np.array([first], np.int64), x)), dtype=np.int64)
    return x


def _gaps(idx: np.ndarray) -> bytes | None:
    """Nothing for consecutive indices; else a list of a packed block: its numbers as 64-bit integers, then its bytes."""
    if len(idx) == int(idx[-1] - idx[0]) + 1 and (np.diff(idx) == 1).all():
        return None
    got = pack(np.diff(idx, prepend=idx[0]))
    return np.array([got.predictor, got.rice, got.bits, *got.warm], "<i8").tobytes() + got.payload


def _indices(first: int, n: int, gaps: bytes | None) -> np.ndarray:
    if gaps is None:
        return first + np.arange(n, dtype=np.int64)
    predictor, rice, bits = np.frombuffer(gaps[:24], "<i8").tolist()
    warm = np.frombuffer(gaps[24 : 24 + 8 * predictor], "<i8").tolist()
    return first + np.cumsum(unpack(n, predictor, rice, warm, bits, gaps[24 + 8 * predictor :]))


def residual_blocks(codes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``codes (signal_id, idx, code)`` to ``signal_id, block, n, first_idx, gaps, predictor, rice, warm, bits, payload``.

    A block holds the codes with ``idx`` from ``block * size`` on; indices may have gaps and repeat. A block is the most that a task
    holds of a signal. Null codes and indices aren't codes and go.
    """
    kind = codes.schema["signal_id"].dataType.simpleString()
    rows = codes.where("idx is not null and code is not null").select("signal_id", F.floor(F.col("idx") / block).cast("long").alias("block"), "idx", F.col("code").cast("long").alias("code"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def packed(table: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
            ids, blocks = table.column("signal_id").combine_chunks(), table.column("block").to_numpy()
            idx, code = table.column("idx").to_numpy(), table.column("code").to_numpy()
            for at in range(0, len(cuts) - 1, 256):
                spans = list(zip(cuts[at : at + 256], cuts[at + 1 : at + 257], strict=False))
                got = [pack(code[lo:hi]) for lo, hi in spans]
                firsts = pa.array([lo for lo, _ in spans], pa.int64())
                columns = [ids.take(firsts), pa.array(blocks[[lo for lo, _ in spans]]), pa.array([hi - lo for lo, hi in spans], pa.int32()), pa.array([int(idx[lo]) for lo, _ in spans], pa.int64()), pa.array([_gaps(idx[lo:hi]) for lo, hi in spans], pa.binary())]
                columns += [pa.array([g.predictor for g in got], pa.int32()), pa.array([g.rice for g in got], pa.int32()), pa.array([g.warm for g in got], pa.list_(pa.int64())), pa.array([g.bits for g in got], pa.int64()), pa.array([g.payload for g in got], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["signal_id", *(f.split()[0] for f in _FIELDS.split(", "))])

        for part in batches:
            table = pa.Table.from_batches([part])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            ids, blocks = table.column("signal_id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(), table.column("block").to_numpy()
            cuts = (np.flatnonzero((ids[1:] != ids[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist()
            if cuts:
                yield from packed(table, [0, *cuts])
            rest = table.slice(cuts[-1] if cuts else 0)
        if rest is not None and rest.num_rows:
            yield from packed(rest, [0, rest.num_rows])

    return rows.repartition("signal_id", "block").sortWithinPartitions("signal_id", "block", "idx").mapInArrow(run, f"signal_id {kind}, {_FIELDS}")


def residual_codes(blocks: DataFrame) -> DataFrame:
    """The codes ``signal_id, idx, code`` of blocks; each block is read by itself, so nothing is shuffled."""
    kind = blocks.schema["signal_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = part.select(["n", "predictor", "rice", "warm", "bits", "payload", "first_idx", "gaps"]).to_pylist()
                code = [unpack(r["n"], r["predictor"], r["rice"], r["warm"], r["bits"], r["payload"]) for r in rows]
                idx = [_indices(r["first_idx"], r["n"], r["gaps"]) for r in rows]
                owner = np.repeat(np.arange(len(rows)), [len(c) for c in code])
                yield pa.RecordBatch.from_arrays([part.column("signal_id").take(pa.array(owner)), pa.array(np.concatenate(idx)), pa.array(np.concatenate(code))], names=["signal_id", "idx", "code"])

    return blocks.mapInArrow(run, f"signal_id {kind}, idx bigint, code bigint")


def block_bytes(blocks: DataFrame) -> DataFrame:
    """``signal_id, blocks, n_samples, stored_bytes``: what a signal's blocks take with their headers."""
    size = HEADER + F.length("payload") + F.coalesce(F.length("gaps"), F.lit(0)) + 8 * F.size("warm")
    return blocks.groupBy("signal_id").agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("n_samples"), F.sum(size).cast("long").alias("stored_bytes"))


def residual_report(meta: DataFrame, blocks: DataFrame) -> DataFrame:
    """``encoding, signals, bytes_in, bytes_out, times``: float64 bytes against blocks and level tables."""
    joined = meta.join(block_bytes(blocks).select("signal_id", "stored_bytes"), "signal_id")
    out = F.col("stored_bytes") + F.when(F.col("encoding") == "indexed", F.col("n_levels") * 8).otherwise(0)
    sums = joined.groupBy("encoding").agg(F.count(F.lit(1)).alias("signals"), F.sum(F.col("n_samples") * 8).alias("bytes_in"), F.sum(out).cast("long").alias("bytes_out"))
    return sums.withColumn("times", F.when(F.col("bytes_out") > 0, F.col("bytes_in") / F.col("bytes_out")))
