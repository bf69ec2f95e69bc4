"""Best-fit-decreasing packing into fixed-length id matrices.

Each task streams over its documents. Overlong documents are split into pieces of at most the row length; a window's
pieces, longest first, each go to the open row with the least room that still holds them. A segment tree over room
sizes finds that row in logarithmic time.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import VOCABULARY, closed_ids


class RoomTree:
    """Open rows by the room they have: a segment tree of counts, with the rows at its leaves."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.counts = [0] * (2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        i = room + self.base
        while i:
            self.counts[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Take out a row with the least room of at least ``need``: ``(row, room)``."""
        counts, i = self.counts, need + self.base
        if not counts[i]:
            while i > 1 and (i & 1 or not counts[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.base:
                i = 2 * i if counts[2 * i] else 2 * i + 1
        room = i - self.base
        while i:
            counts[i] -= 1
            i >>= 1
        return self.rows[room].pop(), room


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of piece numbers, each row's lengths adding up to at most ``size``."""
    tree, rows = RoomTree(size), []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        got = tree.take(lengths[k])
        if got is None:
            rows.append([])
            got = (len(rows) - 1, size)
        rows[got[0]].append(k)
        tree.put(got[0], got[1] - lengths[k])
    return rows


def leaving(rows: list[list[int]], lengths: list[int], enough: float, most: int) -> list[list[int]]:
    """The rows of at least ``enough`` ids, and the fullest others while more than ``most`` ids would stay behind."""
    sums = [sum(lengths[k] for k in r) for r in rows]
    wait, out = sum(sums), []
    for i in sorted(range(len(rows)), key=lambda i: -sums[i]):
        if sums[i] < enough and wait <= most:
            break
        out.append(i)
        wait -= sums[i]
    return [rows[i] for i in sorted(out)]


def packed_matrix(docs: DataFrame, size: int = 2048, vocabulary: str = VOCABULARY, end: int = 0, pad: int = 0, window_tokens: int = 1 << 20, full: float = 0.98) -> DataFrame:
    """``docs (doc_id, text, ...)`` to one row per packed matrix row.

    Rows: ``row_id``; ``ids``, ``size`` little-endian unsigned 32-bit ids, padded with ``pad``; ``n_tokens`` without padding;
    ``cu_seqlens``, the cumulative piece lengths from 0; ``resets``, where positions start again at 0 (with the start of the
    padding, if there is any); ``doc_ids`` and ``doc_starts``, each piece's document and the place of its first id in it.
    A document's ids are its tokens and then ``end``; every id lies in exactly one piece.

    Rows below ``full`` wait for the next window of documents; of more than a window of waiting ids the fullest rows go. Null text counts as empty,
    null doc_ids stay, repeated rows are packed each, other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        names = ["row_id", "ids", "n_tokens", "cu_seqlens", "resets", "doc_ids", "doc_starts"]
        pieces: list[tuple[int | None, int, np.ndarray]] = []
        number = fresh = 0

        def emit(rows: list[list[int]]) -> pa.RecordBatch:
            nonlocal number
            cols: list[list] = [[] for _ in names]
            for row in rows:
                ids = np.full(size, pad, "<u4")
                ends = [0]
                for k in row:
                    ids[ends[-1] : ends[-1] + len(pieces[k][2])] = pieces[k][2]
                    ends.append(ends[-1] + len(pieces[k][2]))
                for col, x in zip(cols, (base + number, ids.tobytes(), ends[-1], ends, ends[:-1] if ends[-1] == size else ends, [pieces[k][0] for k in row], [pieces[k][1] for k in row]), strict=True):
                    col.append(x)
                number += 1
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for part in batches:
            for at in range(0, part.num_rows, 64):
                for doc_id, ids in zip(part.column(0).slice(at, 64).to_pylist(), closed_ids(part.column(1).slice(at, 64).to_pylist(), vocabulary, end), strict=True):
                    pieces += [(doc_id, s, ids[s : s + size]) for s in range(0, len(ids), size)]
                    fresh += len(ids)
                if fresh >= window_tokens:
                    lengths = [len(p[2]) for p in pieces]
                    ready = leaving(best_fit(lengths, size), lengths, full * size, window_tokens)
                    kept = {k for r in ready for k in r}
                    for i in range(0, len(ready), 256):
                        yield emit(ready[i : i + 256])
                    pieces = [p for k, p in enumerate(pieces) if k not in kept]
                    fresh = 0
        rows = best_fit([len(p[2]) for p in pieces], size)
        for i in range(0, len(rows), 256):
            yield emit(rows[i : i + 256])

    schema = "row_id long, ids binary, n_tokens int, cu_seqlens array<int>, resets array<int>, doc_ids array<long>, doc_starts array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def write_matrix(packed: DataFrame, folder: str, rows: int = 8192) -> DataFrame:
    """Write rows of :func:`packed_matrix` as binary files into a folder that every executor mounts: one row per file, ``file, n_rows, n_tokens``.

    ``file.bin`` is the id matrix, row by row, of little-endian unsigned 32-bit ids, and can be mapped into memory;
    ``file.npz`` holds the rows' ids, ``cu_seqlens`` and ``resets`` one after the other with ``cu_splits`` and
    ``reset_splits``, where each row's begin, and the pieces' ``doc_ids`` (-1 for null) and ``doc_starts``. A file holds at
    most ``rows`` rows. Files are renamed into place, so that a task that runs twice writes the same files again. The
    result is written as it is made, so the files are there when it returns.
    """
    scratch = Scratch(packed.sparkSession, "matrix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                name, got = f"{part:05d}-{n:05d}", {c: piece.column(i).to_pylist() for i, c in enumerate(piece.schema.names)}
                n += 1
                splits = lambda lists: np.cumsum([0, *map(len, lists)])
                flat = lambda lists, kind: np.array([-1 if x is None else x for row in lists for x in row], kind)
                whole = f"{folder}/{name}.{uuid.uuid4().hex}.part"
                with open(whole, "wb") as f:
                    f.writelines(got["ids"])
                os.replace(whole, f"{folder}/{name}.bin")
                with open(whole, "wb") as f:
                    np.savez(f, row_ids=np.array(got["row_id"], np.int64), cu_seqlens=flat(got["cu_seqlens"], np.int32), cu_splits=splits(got["cu_seqlens"]), resets=flat(got["resets"], np.int32), reset_splits=splits(got["resets"]), doc_ids=flat(got["doc_ids"], np.int64), doc_starts=flat(got["doc_starts"], np.int64))
                os.replace(whole, f"{folder}/{name}.npz")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(got["ids"])], pa.int64()), pa.array([sum(got["n_tokens"])], pa.int64())], names=["file", "n_rows", "n_tokens"])

    named = packed.select("row_id", "ids", "n_tokens", "cu_seqlens", "resets", "doc_ids", "doc_starts")
    return scratch.save(named.mapInArrow(run, "file string, n_rows long, n_tokens long"), "files")


def as_matrix(ids: list[bytes]) -> np.ndarray:
    """The ``ids`` of some rows as one matrix of unsigned 32-bit ids."""
    return np.frombuffer(b"".join(ids), "<u4").reshape(len(ids), -1)
