"""Hierarchical packing into context-size tiers.

Each task streams over its documents and holds one window of them. Full windows of the longest tier are cut off first.
What remains of a document goes to the tier of the least power of two that holds it; each tier is packed on its own,
gaps in longer windows are filled from shorter tiers (whole pieces first, a cut one last), and windows that come out
full at their tier's size are sequences without padding. Pieces that fill no window wait for the next documents; at
a task's end they are laid out in sequences of falling powers of two.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import VOCABULARY, closed_ids

#: A piece: (length, document's number in the window's list, start in it).
Piece = tuple[int, int, int]


def take(pool: list[Piece], room: int, out: list[Piece]) -> int:
    """Move pieces from the sorted ``pool`` to ``out`` until ``room`` is full or the pool is empty: the longest that fits, or the shortest cut to fit. Gives the room left."""
    while room and pool:
        at = bisect_right(pool, (room, 1 << 62, 0)) - 1
        if at >= 0:
            piece = pool.pop(at)
        else:
            length, doc, start = pool.pop(0)
            piece = (room, doc, start)
            insort(pool, (length - room, doc, start + room))
        out.append(piece)
        room -= piece[0]
    return room


def pack_window(pieces: list[Piece], longest: int, shortest: int) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Pieces of at most ``longest`` to full windows ``(size, pieces)`` and the pieces that fill none."""
    done: list[tuple[int, list[Piece]]] = []
    tiers: dict[int, list[Piece]] = {}
    for piece in pieces:
        tiers.setdefault(max(shortest, 1 << (piece[0] - 1).bit_length()), []).append(piece)
    size = longest
    while size >= shortest:
        shorter = sorted(p for t, ps in tiers.items() if t < size for p in ps)
        rest: list[Piece] = []
        for piece in sorted(tiers.get(size, []), reverse=True):
            window = [piece]
            if take(shorter, size - piece[0], window):
                # nothing shorter is left: what the window holds goes on to wait
                rest += window
            else:
                done.append((size, window))
        tiers = {}
        for piece in shorter:
            tiers.setdefault(max(shortest, 1 << (piece[0] - 1).bit_length()), []).append(piece)
        if rest:
            left = sorted(rest)
            total = sum(p[0] for p in left)
            while total >= size:  # two or more windows over half full fill one by a cut
                window = []
                take(left, size, window)
                done.append((size, window))
                total -= size
            if size == shortest:
                return done, [*left, *(p for ps in tiers.values() for p in ps)]
            for piece in left:  # less than one window is left
                tiers.setdefault(min(size // 2, max(shortest, 1 << (piece[0] - 1).bit_length())), []).append(piece)
            over = [p for p in tiers.get(size // 2, []) if p[0] > size // 2]
            for length, doc, start in over:
                tiers[size // 2].remove((length, doc, start))
                half = size // 2
                tiers[half] += [(half, doc, start)]
                tail = length - half
                tiers.setdefault(max(shortest, 1 << (tail - 1).bit_length()), []).append((tail, doc, start + half))
        size //= 2
    return done, [p for ps in tiers.values() for p in ps]


def lay_out(pieces: list[Piece], longest: int) -> list[tuple[int, list[Piece]]]:
    """The last pieces of a task, in sequences of falling powers of two, without padding."""
    pool, out = sorted(pieces), []
    total = sum(p[0] for p in pool)
    while total:
        size = min(longest, 1 << (total.bit_length() - 1))
        window: list[Piece] = []
        take(pool, size, window)
        out.append((size, window))
        total -= size
    return out


def pack_tiers(docs: DataFrame, longest: int = 1024, shortest: int = 128, vocabulary: str = VOCABULARY, end: int = 0, window_tokens: int = 1 << 19, step_tokens: int = 1 << 16) -> DataFrame:
    """``docs (doc_id, text, ...)`` to one row per piece of a document.

    Rows: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step_id``. A document's ids are
    its tokens and then ``end``; each lies in exactly one piece. ``context`` is the sequence's size, a power of two up to
    ``longest``, which its pieces fill. ``step_id`` numbers groups of sequences of one context that hold ``step_tokens``
    tokens each (a task's last ones fewer), so that training steps are balanced. Ids of sequences and steps carry the
    number of the partition.

    Null text counts as empty and gives the one id ``end``; null doc_ids stay; repeated rows are packed each;
    other columns are ignored; an empty table gives no rows. Memory: one window of ``window_tokens``, or one document.
    """
    if longest & (longest - 1) or shortest & (shortest - 1) or not 0 < shortest <= longest:
        raise ValueError("context sizes are powers of two")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context", "step_id"]
    kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        held: dict[int, tuple[int | None, np.ndarray]] = {}
        pieces: list[Piece] = []
        windows: list[tuple[int, list[Piece]]] = []
        counts: dict[int, int] = {}
        sequences = tokens = serial = 0

        def emit(windows: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
            nonlocal sequences
            rows = []
            for size, window in windows:
                at, n = 0, counts.get(size, 0)
                counts[size] = n + 1
                step = base + (size.bit_length() << 34) + n // max(1, step_tokens // size)
                for length, doc, start in window:
                    doc_id, ids = held[doc]
                    rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids), base + sequences, at, size, step))
                    at += length
                sequences += 1
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 9, kinds, strict=True)], names=names)

        for part in batches:
            for at in range(0, part.num_rows, 64):
                ids_of, texts = part.column(0).slice(at, 64).to_pylist(), part.column(1).slice(at, 64).to_pylist()
                for doc_id, ids in zip(ids_of, closed_ids(texts, vocabulary, end), strict=True):
                    held[serial] = (doc_id, ids)
                    full = len(ids) // longest * longest
                    windows += [(longest, [(longest, serial, s)]) for s in range(0, full, longest)]
                    if full < len(ids):
                        pieces.append((len(ids) - full, serial, full))
                    serial += 1
                    tokens += len(ids)
                if tokens >= window_tokens:
                    done, pieces = pack_window(pieces, longest, shortest)
                    yield emit(windows + done)
                    held, windows, tokens = {p[1]: held[p[1]] for p in pieces}, [], 0
        done, pieces = pack_window(pieces, longest, shortest)
        yield emit(windows + done + lay_out(pieces, longest))

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context int, step_id long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
