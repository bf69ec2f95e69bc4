"""Encoded copies in folders that every executor mounts: a signal's codes and a sidecar, and the samples rebuilt from them.

An encoded file holds a signal's levels as little-endian float64, if it is indexed, and then its codes in blocks of
predicted residuals. The sidecar says how to read it. A rebuilt file holds the samples as little-endian float64.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import file_xxh64
from ..functions.paths import artifact_paths, normalise
from ..operators import residual

OUTCOMES = "file_path string, attempt int, success boolean, error string, decode_failure boolean, rebuilt_checksum string, data_checksum string, compressed_checksum string, sidecar_checksum string, compressed_bytes bigint"


#: Of a block in a file: codes, predictor, Rice parameter, bits, bytes of the payload; warm-up values and the payload follow.
_BLOCK = struct.Struct("<IBBQI")


def _frame(n: int, predictor: int, rice: int, warm: list[int], bits: int, payload: bytes) -> bytes:
    return _BLOCK.pack(n, predictor, rice, bits, len(payload)) + np.array(warm, "<i8").tobytes() + payload


def _blocks(src: BinaryIO) -> Iterator[np.ndarray]:
    """The codes of the blocks that follow in a file; a file that ends in a block is an error."""
    while head := src.read(_BLOCK.size):
        if len(head) < _BLOCK.size:
            raise ValueError("the encoded file ends in a block")
        n, predictor, rice, bits, size = _BLOCK.unpack(head)
        body = src.read(8 * predictor + size)
        if len(body) < 8 * predictor + size or predictor > residual.ORDERS or n < predictor:
            raise ValueError("the encoded file ends in a block")
        codes = residual.unpack(n, predictor, rice, np.frombuffer(body[: 8 * predictor], "<i8").tolist(), bits, body[8 * predictor :])
        if len(codes) != n:
            raise ValueError("a block holds another number of codes than it says")
        yield codes


def write_encoded(codes: DataFrame, meta: DataFrame, levels: DataFrame, folder: str) -> DataFrame:
    """Write each signal's encoded file below ``folder``: ``signal_id, compressed_checksum, encoded_bytes``.

    Blocks are packed in all tasks; a signal's blocks then pass one task in order, in a stream, and its file is renamed into
    place at the end. The result must be saved before it is used twice, since every evaluation writes.
    """
    blocks = residual.residual_blocks(codes).select("signal_id", F.lit(1).alias("part"), F.col("block").alias("pos"), "n", "predictor", "rice", "warm", "bits", "payload")
    rows = blocks.unionByName(levels.select("signal_id", F.lit(0).alias("part"), F.col("level_idx").alias("pos"), "level"), allowMissingColumns=True)
    places = artifact_paths(meta.select("signal_id", F.col("signal_id").alias("file_path"))).select("signal_id", "encoded_path")
    dealt = rows.join(places, "signal_id").repartition("signal_id").sortWithinPartitions("signal_id", "part", "pos")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        last = out = part = place = None
        h, size = xxhash.xxh64(), 0

        def finished() -> pd.DataFrame:
            out.close()
            os.replace(part, place)
            return pd.DataFrame([(last, h.hexdigest(), size)], columns=["signal_id", "compressed_checksum", "encoded_bytes"])

        for frame in frames:
            for key, rows in frame.groupby("signal_id", sort=False):
                if key != last:
                    if out:
                        yield finished()
                    last, h, size = key, xxhash.xxh64(), 0
                    place = os.path.join(folder, rows["encoded_path"].iloc[0])
                    part = f"{place}.{uuid.uuid4().hex}.part"
                    os.makedirs(os.path.dirname(place), exist_ok=True)
                    out = open(part, "wb")
                first = rows["part"].to_numpy() == 0
                packed = rows.loc[~first, ["n", "predictor", "rice", "warm", "bits", "payload"]].itertuples(index=False)
                frames_of = b"".join(_frame(int(r.n), int(r.predictor), int(r.rice), list(r.warm), int(r.bits), r.payload) for r in packed)
                for data in (rows["level"].to_numpy("<f8")[first].tobytes(), frames_of):
                    out.write(data)
                    h.update(data)
                    size += len(data)
        if out:
            yield finished()

    return dealt.drop("pos").mapInPandas(run, "signal_id string, compressed_checksum string, encoded_bytes bigint")


def send_encoded(written: DataFrame, meta: DataFrame, hashes: DataFrame, folder: str, target: str, attempt: int = 1) -> DataFrame:
    """Write the sidecars of encoded files, read both back, rebuild the samples below ``target``: one outcome row per file.

    ``written`` is the saved result of :func:`write_encoded`, ``hashes (signal_id, data_xxh64)`` are those of the samples.
    A rebuilt file gets its name only if the hash of its samples is as expected, and then an index file beside it, which
    was made for another file, goes. The result must be saved before it is used twice.
    """
    named = meta.join(written, "signal_id").join(hashes.select("signal_id", "data_xxh64"), "signal_id").withColumn("file_path", normalise(F.col("signal_id")))
    named = artifact_paths(named).select("signal_id", "file_path", "encoded_path", "sidecar_path", "encoding", "bits_per_sample", "grid_offset", "step", "n_levels", "n_samples", "data_xxh64", "compressed_checksum", "encoded_bytes")

    def one(r) -> tuple:
        failed = lambda error, decoding=False, size=None: (r.signal_id, attempt, False, error, decoding, None, None, None, None, size)
        sidecar = {"encoding": r.encoding, "bits_per_sample": int(r.bits_per_sample), "n_samples": int(r.n_samples), "n_levels": int(r.n_levels) if r.encoding == "indexed" else 0, "grid_offset": None if pd.isna(r.grid_offset) else r.grid_offset, "step": None if pd.isna(r.step) else r.step, "data_xxh64": r.data_xxh64}
        text, beside = json.dumps(sidecar).encode(), os.path.join(folder, r.sidecar_path)
        part = f"{beside}.{uuid.uuid4().hex}.part"
        import xxhash

        try:
            with open(part, "wb") as f:
                f.write(text)
            os.replace(part, beside)
            if file_xxh64(os.path.join(folder, r.encoded_path)) != r.compressed_checksum:
                return failed("the encoded file differs from what was sent")
            if (sidecar_hash := file_xxh64(beside)) != xxhash.xxh64_hexdigest(text):
                return failed("the sidecar differs from what was sent")
        except OSError as e:
            return failed(f"{type(e).__name__}: {e.strerror}")
        size = int(r.encoded_bytes) + len(text)
        try:
            rebuilt = rebuild_file(os.path.join(folder, r.encoded_path), beside, os.path.join(target, r.file_path))
        except (OSError, ValueError) as e:
            return failed(f"rebuilding failed: {type(e).__name__}: {e}", True, size)
        return (r.signal_id, attempt, True, None, False, rebuilt, r.data_xxh64, r.compressed_checksum, sidecar_hash, size)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([one(r) for r in frame.itertuples(index=False)], columns=[c.split()[0] for c in OUTCOMES.split(", ")])

    return named.mapInPandas(run, OUTCOMES)


def rebuild_file(encoded: str, sidecar: str, target: str) -> str:
    """Write the samples of an encoded file to ``target`` if their hash is as the sidecar says: the hash of the new file."""
    import xxhash

    with open(sidecar, "rb") as f:
        how = json.load(f)
    part, h = f"{target}.{uuid.uuid4().hex}.part", xxhash.xxh64()
    os.makedirs(os.path.dirname(target), exist_ok=True)
    try:
        with open(encoded, "rb") as src, open(part, "wb") as dst:
            levels = np.frombuffer(src.read(8 * how["n_levels"]), "<f8")
            for codes in _blocks(src):
                values = levels[codes] if how["encoding"] == "indexed" else how["grid_offset"] + codes.astype("<f8") * how["step"]
                dst.write(values.astype("<f8").tobytes())
                h.update(values.astype("<f8").tobytes())
            dst.flush()
            os.fsync(dst.fileno())
        if h.hexdigest() != how["data_xxh64"]:
            raise ValueError(f"samples have hash {h.hexdigest()}, not {how['data_xxh64']}")
        again = file_xxh64(part)
        os.replace(part, target)
    finally:
        if os.path.exists(part):
            os.remove(part)
    if os.path.exists(f"{target}_index"):
        os.remove(f"{target}_index")
    return again
