"""Bit sets of a fixed size that tasks fill and every task reads: packed by piece, merged, and broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

_PIECE = 21  # bits in a piece: 256 kB


def pieces(bits: int) -> int:
    """Number of pieces of a set of 2**``bits`` bits."""
    return 1 << max(bits - _PIECE, 0)


def packed(bits: np.ndarray) -> list[tuple[int, bytes]]:
    """Distinct bit numbers (uint32) as one binary per piece of the set."""
    bits = np.unique(bits.astype(np.uint32))
    cuts = np.flatnonzero(np.diff(bits >> np.uint32(_PIECE))) + 1
    return [(int(part[0] >> np.uint32(_PIECE)), part.tobytes()) for part in np.split(bits, cuts) if len(part)]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held = pieces.setdefault(piece, np.zeros(1 << _PIECE, dtype=bool))
            held[np.frombuffer(bits, dtype=np.uint32) & np.uint32((1 << _PIECE) - 1)] = True
    maps = [np.packbits(held, bitorder="little").tobytes() for held in pieces.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int64()), pa.array(maps, pa.binary())], names=["piece", "bits"])


def broadcast_set(rows: DataFrame, bits: int) -> Broadcast:
    """The union of all packed rows (piece, bits) as one set of 2**``bits`` bits, whatever the input."""
    merged = rows.select("piece", "bits").repartition("piece").mapInArrow(_merged, "piece long, bits binary")
    whole = np.zeros(1 << (bits - 3), dtype=np.uint8)
    size = 1 << (_PIECE - 3)
    for r in merged.collect():
        whole[r["piece"] * size : (r["piece"] + 1) * size] = np.frombuffer(r["bits"], dtype=np.uint8)
    return rows.sparkSession.sparkContext.broadcast(whole)


def in_set(whole: np.ndarray, bits: np.ndarray) -> np.ndarray:
    bits = bits.astype(np.uint32)
    return (whole[bits >> np.uint32(3)] >> (bits & np.uint32(7)).astype(np.uint8)) & np.uint8(1) != 0
