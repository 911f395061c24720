"""Embeddings as vectors of whole numbers, shared by whitening and hard-negative mining."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SCALE = 256
PACKED = "vec_id long, label long, dims int, x binary"


def whole_matrices(column, scale: int = SCALE):
    """A batch's list column -> (rows, matrix of floor(scale * component)) for each length of vectors.

    Null and empty vectors and those with a null or non-finite component are left out. The whole
    numbers stay doubles, which hold the floor of any double; a product that overflows is the
    largest double.
    """
    lists = column.cast(pa.large_list(pa.float64()))
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)  # null components become NaN
    lengths = np.where(np.asarray(lists.is_valid()), np.diff(offsets), 0)
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        matrix = values[offsets[rows][:, None] + np.arange(length)]
        usable = np.isfinite(matrix).all(axis=1)
        if usable.any():
            with np.errstate(over="ignore"):
                matrix = np.floor(matrix[usable] * float(scale)) + 0.0
            yield rows[usable], np.nan_to_num(matrix)


def pack(matrix: np.ndarray) -> list[bytes]:
    """Each row in the narrowest of 2, 4 or 8 bytes a component: equal vectors give equal bytes."""
    peak = np.abs(matrix).max(axis=1, initial=0)
    out: list[bytes] = [b""] * len(matrix)
    for kind, fits in (("<i2", peak < 2 ** 15), ("<i4", (peak >= 2 ** 15) & (peak < 2 ** 31)), ("<f8", peak >= 2 ** 31)):
        for k, row in zip(np.flatnonzero(fits).tolist(), matrix[fits].astype(kind)):
            out[k] = row.tobytes()
    return out


def unpack(packed: list[bytes], dims: int) -> np.ndarray:
    """The matrix of packed rows, as doubles."""
    out = np.empty((len(packed), dims))
    widths = np.array([len(p) // dims for p in packed])
    for width, kind in ((2, "<i2"), (4, "<i4"), (8, "<f8")):
        rows = np.flatnonzero(widths == width)
        if len(rows):
            out[rows] = np.frombuffer(b"".join([packed[k] for k in rows.tolist()]), kind).reshape(len(rows), dims)
    return out


def packed_rows(batches, scale: int = SCALE):
    """(vec_id, label, embedding) batches -> (vec_id, label, dims, x) of the usable vectors."""
    for batch in batches:
        for rows, matrix in whole_matrices(batch.column(2), scale):
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take),
                 pa.array(np.full(len(rows), matrix.shape[1]), pa.int32()), pa.array(pack(matrix), pa.binary())],
                names=["vec_id", "label", "dims", "x"])
