"""Arrow helpers shared by the operators that work on words (`[^\\x20\\x09-\\x0D]+`)."""

from __future__ import annotations

import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def texts_of(column) -> pa.Array:
    """A text column as one Arrow array of large strings that owns its bytes, null as empty.

    A slice of a batch keeps offsets that do not begin at 0, and some Arrow kernels then return
    garbage, so the texts are copied to an array of their own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # combine_chunks of an empty column
        column = pa.array([], pa.string())
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    return texts.take(pa.array(np.arange(len(texts))))


def word_codes(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, code of every word in reading order, words before each text).

    ASCII white space is exactly what Arrow's ascii_split_whitespace splits at. The third array
    has one entry more than there are texts.
    """
    lists = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]) if len(lists) else lists.values
    offsets = offsets - offsets[0]
    encoded = pc.dictionary_encode(flat)
    codes = np.asarray(encoded.indices, dtype=np.int64)
    lengths = np.asarray(pc.binary_length(encoded.dictionary), dtype=np.int64)
    blank = lengths == 0  # leading or trailing white space leaves an empty word
    if blank.any():
        keep = ~blank[codes]
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        codes = codes[keep]
    return encoded.dictionary, codes, offsets


def batches_of(batches, max_bytes: int = 8 << 20):
    """Re-slice record batches so that none holds much more than max_bytes (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        parts = max(1, min(batch.num_rows, -(-batch.nbytes // max_bytes)))
        step = -(-batch.num_rows // parts)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def worker_cache() -> dict:
    """A dict that lives as long as this Python worker (module globals only live for a task)."""
    home = sys.modules.setdefault("_mercato_worker", ModuleType("_mercato_worker"))
    return home.__dict__.setdefault("cache", {})
