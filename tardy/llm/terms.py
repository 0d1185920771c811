"""Terms of Arrow string arrays: maximal runs of term characters, A-Z lowered, in numpy.

All rows of a block are cut at once; terms of equal spelling are found by Arrow's exact dictionary
encoding, never by a hash.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def alphabet(digits: bool) -> np.ndarray:
    """Which bytes belong to terms: ASCII letters, all characters beyond ASCII and, if asked, digits."""
    table = np.zeros(256, dtype=bool)
    table[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
    table[ord("0"):ord("9") + 1] = digits
    return table


def terms_of(texts: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(terms, first): the terms of row r are terms[first[r]:first[r + 1]]. A null text has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, buffer = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    low, high = int(ends[0]), int(ends[-1])
    data = _LOWER[np.frombuffer(buffer, dtype=np.uint8)[low:high]] if high > low else np.zeros(0, np.uint8)
    ends = ends - low
    solid = table[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cuts = ends[1:-1][ends[1:-1] < len(data)]
    begins[cuts] = solid[cuts]                           # a row's first term never joins the last one
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, ends)
    before = np.cumsum(solid, dtype=np.int64)
    places = np.append(before[starts] - 1, before[-1] if len(before) else 0).astype(np.int64)
    packed = data[solid]
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places.tobytes()), pa.py_buffer(packed.tobytes()))
    return terms, first


def counted(terms: pa.Array, first: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct, row, code, tf): how often (tf) the term distinct[code] occurs in each row that has it."""
    coded = terms.dictionary_encode()
    distinct, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keys, tf = np.unique(rows * max(1, len(distinct)) + codes, return_counts=True)
    row, code = np.divmod(keys, max(1, len(distinct)))
    return distinct, row, code, tf
