"""Words and word windows of Arrow string arrays as 64-bit hashes, in numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D (in UTF-8 these are whole
characters). All rows of a batch are handled at once; windows never count across rows.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M64 = 2**64 - 1
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix(h):
    """A 64-bit finaliser: spreads every input bit over the word."""
    h = np.asarray(h, dtype=np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def salt(seed: int) -> np.uint64:
    return mix(np.array([(seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _M64], dtype=np.uint64))[0]


def _odd(seed: int) -> int:
    return int(salt(seed)) | 1


class Powers:
    """r^0, r^1, ... mod 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.table = base & _M64, np.ones(1, dtype=np.uint64)

    def upto(self, n: int):
        if n > len(self.table):
            size = max(n, 2 * len(self.table))
            steps = np.full(size, self.base, dtype=np.uint64)
            steps[0] = 1
            self.table = np.multiply.accumulate(steps)
        return self.table[:n]


class WordHasher:
    """Hashes of words and of windows of words. Two hashers with different seeds are independent."""

    def __init__(self, seed: int = 1, lower: bool = False):
        self.lower, self.seed = lower, seed
        self.byte = mix(np.arange(256, dtype=np.uint64) + salt(seed))
        self.in_word = Powers(_odd(seed + 100))
        step = _odd(seed + 200)
        self.forth, self.back = Powers(step), Powers(pow(step, -1, 2**64))

    def words(self, texts: pa.Array):
        """(word hashes, first): the words of row r are hashes[first[r]:first[r + 1]]. Null: none."""
        data, ends = _bytes_of(texts)
        if self.lower:
            data = _LOWER[data]
        solid = ~_SEPARATOR[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        cuts = ends[1:-1][ends[1:-1] < len(data)]
        begins[cuts] = solid[cuts]                       # a row's first word never joins the last one
        starts = np.flatnonzero(begins)
        first = np.searchsorted(starts, ends)
        if not len(starts):
            return np.zeros(0, dtype=np.uint64), first
        at = np.flatnonzero(solid)
        opens = np.searchsorted(at, starts)
        lengths = np.diff(np.append(opens, len(at)))
        inside = np.arange(len(at)) - np.repeat(opens, lengths)
        values = self.byte[data[at]] * self.in_word.upto(int(lengths.max()))[inside]
        return mix(np.add.reduceat(values, opens) + lengths.astype(np.uint64)), first

    def totals(self, hashes):
        """Running sums from which ``span`` reads the hash of any stretch of words."""
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * self.forth.upto(len(hashes)), out=sums[1:])
        return sums

    def span(self, sums, start, length):
        """Hashes of the stretches of ``length`` words from ``start`` on."""
        start = np.asarray(start)
        h = (sums[start + length] - sums[start]) * self.back.upto(len(sums))[start]
        return mix(h + np.asarray(length).astype(np.uint64) * salt(self.seed + 300))


def _bytes_of(texts: pa.Array):
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    low, high = int(ends[0]), int(ends[-1])
    raw = np.frombuffer(data, dtype=np.uint8)[low:high] if data is not None and high > low else np.zeros(0, np.uint8)
    return raw, ends - low


def row_blocks(texts: pa.Array, limit: int = 2 << 20):
    """Cut an Arrow array into (first row, slice) of about ``limit`` bytes, one row at least."""
    sizes = np.cumsum([0, *(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).tolist())])
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(sizes, sizes[at] + limit, side="right")) - 1)
        yield at, texts.slice(at, stop - at)
        at = stop
