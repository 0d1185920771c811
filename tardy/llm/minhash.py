"""MinHash near-dedup by a multi-index Hamming join over b-bit signatures.

A document's set (its distinct word shingles) gets a signature of ``SYMBOLS`` minimum hashes cut
to 16 bits. Two signatures are near when they differ in at most ``ERRORS`` symbols. Method: the
signature is split into ``CHUNKS`` chunks; by the pigeonhole principle near signatures have a
chunk with at most one differing symbol, so every chunk is indexed once for each symbol it may
have wrong (the other symbols are the key). No pair under the distance is missed. Near pairs are
then confirmed on the full sets.

Large groups under one key are never expanded into pairs:
1. equal sets are one node (grouped by a 128-bit digest);
2. each key has a leader, the node that shares most keys with others (the original among its
   edited copies), and each node is compared with the leader it meets most often; confirmed links
   are contracted to components;
3. keys whose nodes are still in several components are compared in blocks of signatures on the
   executors (numpy, no rows made). Nodes that have a near one of another component there, which
   one-bit sketches of ``SKETCH`` further hashes do not rule out, meet again in the same blocks with their
   full sets; pairs are confirmed there, under the first key they share, and what leaves a block is a spanning
   forest of its links. Pairs inside a component need no check: membership is what is asked for.

At a similarity of 0.75 a signature differs in 12 of 48 symbols on average (deviation 3). The
distance of 23 is exceeded by 1 pair in 6,010 at the threshold itself (binomial tail 1.66e-4; at
0.76 8.4e-5, at 0.8 3.3e-6), but pairs beyond it that share a key are kept up to ``SHARED_ERRORS``
(six deviations, tail 8.4e-9). What is lost at the threshold are pairs without a common key, 1.0e-7,
and those that the sketches rule out, 5.1e-9 (six deviations).
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tardy.llm.common import bounded_batches, by_shuffle, stored
from tardy.llm.components import components
from tardy.llm.wordhash import WordHasher, mix, row_blocks, salt

SHINGLE = 5
SYMBOLS, CHUNK = 48, 4
CHUNKS = SYMBOLS // CHUNK
ERRORS = 2 * CHUNKS - 1           # at most one wrong symbol in some chunk
# pairs that share a key: a quarter of the symbols differ at the threshold; six deviations more
SHARED_ERRORS = int(SYMBOLS / 4 + 6 * (SYMBOLS * 3 / 16) ** 0.5)
BLOCK = 512                       # signatures compared with each other at once
BLOCK_BYTES = 16 << 20            # or so many bytes of shingle sets
SIMILAR, OF = 75, 100             # link when OF * intersection >= SIMILAR * union
SKETCH = 2048                     # one-bit minimum hashes of a sketch
# differing bits of a linked pair: an eighth of them on average; six deviations more
SKETCH_ERRORS = int(SKETCH / 8 + 6 * (SKETCH * 7 / 64) ** 0.5)

SIGNATURE_SCHEMA = "doc_id long, n_shingles long, a long, b long, sig binary"


def shingle_sets(hasher: WordHasher, texts: pa.Array) -> list:
    """Sorted distinct shingle hashes of each row; fewer words than a shingle are one shingle."""
    words, first = hasher.words(texts)
    sums = hasher.totals(words)
    n = np.diff(first)
    every = hasher.span(sums, np.arange(max(0, len(words) - SHINGLE + 1)), SHINGLE)
    sets = []
    for at, count in zip(first[:-1].tolist(), n.tolist(), strict=True):
        if count >= SHINGLE:
            sets.append(np.unique(every[at:at + count - SHINGLE + 1]))
        elif count:
            sets.append(hasher.span(sums, np.array([at]), count))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def _minima(sets: list, hashes: int, seed: int):
    """Minimum hashes of non-empty sets, block by block: (first set, last set, k, minima)."""
    xor = [salt(seed + k) for k in range(hashes)]
    odd = [salt(seed + 10_000 + k) | np.uint64(1) for k in range(hashes)]
    at = 0
    while at < len(sets):
        stop, held = at, 0
        while stop < len(sets) and (stop == at or held + len(sets[stop]) <= 1 << 15):
            held += len(sets[stop])
            stop += 1
        flat = np.concatenate(sets[at:stop])
        cuts = np.cumsum([0, *(len(s) for s in sets[at:stop - 1])])
        for k in range(hashes):
            yield at, stop, k, mix(np.minimum.reduceat((flat ^ xor[k]) * odd[k], cuts))
        at = stop


def signatures_of(sets: list):
    """(n, 48) array of 16-bit symbols for non-empty sets."""
    out = np.empty((len(sets), SYMBOLS), dtype=np.uint16)
    for at, stop, k, low in _minima(sets, SYMBOLS, 1000):
        out[at:stop, k] = low.astype(np.uint16)
    return out


def sketches_of(sets: list):
    """(n, SKETCH / 8) array of bytes: one bit of each of many more minimum hashes."""
    bits = np.empty((len(sets), SKETCH), dtype=np.uint8)
    for at, stop, k, low in _minima(sets, SKETCH, 50_000):
        bits[at:stop, k] = (low & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, a and b (digest of the set), sig (null for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(seed=1, lower=True)
        for batch in batches:
            for at, texts in row_blocks(batch.column(1)):
                sets = shingle_sets(hasher, texts)
                full = [i for i, s in enumerate(sets) if len(s)]
                sigs = [None] * len(sets)
                for i, row in zip(full, signatures_of([sets[i] for i in full]), strict=True):
                    sigs[i] = row.tobytes()
                a = np.array([mix(s).sum() if len(s) else 0 for s in sets], dtype=np.uint64)
                b = np.array([mix(s ^ salt(9)).sum() if len(s) else 0 for s in sets], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(sigs, pa.binary())],
                    names=["doc_id", "n_shingles", "a", "b", "sig"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SIGNATURE_SCHEMA)


@F.arrow_udf(T.ArrayType(T.LongType()))
def chunk_keys(sig: pa.Array) -> pa.Array:
    """Index keys of a signature: for every chunk and every symbol that may be wrong, the others."""
    symbols = np.frombuffer(b"".join(sig.to_pylist()), dtype=np.uint16).astype(np.int64).reshape(-1, CHUNKS, CHUNK)
    keys = np.empty((len(symbols), CHUNKS, CHUNK), dtype=np.int64)
    tag = np.arange(CHUNKS, dtype=np.int64) * CHUNK
    for wrong in range(CHUNK):
        rest = [symbols[:, :, i] for i in range(CHUNK) if i != wrong]
        keys[:, :, wrong] = (tag + wrong) << 48 | rest[0] << 32 | rest[1] << 16 | rest[2]
    ends = np.arange(len(symbols) + 1) * CHUNKS * CHUNK
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel()))


@F.arrow_udf(T.IntegerType())
def distance(x: pa.Array, y: pa.Array) -> pa.Array:
    """Differing symbols of two signatures."""
    left, right = (np.frombuffer(b"".join(s.to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS) for s in (x, y))
    return pa.array((left != right).sum(axis=1).astype(np.int32))


@F.arrow_udf(T.BooleanType())
def similar(x: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Are two texts linked? Decided on their full shingle sets."""
    hasher = WordHasher(seed=1, lower=True)
    for left, right in x:
        out = []
        for at, texts in row_blocks(left):
            out += map(linked, shingle_sets(hasher, texts), shingle_sets(hasher, right.slice(at, len(texts))))
        yield pa.array(out, pa.bool_())


def sketched(texts: DataFrame) -> DataFrame:
    """(id, sketch) of nodes with a text."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = WordHasher(seed=1, lower=True)
        for batch in batches:
            rows = []
            for _, some in row_blocks(batch):
                rows += [r.tobytes() for r in sketches_of(shingle_sets(hasher, some))]
            yield pa.array(rows, pa.binary())

    return texts.select("id", F.arrow_udf(run, T.BinaryType())("text").alias("sketch"))


def shingled(texts: DataFrame) -> DataFrame:
    """(id, full) of nodes with a text: the whole shingle set, sorted."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = WordHasher(seed=1, lower=True)
        for batch in batches:
            rows = []
            for _, some in row_blocks(batch):
                rows += [s.tobytes() for s in shingle_sets(hasher, some)]
            yield pa.array(rows, pa.binary())

    return texts.select("id", F.arrow_udf(run, T.BinaryType())("text").alias("full"))


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (u, v) whose texts are linked; ``texts`` has one row (id, text) per node."""
    left = texts.select(F.col("id").alias("u"), F.col("text").alias("u_text"))
    right = texts.select(F.col("id").alias("v"), F.col("text").alias("v_text"))
    met = pairs.select("u", "v").join(by_shuffle(left), "u").join(by_shuffle(right), "v")
    return met.filter(similar("u_text", "v_text")).select("u", "v")


def dealt(members: DataFrame) -> DataFrame:
    """``members`` (key, id, comp, size) with their places (i, j, mine) in blocks.

    A key's nodes are dealt into blocks of about ``BLOCK`` nodes and ``BLOCK_BYTES`` of shingle sets; every two blocks
    meet once, under (key, i, j).
    """
    blocks = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") * 8 / BLOCK_BYTES)
    sizes = members.groupBy("key").agg(F.ceil(blocks).cast("int").alias("blocks"))
    placed = members.join(by_shuffle(sizes), "key").withColumn(
        "mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.select("key", F.least("mine", "theirs").alias("i"), F.greatest("mine", "theirs").alias("j"),
                         "mine", "id", "comp")


def _by_block(rows: DataFrame, one, schema: str) -> DataFrame:
    """Apply ``one`` to the rows of every (key, i, j): the pair of blocks lies in one task, with nothing else."""
    names = [c.split(" ")[0] for c in schema.split(", ")]
    grouped = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                key = (row["key"], row["i"], row["j"])
                if key != at and held:
                    found += one(held)
                    held = []
                at = key
                held.append(row)
            yield pa.RecordBatch.from_pylist(found, schema=out)
        yield pa.RecordBatch.from_pylist(one(held) if held else [], schema=out)

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    out = pa.schema([(n, kinds[c.split(" ")[1]]) for n, c in zip(names, schema.split(", "), strict=True)])
    return grouped.mapInArrow(run, schema)


NEAR_SCHEMA = "key long, i int, j int, mine int, id long, comp long, sig binary, sketch binary"


def near_members(placed: DataFrame, errors: int = ERRORS) -> DataFrame:
    """The rows of ``placed`` (with sig and sketch) that may be linked with a node of another component there.

    No pair within ``ERRORS`` lacks a common key. A row stays or goes; none is made for a pair.
    """
    def one(rows: list[dict]) -> list[dict]:
        block = _Block(rows, errors)
        near = np.zeros(len(rows), dtype=bool)
        for i, others in block.pairs():
            near[others] = True
            near[i] |= len(others) > 0
        return [rows[k] for k in np.flatnonzero(near)]

    return _by_block(placed, one, NEAR_SCHEMA)


def block_links(near: DataFrame, errors: int = ERRORS) -> DataFrame:
    """Links (u, v), confirmed on full sets, that join different components under a common key.

    ``near`` are rows of ``near_members`` with ``full``, the whole shingle set. A pair of blocks emits a spanning
    forest of the links it finds: at most one row fewer than it has nodes.
    """
    def one(rows: list[dict]) -> list[dict]:
        block = _Block(rows, errors)
        sets = [np.frombuffer(r["full"], dtype=np.uint64) for r in rows]
        joined = block.part.copy()                    # the tree of the forest that each node is in
        out = []
        for i, others in block.pairs():
            for j in others:
                if joined[j] != joined[i] and linked(sets[i], sets[j]):
                    out.append({"u": min(rows[i]["id"], rows[j]["id"]), "v": max(rows[i]["id"], rows[j]["id"])})
                    joined[joined == joined[j]] = joined[i]
        return out

    return _by_block(near, one, "u long, v long")


def _first_keys(wrong: np.ndarray) -> np.ndarray:
    """For rows of differing symbols: number of the first key shared, by chunk and the first symbol that may be
    wrong there (-1: none)."""
    wrong = wrong.reshape(-1, CHUNKS, CHUNK)
    few = wrong.sum(axis=2) <= 1
    chunk = few.argmax(axis=1)
    symbol = wrong[np.arange(len(wrong)), chunk].argmax(axis=1)
    return np.where(few.any(axis=1), chunk * CHUNK + symbol, -1)


def linked(p, q) -> bool:
    """The rule on two full sets (sorted, without repeats)."""
    least, most = sorted((len(p), len(q)))
    if OF * least < SIMILAR * most:                   # too different in size
        return False
    both = len(np.intersect1d(p, q, assume_unique=True))
    return bool(both) and OF * both >= SIMILAR * (len(p) + len(q) - both)


class _Block:
    """The nodes of one block or, of two blocks, of both."""

    def __init__(self, rows: list[dict], errors: int):
        comps, self.mine = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("comp", "mine"))
        self.errors, self.across, self.here = errors, rows[0]["i"] != rows[0]["j"], rows[0]["key"] >> 48
        self.sigs = np.frombuffer(b"".join(r["sig"] for r in rows), dtype=np.uint16).reshape(-1, SYMBOLS)
        self.sketches = np.frombuffer(b"".join(r["sketch"] for r in rows), dtype=np.uint64).reshape(len(rows), -1)
        order = np.argsort(comps, kind="stable")
        self.parts = np.split(order, np.flatnonzero(np.diff(comps[order])) + 1)
        self.parts.sort(key=len)                      # the largest component is never compared with itself
        self.part = np.empty(len(rows), dtype=np.int64)
        for k, part in enumerate(self.parts):
            self.part[part] = k

    def pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each node with the nodes of larger components that signature and sketch do not rule out and that
        share no earlier key with it."""
        for k, part in enumerate(self.parts[:-1]):
            rest = np.concatenate(self.parts[k + 1:])
            for i in part:
                other = rest[self.mine[rest] != self.mine[i]] if self.across else rest
                wrong = self.sigs[other] != self.sigs[i]
                few = wrong.sum(axis=1) <= self.errors
                other, wrong = other[few], wrong[few]
                close = np.bitwise_count(self.sketches[other] ^ self.sketches[i]).sum(axis=1) <= SKETCH_ERRORS
                other, wrong = other[close], wrong[close]
                yield i, other[_first_keys(wrong) == self.here] if len(other) else other


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable over links; kept marks that document. Texts
    without words are linked with nothing. Rows without a doc_id take no part in linking and
    have a null component_id (kept is false). Rows that share a doc_id are one document for
    linking. Only the id and text columns are read.
    """
    rows = stored(signatures(docs, id_col, text_col), "signatures")
    usable = rows.filter("n_shingles > 0 and doc_id is not null")
    nodes = usable.groupBy("a", "b").agg(F.min("doc_id").alias("id"), F.max("sig").alias("sig"),
                                         F.max("n_shingles").alias("size"))
    nodes = stored(nodes, "nodes")

    # keys shared by two nodes or more, each with its leader
    keyed = nodes.select("id", F.explode(chunk_keys("sig")).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(keyed.join(by_shuffle(shared), "key"), "members")
    weight = members.groupBy("id").agg(F.sum("n").alias("weight"))
    weighed = members.select("key", "id").join(by_shuffle(weight), "id")
    leaders = weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("least"))).alias("lead"))
    leaders = leaders.select("key", (-F.col("lead.least")).alias("leader"))

    # whole texts of every node that shares a key, written once for both rounds of checks
    involved = members.select("id").distinct()
    text_rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = stored(text_rows.join(by_shuffle(involved), "id", "left_semi"), "texts")
    texts = texts.dropDuplicates(["id"]) if _repeats(rows) else texts

    best = (members.select("key", "id").join(by_shuffle(leaders), "key").filter("id != leader")
            .groupBy("id", "leader").count()
            .groupBy("id").agg(F.max(F.struct("count", (-F.col("leader")).alias("least"))).alias("best")))
    sig = nodes.select("id", "sig")
    stars = best.select(F.col("id").alias("u"), (-F.col("best.least")).alias("v"))
    stars = (stars.join(by_shuffle(sig.select(F.col("id").alias("u"), F.col("sig").alias("u_sig"))), "u")
             .join(by_shuffle(sig.select(F.col("id").alias("v"), F.col("sig").alias("v_sig"))), "v")
             .filter(distance("u_sig", "v_sig") <= SHARED_ERRORS))
    edges = stored(confirm(stars, texts), "links")

    # what one leader per node left open: keys whose nodes lie in several components
    label = components(edges)
    named = members.select("key", "id").join(by_shuffle(label), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("comp"))
    open_keys = named.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y")
    rest = stored(named.join(by_shuffle(open_keys.select("key")), "key", "left_semi"), "open")
    sketch = stored(sketched(texts.join(by_shuffle(rest.select("id").distinct()), "id", "left_semi")), "sketches")
    placed = dealt(rest.join(by_shuffle(nodes.select("id", "size")), "id"))
    near = stored(near_members(placed.join(by_shuffle(sig.join(by_shuffle(sketch), "id")), "id"), SHARED_ERRORS), "near")
    full = shingled(texts.join(by_shuffle(near.select("id").distinct()), "id", "left_semi"))
    more = stored(block_links(near.join(by_shuffle(full), "id"), SHARED_ERRORS), "more-links")

    final = components(edges.unionByName(more))
    by_node = nodes.join(by_shuffle(final), "id", "left").select("a", "b", F.coalesce("component", "id").alias("component"))
    linked = rows.join(by_shuffle(by_node.filter("component is not null")), ["a", "b"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce(
            F.when(F.col("n_shingles") > 0, F.col("component")), F.col("doc_id"))).alias("component_id"))
    return linked.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _repeats(rows: DataFrame) -> bool:
    """Does any doc_id occur twice?"""
    return bool(rows.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").head(1))
