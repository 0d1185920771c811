"""Ranked lexical search by exact inner products over sparse ball trees.

Method: a document is the vector of its integer term impacts, an item the vector of its term weights
times repeats, and the score is their inner product. Documents are cut into trees of a bounded number
of documents; a tree halves its documents by two far-apart pivots down to leaves. Each node has its
centroid and, for every group of terms, the radius of its documents around the centroid in the space
of that group. For any document below a node the inner product is at most
``<item, centroid> + sum over groups of |item in group| * radius of group`` (Cauchy-Schwarz in each
group), in doubles and rounded up by a margin above the largest rounding error. A search opens the
nodes of highest bound first, scores leaves exactly in integers, and leaves out every subtree
whose bound is below the tenth score so far; equal bounds are opened, so ties are exact.

Documents are mapped into the space of the item block's own terms, which leaves inner products as they are.
Neighbouring term numbers belong to the same or to similar items, so an item's terms fall into few groups.
A task searches its trees one after the other and keeps the best rows of each item, so later trees
start with a threshold; the best rows of the tasks meet in a window with a limit before its shuffle.
"""

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tardy.llm.common import bounded_batches, stored
from tardy.llm.terms import alphabet, counted, terms_of
from tardy.llm.wordhash import row_blocks

TOP = 10
TERMS_AT_ONCE = 10_000        # distinct terms of a block of items: bounds the driver's and the workers' tables
TREE_DOCS = 4096              # documents of a tree
TREE_TERMS = 1 << 20          # or term entries, whichever comes first
LEAF = 32                     # documents of a leaf
GROUP = 16                    # terms of a group
SLACK = 1e-9                  # relative margin of the bounds; rounding errors stay below 1e-11

INDEX_SCHEMA = "doc_id long, n long, codes array<int>, tfs array<int>"
HITS_SCHEMA = "item long, doc_id long, score long"


def term_index(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, n (terms with repeats), and number and frequency of each of ``terms`` a document holds."""
    table, wanted = alphabet(digits=True), pa.array(terms, pa.large_string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in row_blocks(batch.column(1)):
                split, first = terms_of(texts, table)
                distinct, row, code, tf = counted(split, first)
                number = pc.fill_null(pc.index_in(distinct, wanted), -1).to_numpy().astype(np.int32)
                number = number[code] if len(distinct) else np.zeros(0, np.int32)
                hit = number >= 0
                ends = pa.array(np.searchsorted(row[hit], np.arange(len(texts) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(np.diff(first).astype(np.int64)),
                     pa.ListArray.from_arrays(ends, pa.array(number[hit])),
                     pa.ListArray.from_arrays(ends, pa.array(tf[hit].astype(np.int32)))],
                    names=["doc_id", "n", "codes", "tfs"])

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, INDEX_SCHEMA)


class BallTree:
    """A ball tree over sparse rows (starts, codes, impacts); rows are reordered, ``order`` says how."""

    def __init__(self, starts: np.ndarray, codes: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.n_terms, self.groups = n_terms, -(-n_terms // GROUP)
        self.starts, self.codes, self.impacts = starts, codes, impacts
        self.order = np.arange(len(starts) - 1)
        self.children: list[tuple] = []             # (left, right), or (first, last) row of a leaf
        self.is_leaf: list[bool] = []
        centroids, radii = [], []
        todo = [(self.order, None, 0)]
        placed = []
        while todo:                                 # depth first, so that leaves are runs of the order
            rows, parent, side = todo.pop()
            me = len(self.children)
            if parent is not None:
                self.children[parent][side] = me
            centroid, radius, apart = self._ball(rows)
            centroids.append(centroid)
            radii.append(radius)
            left, right = self._halves(rows, apart) if len(rows) > LEAF else (rows, rows[:0])
            self.is_leaf.append(not len(right))
            if self.is_leaf[me]:
                done = sum(map(len, placed))
                placed.append(rows)
                self.children.append([done, done + len(rows)])
            else:
                self.children.append([None, None])
                todo += [(right, me, 1), (left, me, 0)]
        self.order = np.concatenate(placed)
        self.centroids, self.radii = np.array(centroids), np.array(radii)
        entry, ends = self._entries(self.order)
        self.codes, self.impacts, self.starts = codes[entry], impacts[entry], ends

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the rows' entries, one row after the other, and where each row begins."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return np.arange(ends[-1]) + np.repeat(self.starts[rows] - ends[:-1], sizes), ends

    def _ball(self, rows: np.ndarray):
        """Centroid, radius in each group, and squared distance of each row from the centroid."""
        entry, ends = self._entries(rows)
        code, value = self.codes[entry], self.impacts[entry].astype(np.float64)
        centroid = np.bincount(code, weights=value, minlength=self.n_terms) / len(rows)
        at = np.repeat(np.arange(len(rows)), np.diff(ends)) * self.groups + code // GROUP
        moved = np.bincount(at, weights=value * (value - 2 * centroid[code]), minlength=len(rows) * self.groups)
        own = np.bincount(np.arange(self.n_terms) // GROUP, weights=centroid**2, minlength=self.groups)
        squared = np.maximum(moved.reshape(len(rows), -1) + own, 0)
        # what cancels in the sum is of the order of the squares: the margin covers it
        margin = SLACK * (own + np.bincount(at, weights=value**2, minlength=len(moved)).reshape(squared.shape).max(axis=0))
        return centroid, np.sqrt(squared.max(axis=0) + margin), squared.sum(axis=1)

    def _products(self, rows: np.ndarray, pivot: int) -> np.ndarray:
        """Squared distance of each row from one row, up to a constant."""
        dense = np.zeros(self.n_terms)
        mine = slice(self.starts[pivot], self.starts[pivot + 1])
        dense[self.codes[mine]] = self.impacts[mine]
        entry, ends = self._entries(rows)
        value = self.impacts[entry].astype(np.float64)
        sums = np.concatenate([[0.0], np.cumsum(value * (value - 2 * dense[self.codes[entry]]))])
        return sums[ends[1:]] - sums[ends[:-1]] + (dense**2).sum()

    def _halves(self, rows: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows nearer to one pivot (the row farthest from the centroid) than to the row farthest from it."""
        one = rows[apart.argmax()]
        to_one = self._products(rows, one)
        other = rows[to_one.argmax()]
        lean = to_one - self._products(rows, other)
        near = np.argsort(lean, kind="stable")
        middle = int((lean < 0).sum())
        least = max(1, len(rows) // 8)
        if not least <= middle <= len(rows) - least:
            middle = len(rows) // 2             # keeps the tree's depth logarithmic, copies of one text included
        return rows[near[:middle]], rows[near[middle:]]

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For every node, a number that no row below it exceeds in its inner product."""
        norms = np.sqrt(np.bincount(terms // GROUP, weights=weights.astype(np.float64)**2, minlength=self.groups))
        used = np.flatnonzero(norms)
        bound = self.centroids[:, terms] @ weights + self.radii[:, used] @ norms[used]
        return bound * (1 + SLACK) + 1

    def scores(self, leaf: int, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact integer scores) of a leaf."""
        first, last = self.children[leaf]
        low, high = self.starts[first], self.starts[last]
        sums = np.concatenate([[0], np.cumsum(dense[self.codes[low:high]] * self.impacts[low:high])])
        edges = self.starts[first:last + 1] - low
        return self.order[first:last], sums[edges[1:]] - sums[edges[:-1]]


def search(tree: BallTree, ids: list, terms: np.ndarray, weights: np.ndarray, best: list, top: int,
           dense: np.ndarray) -> int:
    """Best-first search; ``best`` is a heap of (score, -doc_id) that is kept at ``top``. Returns leaves opened."""
    bound = tree.bounds(terms, weights)
    dense[terms] = weights
    todo, opened = [(-bound[0], 0)], 0
    while todo:
        limit, node = heapq.heappop(todo)
        if len(best) == top and -limit < best[0][0]:
            break
        if tree.is_leaf[node]:
            opened += 1
            rows, scores = tree.scores(node, dense)
            least = best[0][0] if len(best) == top else 1
            for k in np.flatnonzero(scores >= least).tolist():
                hit = (int(scores[k]), _last_first(ids[rows[k]]))
                if len(best) < top:
                    heapq.heappush(best, hit)
                elif hit > best[0]:
                    heapq.heapreplace(best, hit)
        else:
            for child in tree.children[node]:
                heapq.heappush(todo, (-bound[child], child))
    dense[terms] = 0
    return opened


def _last_first(doc_id) -> int:
    """Sorts ids downwards; a null id comes after all others."""
    return -(1 << 70) if doc_id is None else -doc_id


def _id(key: int):
    return None if key == -(1 << 70) else -key


def hits(index: DataFrame, queries: list[tuple[int, list[int], list[int]]], n_terms: int, n_docs: int, n_all: int,
         top: int = TOP) -> DataFrame:
    """(item, doc_id, score): each task's best rows for every query (number, terms, weights)."""
    asked = [(q, np.array(t, dtype=np.int64), np.array(w, dtype=np.int64)) for q, t, w in queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {q: [] for q, _, _ in asked}
        dense = np.zeros(n_terms, dtype=np.int64)
        ids, sizes, codes, impacts = [], [], [], []

        def flush():
            if ids:
                starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
                tree = BallTree(starts, np.concatenate(codes), np.concatenate(impacts), n_terms)
                for q, t, w in asked:
                    search(tree, ids, t, w, best[q], top, dense)
                for held in (ids, sizes, codes, impacts):
                    held.clear()

        for batch in batches:
            for at in range(0, len(batch), TREE_DOCS):
                part = batch.slice(at, TREE_DOCS)
                lens = np.diff(part.column(2).offsets.to_numpy())
                tf = part.column(3).flatten().to_numpy().astype(np.int64)
                m = np.array([25 + 75 * n * n_docs // n_all for n in part.column(1).to_pylist()], dtype=np.int64)
                if sum(map(len, codes)) + len(tf) > TREE_TERMS or len(ids) + len(part) > TREE_DOCS:
                    flush()
                ids += part.column(0).to_pylist()
                sizes.append(lens)
                codes.append(part.column(2).flatten().to_numpy().astype(np.int64))
                impacts.append(1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, lens)))
        flush()
        rows = [(q, _id(key), score) for q, held in best.items() for score, key in held]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, HITS_SCHEMA)


def _weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(items: DataFrame) -> Iterator[dict]:
    """Items (number -> id and terms with repeats) in blocks of a bounded number of distinct terms."""
    table, block, held = alphabet(digits=True), {}, set()
    for number, row in enumerate(items.toLocalIterator()):
        split, _ = terms_of(pa.array([row["text"]], pa.string()), table)
        repeats: dict[str, int] = {}
        for t in split.to_pylist():
            repeats[t] = repeats.get(t, 0) + 1
        if block and len(held | repeats.keys()) > TERMS_AT_ONCE:
            yield block
            block, held = {}, set()
        block[number] = (row["item_id"], repeats)
        held |= repeats.keys()
    if block:
        yield block


def _numbered(block: dict) -> list[str]:
    """The terms of a block of items so that neighbours belong together: items that share their most
    frequent term stand side by side, and a term comes with the first item that has it."""
    among: dict[str, int] = {}
    for _, repeats in block.values():
        for t in repeats:
            among[t] = among.get(t, 0) + 1
    by_use = [sorted(repeats, key=lambda t: (-among[t], t)) for _, repeats in block.values() if repeats]
    return list(dict.fromkeys(t for terms in sorted(by_use) for t in terms))


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` documents with a score above 0.

    Equal scores rank by doc_id; a null doc_id comes last. Rows that share a doc_id are documents of
    their own, and rows that share an item_id are one item with the terms of all of them. Null texts
    have no terms: such documents are not found and such items find nothing. An empty table gives
    an empty result. Only the named columns are read. Items are read row by row and searched in blocks
    of at most ``TERMS_AT_ONCE`` distinct terms (one item at least), each against all documents.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = items.groupBy(F.col(item_col).cast("long").alias("item_id")).agg(
        F.array_join(F.sort_array(F.collect_list(F.col(item_text_col).cast("string"))), " ").alias("text"))
    found = []
    for block in _blocks(items):
        terms = _numbered(block)
        code = {t: i for i, t in enumerate(terms)}
        index = stored(term_index(docs, terms), "search-index")
        n_docs, n_all = index.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n_all:
            break
        held = index.select(F.explode("codes").alias("code")).groupBy("code").count().collect()    # a row per term of the block
        weight = {r["code"]: _weight(n_docs, r["count"]) for r in held}
        queries = []
        for number, (_, repeats) in block.items():
            known = [(code[t], k * weight[code[t]]) for t, k in repeats.items() if weight.get(code[t], 0)]
            if known:
                queries.append((number, *map(list, zip(*known, strict=True))))
        best = hits(index.filter(F.size("codes") > 0), queries, len(terms), n_docs, n_all, top)
        names = spark.createDataFrame([(k, i) for k, (i, _) in block.items()], "item long, item_id long")
        found.append(best.join(F.broadcast(names), "item").select("item_id", "doc_id", "score"))     # bounded with the block
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score")
