"""Source divergence audit: how far the term shares of a language's sources lie apart.

Method, late string materialisation: documents are cut into terms by the tasks, and what is shuffled
of a term is its 64-bit digest. The distinct spellings of each task's digests are kept in a
written table beside the counts; its minimum and maximum spelling per digest show where two terms share a
digest, and only such digests are counted again by spelling. Spellings are joined back for
the terms that are reported and for no others.

The pair sums need all sources of a term side by side. Kept terms are dealt into blocks by digest; a
task holds a block as a matrix of sources x terms of bounded size and emits one partial sum
for each two sources, so nothing is emitted per term and pair, and a hot language is many blocks.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tardy.llm.common import bounded_batches, by_shuffle, stored, text_or_empty
from tardy.llm.terms import alphabet, counted, terms_of
from tardy.llm.wordhash import row_blocks

LEAST_DOCS = 3                # documents of a language that must hold a term
TOP_TERMS = 200
BLOCK_CELLS = 1 << 21         # sources x terms of a block: 16 MB as 64-bit numbers
BLOCK_BYTES = 8 << 20         # text that is counted at once
KNOWN_DIGESTS = 1_000_000     # digests whose spelling a task remembers to have written

PARTIAL_SCHEMA = "lang string, source string, digest long, n long, docs long, term string"


def partial_counts(docs: DataFrame, digest_bits: int = 64, spell_all: bool = False) -> DataFrame:
    """Counts of blocks of documents: lang, source, digest, n (occurrences), docs and term.

    ``term`` is null where the task has written that digest's spelling before; a spelling
    that differs from the one written before is written again. ``spell_all`` writes every one.
    """
    table, drop = alphabet(digits=False), 64 - digest_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, str] = {}
        for batch in batches:
            for at, texts in row_blocks(batch.column(2), BLOCK_BYTES):
                langs, sources = (batch.column(i).slice(at, len(texts)).dictionary_encode() for i in (0, 1))
                group = langs.indices.to_numpy() * len(sources.dictionary) + sources.indices.to_numpy()
                distinct, row, code, tf = counted(*terms_of(texts, table))
                if not len(distinct):
                    continue
                spelled = distinct.to_pylist()
                digests = np.array([xxhash.xxh3_64_intdigest(t) >> drop for t in spelled], dtype=np.uint64).view(np.int64)
                keys, which = np.unique(group[row].astype(np.int64) * len(distinct) + code, return_inverse=True)
                n, held = np.bincount(which, weights=tf).astype(np.int64), np.bincount(which)
                group, code = np.divmod(keys, len(distinct))
                if len(known) + len(spelled) > KNOWN_DIGESTS:
                    known.clear()
                new, once = np.zeros(len(spelled), dtype=bool), np.unique(code, return_index=True)[1]
                for i, (d, t) in enumerate(zip(digests.tolist(), spelled, strict=True)):
                    if known.get(d) != t:
                        known[d], new[i] = t, True
                shown = np.zeros(len(code), dtype=bool)
                shown[once] = new[code[once]]
                text = distinct.take(pa.array(np.where(shown | spell_all, code, -1), mask=~(shown | spell_all)))
                lang, source = np.divmod(group, len(sources.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(lang)), sources.dictionary.take(pa.array(source)),
                     pa.array(digests[code]), pa.array(n), pa.array(held.astype(np.int64)), text.cast(pa.string())],
                    names=["lang", "source", "digest", "n", "docs", "term"])

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, PARTIAL_SCHEMA)


def term_counts(docs: DataFrame, digest_bits: int) -> tuple[DataFrame, DataFrame]:
    """(counts, spellings): lang, source, digest, other, n, docs; and one spelling per digest.

    ``other`` is null, or the spelling where two terms share the digest.
    """
    parts = stored(partial_counts(docs, digest_bits), "audit-parts")
    names = stored(parts.filter("term is not null").groupBy("digest").agg(
        F.min("term").alias("low"), F.max("term").alias("high")), "audit-names")
    rows = parts.select("lang", "source", "digest", F.lit(None).cast("string").alias("other"), "n", "docs")
    shared = names.filter("low <> high").select("digest")
    if shared.head(1):                       # two terms with one digest: their rows are counted by spelling
        again = partial_counts(docs, digest_bits, spell_all=True).join(by_shuffle(shared), "digest", "left_semi")
        rows = rows.join(by_shuffle(shared), "digest", "left_anti").unionByName(
            again.select("lang", "source", "digest", F.col("term").alias("other"), "n", "docs"))
    counts = rows.groupBy("lang", "source", "digest", "other").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return stored(counts, "audit-counts"), names.select("digest", F.col("low").alias("spelling"))


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(10^9 * (n + 1) / (total + terms)), in three steps of a thousand so that no product overflows."""
    whole, out, rest = f"({total} + {terms})", "0L", f"({n} + 1)"
    for _ in range(3):
        out, rest = f"({out} * 1000 + {rest} * 1000 div {whole})", f"({rest} * 1000 % {whole})"
    return F.expr(f"{out} + 1")


def _shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The same for numpy arrays."""
    out, rest = np.zeros_like(n), n + 1
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // whole, rest * 1000 % whole
    return out + 1


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): summed over all kept terms, for each two sources of a language.

    ``groups`` has lang, source, total and terms (kept terms of the language). Each block of a
    language has every source's header row, so sources without a term in it count too.
    """
    sizes = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) * F.greatest(F.max("terms"), F.lit(1)) / BLOCK_CELLS)
                                       .cast("int").alias("blocks"))
    heads = groups.join(sizes, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", "total", "terms",
        F.lit(None).cast("long").alias("digest"), F.lit(None).cast("string").alias("other"), F.lit(0).cast("long").alias("n"))
    none = F.lit(None).cast("long")
    cells = kept.join(sizes, "lang").select(
        "lang", F.pmod(F.xxhash64("digest", "other"), F.col("blocks")).cast("int").alias("block"), "source",
        none.alias("total"), none.alias("terms"), "digest", "other", "n")
    dealt = heads.unionByName(cells).repartition("lang", "block").sortWithinPartitions("lang", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            for start, key in _runs(batch):
                if key != at:
                    yield from _block_sums(held)
                    held, at = [], key
                held.append(start)
        yield from _block_sums(held)

    sums = dealt.mapInArrow(run, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    """Slices of a sorted batch with one (lang, block) each."""
    lang, block = batch.column("lang").to_pylist(), batch.column("block").to_pylist()
    at = 0
    for i in range(1, len(lang) + 1):
        if i == len(lang) or (lang[i], block[i]) != (lang[at], block[at]):
            yield batch.slice(at, i - at), (lang[at], block[at])
            at = i


def _block_sums(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of one block: for each source its row of the matrix against all others."""
    if not parts:
        return
    rows = pa.Table.from_batches(parts)
    head = rows.filter(rows["total"].is_valid())
    cell = rows.filter(rows["digest"].is_valid())
    sources = head["source"].to_pylist()
    place = {s: i for i, s in enumerate(sources)}
    whole = (head["total"].to_numpy() + head["terms"].to_numpy()).astype(np.int64)
    names = list(zip(cell["digest"].to_pylist(), cell["other"].to_pylist(), strict=True))
    column = {t: i for i, t in enumerate(dict.fromkeys(names))}
    n = np.zeros((len(sources), len(column)), dtype=np.int64)
    n[[place[s] for s in cell["source"].to_pylist()], [column[t] for t in names]] = cell["n"].to_numpy()
    p = _shares(n, np.maximum(whole, 1)[:, None]) if len(column) else n
    lang = head["lang"][0].as_py()
    for i, source in enumerate(sources):
        apart = p[i] - p
        sums = (apart * apart // p).sum(axis=1) if len(column) else np.zeros(len(sources), dtype=np.int64)
        other = [j for j in range(len(sources)) if j != i]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(other), pa.string()), pa.array([source] * len(other), pa.string()),
             pa.array([sources[j] for j in other], pa.string()), pa.array(sums[other], pa.int64())],
            names=["lang", "source", "item", "value"])


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, digest_bits: int = 64) -> DataFrame:
    """lang, source, part, item, value, rank: the divergence of every (lang, source) group.

    Part ``pair`` has each other source of the language with the divergence summed over the
    language's kept terms; part ``term`` the ``top`` kept terms that the group uses more than its language
    does. A term is kept where at least ``least_docs`` rows of the language hold it. Equal values rank
    by item in UTF-8 order. Nulls in any of the three columns count as ''. A repeated row is a
    document of its own. A group without terms has its pairs; a language without kept terms has
    pairs of value 0 and no terms; one with a single source has no pairs; an empty table gives an empty
    result. Only the three columns are read, so others may have any name.
    """
    docs = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"),
                       text_or_empty(text_col).alias("text"))
    counts, spellings = term_counts(docs, digest_bits)
    term = Window.partitionBy("lang", "digest", "other")
    kept = (counts.withColumn("lang_docs", F.sum("docs").over(term)).filter(F.col("lang_docs") >= least_docs)
            .withColumn("lang_n", F.sum("n").over(term)).withColumn("lead", F.col("source") == F.min("source").over(term))
            .select("lang", "source", "digest", "other", "n", "lang_n", "lead"))
    kept = stored(kept, "audit-kept")

    every = docs.select("lang", "source").distinct()
    by_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("lead").alias("terms"))
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (every.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
              .na.fill(0, ["total", "lang_total", "terms"]))
    groups = stored(groups, "audit-groups")

    pairs = pair_sums(kept.select("lang", "source", "digest", "other", "n"), groups.select("lang", "source", "total", "terms"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))

    known = kept.join(groups, ["lang", "source"])
    scored = known.select("lang", "source", "digest", "other", _share("n", "total", "terms").alias("p"),
                          _share("lang_n", "lang_total", "terms").alias("q"))
    scored = stored(scored.filter("p > q").selectExpr("lang", "source", "digest", "other", "(p - q) * (p - q) div q as value"),
                    "audit-scored")
    # the value at the last rank first, so that only terms that may be reported meet their spelling
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    least = (scored.select("lang", "source", "value").withColumn("place", F.row_number().over(by_value))
             .filter(F.col("place") <= top).groupBy("lang", "source").agg(F.min("value").alias("least")))
    shown = scored.join(least, ["lang", "source"]).filter(F.col("value") >= F.col("least"))
    named = shown.join(by_shuffle(spellings), "digest").select(
        "lang", "source", F.coalesce("other", "spelling").alias("item"), "value")
    terms = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(terms.select(columns))
