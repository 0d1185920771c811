"""Lexical search, source divergence and token counts against plain Python on awkward rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tardy.llm import balltree, divergence, tokencounts

BYTE_PATH = public_tokenizers.path("byte_bpe_50k.json")
WIDE = "doc_id long, text string, lang string, source string, digest string, n string, codes int, value int, total int, item int"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sentences(seed, n, words):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


WORDS = "The the river RIVER stone, stone été ÉTÉ 日本 a1 1a x-y don't zz2 naïve über".split()


def rows(seed, n):
    rnd = random.Random(seed)
    texts = [*sentences(seed, n, WORDS), None, "", "-- 12 !", "stone " * 20_000, "the river", "the river", "the river"]
    return [(i, t, rnd.choice(["en", "fr", None, ""]), rnd.choice(["a", "b", "c", None]), "d", "n", 1, 2, 3, 4)
            for i, t in enumerate(texts)]


# --- 11 search

def terms11(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def ranked(docs, items, top=10):
    found = [(i, Counter(terms11(t))) for i, t in docs]
    n_docs, n_all = sum(bool(c) for _, c in found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = defaultdict(Counter)
    for i, t in items:
        asked[i].update(terms11(t))
    out = set()
    for item, query in asked.items():
        hits = []
        for doc, c in found:
            m = 25 + 75 * c.total() * n_docs // max(1, n_all)
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, k in query.items() if c[t])
            if score > 0:
                hits.append((-score, doc is None, doc or 0, doc))
        out |= {(item, k, h[3], -h[0]) for k, h in enumerate(sorted(hits)[:top], 1)}
    return out


ITEMS = [(1, "the river"), (2, "été 日本 stone STONE stone"), (3, None), (4, "--"), (5, "unheard of"), (6, "a1 x"), (6, "zz2"),
         (None, "naïve über"), (7, "1a " * 50)]


@pytest.mark.parametrize("leaf", [1, 32])
def test_search_equals_scoring_every_document(spark, monkeypatch, leaf):
    monkeypatch.setattr(balltree, "LEAF", leaf)
    monkeypatch.setattr(balltree, "TREE_DOCS", 40)
    monkeypatch.setattr(balltree, "GROUP", 3)
    data = [*rows(1, 150), (None, "the river stone", *rows(1, 0)[0][2:]), (3, "the river stone", *rows(1, 0)[0][2:])]
    docs = spark.createDataFrame(data, WIDE).repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [tuple(r) for r in balltree.rank(docs, items).select("item_id", "rank", "doc_id", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == ranked([r[:2] for r in data], ITEMS)


def test_search_in_several_blocks_of_items_and_on_empty_tables(spark, monkeypatch):
    docs, items = spark.createDataFrame(rows(2, 60), WIDE), spark.createDataFrame(ITEMS, "item_id long, text string")
    want = ranked([r[:2] for r in rows(2, 60)], ITEMS)
    monkeypatch.setattr(balltree, "TERMS_AT_ONCE", 3)
    assert {tuple(r) for r in balltree.rank(docs, items).collect()} == want
    assert balltree.rank(docs.limit(0), items).count() == 0
    assert balltree.rank(docs, items.limit(0)).count() == 0
    assert balltree.rank(docs, items.filter("item_id = 3")).columns == ["item_id", "rank", "doc_id", "score"]


def test_no_document_exceeds_the_bound_of_a_node_above_it():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n, n_terms = int(rng.integers(1, 200)), int(rng.integers(1, 60))
        sizes = rng.integers(0, 12, n)
        codes = np.concatenate([np.sort(rng.choice(n_terms, min(s, n_terms), replace=False)) for s in sizes] or [[]]).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(np.minimum(sizes, n_terms))])
        impacts = rng.integers(1, 10**6, len(codes))
        tree = balltree.BallTree(starts, codes, impacts, n_terms)
        assert sorted(tree.order) == list(range(n))
        dense = np.zeros((n, n_terms), dtype=np.int64)
        for i in range(n):
            dense[i, codes[starts[i]:starts[i + 1]]] = impacts[starts[i]:starts[i + 1]]
        terms = rng.choice(n_terms, min(5, n_terms), replace=False)
        weights = rng.integers(1, 30_000, len(terms))
        true, bound = dense[:, terms] @ weights, tree.bounds(terms, weights)

        def below(node):
            if tree.is_leaf[node]:
                first, last = tree.children[node]
                return tree.order[first:last].tolist()
            return [r for c in tree.children[node] for r in below(c)]

        for node in range(len(tree.children)):
            assert true[below(node)].max() <= bound[node]


# --- 12 divergence

def audited(data, least=3, top=200):
    docs = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))))
            for _, text, lang, source, *_ in data]
    out = set()
    for lang in {d[0] for d in docs}:
        held = Counter(t for one, _, c in docs if one == lang for t in c)
        kept = [t for t in held if held[t] >= least]
        count = defaultdict(Counter)
        for one, source, c in docs:
            if one == lang:
                count[source].update({t: c[t] for t in kept if t in c})
                count[None].update({t: c[t] for t in kept if t in c})
        share = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in count.items()}
        for s in count.keys() - {None}:
            pairs = [(-sum((share[s][t] - share[o][t])**2 // share[o][t] for t in kept), o) for o in count.keys() - {None, s}]
            out |= {(lang, s, "pair", o, -v, k) for k, (v, o) in enumerate(sorted(pairs), 1)}
            over = [(-((share[s][t] - share[None][t])**2 // share[None][t]), t.encode(), t) for t in kept
                    if count[s][t] > 0 and share[s][t] > share[None][t]]
            out |= {(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(sorted(over)[:top], 1)}
    return out


@pytest.mark.parametrize(("bits", "cells"), [(64, 1 << 21), (2, 1 << 21), (64, 7)])
def test_audit_equals_plain_python_also_when_digests_collide(spark, monkeypatch, bits, cells):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", cells)
    monkeypatch.setattr(divergence, "KNOWN_DIGESTS", 5)
    data = rows(3, 120)
    got = divergence.audit(spark.createDataFrame(data, WIDE).repartition(3), digest_bits=bits).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == audited(data)


def test_audit_cuts_at_the_top_and_takes_groups_without_terms(spark):
    data = [*rows(4, 80), (900, None, "xx", "p", *[None] * 6), (901, "!!", "xx", "q", *[None] * 6), (902, "!", "yy", "p", *[None] * 6)]
    docs = spark.createDataFrame(data, WIDE)
    assert {tuple(r) for r in divergence.audit(docs, top=2).collect()} == audited(data, top=2)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_large_shares_do_not_overflow(spark):
    big = 4 * 10**14
    df = spark.createDataFrame([(big, big + 7, 3), (0, 0, 1), (5, 5, 1)], "n long, total long, terms long")
    want = [1 + 10**9 * (n + 1) // (t + v) for n, t, v in ((big, big + 7, 3), (0, 0, 1), (5, 5, 1))]
    assert [r[0] for r in df.select(divergence._share("n", "total", "terms")).collect()] == want
    assert divergence._shares(np.array([big, 0, 5]), np.array([big + 10, 1, 6])).tolist() == want


# --- 13 token counts

SIGNS = ["a", "b", "é", "1", ".", ",", "'s", "'", "re", "'re", "'ll", "l", "ve", " ", " ", "  ", "\n", "\t", "\r\n", " ", "X", "!",
         "½", "ß", "\x1c", "\x85", "　", "日", "<|endoftext|>", "<|endof", "text|>", "\U0001f600", "é", "the", " of"]


def test_every_prefix_has_the_library_count():
    rnd = random.Random(9)
    tok, own = Tokenizer.from_file(BYTE_PATH), tokencounts.PrefixCounter(BYTE_PATH)
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 20))) for _ in range(400)]
    for t in [*texts, "y" * 300, "a" + " " * 250 + "b", "'re'r're", "x  <|endoftext|>  y"]:
        want = [len(tok.encode(t[:i], add_special_tokens=False).ids) for i in range(1, len(t) + 1)]
        assert own.prefixes(t).tolist() == want, t


def test_counts_and_budgets_without_encoding_again(spark):
    tok = Tokenizer.from_file(BYTE_PATH)
    texts = [r[1] for r in rows(5, 40)] + ["ha ha", "ha ha", "x" * 5000]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, prefixes string, n_tokens string")
    out = tokencounts.count_tokens(docs, BYTE_PATH, budgets=(0, 7, 1024), with_prefixes=True).cache()
    asked = out.withColumn("at", tokencounts.tokens_at(F.col("tokens.prefixes"), F.col("doc_id") * 3)).withColumn(
        "fit", tokencounts.longest_fit(F.col("tokens.prefixes"), F.lit(7)))
    got = asked.collect()
    assert out.columns == [*docs.columns, "tokens"] and len(got) == len(texts)
    for r in got:
        text, counts = r["text"] or "", r["tokens"]["prefixes"]
        assert r["tokens"]["n_bytes"] == len(text.encode()) and len(counts) == len(text)
        assert r["tokens"]["n_tokens"] == len(tok.encode(text, add_special_tokens=False).ids)
        assert r["at"] == len(tok.encode(text[:3 * r["doc_id"]], add_special_tokens=False).ids)
        want = [max((i for i in range(1, len(text) + 1) if counts[i - 1] <= b), default=0) for b in (0, 7, 1024)]
        assert r["tokens"]["fits"] == want and r["fit"] == want[1]
    assert tokencounts.count_tokens(docs.limit(0), BYTE_PATH).count() == 0
