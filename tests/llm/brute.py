"""Plain Python statements of what the operators must give, for small inputs."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    ws = words(lowered)
    if not ws:
        return set()
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)}


def joined(ids, links):
    """id -> smallest id reachable over the links."""
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for u, v in links:
            least = min(low[u], low[v])
            changed |= low[u] != least or low[v] != least
            low[u] = low[v] = least
    return low


def near_components(texts):
    """id -> smallest id reachable over pairs with a similarity of 0.75 or more."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}


def without_repeats(texts, window=35):
    """list of texts -> list of kept word lists."""
    starts = Counter(tuple(ws[i:i + window]) for ws in map(words, texts) for i in range(len(ws) - window + 1))
    out = []
    for ws in map(words, texts):
        gone = set()
        for i in range(len(ws) - window + 1):
            if starts[tuple(ws[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append([w for i, w in enumerate(ws) if i not in gone])
    return out


def best_fit_sequences(lengths, capacity):
    """Number of sequences of best-fit decreasing, one piece at a time."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            best = min(fits)
            gaps.remove(best)
            gaps.append(best - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def line_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    ws = words(text)
    lines = (text or "").split("\n")
    dup = sum(1 for i, line in enumerate(lines) if words(line) and line in lines[:i])
    at = defaultdict(list)
    for i in range(len(ws) - 2):
        at[tuple(ws[i:i + 3])].append(i)
    covered = {i + d for where in at.values() if len(where) > 1 for i in where for d in range(3)}
    return (len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered))


def check_packing(rows, texts, capacity):
    """Every piece of every text once, in gapless sequences; returns their number."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == texts.keys()
    for i, parts in by_doc.items():
        ids = np.array([*tok.encode(texts[i] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        assert len(parts) == -(-len(ids) // capacity)
        for k, p in enumerate(sorted(parts, key=lambda p: p["piece"])):
            assert (p["piece"], p["start"]) == (k, at)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    return len(by_seq)
