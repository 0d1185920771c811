"""Registered queries of the operators and the SQL that states the same results."""

import functools

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.llm import (
    balltree,
    bpe,
    divergence,
    exactdedup,
    htmlextract,
    langid,
    lineclean,
    linechunks,
    minhash,
    packing,
    substrings,
    tokencounts,
    urlfilter,
)
from tardy.llm.common import read_table, stored

URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/"))
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_ENDS = ("example.com", "example.net", "example.org")
LISTED_HOSTS = tuple(f"{n}.{e}" for n in LISTED_NAMES for e in LISTED_ENDS)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, path).select("doc_id", "coded.*")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


PACK_CAPACITY, PACK_END_ID = 1024, 2


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Best-fit packing of ``docs``: the columns of op2."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(stored(packing.pieces(docs, path, PACK_END_ID, PACK_CAPACITY), "pieces"), PACK_CAPACITY)


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(read_table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(read_table(spark, sf_dir, "documents"))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linechunks.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def held_out() -> Column:
    """Documents that no model learns from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.learn(docs.filter(~held_out()))
    out = langid.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = exactdedup.exact_dedup(*exactdedup.split_by_age(docs))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lineclean.clean_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "lost")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = htmlextract.extract_text(read_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "repeats.n_words", "repeats.n_removed",
                      F.sha2("repeats.kept_text", 256).alias("kept_sha256"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.range(1).select(F.explode(F.array(*map(F.lit, LISTED_HOSTS))).alias("key"))
    return urlfilter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES, listed)


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


TOKEN_LIMIT = 1024


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = tokencounts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), budgets=(TOKEN_LIMIT,))
    return out.select("doc_id", "tokens.n_bytes", "tokens.n_tokens",
                      (F.col("tokens.n_tokens") > TOKEN_LIMIT).alias("over_limit"),
                      F.col("tokens.fits")[0].alias("fit_chars"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_pack": op2_pack,
    "op3_minhash": op3_minhash,
    "op4_lines": op4_lines,
    "op5_langid": op5_langid,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality": op7_quality,
    "op8_html": op8_html,
    "op9_substrings": op9_substrings,
    "op10_url_filter": op10_url_filter,
    "op11_search": op11_search,
    "op12_divergence": op12_divergence,
    "op13_token_counts": op13_token_counts,
}

_OP3_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(id, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.id, l.v FROM reach r JOIN links l ON l.u = r.other)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) c ON c.id = s.doc_id
"""

_OP4_SQL = """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
h AS (SELECT doc_id, ls, list_transform(ls, lambda x: CAST('0x' || substr(md5(x), 1, 7) AS BIGINT)) AS hs FROM l),
r AS (SELECT doc_id, ls, list_transform(range(1, len(ls) + 1),
        lambda i: (hs[i] + CASE WHEN i > 1 THEN 31 * hs[i - 1] ELSE 0 END
                         + CASE WHEN i > 2 THEN 961 * hs[i - 2] ELSE 0 END) % 4 = 0) AS cut FROM h),
s AS (SELECT doc_id, ls, list_filter(range(1, len(ls) + 1), lambda i: i = 1 OR cut[i - 1]) AS st FROM r),
c AS (SELECT doc_id, unnest(range(1, len(st) + 1)) AS k, st, ls FROM s),
p AS (SELECT doc_id, k, ls[st[k]:coalesce(st[k + 1], len(ls) + 1) - 1] AS part FROM c),
t AS (SELECT doc_id, k, len(part) AS n, array_to_string(part, chr(10)) AS chunk,
             len(list_filter(part, lambda x: trim(x) <> '')) >= 2 AS many FROM p),
m AS (SELECT *, row_number() OVER (PARTITION BY many, chunk ORDER BY doc_id, k) AS nth FROM t)
SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_lines,
       CAST(coalesce(sum(n) FILTER (WHERE many AND nth > 1), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(chunk, chr(10) ORDER BY k) FILTER (WHERE NOT (many AND nth > 1)), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_OP6_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

_OP9_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
v AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS s, ws FROM w WHERE len(ws) >= 35),
h AS (SELECT doc_id, s, array_to_string(ws[s:s + 34], ' ') AS t FROM v),
twice AS (SELECT t FROM h GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS i FROM h WHERE t IN (SELECT t FROM twice)),
g AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
k AS (SELECT w.doc_id, ws, coalesce(g.gone, []) AS gone FROM w LEFT JOIN g ON w.doc_id = g.doc_id),
x AS (SELECT k.doc_id, len(ws) AS n, len(gone) AS r,
  CASE WHEN len(gone) = 0 THEN array_to_string(ws, ' ')
       ELSE coalesce((SELECT string_agg(ws[i], ' ' ORDER BY i) FROM (SELECT unnest(range(1, len(ws) + 1)) AS i) q
                      WHERE NOT list_contains(gone, i)), '') END AS kept FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed, sha256(kept) AS kept_sha256 FROM x
"""


def _fits_sql(rule: str) -> str:
    host, prefix = rule.split("/", 1)
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{prefix}'))"


def _op10_sql() -> str:
    rules = sorted(URL_RULES, key=lambda r: (-len(r[1]), r[1]))
    name = " ".join(f"WHEN {_fits_sql(r)} THEN '{r}'" for _, r in rules)
    verdict = " ".join(f"WHEN rule = '{r}' THEN '{v}'" for v, r in rules)
    listed = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in LISTED_HOSTS)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT page_id, host, path, CASE {name} ELSE NULL END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE {verdict} WHEN {listed} THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP11_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
q AS (
  SELECT item_id, term, count(*) AS k FROM (
    SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term),
s AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_all FROM d),
e AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM e GROUP BY term), s),
f AS (
  SELECT r, doc_id, e.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_all))) AS part
  FROM e JOIN w ON e.term = w.term, s),
h AS (
  SELECT item_id, r, doc_id, CAST(sum(k * part) AS BIGINT) AS score FROM f JOIN q ON f.term = q.term GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM h WHERE score > 0)
WHERE rank <= 10
"""

_OP12_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWERED}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
e AS (SELECT r, lang, source, term, count(*) AS tf FROM (SELECT r, lang, source, unnest(ts) AS term FROM d)
      GROUP BY r, lang, source, term),
kept AS (SELECT lang, term, CAST(sum(tf) AS BIGINT) AS n FROM e GROUP BY lang, term HAVING count(*) >= 3),
c AS (SELECT e.lang, e.source, e.term, CAST(sum(tf) AS BIGINT) AS n FROM e JOIN kept k ON k.lang = e.lang AND k.term = e.term
      GROUP BY e.lang, e.source, e.term),
l AS (SELECT g.lang, count(k.term) AS v, CAST(coalesce(sum(k.n), 0) AS BIGINT) AS total
      FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang),
g AS (SELECT s.lang, s.source, CAST(coalesce(sum(c.n), 0) AS BIGINT) AS total
      FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN c ON c.lang = s.lang AND c.source = s.source GROUP BY s.lang, s.source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n,
         1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p, 1 + (1000000000 * (k.n + 1)) // (l.total + l.v) AS lang_p
  FROM g JOIN l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
every AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL
  SELECT lang, source, 'term', term, (p - lang_p) * (p - lang_p) // lang_p FROM p WHERE n > 0 AND p > lang_p),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@functools.cache
def oracle_sql() -> dict[str, str]:
    return {"op3_minhash": _OP3_SQL, "op4_lines": _OP4_SQL, "op6_exact_dedup": _OP6_SQL, "op9_substrings": _OP9_SQL, "op10_url_filter": _op10_sql(),
            "op11_search": _OP11_SQL, "op12_divergence": _OP12_SQL}
