"""URL filter by a Bloom filter cascade, in DataFrame functions only.

Method: the corpus's own keys (every host and each of its parent domains) are a complete, known
universe. Level 1 is a Bloom filter of the listed keys; level 2 holds the unlisted keys of the
universe that level 1 lets through by mistake; level 3 the listed keys that level 2 lets through;
and so on until a level has no mistakes left. For any key of that universe the answer is exact,
and a url is judged by bit tests on constants: no join with the list.

Size: level 1 holds at most the listed keys and its rate is set so that few unlisted keys pass;
each later level holds about half of the level two before it. The bit arrays (which go through
the driver as constants) are bounded by the list, not by the corpus.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64                     # bits of one array element
MAX_LEVELS = 64


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to / ? # with A-Z lowered, path up to ? or #.

    A null url, or one without ``://``, has an empty host and an empty path.
    """
    col = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(col, "://")
    rest = F.when(at > 0, F.substr(col, at + F.lit(3))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + F.lit(1)), "^[^?#]*", 0)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, path


def domain_keys(host: Column) -> Column:
    """The host and each parent domain, longest first; none for an empty host."""
    parts = F.split(host, "[.]")
    n = F.size(parts)
    keys = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


def _bits_and_hashes(n: int, rate: float) -> tuple[int, int]:
    bits = max(WORD, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    return -(-bits // WORD) * WORD, max(1, round(-math.log2(rate)))


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def _build(keys: DataFrame, level: int, n: int, rate: float) -> tuple[int, int, list[int]]:
    """Bits of a Bloom filter over ``keys``, aggregated per 64-bit word on the executors."""
    bits, hashes = _bits_and_hashes(n, rate)
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits, hashes))).alias("at"))
    words = (at.select(F.expr(f"cast(at div {WORD} as int)").alias("word"),
                       F.expr(f"shiftleft(1L, cast(at % {WORD} as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect())
    table = [0] * (bits // WORD)
    for r in words:
        table[r["word"]] = r["bits"]
    return bits, hashes, table


def _test(key: Column, level: int, built) -> Column:
    bits, hashes, table = built
    words = F.array(*[F.lit(w).cast("long") for w in table])
    out = F.lit(True)
    for at in _positions(key, level, bits, hashes):
        word = F.element_at(words, F.floor(at / F.lit(WORD)).cast("int") + 1)
        out = out & (F.getbit(word, F.pmod(at, F.lit(WORD)).cast("int")) == 1)
    return out


class Cascade:
    """A built cascade; ``member(key)`` is exact for every key of the universe it was built on."""

    def __init__(self, levels):
        self.levels = levels

    def member(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)       # passing every level: listed after an odd one
        for number in range(len(self.levels), 0, -1):
            out = F.when(_test(key, number, self.levels[number - 1]), out).otherwise(F.lit(number % 2 == 0))
        return out

    @property
    def n_bits(self) -> int:
        return sum(bits for bits, _, _ in self.levels)


def build_cascade(universe: DataFrame, listed: DataFrame) -> Cascade:
    """Cascade for ``listed`` (key) over the complete key set ``universe`` (key).

    Listed keys outside the universe are never asked for and not encoded. Null keys are ignored.
    """
    keys = universe.filter("key is not null").distinct()
    marked = keys.join(listed.filter("key is not null").distinct().withColumn("on", F.lit(True)), "key", "left")
    marked = marked.select("key", F.coalesce("on", F.lit(False)).alias("on")).checkpoint()
    inside, outside = marked.filter("on").select("key"), marked.filter("not on").select("key")
    n, other = inside.count(), outside.count()
    levels = []
    while n and len(levels) < MAX_LEVELS:
        level = len(levels) + 1
        rate = max(1e-4, min(0.5, n / max(1, other) * math.sqrt(0.5))) if level == 1 else 0.5
        levels.append(_build(inside, level, n, rate))
        # the next level holds what this one lets through by mistake
        inside, outside = outside.filter(_test(F.col("key"), level, levels[-1])), inside
        other, n = n, inside.count()
    if n:
        raise RuntimeError("the cascade did not close")
    return Cascade(levels)


def rule_name(rules, host: Column, path: Column) -> Column:
    """The longest rule ``(verdict, 'host/path')`` that fits, or null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):     # later, longer rules win
        out = F.when(_fits(rule, host, path), F.lit(rule)).otherwise(out)
    return out


def _fits(rule: str, host: Column, path: Column) -> Column:
    at = rule.index("/")
    name, prefix = rule[:at], rule[at:]
    return ((host == name) | host.endswith("." + name)) & path.startswith(prefix)


def judge_urls(pages: DataFrame, rules, listed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block).

    The longest fitting rule decides; without one, a url is blocked when its host or a parent
    domain is a listed key. Null and malformed urls have no host, fit no rule and are allowed.
    Repeated rows are judged alike; only the id and url columns are read.
    """
    host, path = url_parts(url_col)
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    hosts = parts.select("host").distinct()
    cascade = build_cascade(hosts.select(F.explode(domain_keys(F.col("host"))).alias("key")), listed)
    on_list = F.exists(domain_keys(F.col("host")), cascade.member)
    rule = rule_name(rules, F.col("host"), F.col("path"))
    verdicts = F.create_map(*[F.lit(x) for verdict, name in rules for x in (name, verdict)]) if rules else None
    by_list = F.when(on_list, F.lit("block")).otherwise(F.lit("allow"))
    verdict = by_list if verdicts is None else F.coalesce(F.try_element_at(verdicts, F.col("rule")), by_list)
    return parts.withColumn("rule", rule).withColumn("verdict", verdict)
