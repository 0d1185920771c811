"""Line-first cleaning: rules per line, then a verdict on what the document lost.

Method: every line is judged by punctuation, navigation and boilerplate rules; failing lines are
removed; a document that loses too much of its text is rejected. A base check on the whole text
(word count, repeated words) comes first.

Line rules (a line without a word is neither kept nor counted):
* symbols: more than ``MAX_SYMBOLS`` of ``[#*$%&|<>]`` per word;
* shouting: at least ``SHOUT_WORDS`` words, nearly all letters upper case;
* bangs: more than ``MAX_BANGS`` of the words end in ``!`` or ``?``;
* navigation: at least ``NAV_PARTS`` parts between ``|`` or similar separators with few words each;
* boilerplate: the line states a licence, cookie, copyright or sign-up notice, and is short (at most
  ``SHORT_CHARS`` word characters) or made up of such phrases to ``PHRASE_SHARE``;
* repeated: the line is an exact copy of an earlier line of the document.

All rules look at one line at a time and at counts of the whole document, so a clean text is left
alone however short its lines are.
"""

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.llm.common import bounded_batches

MIN_WORDS = 50
MAX_SYMBOLS = 0.25                # symbols per word of a line
SHOUT_WORDS, SHOUT_SHARE = 3, 0.9
MAX_BANGS = 0.5
NAV_PARTS, NAV_WORDS = 4, 2.5
SHORT_CHARS, PHRASE_SHARE = 120, 0.2
MAX_LOST = 0.5                    # share of a document's word characters that may go

# Phrases that mark boilerplate lines, lower case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "use cookies", "accept cookies", "subscribe to our newsletter", "sign up for",
    "log in to", "click here", "share this", "powered by", "enable javascript", "lorem ipsum",
)
_BOILERPLATE = regex.compile("|".join(map(regex.escape, BOILERPLATE)))
_SYMBOLS = frozenset("#*$%&|<>")
_PARTS = regex.compile(r"[|»›•·]").split
_UPPER, _LOWER = regex.compile(r"\p{Lu}").findall, regex.compile(r"\p{Ll}").findall

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, lost double, clean_text string")


def line_fails(line: str, words: list[str]) -> bool:
    """Do the rules reject a line with these words?"""
    n = len(words)
    if sum(map(line.count, _SYMBOLS)) > MAX_SYMBOLS * n + 1:
        return True
    if sum(w[-1] in "!?" for w in words) > MAX_BANGS * n and n >= SHOUT_WORDS:
        return True
    if n >= SHOUT_WORDS and not line.islower():
        upper, lower = len(_UPPER(line)), len(_LOWER(line))
        if upper > 1 and upper >= SHOUT_SHARE * (upper + lower):
            return True
    parts = _PARTS(line)
    if len(parts) >= NAV_PARTS and n <= NAV_WORDS * len(parts):
        return True
    phrases = sum(map(len, _BOILERPLATE.findall(line.lower())))
    size = sum(map(len, words)) if phrases else 0
    return phrases > 0 and (size <= SHORT_CHARS or phrases >= PHRASE_SHARE * size)


def repeat_words(words: list) -> int:
    """Words inside a 3-word window that the text holds twice or more (every copy counts)."""
    n = len(words)
    if n < 4:
        return 0
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    # pairs are renumbered first, so the key of three words stays exact for any vocabulary
    _, pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, which, count = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[which] > 1)
    covered = np.zeros(n, dtype=bool)
    for d in range(3):
        covered[at + d] = True
    return int(covered.sum())


def clean(text: str) -> tuple:
    """Counts, verdict and cleaned text of one document."""
    lines, seen, kept = text.split("\n"), set(), []
    n_words = chars = dup = kept_chars = 0
    every: list[bytes] = []
    for line in lines:
        words = line.encode().split()                 # exactly space and 0x09-0x0D
        if not words:
            continue
        every += words
        size = len(b"".join(words).decode())
        n_words += len(words)
        chars += size
        again = line in seen
        dup += again
        seen.add(line)
        if not again and not line_fails(line, [w.decode() for w in words]):
            kept.append(line)
            kept_chars += size
    repeated = repeat_words(every)
    failed = n_words < MIN_WORDS or 100 * repeated > 50 * n_words
    lost = 1 - kept_chars / chars if chars else 0.0
    symbols = sum(map(text.count, _SYMBOLS))
    return n_words, chars, symbols, dup, repeated, failed, not failed and lost <= MAX_LOST, lost, "\n".join(kept)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, base_failed, kept, lost (share of characters) and clean_text.

    Null and empty texts have no words and fail the base check. Every whole text is read once, in
    its own row: nothing is shuffled. Only the id and text columns are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f.strip().split(" ") for f in SCHEMA.split(",")]
        kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}
        for batch in batches:
            for low, high in pairwise([*range(0, batch.num_rows, 500), batch.num_rows]):
                texts = batch.column(1).slice(low, high - low)
                cols = list(zip(*(clean(t.as_py() or "") for t in texts), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low),
                     *(pa.array(c, kinds[kind]) for c, (_, kind) in zip(cols, fields[1:], strict=True))],
                    names=[name for name, _ in fields])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
