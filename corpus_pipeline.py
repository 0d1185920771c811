"""The corpus pipeline: five stages over ``documents``, each one operator over all that is left.

Each stage's result is written as Parquet under the shared checkpoint folder and read again as
the next stage's documents, so a lost executor costs its running tasks and never a whole stage.
All but the last stage return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.llm import exactdedup, langid, minhash, queries, substrings
from tardy.llm.common import by_shuffle, read_table, stored, text_or_empty

# language ID and packing cannot be stated in SQL; tests hold run() against brute force
ORACLE_SQL = None


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go; text of several languages stays.

    Raises ValueError where there are letters but no labelled document to learn a language from.
    """
    model = langid.learn(docs.filter(~queries.held_out()))
    if not model.langs and docs.filter(text_or_empty().rlike(r"\p{L}")).head(1):
        raise ValueError("language_id: documents with letters, but none to learn a language from (lang is null)")
    known = langid.identify(docs, model, out_col="__language")
    return known.filter(F.col("__language.lang_pred") != langid.UNKNOWN).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, that with the largest doc_id.

    Rows that repeat an id and its text, or copies that all lack an id, are told apart by nothing but
    their place: one of them stays. Null text counts as empty.
    """
    decided = exactdedup.exact_dedup(*exactdedup.split_by_age(docs))
    stay = stored(decided.filter("kept").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("__rows")), "pipeline-stay")
    key = F.struct(F.col("doc_id"), F.unhex(F.sha2(text_or_empty(), 256)).alias("digest"))
    marked = docs.withColumn("__key", key)

    def among(some: DataFrame) -> DataFrame:
        return marked.join(by_shuffle(some.select(F.struct("doc_id", "digest").alias("__stay"))),
                           F.col("__key") == F.col("__stay"), "left_semi")

    if not stay.filter("__rows > 1").head(1):
        return among(stay).select(*docs.columns)
    once = among(stay.filter("__rows > 1")).dropDuplicates(["__key"])         # combined in each task first
    return among(stay.filter("__rows = 1")).unionByName(once).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays.

    Rows without a doc_id are linked with nothing and stay; the stage before has left one row of each text.
    """
    gone = minhash.near_dedup(docs).filter("doc_id is not null and not kept").select("doc_id").distinct()
    return docs.join(by_shuffle(gone), "doc_id", "left_anti").select(*docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under repeated 35-word windows go; a document that loses every word goes too."""
    out = substrings.remove_repeats(docs, out_col="__repeats")
    changed = F.col("__repeats.n_removed") > 0
    out = out.filter("not (__repeats.n_removed > 0 and __repeats.n_removed = __repeats.n_words)")
    kinds = dict(docs.dtypes)
    return out.withColumns({
        "text": F.when(changed, F.col("__repeats.kept_text")).otherwise(F.col("text")),
        "n_chars": F.when(changed, F.char_length("__repeats.kept_text")).otherwise(F.col("n_chars")).cast(kinds["n_chars"]),
    }).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 1024 tokens: one row per piece."""
    return queries.packed_pieces(docs)


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", remove_repeated_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
