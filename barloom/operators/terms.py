"""Words of articles: counts, association, keyword search."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barloom.operators.sets import union_all
from barloom.session import work_folder

_LETTERS = r"\p{L}+"
# The first group is what counts as a word: at a Han sign the pair it starts, or the sign
# itself where it stands alone; else a run of other letters.
_PAIRS = (
    r"(?=(\p{IsHan}{2}|(?<!\p{IsHan})\p{IsHan}(?!\p{IsHan})|[\p{L}&&[^\p{IsHan}]]+))"
    r"(?:\p{IsHan}|[\p{L}&&[^\p{IsHan}]]+)"
)
# code points among which all Han signs are; testing a plain range is far cheaper than
# testing the script, and most texts need no more than that
_MAY_BE_HAN = r"[\x{2E80}-\x{FAFF}\x{16FE0}-\x{3FFFF}]"


def token_array(text: Column) -> Column:
    """Lower-case words in order. Han text has no spaces: its runs become the
    overlapping pairs of signs, a single sign stays as it is."""
    lower = F.lower(text)
    with_han = F.regexp_extract_all(lower, F.lit(_PAIRS), F.lit(1))
    plain = F.regexp_extract_all(lower, F.lit(_LETTERS), F.lit(0))
    return F.when(text.rlike(_MAY_BE_HAN), with_han).otherwise(plain)


# Words become rows by the outer forms of explode: for the plain ones Spark first filters
# on the size of the array and so would split every text once more.


def tokens(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word with its place in the text, from 0."""
    words = F.posexplode_outer(token_array(F.col(text))).alias("pos", "term")
    return docs.select(key, words).where("term IS NOT NULL")


def term_freq(docs: DataFrame, k: int, text: str = "text") -> DataFrame:
    """The ``k`` most frequent words of all texts."""
    words = docs.select(F.explode_outer(token_array(F.col(text))).alias("term"))
    counts = words.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("term_count"))
    return counts.orderBy(F.desc("term_count"), "term").limit(k)


SUMMARY_TERMS = 50_000
MOST_SUMMARY_TERMS = 2_000_000
SENT_TERMS = 200_000


def _summaries(capacity: int):
    """Counts of a task's most frequent words, each too low by at most an error that comes without a word.

    Beyond ``capacity`` words the count of the first word too many is taken off all, and words
    with nothing left go, so a word that is not listed occurs no more often than the error.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pd.Series = pd.Series(dtype="int64")
        error = 0
        for batch in batches:
            found = batch.column("words").flatten().value_counts()
            new = pd.Series(found.field("counts").to_numpy(), found.field("values").to_pylist(), dtype="int64")
            held = held.add(new, fill_value=0).astype("int64")
            if len(held) > capacity:
                off = int(np.partition(held.to_numpy(), len(held) - capacity - 1)[len(held) - capacity - 1])
                error += off
                held = held[held > off] - off
        terms, counts = [None, *held.index], [error, *held.to_numpy()]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(counts, pa.int64())], ["term", "n"])

    return summed


def top_terms(docs: DataFrame, k: int, text: str = "text", capacity: int = SUMMARY_TERMS) -> DataFrame:
    """:func:`term_freq` without a shuffle of all distinct words.

    Every task sums up its words in ``capacity`` counts (Misra and Gries), which are added up:
    a word occurs as often as that at least, and at most the sum of all errors more. Words
    whose greatest possible count reaches the k-th best least one are counted exactly in a second
    pass. If words that no task lists might reach it, summaries four times as large are
    made; and if those grow beyond ``MOST_SUMMARY_TERMS``, or the words that might be among the
    best are too many to send, all words are counted.
    """
    spark = docs.sparkSession
    words = docs.select(token_array(F.col(text)).alias("words"))
    while capacity <= MOST_SUMMARY_TERMS:
        path = work_folder(spark, "summaries")
        words.mapInArrow(_summaries(capacity), "term string, n long").write.parquet(path)
        summaries = spark.read.parquet(path)
        error = summaries.where("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        least = summaries.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n"))
        best = least.orderBy(F.desc("n")).limit(k).agg(F.min("n"), F.count("*")).first()
        if not error:  # all counts are exact
            return least.select("term", F.col("n").alias("term_count")).orderBy(F.desc("term_count"), "term").limit(k)
        if best[1] == k and best[0] > error:
            break
        capacity *= 4
    else:
        return term_freq(docs, k, text)
    hopeful = least.where(F.col("n") + error >= best[0]).select("term")
    if hopeful.count() > SENT_TERMS:
        return term_freq(docs, k, text)
    found = words.select(F.explode_outer("words").alias("term")).join(F.broadcast(hopeful), "term", "left_semi")
    counts = found.groupBy("term").agg(F.count("*").alias("term_count"))
    return counts.orderBy(F.desc("term_count"), "term").limit(k)


_ALL_TEXTS = ""  # stands beside the words of every text; no word is empty


def term_assoc(docs: DataFrame, term: str, min_support: int = 1, text: str = "text") -> DataFrame:
    """How strongly other words go with ``term``: phi coefficient over texts.

    Each text is reduced to its distinct words and the mark whether it holds the
    term, so pairs are counted by one grouping and no join of words with words. An
    extra word present in every text brings the totals along in the same grouping.
    """
    term = term.lower()
    words = docs.select(F.array_distinct(token_array(F.col(text))).alias("words"))
    # the mark once per text, before its words become rows
    texts = words.select(
        F.array_contains("words", term).cast("bigint").alias("has"),
        F.array_append(F.array_remove("words", term), F.lit(_ALL_TEXTS)).alias("others"),
    )
    marked = texts.select("has", F.explode_outer("others").alias("term")).where("term IS NOT NULL")
    counts = marked.groupBy("term").agg(
        F.count("*").alias("doc_count"),
        F.sum("has").alias("both_count"),
        F.max(F.col("term") == _ALL_TEXTS).alias("_total"),
    )
    totals = counts.agg(F.max(F.when(F.col("_total"), F.struct("doc_count", "both_count"))).alias("t"))
    joined = counts.where(~F.col("_total") & (F.col("both_count") >= min_support)).withColumn(
        "_t", totals.scalar()
    )
    n, k = F.col("_t.doc_count").cast("double"), F.col("_t.both_count").cast("double")
    t, both = F.col("doc_count").cast("double"), F.col("both_count").cast("double")
    phi = F.try_divide(n * both - k * t, F.sqrt(k * (n - k)) * F.sqrt(t * (n - t)))
    return joined.select("term", "doc_count", "both_count", phi.alias("phi"))


def keyword_range(
    docs: DataFrame,
    word: str,
    first_page: int,
    last_page: int,
    page_size: int = 20,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Texts that hold a keyword, pages ``first_page`` to ``last_page`` (from 1) by key."""
    matches = docs.where(F.contains(F.col(text), F.lit(word)))
    skipped = (first_page - 1) * page_size
    wanted = (last_page - first_page + 1) * page_size
    return matches.orderBy(key).offset(skipped).limit(wanted)


def merge_feeds(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Articles of several sites in one table, each with its site."""
    return union_all([frame.withColumn("site", F.lit(site)) for site, frame in feeds.items()])
