"""Word and letter counts. Words are what lies between single spaces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.sinks.files import write_text


def words(text: DataFrame, column: str = "value", keep_empty: bool = True) -> DataFrame:
    """One row per word in the column ``word``; two spaces in a row enclose an empty word."""
    split = text.select(F.explode(F.split(F.col(column), " ", -1)).alias("word"))
    return split if keep_empty else split.where(F.length("word") > 0)


def word_count(text: DataFrame, column: str = "value", keep_empty: bool = True) -> DataFrame:
    """Case-sensitive counts. Each task sums its own words before the shuffle."""
    return words(text, column, keep_empty).groupBy("word").agg(F.count(F.lit(1)).alias("amount"))


def top_words(text: DataFrame, column: str = "value", limit: int = 20) -> DataFrame:
    """The most frequent words regardless of case; equal counts in the order of the words.

    Lines are folded as a whole, which costs less than folding word by word. What lies
    between spaces has none to trim.
    """
    lowered = text.select(F.lower(column).alias("value"))
    return (
        words(lowered, keep_empty=False)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("amount"))
        .orderBy(F.desc("amount"), "word")
        .limit(limit)
    )


def letter_count(counts: DataFrame) -> DataFrame:
    """Words per first character, summed up from word counts."""
    return (
        counts.where(F.length("word") > 0)
        .groupBy(F.substring("word", 1, 1).alias("letter"))
        .agg(F.sum("amount").alias("amount"))
    )


def write_word_and_letter_counts(
    text: DataFrame, words_path: str, letters_path: str, column: str = "value"
) -> None:
    """Both outputs from one count, which is kept between the two writes."""
    counts = word_count(text, column, keep_empty=False).persist()
    try:
        write_text(counts, words_path)
        write_text(letter_count(counts), letters_path)
    finally:
        counts.unpersist()
