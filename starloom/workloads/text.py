"""Word and letter counts over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.words import (
    letter_count,
    top_words,
    word_count,
    words,
    write_word_and_letter_counts,
)
from starloom.sinks.files import write_text
from starloom.sources.files import scan_text
from starloom.workloads.registry import query
from starloom.workloads.relations import Relations
from starloom.workspace import new_folder

_WORDS = "SELECT unnest(string_split(text, ' ')) AS word FROM documents"


@query(
    "word_count_top20",
    f"""SELECT lower(trim(word)) AS word, count(*) AS amount FROM ({_WORDS})
WHERE lower(trim(word)) <> '' GROUP BY 1 ORDER BY amount DESC, word LIMIT 20""",
)
def word_count_top20(r: Relations) -> DataFrame:
    return top_words(r.table("documents"), "text")


@query(
    "word_count",
    f"SELECT word, count(*) AS amount FROM ({_WORDS}) GROUP BY word",
)
def word_count_all(r: Relations) -> DataFrame:
    """Empty words, from repeated spaces, count as a word."""
    return word_count(r.table("documents"), "text")


@query(
    "word_count_not_empty",
    f"SELECT word, count(*) AS amount FROM ({_WORDS}) WHERE length(word) > 0 GROUP BY word",
)
def word_count_not_empty(r: Relations) -> DataFrame:
    return word_count(r.table("documents"), "text", keep_empty=False)


@query(
    "letter_count",
    f"""SELECT substring(word, 1, 1) AS letter, CAST(count(*) AS BIGINT) AS amount
FROM ({_WORDS}) WHERE length(word) > 0 GROUP BY 1""",
)
def letters(r: Relations) -> DataFrame:
    return letter_count(word_count(r.table("documents"), "text", keep_empty=False))


@query(
    "flat_map_words",
    f"""SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents""",
)
def flat_map_words(r: Relations) -> DataFrame:
    """Every word of every document, not aggregated."""
    return r.table("documents").select("doc_id", F.explode(F.split("text", " ", -1)).alias("word"))


@query(
    "map_pairs",
    f"""SELECT substring(word, 1, 1) AS letter, CAST(length(word) AS INTEGER) AS length,
       count(*) AS pairs
FROM ({_WORDS}) WHERE length(word) > 0 GROUP BY ALL""",
)
def map_pairs(r: Relations) -> DataFrame:
    pairs = words(r.table("documents"), "text", keep_empty=False).select(
        F.substring("word", 1, 1).alias("letter"), F.length("word").alias("length")
    )
    return pairs.groupBy("letter", "length").agg(F.count(F.lit(1)).alias("pairs"))


@query(
    "scan_text",
    """SELECT line, count(*) AS lines
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line""",
)
def scan_text_lines(r: Relations) -> DataFrame:
    """Documents written as text files and read back line by line."""
    folder = new_folder(r.spark, "text")
    write_text(r.table("documents").select("text"), folder)
    return (
        scan_text(r.spark, folder)
        .groupBy(F.col("value").alias("line"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )


_LINES = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"


@query(
    "word_and_letter_files",
    f"""WITH w AS (SELECT word, count(*) AS amount
           FROM (SELECT unnest(string_split(line, ' ')) AS word FROM ({_LINES}))
           WHERE length(word) > 0 GROUP BY word)
SELECT 'word' AS kind, word AS name, amount FROM w
UNION ALL
SELECT 'letter', substring(word, 1, 1), CAST(sum(amount) AS BIGINT) FROM w GROUP BY 2""",
)
def word_and_letter_files(r: Relations) -> DataFrame:
    """Words and letters of all lines: both text outputs of one count, read back."""
    lines = r.table("documents").select(F.explode(F.split("text", "\n", -1)).alias("value"))
    folders = {kind: new_folder(r.spark, kind) for kind in ("word", "letter")}
    write_word_and_letter_counts(lines, folders["word"], folders["letter"])

    def read(kind: str) -> DataFrame:
        """The count follows the last tab of a line; a word may hold tabs itself."""
        line = r"^(.*)\t(\d+)$"
        return scan_text(r.spark, folders[kind]).select(
            F.lit(kind).alias("kind"),
            F.regexp_extract("value", line, 1).alias("name"),
            F.regexp_extract("value", line, 2).cast("long").alias("amount"),
        )

    return read("word").union(read("letter"))
