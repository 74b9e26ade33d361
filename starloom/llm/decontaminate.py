"""Benchmark passages in training texts by spaced seeds, with DataFrame functions only.

A text is its runs of letters and digits, in lower case. A mask such as 1101011 is laid at every
word; the words under its ones make a hash, the others are ignored, so a substituted word under a
zero does no harm. Hashes of the training texts meet those of the benchmark in a join. A hit gives
a diagonal (place in the text less place in the item); along each diagonal the words are compared
one by one. An item is leaked if the aligned words are ``threshold`` of the item, or if the best
stretch of the diagonal, with a match counting 1 and a substitution -3, has ``min_words`` matches.

Null and empty texts contain nothing. Items of less than five words are too short to tell a leak
from chance and match nothing. Rows that repeat a doc_id count as one document; a null doc_id is a
document too. Repeated items each have their own rows. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import query, stored, table, texts

#: No spacing against short items, and spacings that step over every fifth and every third word.
#: A mask begins with two ones.
MASKS = ("11111", "1111011", "1101101011")
#: Bytes up to which a side is broadcast; larger ones are shuffled.
BROADCAST_BYTES = 32 << 20


def _checked_broadcast(df: DataFrame, row_bytes: str = "64") -> DataFrame:
    """``df``, which must be stored or cheap, marked for broadcasting if its rows, each of ``row_bytes`` in
    memory, are small together. Seeds and candidates have rows of a few numbers."""
    size = df.agg(F.expr(f"coalesce(sum(cast({row_bytes} as bigint)), 0)")).first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))


def _laid(number: int, mask: str) -> str:
    """The seeds of a mask at all words, built from hashes of neighbouring words in ``pairs`` and
    of single ones. Arrays are zipped, since reading them by index costs several times as much; what
    the zips make of the missing words behind the last place is cut off."""
    parts, at = [], 0
    while at < len(mask):
        pair = mask[at : at + 2] == "11"
        if pair or mask[at] == "1":
            parts.append(("pairs" if pair else "hashed_words", at))
        at += 1 + pair
    made = parts[0][0]
    for column, offset in parts[1:]:
        later = f"slice({column}, {offset + 1}, size(hashed_words))"
        made = f"zip_with({made}, {later}, (a, b) -> xxhash64(a, b, {number}))"
    return f"slice({made}, 1, greatest(0, size(hashed_words) - {len(mask) - 1}))"


def seeds(df: DataFrame, ident: str) -> DataFrame:
    """ident, seed, and ``at`` and ``size`` that tell its place: a row per mask and word of ``text``
    at which the mask fits, mask by mask."""
    hashed = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    laid = ", ".join(_laid(number, mask) for number, mask in enumerate(MASKS))
    following = "slice(hashed_words, 2, size(hashed_words))"
    return (
        df.select(ident, hashed.alias("hashed_words"))
        .withColumn(
            "pairs",
            F.expr(f"zip_with(hashed_words, {following}, (a, b) -> xxhash64(a, b))"),
        )
        # The outer form keeps the optimizer from computing all seeds again in a filter.
        .select(
            ident,
            F.size("hashed_words").alias("size"),
            F.posexplode_outer(F.expr(f"concat({laid})")).alias("at", "seed"),
        )
        .where("seed is not null")
    )


def _place() -> Column:
    """The word at which the mask of a seed was laid: masks follow each other in ``at``."""
    place, before = "", "0"
    for mask in MASKS:
        after = f"{before} + greatest(0, size - {len(mask) - 1})"
        place += f" WHEN at < {after} THEN at - ({before})"
        before = after
    return F.expr(f"CASE{place} END")


def _best_stretch() -> Column:
    """Over ``same`` (array of booleans): the matches of the stretch with the best score."""
    step = "if(x, 1, -3)"
    return F.expr(
        "aggregate(same, named_struct('score', 0, 'matches', 0, 'top', 0, 'found', 0), (a, x) -> "
        f"named_struct('score', greatest(a.score, 0) + {step}, "
        "'matches', if(a.score <= 0, 0, a.matches) + int(x), "
        f"'top', greatest(a.top, greatest(a.score, 0) + {step}), "
        f"'found', if(greatest(a.score, 0) + {step} > a.top, "
        "if(a.score <= 0, 0, a.matches) + int(x), a.found)), a -> a.found)"
    )


def leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, min_words: int = 13
) -> DataFrame:
    """doc_id, item_id, matched (aligned words alike), item_words, stretch (matches of the best
    stretch) and similarity (matched / item_words) of every leaked item; the best diagonal counts."""
    items = texts(benchmark.select(F.col("item_id").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("item_id"), "text"
    )
    item_seeds = stored(
        seeds(items, "item_id").select("item_id", "seed", _place().alias("item_at")), "item-seeds"
    )
    candidates = stored(
        seeds(texts(docs), "doc_id")
        .join(_checked_broadcast(item_seeds), "seed")
        .withColumn("doc_at", _place())
        .select(
            F.col("doc_id").alias("hit_id"),
            "item_id",
            (F.col("doc_at") - F.col("item_at")).alias("diagonal"),
        )
        .distinct(),
        "leak-candidates",
    )
    item_words = stored(items.withColumn("item", words(F.col("text"))).drop("text"), "items")
    in_memory = "aggregate(item, 64L, (a, w) -> a + octet_length(w) + 24)"
    hit = _checked_broadcast(candidates.select(F.col("hit_id").alias("known_id")).distinct())
    compared = (
        texts(docs)
        .join(hit, F.col("doc_id").eqNullSafe(F.col("known_id")), "left_semi")
        # Here, so that a text is cut into words once and not for each of its candidates.
        .select("doc_id", words(F.col("text")).alias("words"))
        .join(_checked_broadcast(candidates), F.col("doc_id").eqNullSafe(F.col("hit_id")))
        .join(
            _checked_broadcast(item_words, in_memory).withColumnRenamed("item_id", "own_id"),
            F.col("item_id").eqNullSafe(F.col("own_id")),
        )
        .withColumn(
            "same",
            F.expr(
                "if(least(size(item), size(words) - diagonal) > greatest(0, -diagonal), "
                "transform(sequence(greatest(0, -diagonal), "
                "least(size(item), size(words) - diagonal) - 1), "
                "j -> words[j + diagonal] = item[j]), array(false))"
            ),
        )
        .select(
            "doc_id",
            "item_id",
            F.size("item").alias("item_words"),
            F.size(F.filter("same", lambda x: x)).alias("matched"),
            _best_stretch().alias("stretch"),
        )
    )
    return (
        compared.groupBy("doc_id", "item_id", "item_words")
        .agg(F.max("matched").alias("matched"), F.max("stretch").alias("stretch"))
        .withColumn("similarity", F.col("matched") / F.col("item_words"))
        .where((F.col("similarity") >= threshold) | (F.col("stretch") >= min_words))
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leaked item, with all their columns."""
    leaked = leaks(docs, benchmark).select(F.col("doc_id").alias("leaked_id")).distinct()
    return docs.join(leaked, docs["doc_id"].eqNullSafe(leaked["leaked_id"]), "left_anti")


@query("op5_decontamination")
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
