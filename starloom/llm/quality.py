"""Quality of documents by an interpolated modified Kneser-Ney model of trusted text.

The model is of five symbols. A symbol is a character; digits count as one, and code points from
2,048 on share 2,048 hashed symbols, so that five symbols are one number of 60 bits. Each task
reduces its texts to distinct grams with their counts in trusted texts; summed up, these are all
grams of the corpus. The probabilities of all of them follow order by order from joins of counts,
continuation counts and context totals, from trusted texts only. The table of probabilities,
which grows with the corpus, is cut into shards of at most ``shard_entries`` grams; each shard is
broadcast, which its size bounds, and looked up by all texts; the sums over the shards give each
document's perplexity. No text is shuffled.

Trusted texts are those labelled good. By the CRC of the id they are in five folds; a model counts
all folds but one, and each trusted text is scored by the model that leaves out its own, so all of them
are judges. Other texts are scored by the model without the first fold. Short texts vary more: the
spread of the logarithm around the median of its language is the root of a + b / characters, fitted
on all judges, and a score is the distance from the median in such spreads. The quantile of a language's
scores, and that of a normal distribution at least, plus half of it as a margin, is the language's
limit. The rule is the same for many judges and few. A language without trusted texts has no
threshold: nothing can be told of it, and its texts are kept.

Null and empty texts have no perplexity and are rejected, for they hold nothing. A null language
is a language. Without trusted texts nothing can be told and everything else is kept. Rows that
repeat doc_id, language and text are one row of the result; a null doc_id stays null. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import query, stored, table, texts
from starloom.llm.hashing import column_bytes

ORDER, SYMBOL_BITS = 5, 12
FOLDS = 5
#: Above the bits of a gram: its fold, FOLDS for texts that are not trusted.
FOLD_BITS = ORDER * SYMBOL_BITS
_LOW = 1 << (SYMBOL_BITS - 1)
#: Characters of texts that are worked on at once; a longer text is a slice by itself.
SLICE = 1 << 17
#: Distinct grams that a task holds before it merges them, and after which it gives them out.
HELD, FULL = 1_000_000, 700_000
#: Rows up to which labels are broadcast; more are shuffled.
BROADCAST_ROWS = 1_000_000


def _mask(order: int) -> int:
    return (1 << (SYMBOL_BITS * order)) - 1


def grams(bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each character of each text, and where each text begins (and the last
    one ends). Places before a text are symbol 0."""
    sizes = np.array([len(body) for body in bodies], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    codes = np.frombuffer("".join(bodies).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.int64)
    symbols = np.where(codes < _LOW, np.maximum(codes, 1), _LOW + codes * 40_503 % _LOW)
    symbols[(codes >= 48) & (codes < 58)] = 48
    place = np.arange(len(codes)) - np.repeat(begins[:-1], sizes)
    found = symbols.copy()
    for back in range(1, ORDER):
        earlier = np.zeros_like(symbols)
        earlier[back:] = symbols[:-back]
        earlier[place < back] = 0
        found |= earlier << (SYMBOL_BITS * back)
    return found, begins


def _slices(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Ranges of rows with about SLICE bytes of text, and their texts."""
    _, offsets = column_bytes(column)
    first, last = 0, len(column)
    while first < last:
        end = int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1
        end = min(last, max(end, first + 1))
        yield first, end, column.slice(first, end - first).to_pylist()
        first = end


def corpus_grams(rows: DataFrame) -> DataFrame:
    """gram and count: all grams of ``rows`` (text, trusted), counted where trusted. If there is a
    column fold as well, it is the bits above the gram."""
    folded = "fold" in rows.columns

    def made(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(column) for column in zip(*parts))
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first], np.add.reduceat(counts, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def emitted() -> Iterator[pa.RecordBatch]:
            if parts:
                keys, counts = made(parts)
                parts.clear()
                yield pa.RecordBatch.from_pydict({"gram": keys, "count": counts})

        for batch in batches:
            marks = np.array(batch.column("trusted").to_pylist(), bool)
            folds = np.zeros(batch.num_rows, np.int64)
            if folded:
                folds = np.array(batch.column("fold").to_pylist(), np.int64) << FOLD_BITS
            for first, end, bodies in _slices(batch.column("text")):
                found, begins = grams(bodies)
                found |= np.repeat(folds[first:end], np.diff(begins))
                good = np.repeat(marks[first:end], np.diff(begins))
                if good.any():
                    keys, counts = np.unique(found[good], return_counts=True)
                    parts.append((keys, counts))
                    held += len(keys)
                if not good.all():
                    keys = np.unique(found[~good])
                    parts.append((keys, np.zeros(len(keys), np.int64)))
                    held += len(keys)
                if held > HELD:
                    merged = made(parts)
                    parts[:] = [merged]
                    held = len(merged[0])
                    if held > FULL:
                        yield from emitted()
                        held = 0
        yield from emitted()

    return (
        rows.select("text", "trusted", *["fold"] * folded)
        .mapInArrow(run, "gram bigint, count bigint")
        .groupBy("gram")
        .agg(F.sum("count").alias("count"))
    )


def _model() -> Column:
    return F.shiftright("gram", FOLD_BITS)


def _last(order: int) -> Column:
    """The last symbols of a gram, and the model."""
    return F.col("gram").bitwiseAND(F.lit(_mask(order) | 7 << FOLD_BITS)).alias("gram")


def _by_model(values: dict[int, float]) -> Column:
    """The value of the row's model; no more values than there are folds."""
    pairs = [F.lit(x) for model, value in values.items() for x in (model, float(value))]
    return F.element_at(F.create_map(*pairs), _model().cast("int")) if pairs else F.lit(None)


def _discounts(counts: DataFrame) -> list[Column]:
    """The three discounts of modified Kneser-Ney from the numbers of counts 1 to 4, by model."""
    numbers = [F.count_if(F.col("count") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    found = {}
    for row in counts.groupBy(_model().cast("int").alias("model")).agg(*numbers).collect():
        n = [0, *(row[f"n{k}"] or 0 for k in (1, 2, 3, 4))]
        if not n[1]:
            found[row.model] = [0.5, 0.5, 0.5]
            continue
        y = n[1] / (n[1] + 2 * n[2])
        made = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k * 0.5 for k in (1, 2, 3)]
        found[row.model] = [min(max(d, 0.05 * k), 0.95 * k) for k, d in zip((1, 2, 3), made)]
    return [_by_model({model: d[k] for model, d in found.items()}) for k in range(3)]


def probabilities(corpus: DataFrame) -> DataFrame:
    """gram and log_p (natural) of all grams of ``corpus`` (gram, count; stored). Each number in the
    bits above the gram is a model by itself."""
    seen = corpus.where("count > 0")
    levels = {ORDER: seen}
    for order in range(ORDER - 1, 0, -1):
        # Continuation counts: with how many different symbols before it a gram was seen.
        levels[order] = stored(
            levels[order + 1].groupBy(_last(order)).agg(F.count("*").alias("count")),
            "continuations",
        )
    asked = {ORDER: corpus.select("gram")}
    for order in range(ORDER - 1, 0, -1):
        asked[order] = stored(asked[order + 1].select(_last(order)).distinct(), "asked-grams")

    def discount(d: list[Column]) -> Column:
        c = F.col("count")
        return F.when(c == 1, d[0]).when(c == 2, d[1]).when(c > 2, d[2]).otherwise(0.0)

    def totals(d: list[Column]) -> tuple[Column, Column]:
        return F.sum("count").alias("total"), F.sum(discount(d)).alias("left_over")

    d = _discounts(levels[1])
    sums = levels[1].groupBy(_model().cast("int").alias("model")).agg(*totals(d)).collect()
    total, left_over = (_by_model({r.model: r[name] for r in sums}) for name in ("total", "left_over"))
    uniform = 1 / (1 << SYMBOL_BITS)
    known = asked[1].join(levels[1], "gram", "left").select(
        "gram",
        (
            (F.coalesce(F.col("count") - discount(d), F.lit(0.0)) + left_over * uniform) / total
        ).alias("p"),
    )
    for order in range(2, ORDER + 1):
        known = stored(known, "probabilities")
        d = _discounts(levels[order])
        contexts = (
            levels[order]
            .groupBy(F.shiftright("gram", SYMBOL_BITS).alias("context"))
            .agg(*totals(d))
        )
        rows = corpus if order == ORDER else asked[order].join(levels[order], "gram", "left")
        lower = known.select(F.col("gram").alias("shorter"), F.col("p").alias("lower_p"))
        known = (
            rows.withColumn("context", F.shiftright("gram", SYMBOL_BITS))
            .withColumn("shorter", _last(order - 1))
            .join(contexts, "context", "left")
            .join(lower, "shorter")
            .select(
                "gram",
                F.when(F.col("total").isNull(), F.col("lower_p"))
                .otherwise(
                    (
                        F.coalesce(F.col("count") - discount(d), F.lit(0.0))
                        + F.col("left_over") * F.col("lower_p")
                    )
                    / F.col("total")
                )
                .alias("p"),
            )
        )
    return known.select("gram", F.log("p").cast("float").alias("log_p"))


class Lookup:
    """Values by gram, in the order of hashes with the place where each hash begins, for many grams at
    once. There are no free places, and a task holds it beside the arrays that were broadcast."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        slots = self._slots(keys)
        self.begins = np.zeros((1 << bits) + 1, np.int32)
        np.cumsum(np.bincount(slots, minlength=1 << bits), dtype=np.int32, out=self.begins[1:])
        order = np.argsort(slots)
        del slots
        # One more entry that no gram is equal to, for hashes behind all others.
        self.keys, self.values = np.append(keys[order], -1), np.append(values[order], np.float32(0))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        slots >>= self.shift
        return slots.astype(np.int32)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The values; 0 for grams that are not in the table."""
        slots = self._slots(keys)
        at = self.begins[slots]
        hit = self.keys[at] == keys
        result = np.where(hit, self.values[at], np.float32(0)).astype(np.float64)
        left = np.flatnonzero(~hit)
        at, ends, wanted = at[left] + 1, self.begins[slots[left] + 1], keys[left]
        while True:
            more = at < ends
            left, at, ends, wanted = left[more], at[more], ends[more], wanted[more]
            if not len(left):
                break
            hit = self.keys[at] == wanted
            result[left[hit]] = self.values[at[hit]]
            at = np.where(hit, ends, at + 1)
        return result


def log_likelihoods(rows: DataFrame, table_of_p: DataFrame, shard_entries: int) -> DataFrame:
    """doc_id, lang, text_hash, chars and log_p, the sum over all characters by the model of the
    row, of each text."""
    spark = rows.sparkSession
    size = table_of_p.count()
    shards = max(1, -(-size // shard_entries))
    names = ["doc_id", "lang", "text_hash"]

    def scored(shard) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup = Lookup(*shard.value)
            for batch in batches:
                models = np.array(batch.column("model").to_pylist(), np.int64) << FOLD_BITS
                sums, sizes = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
                for first, end, bodies in _slices(batch.column("text")):
                    found, begins = grams(bodies)
                    sizes[first:end] = np.diff(begins)
                    found |= np.repeat(models[first:end], np.diff(begins))
                    running = np.concatenate([[0.0], np.cumsum(lookup.of(found))])
                    sums[first:end] = running[begins[1:]] - running[begins[:-1]]
                yield pa.RecordBatch.from_pydict(
                    {name: batch.column(name) for name in names}
                    | {
                        "chars": pa.array(sizes, pa.int64()),
                        "log_p": pa.array(sums, pa.float64()),
                    }
                )

        return rows.select(*names, "text", "model").mapInArrow(
            run, "doc_id bigint, lang string, text_hash bigint, chars bigint, log_p double"
        )

    dealt = stored(
        table_of_p.withColumn("shard", F.expr(f"cast(pmod(xxhash64(gram), {shards}) as int)")),
        "gram-shards",
    )
    parts = None
    for number in range(shards):
        # About shard_entries grams, 12 bytes each: the one thing here that is sent whole. One shard is
        # there at a time.
        entries = dealt.where(F.col("shard") == number).select("gram", "log_p").toArrow()
        entries = entries.combine_chunks()
        shard = spark.sparkContext.broadcast(
            (entries.column("gram").to_numpy(), entries.column("log_p").to_numpy())
        )
        part = stored(scored(shard), "shard-sums")
        shard.destroy()
        parts = part if parts is None else parts.unionByName(part)
    # Each row comes once per shard, and a row that is there several times several times as often.
    return (
        parts.groupBy(*names)
        .agg(
            F.max("chars").alias("chars"),
            (F.sum("log_p") * F.lit(shards) / F.count("*")).alias("log_p"),
        )
    )


def fold_of() -> Column:
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS).cast("int")


def grams_of_models(grams_of_folds: DataFrame, models: list[int]) -> DataFrame:
    """gram, with its model in the bits above, and count in the trusted texts that the model counts:
    those of the other folds. The first model has all grams, the others those of trusted texts."""
    fold = F.shiftright("gram", FOLD_BITS)
    scoring = F.when(fold < FOLDS, F.array(*map(F.lit, models))).otherwise(F.array(F.lit(0)))
    return (
        grams_of_folds.select("gram", "count", fold.alias("fold"), F.explode(scoring).alias("model"))
        .select(
            F.col("gram")
            .bitwiseAND(F.lit(_mask(ORDER)))
            .bitwiseOR(F.shiftleft(F.col("model").cast("bigint"), FOLD_BITS))
            .alias("gram"),
            F.when(F.col("fold") != F.col("model"), F.col("count")).otherwise(0).alias("count"),
        )
        .groupBy("gram")
        .agg(F.sum("count").alias("count"))
    )


def thresholds(scored: DataFrame, judges: DataFrame, quantile: float) -> DataFrame:
    """``scored`` (lang, chars, perplexity and more) with the threshold by language and length."""
    least = NormalDist().inv_cdf(quantile)
    judges = judges.select("lang", "chars", F.log("perplexity").alias("level"))
    # One row per language.
    middle = judges.groupBy(F.col("lang").alias("judged")).agg(
        F.percentile_approx("level", 0.5, 100_000).alias("middle")
    )
    placed = judges.join(F.broadcast(middle), F.col("lang").eqNullSafe(F.col("judged")))
    placed = placed.withColumn("distance", F.col("level") - F.col("middle"))
    square, part = F.col("distance") * F.col("distance"), 1 / F.col("chars")
    fit = placed.agg(
        F.regr_slope(square, part).alias("b"),
        F.regr_intercept(square, part).alias("a"),
        F.avg(square).alias("all"),
        F.avg(square * F.col("chars")).alias("each"),
    ).first()
    a, b = fit["a"], fit["b"]
    if a is None or b is None or b < 0:
        a, b = fit["all"] or 0.0, 0.0
    elif a < 0:
        a, b = 0.0, fit["each"]
    spread = F.sqrt(F.lit(a) + F.lit(b) / F.col("chars")) + 1e-9
    limits = (
        placed.groupBy(F.col("lang").alias("judged"))
        .agg(
            F.greatest(
                F.percentile_approx(F.col("distance") / spread, quantile, 100_000), F.lit(least)
            ).alias("limit")
        )
        .join(middle.withColumnRenamed("judged", "same"), F.col("judged").eqNullSafe(F.col("same")))
        .drop("same")
    )
    return scored.join(
        F.broadcast(limits), F.col("lang").eqNullSafe(F.col("judged")), "left"
    ).withColumn("threshold", F.exp(F.col("middle") + 1.5 * F.col("limit") * spread))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = 0.999,
    shard_entries: int = 2_000_000,
) -> DataFrame:
    """doc_id, lang, text_hash (xxhash64 of the text), chars, perplexity (per character),
    threshold and kept, for each document. ``labels`` has doc_id and quality, 1 for trusted texts."""
    good = labels.where("quality = 1").select("doc_id").where("doc_id is not null").distinct()
    good = stored(good.withColumn("labelled", F.lit(True)), "trusted-ids")
    n_good = good.count()
    rows = texts(docs, "lang").withColumn("text_hash", F.xxhash64("text"))
    full = rows.where("text != ''").join(
        F.broadcast(good) if n_good <= BROADCAST_ROWS else good, "doc_id", "left"
    )
    full = full.withColumn("labelled", F.col("labelled").isNotNull())
    full = full.withColumn("trusted", F.col("labelled"))
    full = full.withColumn("fold", F.when(F.col("labelled"), fold_of()).otherwise(FOLDS))
    result = ["doc_id", "lang", "text_hash", "chars", "perplexity", "threshold", "kept"]
    empty = (
        rows.where("text = ''")
        .select(
            "doc_id",
            "lang",
            "text_hash",
            F.lit(0).cast("bigint").alias("chars"),
            F.lit(None).cast("double").alias("perplexity"),
            F.lit(None).cast("double").alias("threshold"),
            F.lit(False).alias("kept"),
        )
        .distinct()
    )
    corpus = stored(corpus_grams(full), "corpus-grams")
    # A model needs trusted texts in another fold than the one that it leaves out.
    folds = corpus.where("count > 0").select(F.shiftright("gram", FOLD_BITS)).distinct()
    folds = {fold for fold, in folds.collect()}
    if len(folds) < 2:
        size = F.length("text").cast("bigint").alias("chars")
        plain = full.select("doc_id", "lang", "text_hash", size)
        plain = plain.distinct().withColumns(
            {
                "perplexity": F.lit(None).cast("double"),
                "threshold": F.lit(None).cast("double"),
                "kept": F.lit(True),
            }
        )
        return plain.select(result).unionByName(empty)
    table_of_p = probabilities(stored(grams_of_models(corpus, sorted(folds | {0})), "model-grams"))
    asking = full.withColumn("model", F.when(F.col("fold") < FOLDS, F.col("fold")).otherwise(0))
    sums = log_likelihoods(asking, table_of_p, shard_entries)
    scored = stored(
        sums.withColumn("perplexity", F.exp(-F.col("log_p") / F.col("chars"))), "perplexities"
    )
    judges = scored.join(F.broadcast(good) if n_good <= BROADCAST_ROWS else good, "doc_id")
    return (
        thresholds(scored, judges, quantile)
        .withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
        .select(result)
        .unionByName(empty)
    )


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    kept = quality(docs, labels, **options).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("lang").alias("kept_lang"), "text_hash"
    )
    same = (
        docs["doc_id"].eqNullSafe(kept["kept_id"])
        & docs["lang"].eqNullSafe(kept["kept_lang"])
        & (F.xxhash64(docs["text"]) == kept["text_hash"])
    )
    return docs.join(kept, same, "left_semi")


@query("op3_quality")
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality(docs, labels).drop("text_hash")
