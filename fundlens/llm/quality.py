"""Quality rules: a hashed n-gram log-likelihood ratio and counted base rules (native).

Unigrams and bigrams of words are hashed into a fixed number of buckets.  Two
multinomials over the buckets are counted: the raw corpus (every document) and
the trusted target (all documents labelled good).  A document's score is the sum of
log(p_target / p_raw) over its n-grams divided by their number; it is kept if it
passes the base rules and its score reaches the threshold.  All of it is
DataFrame functions; the only values that reach the driver are the bucket
weights (one number per bucket), the totals of the labelled scores by range and
the threshold.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.llm.common import id_and_text, written
from fundlens.operators.join import broadcast_if_small

# Bytes that separate words: space, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

BUCKETS = 1 << 14
MOVED = 2_000_000  # labelled ids up to which they are broadcast; beyond it the documents are shuffled


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def slot(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def word_pairs(words: Column, value: Callable[[Column], Column] = lambda h: h) -> Column:
    """``value`` of the hash of every pair of neighbouring words."""
    n = F.size(words)
    starts = F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: value(F.xxhash64(F.get(words, i), F.get(words, i + 1))))


def word_windows(pairs: Column) -> Column:
    """One hash per window of three words, from the hashes of its two pairs."""
    n = F.size(pairs)
    starts = F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.get(pairs, i), F.get(pairs, i + 1)))


def _covered(at: Column) -> Column:
    """Words inside the 3-word windows that start at the ascending positions ``at`` (repeated ones count once)."""
    step = F.aggregate(
        at,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("end")),
        lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["end"])).alias("n"), p.alias("end")),
    )
    return step["n"]


def _covered_by_pairs(windows: Column) -> Column:
    """The same for all windows found twice or more, by sorting (hash, position) pairs: any hashes, but slow."""

    def repeated(placed: Column) -> Column:
        last = F.size(placed) - 1
        twice = F.filter(
            placed,
            lambda x, i: ((i > 0) & (F.get(placed, i - 1)["h"] == x["h"])) | ((i < last) & (F.get(placed, i + 1)["h"] == x["h"])),
        )
        return F.sort_array(F.transform(twice, lambda x: x["p"]))

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("p")))
    # a let-binding: the one-element array's element is evaluated once
    return _covered(F.get(F.transform(F.array(F.sort_array(pairs)), repeated), F.lit(0)))


def with_repeat_words(rows: DataFrame) -> DataFrame:
    """``n_repeat_words`` instead of ``windows``: words inside 3-word windows that occur twice or more in the text.

    Each step is a select of its own: inside a lambda Spark evaluates (and sorts) boxed values.  A text
    with a repeat sorts plain longs, the low bits of a hash followed by its position; neighbours that
    agree but for the position are repeats.  If cut hashes agree where whole ones differ, there are
    more such neighbours than repeats, and the whole hashes are sorted with their positions.
    """
    kept = [c for c in rows.columns if c != "windows"]
    n, bits, placed, again = F.size("windows"), F.col("bits"), F.col("placed"), F.col("again")
    found = rows.select(*kept, "windows", F.size(F.array_distinct("windows")).alias("different"), F.length(F.bin(n)).alias("bits"))
    searched = F.when(F.col("different") < n, F.col("windows")).otherwise(F.slice("windows", 1, 0))
    place = F.transform(searched, lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("long")))
    sorted_ = found.select(*kept, "windows", (n - F.col("different")).alias("repeats"), "bits", F.sort_array(place).alias("placed"))
    # beyond the ends get() gives null, which no filter keeps
    alike = lambda i: F.call_function("shiftrightunsigned", F.get(placed, i).bitwiseXOR(F.get(placed, i - 1)), bits) == 0
    low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    neighbours = sorted_.select(
        *kept,
        "windows",
        "repeats",
        "placed",
        low.alias("low"),
        F.filter(F.sequence(F.lit(1), F.greatest(F.size(placed) - 1, F.lit(1))), alike).alias("again"),
    )
    position = lambda i: F.get(placed, i).bitwiseAND(F.col("low"))
    at = F.concat(F.transform(again, lambda i: position(i)), F.transform(again, lambda i: position(i - 1)))
    counted = (
        F.when(F.col("repeats") == 0, F.lit(0).cast("long"))
        .when(F.size(again) == F.col("repeats"), _covered(F.sort_array(at)))
        .otherwise(_covered_by_pairs(F.col("windows")))
    )
    return neighbours.select(*kept, counted.alias("n_repeat_words"))


def with_words(docs: DataFrame, id_col: str, text_col: str, keep_row: bool = False) -> DataFrame:
    """id, text, words (and the whole input row as one struct, so names cannot clash)."""
    row = [F.struct(*[qcol(c) for c in docs.columns]).alias("row")] if keep_row else []
    text = F.coalesce(qcol(text_col).cast("string"), F.lit(""))
    return docs.select(*row, qcol(id_col).alias("id"), text.alias("text"), words_of(qcol(text_col).cast("string")).alias("words"))


def counted_columns() -> dict[str, Column]:
    """The base columns over ``text`` and ``words`` that need no windows."""
    text, words = F.col("text"), F.col("words")
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_dup_lines": F.get(F.transform(F.array(lines), lambda a: F.size(a) - F.size(F.array_distinct(a))), F.lit(0)).cast("long"),
    }


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def ngram_buckets(buckets: int) -> Column:
    """Bucket numbers of every word and every pair of neighbouring words."""
    value = lambda h: slot(h, buckets)
    return F.concat(F.transform("words", lambda w: value(F.xxhash64(w))), word_pairs(F.col("words"), value))


def labelled_ids(labels: DataFrame) -> DataFrame:
    """(t, good) of every labelled id, materialized; an id with both labels is good (1).

    Broadcast up to MOVED ids; beyond it the joins with the documents are shuffled.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    ids = known.groupBy(F.col("doc_id").alias("t")).agg(F.max("quality").cast("int").alias("good"))
    return broadcast_if_small(ids, MOVED)


@dataclass(frozen=True)
class QualityModel:
    """One weight per bucket, log(p_target / p_raw), and the score from which documents are kept."""

    weights: tuple[float, ...]
    threshold: float

    def score(self) -> Column:
        """Mean weight of the n-grams of ``words`` and ``pairs`` (0 without any)."""
        table = F.expr("array(" + ",".join(f"{w!r}D" for w in self.weights) + ")")  # folded to one literal
        hashes = F.concat(F.transform("words", lambda w: F.xxhash64(w)), F.col("pairs"))
        total = F.aggregate(hashes, F.lit(0.0), lambda s, h: s + F.get(table, slot(h, len(self.weights))))
        n = F.size("words") + F.size("pairs")
        return F.when(n > 0, total / n).otherwise(F.lit(0.0))


def fit_weights(docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str, buckets: int) -> tuple[float, ...]:
    """Log ratio per bucket, add-one smoothed: target from all trusted rows, raw from all rows."""
    words = with_words(docs, id_col, text_col)
    marked = words.join(labelled, words["id"] == labelled["t"], "left").select(
        F.coalesce("good", F.lit(0)).cast("long").alias("trusted"), ngram_buckets(buckets).alias("grams")
    )
    counts = (
        # explode() would add a filter on the size of grams that computes them a second time
        marked.select("trusted", F.explode_outer("grams").alias("bucket"))
        .filter("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("target"))
    )
    found = {r["bucket"]: (r["raw"], r["target"]) for r in counts.collect()}  # at most one row per bucket
    every = [found.get(b, (0, 0)) for b in range(buckets)]
    raw_all, target_all = sum(r for r, _ in every) + buckets, sum(t for _, t in every) + buckets
    if target_all == buckets:  # nothing trusted: no evidence either way
        return (0.0,) * buckets
    from math import log

    return tuple(round(log((t + 1) / target_all) - log((r + 1) / raw_all), 9) for r, t in every)


def fit_threshold(docs: DataFrame, labelled: DataFrame, weights: tuple[float, ...], id_col: str, text_col: str) -> float:
    """The score that best separates all labelled documents with words (:func:`best_cut`)."""
    # joined before the words are cut, so only labelled texts are; wordless ones get no score
    rows = id_and_text(docs, id_col, text_col).join(labelled, F.col("id") == F.col("t"))
    words = rows.select("good", words_of(F.col("text")).alias("words"))
    grams = words.select("good", "words", word_pairs(F.col("words")).alias("pairs"))
    score = F.when(F.size("words") > 0, QualityModel(weights, 0.0).score())
    return best_cut(grams.select("good", score.alias("score")))


def best_cut(scored: DataFrame) -> float:
    """The cut of ``scored`` (good 0 or 1, score) that maximises (share of good kept) - (share of bad kept).

    Of equal best cuts the lowest; it lies halfway below the lowest kept score.
    Without both classes nothing is rejected (minus infinity); rows without a
    score do not count.  The distinct scores are dealt into ranges; the counts
    above a score are those of its range plus the totals of the ranges above,
    and only the totals (one row per range) reach the driver.
    """
    per_score = scored.groupBy("score").agg(F.sum("good").alias("good"), F.count(F.lit(1)).alias("n"))
    ranged = per_score.repartitionByRange("score").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "scores").filter("score IS NOT NULL")
    ends = ranged.groupBy("part").agg(F.sum("good").alias("good"), F.sum("n").alias("n"), F.max("score").alias("top")).orderBy("part").collect()
    good, bad = sum(r["good"] for r in ends), sum(r["n"] - r["good"] for r in ends)
    if not good or not bad:
        return float("-inf")
    starts, kept_good, kept_bad, below = [], good, bad, None
    for r in ends:
        starts.append((r["part"], kept_good, kept_bad, below))
        kept_good, kept_bad, below = kept_good - r["good"], kept_bad - (r["n"] - r["good"]), r["top"]
    starts = scored.sparkSession.createDataFrame(starts, "part int, good_left long, bad_left long, top_below double")
    by_score = Window.partitionBy("part").orderBy("score")
    before = by_score.rowsBetween(Window.unboundedPreceding, -1)
    kept_good = F.col("good_left") - F.coalesce(F.sum("good").over(before), F.lit(0))
    kept_bad = F.col("bad_left") - F.coalesce(F.sum(F.col("n") - F.col("good")).over(before), F.lit(0))
    below = F.coalesce(F.lag("score").over(by_score), "top_below")
    cuts = ranged.join(F.broadcast(starts), "part").select(
        (kept_good / F.lit(good) - kept_bad / F.lit(bad)).alias("gain"),
        (-F.col("score")).alias("low"),
        F.when(below.isNull(), F.col("score")).otherwise((F.col("score") + below) / 2).alias("cut"),
    )
    return cuts.agg(F.max(F.struct("gain", "low", "cut")).alias("best")).first()["best"]["cut"]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
) -> QualityModel:
    """Weights over all documents, target and threshold from all labelled ones.

    ``labels`` has doc_id and quality (1 trusted, 0 bad); null ids or labels are not used.
    """
    labelled = labelled_ids(labels)
    weights = fit_weights(docs, labelled, id_col, text_col, buckets)
    return QualityModel(weights, fit_threshold(docs, labelled, weights, id_col, text_col))


def _verdicts(words: DataFrame, model: QualityModel, *carried: str) -> DataFrame:
    counted = words.select(*carried, *[c.alias(n) for n, c in counted_columns().items()], "words", word_pairs(F.col("words")).alias("pairs"))
    scored = counted.select(*carried, *BASE[:-1], model.score().alias("score"), word_windows(F.col("pairs")).alias("windows"))
    scored = with_repeat_words(scored).select(*carried, *BASE, base_failed().alias("base_failed"), "score")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(model.threshold)))


def assess(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score) per row.

    A null or wordless text counts zero everywhere, scores 0 and fails the base
    rules.  Repeated rows give repeated results; an empty table an empty one.
    """
    verdicts = _verdicts(with_words(docs, id_col, text_col), model, "id")
    return verdicts.select(F.col("id").alias(id_col), *[c for c in verdicts.columns if c not in ("id", "score")], "score")


def keep_good(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a ``kept`` verdict, all columns unchanged."""
    verdicts = _verdicts(with_words(docs, id_col, text_col, keep_row=True), model, "row")
    # A filter on the verdict would be pushed down and compute every rule twice; one on an exploded column is not.
    kept = verdicts.select(F.explode_outer(F.when(F.col("kept"), F.array("row"))).alias("row")).filter("row IS NOT NULL")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
