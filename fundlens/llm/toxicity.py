"""Toxicity by compression distance.

Two zstandard dictionaries are made: one of the most frequent words of ordinary
text, one of every word that occurs in many more different contexts in toxic
text than in ordinary text.  Every window of a document (they overlap) is compressed twice, given the
ordinary dictionary alone and given the ordinary one together with the toxic
one; the bytes saved by the second measure how toxic the window is, as
everything that is ordinary costs the same both times.  Statistics of the
savings over all windows go into a logistic calibration fitted on labelled
documents that the dictionaries have not seen; 0.5 is its threshold.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import id_and_text, id_type, written

WINDOW, STEP = 96, 32  # bytes of a window, and from one to the next: every shorter word is whole in some window
LEVEL = 9
ORDINARY_BYTES = 8192
# The bound of the fit: labelled documents per class, and kilobyte segments taken from each.
SAMPLE_ROWS = 6_000
SEGMENTS, SEGMENT_CHARS = 24, 1024
ORDINARY_WINDOWS = 40_000
MIN_SCORE, MIN_RATIO, MIN_CONTEXTS = 6.0, 5.0, 5

PUNCTUATION = ".,!?;:\"'()[]*$%#&|<>"


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]  # intercept first, then one per feature

    def scorer(self) -> WindowSavings:
        return WindowSavings(self.ordinary, self.toxic)


class WindowSavings:
    """Compresses windows given either dictionary; one per task."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard

        self.compress = []
        for content in (ordinary, toxic + ordinary):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            self.compress.append(c.compress)

    def features(self, text: str) -> list[float]:
        """Of the bytes saved per window: largest, mean of the 3 largest, mean, mean of gains, mean of the top quarter."""
        raw = text.lower().encode("utf-8")
        if not raw:
            return [0.0] * 5
        plain, given = self.compress
        windows = (raw[i : i + WINDOW] for i in range(0, max(1, len(raw) - WINDOW + STEP), STEP))
        saved = sorted((len(plain(w)) - len(given(w)) for w in windows), reverse=True)
        n = len(saved)
        quarter = max(1, n // 4)
        return [
            float(saved[0]),
            sum(saved[:3]) / min(3, n),
            sum(saved) / n,
            sum(x for x in saved if x > 0) / n,
            sum(saved[:quarter]) / quarter,
        ]


def bare_words(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.lower(text), r"\s+"), lambda w: F.btrim(w, F.lit(PUNCTUATION))), lambda w: w != "")


def toxic_words(sample: DataFrame) -> list[str]:
    """Words whose number of different contexts (the word before) is far larger in toxic text.

    Contexts rather than occurrences are counted, so the words of one text
    that was copied many times do not look frequent.  ``sample`` has toxic and words.
    """
    words = F.col("words")
    before = F.concat(F.array(F.lit("")), words)
    pairs = sample.select("toxic", F.explode(F.arrays_zip(before.alias("b"), words.alias("w"))).alias("p")).select("toxic", "p.b", "p.w")
    contexts = pairs.filter("w IS NOT NULL").distinct()
    n = {r["toxic"]: r["n"] for r in contexts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = float(n.get(0, 1)), float(n.get(1, 1))
    counts = contexts.groupBy("w").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    a, b = F.col("a"), F.col("b")
    p = (a + b) / (n0 + n1)
    z = (a / n1 - b / n0) / F.sqrt(p * (1 - p) * (1 / n0 + 1 / n1) + 1e-18)
    far = counts.filter((a >= MIN_CONTEXTS) & (z > MIN_SCORE) & (a * n0 > MIN_RATIO * b * n1))
    return [r["w"] for r in far.select("w").orderBy("w").collect()]


def ordinary_dictionary(windows: list[bytes]) -> bytes:
    """The words most frequent in ordinary windows, at most ORDINARY_BYTES of them; the most frequent come last."""
    counts = Counter(w for window in windows for w in window.split())
    ranked = sorted(counts, key=lambda w: (-counts[w], w))
    sizes = np.cumsum([len(w) + 1 for w in ranked])
    fit = int(np.searchsorted(sizes, ORDINARY_BYTES - 1, side="right"))
    return b" ".join([b"", *reversed(ranked[:fit]), b""])


def toxic_dictionary(samples: list[bytes]) -> bytes:
    """Every distinct sample, whole."""
    return b" ".join([b"", *sorted(set(samples)), b""])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Newton's method for ridge logistic regression with an intercept."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(a.shape[1])
    penalty = ridge * len(x) * np.diag([0.0, *[1.0] * x.shape[1]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + penalty @ w
        hess = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + penalty + 1e-9 * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    slope = w[1:] / scale
    return np.array([w[0] - (slope * mean).sum(), *slope])


def labelled_segments(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, rows: int) -> DataFrame:
    """(id, toxic, segments) of at most ``rows`` labelled training documents per class.

    ``train`` is a condition on labels' doc_id.  The sample is the first in
    hash order; of a long document SEGMENTS evenly spaced pieces are taken.
    """
    known = labels.filter(train).filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id"), "doc_id")
    sample = known.filter("toxic = 0").orderBy(*order).limit(rows).unionByName(known.filter("toxic = 1").orderBy(*order).limit(rows))
    text = id_and_text(docs, id_col, text_col)
    picked = text.join(F.broadcast(sample.withColumnRenamed("doc_id", "t")), F.col("id") == F.col("t")).filter("text <> ''")
    n = F.char_length("text")
    count = F.least(F.lit(SEGMENTS), F.ceil(n / SEGMENT_CHARS)).cast("int")
    at = lambda i: F.floor(i * n / count).cast("int") + 1
    pieces = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("text"), at(i), F.lit(SEGMENT_CHARS)))
    return picked.groupBy("id").agg(F.first("toxic").alias("toxic"), F.first(pieces).alias("segments"))


def _features(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """(toxic, x) of calibration rows, compressed on the executors."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            x = [scorer.features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "x"])

    return rows.select("toxic", F.array_join("segments", "\n").alias("text")).mapInArrow(run, "toxic int, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on a bounded sample of the labelled rows that satisfy ``train`` (a condition on labels).

    Four fifths of the sample (by a hash of the text) train the dictionaries,
    the rest the calibration; the driver sees the words that stand out, a
    bounded number of windows and the calibration features.  With one class
    or no labels every text gets the same score.
    """
    sample = written(labelled_segments(docs, labels, train, id_col, text_col, rows), "labelled")
    text = F.array_join("segments", "\n")
    rows_ = sample.select("toxic", "segments", (F.pmod(F.xxhash64(text), F.lit(5)) == 0).alias("calibrate"), bare_words(text).alias("words"))
    n = {(r["toxic"], r["calibrate"]): r["n"] for r in rows_.groupBy("toxic", "calibrate").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = {y for y, _ in n}
    if len(classes) < 2:
        return ToxicityModel(b"", b"", (4.0 if classes == {1} else -4.0, 0.0, 0.0, 0.0, 0.0, 0.0))
    whole = all((y, c) in n for y in (0, 1) for c in (True, False))  # else too few to set any aside
    learn = rows_.filter(~F.col("calibrate")) if whole else rows_
    words = toxic_words(learn)
    toxic = learn.filter("toxic = 1")
    # where no word stands out, the beginnings of the toxic texts take the words' place
    samples = words or [r["t"] for r in toxic.select(F.substring(F.lower(text), 1, SEGMENT_CHARS).alias("t")).distinct().collect()]
    each = max(1, -(-ORDINARY_WINDOWS // rows))
    cuts = F.transform(F.sequence(F.lit(0), F.lit(each - 1)), lambda i: F.substring(F.lower(text), F.floor(i * F.char_length(text) / each).cast("int") + 1, F.lit(WINDOW)))
    windows = sorted(w.encode()[:WINDOW] for r in learn.filter("toxic = 0").select(F.array_distinct(cuts).alias("w")).collect() for w in r["w"])
    model = ToxicityModel(ordinary_dictionary(windows), toxic_dictionary([t.encode() for t in samples]), ())
    got = sorted((r["toxic"], tuple(r["x"])) for r in _features(rows_.filter("calibrate") if whole else rows_, model).collect())
    weights = _logistic(np.array([x for _, x in got]), np.array([float(y) for y, _ in got]))
    return ToxicityModel(model.ordinary, model.toxic, tuple(weights))


def score_documents(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score in 0..1, predicted) of every whole text.

    Null and empty texts have no savings and score what the calibration gives
    for none.  Rows are independent; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer, w = m.scorer(), m.weights
        for batch in batches:
            scores = []
            for text in batch.column(1):
                z = w[0] + sum(a * b for a, b in zip(w[1:], scorer.features(text.as_py() or "")))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=[id_col, "score", "predicted"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type(docs, id_col)}, score double, predicted int")
