"""Language identification by a convolutional network over bytes.

Byte embeddings, filters of several widths, max pooling over the window and a
softmax layer, trained in numpy on windows of labelled text and applied to
batches of fixed-length windows that cover every whole text.  A document's
language is the class with the largest mean window logit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.llm.common import id_and_text, id_type

WINDOW = 128  # bytes of a window
WIDTHS = (2, 3, 4)  # filter widths
FILTERS = 8  # filters per width
EMBED = 6
UNKNOWN = "und"
# The bound of the fit: training documents per language and windows of each.
SAMPLE_ROWS, SAMPLE_WINDOWS = 1_500, 4

LETTER = regex.compile(r"\p{L}")
WIDEST = max(WIDTHS)
STRIDE = WINDOW - WIDEST + 1  # neighbouring windows overlap so that no n-gram is lost


@dataclass
class ByteCnn:
    """embed (257, EMBED; row 0 is padding), conv (WIDEST * EMBED, filters), bias, dense, dense_bias, classes."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    classes: list[str]

    def columns(self, x: np.ndarray) -> np.ndarray:
        """(windows, positions, WIDEST * EMBED): the embedded bytes below each filter position."""
        e = self.embed[x]
        n, _, d = e.shape
        s = e.strides
        view = np.lib.stride_tricks.as_strided(e, (n, STRIDE, WIDEST * d), (s[0], s[1], s[2]))
        return np.ascontiguousarray(view)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        c = self.columns(x)
        z = c.reshape(-1, c.shape[2]) @ self.conv
        z = z.reshape(len(x), STRIDE, -1)
        return c, z, z.max(axis=1)

    def logits(self, x: np.ndarray, chunk: int = 256) -> np.ndarray:
        """Class logits of windows (n, WINDOW) of byte codes (0 padding, else byte + 1)."""
        out = np.empty((len(x), len(self.classes)), np.float32)
        for i in range(0, len(x), chunk):
            pool = self.pooled(x[i : i + chunk])[2]
            out[i : i + chunk] = np.maximum(pool + self.bias, 0) @ self.dense + self.dense_bias
        return out


def width_mask(embed: int) -> np.ndarray:
    """1 where a filter of its width has a weight: a width w filter uses the first w bytes."""
    mask = np.zeros((WIDEST * embed, FILTERS * len(WIDTHS)), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[: w * embed, k * FILTERS : (k + 1) * FILTERS] = 1
    return mask


def train(windows: np.ndarray, labels: np.ndarray, classes: list[str], epochs: int = 4, batch: int = 64, rate: float = 0.01, seed: int = 5) -> ByteCnn:
    """Adam on softmax cross-entropy, class-balanced; all gradients by hand in numpy."""
    rng = np.random.default_rng(seed)
    f, k = FILTERS * len(WIDTHS), len(classes)
    mask = width_mask(EMBED)
    net = ByteCnn(
        rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
        rng.normal(0, 0.3, mask.shape).astype(np.float32) * mask,
        np.zeros(f, np.float32),
        rng.normal(0, 0.3, (f, k)).astype(np.float32),
        np.zeros(k, np.float32),
        classes,
    )
    net.embed[0] = 0
    params = [net.embed, net.conv, net.bias, net.dense, net.dense_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weight = len(labels) / (k * np.bincount(labels, minlength=k).clip(1))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            x, y = windows[pick], labels[pick]
            c, z, pool = net.pooled(x)
            at = z.argmax(axis=1)
            hidden = np.maximum(pool + net.bias, 0)
            logit = hidden @ net.dense + net.dense_bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p *= (weight[y] / len(y))[:, None]
            d_hidden = (p @ net.dense.T) * (hidden > 0)
            rows = np.take_along_axis(c, at[:, :, None], axis=1)  # (n, filters, columns): what each filter's maximum saw
            d_conv = np.einsum("nf,nfc->cf", d_hidden, rows) * mask
            d_rows = (d_hidden[:, :, None] * net.conv.T[None]).reshape(len(x), f, WIDEST, EMBED)
            codes = x[np.arange(len(x))[:, None, None], at[:, :, None] + np.arange(WIDEST)]
            d_embed = np.zeros_like(net.embed)
            np.add.at(d_embed, codes.ravel(), d_rows.reshape(-1, EMBED))
            d_embed[0] = 0
            step += 1
            for j, g in enumerate((d_embed, d_conv, d_hidden.sum(0), hidden.T @ p, p.sum(0))):
                first[j] += 0.1 * (g - first[j])
                second[j] += 0.001 * (g * g - second[j])
                params[j] -= (rate * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def to_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows, owner): all overlapping windows of all texts and the text each belongs to."""
    counts = [max(1, -(-(len(t) - WIDEST + 1) // STRIDE)) for t in texts]
    out = np.zeros((sum(counts), WINDOW), np.uint16)
    row = 0
    for t, n in zip(texts, counts):
        raw = np.zeros((n - 1) * STRIDE + WINDOW, np.uint16)
        raw[: len(t)] = np.frombuffer(t, np.uint8)[: len(raw)]
        raw[: len(t)] += 1
        out[row : row + n] = np.lib.stride_tricks.as_strided(raw, (n, WINDOW), (raw.strides[0] * STRIDE, raw.strides[0]))
        row += n
    return out, np.repeat(np.arange(len(texts)), counts)


def training_rows(docs: DataFrame, train_rows: Column, id_col: str, text_col: str, lang_col: str, rows: int) -> DataFrame:
    """(lang, pieces): about ``rows`` documents per language by a hash threshold, SAMPLE_WINDOWS pieces of each."""
    known = docs.filter(train_rows).select(
        qcol(id_col).alias("id"), qcol(text_col).cast("string").alias("text"), qcol(lang_col).cast("string").alias("lang")
    ).filter("lang IS NOT NULL AND text <> ''")
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per language
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == F.lit(r["lang"]), F.lit(min(1.0, rows / r["n"]))).otherwise(share)
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), F.substring("text", 1, 64))), 1, 8), 16, 10)
    n = F.char_length("text")
    at = lambda i: F.floor(i * n / SAMPLE_WINDOWS).cast("int") + 1
    pieces = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)), lambda i: F.substring(F.col("text"), at(i), F.lit(WINDOW))))
    return known.filter(place.cast("double") / float(2**32) < share).select("lang", pieces.alias("pieces"))


def fit(
    docs: DataFrame, train_rows: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS
) -> ByteCnn | None:
    """Train on a bounded sample of the rows that satisfy ``train_rows``; None without any labelled text."""
    found = sorted((r["lang"], p) for r in training_rows(docs, train_rows, id_col, text_col, lang_col, rows).collect() for p in r["pieces"])
    if not found:
        return None
    classes = sorted({lang for lang, _ in found})
    index = {c: i for i, c in enumerate(classes)}
    windows = np.zeros((len(found), WINDOW), np.uint16)
    for i, (_, piece) in enumerate(found):
        raw = piece.encode("utf-8")[:WINDOW]
        windows[i, : len(raw)] = np.frombuffer(raw, np.uint8).astype(np.uint16) + 1
    return train(windows, np.array([index[lang] for lang, _ in found]), classes)


def predict(docs: DataFrame, net: ByteCnn | None, id_col: str = "doc_id", text_col: str = "text", group: int = 64) -> DataFrame:
    """(id, lang_pred, score) of every whole text.

    ``und`` with score 0 where the text is null or has no letter, or nothing
    was learned.  Rows are independent; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def classify(model: ByteCnn | None, texts: list[str | None]) -> list[tuple[str, float]]:
        known = [i for i, t in enumerate(texts) if model is not None and t and LETTER.search(t)]
        out = [(UNKNOWN, 0.0)] * len(texts)
        for lo in range(0, len(known), group):
            part = known[lo : lo + group]
            windows, owner = to_windows([texts[i].encode("utf-8") for i in part])
            logits = model.logits(windows)
            sums = np.zeros((len(part), len(model.classes)))
            np.add.at(sums, owner, logits)
            mean = sums / np.bincount(owner, minlength=len(part))[:, None]
            p = np.exp(mean - mean.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            for i, row in zip(part, p):
                best = int(row.argmax())
                out[i] = (model.classes[best], float(row[best]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = classify(shared.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=[id_col, "lang_pred", "score"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type(docs, id_col)}, lang_pred string, score double")
