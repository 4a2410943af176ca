"""Ranked lexical search by Block-Max MaxScore over a segmented inverted index.

:func:`build_index` turns every partition of the documents into index segments
of a bounded amount of text, without a shuffle: postings in blocks of 128,
byte-packed, each block with its first and last document and the competitive
(tf, length) pairs from which its exact maximum follows for any corpus
statistics.  :func:`search` gives every task the queries and its segments.
Lists whose global bounds together stay below the query's threshold are
non-essential; candidates come from the essential lists alone, block maxima of
the non-essential lists reject them before those blocks are unpacked, and what
is left is scored exactly.  A task carries its thresholds from segment to
segment; the small result heaps of all tasks are merged at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlens.llm.common import id_and_text, id_type
from fundlens.session import scratch_path

BLOCK = 128
# Text that one segment covers at most (one document at least).
SEGMENT_BYTES = 8 << 20
# Row group of the stored index, so that few segments are in memory at once.
ROW_GROUP_BYTES = 16 << 20
# Terms of the queries that one search job broadcasts; more queries run as several jobs.
QUERY_BYTES = 16 << 20

# Separators become spaces and A-Z lower case; bytes from 0x80 on belong to terms.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


# Bytes of a text that are split at a time.
SPLIT_BYTES = 4 << 20


def terms(text: str | None) -> pa.Array:
    """The terms of a text in order: maximal runs of letters, digits and non-ASCII characters."""
    raw = (text or "").encode().translate(FOLD)
    parts, at = [], 0
    while at < len(raw):
        end = raw.find(b" ", at + SPLIT_BYTES)
        end = len(raw) if end < 0 else end
        parts.append(pa.array(raw[at:end].split(), pa.binary()))
        at = end
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def length_norm(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """100 - 75 + (75 * n * docs) div total, in exact integers."""
    if len(n) and 75 * int(n.max()) * docs >= 2**63:
        return np.array([25 + 75 * int(x) * docs // total for x in n], np.int64)
    return 25 + (75 * n.astype(np.int64) * docs) // max(total, 1)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m): grows with tf, falls with m."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def term_weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# ------------------------------------------------------------------- index

# The arrays of a segment: per document its length, per term its first block, per block its documents,
# postings, byte widths, place in the payload and first competitive pair, and the pairs themselves.
ARRAYS = {
    "doc_len": np.int32,
    "term_df": np.int32,
    "term_block": np.int32,
    "block_first": np.int32,
    "block_last": np.int32,
    "block_count": np.uint8,
    "doc_width": np.uint8,
    "tf_width": np.uint8,
    "pair_start": np.int32,
    "pair_tf": np.int32,
    "pair_len": np.int32,
    "payload": np.uint8,
}
SEGMENT_SCHEMA = "n_docs long, n_terms long, ids binary, vocabulary binary, " + ", ".join(f"{n} binary" for n in ARRAYS)


def _ipc(array: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([array], names=["v"])
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_ipc(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_all().column(0).combine_chunks()


def _width(values: np.ndarray) -> np.ndarray:
    return np.where(values < 1 << 8, 1, np.where(values < 1 << 16, 2, 4)).astype(np.uint8)


def pack_segment(ids: pa.Array, texts: list[pa.Array]) -> dict[str, object]:
    """One index segment of documents that have terms; documents are numbered by ascending id, null first."""
    order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    lens = np.array([len(t) for t in texts], np.int64)
    words = pa.concat_arrays(texts).dictionary_encode()
    codes = words.indices.to_numpy().astype(np.int64)
    n_docs, n_terms = len(order), len(words.dictionary)
    postings, tf = np.unique(codes * n_docs + np.repeat(place, lens), return_counts=True)
    term, doc = postings // n_docs, postings % n_docs
    doc_len = lens[order]
    term_df = np.bincount(term, minlength=n_terms)
    start = np.concatenate([[0], np.cumsum(term_df)[:-1]])
    in_list = np.arange(len(doc)) - start[term]
    first = np.flatnonzero(in_list % BLOCK == 0)
    count = np.diff(np.append(first, len(doc)))
    block = np.repeat(np.arange(len(first)), count)
    in_block = np.arange(len(doc)) - first[block]
    last = first + count - 1
    delta = np.diff(doc, prepend=0)
    delta[first] = 0
    doc_width, tf_width = _width(np.maximum.reduceat(delta, first)), _width(np.maximum.reduceat(tf, first))
    size = count * (doc_width.astype(np.int64) + tf_width)
    at = np.concatenate([[0], np.cumsum(size)])
    payload = np.zeros(at[-1], np.uint8)
    for values, width, base in ((delta, doc_width, at[:-1]), (tf, tf_width, at[:-1] + count * doc_width)):
        spot = base[block] + in_block * width[block]
        for k in range(4):
            has = width[block] > k
            payload[spot[has] + k] = (values[has] >> (8 * k)) & 255
    # competitive pairs of a block: by falling tf, those shorter than all before them
    n = doc_len[doc]
    by = np.lexsort((n, -tf, block))
    big = int(n.max()) + 1
    keyed = n[by] - block[by] * big  # falls from block to block, so the running minimum starts anew in each
    low = np.minimum.accumulate(keyed)
    best = np.ones(len(by), bool)
    best[1:] = keyed[1:] < low[:-1]
    pairs = by[best]
    arrays = {
        "doc_len": doc_len,
        "term_df": term_df,
        "term_block": np.searchsorted(first, start),
        "block_first": doc[first],
        "block_last": doc[last],
        "block_count": count,
        "doc_width": doc_width,
        "tf_width": tf_width,
        "pair_start": np.searchsorted(block[pairs], np.arange(len(first))),
        "pair_tf": tf[pairs],
        "pair_len": n[pairs],
        "payload": payload,
    }
    row = {"n_docs": n_docs, "n_terms": int(lens.sum()), "ids": _ipc(ids.take(pa.array(order))), "vocabulary": _ipc(words.dictionary)}
    return row | {k: v.astype(ARRAYS[k]).tobytes() for k, v in arrays.items()}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Index segments of every whole text, one row each, made where the documents are read.

    Documents without a term (null, empty, punctuation only) are not in it.
    Rows with equal ids are separate documents; ids may have any ordered type.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0

        def segment() -> pa.RecordBatch:
            row = pack_segment(pa.concat_arrays(ids), texts)
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                raw = text.as_py()
                found = terms(raw)
                if not len(found):
                    continue
                if held and held + len(raw) > segment_bytes:
                    yield segment()
                    ids, texts, held = [], [], 0
                ids.append(batch.column(0).slice(i, 1))
                texts.append(found)
                held += len(raw)
        if ids:
            yield segment()

    arrow = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.binary()), ("vocabulary", pa.binary())])
    for name in ARRAYS:
        arrow = arrow.append(pa.field(name, pa.binary()))
    return id_and_text(docs, id_col, text_col).mapInArrow(run, SEGMENT_SCHEMA)


def store_index(index: DataFrame) -> DataFrame:
    """The index written to the shared folder and read back."""
    spark, path = index.sparkSession, scratch_path(index.sparkSession, "lexical-index")
    index.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    return spark.read.schema(index.schema).parquet(path)


# ------------------------------------------------------------------ search


class Segment:
    """A segment opened for one corpus: block maxima are exact for its ``docs`` and ``total``."""

    def __init__(self, row: dict, docs: int, total: int):
        self.ids = _from_ipc(row["ids"])
        self.vocabulary = _from_ipc(row["vocabulary"])
        for name, kind in ARRAYS.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.norm = length_norm(self.doc_len, docs, total)
        pair = impact(self.pair_tf, length_norm(self.pair_len, docs, total))
        self.block_max = np.maximum.reduceat(pair, self.pair_start)
        self.term_max = np.maximum.reduceat(self.block_max, self.term_block)
        self.term_end = np.append(self.term_block[1:], len(self.block_first))
        count = self.block_count.astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(count * (self.doc_width.astype(np.int64) + self.tf_width))])
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def unpack(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of the postings in some blocks of one list, ascending."""
        count = self.block_count[blocks].astype(np.int64)
        owner = np.repeat(np.arange(len(blocks)), count)
        starts = np.cumsum(count) - count
        within = np.arange(len(owner)) - starts[owner]

        def read(base: np.ndarray, width: np.ndarray) -> np.ndarray:
            spot, out = base[owner] + within * width[owner], np.zeros(len(owner), np.int64)
            for k in range(int(width.max())):
                has = width[owner] > k
                out[has] |= self.payload[spot[has] + k].astype(np.int64) << (8 * k)
            return out

        widths, at = self.doc_width[blocks].astype(np.int64), self.at[blocks]
        steps = np.cumsum(read(at, widths))
        doc = steps - steps[starts][owner] + self.block_first[blocks][owner]  # a block's first step is 0
        tf = read(at + count * widths, self.tf_width[blocks].astype(np.int64))
        return doc, impact(tf, self.norm[doc])

    def whole(self, code: int) -> tuple[np.ndarray, np.ndarray]:
        """All postings of a term, unpacked once per segment."""
        if code not in self.known:
            self.known[code] = self.unpack(np.arange(self.term_block[code], self.term_end[code]))
        return self.known[code]


def score_candidates(seg: Segment, codes: np.ndarray, weights: np.ndarray, essential: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of all documents in the lists from ``essential`` on that reach ``floor``.

    ``codes`` ascend by their lists' bounds.  Candidates come from the essential lists;
    block maxima of the others reject them first, then what remains is scored exactly.
    """
    acc = np.zeros(len(seg.norm), np.int64)
    for code, weight in zip(codes[essential:].tolist(), weights[essential:].tolist()):
        doc, value = seg.whole(code)
        acc[doc] += weight * value
    cand = np.flatnonzero(acc > 0)
    score = acc[cand]
    rest = list(range(essential - 1, -1, -1))  # strongest first
    alive = score + sum(int(weights[t]) * int(seg.term_max[codes[t]]) for t in rest) >= floor
    cand, score = cand[alive], score[alive]
    bounds, blocks = np.zeros((len(rest), len(cand)), np.int64), np.full((len(rest), len(cand)), -1, np.int64)
    for r, t in enumerate(rest):
        lo, hi = int(seg.term_block[codes[t]]), int(seg.term_end[codes[t]])
        b = lo + np.searchsorted(seg.block_last[lo:hi], cand)
        inside = (b < hi) & (seg.block_first[np.minimum(b, hi - 1)] <= cand)
        blocks[r, inside] = b[inside]
        bounds[r, inside] = int(weights[t]) * seg.block_max[b[inside]]
    left = bounds.sum(axis=0)
    for r, t in enumerate(rest):
        alive = score + left >= floor
        cand, score, left, bounds, blocks = cand[alive], score[alive], left[alive], bounds[:, alive], blocks[:, alive]
        left = left - bounds[r]
        here = np.flatnonzero(blocks[r] >= 0)
        if not len(here):
            continue
        code = int(codes[t])
        doc, value = seg.known[code] if code in seg.known else seg.unpack(np.unique(blocks[r, here]))
        spot = np.minimum(np.searchsorted(doc, cand[here]), len(doc) - 1)
        hit = doc[spot] == cand[here]
        score[here[hit]] += int(weights[t]) * value[spot[hit]]
    keep = score >= max(floor, 1)
    return cand[keep], score[keep]


def best_of(doc: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, equal ones by ascending document."""
    by = np.lexsort((doc, -score))[:k]
    return doc[by], score[by]


def search_segment(seg: Segment, codes: np.ndarray, weights: np.ndarray, floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment's ``k`` best documents of one query that score at least ``floor``."""
    bound = weights * seg.term_max[codes]
    by = np.argsort(bound, kind="stable")
    codes, weights, bound = codes[by], weights[by], bound[by]
    if floor == 0:
        # a first threshold: the documents of the strongest lists, until there are k
        df = np.cumsum(seg.term_df[codes][::-1])
        strong = len(codes) - 1 - int(np.searchsorted(df, k)) if df[-1] > k else 0
        if strong > 0:
            _, seen = best_of(*score_candidates(seg, codes, weights, strong, 0), k)
            floor = int(seen[-1]) if len(seen) == k else 0
    # lists that cannot reach the threshold even all together; a tie may still win by its id
    essential = int(np.searchsorted(np.cumsum(bound), floor))
    if essential >= len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return best_of(*score_candidates(seg, codes, weights, essential, floor), k)


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term, times) of every query; rows that share an id are one query, equal rows count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                found = terms(text.as_py())
                owner = pa.array(np.full(len(found), i))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), found], names=["item", "term"])

    rows = id_and_text(queries, id_col, text_col).distinct()
    split = rows.mapInArrow(run, f"item {id_type(queries, id_col)}, term binary")
    return split.groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 10,
    query_id_col: str = "item_id",
    query_text_col: str = "text",
    id_col: str = "doc_id",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query id, rank, id, score): each query's ``k`` best documents of a stored ``index``, score above 0.

    Equal scores go by ascending id, null first.  Queries without a term, or
    whose terms no document has, have no row; rows that share a query id are one
    query.  Queries are dealt into as many jobs as their terms need at
    ``query_bytes`` each; an empty table on either side gives an empty result.
    """
    spark = index.sparkSession
    items = query_terms(queries, query_id_col, query_text_col).persist()
    try:
        need = items.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
        blocks = max(1, math.ceil(need / query_bytes))
        stats = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("total")).first()
        ids = index.select("ids").head()
        kind = _from_ipc(ids.ids).type if ids else pa.int64()
        parts = []
        for b in range(blocks if ids else 0):
            rows = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow()
            if rows.num_rows:
                parts.append(_search_block(index, rows, stats.docs, stats.total, k, kind))
    finally:
        items.unpersist()
    named = [F.col("item").alias(query_id_col), F.col("rank"), F.col("id").alias(id_col), F.col("score")]
    if not parts:
        from pyspark.sql.pandas.types import from_arrow_type

        schema = f"item {id_type(queries, query_id_col)}, rank int, id {from_arrow_type(kind).simpleString()}, score long"
        return spark.createDataFrame([], schema).select(*named)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(*named)


def _document_counts(index: DataFrame, words: pa.Array) -> np.ndarray:
    """How many documents hold each of ``words``."""
    shared = index.sparkSession.sparkContext.broadcast(_ipc(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _from_ipc(shared.value)
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for vocabulary, df in zip(batch.column(0), batch.column(1)):
                code = pc.index_in(wanted, value_set=_from_ipc(vocabulary.as_py()))
                has = pc.is_valid(code).to_numpy(zero_copy_only=False)
                total[has] += np.frombuffer(df.as_py(), np.int32)[code.drop_null().to_numpy()]
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(total[has])], names=["word", "df"])

    counted = index.select("vocabulary", "term_df").mapInArrow(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df"))
    out = np.zeros(len(words), np.int64)
    table = counted.toArrow()  # at most one row per query term
    out[table.column("word").to_numpy()] = table.column("df").to_numpy()
    return out


def _search_block(index: DataFrame, rows: pa.Table, docs: int, total: int, k: int, id_kind: pa.DataType) -> DataFrame:
    """(item, id, score): candidates for the best ``k`` of one block of queries, at most a few per item and task."""
    words = rows.column("term").combine_chunks().dictionary_encode()
    df = _document_counts(index, words.dictionary)
    weight = np.array([term_weight(docs, int(d)) if d else 0 for d in df], np.int64)
    owner = rows.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
    codes = words.indices.to_numpy().astype(np.int64)
    by = np.argsort(owner.indices.to_numpy(), kind="stable")
    starts = np.searchsorted(owner.indices.to_numpy()[by], np.arange(len(owner.dictionary) + 1))
    times = rows.column("times").to_numpy()[by]
    item_kind, names = owner.dictionary.type, _ipc(owner.dictionary)
    shared = index.sparkSession.sparkContext.broadcast((names, _ipc(words.dictionary), codes[by], weight[codes[by]] * times, starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vocabulary, codes, weights, starts = shared.value
        wanted, items = _from_ipc(vocabulary), len(starts) - 1
        held: list[list[tuple[pa.Array, np.ndarray]]] = [[] for _ in range(items)]
        top = np.zeros((items, k), np.int64)  # the best scores so far, ascending
        for batch in batches:
            for row in range(batch.num_rows):
                seg = Segment({n: batch.column(n)[row].as_py() for n in batch.schema.names}, docs, total)
                code = pc.fill_null(pc.index_in(wanted, value_set=seg.vocabulary), -1).to_numpy()
                for item in range(items):
                    span = slice(starts[item], starts[item + 1])
                    here, weight = code[codes[span]].astype(np.int64), weights[span]
                    use = (here >= 0) & (weight > 0)
                    if not use.any():
                        continue
                    doc, score = search_segment(seg, here[use], weight[use], int(top[item, 0]), k)
                    if len(doc):
                        held[item].append((seg.ids.take(pa.array(doc)), score))
                        top[item] = np.sort(np.concatenate([top[item], score]))[-k:]
        names = _from_ipc(names)
        for item in range(items):
            for ids, score in held[item]:
                keep = np.flatnonzero(score >= top[item, 0])
                if len(keep):
                    same = names.take(pa.array(np.full(len(keep), item)))
                    yield pa.RecordBatch.from_arrays([same, ids.take(pa.array(keep)), pa.array(score[keep])], names=["item", "id", "score"])

    from pyspark.sql.pandas.types import from_arrow_type

    schema = f"item {from_arrow_type(item_kind).simpleString()}, id {from_arrow_type(id_kind).simpleString()}, score long"
    return index.mapInArrow(run, schema)


def top_documents(docs: DataFrame, queries: DataFrame, k: int = 10, **columns: str) -> DataFrame:
    """:func:`search` over a fresh, stored index of ``docs`` (``id_col``, ``text_col``, ``query_id_col``, ``query_text_col``)."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    index = store_index(build_index(docs, id_col, text_col))
    return search(index, queries, k, columns.get("query_id_col", "item_id"), columns.get("query_text_col", "text"), id_col)
