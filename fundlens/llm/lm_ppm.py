"""Language-model scoring: prediction by partial matching over bytes, and a unigram base.

The model is the trie of all byte contexts up to ORDER bytes of the training
texts with the counts of what followed.  A byte is predicted by its longest
context; one never seen there escapes (method C: the number of different
followers over that number plus their total) to the next shorter context, where
the followers already ruled out are excluded, down to equal chances.  As the
pretrained trie is fixed, the probability of a follower in a context is one
number, so texts only need a lookup per distinct (context, follower).

Work is spread by what a block of text asks for.  Each task cuts its rows into
blocks and writes their distinct codes, dealt into buckets by code, next to
the block's packed text.  Buckets merge the counts of all blocks; contexts
then turn counts into probabilities, grouped by their last two bytes (shorter
contexts are one table of at most 2^16 counts); buckets answer each block's
codes; and a block sums the answers per text.  No table of the corpus is
broadcast or held in one place, and everything gathered grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.llm.common import written
from fundlens.llm.shingles import mix, word_hashes

ORDER = 4
BLOCK_BYTES = 4 << 20
START, END = 0xFE, 0xFF  # byte values that UTF-8 never uses: before a text, after a text
SYMBOLS = 255  # every byte value but START
END_WORD = np.uint64(1)
GRAM, WORD, TEXT = 0, 1, 2

PACKED = "kind int, bucket int, block string, codes binary, amounts binary"


def gram_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(code, text index) of every predicted symbol: ORDER bytes of context and the symbol, END after each text."""
    raw = np.frombuffer(b"".join(bytes([START]) * ORDER + t + bytes([END]) for t in texts), np.uint8)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + ORDER + 1 for t in texts])
    code = np.zeros(max(0, len(raw) - ORDER), np.uint64)
    for k in range(ORDER + 1):
        code <<= np.uint64(8)
        code |= raw[k : len(raw) - ORDER + k]
    predicted = raw[ORDER:] != START
    return code[predicted], owner[ORDER:][predicted]


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(code, text index) of every word and of one end token per text."""
    codes, owners, lo = [np.full(len(texts), END_WORD)], [np.arange(len(texts), dtype=np.int32)], 0
    sums = np.cumsum([len(t) for t in texts])
    while lo < len(texts):  # about a megabyte at a time, for the working arrays' sake
        hi = max(lo + 1, int(np.searchsorted(sums, (sums[lo - 1] if lo else 0) + (1 << 20), side="right")))
        h, owner = word_hashes(texts[lo:hi])
        codes.append(h)
        owners.append((owner + lo).astype(np.int32))
        lo = hi
    return np.concatenate(codes), np.concatenate(owners)


def bucket_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(codes) % np.uint64(buckets)).astype(np.int64)


def _distinct_grams(codes: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and how often each occurs in training texts; one in-place sort."""
    codes <<= np.uint64(1)
    codes |= train
    codes.sort()
    counted = (codes & np.uint64(1)).astype(np.uint8)
    codes >>= np.uint64(1)
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[starts], np.add.reduceat(counted, starts, dtype=np.int64)


def _distinct_words(codes: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(at, weights=train, minlength=len(distinct)).astype(np.int64)


def _dealt(codes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by (bucket, code) and where each bucket starts in it."""
    b = bucket_of(codes, buckets)
    order = np.argsort(b, kind="stable")
    return order, np.searchsorted(b[order], np.arange(buckets + 1))


def _squeezed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kind, bucket, block, codes, values = zip(*rows) if rows else ((), (), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(block, pa.string()), pa.array(codes, pa.binary()), pa.array(values, pa.binary())],
        names=["kind", "bucket", "block", "codes", "amounts"],
    )


def _to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _binary(column: pa.Array) -> list[bytes]:
    return [t.as_py() or b"" for t in column.cast(pa.binary())]


def blocks(rows: DataFrame, buckets: int, block_bytes: int) -> DataFrame:
    """PACKED rows of (id, text, train): per block its text, and per bucket its codes with training counts."""

    def close(batches: list[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        texts = _binary(table.column(1))
        train = np.asarray(table.column(2).fill_null(False).cast(pa.uint8()))
        yield _packed([(TEXT, -1, name, _to_ipc(table.select(["id", "text"])), b"")])
        for kind, make, count in ((GRAM, gram_codes, _distinct_grams), (WORD, word_codes, _distinct_words)):
            codes, owner = make(texts)
            distinct, counts = count(codes, train[owner])
            del codes, owner
            order, starts = _dealt(distinct, buckets)
            out = []
            for b in range(buckets):
                part = order[starts[b] : starts[b + 1]]
                if len(part):
                    out.append((kind, b, name, _squeezed(distinct[part]), _squeezed(counts[part])))
            yield _packed(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        place = TaskContext.get().partitionId()
        for batch in batches:
            lengths = np.diff(np.frombuffer(batch.column(1).cast(pa.large_binary()).buffers()[1], np.int64)[batch.column(1).offset :][: batch.num_rows + 1])
            lo = 0
            while lo < batch.num_rows:  # cut where a block is full
                hi = lo + max(1, int(np.searchsorted(np.cumsum(lengths[lo:]), max(1, block_bytes - size), side="right")))
                hi = min(hi, batch.num_rows)
                held.append(batch.slice(lo, hi - lo))
                size += int(lengths[lo:hi].sum())
                lo = hi
                if size >= block_bytes or lo < batch.num_rows:
                    yield from close(held, f"{place}-{number}")
                    pa.default_memory_pool().release_unused()
                    held, size, number = [], 0, number + 1
        if held:
            yield from close(held, f"{place}-{number}")

    return rows.select("id", "text", "train").mapInArrow(run, PACKED)


def _codes_of(blob) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob.as_py()), np.uint64)


def _amounts_of(blob, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob.as_py()), dtype)


def merge_counts(packed: DataFrame) -> DataFrame:
    """(kind, bucket, codes, amounts, total, seen): per bucket the counts of all blocks summed."""

    def run(table: pa.Table) -> pa.Table:
        codes = np.concatenate([_codes_of(c) for c in table["codes"]])
        counts = np.concatenate([_amounts_of(c, np.int64) for c in table["amounts"]])
        distinct, at = np.unique(codes, return_inverse=True)
        sums = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
        return pa.table(
            {
                "kind": table["kind"][:1], "bucket": table["bucket"][:1],
                "codes": pa.array([_squeezed(distinct)], pa.binary()), "amounts": pa.array([_squeezed(sums)], pa.binary()),
                "total": pa.array([int(sums.sum())], pa.int64()), "seen": pa.array([int((sums > 0).sum())], pa.int64()),
            }
        )

    schema = "kind int, bucket int, codes binary, amounts binary, total long, seen long"
    return packed.groupBy("kind", "bucket").applyInArrow(run, schema)


def _followers(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of (context, symbol) keys: distinct keys, their counts, contexts, their totals and numbers of followers, context of each key."""
    key, at = np.unique(keys, return_inverse=True)
    count = np.bincount(at, weights=counts, minlength=len(key))
    context, of = np.unique(key >> np.uint64(8), return_inverse=True)
    return key, count, context, np.bincount(of, weights=count, minlength=len(context)), np.bincount(of, minlength=len(context)), of


def _find(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each wanted value in sorted ``values`` and whether it is there."""
    if not len(values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return at, values[at] == wanted


def log_probabilities(codes: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of each code's symbol in its context.

    ``codes`` must hold all codes of every order-2 context in them;  ``pairs``
    are the (256, 256) training counts of (previous byte, symbol).
    """
    out = np.zeros(len(codes))
    open_ = np.ones(len(codes), bool)  # not predicted yet
    sums, ruled_out = np.zeros(len(codes)), np.zeros(len(codes))  # of the followers excluded at the coming order
    known = counts > 0
    single = pairs.sum(0)
    symbol = (codes & np.uint64(0xFF)).astype(np.int64)
    last = ((codes >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)

    def level(total, different, count, seen_context):
        """One order: predict, escape, or pass on where nothing is left to say."""
        n, d = total - sums, different - ruled_out
        acts = open_ & seen_context & (d > 0)
        hit = acts & (count > 0)
        out[hit] += np.log10(count[hit] / (n + d)[hit])
        miss = acts & ~hit
        out[miss] += np.log10(d[miss] / (n + d)[miss])
        open_[hit] = False

    mask = lambda k: np.uint64((1 << (8 * (k + 1))) - 1)
    for k in range(ORDER, 1, -1):
        mine = codes & mask(k)
        key, count, context, total, different, of = _followers(mine[known], counts[known])
        at, there = _find(key, mine)
        ctx, seen = _find(context, mine >> np.uint64(8))
        if not len(key):
            continue
        level(total[ctx], different[ctx], np.where(there, count[at], 0), seen)
        # what this context's followers make up in the next shorter one
        if k > 2:
            short, short_count = _followers(codes[known] & mask(k - 1), counts[known])[:2]
            weight = short_count[_find(short, key & mask(k - 1))[0]]
        else:
            weight = pairs[((key >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64), (key & np.uint64(0xFF)).astype(np.int64)]
        excluded = np.bincount(of, weights=weight, minlength=len(context))
        sums = np.where(seen, excluded[ctx], 0.0)
        ruled_out = np.where(seen, different[ctx], 0)
    level(pairs.sum(1)[last], (pairs > 0).sum(1)[last], pairs[last, symbol], pairs.sum(1)[last] > 0)
    seen = pairs.sum(1)[last] > 0
    sums = np.where(seen, ((pairs > 0) * single[None]).sum(1)[last], 0.0)
    ruled_out = np.where(seen, (pairs > 0).sum(1)[last], 0)
    level(np.full(len(codes), single.sum()), np.full(len(codes), (single > 0).sum()), single[symbol], np.full(len(codes), single.sum() > 0))
    out[open_] -= np.log10(SYMBOLS - (single > 0).sum()) if open_.any() else 0.0
    return out


def gram_table(merged: DataFrame, buckets: int) -> DataFrame:
    """(kind, bucket, codes, amounts): the log probability of every gram code, dealt like the counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, counts in zip(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array(_codes_of(codes).view(np.int64)), pa.array(_amounts_of(counts, np.int64))], names=["code", "n"])

    grams = merged.filter(F.col("kind") == GRAM).select("codes", "amounts").mapInArrow(rows, "code long, n long")
    last_two = grams.groupBy(F.col("code").bitwiseAND(0xFFFF).alias("pair")).agg(F.sum("n").alias("n")).filter("n > 0")
    pairs = np.zeros((256, 256))
    for r in last_two.collect():  # at most 2^16 rows
        pairs[r["pair"] >> 8, r["pair"] & 0xFF] = r["n"]
    shared = merged.sparkSession.sparkContext.broadcast(pairs)

    def score(table: pa.Table) -> pa.Table:
        codes, counts = table["code"].to_numpy().view(np.uint64), table["n"].to_numpy()
        logs = log_probabilities(codes, counts, shared.value).astype(np.float32)
        order, starts = _dealt(codes, buckets)
        parts = [(b, order[starts[b] : starts[b + 1]]) for b in range(buckets) if starts[b + 1] > starts[b]]
        return pa.table(
            {
                "kind": pa.array([GRAM] * len(parts), pa.int32()), "bucket": pa.array([b for b, _ in parts], pa.int32()),
                "codes": pa.array([_squeezed(codes[p]) for _, p in parts], pa.binary()),
                "amounts": pa.array([_squeezed(logs[p]) for _, p in parts], pa.binary()),
            }
        )

    context = F.pmod(F.xxhash64(F.shiftright("code", 8).bitwiseAND(0xFFFF)), F.lit(buckets)).alias("context")
    return grams.select(context, "code", "n").groupBy("context").applyInArrow(lambda t: score(t.select(["code", "n"])), "kind int, bucket int, codes binary, amounts binary")


def answers(packed: DataFrame, table: DataFrame) -> DataFrame:
    """PACKED rows: for each block and bucket the table's number for each of its codes, in their order."""

    def run(asked: pa.Table, known: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return _packed_table([])
        kind, bucket = asked["kind"][0].as_py(), asked["bucket"][0].as_py()
        dtype = np.float32 if kind == GRAM else np.int64
        codes = np.concatenate([_codes_of(c) for c in known["codes"]])
        values = np.concatenate([_amounts_of(v, dtype) for v in known["amounts"]])
        order = np.argsort(codes)
        codes, values = codes[order], values[order]
        out = [(kind, bucket, b.as_py(), b"", _squeezed(values[np.searchsorted(codes, _codes_of(c))])) for b, c in zip(asked["block"], asked["codes"])]
        return _packed_table(out)

    left, right = (x.groupBy("kind", "bucket") for x in (packed.select("kind", "bucket", "block", "codes"), table))
    return left.cogroup(right).applyInArrow(run, PACKED)


def _packed_table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_packed(rows)])


def _answered(distinct: np.ndarray, replies: dict[int, np.ndarray], buckets: int) -> np.ndarray:
    """The answers to a block's distinct codes, back in the order of the codes."""
    order, _ = _dealt(distinct, buckets)
    values = np.concatenate([replies[b] for b in sorted(replies)])
    back = np.empty(len(distinct), values.dtype)
    back[order] = values
    return back


def gram_sums(texts: list[bytes], replies: dict[int, np.ndarray], buckets: int) -> np.ndarray:
    """Each text's sum of the answers to its gram codes; (code, text) pairs are sorted in place."""
    codes, owner = gram_codes(texts)
    codes <<= np.uint64(24)  # a block has fewer than 2^24 texts, a code 40 bits
    codes |= owner.astype(np.uint32)
    del owner
    codes.sort()
    owner = (codes & np.uint64(0xFFFFFF)).astype(np.int32)
    codes >>= np.uint64(24)
    new = np.concatenate([[True], codes[1:] != codes[:-1]])
    values = _answered(codes[new], replies, buckets)
    at = np.cumsum(new, dtype=np.int32)
    del codes, new
    return np.bincount(owner, weights=values[at - 1], minlength=len(texts))


def sum_blocks(packed: DataFrame, replies: DataFrame, buckets: int, train_tokens: int, vocabulary: int, id_type: str) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every text of every block."""

    def run(table: pa.Table) -> pa.Table:
        text, got = None, {GRAM: {}, WORD: {}}
        for kind, bucket, codes, values in zip(*(table[c] for c in ("kind", "bucket", "codes", "amounts"))):
            if kind.as_py() == TEXT:
                text = pa.ipc.open_stream(codes.as_py()).read_all().combine_chunks()
            else:
                got[kind.as_py()][bucket.as_py()] = _amounts_of(values, np.float32 if kind.as_py() == GRAM else np.int64)
        texts = _binary(text["text"].combine_chunks())
        n = len(texts)
        words, owner = word_codes(texts)
        log_all = np.log10(train_tokens + vocabulary + 1)
        distinct, at = np.unique(words, return_inverse=True)
        c = _answered(distinct, got[WORD], buckets)
        known = np.bincount(owner, weights=(c > 0)[at], minlength=n)
        base = np.bincount(owner, weights=(np.log10(c + 1.0) - log_all)[at], minlength=n)
        score = gram_sums(texts, got[GRAM], buckets)
        return pa.table(
            {
                "id": text["id"], "n_tokens": pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                "n_known": pa.array(np.rint(known).astype(np.int64)), "base_score": pa.array(base), "score": pa.array(score),
            }
        )

    both = packed.filter(F.col("kind") == TEXT).unionByName(replies)
    return both.groupBy("block").applyInArrow(run, f"id {id_type}, n_tokens long, n_known long, base_score double, score double")


def bucket_count(spark: SparkSession) -> int:
    """Two buckets per shuffle partition: they grow with what the session expects to shuffle."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def score_documents(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, buckets: int | None = None
) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every whole text, learning where ``train`` holds.

    base_score sums log10((c + 1) / (N + V + 1)) over the words (A-Z folded)
    and one end token; score is the byte model's log10 probability of the text
    and its end.  A null text counts as empty.  Repeated rows count and score
    each; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    buckets = buckets or bucket_count(spark)
    text = F.coalesce(qcol(text_col).cast("string"), F.lit(""))
    rows = docs.select(qcol(id_col).alias("id"), text.alias("text"), train.alias("train"))
    packed = written(blocks(rows, buckets, block_bytes), "blocks")
    asked = packed.filter(F.col("kind") != TEXT)
    merged = written(merge_counts(asked), "merged")
    totals = merged.filter(F.col("kind") == WORD).agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.coalesce(F.sum("seen"), F.lit(0)).alias("v")).first()
    table = gram_table(merged, buckets).unionByName(merged.filter(F.col("kind") == WORD).select("kind", "bucket", "codes", "amounts"))
    id_type = docs.schema[id_col].dataType.simpleString()
    scored = sum_blocks(packed, answers(asked, table), buckets, totals["n"], totals["v"], id_type)
    return scored.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(totals["n"]).cast("long").alias("train_tokens"), "base_score", "score")
