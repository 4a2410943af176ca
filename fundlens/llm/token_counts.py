"""Token counts of whole texts by a two-tier look-up on the map side.

Tier one is a compact table of the corpus' frequent pre-tokens and their token
counts, broadcast to every worker.  Tier two is each worker's own cache: a
pre-token the table lacks is encoded once by the tokenizer's model and
remembered, for as long as the Python worker lives.  No pre-token is ever
shuffled: the frequent ones are found by bounded heavy-hitter summaries, one
per task over all of its texts, merged in a tree of fixed fan-in.  Which
pre-tokens the table holds only decides the speed, never a count.

The tokenizer is a byte-level BPE file of the ``tokenizers`` library; texts are
cut exactly as the library cuts them, its added tokens first.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import id_and_text, id_type, slices
from fundlens.llm.tokenize_bpe import byte_alphabet

# The library's byte-level pattern, and code point ranges on which
# the regex module and the library's older Unicode tables class every character alike.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ALIKE = ((0x0, 0x52F), (0x2000, 0x206F), (0x20A0, 0x20BF), (0x3000, 0x30FF), (0x4E00, 0x9FEF), (0xAC00, 0xD7A3), (0x1F300, 0x1F64F))

# Entries of the broadcast table, and characters of the longest pre-token in it:
# at most 4 bytes a character, so the broadcast stays below 8 MB for any corpus.
TABLE_ENTRIES = 32_768
TABLE_CHARS = 32
# Entries and characters per entry that a worker's cache holds; a full cache is emptied.
CACHE_ENTRIES = 262_144
CACHE_CHARS = 64
FAN_IN = 64


@dataclass(frozen=True)
class FrequentTable:
    """Frequent pre-tokens joined by U+0000 ... as one blob, and the token count of each."""

    blob: bytes
    offsets: bytes
    lengths: bytes

    @classmethod
    def pack(cls, entries: dict[str, int]) -> FrequentTable:
        import numpy as np

        raw = [k.encode() for k in entries]
        return cls(
            b"".join(raw),
            np.cumsum([0, *map(len, raw)]).astype(np.uint32).tobytes(),
            np.fromiter(entries.values(), np.uint16, len(raw)).tobytes(),
        )

    def unpack(self) -> dict[str, int]:
        import numpy as np

        at = np.frombuffer(self.offsets, np.uint32).tolist()
        keys = [self.blob[a:b].decode() for a, b in zip(at, at[1:])]
        return dict(zip(keys, np.frombuffer(self.lengths, np.uint16).tolist()))


class PreTokens:
    """Cuts a text as the tokenizer does: at its added tokens, then by the byte-level pattern."""

    def __init__(self, tokenizer_json: str):
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        pre = spec["pre_tokenizer"] or {}
        added = [t for t in spec["added_tokens"]]
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in added)
        level = pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True)
        if spec["normalizer"] or not level or not plain or spec["model"]["type"] != "BPE":
            raise ValueError("only a byte-level BPE tokenizer without normaliser or prefix space is supported")
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.find = regex.compile(PATTERN).findall
        alike = "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in ALIKE)
        self.unlike = regex.compile(f"[^{alike}]").search

    def __call__(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, number of added tokens found in the text)."""
        if self.added is None or not self.added.search(text):
            return self.cut(text), 0
        out, found, at = [], 0, 0
        for m in self.added.finditer(text):
            out += self.cut(text[at : m.start()])
            found, at = found + 1, m.end()
        return out + self.cut(text[at:]), found

    def cut(self, text: str) -> list[str]:
        if text.isascii() or not self.unlike(text):
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]


class TokenCounter:
    """One worker's two tiers: the broadcast table, then its own cache in front of the model."""

    def __init__(self, tokenizer_json: str, frequent: dict[str, int]):
        self.pretokens = PreTokens(tokenizer_json)
        self.tokenize = self.pretokens.tokenizer.model.tokenize
        self.frequent = frequent
        self.cache: dict[str, int] = {}
        self.spell = str.maketrans({chr(b): c for b, c in enumerate(byte_alphabet())})

    def encode(self, pretoken: str) -> int:
        return len(self.tokenize(pretoken.encode().decode("latin-1").translate(self.spell)))

    def miss(self, pretoken: str) -> int:
        n = self.cache.get(pretoken)
        if n is None:
            n = self.encode(pretoken)
            if len(pretoken) <= CACHE_CHARS:
                if len(self.cache) >= CACHE_ENTRIES:
                    self.cache.clear()
                self.cache[pretoken] = n
        return n

    def count(self, text: str) -> int:
        pretokens, total = self.pretokens(text)
        found = list(map(self.frequent.get, pretokens))
        if None not in found:
            return total + sum(found)
        miss = self.miss
        return total + sum([miss(p) if n is None else n for p, n in zip(pretokens, found)])


# The counter of this Python worker: tasks that follow one another in it share its cache.
_WORKER: dict[str, TokenCounter] = {}


def worker_counter(key: str, tokenizer_json: str, table: FrequentTable) -> TokenCounter:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = TokenCounter(tokenizer_json, table.unpack())
    return _WORKER[key]


def shrink(counts: dict[str, int], size: int) -> dict[str, int]:
    """A mergeable summary of ``size`` counters: the next largest count is taken off all.

    Over any number of shrinks and merges a pre-token loses at most
    all / (size + 1) occurrences, so every one more frequent than that stays.
    """
    if len(counts) <= size:
        return counts
    cut = sorted(counts.values(), reverse=True)[size]
    return {k: n - cut for k, n in counts.items() if n > cut}


def frequent_pretokens(docs: DataFrame, tokenizer_json: str, size: int = TABLE_ENTRIES, text_col: str = "text") -> DataFrame:
    """One row (pretokens, counts): the summary of at most ``size`` pre-tokens over all texts.

    Every task reads all its texts and gives one bounded row; three levels of
    FAN_IN rows each merge them, so a group holds bounded rows whatever the
    corpus.  An empty table gives no row.
    """
    cut = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    schema = "slot long, pretokens array<string>, counts array<long>"

    def row(slot: int, counts: dict[str, int]) -> dict:
        return {"slot": [slot], "pretokens": [list(counts)], "counts": [list(counts.values())]}

    arrow = pa.schema([("slot", pa.int64()), ("pretokens", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pretokens, counts = PreTokens(cut.value), Counter()
        for batch in batches:
            for part in slices(batch, 0):
                for text in part.column(0):
                    counts.update(pretokens(text.as_py() or "")[0])
                if len(counts) > 4 * size:
                    counts = Counter(shrink({k: n for k, n in counts.items() if len(k) <= TABLE_CHARS}, size))
        kept = shrink({k: n for k, n in counts.items() if len(k) <= TABLE_CHARS}, size)
        yield pa.RecordBatch.from_pydict(row(TaskContext.get().partitionId(), kept), schema=arrow)

    def merge(group: pa.Table) -> pa.Table:
        counts: Counter = Counter()
        for keys, values in zip(group.column("pretokens"), group.column("counts")):
            for k, n in zip(keys.as_py(), values.as_py()):
                counts[k] += n
        slot = min(group.column("slot").to_pylist())
        return pa.Table.from_pydict(row(slot, shrink(counts, size)), schema=arrow)

    out = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(summarise, schema)
    for width in (FAN_IN, FAN_IN**2):
        out = out.groupBy(F.floor(F.col("slot") / width).alias("g")).applyInArrow(merge, schema)
    return out.groupBy(F.lit(0).alias("g")).applyInArrow(merge, schema).select("pretokens", "counts")


def frequent_table(docs: DataFrame, tokenizer_path: str, size: int = TABLE_ENTRIES, text_col: str = "text") -> FrequentTable:
    """The broadcast table of ``docs``: at most ``size`` frequent pre-tokens with their token counts.

    It may be kept and used for other tables too; a foreign table only costs speed.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    row = frequent_pretokens(docs, tokenizer_json, size, text_col).first()  # one row of bounded size
    counter = TokenCounter(tokenizer_json, {})
    lengths = {p: counter.encode(p) for p in (row.pretokens if row else [])}
    return FrequentTable.pack(lengths)


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 1024,
    table: FrequentTable | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text.

    n_bytes counts UTF-8 bytes, n_tokens the tokens as the library's default
    gives them (no begin, end or padding; the string of an added token counts
    as that one token), over_limit tells n_tokens > ``limit``.  A null text
    counts as empty: 0 bytes, 0 tokens.  Rows are independent: repeated rows
    and ids give repeated results, a null id stays null, an empty table gives
    an empty result; other columns are ignored whatever their names.  Long
    texts are counted whole, a megabyte of text or one text at a time.
    ``table`` is by default the :func:`frequent_table` of ``docs``.
    """
    if table is None:
        table = frequent_table(docs, tokenizer_path, text_col=text_col)
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    sc = docs.sparkSession.sparkContext
    shared, key = sc.broadcast((tokenizer_json, table)), f"{sc.applicationId}:{hash((tokenizer_json, table.blob))}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(key, *shared.value)
        for batch in batches:
            for part in slices(batch, 1):
                counts = [counter.count(t.as_py() or "") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                    names=[id_col, "n_bytes", "n_tokens", "over_limit"],
                )

    rows = id_and_text(docs, id_col, text_col)
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return rows.mapInArrow(run, f"`{id_col}` {id_type(docs, id_col)}, n_bytes long, n_tokens long, over_limit boolean")
