"""Byte-level BPE through a sentencepiece model built from a rank vocabulary.

The model is serialised straight from the ranks: every vocabulary entry becomes
a piece spelled with one printable character per byte, scored by its negative
rank, with identity normalisation, so sentencepiece's best-score-first merges
are the lowest-rank-first merges of byte-level BPE.  The text is first cut by
the vocabulary's pattern; each distinct pre-token of about 1 MB of text is encoded once.
Decoding looks the ids up in the inverse mapping and joins their bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from fundlens.llm.common import id_and_text, id_type, slices

# Pre-tokens whose ids a task remembers; older ones are forgotten and encoded again.
CACHE_ENTRIES = 200_000


def byte_alphabet() -> list[str]:
    """One printable character per byte: itself where it is visible Latin-1, else U+0100 onwards."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(moved)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries in rank order from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    entries = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(entries) != list(range(len(entries))):
        raise ValueError("ranks must be 0..n-1")
    return [entries[i] for i in range(len(entries))]


def build_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ids are the ranks (unknown piece last)."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    alphabet = byte_alphabet()
    model = pb.ModelProto()
    for rank, token in enumerate(tokens):
        piece = model.pieces.add()
        piece.piece = "".join(alphabet[b] for b in token)
        piece.score = -float(rank)
        piece.type = pb.ModelProto.SentencePiece.NORMAL
    unknown = model.pieces.add()
    unknown.piece, unknown.score, unknown.type = "<unk>", 0.0, pb.ModelProto.SentencePiece.UNKNOWN
    trainer = model.trainer_spec
    trainer.model_type = pb.TrainerSpec.BPE
    trainer.vocab_size = len(model.pieces)
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(tokens), -1, -1, -1
    trainer.byte_fallback = False
    normalizer = model.normalizer_spec
    normalizer.name = "identity"
    normalizer.add_dummy_prefix = False
    normalizer.remove_extra_whitespaces = False
    normalizer.escape_whitespaces = False
    return model.SerializeToString()


class ByteBpe:
    """Encoder and decoder of one task over the serialised model."""

    def __init__(self, model: bytes, pattern: str, cache_entries: int = CACHE_ENTRIES):
        import regex
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        alphabet = byte_alphabet()
        n = self.processor.get_piece_size() - 1
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self.token_bytes = [bytes(byte_of[c] for c in self.processor.id_to_piece(i)) for i in range(n)]
        self.whole = {t: i for i, t in enumerate(self.token_bytes)}
        self.to_piece = str.maketrans({chr(b): alphabet[b] for b in range(256)})
        self.find = regex.compile(pattern).findall
        self.cache: dict[str, tuple[int, ...]] = {}
        self.cache_entries = cache_entries

    def encode_pretokens(self, pretokens: list[str]) -> None:
        """Fill the cache; an entry of the vocabulary is its own id, as the rank encoder has it."""
        todo = []
        for p in pretokens:
            raw = p.encode("utf-8")
            rank = self.whole.get(raw)
            if rank is None:
                todo.append((p, raw.decode("latin-1").translate(self.to_piece)))
            else:
                self.cache[p] = (rank,)
        if todo:
            # one thread: by default every call starts and ends a thread per core of the machine
            for (p, _), ids in zip(todo, self.processor.encode([m for _, m in todo], out_type=int, num_threads=1)):
                self.cache[p] = tuple(ids)

    def encode_texts(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text; pre-tokens that are not remembered are encoded in one call for all of them."""
        found = [self.find(t) for t in texts]
        if len(self.cache) > self.cache_entries:
            self.cache.clear()
        missing = set().union(*found).difference(self.cache)
        if missing:
            self.encode_pretokens(list(missing))
        for pretokens in found:
            yield list(chain.from_iterable(map(self.cache.__getitem__, pretokens)))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_texts([text]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


def _coder(docs: DataFrame, vocab_path: str, pattern: str):
    """A function giving each task its ByteBpe; the model (about 1 MB) is read once by the driver."""
    model = docs.sparkSession.sparkContext.broadcast(build_model(read_ranks(vocab_path)))
    return lambda: ByteBpe(model.value, pattern)


def encode_documents(
    docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>) of every whole text; a null text counts as empty and gives no ids.

    Rows are independent, so repeated rows give repeated results and an empty
    table gives an empty result.
    """
    make = _coder(docs, vocab_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = make()
        for batch in batches:
            for part in slices(batch, 1):  # a bounded number of ids at a time
                ids = list(bpe.encode_texts([t or "" for t in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type(docs, id_col)}, ids array<int>")


def decode_documents(encoded: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary): the bytes of an ``ids`` column; null ids give empty bytes."""
    make = _coder(encoded, vocab_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = make()
        for batch in batches:
            out = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=[id_col, "decoded"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {id_type(encoded, id_col)}, decoded binary")


def encode_digest(
    docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode every whole text, decode the ids, digest both.

    ids_sha256 is over the decimal ids joined by commas, decoded_sha256 over
    the decoded bytes.  Null texts count as empty.
    """
    make = _coder(docs, vocab_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = make()
        decimal = [str(i) for i in range(len(bpe.token_bytes))]
        for batch in (part for b in batches for part in slices(b, 1)):
            counts, id_sums, text_sums = [], [], []
            for ids in bpe.encode_texts([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(len(ids))
                id_sums.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_sums.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"`{id_col}` {id_type(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
