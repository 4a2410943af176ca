"""The encoder asks sentencepiece once for all texts of a batch, on one thread."""

from fundlens.llm import tokenize_bpe
from fundlens.llm.queries import vocabulary


class Counting:
    def __init__(self, processor):
        self.processor, self.calls = processor, []

    def encode(self, pieces, **options):
        self.calls.append(options.get("num_threads"))
        return self.processor.encode(pieces, **options)


def test_one_call_on_one_thread_for_all_texts():
    path, pattern = vocabulary()
    model = tokenize_bpe.build_model(tokenize_bpe.read_ranks(path))
    texts = ["", "zqxj wvkq", " Toanoredan zqxj", "éonenè 123\n\n  x", "wvkq" * 40]
    alone = [tokenize_bpe.ByteBpe(model, pattern).encode(t) for t in texts]
    bpe = tokenize_bpe.ByteBpe(model, pattern)
    bpe.processor = Counting(bpe.processor)
    assert list(bpe.encode_texts(texts)) == alone
    assert bpe.processor.calls == [1]
    assert [bpe.decode(ids).decode() for ids in alone] == texts
