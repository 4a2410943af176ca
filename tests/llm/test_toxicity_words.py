"""Every word that marks toxic text is in the dictionary, whatever the size of the sample."""

import random

import pytest
from pyspark.sql import functions as F

from fundlens.llm import toxicity

# the alphabet's first word is what a tail of the sorted samples loses first
MARKS = ["aaabadword", "horridword", "zzzinsult", *(f"mark{a}{b}" for a in "bd" for b in "aeiou")]


@pytest.mark.parametrize("repeat", [8, 80])
def test_dictionary_holds_every_chosen_word(documents, spark, repeat):
    rng = random.Random(3)
    vocab = [f"{a}{b}{c}" for a in "bdfklm" for b in "aeiou" for c in ("ran", "tel", "mis", "pon", "gur")]
    rows, labels = [], []
    for i in range(300):
        text = [rng.choice(vocab) for _ in range(150)]
        if i % 2:
            for _ in range(repeat):
                text.insert(rng.randrange(len(text)), rng.choice(MARKS))
        rows.append((i, " ".join(text), "en", "a"))
        labels.append((i, i % 2))
    chosen = []
    words = toxicity.toxic_words
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "toxic_words", lambda sample: chosen.extend(words(sample)) or list(chosen))
        model = toxicity.fit(documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    assert len(chosen) >= 3
    held = model.toxic.decode(errors="replace").split()
    assert sorted(held) == sorted(chosen)  # each once
