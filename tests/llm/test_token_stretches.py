"""Stretches of a batch reach the tokenizers library a few texts at a time, with the ids of whole texts."""

import json
import random
import struct

import public_tokenizers
import pyarrow as pa

from labeltext.llm import tokenfile

with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
    MODEL = f.read()
PARTS = ["word", "Word.", "it's", "naïve", "слово", "слово,", "漢字。", "x²y", "12,5", "a\nb", "a b", " x", "x ", "​", "\u0085q",
         "<|endoftext|>", "a<|endoftext|>b", "Ġa", "☃", "𝄞!", "é", "", "\n", "q" * 90, "!?", "ſt", "'s", "\x1c", "ª", "ǅ"]


def by_library(model, texts):
    from tokenizers import Tokenizer

    coded = Tokenizer.from_str(model).encode_batch_fast(texts, add_special_tokens=False)
    return [struct.pack(f"<{len(c)}I", *c.ids) for c in coded]


def texts(n, seed):
    pick = random.Random(seed)
    return [" ".join(pick.choices(PARTS, k=pick.randrange(12))) for _ in range(n)]


def test_ids_are_those_of_whole_texts(monkeypatch):
    monkeypatch.setattr(tokenfile, "JOINED", 5)
    some, coder = texts(400, 3), tokenfile.Encoder(MODEL)
    for lo in range(0, 400, 100):  # known stretches and new ones
        assert coder.encode(pa.array(some[lo : lo + 100])) == by_library(MODEL, some[lo : lo + 100])


def test_vocabulary_without_the_space():
    parts = json.loads(MODEL)
    model = parts["model"]
    model["vocab"] = {t: i for t, i in model["vocab"].items() if "Ġ" not in t}
    model["merges"] = [m for m in model["merges"] if "Ġ" not in "".join(m)]
    model, some = json.dumps(parts), texts(100, 4)
    assert tokenfile.Encoder(model).encode(pa.array(some)) == by_library(model, some)


def test_the_library_gets_few_texts():
    coder, given = tokenfile.Encoder(MODEL), []

    class Counting:
        def encode_batch_fast(self, some, **options):
            given.extend(some)
            return model.encode_batch_fast(some, **options)

    model, coder.model = coder.model, Counting()
    some = [" ".join(["слово", *(f"сл{'ов' * (i % 40)}{'а' * (i // 40)}" for i in range(lo, lo + 200)), *(f"w{'or' * i}d" for i in range(30))])
            for lo in range(0, 1000, 200)]
    assert coder.encode(pa.array(some)) == by_library(MODEL, some)
    assert len(given) <= 10
