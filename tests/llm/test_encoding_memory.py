"""A worker that encodes holds some texts at a time, and little once its task has ended."""

import sys
import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa

from labeltext.llm import bpe

RNG = np.random.default_rng(7)
WORDS = np.array([f"w{i}" for i in range(5000)])
TEXTS = [" ".join(WORDS[RNG.integers(0, len(WORDS), 300)]) for _ in range(2000)]  # 3.4 MB


class Docs:
    """What encode_texts asks of a table; mapInArrow hands back the workers' function."""

    schema = {"doc_id": SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "bigint"))}

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_peak_of_a_batch_and_what_is_left(monkeypatch):
    monkeypatch.delitem(sys.__dict__, "_bpe_codec", raising=False)
    run = bpe.encode_texts(Docs(), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], ["doc_id", "text"])
    assert sum(b.num_rows for b in run(iter([batch.slice(0, 10)]))) == 10  # makes the codec
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(TEXTS) and peak < 35e6
    assert not sys.__dict__["_bpe_codec"]["codec"].stretches
