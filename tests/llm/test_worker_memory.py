"""Sets and toxicity look-ups hold a few texts at a time, whatever a batch has."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from labeltext.llm import neardup, textvec, toxicity

RNG = np.random.default_rng(5)
WORDS = np.array([f"w{i}" for i in range(5000)])
TEXTS = [" ".join(WORDS[RNG.integers(0, len(WORDS), 300)]) for _ in range(2000)]  # 3.4 MB


@pytest.mark.parametrize("run", [
    lambda: sum(len(h) for _, _, h in neardup.shingle_sets(pa.array(TEXTS), 5)),
    lambda: len(toxicity._looked_up(pa.array(TEXTS), np.arange(1, 100, dtype=np.uint64))[0]),
])
def test_peak_of_a_batch(run, monkeypatch):
    monkeypatch.delitem(textvec.sys.__dict__, "_word_hash_powers", raising=False)
    tracemalloc.start()
    try:
        run()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 35e6


def test_sets_do_not_depend_on_the_chunk(monkeypatch):
    texts = pa.array([*TEXTS[:50], None, "", "one two", " ".join(TEXTS[:200]), *TEXTS[50:60]])  # one is longer than a chunk
    found = []
    for size in (1_000, textvec.FEW_BYTES, 50_000_000):
        monkeypatch.setattr(neardup, "FEW_BYTES", size)
        sets = [h[b[i] : b[i + 1]].tolist() for _, b, h in neardup.shingle_sets(texts, 5) for i in range(len(b) - 1)]
        found.append(sets)
    assert found[0] == found[1] == found[2] and len(found[0]) == len(texts)
