"""The sequence classifier against the same steps in one numpy process."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labeltext.operators import neural


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    out = []
    for i in range(160):
        label = i % 3
        words = rng.integers(1, 7, rng.integers(0, 9)).tolist() + [7 + label] * int(rng.integers(1, 3))
        out.append((i, words + [0] * (12 - len(words)) if i % 2 else words, label, i % 5 == 0))
    return spark.createDataFrame(out, "doc_id bigint, seq array<int>, label int, is_val boolean").repartition(5)


def settings(**more):
    return {"n_classes": 3, "num_words": 10, "dim": 6, "units": 5, "epochs": 4, "batches": 3, "rate": 0.05, **more}


def by_hand(rows, seed=42, **s):
    """The history and the kept weights, batch by batch in numpy."""
    marked = [rows.withColumn("b", F.pmod(F.xxhash64("doc_id", F.lit(e), F.lit(seed)), F.lit(s["batches"]))).collect()
              for e in range(1, s["epochs"] + 1)]
    w = neural.fresh(s["num_words"] + 1, s["dim"], s["units"], s["n_classes"], seed)
    adam, history, best = neural.Adam(w, s["rate"]), [], (np.inf, 0, None)

    def p_of(r):
        x = np.mean([w.embedding[t] for t in r.seq if t], axis=0)
        h = np.maximum(x @ w.hidden + w.hidden_bias, 0)
        e = np.exp(h @ w.out + w.out_bias)
        return x, h, e / e.sum()

    for epoch, table in enumerate(marked, 1):
        loss = right = n = 0
        for b in range(s["batches"]):
            total, mine = neural.Weights(*(np.zeros_like(p) for p in w.parts())), [r for r in table if not r.is_val and r.b == b]
            for r in mine:
                x, h, p = p_of(r)
                loss, right = loss - np.log(p[r.label]), right + (p.argmax() == r.label)
                d = p - np.eye(s["n_classes"])[r.label]
                total.out += np.outer(h, d)
                total.out_bias += d
                d = (w.out @ d) * (h > 0)
                total.hidden += np.outer(x, d)
                total.hidden_bias += d
                words = [t for t in r.seq if t]
                for t in words:
                    total.embedding[t] += (w.hidden @ d) / len(words)
            for p in total.parts():
                p /= len(mine)
            adam.move(w, total)
            n += len(mine)
        val = [(-np.log(p_of(r)[2][r.label]), p_of(r)[2].argmax() == r.label) for r in table if r.is_val]
        history.append((epoch, loss / n, right / n, np.mean([v[0] for v in val]), np.mean([v[1] for v in val])))
        if history[-1][3] < best[0]:
            best = history[-1][3], epoch, w.copy()
    return history, best


def test_history_equals_numpy(rows):
    got = neural.fit_sequences(rows, **settings())
    history, best = by_hand(rows, **settings())
    assert np.allclose(got.history, history, atol=1e-9) and got.best_epoch == best[1]
    for a, b in zip(got.weights.parts(), best[2].parts()):
        assert np.allclose(a, b, atol=1e-9)


def test_learns_and_keeps_the_best(spark, rows):
    model = neural.fit_sequences(rows, **settings(epochs=12))
    table = model.history_table(spark).collect()
    assert [r.epoch for r in table] == list(range(1, 13)) and sum(r.kept for r in table) == 1
    assert min(r.val_loss for r in table) == next(r.val_loss for r in table if r.kept)
    assert table[-1].train_loss < table[0].train_loss
    odd = rows.unionByName(spark.createDataFrame([(900, None, 0, True), (901, [], 1, True)], rows.schema))
    predicted = model.predict(odd).collect()
    assert len(predicted) == rows.count() + 2
    assert np.mean([r.prediction == r.label for r in predicted]) > 0.95
    assert all(abs(sum(r.probability) - 1) < 1e-9 for r in predicted)


def test_odd_tables(spark, rows):
    empty = neural.fit_sequences(rows.limit(0), **settings())
    assert empty.history == [] and empty.best_epoch == 0
    no_val = neural.fit_sequences(rows.withColumn("is_val", F.lit(False)), **settings(epochs=2))
    assert all(h[1] == h[3] for h in no_val.history)
    with pytest.raises(ValueError, match="weights"):
        neural.fit_sequences(rows, 3, 10**7)
