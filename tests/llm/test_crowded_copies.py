"""Near copies among many texts that share a passage."""

import random

from test_corpus_operators import made_up

from labeltext.llm import neardup


def check_copies(spark, seed, texts, passage, own, **settings):
    """Each text shares a passage with all others, has words of its own and one copy at the limit."""
    r = random.Random(seed)
    word = lambda: f"u{r.randrange(10**9)}"
    common = [word() for _ in range(passage)]
    out = []
    for _ in range(texts):
        text = common + [word() for _ in range(own)]
        copy = list(text)
        # words so far apart that each change takes five shingles
        for at in r.sample(range(4, len(copy) - 4, 6), (len(copy) - 4) // 45):
            copy[at] = word()
        out += [" ".join(text), " ".join(copy)]
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    sets = [shingles(t) for t in out]
    linked = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    assert all(linked(*sets[i : i + 2]) for i in range(0, len(out), 2)) and not linked(sets[0], sets[2])
    where = {t: i for i, t in enumerate(out)}
    rows = made_up(spark, out).cache()
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(rows, k=5, **settings).collect()}
    ids = {where[r["text"]]: r["doc_id"] for r in rows.collect()}
    assert len(ids) == len(out)
    for i in range(0, len(out), 2):
        assert got[ids[i]] == got[ids[i + 1]] == min(ids[i], ids[i + 1])


def test_links_in_a_large_cluster_are_exact(spark):
    """Weak candidates connect the cluster, random blocks alone lose links."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        check_copies(spark, 1, 300, 117, 23, block_shingles=1_500)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_crowded_regions_are_settled(spark, monkeypatch):
    """Many rows that are no candidates lie between the copies; what the window does not see is joined."""
    monkeypatch.setattr(neardup, "WINDOW", 1)
    monkeypatch.setattr(neardup, "ALIKE", 0.7)  # the passage alone makes no cluster
    check_copies(spark, 2, 600, 67, 33)
