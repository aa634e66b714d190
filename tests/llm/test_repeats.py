"""Removed windows against brute force; the automaton's matching statistics; edge rows."""

import hashlib
import random

import cases
import numpy as np
import pytest
from passbook.llm import repeats
from pyspark.sql import functions as F


def brute(rows, length):
    """(id, words, removed, hash) of (id, text) rows: a word goes if a window over it starts in a smaller document."""
    words = [(LAST if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < i:
                gone |= set(range(k, k + length))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((None if i == LAST else i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


LAST = repeats.LAST
COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def passages(seed: int) -> list[tuple]:
    """Copies, near copies, shared passages at every place, one passage in most rows, periodic texts."""
    rnd = random.Random(seed)
    shared = [cases.prose(seed * 100 + k, rnd.randrange(3, 40)) for k in range(6)]
    rows = []
    for i in range(60):
        parts = [cases.prose(1000 * seed + 10 * i + k, rnd.randrange(0, 20)) for k in range(3)]
        parts.insert(rnd.randrange(4), rnd.choice(shared))
        if i % 3:
            parts.insert(rnd.randrange(5), shared[0])
        rows.append((i, " ".join(parts)))
    rows += [(100, rows[5][1]), (101, rows[5][1]), (102, rows[7][1].replace("alpha", "omega"))]
    rows += [(103, "a b " * 40), (104, "b a " * 30), (105, "a " * 50)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("length, words, chars", [(12, 60, 400), (12, 10**6, 10**8), (5, 30, 200)])
def test_equals_brute_force(spark, seed, length, words, chars):
    rows = passages(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.digests(docs, length=length, gram=4, shard_words=words, task_chars=chars)
    assert cases.bag(found, *COLUMNS) == brute(rows, length)


def test_edge_rows(spark):
    docs = cases.frame(spark, ("Rank", "mark", "spans"))
    rows = [(r[0], r[1]) for r in cases.rows()]
    found = repeats.digests(docs, length=8)
    assert cases.bag(found, *COLUMNS) == brute(rows, 8)
    kept = repeats.without_repeats(docs, length=8)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert kept.filter("text is null").count() == docs.filter("text is null").count()
    texts = [hashlib.sha256((r[0] or "").encode()).hexdigest() for r in kept.select("text").collect()]
    assert sorted(texts) == sorted(r[3] for r in brute(rows, 8))
    assert repeats.digests(cases.empty(spark)).count() == 0
    assert repeats.without_repeats(cases.empty(spark)).count() == 0


def test_repeated_rows_at_size(spark):
    """A third of all rows are one row, another third copies of it."""
    text = cases.prose(9, 80)
    rows = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") < 2000, text).otherwise(F.concat(F.lit(f"{text} "), F.col("id").cast("string"))).alias("text"),
    )
    found = repeats.digests(rows)
    assert found.filter("doc_id = 7 and n_removed = 0").count() == 1000
    assert found.filter("doc_id between 1000 and 1999 and n_removed = 80").count() == 1000
    assert found.filter("doc_id >= 2000 and n_removed = 80 and n_words = 81").count() == 1000


def test_statistics_of_the_automaton():
    rnd = random.Random(3)
    texts = [[rnd.choice(b"abc").to_bytes() for _ in range(rnd.randrange(1, 40))] for _ in range(30)]
    machine = repeats.Automaton()
    for number, words in enumerate(texts):
        machine.add(words, number)
    joined = [b"".join(w) for w in texts]
    for number, words in enumerate(texts):
        covered = set()
        for k in range(len(words) - 3):
            if any(joined[number][k : k + 4] in earlier for earlier in joined[:number]):
                covered |= set(range(k, k + 4))
        spans = machine.spans(words, number, 4)
        assert {k for a, b in spans for k in range(a, b)} == covered
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_every_window_has_its_anchor():
    rnd = np.random.default_rng(1)
    hashes = rnd.integers(1, 2**63, 500, dtype=np.uint64)
    doc = np.sort(rnd.integers(0, 6, 500))
    _, at = repeats.anchors(hashes, doc, 20, 5)
    for start in range(481):
        if doc[start] == doc[start + 19]:
            assert any(start <= p <= start + 15 for p in at)
    # the same words elsewhere have the same anchors
    again, places = repeats.anchors(np.concatenate((hashes[:7], hashes[100:200])), np.zeros(107, dtype=np.int64), 20, 5)
    alone, own = repeats.anchors(hashes[100:200], np.zeros(100, dtype=np.int64), 20, 5)
    assert set(own + 7) <= set(places) and set(alone) <= set(again)
