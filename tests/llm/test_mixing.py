import hashlib
import re
from collections import defaultdict

import cases
import pytest
from passbook.llm import mixing
from pyspark.sql import functions as F


def expected_targets(sizes):
    """Targets by handing out the excess again and again, as the definition says."""
    total = sum(sizes.values())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, full = dict.fromkeys(sizes, 0.0), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = [s for s in sizes if s not in full]
        for s in free:
            target[s] = left * weight[s] / sum(weight[x] for x in free)
        above = [s for s in free if target[s] > 3 * sizes[s]]
        if not above:
            return target
        for s in above:
            full.add(s)
            target[s] = float(3 * sizes[s])


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected_taken(rows):
    """(id, size, taken) by walking every queue word by word."""
    sizes, queues = defaultdict(int), defaultdict(list)
    for i, text, source in rows:
        sizes[source] += size_of(text)
        inner = hashlib.md5((text or "").encode()).hexdigest()
        key = hashlib.md5(f"7|{'' if i is None else i}|{inner}".encode()).hexdigest()
        queues[source].append((key, i is not None, i, size_of(text)))
    targets, out = expected_targets(sizes), []
    for source, queue in queues.items():
        queue.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        taken, at = [0] * len(queue), 0
        for _ in range(3):
            for k, (_, _, _, size) in enumerate(queue):
                taken[k] += max(0, min(size, int(targets[source]) - at))
                at += size
        out += [(i, size, t) for (_, _, i, size), t in zip(queue, taken)]
    return sorted(out, key=repr)


def skewed(n=400):
    rows = [(k, cases.prose(k, 1 + k * 37 % 90), "hot" if k % 3 == 0 else f"s{k % 11}") for k in range(n)]
    return rows + [(n, cases.prose(n, 3), "tiny"), (n + 1, cases.prose(n, 4000), None)]


@pytest.mark.parametrize("bucket_rows", [3, 4096])
def test_taken_equals_walk(spark, bucket_rows):
    rows = skewed()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    found = mixing.taken_words(mixing.queue(docs, bucket_rows=bucket_rows))
    assert cases.bag(found, "doc_id", "size", "taken") == expected_taken(rows)
    targets = expected_targets({s: sum(size_of(t) for _, t, x in rows if x == s) for s in {r[2] for r in rows}})
    for row in found.select("source_size", "target").distinct().collect():
        assert any(row.target == pytest.approx(t) for t in targets.values())


def test_edge_rows(spark):
    docs = cases.frame(spark, ("size", "target", "taken", "key"))
    rows = [(r[0], r[1], r[3]) for r in cases.rows()]
    found = mixing.taken_words(mixing.queue(docs))
    assert cases.bag(found, "doc_id", "size", "taken") == expected_taken(rows)
    assert mixing.taken_words(mixing.queue(cases.empty(spark))).count() == 0
    assert all(r.taken <= 3 * r.size for r in found.collect())


def test_mix_is_ordered_and_near_targets(spark):
    rows = skewed()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mix_key", F.lit(1))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    served = defaultdict(int)
    passes = defaultdict(int)
    for r in mixed.collect():
        served[r.source] += size_of(r.text)
        passes[r.doc_id] += 1
    sizes = {s: sum(size_of(t) for _, t, x in rows if x == s) for s in {r[2] for r in rows}}
    longest = {s: max(size_of(t) for _, t, x in rows if x == s) for s in sizes}
    for source, target in expected_targets(sizes).items():
        assert abs(served[source] - target) <= longest[source] / 2 + 1
    assert max(passes.values()) <= 3
    assert cases.bag(mixed, "doc_id") == cases.bag(mixing.mix(docs.repartition(3)), "doc_id")


def expected_passes(rows):
    """(id, source) → how often the mix takes it: a copy of a row is in a pass if half of its words are within the target."""
    sizes, queues = defaultdict(int), defaultdict(list)
    for i, text, source in rows:
        sizes[source] += size_of(text)
        inner = hashlib.md5((text or "").encode()).hexdigest()
        key = hashlib.md5(f"7|{'' if i is None else i}|{inner}".encode()).hexdigest()
        queues[source].append((key, i is not None, i, size_of(text)))
    targets, out = expected_targets(sizes), defaultdict(int)
    for source, queue in queues.items():
        at = 0
        for number in range(3):
            for _, _, i, size in sorted(queue, key=lambda x: (x[0], x[1], x[2] or 0)):
                out[i, source] += number == 0 if size == 0 else at + size / 2 <= targets[source]
                at += size
    return {k: n for k, n in out.items() if n}


def mixed_passes(df):
    return {(r.doc_id, r.source): r["count"] for r in df.groupBy("doc_id", "source").count().collect()}


def test_identical_rows_are_served_in_turn(spark):
    rows = [(1, "a b c d", "s")] * 10 + [(2, " ".join(["w"] * 400), "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    queues = mixing.queue(docs)
    assert mixed_passes(mixing.mix(docs)) == expected_passes(rows)
    for range_rows in (3, 4096):
        taken = mixing.taken_words(queues, range_rows=range_rows)
        assert cases.bag(taken, "doc_id", "size", "taken") == expected_taken(rows)
    assert mixing.mix(cases.empty(spark)).count() == 0


def test_one_id_and_text_in_several_sources(spark):
    """Each source serves its own rows only."""
    rows = [(1, "a b c d e f", s) for s in "abc"] + [(1, "a b c d e f", "b")] * 3 + [(2, cases.prose(3, 90), "a"), (3, "x", None)]
    rows += [(1, "a b c d e f", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    mixed = mixing.mix(docs)
    assert mixed_passes(mixed) == expected_passes(rows)
    assert mixed_passes(mixing.mix(cases.frame(spark, ("size", "target", "key")))) == expected_passes(
        [(r[0], r[1], r[3]) for r in cases.rows()]
    )


def test_a_hundred_thousand_identical_rows(spark):
    rows = spark.range(100_000, numPartitions=8).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    rows = rows.unionByName(spark.createDataFrame([(2, "w " * 60_000, "t")], rows.schema))
    queues = mixing.queue(rows)
    taken = mixing.taken_words(queues).filter("doc_id = 1").agg(F.count("*"), F.sum("taken"), F.max("taken"), F.min("taken")).first()
    target = queues.filter("doc_id = 1").first().target
    assert (taken[0], taken[1]) == (100_000, int(target)) and taken[2] - taken[3] <= 3
    served = mixing.mix(rows).filter("doc_id = 1").count()
    assert abs(3 * served - target) <= 3


def test_plans_run_no_python(spark):
    docs = cases.frame(spark)
    for found in (mixing.mix(docs), mixing.taken_words(mixing.queue(docs))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
