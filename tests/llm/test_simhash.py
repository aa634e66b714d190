import re

import cases
import numpy as np
import pytest
import xxhash
from passbook.llm import simhash
from passbook.llm.components import components
from pyspark.sql import functions as F


def expected_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected_components(rows, radius=3):
    """(id, fingerprint, least id of the component) by comparing all pairs."""
    prints = [(i, expected_fingerprint(t)) for i, t in rows]
    label = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= radius:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    out = []
    for k, (i, f) in enumerate(prints):
        ids = [prints[j][0] for j in range(len(prints)) if label[j] == label[k] and prints[j][0] is not None]
        out.append((i, f"{f:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


def near_rows():
    """Groups whose texts differ in one of many words, so their fingerprints are a few bits apart."""
    out = []
    for group in range(6):
        words = cases.prose(100 + group, 600).split()
        for k in range(12):
            changed = list(words)
            if k:
                changed[(k * 47) % 600] = f"changed{group}{k % 7}"
            out.append((group * 100 + k, " ".join(changed)))
    return out


@pytest.mark.parametrize("tile", [2, 5, 2048])
def test_equals_all_pairs(spark, tile):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = cases.bag(simhash.near_duplicates(docs, tile=tile), "doc_id", "fingerprint", "component_id")
    assert found == expected_components(rows)
    assert len({r[2] for r in found}) < len({r[1] for r in found})  # links between different texts


def test_edge_rows(spark):
    docs = cases.frame(spark, ("fp", "root", "component_id", "cell"))
    found = cases.bag(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id")
    assert found == expected_components([r[:2] for r in cases.rows()])
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


def test_keep_one(spark):
    docs = cases.frame(spark, ("simhash_id", "fp"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {}
    for row in cases.rows():
        groups.setdefault(expected_fingerprint(row[1]), []).append(row[0])
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(groups)
    # a group's least id stays, once; a group without ids keeps one of its rows
    assert sorted(ids, key=repr) == sorted((min((i for i in g if i is not None), default=None) for g in groups.values()), key=repr)
    assert simhash.keep_one(cases.empty(spark)).count() == 0


def test_tile_links_connect_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 6), dtype=np.uint64)
    nodes = np.unique(np.concatenate((base, *(base ^ np.bitwise_xor.reduce(flips[:, :k], axis=1) for k in range(1, 7)))))

    def parts(pairs):
        label = {int(n): int(n) for n in nodes}
        for a, b in pairs:
            old, new = label[int(a)], label[int(b)]
            label = {n: new if x == old else x for n, x in label.items()}
        groups = {}
        for n, x in label.items():
            groups.setdefault(x, set()).add(n)
        return sorted(map(sorted, groups.values()))

    pairs = [(a, b) for k, a in enumerate(nodes) for b in nodes[:k] if np.bitwise_count(a ^ b) <= 3]
    assert parts(zip(*simhash.tile_links(nodes, None, 3))) == parts(pairs)
    left, right = nodes[::2], nodes[1::2]
    across = [(a, b) for a in left for b in right if np.bitwise_count(a ^ b) <= 3]
    assert parts(zip(*simhash.tile_links(left, right, 3))) == parts(across)


def test_cells_meet_within_radius(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(200):
        a = int(rng.integers(-(2**63), 2**63))
        b = a
        for bit in rng.choice(64, 3, replace=False):
            b ^= -(1 << 63) if bit == 63 else 1 << int(bit)
        rows += [(k, a), (k, b)]
    cells = spark.createDataFrame(rows, "pair int, fp long").select("pair", "fp", F.explode(simhash._cells(3)).alias("c"))
    met = cells.groupBy("pair", "c").count().filter("count > 1").select("pair").distinct()
    assert met.count() == 200


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(k, 200) for k in range(100, 140)] + [(300, 301), (301, 300), (400, 400)]
    found = dict(cases.bag(components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert {found[k] for k in range(61)} == {0}
    assert {found[k] for k in [*range(100, 140), 200]} == {100}
    assert found[301] == found[300] == 300 and 400 not in found
