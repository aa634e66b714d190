"""The trie against brute force, whatever the blocks are; rebuilding; edge rows."""

import binascii
import hashlib
import random

import cases
import pytest
from passbook.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turns_of(rows):
    def digest(role, text):
        return hashlib.md5((hashlib.md5((role or "").encode()).hexdigest() + (text or "")).encode()).hexdigest()

    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is not None, turn or 0, digest(role, text))
            own.setdefault(conv, []).append((key, (role or "", text or "")))
    return {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}


def brute(rows):
    own = turns_of(rows)
    built = {}
    for c, turns in own.items():
        h = binascii.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members, children = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
            if d:
                children.setdefault(turns[: d - 1], set()).add(turns[:d])

    def below(node):
        stack = [node]
        while stack:
            node = stack.pop()
            yield node
            stack += children.get(node, ())

    out = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(built[c]) == len(node))
        inside = list(below(node))
        out.append(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, ())),
                sum(n not in children for n in inside), sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in inside),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def random_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(1000), 60) + [0, 100, 300]:
        for turn in range(rnd.randrange(0, 8)):
            rows.append((c, turn, rnd.choice(["user", "assistant"]), rnd.choice(["a", "bé", "", "c\nd"])))
    rnd.shuffle(rows)
    return rows


def _convs(found):
    return cases.bag(found, *COLUMNS)


@pytest.mark.parametrize("seed, blocks", [(0, 10_000), (1, 7), (2, 1), (3, 2)])
def test_equals_brute_force(spark, seed, blocks):
    rows = random_rows(seed)
    found = prefixtrie.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), block_rows=blocks)
    assert _convs(found) == brute(rows)


def test_edge_rows(spark):
    rows = [
        (None, 1, "user", "x"), (100, None, None, None), (100, None, "user", "b"), (100, 1, "user", "same"), (100, 1, "user", "same"),
        (101, 5, None, ""), (101, 2, "user", "y" * 300_000), (102, -1, "", None), (205, 0, "user", "only"), (206, 0, "user", "only"),
        (207, 0, "user", "only"), (300, 0, "system", "\0"), (301, 3, "a", "bc"), (302, 3, "ab", "c"), (2**40, 0, "user", "z"),
    ]
    rows += [(301 + k, 3, "a", "bc") for k in range(2, 60)]
    frame = spark.createDataFrame([(*r, "x", b"y") for r in rows], f"{SCHEMA}, key string, ends binary")
    assert _convs(prefixtrie.conversation_trie(frame, block_rows=3)) == brute(rows)
    assert prefixtrie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefixtrie.conversation_trie(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)).count() == 0


def test_long_chain_and_equal_conversations(spark):
    """Five hundred equal conversations and deep ones that part late, over many blocks."""
    deep = [(t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(120)]
    rows = [(c, *t) for c in range(1000, 1005) for t in deep[: 100 + c % 7]]
    rows += [(c, 0, "user", "hello") for c in range(2000, 2500)]
    assert _convs(prefixtrie.conversation_trie(spark.createDataFrame(rows, SCHEMA), block_rows=2)) == brute(rows)
