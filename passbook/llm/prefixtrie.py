"""Conversation prefix trie: union-find over sorted-neighbour common prefixes, forests merged across partitions.

Conversations are sequences of turns; a turn is known by the digest of its role and text. Every distinct
sequence of first turns is a node of the trie.

1. Equal sequences become one row, so a conversation that a third of all share costs one row.
2. The rows are range-sorted by their digests. Rows that share a prefix stand next to each other, and what
   two neighbours share (their longest common prefix, LCP) is an edge between them.
3. A task takes its rows in blocks of bounded size. It joins the edges in descending depth by union-find;
   each merge of two components is a branching node, and what lies between it and its parent is a chain.
4. A node whose rows end inside a block is finished there. Only prefixes of a block's first and last row can
   go on in another block: they are the contracted forest, keyed by the digest of the prefix, and are merged
   by an aggregation over all blocks. Sums over their subtrees are made by doubling steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passbook.llm.columns import quoted
from passbook.workspace import stored

#: Conversations of one hundred share the opening of the first; up to five turns of it.
GROUP = 100
OPENINGS = 6
#: Distinct sequences, and bytes of their digests, of one block.
BLOCK_ROWS = 20_000
BLOCK_BYTES = 32_000_000
#: Ids of one chunk of a node's list differ in so many low bits.
CHUNK_BITS = 16
DIGEST = 16  # bytes
EMPTY = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's (digest, length) in order of turn, null turns first.

    Null role or text is empty. Rows of one turn number come in the order of their digests, so that any order of
    arrival gives the same result. Rows without ``conv_id`` belong to no conversation and take no part.
    """
    role, text = (F.coalesce(quoted(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.md5(role.cast("binary")), text).cast("binary"))
    turn = F.struct(
        quoted("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("length")
    )
    each = conversations.select(quoted("conv_id").cast("long").alias("conv_id"), turn.alias("t")).filter("conv_id is not null")
    gathered = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return gathered.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"], t["length"])))


def rebuilt(turns: DataFrame, group: int = GROUP, openings: int = OPENINGS) -> DataFrame:
    """Conversations with the first h turns of their group's first one, h = crc32 of the id's decimals mod ``openings``."""
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(openings)).cast("int")
    heads = turns.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, openings - 1).alias("head")
    )
    joined = turns.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % group).join(heads, "head_id", "left")
    none = F.array().cast(turns.schema["turns"].dataType)
    head = F.coalesce(F.slice("head", F.lit(1), taken), none)
    own = F.filter("turns", lambda _, k: k >= taken)
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def _common(a: bytes, b: bytes) -> int:
    """Digests at the start that two rows share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    low, high = 0, n // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * DIGEST] == b[: middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


def prefix_keys(key: bytes) -> list[bytes]:
    """A digest of every prefix, the empty one first."""
    running, out = hashlib.md5(usedforsecurity=False), []
    out.append(running.digest())
    for k in range(0, len(key), DIGEST):
        running.update(key[k : k + DIGEST])
        out.append(running.digest())
    return out


class _Node:
    __slots__ = ("depth", "low", "high", "n", "conv", "children", "row", "end", "leaves", "saved")

    def __init__(self, depth: int, low: int, high: int, n: int, conv: int, row: int, end):
        self.depth, self.low, self.high, self.n, self.conv, self.row, self.end = depth, low, high, n, conv, row, end
        self.children: list[_Node] = []
        self.leaves = self.saved = 0


def forest(keys: list[bytes], counts: list[int], convs: list[int]) -> _Node:
    """The compact trie of sorted distinct rows: branching nodes and row ends, by union-find in descending depth."""
    tops = [_Node(len(key) // DIGEST, i, i, counts[i], convs[i], i, i) for i, key in enumerate(keys)]
    label = list(range(len(keys)))

    def find(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    edges = sorted(((_common(a, b), i) for i, (a, b) in enumerate(zip(keys, keys[1:]))), key=lambda e: -e[0])
    for depth, i in edges:
        left, right = find(i), find(i + 1)
        a, b = tops[left], tops[right]
        if a.depth == depth:
            node, parts = a, (b.children if b.depth == depth else [b])
            node.end = b.end if b.depth == depth and b.end is not None else node.end
        elif b.depth == depth:
            node, parts = b, [a]
        else:
            node, parts = _Node(depth, a.low, b.high, 0, a.conv, a.row, None), [a, b]
        node.low, node.high = a.low, b.high
        node.n, node.conv = a.n + b.n, min(a.conv, b.conv)
        node.children += parts
        label[right] = left
        tops[left] = node
    return tops[find(0)]


NODES = (
    "open boolean, block string, key binary, parent_key binary, depth long, conv_id long, parent_conv long, n_convs long, "
    "n_children long, n_leaves long, saved long, own long, ends binary"
)
_KINDS = [
    ("open", pa.bool_()), ("block", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()),
    ("conv_id", pa.int64()), ("parent_conv", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved", pa.int64()), ("own", pa.int64()), ("ends", pa.binary()),
]


def block_nodes(block: str, keys: list[bytes], counts: list[int], convs: list[int], lengths: list[list[int]]) -> Iterator[tuple]:
    """All trie nodes of a block, see ``NODES``; open ones with what their finished children hold."""
    last = len(keys) - 1
    root = forest(keys, counts, convs)
    order, stack = [], [(root, -1)]
    parents: dict[int, _Node | None] = {id(root): None}
    while stack:
        node, above = stack.pop()
        order.append((node, above))
        for child in node.children:
            parents[id(child)] = node
            stack.append((child, node.depth))
    upto: dict[int, list[int]] = {}

    def running(row: int) -> list[int]:
        if row not in upto:
            sums = [0]
            for n in lengths[row]:
                sums.append(sums[-1] + n)
            upto[row] = sums
        return upto[row]

    prefixes = {row: prefix_keys(keys[row]) for row in {0, last}}
    is_open = lambda node: node.low == 0 or node.high == last
    for node, above in reversed(order):  # children before parents
        done = [c for c in node.children if not is_open(c)]
        node.leaves = sum(c.leaves for c in done) or int(not node.children and not is_open(node))
        node.saved = sum(c.saved for c in done)  # children's sums hold their chains already
        sums = running(node.row)
        end = hashlib.md5(keys[node.end], usedforsecurity=False).digest() if node.end is not None else None
        if is_open(node):
            names = prefixes[0 if node.low == 0 else last]
            for depth in range(above + 1, node.depth + 1):
                bottom = depth == node.depth
                yield (
                    True, block, names[depth], names[depth - 1] if depth else None, depth, node.conv, None, node.n,
                    len(done) if bottom else 0, node.leaves if bottom else 0, node.saved if bottom else 0,
                    sums[depth] - sums[depth - 1] if depth else 0, end if bottom else None,
                )
            continue
        below, parent = node.saved, parents[id(node)]
        for depth in range(above + 1, node.depth + 1):
            top, bottom = depth == above + 1, depth == node.depth
            parent_key = parent_conv = None
            if not top:
                parent_conv = node.conv
            elif is_open(parent):
                parent_key = prefixes[0 if parent.low == 0 else last][parent.depth]
            else:
                parent_conv = parent.conv
            yield (
                False, block, None, parent_key, depth, node.conv, parent_conv, node.n, len(node.children) if bottom else 1,
                node.leaves, below + (node.n - 1) * (sums[node.depth] - sums[depth - 1]), 0, end if bottom else None,
            )
        node.saved = below + (node.n - 1) * (sums[node.depth] - sums[above])


def _blocks(rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: tuple[list, ...] = ([], [], [], [])

        def emit() -> Iterator[pa.RecordBatch]:
            out: list[tuple] = []
            for node in block_nodes(f"{part}-{number}", *held):
                out.append(node)
                if len(out) == 50_000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

        used = 0
        for batch in batches:
            for key, n, conv, lengths in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if held[0] and (len(held[0]) >= rows or used >= size):
                    yield from emit()
                    number, used, held = number + 1, 0, ([], [], [], [])
                for column, value in zip(held, (key, n, conv, lengths)):
                    column.append(value)
                used += len(key)
        if held[0]:
            yield from emit()

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), _KINDS)], [name for name, _ in _KINDS]
    )


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, which come sorted; one chunk is held at a time."""
    here, running = None, None
    schema = ["ends", "ends_sha256"]
    for batch in batches:
        out = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != here:
                if here is not None:
                    out.append((here, running.hexdigest()))
                here, running = name, hashlib.sha256(text.encode())
            else:
                running.update(b"," + text.encode())
        columns = list(zip(*out)) if out else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], schema)
    if here is not None:
        yield pa.RecordBatch.from_arrays([pa.array([here], pa.binary()), pa.array([running.hexdigest()])], schema)


def ends_of(members: DataFrame) -> DataFrame:
    """``ends, ends_sha256``: for each whole sequence, the hash of the ids of its conversations.

    A SHA-256 is one chain, so a sequence's ids pass through one task; they come as chunks of 65,536
    neighbouring ids at most, joined before the shuffle's last step, and only one chunk is in memory.
    """
    chunk = F.shiftright("conv_id", CHUNK_BITS)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = members.groupBy("ends", chunk.alias("chunk")).agg(ids.alias("ids"))
    return chunks.repartition("ends").sortWithinPartitions("ends", "chunk").mapInArrow(_hash_chunks, "ends binary, ends_sha256 string")


def _merged(parts: DataFrame) -> DataFrame:
    """The contracted forest of all blocks: open nodes with sums over whole subtrees."""
    one = parts.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"),
        F.first("own").alias("own"),
        F.max("ends").alias("ends"),
    )
    one = stored(one, "open_nodes")
    below = one.groupBy("parent_key").agg(F.count("*").alias("more")).withColumnRenamed("parent_key", "above")
    joined = one.join(below, F.col("key") == F.col("above"), "left").drop("above")
    children = F.col("n_children") + F.coalesce("more", F.lit(0))
    values = joined.withColumn("n_children", children).withColumns(
        {
            "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
            "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("own"),
            "jump": F.col("parent_key"),
        }
    )
    values = stored(values.drop("more", "own"), "open_values")
    deepest = values.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        # subtree sums within 2^k levels become sums within 2^(k+1), jumps twice as long
        sent = values.filter("jump is not null").groupBy("jump").agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        far = values.select(F.col("key").alias("via"), F.col("jump").alias("beyond"))
        values = (
            values.join(sent.withColumnRenamed("jump", "to"), F.col("key") == F.col("to"), "left")
            .join(far, F.col("jump") == F.col("via"), "left")
            .select(
                "key", "parent_key", "depth", "conv_id", "n_convs", "n_children",
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                "ends", F.col("beyond").alias("jump"),
            )
        )
        values = stored(values, "open_values")
    return values.drop("jump")


def trie(turns: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The nodes of the trie over ``conv_id, turns`` (see ``sequences``); every conversation is one row.

    Columns ``conv_id`` (least member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``. Without conversations there is no node, not even a root. A conversation's digests (16
    bytes a turn) are held in memory as one value, its texts are not.
    """
    spelled = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    members = stored(
        turns.select(
            "conv_id",
            spelled.alias("sequence"),
            F.unhex(F.md5(spelled)).alias("ends"),
            F.transform("turns", lambda t: t["length"]).alias("lengths"),
        ),
        "conversations",
    )
    distinct = members.groupBy("sequence").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("lengths").alias("lengths")
    )
    distinct = stored(distinct.select("sequence", "n", "conv_id", "lengths"), "distinct_conversations")
    dealt = distinct.repartitionByRange("sequence").sortWithinPartitions("sequence")
    nodes = stored(dealt.mapInArrow(_blocks(block_rows, block_bytes), NODES), "trie_nodes")

    parts = nodes.filter("open")
    merged = stored(_merged(parts), "merged_nodes")
    names = merged.select(F.col("key").alias("name"), F.col("conv_id").alias("name_conv"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends"]
    upper = merged.join(names, F.col("parent_key") == F.col("name"), "left").withColumnRenamed("name_conv", "parent_conv_id")
    closed = nodes.filter("not open")
    inner = closed.filter("parent_key is null").withColumnRenamed("parent_conv", "parent_conv_id")
    # each block learns the merged ids of its own open prefixes, so no prefix is a key of many rows
    per_block = parts.select("block", "key").join(names, F.col("key") == F.col("name"))
    per_block = per_block.select(F.col("block").alias("in_block"), F.col("key").alias("above"), "name_conv")
    border = closed.filter("parent_key is not null").join(
        per_block, (F.col("block") == F.col("in_block")) & (F.col("parent_key") == F.col("above"))
    ).withColumnRenamed("name_conv", "parent_conv_id")
    every = upper.select(*columns).unionByName(inner.select(*columns)).unionByName(border.select(*columns))

    ended = every.filter("ends is not null").join(ends_of(members.select("conv_id", "ends")), "ends")
    passed = every.filter("ends is null").withColumn("ends_sha256", F.lit(EMPTY))
    return ended.drop("ends").unionByName(passed.drop("ends"))


def conversation_trie(conversations: DataFrame, **options) -> DataFrame:
    """The trie of the rebuilt conversations; ``options`` as for ``trie``.

    Null turns come first, null roles and texts are empty, rows without ``conv_id`` take no part, repeated rows are
    turns like others, texts of any length count whole, an empty table gives an empty one, and columns of
    any other name are ignored.
    """
    return trie(rebuilt(sequences(conversations)), **options)
