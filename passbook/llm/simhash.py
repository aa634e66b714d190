"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

1. Tasks turn whole texts into fingerprints (one pass over the text, nothing shuffled).
2. Equal fingerprints become one class, so copies cost nothing further on.
3. Two fingerprints at most three bits apart agree in one of four 16-bit quarters, and there in one of
   four 12-bit parts of the rest: classes meet in 16 cells keyed by 28 bits each. No pair is lost,
   and at n classes a cell holds about n / 2**28 of them beside true neighbours.
4. A cell's fingerprints are compared in tiles with numpy exclusive-or and bit counts. A crowded cell is cut
   by population count and hash into many tiles; tile pairs whose population counts differ by more
   than the radius are never formed, since every differing bit changes the count by one.
5. A tile answers with a spanning forest of its links and not with its pairs; the forests are joined into
   components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.llm.columns import quoted, spare
from passbook.llm.components import components
from passbook.workspace import stored

WORDS = 3
RADIUS = 3
SEED = 42
#: Fingerprints of one tile; a comparison holds the bits of one tile row at a time.
TILE = 2048


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes; zero for no hash."""
    if not len(hashes):
        return 0
    total = np.zeros(64, dtype=np.int64)
    for part in range(0, len(hashes), 65536):
        some = hashes[part : part + 65536].astype("<u8")
        total += np.unpackbits(some.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    bits = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, joined by one space; of all words if they are fewer."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[: len(words) - size])).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)),
        dtype=np.uint64,
        count=len(starts),
    )


def fingerprint_column(size: int = WORDS):
    """Arrow function from texts to fingerprints (64 bits as signed long)."""
    lowered = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

    @F.arrow_udf(T.LongType())
    def run(texts: pa.Array) -> pa.Array:
        found = np.empty(len(texts), dtype=np.uint64)
        for row, text in enumerate(texts):
            # bytes.split cuts at exactly the white space of the contract
            words = (text.as_py() or "").encode("utf-8").translate(lowered).split()
            found[row] = fingerprint(shingle_hashes(words, size))
        return pa.array(found.view(np.int64))

    return run


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WORDS) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as signed long) of every row."""
    return docs.select(quoted(id_column).alias("doc_id"), fingerprint_column(size)(quoted(text_column)).alias("fp"))


def _cells(radius: int) -> Column:
    """Keys of the cells of ``fp``: any two fingerprints within ``radius`` bits share one."""
    pieces = radius + 1
    cuts = [64 * k // pieces for k in range(pieces + 1)]
    keys = []
    for k, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        outer = [bit for bit in range(64) if not low <= bit < high]
        inner = [len(outer) * j // pieces for j in range(pieces + 1)]
        for j, (a, b) in enumerate(zip(inner, inner[1:], strict=False)):
            mask = sum(1 << bit for bit in [*range(low, high), *outer[a:b]])
            signed = mask - (1 << 64) if mask >> 63 else mask
            keys.append(F.struct(F.lit(k * pieces + j).alias("part"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in a tile, or of those between two tiles.

    ``left`` and ``right`` are unsigned and distinct; rows are compared block by block, and within a
    sorted tile only where population counts are near enough.
    """
    nodes = left if right is None else np.concatenate((left, right))
    nodes = nodes[np.argsort(np.bitwise_count(nodes), kind="stable")] if right is None else nodes
    counts = np.bitwise_count(nodes).astype(np.int64)
    label = np.arange(len(nodes))

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    out: list[tuple[int, int]] = []
    rows = range(len(nodes)) if right is None else range(len(left))
    for i in rows:
        if right is None:
            low, high = i + 1, int(np.searchsorted(counts, counts[i] + radius, "right"))
        else:
            low, high = len(left), len(nodes)
        near = low + np.flatnonzero(np.bitwise_count(nodes[low:high] ^ nodes[i]) <= radius)
        if not len(near):
            continue
        mine = root(i)
        # labels of what is near may point at i's root already: only others are new links
        for j in near[label[near] != mine].tolist():
            theirs = root(j)
            if theirs != mine:
                label[theirs] = mine
                out.append((i, j))
            label[j] = mine
    pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
    return nodes[pairs[:, 0]], nodes[pairs[:, 1]]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("left", "right"):
                column = batch.column(batch.schema.get_field_index(name))
                sides.append((column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()))
            same = batch.column(batch.schema.get_field_index("same")).to_pylist()
            found_a, found_b = [], []
            for row in range(batch.num_rows):
                (lv, lo), (rv, ro) = sides
                left = lv[lo[row] : lo[row + 1]]
                right = None if same[row] else rv[ro[row] : ro[row + 1]]
                a, b = tile_links(left, right, radius)
                found_a.append(a)
                found_b.append(b)
            a, b = np.concatenate(found_a or [np.empty(0, np.uint64)]), np.concatenate(found_b or [np.empty(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def links(classes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges ``a, b`` between the distinct fingerprints ``fp`` that connect all within ``radius`` bits.

    Cells are counted before they are gathered. A cell above ``tile`` fingerprints is dealt into tiles of
    one population count and one hash share; a list holds about ``tile`` fingerprints at most, whatever
    the size of the cell.
    """
    cells = stored(classes.select("fp", F.explode(_cells(radius)).alias("cell")).select("fp", "cell.*"), "cells")
    counted = cells.groupBy("part", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(cells.join(counted, ["part", "bits"]), "shared_cells")
    light = (
        shared.filter(F.col("n") <= tile)
        .groupBy("part", "bits")
        .agg(F.collect_list("fp").alias("left"))
        .select("left", F.array().cast("array<bigint>").alias("right"), F.lit(True).alias("same"))
    )
    heavy = shared.filter(F.col("n") > tile).select(
        "part",
        "bits",
        "fp",
        F.bit_count("fp").cast("int").alias("pop"),
        F.ceil(F.col("n") / tile).cast("int").alias("shares"),
    ).withColumn("share", F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int"))
    tile_of = F.struct("pop", "share").alias("mine")
    others = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.col("pop") - radius, F.col("pop") + radius),
                lambda p: F.transform(
                    F.sequence(F.lit(0), F.col("shares") - 1), lambda s: F.struct(p.alias("pop"), s.alias("share"))
                ),
            )
        )
    ).alias("other")
    dealt = heavy.select("part", "bits", "fp", tile_of, others)
    dealt = dealt.groupBy("part", "bits", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")).agg(
        F.collect_list(F.when(F.col("mine") <= F.col("other"), F.col("fp"))).alias("left"),
        F.collect_list(F.when(F.col("mine") > F.col("other"), F.col("fp"))).alias("right"),
    )
    dealt = dealt.select("left", "right", (F.col("low") == F.col("high")).alias("same")).filter(
        "size(left) > 0 and (same or size(right) > 0)"
    )
    return light.unionByName(dealt).mapInArrow(_compare(radius), "a bigint, b bigint").distinct()


def _labels(rows: DataFrame, radius: int, tile: int) -> DataFrame:
    """``fp, root, least`` of every distinct fingerprint: its component and the component's least id."""
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(classes.select("fp"), radius, tile))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first_id").alias("least"))
    return stored(named.select("fp", "root").join(least, "root").select("fp", "root", "least"), "labels")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = WORDS,
    radius: int = RADIUS,
    tile: int = TILE,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``.

    Null texts and texts without words have fingerprint zero and are linked like any other. A component's id
    is its smallest id that is not null (null if it has none). Repeated rows and repeated ids
    give a row each; an empty table gives an empty one. Other columns are ignored.
    """
    rows = stored(fingerprints(docs, id_column, text_column, size), "fingerprints")
    return rows.join(_labels(rows, radius, tile), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("least").alias("component_id")
    )


def keep_one(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = WORDS,
    radius: int = RADIUS,
    tile: int = TILE,
) -> DataFrame:
    """One row of each component, with all columns of ``docs``.

    The document whose id names the component stays. Of several rows with that id, or of a component's
    rows if all its ids are null, the one with the least text hash stays.
    """
    rows = stored(fingerprints(docs, id_column, text_column, size), "fingerprints")
    labels = _labels(rows, radius, tile)
    per_id = rows.join(labels, "fp").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.bool_or(F.col("doc_id") == F.col("least")).alias("names")
    )
    mine, fp, root, least, rank = spare(docs, "simhash_id", "simhash_fp", "simhash_root", "simhash_least", "simhash_rank")
    plain = per_id.filter("n = 1 and names").select(F.col("doc_id").alias(mine))
    single = docs.join(plain, quoted(id_column) == F.col(mine), "left_semi")
    # rows whose id does not tell them apart: seldom any, so their fingerprints are made again
    odd = per_id.filter("doc_id is null or (n > 1 and names)").select(F.col("doc_id").alias(mine))
    odd = docs.join(odd, quoted(id_column).eqNullSafe(F.col(mine)), "left_semi")
    odd = odd.withColumn(fp, fingerprint_column(size)(quoted(text_column)))
    known = labels.select(F.col("fp").alias(rank), F.col("root").alias(root), F.col("least").alias(least))
    odd = odd.join(known, F.col(fp) == F.col(rank)).filter(F.col(least).eqNullSafe(quoted(id_column)))
    first = F.row_number().over(Window.partitionBy(root).orderBy(F.xxhash64(quoted(text_column))))
    odd = odd.withColumn(rank, first).filter(F.col(rank) == 1)
    columns = [quoted(c) for c in docs.columns]
    return single.select(*columns).unionByName(odd.select(*columns))
