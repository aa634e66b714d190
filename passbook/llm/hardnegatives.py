"""Hard negatives: a GNAT-style multiway hyperplane tree with exact leaves.

Scores are integer inner products. With M the greatest length of any vector and every row x extended by
sqrt(M² − |x|²), an anchor a (extended by 0) has distance² = |a|² + M² − 2·score to it: higher scores are nearer, and a
window of scores is an annulus of distances. So rows are searched in a metric space.

1. The tree is fitted on a bounded sample: a node has ``WAYS`` split points far apart, and a row belongs to the nearest
   (hyperplanes lie between them). Every row of the table is put into a leaf.
2. For split points i and j of a node, the least and greatest distance from i to any row below j is kept, over all
   rows. There are nodes · WAYS² such ranges, however large the table is.
3. An anchor's annulus eliminates a sibling j if, for some i, no point that far from i can lie in the annulus.
   What an anchor finds in the sample bounds its annulus from the start.
4. The leaves that stay are compared exactly, in blocks: a leaf is cut into chunks of ``CHUNK`` rows, anchors
   stream past the chunk, and a chunk answers with its best few for each anchor.

Distances only ever leave out rows that cannot count (with room for rounding); scores are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passbook.llm.columns import quoted
from passbook.workspace import stored

WAYS = 12
LEVELS = 2
#: Rows of the sample that the tree is fitted on and that give first bounds.
SAMPLE = 4096
#: Rows of a leaf that are compared in one go.
CHUNK = 4096
POSITIVES = 5
NEGATIVES = 10
#: Window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Scores are exact in doubles below this bound.
EXACT = 2.0**53
ROOM = 1e-7


def prepared(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """``vec_id, label, vector`` (whole numbers as doubles) of the rows that take part.

    A null id, label, vector or component, or one that is not finite, leaves a row out.
    """
    vector = quoted(vector_column)
    number = quoted(id_column).cast("long")
    label = F.when(number % 7 == 0, (quoted(label_column) + 1) % 10).otherwise(quoted(label_column))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("double"))
    found = rows.filter(number.isNotNull() & quoted(label_column).isNotNull() & vector.isNotNull()).filter(usable)
    return found.select(number.alias("vec_id"), label.cast("long").alias("label"), whole.alias("vector"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, short ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values[offsets[0] : offsets[-1]]
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows: in doubles where they hold them, else in whole numbers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in a], dtype=object) @ np.array(
        [[int(x) for x in row] for row in b], dtype=object
    ).T
    if max(abs(x) for x in exact.ravel()) >= 2**63:
        raise OverflowError("an inner product does not fit a long")
    return exact.astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between rows of ``a`` and of ``b``."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def extended(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the component that gives all of them the length ``longest``."""
    rest = np.sqrt(np.maximum(longest * longest - (vectors * vectors).sum(1), 0))
    return np.column_stack((vectors, rest))


@dataclass
class Tree:
    """Nodes of the tree. ``points[n]``: split points; ``children[n]``: node below each, or −1 − leaf."""

    longest: float
    points: list[np.ndarray]
    children: list[list[int]]
    leaves: int
    low: list[np.ndarray] | None = None  # [node][i, j]: least distance from point i to a row below j
    high: list[np.ndarray] | None = None

    def down(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Node, numbers of the rows that come by, their distances to its points and the child each takes."""
        waiting = [(0, np.arange(len(rows)))]
        while waiting:
            node, here = waiting.pop()
            if not len(here):
                continue
            far = distances(rows[here], self.points[node])
            child = far.argmin(1)
            yield node, here, far, child
            waiting += [(c, here[child == j]) for j, c in enumerate(self.children[node]) if c >= 0]

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        found = np.zeros(len(rows), dtype=np.int64)
        for node, here, _, child in self.down(rows):
            below = np.array(self.children[node])[child]
            found[here[below < 0]] = -1 - below[below < 0]
        return found

    def reached(self, anchor: np.ndarray, rings: list[tuple[float, float]]) -> list[int]:
        """Leaves that may hold a row within one of the ``rings`` (nearest, farthest) around ``anchor``."""
        out, waiting = [], [0]
        slack = ROOM * (self.longest + float(np.linalg.norm(anchor)) + 1)
        while waiting:
            node = waiting.pop()
            far = distances(anchor[None, :], self.points[node])[0][:, None]
            low, high = self.low[node], self.high[node]
            # from point i: rows below j are no nearer to the anchor than nearest, no farther than farthest
            nearest = np.maximum(np.maximum(low - far, far - high), 0).max(0) - slack
            farthest = (far + high).min(0) + slack
            alive = np.zeros(len(nearest), dtype=bool)
            for a, b in rings:
                alive |= (nearest <= b) & (farthest >= a)
            for j in np.flatnonzero(alive & (high[0] >= 0)):
                child = self.children[node][j]
                out.append(-1 - child) if child < 0 else waiting.append(child)
        return out


def fit(sample: np.ndarray, longest: float, ways: int = WAYS, levels: int = LEVELS) -> Tree:
    """Tree over the sample: each split point is the row farthest from those chosen before it."""
    tree = Tree(longest, [], [], 0)

    def build(rows: np.ndarray, level: int) -> int:
        node = len(tree.points)
        chosen = [0]
        near = distances(rows, rows[:1])[:, 0]
        while len(chosen) < min(ways, len(rows)) and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, distances(rows, rows[chosen[-1] : chosen[-1] + 1])[:, 0])
        tree.points.append(rows[chosen])
        tree.children.append([])
        nearest = distances(rows, rows[chosen]).argmin(1)
        for j in range(len(chosen)):
            mine = rows[nearest == j]
            if level + 1 < levels and len(mine) > 2 * ways:
                tree.children[node].append(build(mine, level + 1))
            else:
                tree.children[node].append(-1 - tree.leaves)
                tree.leaves += 1
        return node

    build(sample, 0)
    return tree


def _leaf_rows(tree, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.value.leaf_of(extended(matrix(batch.column(2), width), tree.value.longest))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    return run


def _range_rows(tree, width: int):
    """One row per node and pair of split points from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tree.value
        low = [np.full((len(p), len(p)), np.inf) for p in own.points]
        high = [np.full((len(p), len(p)), -1.0) for p in own.points]
        for batch in batches:
            rows = extended(matrix(batch.column(0), width), own.longest)
            for node, _, far, child in own.down(rows):
                for j in np.unique(child):
                    part = far[child == j]
                    low[node][:, j] = np.minimum(low[node][:, j], part.min(0))
                    high[node][:, j] = np.maximum(high[node][:, j], part.max(0))
        out = [
            (node, i, j, float(low[node][i, j]), float(high[node][i, j]))
            for node in range(len(low))
            for i, j in zip(*np.nonzero(high[node] >= 0))
        ]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["node", "i", "j", "low", "high"])

    return run


@dataclass
class Index:
    rows: DataFrame  # leaf, vec_id, label, vector, chunk
    chunks: DataFrame  # leaf, chunk
    tree: Tree
    width: int
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]  # vec_id, label, vectors


def index(rows: DataFrame, sample_rows: int = SAMPLE, ways: int = WAYS, levels: int = LEVELS, chunk: int = CHUNK) -> Index | None:
    """Fit the tree on ``sample_rows`` rows at most and put every row of ``rows`` into a leaf; None if there is none."""
    rows = stored(rows, "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    longest, width = rows.agg(F.max(F.sqrt(square)), F.max(F.size("vector"))).first()
    if longest is None:
        return None
    longest *= 1 + 1e-12
    drawn = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(sample_rows).toArrow()
    sample = (drawn["vec_id"].to_numpy(), drawn["label"].to_numpy(), matrix(drawn["vector"], width))
    tree = fit(extended(sample[2], longest), longest, ways, levels)
    send = rows.sparkSession.sparkContext.broadcast
    bare = send(tree)
    ranges = (
        rows.select("vector")
        .mapInArrow(_range_rows(bare, width), "node long, i long, j long, low double, high double")
        .groupBy("node", "i", "j")
        .agg(F.min("low"), F.max("high"))
        .collect()
    )
    tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.high = [np.full((len(p), len(p)), -1.0) for p in tree.points]
    for node, i, j, low, high in ranges:
        tree.low[node][i, j], tree.high[node][i, j] = low, high
    leafed = stored(
        rows.mapInArrow(_leaf_rows(bare, width), "vec_id long, label long, vector array<double>, leaf long"), "leaves"
    )
    # chunks of a leaf by hash: a leaf full of equal vectors is cut like any other
    parts = leafed.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(chunk)).cast("int").alias("parts"))
    parts = stored(parts, "leaf_parts")
    dealt = leafed.join(F.broadcast(parts), "leaf")  # one row per leaf; the tree has ways ** levels at most
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("parts")).cast("int")).drop("parts")
    chunks = parts.select("leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("chunk"))
    return Index(dealt, chunks, tree, width, sample)


def _ring(anchor: np.ndarray, longest: float, low: float, high: float) -> tuple[float, float]:
    """Distances of the scores from ``low`` to ``high``."""
    base = float(anchor @ anchor) + longest * longest
    return tuple(float(np.sqrt(max(base - 2 * s, 0.0))) if np.isfinite(s) else np.inf for s in (high, low))


def _best(values: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the ``count`` highest values, equal ones by smaller id."""
    if len(values) > count:
        edge = np.partition(values, len(values) - count)[len(values) - count]
        some = np.flatnonzero(values >= edge)
    else:
        some = np.arange(len(values))
    return some[np.lexsort((ids[some], -values[some]))][:count]


def _reach(tree, width: int, sample, positives: int, negatives: int | None):
    """Leaves each anchor must visit, given what the sample holds.

    Without ``negatives``: for the best of its own label. With it: for the windows of its positives, whose
    scores come in the column ``windows``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (ids, labels, vectors) = tree.value, sample.value
        for batch in batches:
            anchors = matrix(batch.column(2), width)
            found = scores(anchors, vectors)
            windows = batch.column(4).to_pylist() if negatives is not None else None
            take, leaves = [], []
            for row, (number, label) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if negatives is None:
                    mine = found[row][(labels == label) & (ids != number)]
                    least = float(np.partition(mine, -positives)[-positives]) if len(mine) >= positives else -np.inf
                    rings = [(0.0, _ring(anchors[row], own.longest, least, least)[1])]
                else:
                    others, rings = found[row][labels != label], []
                    for low, high in {(w["low"], w["high"]) for w in windows[row]}:
                        inside = others[(others >= low) & (others <= high)]
                        if len(inside) >= negatives:
                            low = float(np.partition(inside, -negatives)[-negatives])
                        rings.append(_ring(anchors[row], own.longest, low, high))
                slack = ROOM * (own.longest + float(np.linalg.norm(anchors[row])) + 1)
                rings = [(a - slack, b + slack) for a, b in rings]
                reached = own.reached(np.append(anchors[row], 0.0), rings)
                take += [row] * len(reached)
                leaves += reached
            if take:
                chosen = batch.take(pa.array(take))
                yield pa.RecordBatch.from_arrays([*chosen.columns, pa.array(leaves, pa.int64())], [*batch.schema.names, "leaf"])

    return run


def _search(width: int, positives: int, negatives: int | None):
    """Rows sorted by leaf, chunk and kind: the chunk's rows first, then the anchors that visit it."""

    def answers(held, ids, labels, vectors, windows, keys):
        own_ids, own_labels, own_vectors = held
        found = scores(vectors, own_vectors)
        for row in range(len(ids)):
            if negatives is None:
                near = np.flatnonzero((own_labels == labels[row]) & (own_ids != ids[row]))
                best = near[_best(found[row][near], own_ids[near], positives)]
                yield from ((keys[row], None, int(own_ids[k]), int(found[row][k])) for k in best)
                continue
            other = np.flatnonzero(own_labels != labels[row])
            for window in windows[row]:
                near = other[(found[row][other] >= window["low"]) & (found[row][other] <= window["high"])]
                best = near[_best(found[row][near], own_ids[near], negatives)]
                yield from ((keys[row], window["of"], int(own_ids[k]), int(found[row][k])) for k in best)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, held = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf, chunk, kind = (batch.column(k).to_numpy() for k in range(3))
            edges = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(chunk) != 0) | (np.diff(kind) != 0)) + 1
            out: list[tuple] = []
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                part = batch.slice(a, b - a)
                if here != (leaf[a], chunk[a]):
                    here, parts, held = (leaf[a], chunk[a]), [], None
                ids, labels = part.column(3).to_numpy(), part.column(4).to_numpy()
                vectors = matrix(part.column(5), width)
                if kind[a] == 0:
                    parts.append((ids, labels, vectors))
                    continue
                if held is None:
                    if not parts:
                        continue
                    held = tuple(np.concatenate(c) for c in zip(*parts))
                windows = part.column(7).to_pylist() if negatives is not None else None
                keys = part.column(6).to_pylist()
                for k in range(0, len(ids), 256):
                    some = slice(k, k + 256)
                    out += answers(held, ids[some], labels[some], vectors[some], windows and windows[some], keys[some])
            columns = list(zip(*out)) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["anchor", "of", "other_id", "score"]
            )

    return run


def _visits(found: Index, anchors: DataFrame, positives: int, negatives: int | None) -> DataFrame:
    """Best rows of every chunk that an anchor must visit: ``anchor, of, other_id, score``."""
    send = anchors.sparkSession.sparkContext.broadcast
    window = "array<struct<low:long,high:long,of:long>>"
    kinds = "vec_id long, label long, vector array<double>, anchor long"
    if negatives is not None:
        kinds += f", windows {window}"
    routed = anchors.mapInArrow(
        _reach(send(found.tree), found.width, send(found.sample), positives, negatives), f"{kinds}, leaf long"
    )
    none = F.lit(None).cast(window).alias("windows")
    visitors = routed.join(found.chunks, "leaf").select(
        "leaf", "chunk", F.lit(1).alias("kind"), "vec_id", "label", "vector", "anchor", none if negatives is None else F.col("windows")
    )
    no_anchor = F.lit(0).cast("long").alias("anchor")
    rows = found.rows.select("leaf", "chunk", F.lit(0).alias("kind"), "vec_id", "label", "vector", no_anchor, none)
    dealt = rows.unionByName(visitors).repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk", "kind")
    return dealt.mapInArrow(_search(found.width, positives, negatives), "anchor long, of long, other_id long, score long")


def hard_negatives(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    sample_rows: int = SAMPLE,
    ways: int = WAYS,
    levels: int = LEVELS,
    chunk: int = CHUNK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id ``every`` divides. Rows with a null id, label, vector or component, or a
    component that is not finite, take no part; the empty vector scores 0 with every row, and of vectors of different
    lengths the shorter one counts as filled with zeros. Ties go by smaller id. Equal rows count once; an anchor is
    never among its own positives. Rows that share an id but differ otherwise each count. An
    empty table gives an empty one. A score beyond a long is an error. Other columns are ignored.
    """
    given = prepared(rows, id_column, vector_column, label_column).distinct()
    empty = rows.sparkSession.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    found = index(given, sample_rows, ways, levels, chunk)
    if found is None:
        return empty
    # rows of one id may differ: an anchor is known by all it has
    anchors = found.rows.filter(F.col("vec_id") % every == 0)
    anchors = anchors.select("vec_id", "label", "vector", F.xxhash64("vec_id", "label", "vector").alias("anchor"))
    near = _visits(found, anchors, positives, None)
    ordered = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "other_id")
    best = near.withColumn("nth", F.row_number().over(ordered)).filter(F.col("nth") <= positives)
    # the window in whole scores: low * p <= 100 * score <= high * p
    share = lambda part: F.col("score").cast("decimal(20,0)") * F.lit(part).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")
    window = F.struct(
        F.ceil(share(low)).cast("long").alias("low"), F.floor(share(high)).cast("long").alias("high"), F.col("score").alias("of")
    )
    pairs = stored(best.select("anchor", F.col("other_id").alias("positive_id"), window.alias("window")), "positives")
    windows = pairs.filter("window.low <= window.high").groupBy("anchor").agg(F.collect_set("window").alias("windows"))
    asking = anchors.join(windows, "anchor").select("vec_id", "label", "vector", "anchor", "windows")
    hits = _visits(found, asking, positives, negatives)
    ranked = Window.partitionBy("anchor", "of").orderBy(F.col("score").desc(), "other_id")
    hits = hits.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= negatives)
    hits = hits.select(
        F.col("anchor").alias("hit"), "of", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = pairs.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return named.join(hits, (F.col("anchor") == F.col("hit")) & (F.col("window.of") == F.col("of"))).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        F.col("of").alias("positive_score"),
        "negative_score",
    )
