"""Benchmark decontamination: short test items found inside long documents.

An item is contained in a document if at least ``threshold`` of the item's distinct five-word shingles
occur in it. Jaccard MinHash cannot see an item of thirty shingles in a document of twenty thousand, so
the search is asymmetric (containment MinHash, Koslicki and Zabeti 2019): the minima of the *item* are
looked up in the document's whole shingle set.

Items are partitioned by size. An item with n shingles of which ``need`` must occur gets its
n - need + 1 shingles of least hash as sketch: a document that lacks them all lacks too many, so no
containment is missed, whatever the hash. Documents with fewer shingles than an item's size class needs
are not compared with that class. What shares a sketch element is verified on the shingles' text.

With a benchmark below a checked size the sketches go to every task and the documents are read once,
without a shuffle. Beyond it the same search runs as joins on shingles.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.llm import textbatch
from passbook.llm.columns import lower_ascii, quoted, spare
from passbook.workspace import stored

SHINGLE = 5
THRESHOLD = 0.8
#: A benchmark up to this many characters is sent to the tasks (about ten times as many bytes there).
SENT_CHARS = 16_000_000
_SIGNS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def needed(total: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * total - 1e-9))


class Sketches:
    """The items' sketches by shingle length and size class, and the items' shingles."""

    def __init__(self, texts: list[str | None], threshold: float, size: int):
        column = pa.array(texts, pa.string())
        self.grams: list[frozenset[bytes]] = [frozenset()] * len(texts)
        self.need = [0] * len(texts)
        self.length = [0] * len(texts)
        elements: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for words in textbatch.blocks(column, textbatch.ALPHANUMERIC):
            hashes, bounds = words.hashes(), np.concatenate(([0], np.cumsum(words.counts())))
            for row in range(words.n):
                a, b = bounds[row], bounds[row + 1]
                if a == b:
                    continue  # no word: in no document
                item, length = words.first + row, min(size, b - a)
                found, _ = textbatch.grams(hashes[a:b], words.doc[a:b], length)
                found = np.unique(found)
                self.grams[item] = gram_texts(words, a, b, length)
                self.length[item], self.need[item] = length, needed(len(found), threshold)
                sketch = found[: len(found) - self.need[item] + 1]  # np.unique sorts: the least hashes
                elements[length] += [(int(h), item) for h in sketch]
        self.tables = {}
        for length, pairs in elements.items():
            pairs.sort()
            keys = np.array([h for h, _ in pairs], dtype=np.uint64)
            items = np.array([i for _, i in pairs], dtype=np.int64)
            bits = np.zeros(1 << 20, dtype=bool)
            bits[(keys >> np.uint64(44)).astype(np.int64)] = True
            least = min(self.need[i] for i in items.tolist())
            self.tables[length] = (keys, items, bits, least)

    def candidates(self, words: textbatch.Words) -> dict[int, set[int]]:
        """Items that share a sketch element with a text, by text."""
        found: dict[int, set[int]] = defaultdict(set)
        hashes, counts = words.hashes(), words.counts()
        for length, (keys, items, bits, least) in self.tables.items():
            grams, at = textbatch.grams(hashes, words.doc, length)
            near = np.flatnonzero(bits[(grams >> np.uint64(44)).astype(np.int64)])
            low, high = np.searchsorted(keys, grams[near], "left"), np.searchsorted(keys, grams[near], "right")
            for k in np.flatnonzero(low < high).tolist():
                text = int(words.doc[at[near[k]]])
                runs = counts[text] - length + 1
                if runs >= least:
                    found[text].update(i for i in items[low[k] : high[k]].tolist() if self.need[i] <= runs)
        return found


def gram_texts(words: textbatch.Words, a: int, b: int, length: int) -> frozenset[bytes]:
    """The distinct runs of ``length`` words from word ``a`` up to ``b``."""
    parts = [words.data[s:e].tobytes() for s, e in zip(words.starts[a:b].tolist(), words.ends[a:b].tolist(), strict=True)]
    return frozenset(b" ".join(parts[k : k + length]) for k in range(len(parts) - length + 1))


def found_column(texts: list[str | None], threshold: float = THRESHOLD, size: int = SHINGLE):
    """Arrow function from documents to the items they contain: ``array<struct<item, shared, total>>``.

    ``item`` counts the rows of ``texts``.
    """
    kind = "array<struct<item:int,shared:int,total:int>>"
    arrow = pa.list_(pa.struct([("item", pa.int32()), ("shared", pa.int32()), ("total", pa.int32())]))
    made: list[Sketches] = []

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if not made:
            made.append(Sketches(texts, threshold, size))
        sketches = made[0]
        for column in batches:
            rows: list[list[dict]] = [[] for _ in range(len(column))]
            for words in textbatch.blocks(column, textbatch.ALPHANUMERIC):
                candidates = sketches.candidates(words)
                bounds = np.concatenate(([0], np.cumsum(words.counts()))) if candidates else None
                for text, items in candidates.items():
                    have: dict[int, frozenset[bytes]] = {}
                    for item in sorted(items):
                        length = sketches.length[item]
                        if length not in have:
                            have[length] = gram_texts(words, bounds[text], bounds[text + 1], length)
                        shared = len(sketches.grams[item] & have[length])
                        if shared >= sketches.need[item]:
                            rows[words.first + text].append(
                                {"item": item, "shared": shared, "total": len(sketches.grams[item])}
                            )
            yield pa.array(rows, arrow)

    return run


def _words(text: Column) -> Column:
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SIGNS)
    return F.filter(parts, lambda w: w != "")


def _shingles(words: Column, length: int) -> Column:
    """Distinct runs of ``length`` words."""
    count = F.size(words) - (length - 1)
    runs = F.transform(F.sequence(F.lit(1), count), lambda k: F.concat_ws(" ", F.slice(words, k, length)))
    return F.when(count > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def _joined(docs: DataFrame, items: DataFrame, threshold: float, size: int) -> DataFrame:
    """The search as joins: ``key`` (hash of the text), ``item, shared, total``. For large benchmarks.

    Texts are compared once however many rows have them. A shingle that very many documents have meets few
    sketches, and adaptive execution splits its side of the join.
    """
    words = items.select("item", _words(F.col("text")).alias("w")).filter("size(w) > 0")
    words = words.withColumn("length", F.least(F.size("w"), F.lit(size)))
    grams = F.when(F.col("length") == size, _shingles(F.col("w"), size)).otherwise(F.array(F.concat_ws(" ", "w")))
    sets = words.select("item", "length", grams.alias("grams")).withColumn("total", F.size("grams"))
    need = F.greatest(F.lit(1), F.ceil(F.col("total") * F.lit(threshold) - 1e-9)).cast("int")
    sets = stored(sets.withColumn("need", need), "items")
    by_hash = F.array_sort(F.transform("grams", lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))
    sketch = sets.select(
        "item", "length", "need", F.explode(F.slice(by_hash, F.lit(1), F.col("total") - F.col("need") + 1)).alias("s")
    ).select("item", "length", "need", F.col("s.g").alias("gram"))
    lengths = [r[0] for r in sets.select("length").distinct().collect()]  # at most ``size`` values
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    texts = docs.select(key.alias("key"), _words(F.col("text")).alias("w"))
    each = [
        texts.select("key", F.lit(k).alias("length"), F.size("w").alias("n_words"), F.explode(_shingles(F.col("w"), k)).alias("gram"))
        for k in lengths
    ]
    if not each:
        return docs.sparkSession.createDataFrame([], "key string, item int, shared int, total int")
    runs = each[0]
    for more in each[1:]:
        runs = runs.unionByName(more)
    runs = stored(runs.distinct(), "shingles")
    enough = F.col("n_words") - F.col("length") + 1 >= F.col("need")
    candidates = runs.join(sketch, ["length", "gram"]).filter(enough).select("key", "item").distinct()
    full = sets.select("item", "length", "need", "total", F.explode("grams").alias("gram"))
    wanted = candidates.join(full, "item")
    return (
        wanted.join(runs.select("key", "length", "gram"), ["key", "length", "gram"])
        .groupBy("key", "item", "need", "total")
        .agg(F.count("*").cast("int").alias("shared"))
        .filter("shared >= need")
        .select("key", "item", "shared", "total")
    )


def _fits(benchmark: DataFrame, sent_chars: int) -> bool:
    size = benchmark.agg(F.coalesce(F.sum(F.length("text") + 8), F.lit(0))).first()[0]
    return size <= sent_chars


def containments(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    sent_chars: int = SENT_CHARS,
) -> DataFrame:
    """``doc_id, item_id, n_shared, n_shingles, containment`` for each document row and item it contains.

    Words are runs of letters and digits, A-Z lowered. An item of fewer words is one shingle of them all;
    items without words (null, empty) are in no document, and documents without words contain none.
    Repeated documents and repeated items give a row each; null ids stay null; empty tables give an
    empty result; other columns are ignored.
    """
    items = benchmark.select(quoted(item_id).alias("item_id"), quoted(item_text).alias("text"))
    rows = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    share = (F.col("f.shared").cast("double") / F.col("f.total")).alias("containment")
    if _fits(items, sent_chars):
        listed = items.collect()  # bounded by sent_chars
        kind = items.schema["item_id"].dataType
        find = found_column([r["text"] for r in listed], threshold, size)
        schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)])
        names = docs.sparkSession.createDataFrame([(k, r["item_id"]) for k, r in enumerate(listed)], schema)
        hits = rows.select("doc_id", F.explode(find(F.col("text"))).alias("f"))
        joined = hits.join(names, F.col("f.item") == F.col("item"))
    else:
        numbered = stored(items.withColumn("item", F.monotonically_increasing_id()), "benchmark")
        hits = _joined(rows, numbered.select("item", "text"), threshold, size)
        hits = hits.select("key", F.struct("item", "shared", "total").alias("f"))
        key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
        joined = rows.select("doc_id", key.alias("key")).join(hits, "key")
        joined = joined.join(numbered.select("item", "item_id"), F.col("f.item") == F.col("item"))
    return joined.select(
        "doc_id",
        "item_id",
        F.col("f.shared").cast("long").alias("n_shared"),
        F.col("f.total").cast("long").alias("n_shingles"),
        share,
    )


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    sent_chars: int = SENT_CHARS,
) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item."""
    items = benchmark.select(quoted(item_text).alias("text"))
    if _fits(items, sent_chars):
        find = found_column([r["text"] for r in items.collect()], threshold, size)
        return docs.filter(F.size(find(quoted(text_column))) == 0)
    numbered = stored(items.withColumn("item", F.monotonically_increasing_id()), "benchmark")
    bad = _joined(docs.select(quoted(text_column).alias("text")), numbered, threshold, size).select("key").distinct()
    (mine,) = spare(docs, "text_key")
    key = F.md5(F.coalesce(quoted(text_column), F.lit("")).cast("binary"))
    return docs.join(bad.withColumnRenamed("key", mine), key == F.col(mine), "left_anti")
