"""Substring dedup: suffix automata of reference shards, documents streamed for matching statistics.

A window is ``length`` consecutive words of one document. A word goes if a window over it also starts in a
document of smaller id. What is compared are words, exactly; hashes only say what need not be compared.

1. Equal texts are one class. In all but its first document every window repeats, so only the first document
   of a class is searched (``classes``).
2. Every window has an anchor, its least ``GRAM``-word run by hash. Equal windows have equal anchors, so only
   documents holding an anchor that another class holds too can share a window (``candidates``).
3. Windows over such anchors are hashed. The first document of every window that repeats gives that stretch
   of words to the reference; the reference is dealt into shards of about ``SHARD_WORDS`` words (``reference``).
4. A shard is sent to the tasks that stream the documents sharing a window with it. Such a task builds the
   shard's suffix automaton, which knows for every state the least document holding it, and streams its
   documents through it: the matching statistic of a word is the longest stretch ending there that a
   document of smaller id holds. Stretches of ``length`` words and more are spans to remove (``Automaton``).

A shard is a bounded number of words, whatever the corpus; a shard wanted by many documents goes to several
tasks, each with its share of the documents, so a passage that a third of all documents hold is no hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.llm.columns import quoted, spare
from passbook.llm.textbatch import blocks, grams
from passbook.workspace import stored

LENGTH = 50
GRAM = 10
#: Words of a reference shard, on average; one document gives a shard at most PIECE windows in a row.
SHARD_WORDS = 60_000
PIECE = 16_384
#: Characters that one task streams through one automaton.
TASK_CHARS = 8_000_000
#: A row without id counts as larger than every id.
LAST = 2**63 - 1


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _marked(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``rank, mark, other, text``: the id with nulls last, and two hashes of the text."""
    text = F.coalesce(quoted(text_column), F.lit(""))
    return docs.select(
        F.coalesce(quoted(id_column).cast("long"), F.lit(LAST)).alias("rank"),
        F.xxhash64(text).alias("mark"),
        F.xxhash64(F.lit(1), text).alias("other"),
        text.alias("text"),
    )


def classes(marked: DataFrame) -> DataFrame:
    """One row per distinct text: ``mark, other``, its least ``rank`` and the number of rows ``n`` with that rank."""
    each = marked.groupBy("mark", "other", "rank").agg(F.count("*").alias("n"))
    least = each.groupBy("mark", "other").agg(F.min(F.struct("rank", "n")).alias("first"))
    return stored(least.select("mark", "other", "first.*"), "text_classes")


def _sliding(x: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Minimum or maximum of every ``size`` values in a row."""
    pick = np.minimum if least else np.maximum
    width = 1
    while 2 * width <= size:
        x = pick(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(hashes: np.ndarray, doc: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and word position of the least gram of every window; equal least ones all count."""
    found, at = grams(hashes, doc, gram)
    span = length - gram + 1
    if len(found) < span:
        return found[:0], at[:0]
    least = _sliding(found, span, least=True)
    # windows that would run on into the next text have none
    least[doc[at[: len(least)]] != doc[at[span - 1 :]]] = 0
    pad = np.zeros(span - 1, dtype=np.uint64)
    chosen = np.flatnonzero(_sliding(np.concatenate((pad, least, pad)), span, least=False) == found)
    return found[chosen], at[chosen]


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(0).to_numpy(zero_copy_only=False)
            for words in blocks(batch.column(1), lower=False):
                hashes, at = anchors(words.hashes(), words.doc, length, gram)
                doc = words.doc[at]
                first = np.concatenate(([0], np.cumsum(words.counts())))[doc]
                columns = [_signed(hashes), pa.array(marks[words.first + doc]), pa.array((at - first).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "mark", "pos"])

    return run


def candidates(marked: DataFrame, of: DataFrame, length: int, gram: int) -> DataFrame:
    """First documents that hold an anchor which another text holds too: ``rank, mark, text, anchors``."""
    rows = marked.select("mark", "text").mapInArrow(_anchor_rows(length, gram), "gram long, mark long, pos int")
    rows = stored(rows, "anchors")
    both = rows.groupBy("gram").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).filter("low < high")
    # a table of its own: the join then has an exchange on either side, and one gram's many rows can be split
    both = stored(both.select("gram"), "shared_anchors")
    held = rows.join(both, "gram", "left_semi").groupBy("mark").agg(F.collect_set("pos").alias("anchors"))
    wanted = stored(of.join(held, "mark").select("rank", "mark", "other", "n", "anchors"), "candidate_ids")
    key = ["rank", "mark", "other"]
    alone = marked.join(wanted.filter("n = 1").drop("n"), key)
    # rows repeated with their id: counted as one before anything moves
    several = marked.join(wanted.filter("n > 1").select(key), key, "left_semi").dropDuplicates(key)
    several = several.join(wanted.filter("n > 1").drop("n"), key)
    return stored(alone.unionByName(several).select("rank", "mark", "text", "anchors"), "candidates")


def _window_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, marks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            places = batch.column(3)
            offsets, flat = places.offsets.to_numpy(), places.values.to_numpy(zero_copy_only=False)
            for words in blocks(batch.column(2), lower=False):
                counts = words.counts()
                first = np.concatenate(([0], np.cumsum(counts)))
                covered = np.zeros(len(words.starts) + 1, dtype=np.int32)
                for doc in range(words.n):
                    row = words.first + doc
                    at = flat[offsets[row] : offsets[row + 1]].astype(np.int64)
                    np.add.at(covered, first[doc] + np.maximum(at + gram - length, 0), 1)
                    np.add.at(covered, first[doc] + at + 1, -1)
                hashes, at = grams(words.hashes(), words.doc, length)
                near = np.cumsum(covered)[at] > 0
                hashes, at = hashes[near], at[near]
                doc = words.doc[at]
                columns = [
                    _signed(hashes),
                    pa.array(ranks[words.first + doc]),
                    pa.array(marks[words.first + doc]),
                    pa.array((at - first[doc]).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["window", "rank", "mark", "pos"])

    return run


def runs(starts: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Stretches of words (from, to) that windows starting at ``starts`` cover."""
    starts = np.unique(starts)
    if not len(starts):
        return
    new = np.flatnonzero(np.diff(starts) > length) + 1
    for part in np.split(starts, new):
        yield int(part[0]), int(part[-1]) + length


def _segment_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            shard, rank, text, starts = (batch.column(k) for k in range(4))
            for row in range(batch.num_rows):
                words = text[row].as_py().encode("utf-8").split()
                for a, b in runs(np.asarray(starts[row].values.to_numpy(zero_copy_only=False)), length):
                    out.append((shard[row].as_py(), rank[row].as_py(), b" ".join(words[a:b]).decode("utf-8")))
            columns = list(zip(*out)) if out else ([], [], [])
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "rank", "text"])

    return run


class Automaton:
    """Suffix automaton of some stretches of words, added in ascending order of their documents.

    ``least`` of a state is the least document that holds its stretches: the one that was added first. A copy
    of a state made later holds at least the same stretches, so it keeps the value.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.least = [-1], [0], [-1]
        self.ids: dict[bytes, int] = {}

    def add(self, words: list[bytes], document: int) -> None:
        last, ids = 0, self.ids
        following, link, size, least = self.next, self.link, self.size, self.least
        for word in words:
            c = ids.setdefault(word, len(ids))
            known = following[last].get(c)
            if known is not None and size[known] == size[last] + 1:
                last = known
                continue
            fresh = known is None
            if fresh:
                state = len(size)
                following.append({})
                link.append(0)
                size.append(size[last] + 1)
                least.append(document)
            p = last
            while fresh and p != -1 and c not in following[p]:
                following[p][c] = state
                p = link[p]
            if p != -1:
                q = following[p][c]
                if size[q] != size[p] + 1:
                    copy = len(size)
                    following.append(dict(following[q]))
                    link.append(link[q])
                    size.append(size[p] + 1)
                    least.append(least[q])
                    while p != -1 and following[p].get(c) == q:
                        following[p][c] = copy
                        p = link[p]
                    link[q] = copy
                    q = copy
                if fresh:
                    link[state] = q
                else:
                    state = q
            last = state

    def spans(self, words: list[bytes], document: int, length: int) -> list[tuple[int, int]]:
        """Maximal stretches (from, to) covered by matches of ``length`` words and more with smaller documents."""
        following, link, size, least = self.next, self.link, self.size, self.least
        out: list[tuple[int, int]] = []
        state = match = 0
        for i, c in enumerate(map(self.ids.get, words)):
            if c is None:
                state = match = 0
                continue
            target = following[state].get(c)
            while state and (target is None or least[target] >= document):
                state = link[state]
                match = size[state]
                target = following[state].get(c)
            if target is None or least[target] >= document:
                match = 0
                continue
            state, match = target, match + 1
            if match >= length:
                start = i + 1 - match
                if out and start <= out[-1][1]:
                    out[-1] = (min(start, out[-1][0]), i + 1)
                else:
                    out.append((start, i + 1))
        return out


def _match_rows(length: int):
    """Rows sorted by shard, share and kind: reference stretches by document first, then what streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, machine = None, Automaton()
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            shard, share, kind, rank, mark = (batch.column(k).to_pylist() for k in range(5))
            text = batch.column(5)
            for row in range(batch.num_rows):
                if here != (shard[row], share[row]):
                    here, machine = (shard[row], share[row]), Automaton()
                words = text[row].as_py().encode("utf-8").split()
                if kind[row] == 0:
                    machine.add(words, rank[row])
                else:
                    out += [(rank[row], mark[row], a, b) for a, b in machine.spans(words, rank[row], length)]
            columns = list(zip(*out)) if out else ([], [], [], [])
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["rank", "mark", "start", "stop"]
            )

    return run


def matches(
    found: DataFrame, length: int, gram: int, shard_words: int = SHARD_WORDS, task_chars: int = TASK_CHARS
) -> DataFrame:
    """``rank, mark, start, stop``: stretches of the candidates that smaller documents hold, shard by shard."""
    windows = found.mapInArrow(_window_rows(length, gram), "window long, rank long, mark long, pos int")
    windows = stored(windows, "windows")
    firsts = windows.groupBy("window").agg(F.min(F.struct("rank", "mark", "pos")).alias("at"), F.max("rank").alias("last"))
    firsts = stored(firsts.filter("at.rank < last").select("window", "at.*"), "first_windows")
    shards = max(1, -(-firsts.count() // shard_words))
    piece = F.floor(F.col("pos") / PIECE)
    firsts = firsts.withColumn("shard", F.pmod(F.xxhash64("rank", "mark", piece), F.lit(shards)))

    starts = firsts.groupBy("rank", "mark", "shard").agg(F.collect_list("pos").alias("starts"))
    texts = found.select("rank", "mark", "text")
    stretches = (
        starts.join(texts, ["rank", "mark"])
        .select("shard", "rank", "text", "starts")
        .mapInArrow(_segment_rows(length), "shard long, rank long, text string")
    )
    known = firsts.select("window", "shard", F.col("rank").alias("first_rank"))
    wanted = windows.join(known, "window").filter("first_rank < rank").select("rank", "mark", "shard").distinct()
    wanted = stored(wanted, "wanted_shards")
    sized = wanted.join(found.select("rank", "mark", F.length("text").alias("chars")), ["rank", "mark"])
    shares = sized.groupBy("shard").agg(F.ceil(F.sum("chars") / F.lit(task_chars)).cast("int").alias("shares"))
    shares = stored(shares, "shard_shares")

    sent = stretches.join(shares, "shard").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    sent = sent.select("shard", "share", F.lit(0).alias("kind"), "rank", F.lit(0).cast("long").alias("mark"), "text")
    streamed = wanted.join(shares, "shard").join(texts, ["rank", "mark"])
    share = F.pmod(F.xxhash64("rank", "mark"), F.col("shares")).cast("int")
    streamed = streamed.select("shard", share.alias("share"), F.lit(1).alias("kind"), "rank", "mark", "text")
    dealt = sent.unionByName(streamed).repartition("shard", "share").sortWithinPartitions("shard", "share", "kind", "rank")
    return dealt.mapInArrow(_match_rows(length), "rank long, mark long, start int, stop int")


def _search(marked: DataFrame, length: int, gram: int, shard_words: int, task_chars: int):
    gram = min(gram, length)
    of = classes(marked)
    found = candidates(marked, of, length, gram)
    spans = matches(found, length, gram, shard_words, task_chars)
    spans = spans.groupBy("rank", "mark").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    return of, found, stored(spans, "spans")


def cut(text: str | None, spans: list | None, length: int, later: bool) -> tuple[int, int, bytes]:
    """Words, removed words and the kept words joined by one space."""
    words = (text or "").encode("utf-8").split()
    if later:
        return len(words), (len(words) if len(words) >= length else 0), (b"" if len(words) >= length else b" ".join(words))
    kept, end = [], 0
    for span in spans or []:
        kept += words[end : span["start"]]
        end = max(end, span["stop"])
    kept += words[end:]
    return len(words), len(words) - len(kept), b" ".join(kept)


def _cut_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, later = (batch.column(k) for k in range(3))
            results = [
                cut(texts[row].as_py(), spans[row].as_py(), length, later[row].as_py()) for row in range(batch.num_rows)
            ]
            n, gone, kept = zip(*results) if results else ([], [], [])
            columns = [
                pa.array(n, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ]
            names = ["n_words", "n_removed", "kept_sha256"]
            rest = batch.schema.names[3:]
            columns += [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays(columns, names + rest)

    return run


DIGEST = "n_words long, n_removed long, kept_sha256 string, rank long, mark long"


def digests(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    shard_words: int = SHARD_WORDS,
    task_chars: int = TASK_CHARS,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``.

    Null, empty and blank texts have no words and keep none. Texts of any length are searched whole; texts of
    fewer than ``length`` words keep all. A null id counts as larger than every id; rows of one id, or without
    id, never remove anything from each other. Repeated rows get a row each, all with the same result; an
    empty table gives an empty one. Columns of any other name are ignored.
    """
    marked = _marked(docs, id_column, text_column)
    of, found, spans = _search(marked, length, gram, shard_words, task_chars)
    first = of.select("mark", "other", F.col("rank").alias("least"))
    none = F.lit(None).cast("array<struct<start:int,stop:int>>")
    # what no span touches: one pass over the texts, whose results are narrow; then what spans touch
    whole = marked.select(
        "text", none.alias("spans"), F.lit(False).alias("later"), "rank", "mark", F.col("other")
    ).mapInArrow(_cut_rows(length), f"{DIGEST}, other long")
    touched = found.join(spans, ["rank", "mark"]).select("text", "spans", F.lit(False).alias("later"), "rank", "mark")
    touched = touched.mapInArrow(_cut_rows(length), DIGEST).select(
        "rank", "mark", F.col("n_removed").alias("gone"), F.col("kept_sha256").alias("left")
    )
    repeated = (F.col("rank") > F.col("least")) & (F.col("n_words") >= length)
    ids = F.when(F.col("rank") != LAST, F.col("rank")).alias("doc_id")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        whole.join(first, ["mark", "other"])
        .join(touched, ["rank", "mark"], "left")
        .select(
            ids,
            "n_words",
            F.when(repeated, F.col("n_words")).otherwise(F.coalesce("gone", "n_removed")).alias("n_removed"),
            F.when(repeated, nothing).otherwise(F.coalesce("left", "kept_sha256")).alias("kept_sha256"),
        )
    )


def _kept_text(length: int) -> Column:
    from pyspark.sql import types as T

    @F.arrow_udf(T.StringType())
    def run(text: pa.Array, spans: pa.Array, later: pa.Array) -> pa.Array:
        rows = zip(text.to_pylist(), spans.to_pylist(), later.to_pylist())
        return pa.array([None if t is None else cut(t, s, length, l)[2].decode("utf-8") for t, s, l in rows], pa.string())

    return run


def without_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    shard_words: int = SHARD_WORDS,
    task_chars: int = TASK_CHARS,
) -> DataFrame:
    """All rows and columns of ``docs``, the text reduced to its kept words (joined by one space).

    Null texts stay null. For the other cases see ``digests``.
    """
    rank, mark, other, least, spans = spare(docs, "repeat_rank", "repeat_mark", "repeat_other", "repeat_least", "repeat_spans")
    marked = _marked(docs, id_column, text_column)
    of, _, found = _search(marked, length, gram, shard_words, task_chars)
    text = F.coalesce(quoted(text_column), F.lit(""))
    keyed = docs.withColumns(
        {
            rank: F.coalesce(quoted(id_column).cast("long"), F.lit(LAST)),
            mark: F.xxhash64(text),
            other: F.xxhash64(F.lit(1), text),
        }
    )
    first = of.select(F.col("mark").alias(mark), F.col("other").alias(other), F.col("rank").alias(least))
    cuts = found.select(F.col("rank").alias(rank), F.col("mark").alias(mark), F.col("spans").alias(spans))
    joined = keyed.join(first, [mark, other]).join(cuts, [rank, mark], "left")
    kept = _kept_text(length)(quoted(text_column), F.col(spans), F.col(rank) > F.col(least))
    return joined.select(*(kept.alias(c) if c == text_column else quoted(c) for c in docs.columns))
