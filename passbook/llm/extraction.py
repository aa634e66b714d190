"""HTML extraction with host suffix arrays.

1. A host's pages are dealt into shards of bounded size, by the length of its pages' HTML. Tasks read each page's blocks
   (``markup``): the declared article, furniture by markup, and open blocks. Each shard becomes one row of a bucketed table, with the
   words of its pages compressed together. That is the only time that texts cross the network: every later step
   reads the shards in place and joins them with small tables.
2. All words of the pages, those of declared articles too, are the host's token streams. In each shard
   the streams are concatenated and a suffix array with common-prefix
   lengths gives all substrings of at least ``MIN_RUN`` tokens that occur on ``SHARE`` of the host's distinct
   pages, but on ``MIN_PAGES`` at least: a sentence that two pages quote is none, however large the host.
   Pages whose whole words (article included) are near copies count as one page: those that share a band of
   MinHash values and agree in ``ALIKE`` of all values, in shingles of five words.
   In hosts of several shards a run on enough pages of the host is on its part of them (the number over that of
   the shards) in one shard at least. Those runs are looked up by hash in all pages of the host and counted exactly.
3. Runs so covered are template text and go; unique runs stay. The markup has the last word: the text
   of a declared article is kept whole, however often it is repeated, and on pages that declare
   an article nothing outside of it is text.

A page is parsed once. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.llm import markup, textbatch
from passbook.llm.columns import quoted
from passbook.llm.textbatch import mixed
from passbook.workspace import fresh_path, stored

MIN_RUN = 10  # tokens of a repeated substring; a block's end is a token
MIN_PAGES = 3
SHARE = 0.3  # of a host's distinct pages
SHARD_TOKENS = 50_000
CHARS = 6  # of HTML for a token, when pages are dealt before they are read
ROW_SHARDS = 16  # shards of a bucket, about
MAX_BUCKETS = 20_000
LEVEL = 6  # of compression
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SHINGLE = 5
VALUES = 64  # MinHash values of a page
BAND = 4  # values that a band joins: a pair at similarity 0.8 misses all 16 bands once in 5,000
ALIKE = 48  # values of near copies that agree: 51 are expected at similarity 0.8, with a deviation of 3

_FOUND = "host string, shard int, several boolean, starts array<int>, likely array<bigint>"
_RUNS = "host string, shard int, family bigint, start int, gram bigint"
_ZONES = (markup.ARTICLE, markup.OPEN, markup.FURNITURE)


def packed(texts: list[str]) -> bytes:
    """Blocks (they hold no line ends), each ended by one, compressed."""
    return zstandard.compress("".join(f"{t}\n" for t in texts).encode("utf-8", "surrogatepass"), LEVEL)


def host_of(url):
    """The host of a URL in lower case, without user and port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


_SEEDS = mixed(np.arange(1, VALUES + 1, dtype=np.uint64))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PART = 4096  # shingles hashed at once
_PAGES = 64  # pages handed on at once
_STEPS = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def min_hashes(texts: list[str]) -> Iterator[np.ndarray]:
    """Per text, ``VALUES`` least hashes of its shingles of five words (fewer words: of the whole sequence; none: zeros)."""
    for words in textbatch.blocks(pa.array(texts, pa.string()), lower=False):
        hashes, ends = words.hashes(), np.cumsum(words.counts())
        for first, end in zip([0, *ends[:-1]], ends, strict=True):
            own = hashes[first:end]
            if not len(own):
                yield np.zeros(VALUES, dtype=np.uint64)
                continue
            n = max(1, len(own) - SHINGLE + 1)
            joined = np.zeros(n, dtype=np.uint64)
            for k in range(min(SHINGLE, len(own))):
                joined += own[k : k + n] * _STEPS[k]
            joined, least = mixed(joined), np.full(VALUES, 2**64 - 1, dtype=np.uint64)
            for at in range(0, n, _PART):
                spread = joined[at : at + _PART] ^ _SEEDS[:, None]
                spread *= _FACTOR
                np.minimum(least, spread.min(axis=1), out=least)
            yield least


def bands_of(values: np.ndarray) -> list[int]:
    """A signed hash for each band of ``BAND`` values, page by page."""
    rows = values.reshape(-1, BAND).astype(np.uint64)
    found = np.tile(np.arange(VALUES // BAND, dtype=np.uint64), len(rows) * BAND // VALUES)
    for k in range(BAND):
        found = mixed(found ^ rows[:, k])
    return found.view(np.int64).tolist()


@F.arrow_udf(T.ArrayType(T.LongType()))
def bands(values: pa.Array) -> pa.Array:
    """Bands of the kept bytes of pages' values: what agrees by chance ``alike`` tells apart."""
    found = bands_of(np.frombuffer(b"".join(values.to_pylist()), dtype=np.uint8))
    ends = np.arange(0, len(found) + 1, VALUES // BAND, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(found, pa.int64()))


@F.arrow_udf(T.BooleanType())
def alike(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether pages agree in ``ALIKE`` of their values, of which the last byte is kept."""
    left, right = (np.frombuffer(b"".join(x.to_pylist()), dtype=np.uint8).reshape(-1, VALUES) for x in (a, b))
    return pa.array((left == right).sum(axis=1) >= ALIKE)


def families(streams: DataFrame) -> DataFrame:
    """``host, page, family``: the least page that a page is a near copy of, for pages that are one of another.

    In each band the least page is the one that all others are compared with, so a group of copies
    costs a row for each page and band, never a pair of copies.
    """
    values = streams.filter("n_tokens > 0").select("host", "page", "values")
    each = streams.filter("n_tokens > 0").select("host", "page", F.explode("bands").alias("band"))
    first = each.groupBy("host", "band").agg(F.min("page").alias("first"), F.max("page").alias("last"))
    # values follow only to pages that share a band with another
    first = stored(first.filter("first < last").drop("last"), "bands")
    pairs = stored(each.join(first, ["host", "band"]).select("host", "page", "first").distinct(), "pairs")
    ends = pairs.select("host", "page").union(pairs.select("host", "first")).distinct()
    known = stored(values.join(ends, ["host", "page"], "left_semi").dropDuplicates(["host", "page"]), "values")
    least = known.select("host", F.col("page").alias("first"), F.col("values").alias("_least"))
    near = pairs.join(known, ["host", "page"]).join(least, ["host", "first"]).filter(alike(F.col("values"), F.col("_least")))
    return near.groupBy("host", "page").agg(F.min("first").alias("family"))


_WORD = textbatch.byte_class(b" \n")


def tokens_of(texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens, in order: words, and each block's end; and which are such ends."""
    data = np.frombuffer(texts, dtype=np.uint8)
    word, end = _WORD[data], data == 10
    inside = np.zeros(len(data), dtype=bool)
    inside[1:] = word[:-1] & word[1:]
    starts = np.flatnonzero(word & ~inside | end)
    blank = np.flatnonzero(~word)  # one follows every word: blocks are ended
    marks = end[starts]
    ends = np.where(marks, starts + 1, blank[np.searchsorted(blank, starts)])
    spans = textbatch.Words(0, 1, data, starts, ends, np.zeros(0), np.zeros(0), np.zeros(0))
    return spans.hashes(), marks


def suffix_array(ids: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``ids``, in the order of their first ``limit`` numbers at least (prefix doubling), and the prefix length,
    up to ``limit``, that each shares with the one before."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    width = np.int64(max(1, n).bit_length())
    while step < min(n, limit):
        later = np.zeros(n, dtype=np.int64)
        later[:-step] = rank[step:] + 1
        pair = rank << width | later
        if 3 * int(width) < 63:  # with its place each pair is one number, and numbers sort fast
            placed = np.sort(pair << width | np.arange(n))
            order, pair = placed & ((1 << width) - 1), placed >> width
        else:
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
        changed = pair[1:] != pair[:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(changed)))
        if changed.all():
            break
        step *= 2
    return order, shared_prefixes(ids, order, limit)


def shared_prefixes(ids: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix lengths of neighbours in a suffix array, up to ``limit``; all neighbours step by step."""
    n = len(ids)
    shared = np.zeros(n, dtype=np.int64)
    a, b = order[1:].copy(), order[:-1].copy()
    open_ = np.arange(1, n)
    for _ in range(limit):
        if not len(open_):
            break
        same = (np.maximum(a, b) < n) & (ids[np.minimum(a, n - 1)] == ids[np.minimum(b, n - 1)])
        open_, a, b = open_[same], a[same] + 1, b[same] + 1
        shared[open_] += 1
    return shared


def repeated(ids: np.ndarray, page: np.ndarray, min_run: int, min_pages: int) -> np.ndarray:
    """Positions where a run of ``min_run`` tokens starts that occurs in ``min_pages`` distinct pages.

    ``ids`` ends every page with a number of its own, so no run crosses pages.
    """
    if len(ids) < min_run:
        return np.empty(0, dtype=np.int64)
    order, shared = suffix_array(ids, min_run)
    group = np.cumsum(shared < min_run) - 1  # suffixes that agree in min_run tokens stand together
    count = int(page.max()) + 1
    pairs = np.unique(group * count + page[order])
    pages = np.bincount(pairs // count, minlength=group[-1] + 1)
    return np.sort(order[pages[group] >= min_pages])


class _Shard:
    """A row of the shards' table: its pages' tokens one after another."""

    def __init__(self, row: dict):
        self.raw = zstandard.decompress(row["texts"])
        self.tokens, self.marks = tokens_of(self.raw)
        self.bounds = np.cumsum([0, *row["n_tokens"]])
        same = {p["page"]: p["family"] for p in row.get("families") or []}
        self.families = [same.get(p, p) for p in row["page"]] if "page" in row else []

    def runs(self, min_run: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and signed 64-bit hash of each run of ``min_run`` tokens within a page."""
        n = max(0, len(self.tokens) - min_run + 1)
        joined = np.zeros(n, dtype=np.uint64)
        for k, step in enumerate(mixed(np.arange(1, min_run + 1, dtype=np.uint64)) | np.uint64(1)):
            joined += self.tokens[k : k + n] * step
        page = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        inside = np.flatnonzero(page[:n] == page[min_run - 1 :]) if n else np.empty(0, dtype=np.int64)
        return inside, mixed(joined[inside]).view(np.int64)

    def repeated(self, min_run: int, count: int) -> np.ndarray:
        """Where runs start that occur on ``count`` pages."""
        # near copies are one page: they do not make text a template
        numbers: dict[int, int] = {}
        page = np.array([numbers.setdefault(f, len(numbers)) for f in self.families], dtype=np.int64)
        sizes = np.diff(self.bounds)
        # each page ends with a number of its own
        ids = np.insert(np.unique(self.tokens, return_inverse=True)[1].astype(np.int64), self.bounds[1:], -1 - np.arange(len(sizes)))
        places = np.insert(np.arange(len(self.tokens)), self.bounds[1:], -1)
        return places[repeated(ids, np.repeat(page, sizes + 1), min_run, count)]


def _shard(min_run: int):
    """The template runs found in each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                shards, needed = row["shards"], row["needed"]
                shard, hits, likely = _Shard(row), [], []
                if shards > 1:
                    # of needed pages in all shards, one shard at least holds its part
                    at, grams = shard.runs(min_run)
                    part = shard.repeated(min_run, -(-needed // shards))
                    likely = np.unique(grams[np.isin(at, part)])
                else:
                    hits = shard.repeated(min_run, needed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["host"]], pa.string()), pa.array([row["shard"]], pa.int32()), pa.array([shards > 1]),
                     pa.array([hits], pa.list_(pa.int32())), pa.array([likely], pa.list_(pa.int64()))],
                    ["host", "shard", "several", "starts", "likely"],
                )

    return run


def _runs(min_run: int):
    """Every run of the pages by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                shard = _Shard(row)
                at, grams = shard.runs(min_run)
                family = np.repeat(np.array(shard.families, dtype=np.int64), np.diff(shard.bounds))[at]
                own = [pa.repeat(pa.scalar(row["host"], pa.string()), len(at)), pa.repeat(pa.scalar(row["shard"], pa.int32()), len(at))]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(family), pa.array(at.astype(np.int32)), pa.array(grams)], ["host", "shard", "family", "start", "gram"]
                )

    return run


_READ = "n bigint, page bigint, n_tokens bigint, texts binary, zones binary, values binary"
_READ_ARROW = [("n", pa.int64()), ("page", pa.int64()), ("n_tokens", pa.int64()), ("texts", pa.binary()),
               ("zones", pa.binary()), ("values", pa.binary())]


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages read: equal rows of a batch once, with their number."""
    for batch in batches:
        seen: dict[str, int] = {}
        for key in batch.column("key").to_pylist():
            seen[key] = seen.get(key, 0) + 1
        left = dict(seen)
        first = [k for k, key in enumerate(batch.column("key").to_pylist()) if left.pop(key, None)]
        batch = batch.take(pa.array(first, pa.int64()))
        for at in range(0, batch.num_rows, _PART):
            pages = batch.slice(at, _PART)
            out = {name: [] for name, _ in _READ_ARROW}
            out["n"] = [seen[key] for key in pages.column("key").to_pylist()]
            read = [markup.read(text).blocks for text in pages.column("html").to_pylist()]
            whole = ["\n".join(t for _, t in blocks) for blocks in read]
            for blocks, text, values in zip(read, whole, min_hashes(whole), strict=True):
                texts = [t for _, t in blocks]
                out["texts"].append(packed(texts))
                out["zones"].append(bytes(_ZONES.index(z) for z, _ in blocks))
                out["page"].append(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63))
                out["values"].append(values.astype(np.uint8).tobytes())
                out["n_tokens"].append(sum(t.count(" ") + 2 for t in texts))
            same = [pages.column(c) for c in ("host", "shard", "page_id", "url")]
            own = [pa.array(out[name], kind) for name, kind in _READ_ARROW]
            yield pa.RecordBatch.from_arrays([*same, *own], ["host", "shard", "page_id", "url", *out])


def _gather(table: pa.Table) -> pa.Table:
    """A shard's pages as one row."""
    host, shard = table.column("host")[:1], table.column("shard")[:1]
    texts = zstandard.compress(b"".join(zstandard.decompress(t) for t in table.column("texts").to_pylist()), LEVEL)
    lists = ("page_id", "url", "n", "page", "n_tokens", "zones", "values")
    ends = pa.array([0, table.num_rows], pa.int32())
    columns = [pa.ListArray.from_arrays(ends, pa.concat_arrays(table.column(c).chunks)) for c in lists]
    return pa.table([host, shard, pa.array([texts], pa.binary()), *columns], ["host", "shard", "texts", *lists])


def _keep(min_run: int):
    """The declared article, or open text without its covered runs; how many of the page's words were covered and were not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.select(["texts", "n", "n_tokens", "zones", "starts"]).slice(k, 1).to_pylist()[0]
                shard = _Shard(row)
                covers = np.zeros(len(shard.tokens) + 1, dtype=np.int64)
                at = np.array(row["starts"] or [], dtype=np.int64)
                np.add.at(covers, at, 1)
                np.add.at(covers, at + min_run, -1)
                gone = (np.cumsum(covers)[:-1] > 0) & ~shard.marks
                lost = np.concatenate(([0], np.cumsum(gone)))[shard.bounds]
                words = np.concatenate(([0], np.cumsum(~shard.marks)))[shard.bounds]
                lines = shard.raw.decode("utf-8", "replace").split("\n")
                kept, line = [], 0
                for number, zones in enumerate(row["zones"]):
                    texts = lines[line : line + len(zones)]
                    line += len(zones)
                    wanted = markup.ARTICLE if _ZONES.index(markup.ARTICLE) in zones else markup.OPEN
                    if wanted == markup.OPEN and lost[number + 1] > lost[number]:
                        place = shard.bounds[number]
                        for j, text in enumerate(texts):
                            own = text.split(" ")
                            texts[j] = " ".join(w for w, g in zip(own, gone[place : place + len(own)], strict=True) if not g)
                            place += len(own) + 1
                    kept.append("\n".join(t for t, z in zip(texts, zones, strict=True) if t and _ZONES[z] == wanted))
                covered, total = np.diff(lost), np.diff(words)
                out = pa.RecordBatch.from_arrays(
                    [batch.column("page_id")[k].values, batch.column("url")[k].values, pa.array(kept, pa.string()),
                     pa.array(covered), pa.array(total - covered)],
                    ["page_id", "url", "text", "n_template_words", "n_unique_words"],
                )
                for first in range(0, len(kept), _PAGES):
                    pages, times = out.slice(first, _PAGES), row["n"][first : first + _PAGES]
                    for part in range(0, sum(times), _PAGES) if max(times) > 1 else ():
                        yield pages.take(pa.array(np.repeat(np.arange(len(times)), times)[part : part + _PAGES]))
                    if max(times) == 1:
                        yield pages

    return run


def _in_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    """``host, shard, texts, …``: a row for each shard, in a bucketed table, so that joins on both columns leave it in place."""
    spark, name = rows.sparkSession, f"passbook_{uuid.uuid4().hex}"
    fields = {f.name: f.dataType for f in rows.schema.fields}
    lists = ("page_id", "url", "n", "page", "n_tokens", "zones", "values")
    layout = T.StructType([
        T.StructField("host", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("texts", T.BinaryType()),
        *(T.StructField(c, T.ArrayType(fields[c])) for c in lists),
    ])
    shards = rows.repartition(buckets, "host", "shard").groupBy("host", "shard").applyInArrow(_gather, layout)
    path = fresh_path(spark, "shards")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # the shuffle's files go when the table is written
    try:
        shards.write.bucketBy(buckets, "host", "shard").option("path", path).format("parquet").saveAsTable(name)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay: the path is not the catalog's
    return table


def extract(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    min_run: int = MIN_RUN,
    min_pages: int = MIN_PAGES,
    share: float = SHARE,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """``page_id, url, text, n_chars, n_template_words, n_unique_words`` for every row.

    ``text``: the declared article, or on a page without one the open blocks less the runs its host repeats.
    Null and empty pages have empty text. Pages without a readable host share the empty host. Repeated rows
    and near copies count as one page and give a row each. A very long page is read whole, its words are
    one stream of one shard. Runs that stand on equally many pages are treated alike, so ties decide
    nothing. An empty table gives an empty one. Other columns, whatever their names, are ignored.
    """
    blank = F.lit("")
    rows = pages.select(
        quoted(id_column).alias("page_id"), quoted(url_column).alias("url"), quoted(html_column).alias("html")
    )
    parts = [F.md5(F.coalesce(F.col(c).cast("string"), blank).cast("binary")) for c in ("page_id", "url", "html")]
    rows = rows.withColumn("host", host_of(F.col("url")))
    chars = F.sum(F.coalesce(F.length("html"), F.lit(0)) + 1)
    sizes = rows.groupBy("host").agg(F.ceil(chars / F.lit(CHARS * shard_tokens)).cast("int").alias("shards"))
    sizes = stored(sizes, "sizes")
    total = sizes.agg(F.sum("shards")).first()[0] or 0
    buckets = min(MAX_BUCKETS, 1 + total // ROW_SHARDS)
    # one row for each host of several shards: few, whatever the number of hosts
    rows = rows.join(F.broadcast(sizes.filter("shards > 1")), "host", "left").withColumn("key", F.md5(F.concat(*parts).cast("binary")))
    shard = F.pmod(F.xxhash64("key"), F.coalesce("shards", F.lit(1))).cast("int").alias("shard")
    rows = rows.select("host", shard, "page_id", "url", "key", "html")
    layout = T.StructType([*rows.select("host", "shard", "page_id", "url").schema.fields, *T._parse_datatype_string(_READ).fields])
    shards = _in_buckets(rows.mapInArrow(_streams, layout), buckets)

    streams = shards.select("host", "shard", F.inline(F.arrays_zip("page", "n_tokens", "values")))
    streams = streams.withColumn("bands", bands("values"))
    near = stored(families(streams), "families")
    whole = F.coalesce("family", "page")
    distinct = streams.filter("n_tokens > 0").select("host", "page").join(near, ["host", "page"], "left")
    counts = distinct.select("host", whole.alias("family")).distinct().groupBy("host").agg(F.count("*").alias("n_pages"))
    needed = F.greatest(F.lit(min_pages), F.ceil(F.col("n_pages") * F.lit(share))).cast("int")
    dealt = shards.select("host", "shard").groupBy("host").agg(F.count("*").cast("int").alias("shards"))
    hosts = stored(dealt.join(counts, "host").select("host", "shards", needed.alias("needed")), "hosts")
    alike_pages = streams.select("host", "shard", "page").join(near, ["host", "page"])
    alike_pages = alike_pages.groupBy("host", "shard").agg(F.collect_set(F.struct("page", "family")).alias("families"))
    notes = shards.select("host", "shard").join(hosts, "host").join(alike_pages, ["host", "shard"], "left")
    notes = stored(notes, "notes")
    words = shards.select("host", "shard", "texts", "page", "n_tokens")

    found = stored(words.join(notes, ["host", "shard"]).mapInArrow(_shard(min_run), _FOUND), "runs")
    likely = stored(found.filter("several").select("host", F.explode("likely").alias("gram")).distinct(), "likely_runs")
    several = stored(notes.join(likely.select("host").distinct(), "host", "left_semi"), "searched")
    runs = words.join(several, ["host", "shard"]).mapInArrow(_runs(min_run), _RUNS)
    runs = stored(runs.join(likely, ["host", "gram"]), "template_runs")
    often = (
        runs.groupBy("host", "gram", "family").agg(F.lit(1).alias("one"))
        .groupBy("host", "gram").agg(F.count("*").alias("n_pages"))
        .join(hosts, "host").filter("n_pages >= needed").select("host", "gram")
    )
    more = runs.join(often, ["host", "gram"]).groupBy("host", "shard").agg(F.collect_list("start").alias("starts"))
    alone = found.filter("not several and size(starts) > 0").select("host", "shard", "starts")
    marks = stored(alone.unionByName(more), "marks")
    known = shards.drop("page", "values").join(marks, ["host", "shard"], "left")
    kinds = rows.select("page_id", "url").schema.fields
    counted = T._parse_datatype_string("text string, n_template_words bigint, n_unique_words bigint").fields
    kept = known.mapInArrow(_keep(min_run), T.StructType([*kinds, *counted]))
    return kept.select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template_words", "n_unique_words"
    )
