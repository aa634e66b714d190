"""Token sequences in training order, as binary shards of fixed stride.

1. Documents are range-partitioned and sorted by a hash of id and text, so that their order does not depend on how
   the input is cut. Tasks tokenise whole texts, number the sequences of their range from zero and write the
   tokens once.
2. Range totals, one row per task, give every sequence a dense index in 0 ... N-1.
3. A keyed Feistel network permutes the indexes: it runs on the least even number of bits that holds N,
   and walks on along its cycle while a value is N or more. Index and key alone give the slot;
   nothing is drawn, sorted or looked up.
4. Partition k takes the slots of range k, sorts them and packs them into blocks of ``block`` sequences
   with ``stride`` tokens each. Slot s lies in block s // block at byte (s % block) * stride * width, so
   a reader can start at any slot and read on in order.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from passbook.llm.columns import quoted
from passbook.llm.textbatch import mixed
from passbook.workspace import fresh_path

STRIDE = 512
BLOCK = 256
PARTITION_BYTES = 16 << 20
ROUNDS = 6
KEY = 0x5EED
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's public tokenizer cuts text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of sequences that a task hands on at once.
_BATCH = 4 << 20


def permuted(index: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The slots of ``index``: a permutation of 0 ... n-1 that ``key`` chooses."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mixed(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key))

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mixed(right ^ k) & mask)
        return left << half | right

    slots = network(index.astype(np.uint64))
    outside = np.flatnonzero(slots >= n)
    while len(outside):
        slots[outside] = network(slots[outside])
        outside = outside[slots[outside] >= n]
    return slots.astype(np.int64)


class Tokenizer:
    """A byte-level BPE given by its rank file; the id after the last rank ends a document."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.end = max(table.values()) + 1
        self.dtype = np.dtype("<u2") if self.end < 1 << 16 else np.dtype("<u4")

    def encode(self, text: str | None) -> np.ndarray:
        found = np.array([self.end], dtype=self.dtype)
        if not text:
            return found
        # signs of special tokens in a text are ordinary text
        return np.concatenate((self.encoding.encode_to_numpy(text, disallowed_special=()).astype(self.dtype), found))


_OPENED: dict[str, Tokenizer] = {}


def _tokenise(ranks, pattern: str, stride: int):
    name = f"{zlib.crc32(ranks.value)} {len(ranks.value)} {pattern}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        if name not in _OPENED:  # once in a worker
            _OPENED[name] = Tokenizer(ranks.value, pattern)
        tokenizer = _OPENED[name]
        names = ["part", "first", "n_sequences", "doc_id", "tokens"]
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            begin, out, size = 0, [], 0
            for row, text in enumerate(texts):
                out.append(tokenizer.encode(text.as_py()))
                size += out[-1].nbytes
                if size >= _BATCH or row + 1 == len(texts):
                    counts = np.array([-(-len(x) // stride) for x in out], dtype=np.int64)
                    firsts = first + np.cumsum(counts) - counts
                    first += int(counts.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(out), pa.int32()), pa.array(firsts), pa.array(counts),
                         ids.slice(begin, len(out)), pa.array([x.tobytes() for x in out], pa.binary())],
                        names,
                    )
                    begin, out, size = row + 1, [], 0

    return run


def _cut(n: int, key: int, stride: int, width: int, end: int, per_partition: int):
    """Sequences of the documents with their slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = np.dtype(f"<u{width}")
        for batch in batches:
            firsts, counts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            begin = 0
            while begin < batch.num_rows:
                # so many documents that their sequences make one batch; a long document is a batch of its own
                stop = max(begin + 1, int(np.searchsorted(np.cumsum(counts[begin:]), _BATCH // (stride * width), "right")) + begin)
                some = counts[begin:stop]
                total = int(some.sum())
                grid = np.full((total, stride), end, dtype=dtype)
                lengths = np.empty(total, dtype=np.int32)
                chunks = np.empty(total, dtype=np.int32)
                at = 0
                for row in range(begin, stop):
                    tokens = np.frombuffer(batch.column(3)[row].as_buffer(), dtype=dtype)
                    k = int(counts[row])
                    grid[at : at + k].reshape(-1)[: len(tokens)] = tokens
                    chunks[at : at + k] = np.arange(k)
                    lengths[at : at + k] = np.minimum(stride, len(tokens) - stride * np.arange(k))
                    at += k
                within = np.arange(total) - np.repeat(np.cumsum(some) - some, some)
                slots = permuted(np.repeat(firsts[begin:stop], some) + within, n, key)
                ids = batch.column(2).take(pa.array(np.repeat(np.arange(begin, stop), some)))
                payload = pa.Array.from_buffers(
                    pa.binary(), total,
                    [None, pa.py_buffer(np.arange(total + 1, dtype=np.int32) * (stride * width)), pa.py_buffer(grid.tobytes())],
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array((slots // per_partition).astype(np.int32)), pa.array(slots), ids, pa.array(chunks), pa.array(lengths), payload],
                    ["part", "slot", "doc_id", "chunk", "n_tokens", "payload"],
                )
                begin = stop

    return run


def _pack(block: int, stride: int, width: int, id_type: pa.DataType):
    """Blocks of a partition's sorted sequences."""
    schema = pa.schema(
        [("block", pa.int64()), ("first_slot", pa.int64()), ("n_sequences", pa.int32()), ("stride", pa.int32()),
         ("width", pa.int32()), ("doc_ids", pa.list_(id_type)), ("chunks", pa.list_(pa.int32())),
         ("n_tokens", pa.list_(pa.int32())), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number = None

        def packed() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            lists = [rows.column(c).to_pylist() for c in ("doc_id", "chunk", "n_tokens")]
            content = b"".join(rows.column("payload").to_pylist())
            values = [[number], [number * block], [rows.num_rows], [stride], [width], *([x] for x in lists), [content]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            own = batch.column(0).to_numpy() // block
            for first in np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else []:
                if number is not None and own[first] != number:
                    yield packed()
                    held = []
                number = int(own[first])
                held.append(batch.slice(first, int(np.searchsorted(own, number, "right")) - int(first)))
        if held:
            yield packed()

    return run


def shards(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    stride: int = STRIDE,
    block: int = BLOCK,
    key: int = KEY,
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """One row per block of ``block`` sequences, range-partitioned and sorted by slot.

    ``block, first_slot, n_sequences, stride, width, doc_ids, chunks, n_tokens, payload``: ``payload`` has
    n_sequences * stride little-endian numbers of ``width`` bytes; sequence k of the block is chunk
    ``chunks[k]`` of document ``doc_ids[k]`` with ``n_tokens[k]`` tokens, the rest is filled with the end
    token. Every document ends with the end token; a null or empty text is that token alone. Null ids stay
    null, repeated rows are documents of their own, other columns are ignored, an empty table has no block.

    The order depends on the key and on the rows of ``docs`` alone, not on their files, splits or partitions.
    Equal rows have equal sequences, so which of them comes first (a tie) decides nothing; a large group of
    them is dealt over the ranges by a random number. A very long text is tokenised whole, as one document
    of many sequences. The written shards (``write``) are read without the key.
    """
    spark = docs.sparkSession
    content = spark.read.format("binaryFile").load(vocabulary).select("content").first()[0]  # the rank file
    tokenizer = Tokenizer(bytes(content), pattern)
    width, end = tokenizer.dtype.itemsize, tokenizer.end
    ranks = spark.sparkContext.broadcast(bytes(content))
    rows = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType
    id_text, text_of = F.col("doc_id").cast("string"), F.col("text")
    flags = F.concat(F.isnull(id_text).cast("string"), F.isnull(text_of).cast("string"))
    rank = F.md5(F.concat_ws("|", F.lit(str(key)), flags, id_text, F.md5(text_of.cast("binary"))).cast("binary"))
    # equal rows are cut by a number of their own: a seeded one, which a repeated task draws again
    ranked = rows.withColumn("rank", rank).withColumn("tie", F.rand(key))
    rows = ranked.repartitionByRange("rank", "tie").sortWithinPartitions("rank").select("doc_id", "text")
    arrow = to_arrow_type(kind)
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("n_sequences", T.LongType()),
         T.StructField("doc_id", kind), T.StructField("tokens", T.BinaryType())]
    )
    path = fresh_path(spark, "tokens")
    rows.mapInArrow(_tokenise(ranks, pattern, stride), schema).write.option("compression", "zstd").parquet(path)
    tokens = spark.read.schema(schema).parquet(path)
    totals = tokens.groupBy("part").agg(F.sum("n_sequences").alias("n"))  # one row per task of the scan
    n = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ahead = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(F.col("part").alias("of"), F.coalesce(ahead, F.lit(0)).alias("offset"))
    placed = tokens.join(F.broadcast(offsets), F.col("part") == F.col("of")).select(
        (F.col("first") + F.col("offset")).alias("first"), "n_sequences", "doc_id", "tokens"
    )
    blocks = max(1, partition_bytes // (block * stride * width))
    per_partition = blocks * block
    cut = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("slot", T.LongType()), T.StructField("doc_id", kind),
         T.StructField("chunk", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()), T.StructField("payload", T.BinaryType())]
    )
    sequences = placed.mapInArrow(_cut(n, key, stride, width, end, per_partition), cut)
    dealt = sequences.repartitionById(max(1, -(-n // per_partition)), F.col("part")).sortWithinPartitions("slot")
    packed = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("first_slot", T.LongType()), T.StructField("n_sequences", T.IntegerType()),
         T.StructField("stride", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("doc_ids", T.ArrayType(kind)),
         T.StructField("chunks", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.ArrayType(T.IntegerType())),
         T.StructField("payload", T.BinaryType())]
    )
    return dealt.select("slot", "doc_id", "chunk", "n_tokens", "payload").mapInArrow(_pack(block, stride, width, arrow), packed)


def write(blocks: DataFrame, path: str) -> None:
    """One file per range partition. Spark commits a file when its task is done, so a lost task is run again."""
    blocks.write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str, first_slot: int = 0) -> DataFrame:
    """``slot, doc_id, chunk, tokens`` from ``first_slot`` on.

    All blocks but the last are full, so earlier ones are skipped by the files' statistics of ``block``.
    """
    blocks = spark.read.parquet(path)
    head = blocks.filter("block = 0").select("n_sequences").first()
    if head is not None:
        blocks = blocks.filter(F.col("block") >= first_slot // head[0])

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def unpacked(payloads: pa.Array, stride: pa.Array, width: pa.Array, lengths: pa.Array) -> pa.Array:
        rows = []
        for content, s, w, n in zip(payloads.to_pylist(), stride.to_pylist(), width.to_pylist(), lengths.to_pylist(), strict=True):
            grid = np.frombuffer(content, dtype=f"<u{w}").reshape(-1, s)
            rows.append([grid[k, :size].tolist() for k, size in enumerate(n)])
        return pa.array(rows, pa.list_(pa.list_(pa.int32())))

    tokens = unpacked("payload", "stride", "width", "n_tokens")
    each = blocks.select("first_slot", "doc_ids", "chunks", tokens.alias("tokens"))
    each = each.select("first_slot", F.posexplode(F.arrays_zip("doc_ids", "chunks", "tokens")).alias("k", "s"))
    return each.select(
        (F.col("first_slot") + F.col("k")).alias("slot"), F.col("s.doc_ids").alias("doc_id"), F.col("s.chunks").alias("chunk"),
        F.col("s.tokens").alias("tokens"),
    ).filter(F.col("slot") >= first_slot)
