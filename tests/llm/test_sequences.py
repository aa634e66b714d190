import cases
import numpy as np
import pytest
from passbook.llm import sequences


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    slots = sequences.permuted(np.arange(n), n, 11)
    assert sorted(slots.tolist()) == list(range(n))
    assert np.array_equal(slots, sequences.permuted(np.arange(n), n, 11))
    # parts of the indexes get the slots that they have in the whole
    assert np.array_equal(sequences.permuted(np.arange(n)[::2], n, 11), slots[::2])
    if n > 100:
        assert not np.array_equal(slots, sequences.permuted(np.arange(n), n, 12))
        assert np.corrcoef(slots, np.arange(n))[0, 1] < 0.2


def tokenizer(spark):
    content = spark.read.format("binaryFile").load(sequences.VOCABULARY).first()["content"]
    return sequences.Tokenizer(bytes(content), sequences.PATTERN)


def test_round_trip(spark, tmp_path):
    docs = cases.frame(spark, ("part", "slot", "payload")).repartition(3)
    blocks = sequences.shards(docs, stride=64, block=8, partition_bytes=8 * 64 * 2 * 3)
    sequences.write(blocks, str(tmp_path / "shards"))
    stored = spark.read.parquet(str(tmp_path / "shards")).orderBy("block").collect()
    total = sum(b.n_sequences for b in stored)
    assert [b.block for b in stored] == list(range(len(stored)))
    assert all(b.n_sequences == 8 for b in stored[:-1]) and all(b.first_slot == 8 * b.block for b in stored)
    assert all(len(b.payload) == b.n_sequences * b.stride * b.width for b in stored)
    rows = sequences.read(spark, str(tmp_path / "shards")).collect()
    assert sorted(r.slot for r in rows) == list(range(total))
    own = tokenizer(spark)
    whole = [(r[0], [*(own.encoding.encode_ordinary(r[1]) if r[1] else []), own.end]) for r in cases.rows()]
    expected = sorted(((i, k, t[64 * k : 64 * k + 64]) for i, t in whole for k in range(-(-len(t) // 64))), key=repr)
    assert sorted(((r.doc_id, r.chunk, r.tokens) for r in rows), key=repr) == expected
    # reading on from a slot gives the rest
    late = sequences.read(spark, str(tmp_path / "shards"), total - 5).collect()
    assert {r.slot: r.tokens for r in late} == {r.slot: r.tokens for r in rows if r.slot >= total - 5}


def test_files_hold_ranges_in_order(spark, tmp_path):
    docs = spark.createDataFrame([(k, cases.prose(k, 50)) for k in range(200)], "doc_id string, text string")
    sequences.write(sequences.shards(docs, stride=32, block=4, partition_bytes=4 * 32 * 2 * 5), str(tmp_path / "s"))
    files = spark.read.parquet(str(tmp_path / "s")).selectExpr("input_file_name() as file", "block").collect()
    ranges = {}
    for row in files:
        ranges.setdefault(row.file, []).append(row.block)
    assert len(ranges) > 3
    for found in ranges.values():
        assert found == sorted(found) and max(found) - min(found) == len(found) - 1


def test_empty_table(spark):
    assert sequences.shards(cases.empty(spark)).count() == 0


def test_special_strings_are_text(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    (block,) = sequences.shards(docs).collect()
    own = tokenizer(spark)
    tokens = np.frombuffer(block.payload, "<u2")[: block.n_tokens[0]].tolist()
    assert tokens.count(own.end) == 1 and own.encoding.decode(tokens[:-1]) == "a <|endoftext|> b"


def test_order_does_not_depend_on_the_cut(spark):
    rows = [(k % 70 if k % 9 else None, cases.prose(k % 70, 40) if k % 11 else None) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    orders = []
    for cut in (docs.repartition(1), docs.repartition(7), docs.orderBy(docs.text.desc()).coalesce(3)):
        blocks = sequences.shards(cut, stride=16, block=8).orderBy("block").collect()
        orders.append([(b.block, b.doc_ids, b.chunks, b.n_tokens, bytes(b.payload)) for b in blocks])
    assert orders[0] == orders[1] == orders[2]
    other = sequences.shards(docs, stride=16, block=8, key=1).orderBy("block").collect()
    assert [b.doc_ids for b in other] != [o[1] for o in orders[0]]


def test_equal_rows_are_dealt_over_ranges(spark):
    docs = spark.createDataFrame([(1, "the same")] * 4000 + [(k, "x") for k in range(100)], "doc_id long, text string")
    plan = sequences.shards(docs, stride=8, block=64).select("doc_ids", "n_sequences")
    assert sum(r.n_sequences for r in plan.collect()) == 4100
