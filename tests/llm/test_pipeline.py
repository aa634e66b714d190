import re
from collections import Counter

import cases
import corpus_pipeline
import pytest
from passbook.llm import mixing, quality, sequences
from test_decontaminate import expected as contained
from test_mixing import expected_targets, size_of
from test_simhash import expected_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    out, docs = [], spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((name, docs, result))
        docs = result
    return out


def test_order_and_columns(stages):
    assert [re.split(r" |/", n)[0] for n, *_ in stages] == ["quality", "SimHash", "benchmark", "mixing", "token-ID"]
    for _, docs, result in stages[:-1]:
        assert result.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < result.count() <= 3 * docs.count()


def test_quality_keeps_what_the_model_keeps(spark, stages):
    _, docs, result = stages[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, quality.grades_of(labels))
    kept = {r.doc_id for r in quality.grade(docs, model).collect() if r.tails[0] >= quality.CUT}
    assert {r.doc_id for r in result.collect()} == kept
    good = {r.doc_id for r in labels.filter("quality = 1 and toxic = 0").collect()}
    assert len(good & kept) >= 0.98 * len(good)


def test_one_of_each_group_stays(stages):
    _, docs, result = stages[1]
    rows = expected_components([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in result.collect()) == sorted({r[2] for r in rows})


def test_contaminated_documents_go(spark, stages):
    _, docs, result = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, *_ in contained([(r.doc_id, r.text) for r in docs.collect()], items)}
    assert bad and {r.doc_id for r in result.collect()} == {r.doc_id for r in docs.collect()} - bad


def test_sources_come_near_their_targets(stages):
    _, docs, result = stages[3]
    rows = [(r.doc_id, r.source, size_of(r.text)) for r in docs.collect()]
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    served, times = Counter(), Counter()
    for r in result.collect():
        served[r.source] += size_of(r.text)
        times[r.doc_id] += 1
    for source, target in expected_targets(dict(sizes)).items():
        assert abs(served[source] - target) <= max(s for _, x, s in rows if x == source) / 2 + 1
    assert max(times.values()) <= mixing.MAX_PASSES


def test_shards_hold_every_token(spark, stages):
    _, docs, result = stages[4]
    blocks = result.collect()
    content = spark.read.format("binaryFile").load(sequences.VOCABULARY).first()["content"]
    own = sequences.Tokenizer(bytes(content), sequences.PATTERN)
    expected = Counter()
    for r in docs.collect():
        expected[r.doc_id] += len(own.encoding.encode_ordinary(r.text)) + 1
    found = Counter()
    for b in blocks:
        for i, n in zip(b.doc_ids, b.n_tokens):
            found[i] += n
    assert found == expected
    assert sum(b.n_sequences for b in blocks) == max(b.first_slot + b.n_sequences for b in blocks)


def test_run_equals_the_stages(spark, stages):
    ran = corpus_pipeline.run(spark, SF).collect()
    found = Counter((i, n) for b in ran for i, n in zip(b.doc_ids, b.n_tokens))
    assert found == Counter((i, n) for b in stages[4][2].collect() for i, n in zip(b.doc_ids, b.n_tokens))


CLASHING = ("key", "size", "fp", "text_key", "simhash_id", "mix_key", "mix_finish", "quality_tails", "doc_ids", "payload", "part")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_edge_rows(spark, name, stage):
    """Nulls, blank and very long texts, repeated rows and ids, and extra columns with the stages' own names."""
    docs = cases.frame(spark, CLASHING)
    result = stage(spark, docs, SF)
    if stage is corpus_pipeline.token_shards:
        assert sum(len(b.doc_ids) for b in result.collect()) >= len(cases.rows())
    else:
        assert result.columns == docs.columns
        assert {r[:2] for r in cases.bag(result, "doc_id", "text")} <= {r[:2] for r in cases.rows()}
    assert stage(spark, cases.empty(spark), SF).count() == 0
