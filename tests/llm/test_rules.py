import re
from collections import Counter

import cases
from passbook.llm import rules
from pyspark.sql import functions as F

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if runs[tuple(words[k : k + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    "a b c d e a b c d e", "a a a a a a a a", "one two three four five six one two three four five", "l1 x\nl1 x\n\n \nl1 x\nl1 y",
    "é日本  wide # <tag> $5 & | 100%", "\x0b\x0ctabs\tand\rreturns", "a b c d", "A a A a A a A a A a", " ".join(["w"] * 3000),
    " ".join(f"w{k % 700}" for k in range(20_000)), "\n".join(["same line here"] * 50),
]


def test_statistics_equal_definition(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(100 + k, r[1]) for k, r in enumerate(cases.rows())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: tuple(r[c] for c in COUNTS) for r in rules.statistics(docs).collect()}
    assert found == {i: expected(t) for i, t in rows}


def test_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r.doc_id: tuple(r[c] for c in COUNTS) for r in rules.statistics(docs).collect()}
    assert found == {r.doc_id: expected(r.text) for r in docs.collect()}


def statistics_rows(spark, n=400):
    """Rows that are poor if symbols are frequent, or if words are long and capitals frequent."""
    out = []
    for k in range(n):
        symbols, capitals, chars = (k * 7) % 100, (k * 13) % 50, 400 + (k * 31) % 600
        poor = symbols > 60 or (capitals > 30 and chars > 800)
        out.append((k, 100, chars, symbols, 0, 0, capitals, 0, 90, int(poor)))
    names = [*COUNTS, "n_capitals", "n_marks", "n_distinct"]
    return spark.createDataFrame(out, "doc_id long, " + ", ".join(f"{c} long" for c in names) + ", poor int")


def test_learned_list_finds_the_rules(spark):
    rows = statistics_rows(spark)
    found = rules.learn(rows)
    assert {t.feature for rule in found for t in rule} >= {"symbols_per_word", "capitals_per_word", "chars_per_word"}
    judged = rows.withColumn("rule", rules.as_column(found))
    assert judged.filter((F.col("poor") == 1) != F.col("rule").isNotNull()).count() < 0.08 * rows.count()
    assert judged.filter("poor = 0 and rule is not null").count() < 0.02 * rows.count()
    assert rules.learn(rows.repartition(3)) == found
    text = rules.as_column(found)._jc.toString()
    assert "CASE WHEN" in text or "WHEN" in text


def test_one_sided_labels_learn_nothing(spark):
    rows = statistics_rows(spark)
    assert rules.learn(rows.filter("poor = 0")) == rules.learn(rows.limit(0)) == []
    assert rules.learn(rows.withColumn("poor", F.lit(None).cast("int"))) == []
    assert rules.as_column([])._jc.toString() is not None


def test_no_rules_from_noise(spark):
    noise = statistics_rows(spark).withColumn("poor", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).cast("int"))
    judged = noise.withColumn("rule", rules.as_column(rules.learn(noise)))
    assert judged.filter("rule is not null").count() < 0.05 * noise.count()


def test_edge_rows(spark):
    docs = cases.frame(spark, ("n_words", "words", "runs", "rule", "kept"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 0), (3, None)], "doc_id long, quality int")
    found = rules.judge(docs, labels)
    rows = [(r.doc_id, r.base_failed, r.kept) for r in found.collect()]
    base = [(i, (e := expected(t))[0] < 10 or 100 * e[4] > 20 * e[0]) for i, t, *_ in cases.rows()]
    assert sorted(((i, b) for i, b, _ in rows), key=repr) == sorted(base, key=repr)
    assert all(not k for _, b, k in rows if b)
    assert rules.judge(cases.empty(spark), labels).count() == 0
    assert rules.judge(docs, labels.limit(0)).filter("kept = base_failed").count() == 0


def test_poor_documents_go_and_good_ones_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = rules.judge(docs, labels).join(labels, "doc_id").filter("not base_failed")
    rates = {r.quality: r.share for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert rates[1] > 0.99 and rates[0] < 0.1


def test_an_id_of_many_rows_is_learned_from_once(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    ids = docs.join(labels, "doc_id").filter("quality = 1").orderBy(F.xxhash64("doc_id"))
    first = ids.select(docs.columns).limit(1)
    copies = first.crossJoin(spark.range(400).select(F.lit(1).alias("one"))).drop("one")
    alone = rules.judge(docs, labels, labelled_rows=300)
    beside = rules.judge(docs.unionByName(copies), labels, labelled_rows=300)
    expected = {r.doc_id: r.rule for r in alone.select("doc_id", "rule").collect()}
    found = beside.select("doc_id", "rule").collect()
    assert len(found) == len(expected) + 400
    assert any(expected.values()) and all(expected[r.doc_id] == r.rule for r in found)


def test_no_python_runs(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    for frame in (rules.statistics(docs), rules.judge(docs, labels)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
