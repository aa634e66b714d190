import cases
import numpy as np
import pyarrow as pa
import pytest
from passbook.llm import quality, textbatch
from pyspark.sql import functions as F


def graded(n, seed=0):
    """Texts whose share of 'bad' words falls with their grade, 0 to 3."""
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        grade = k % 4
        words = cases.prose(seed * 100_000 + k, 80).split()
        for j in rng.choice(80, (3 - grade) * 12, replace=False):
            words[j] = f"junk{rng.integers(5)}"
        out.append((k, " ".join(words), grade))
    return out


def test_ordered_thresholds_and_grades():
    rows = graded(600)
    model = quality.fit(pa.array([r[1] for r in rows]), np.array([float(r[2]) for r in rows]))
    assert model.grades == [0.0, 1.0, 2.0, 3.0]
    assert (np.diff(model.thresholds) > 0).all()
    fresh = graded(400, seed=1)
    found = np.concatenate([
        model.tails(model.scores(w)) for w in textbatch.blocks(pa.array([r[1] for r in fresh]), textbatch.NOT_BLANK, lower=False)
    ])
    assert (np.diff(found, axis=1) <= 1e-12).all()  # P(grade >= k) falls with k
    truth = np.array([r[2] for r in fresh])
    assert np.mean(np.round(found.sum(axis=1)) == truth) > 0.8
    assert np.corrcoef(found.sum(axis=1), truth)[0, 1] > 0.9


def test_gradient_raises_the_likelihood():
    rows = graded(120)
    texts, grades = pa.array([r[1] for r in rows]), np.array([float(r[2]) for r in rows])

    def likelihood(model):
        scores = np.concatenate([model.scores(w) for w in textbatch.blocks(texts, textbatch.NOT_BLANK, lower=False)])
        tails = np.hstack([np.ones((len(scores), 1)), model.tails(scores), np.zeros((len(scores), 1))])
        k = np.arange(len(scores)), grades.astype(int)
        return np.log(np.maximum(tails[k] - tails[k[0], k[1] + 1], 1e-12)).mean()

    values = [likelihood(quality.fit(texts, grades, epochs=e)) for e in (0, 5, 20, 60)]
    assert values == sorted(values)


def test_training_uses_labels_and_is_repeatable(spark):
    rows = graded(200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    ratings = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5, None), (7, 3), (7, 3)], "doc_id long, grade int")
    first, second = (quality.train(d, ratings) for d in (docs, docs.repartition(5)))
    assert np.array_equal(first.weights, second.weights) and np.array_equal(first.thresholds, second.thresholds)
    bounded = quality.train(docs, ratings, labelled_rows=40)
    assert not np.array_equal(first.weights, bounded.weights)


def test_a_repeated_id_counts_once(spark):
    rows = graded(100)
    ratings = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, grade int")
    once, often = (
        quality.train(spark.createDataFrame([r[:2] for r in rows] + more, "doc_id long, text string").repartition(3), ratings)
        for more in ([], [rows[0][:2]] * 300 + [(rows[1][0], None)])
    )
    assert np.array_equal(once.weights, often.weights) and np.array_equal(once.thresholds, often.thresholds)


def test_edge_rows(spark):
    rows = graded(100)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = quality.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, grade int"))
    edge = cases.frame(spark, ("tails", "quality_tails", "grade", "_id"))
    found = quality.grade(edge, model)
    assert found.count() == len(cases.rows())
    blank = found.join(edge.select("doc_id").filter("doc_id in (4, 5, 6)"), "doc_id").collect()
    assert all(r.expected_grade == 0 and not r.kept for r in blank) and len(blank) == 3
    kept = quality.good(edge, model)
    assert kept.columns == edge.columns and kept.count() == found.filter("kept").count()
    assert quality.grade(cases.empty(spark), model).count() == 0
    assert quality.good(edge, None).count() == len(cases.rows())


@pytest.mark.parametrize("labels", [[], [(0, 1)], [(0, 1), (1, 1)]])
def test_too_few_grades_give_no_model(spark, labels):
    docs = spark.createDataFrame([r[:2] for r in graded(4)], "doc_id long, text string")
    assert quality.train(docs, spark.createDataFrame(labels, "doc_id long, grade int")) is None


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ratings = quality.grades_of(spark.read.parquet(f"{sf}/labels.parquet"))
    model = quality.train(docs, ratings.filter("doc_id % 4 <> 2"))
    judged = quality.grade(docs, model).join(ratings.filter("doc_id % 4 = 2"), "doc_id")
    rates = {r.grade: r.kept for r in judged.groupBy("grade").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[2] > 0.99 and rates[1] > 0.9 and rates[0] < 0.1
