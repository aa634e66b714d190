import random

import cases
import numpy as np
import pyarrow as pa
from passbook.llm import textbatch, toxicity
from pyspark.sql import functions as F


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    rnd = random.Random(1)
    for _ in range(200):
        terms = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(3, 12))) for _ in range(6)})
        lexicon = toxicity.Lexicon(terms)
        words = ["".join(rnd.choice("abé") for _ in range(rnd.randint(1, 13))) for _ in range(20)] + [t[1:] + "a" for t in terms]
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw])
        may = lexicon.screened(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes, sizes)
        for word, screened in zip(words, may):
            near = [(distance(t, word), k) for k, t in enumerate(terms) if distance(t, word) <= lexicon.bound[k]]
            assert lexicon.nearest(word) == ((min(near)[1], min(near)[0]) if near else None)
            assert screened or not near


def labelled(n, seed=0, words=("idiotic", "worthless", "disgusting")):
    """Every fourth text has two of the words, one of them misspelled now and then."""
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        text = cases.prose(seed * 10_000 + k, 40).split()
        if k % 4 == 0:
            for _ in range(2):
                text.insert(rnd.randrange(len(text)), rnd.choice(words))
        out.append((k, " ".join(text), int(k % 4 == 0)))
    return out


def model():
    rows = labelled(800)
    return toxicity.fit(pa.array([r[1] for r in rows]), np.array([r[2] == 1 for r in rows]))


def scores(m, texts):
    return np.concatenate([m.scores(w) for w in textbatch.blocks(pa.array(texts), textbatch.ALPHANUMERIC)])


def test_lexicon_misspellings_and_context():
    m = model()
    assert set(m.terms) == set(m.lexicon.terms) == {"idiotic", "worthless", "disgusting"}
    base = cases.prose(5, 40)
    plain, exact, missp, quoted, reported = scores(m, [
        base, f"{base} you worthless thing {base}", f"{base} you wortless thing {base}",
        f"{base} the “worthless” thing {base}", f"{base} he wrote worthless there {base}",
    ])
    assert exact > 0.9 and missp > 0.5 and plain < 0.1
    assert quoted < exact and reported < exact
    assert np.array_equal(scores(m, [base] * 3), scores(m, [base]).repeat(3))


def test_misspellings_of_rare_terms_and_of_families_are_found():
    rnd = random.Random(4)
    family = ["grobnakel", "grobnition", "grobnuzzer", "grobnefuls", "grobnowicht"]
    words = family + ["".join(rnd.choice("bcdfghklmnprstvz") + rnd.choice("aeiou") for _ in range(5)) for _ in range(90)]
    rows = labelled(6000, seed=2, words=words)
    m = toxicity.fit(pa.array([r[1] for r in rows]), np.array([r[2] == 1 for r in rows]))
    assert len(m.terms) > 80 and set(m.lexicon.terms) == set(m.terms) and "grobn" in m.stems
    missp = [(t, t[:k] + "q" + t[k + 1 :]) for t in sorted(m.terms) for k in (1, 3, len(t) - 1)]
    found = [h for w in textbatch.blocks(pa.array([x for _, x in missp]), textbatch.ALPHANUMERIC) for h in m.hits(w)]
    assert [k for k, weight, _ in found if weight > 0] == list(range(len(missp)))


def test_fit_is_repeatable_and_cache_does_not_change_scores():
    a, b = model(), model()
    texts = [r[1] for r in labelled(300, seed=3)]
    assert np.array_equal(a.coefficients, b.coefficients)
    first = scores(a, texts)
    assert np.array_equal(first, scores(a, texts)) and np.array_equal(first, scores(b, texts[::-1])[::-1])


def test_words_without_evidence_are_not_learned():
    rnd = random.Random(9)
    toxic = np.array([rnd.random() < 0.2 for _ in range(400)])
    found = toxicity.fit(pa.array([cases.prose(k, 30) for k in range(400)]), toxic)
    assert found.terms == {} and found.stems == {}


def test_held_out_rows_are_not_learned_from(spark):
    rows = labelled(600)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    held = toxicity.held_out(F.col("doc_id"))
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs.repartition(3), turned)
    assert np.array_equal(a.coefficients, b.coefficients) and a.terms == b.terms
    import zlib

    flagged = {r.doc_id for r in toxicity.score(docs, a).filter("held_out").collect()}
    assert flagged == {k for k in range(600) if zlib.crc32(str(k).encode()) % 4 == 2}


def test_a_repeated_id_counts_once(spark):
    rows = labelled(400)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    once, often = (
        toxicity.train(spark.createDataFrame([r[:2] for r in rows] + more, "doc_id long, text string").repartition(3), labels)
        for more in ([], [r[:2] for r in rows[:8]] * 100)
    )
    assert once.terms == often.terms and np.array_equal(once.coefficients, often.coefficients)


def test_edge_rows(spark):
    rows = labelled(400)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    m = toxicity.train(docs, labels)
    found = toxicity.score(cases.frame(spark, ("score", "held_out", "predicted")), m).collect()
    assert len(found) == len(cases.rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out is not None for r in found)
    assert toxicity.score(cases.empty(spark), m).count() == 0
    assert toxicity.train(docs, labels.filter("toxic = 0")) is None
    assert toxicity.score(docs, None).filter("score <> 0 or predicted <> 0").count() == 0


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").filter("held_out")
    rates = {r.toxic: r.hit for r in judged.groupBy("toxic").agg(F.avg("predicted").alias("hit")).collect()}
    assert rates[1] > 0.9 and rates[0] < 0.02


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_nearest_term_of_words_of_any_length():
    import random

    rnd = random.Random(4)
    terms = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 14))) for _ in range(60)} | {"xy" * 50, "z" * 300})
    lexicon = toxicity.Lexicon(terms)
    words = ["".join(rnd.choice("abcd") for _ in range(rnd.randrange(0, 15))) for _ in range(300)]
    words += ["xy" * 49 + "x", "xy" * 50 + "ab", "xy" * 51 + "x", "z" * 298, "z" * 302, "z" * 303, "é" + "z" * 299]
    for word in words:
        near = [(edit_distance(word, t), k) for k, t in enumerate(terms)]
        near = [(d, k) for d, k in near if d <= toxicity.allowed(len(terms[k]))]
        assert lexicon.nearest(word) == ((min(near)[1], min(near)[0]) if near else None)
        raw = word.encode()
        import numpy as np

        may = lexicon.screened(np.frombuffer(raw, dtype=np.uint8), np.array([0]), np.array([len(raw)]))
        assert may[0] or not near


def test_every_term_of_five_letters_keeps_its_edits():
    """Common words near a term are exempt themselves; the term's other neighbours still count."""
    import numpy as np
    import pyarrow as pa

    common = ["brantes", "brantel", "branter", "brantax", "bramtex", "brontex"]
    texts = [f"well brantex here {k}" for k in range(40)] + [f"{w} stands here {k}" for k in range(40) for w in common]
    toxic = np.array([1] * 40 + [0] * 240)
    model = toxicity.fit(pa.array(texts), toxic)
    assert "brantex" in model.terms
    assert all(b == toxicity.allowed(len(t)) for t, b in zip(model.lexicon.terms, model.lexicon.bound))
    assert set(common) <= model.harmless
    assert model._weigh("brantxx")[0] > 0 and model._weigh("brntex")[0] > 0 and model._weigh("brantes")[0] == 0
