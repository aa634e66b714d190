import re

import cases
import pytest
from passbook.llm import licences


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(w):
    return [" ".join(w[k : k + 5]) for k in range(len(w) - 4)]


def expected(docs, templates):
    """The best passage of every document for every template, window by window."""
    out = []
    for d, text in docs:
        own = runs(words(text))
        for name, template in templates:
            grams = set(runs(words(template)))
            if grams:
                step = 1 << (len(grams).bit_length() - 1)
                best = max((len(grams & set(own[k : k + 4 * step])) for k in range(0, max(1, len(own)), step)), default=0)
                if best * 5 >= len(grams) * 4:
                    out.append((d, name, best, len(grams)))
    return sorted(out, key=repr)


def planted():
    docs = []
    names = list(licences.TEMPLATES.items())
    for k in range(60):
        template = names[k % len(names)][1]
        w = template.split()
        if k % 4 == 1:  # cut short
            w = w[: len(w) - k % 7]
        elif k % 4 == 2:  # words put in
            w = [x for j, y in enumerate(w) for x in ((y, "indeed") if j % 19 == 18 else (y,))]
        docs.append((k, f"{cases.prose(k, 150 + k)} {' '.join(w).upper() if k % 3 else ' '.join(w)}\n{cases.prose(k + 99, 80)}"))
    return docs


@pytest.mark.parametrize("constants", [licences.CONSTANTS, 0])
def test_equals_search_of_all_windows(spark, constants):
    docs = planted()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = licences.scan(frame, licences.templates_frame(spark), constants=constants)
    assert cases.bag(found, "doc_id", "license", "n_shared", "n_shingles") == expected(docs, list(licences.TEMPLATES.items()))


@pytest.mark.parametrize("constants", [licences.CONSTANTS, 0])
def test_edge_rows(spark, constants):
    docs = cases.frame(spark, ("license", "words", "row", "class"))
    rows = [r[:2] for r in cases.rows()]
    templates = [("a", cases.rows()[0][1]), ("a", cases.rows()[0][1]), ("b", None), ("c", "too few words"), (None, " ".join(rows[10][1].split()[29_900:29_960]))]
    frame = spark.createDataFrame(templates, "license string, template string")
    found = licences.scan(docs, frame, constants=constants)
    assert cases.bag(found, "doc_id", "license", "n_shared", "n_shingles") == expected(rows, templates)
    assert licences.scan(cases.empty(spark), frame, constants=constants).count() == 0
    assert licences.scan(docs, frame.limit(0), constants=constants).count() == 0


def test_bands_bound_the_misses():
    similarity = 0.8 / 4.2
    assert (1 - similarity) ** licences.bands() <= licences.MISS


def test_no_python_runs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licences.scan(docs, licences.templates_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
