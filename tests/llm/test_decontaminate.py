import re

import cases
import pytest
from passbook.llm import decontaminate
from pyspark.sql import functions as F

SENT = [decontaminate.SENT_CHARS, 0]  # the sketches sent to the tasks, and the joins


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(w, k):
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def expected(docs, items, threshold=0.8):
    out = []
    for d, text in docs:
        for i, item in items:
            w = words(item)
            if w:
                k = min(5, len(w))
                own = grams(w, k)
                shared = len(own & grams(words(text), k))
                if shared * 10 >= len(own) * round(threshold * 10):
                    out.append((d, i, shared, len(own)))
    return sorted(out, key=repr)


def planted():
    items = [(k, cases.prose(1000 + k, 8 + k)) for k in range(20)]
    items += [(20, "only three words"), (21, "solo"), (22, ""), (23, None), (24, "?!"), (None, cases.prose(1100, 30)), (3, items[3][1])]
    docs = []
    for k in range(60):
        text = cases.prose(k, 200)
        item = items[k % 22][1]
        if k % 3 == 0:  # whole, in capitals and with signs
            text = f"{text} <<{item.upper()}>> {cases.prose(k + 500, 300)}"
        elif k % 3 == 1:  # cut short: some above the threshold and some below
            w = item.split()
            text = f"{text} {' '.join(w[: max(1, len(w) - k % 5)])} {cases.prose(k + 500, 30)}"
        docs.append((k, text))
    return docs, items


@pytest.mark.parametrize("sent", SENT)
def test_equals_brute_force(spark, sent):
    docs, items = planted()
    found = decontaminate.containments(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), sent_chars=sent
    )
    assert cases.bag(found, "doc_id", "item_id", "n_shared", "n_shingles") == expected(docs, items)


@pytest.mark.parametrize("sent", SENT)
def test_edge_rows(spark, sent):
    docs = cases.frame(spark, ("item_id", "item", "f", "key"))
    rows = [r[:2] for r in cases.rows()]
    long_item = " ".join(rows[10][1].split()[20_000:20_030])  # far inside the longest text
    items = [(1, long_item), (2, "word"), (3, None), (4, rows[0][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = decontaminate.containments(docs, benchmark, sent_chars=sent)
    assert cases.bag(found, "doc_id", "item_id", "n_shared", "n_shingles") == expected(rows, items)
    kept = decontaminate.clean(docs, benchmark, sent_chars=sent)
    bad = {(d, t) for d, t in rows if expected([(d, t)], items)}
    assert kept.columns == docs.columns
    assert cases.bag(kept, "doc_id", "text") == sorted((r for r in rows if r not in bad), key=repr)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.containments(docs, none, sent_chars=sent).count() == 0
    assert decontaminate.clean(docs, none, sent_chars=sent).count() == len(rows)
    assert decontaminate.containments(cases.empty(spark), benchmark, sent_chars=sent).count() == 0


def test_sketches_cannot_miss():
    """Whatever shingles are lacking, an item that is contained shares an element of its sketch."""
    sketches = decontaminate.Sketches([cases.prose(7, 45)], 0.8, 5)
    keys, _, _, least = sketches.tables[5]
    total = len(sketches.grams[0])
    assert least == sketches.need[0] and len(keys) + least == total + 1
