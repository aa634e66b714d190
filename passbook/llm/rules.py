"""Quality rules: a decision list learned by sequential covering.

A rule is a conjunction of threshold tests on per-document statistics that marks documents as poor. Rules are
grown one test at a time on two thirds of the labelled rows, pruned on the last third, and kept while they
are precise there; rows that a rule covers leave the training set. The list becomes an ordered
Spark conditional expression whose branches can be read.

Everything runs on DataFrame functions. One pass over the texts writes the statistics; learning reads
counts per feature and threshold step, a table of fixed size, from the labelled rows' statistics.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passbook.llm.columns import BLANKS, quoted, trimmed, words_of
from passbook.workspace import stored

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words
STEPS = 24  # thresholds tried per feature
MAX_RULES = 12
MAX_TESTS = 3
MIN_PRECISION = 0.9
MIN_COVERED = 5
LABELLED_ROWS = 50_000


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts of every whole text, one row per row of ``docs``.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` as the contract defines them, and
    ``n_capitals`` (A-Z), ``n_marks`` (exclamation and question marks), ``n_distinct`` words.
    A null text counts as empty.
    """
    rows = docs.select(quoted(id_column).alias("doc_id"), F.coalesce(quoted(text_column), F.lit("")).alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("n_words", F.size("words").cast("long"))
    # one hash for each run of five words; two equal ones are the same run but for 64-bit collisions
    starts = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    runs = F.when(
        F.size("words") >= WINDOW,
        F.transform(starts, lambda k: F.xxhash64(*(F.element_at("words", k + j) for j in range(WINDOW)))),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("runs", runs)
    rows = rows.withColumn("again", F.size(F.array_distinct("runs")) < F.size("runs"))
    # only texts with a repeated run need positions: runs in hash order, those equal to a neighbour stay
    ordered = F.array_sort(F.transform("runs", lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
    rows = rows.withColumn("ordered", F.when(F.col("again"), ordered)).drop("runs")
    equal = F.filter(
        "ordered",
        lambda x, k: (x["h"] == F.get("ordered", k - 1)["h"]) | (x["h"] == F.get("ordered", k + 1)["h"]),
    )
    rows = rows.withColumn("starts", F.array_sort(F.transform(equal, lambda x: x["k"]))).drop("ordered")
    # each start covers five words, or as many as lie before the next start
    covered = F.aggregate(
        F.transform("starts", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: trimmed(line) != "")

    def count_of(characters: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")

    rows = rows.withColumn("lines", lines)
    return rows.select(
        "doc_id",
        "n_words",
        (F.length(text) - count_of(BLANKS)).cast("long").alias("word_chars"),
        count_of(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        count_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
        count_of("!?").alias("n_marks"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))




def features() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "chars_per_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "capitals_per_word": F.col("n_capitals") / words,
        "marks_per_word": F.col("n_marks") / words,
        "repeated_share": F.col("n_repeat_words") / words,
        "distinct_share": F.col("n_distinct") / words,
        "dup_lines_per_word": F.col("n_dup_lines") / words,
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Test, ...]


def covers(rule: Rule) -> Column:
    found = F.lit(True)
    for test in rule:
        found = found & test.column()
    return found


def _gain(poor: int, good: int, poor0: int, good0: int) -> float:
    """FOIL's information gain of a narrower rule."""
    if not poor:
        return 0.0
    return poor * (math.log2(poor / (poor + good)) - math.log2(poor0 / (poor0 + good0)))


def _best_test(rows: DataFrame, rule: Rule, steps: dict[str, list[float]]) -> tuple[Test, float] | None:
    """The test that narrows ``rule`` best; one aggregate over the labelled rows gives all counts."""
    inside = rows.filter(covers(rule))
    slots = F.array(
        *(
            F.struct(
                F.lit(name).alias("feature"),
                sum((F.when(value > t, 1).otherwise(0) for t in steps[name]), F.lit(0)).alias("slot"),
            )
            for name, value in features().items()
        )
    )
    counted = (
        inside.select("poor", F.explode(slots).alias("at"))
        .groupBy("at.feature", "at.slot")
        .agg(F.sum("poor").alias("poor"), F.sum(1 - F.col("poor")).alias("good"))
        .collect()  # features x (steps + 1) rows
    )
    best = None
    for name in features():
        table = {r["slot"]: (r["poor"], r["good"]) for r in counted if r["feature"] == name}
        poor0, good0 = (sum(x[k] for x in table.values()) for k in (0, 1))
        if not poor0:
            return None
        for k, threshold in enumerate(steps[name]):
            low = [sum(x[i] for slot, x in table.items() if slot <= k) for i in (0, 1)]
            for above, (poor, good) in ((True, (poor0 - low[0], good0 - low[1])), (False, tuple(low))):
                gain = _gain(poor, good, poor0, good0)
                if gain > 1e-9 and (best is None or gain > best[1] + 1e-9):
                    best = (Test(name, above, threshold), gain)
    return best


def _counts(rows: DataFrame, rules: list[Rule]) -> list[tuple[int, int]]:
    """Poor and good rows that each rule covers, in one aggregate."""
    sums = []
    for k, rule in enumerate(rules):
        inside = covers(rule)
        sums += [
            F.coalesce(F.sum(F.when(inside, F.col("poor"))), F.lit(0)).alias(f"p{k}"),
            F.coalesce(F.sum(F.when(inside, 1 - F.col("poor"))), F.lit(0)).alias(f"g{k}"),
        ]
    row = rows.agg(*sums).first()
    return [(row[f"p{k}"], row[f"g{k}"]) for k in range(len(rules))]


def learn(
    labelled: DataFrame,
    max_rules: int = MAX_RULES,
    max_tests: int = MAX_TESTS,
    min_precision: float = MIN_PRECISION,
    min_covered: int = MIN_COVERED,
) -> list[Rule]:
    """The decision list for statistics rows with a column ``poor`` (1 poor, 0 good).

    Rows without label, and an empty or one-sided table, give an empty list. Thresholds lie half-way
    between neighbouring quantiles of the poor and the good rows.
    """
    rows = stored(labelled.filter(F.col("poor").isNotNull()).withColumn("poor", F.col("poor").cast("int")), "labelled")
    shares = [k / STEPS for k in range(STEPS + 1)]
    names = list(features())
    quantiles = rows.groupBy("poor").agg(*(F.percentile_approx(v, shares, 1000).alias(n) for n, v in features().items())).collect()
    if len(quantiles) < 2:
        return []
    steps = {}
    for name in names:
        values = sorted({float(x) for q in quantiles for x in q[name]})
        steps[name] = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    third = F.pmod(F.xxhash64(F.lit("prune"), F.col("doc_id").cast("string")), F.lit(3))
    found: list[Rule] = []
    left = rows
    for _ in range(max_rules):
        grow, prune = left.filter(third != 0), left.filter(third == 0)
        rule: Rule = ()
        while len(rule) < max_tests:
            best = _best_test(grow, rule, steps)
            if best is None:
                break
            rule = (*rule, best[0])
        if not rule:
            break
        # every beginning of the rule competes on rows it was not grown on
        beginnings = [rule[:k] for k in range(1, len(rule) + 1)]
        judged = []
        for cut, (poor, good) in zip(beginnings, _counts(prune, beginnings), strict=True):
            judged.append(((poor - good) / (poor + good) if poor + good else -1.0, -len(cut), cut, poor, good))
        worth, _, rule, poor, good = max(judged, key=lambda x: x[:2])
        if poor + good < min_covered or poor < min_precision * (poor + good):
            break
        found.append(rule)
        left = left.filter(~covers(rule))
    return found


def as_column(rules: list[Rule]) -> Column:
    """The list as one conditional expression: the text of the first rule that covers a row, else null."""
    if not rules:
        return F.lit(None).cast("string")
    chosen = F.when(covers(rules[0]), F.lit(" and ".join(map(str, rules[0]))))
    for rule in rules[1:]:
        chosen = chosen.when(covers(rule), F.lit(" and ".join(map(str, rule))))
    return chosen


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_id: str = "doc_id",
    quality_column: str = "quality",
    labelled_rows: int = LABELLED_ROWS,
) -> DataFrame:
    """Statistics of every row, ``base_failed``, ``kept`` and the ``rule`` that rejected it.

    The list is learned from at most ``labelled_rows`` labelled documents that pass the base test,
    chosen by the hash of their id; an id with labels that disagree counts as its lower one, and an id of several
    rows is learned from once, by the row that comes first in order of its statistics. Null or empty
    texts fail the base test, very long ones are counted whole. Null ids have no label. Repeated rows are judged
    alike; an empty table gives an empty one; without labels the base test decides alone. Ties between
    tests go to the first feature and lowest threshold. Other columns of ``docs``, whatever their names, are not read.
    """
    rows = stored(statistics(docs, id_column, text_column).withColumn("base_failed", base_failed()), "statistics")
    marks = labels.select(quoted(label_id).alias("_id"), quoted(quality_column).alias("_quality")).dropna()
    marks = marks.groupBy("_id").agg(F.min("_quality").alias("_quality"))
    chosen = F.xxhash64("doc_id")
    labelled = rows.join(marks, F.col("doc_id") == F.col("_id")).filter(~F.col("base_failed"))
    # the rank is limited before the shuffle: an id repeated in many rows sends one row of each task
    first = Window.partitionBy("doc_id").orderBy(*[c for c in rows.columns if c != "doc_id"])
    labelled = labelled.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")
    labelled = labelled.orderBy(chosen, "doc_id").limit(labelled_rows)
    list_ = learn(labelled.withColumn("poor", F.when(F.col("_quality") == 0, 1).otherwise(0)).drop("_id", "_quality"))
    rule = as_column(list_)
    judged = rows.withColumn("rule", F.when(~F.col("base_failed"), rule))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
