import datetime as dt
import re

import cases
import pytest
from passbook.llm import pseudonyms
from pyspark.sql import functions as F


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def card(body):
    return next(body + str(c) for c in range(10) if luhn(body + str(c)))


def rewritten(spark, texts, key="k"):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [(r.text, r.pseudonym_kinds) for r in pseudonyms.pseudonymise(docs, key=key).orderBy("doc_id").collect()]


def test_formats_stay_valid(spark):
    number = card("401288888888188")
    texts = [
        f"a {number}, b {number[:4]} {number[4:8]} {number[8:12]} {number[12:]}.", "born 1987-02-28 / 28.02.1987 / 28/02/1987.",
        "from 10.0.0.1.", "ssn 123-45-6789;", "call +49 (030) 555-7713 or (212) 555-1234", "DE89 3704 0044 0532 0130 00 DE89370400440532013000",
        "x.Y-7@mail.example.com,", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f960"',
    ]
    found = rewritten(spark, texts)
    for (text, kinds), old in zip(found, texts):
        assert kinds and text != old
        # everything but letters and digits of the values is where it was
        length = "+" if kinds == ["ip"] else ""  # octets are not padded
        assert re.sub(rf"[0-9a-zA-Z]{length}", "0", text) == re.sub(rf"[0-9a-zA-Z]{length}", "0", old)
    a, b = re.findall(r"[0-9][0-9 ]{13,}[0-9]", found[0][0])
    assert a == b.replace(" ", "") and luhn(a) and a != number
    dates = re.findall(r"[0-9./-]{10}", found[1][0])
    parsed = {dt.date.fromisoformat(dates[0]), dt.datetime.strptime(dates[1], "%d.%m.%Y").date(), dt.datetime.strptime(dates[2], "%d/%m/%Y").date()}
    assert len(parsed) == 1
    assert all(int(x) < 256 for x in found[2][0][5:-1].split("."))
    assert re.fullmatch(r"ssn (?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4};", found[3][0])
    assert found[4][0].startswith("call +49 (") and found[4][1] == ["phone", "phone"]
    ibans = [x.replace(" ", "") for x in re.findall(r"DE[0-9 ]{20,}(?= |$)", found[5][0])]
    for iban in re.findall(r"DE[0-9]{20}", found[5][0].replace(" ", "")):
        assert int(iban[4:] + "1314" + iban[2:4]) % 97 == 1
    assert len(set(re.findall(r"DE[0-9]{20}", found[5][0].replace(" ", "")))) == 1, ibans
    assert found[6][0].endswith("@mail.example.com,") and found[7][1] == ["secret"]


def test_email_before_a_full_stop_is_found(spark):
    texts = [
        "write to bob@example.com. Then", "write to bob@example.com.", "bob@mail.example.co.uk...", "bob@example.com.\nNext", "(bob@example.com.)",
        "bob@example.com.2 is next", "bob@" + "a." * 100 + "com. End",
    ]
    for (text, kinds), old in zip(rewritten(spark, texts), texts):
        name, rest = text.split("@")
        assert kinds == ["email"] and "bob" not in name and rest == old.split("@")[1]
    assert rewritten(spark, (none := ["bob@example.c1.", "bob@example.", "bob@" + "a." * 20_000])) == [(t, []) for t in none]


def test_cards_beside_other_numbers(spark):
    number, other, short = card("411111111111111"), card("37828224631000"), card("3056930902590")
    groups = " ".join(number[k : k + 4] for k in (0, 4, 8, 12))
    amex = f"{other[:4]} {other[4:10]} {other[10:]}"
    texts = {
        f"{groups} 12/27": groups, f"{number} 123": number, f"{groups} 2 times": groups, f"{groups} 12/27/1990": groups, f"12 {groups}": groups,
        f"2024 {groups}": groups, f"{amex} 1234": amex, f"{short} 99": short, f"{number} 123-45-6789": number, f"{groups} 7 and {number}": groups,
    }
    for (text, kinds), (old, value) in zip(rewritten(spark, list(texts)), texts.items()):
        whole = re.findall(r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9])", old)[0]
        assert "card" in kinds and value not in text and len(text) == len(old), old
        if not luhn(re.sub("[^0-9]", "", whole)):
            start = old.index(value)
            assert luhn(re.sub("[^0-9]", "", text[start : start + len(value)])) and text[:start] == old[:start]
    found = rewritten(spark, [f"{groups} 12/27/1990", f"{number} 123-45-6789"])
    assert [k for _, k in found] == [["card", "day_date"], ["card", "ssn"]]
    assert "12/27/1990" not in found[0][0] and "123-45-6789" not in found[1][0]


def test_ibans_with_letters(spark):
    ibans = [
        "GB82 WEST 1234 5698 7654 32", "NL91ABNA0417164300", "FR14 2004 1010 0505 0001 3M02 606", "IT60X0542811101000000123456",
        "IE29 AIBK 9311 5212 3456 78", "BE68 5390 0754 7034", "DE89370400440532013000",
    ]
    found = rewritten(spark, [f"pay {x} EUR 5" for x in ibans] + ["pay GB83 WEST 1234 5698 7654 32 now"])
    for (text, kinds), old in zip(found, ibans):
        new = text.removeprefix("pay ").removesuffix(" EUR 5")
        assert kinds == ["iban"] and new != old and new[:2] == old[:2]
        assert re.sub("[A-Z]", "A", re.sub("[0-9]", "0", new)) == re.sub("[A-Z]", "A", re.sub("[0-9]", "0", old))
        signs = new.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in signs[4:] + signs[:4])) % 97 == 1
    assert found[-1] == ("pay GB83 WEST 1234 5698 7654 32 now", [])


def test_dates_with_the_month_first_and_of_one_digit(spark):
    iso, month_first, one, padded, dots = rewritten(spark, ["1990-12-25", "12/25/1990", "25/12/1990 5/3/1990", "05/03/1990", "5.3.1990."])
    new = dt.date.fromisoformat(iso[0])
    assert month_first == (new.strftime("%m/%d/%Y"), ["day_date"])
    assert one[1] == ["day_date"] * 2 and one[0].split()[0] == new.strftime("%d/%m/%Y")
    other = dt.datetime.strptime(padded[0], "%d/%m/%Y")
    assert one[0].split()[1] == f"{other.day}/{other.month}/{other.year}" and dots[0] == f"{other.day}.{other.month}.{other.year}."
    assert rewritten(spark, ["13/13/1990 31/4/2001 0/5/1990"]) == [("13/13/1990 31/4/2001 0/5/1990", [])]


def test_dates_are_permuted_one_to_one_in_every_notation(spark):
    days = spark.range(73_049).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    moved = days.select("day", pseudonyms._day(F.col("day"), "k").alias("new"))
    assert moved.filter("new between date'1900-01-01' and date'2099-12-31'").select("new").distinct().count() == 73_049
    assert moved.filter("(day(day) > 12) != (day(new) > 12)").count() == 0
    assert moved.filter("day = new").count() < 100
    # notations of four years: values that differ stay apart, those of one day stay together
    some = moved.filter("year(day) between 1988 and 1991").collect()
    forms = ["%d/%m/%Y", "%m/%d/%Y", "%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%m-%d-%Y"]
    old = sorted({r.day.strftime(f) for r in some for f in forms})
    new = {r.day: r.new for r in some}

    def read(text):
        for form in ("%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%m/%d/%Y", "%d-%m-%Y", "%m-%d-%Y"):
            try:
                return dt.datetime.strptime(text, form).date()
            except ValueError:
                pass

    found = rewritten(spark, old)
    assert len({t for t, _ in found}) == len(old)
    assert all(len(k) == 1 and read(t) == new[read(o)] for (t, k), o in zip(found, old))
    assert rewritten(spark, ["/blog/1990/12/25/x 7-12-12-2020 1990/13/25"]) == [("/blog/1990/12/25/x 7-12-12-2020 1990/13/25", [])]


def test_what_fails_its_check_stays(spark):
    texts = [
        "4012888888881882", "1987-02-30 31.04.2001", "300.1.1.1 1.2.3.4.5 01.2.3.4", "000-45-6789 666-45-6789", "DE00370400440532013000",
        "a@b", "version 2.0.1", "deadbeef", "12345678901234567890123", "plain text", "https://example.org/a-b",
    ]
    assert rewritten(spark, texts) == [(t, []) for t in texts]


def test_same_value_same_pseudonym_and_keys_differ(spark):
    number = card("55555555555544")
    first = rewritten(spark, [f"x {number} y", f"{number}", "1.2.3.4 and 1.2.3.4"])
    assert first[0][0].split()[1] == first[1][0]
    assert len(set(first[2][0].split(" and "))) == 1
    assert rewritten(spark, [number], key="other")[0][0] != first[1][0]
    assert rewritten(spark, [number])[0][0] == first[1][0]


@pytest.mark.parametrize("a, b", [(17, 4297), (10, 100), (1, 10), (3, 5)])
def test_network_is_a_permutation(spark, a, b):
    rows = spark.range(a * b)
    pair = pseudonyms.permuted_pair(F.floor(F.col("id") / b), F.col("id") % b, F.lit(a), F.lit(b), "k", "t")
    found = rows.select(pair.alias("p")).select("p.a", "p.b").distinct()
    assert found.count() == a * b
    assert found.filter((F.col("a") >= a) | (F.col("b") >= b) | (F.col("a") < 0) | (F.col("b") < 0)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_digits_and_letters_are_permuted_one_to_one(spark, size):
    digits = spark.range(10**size).select(F.lpad(F.col("id").cast("string"), size, "0").alias("d"))
    found = digits.select(pseudonyms.permuted_digits(F.col("d"), "k", "t").alias("p"))
    assert found.filter(F.length("p") == size).distinct().count() == 10**size
    if size < 3:
        letters = [a + b for a in "abcxyz0123456789" for b in ["", *"azAZ09."]]
        words = spark.createDataFrame([(x,) for x in letters], "w string")
        out = words.select(pseudonyms.permuted_letters(F.col("w"), "k", "t", pseudonyms._ALNUM).alias("p")).collect()
        assert len({r.p for r in out}) == len(letters)


def test_edge_rows(spark):
    docs = cases.frame(spark, ("pseudonym_kinds", "pseudonym_found", "value"))
    found = pseudonyms.pseudonymise(docs)
    assert found.columns == [*docs.columns, "_pseudonym_kinds"]
    assert cases.bag(found, *docs.columns) == cases.bag(docs, *docs.columns)
    assert pseudonyms.pseudonymise(cases.empty(spark)).count() == 0
    long = "word " * 200_000 + "10.1.2.3" + " tail" * 1000
    (text, kinds), = rewritten(spark, [long])
    assert kinds == ["ip"] and text[:1_000_000] == long[:1_000_000] and text[-5000:] == long[-5000:]


def test_no_python_runs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = pseudonyms.pseudonymise(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_documents_keep_what_is_not_personal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = pseudonyms.pseudonymise(docs).withColumnRenamed("text", "new").join(docs, "doc_id")
    values = re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9.]*[0-9])|[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+\.[a-z]{2,}")
    for r in found.collect():
        assert "ip" in r.pseudonym_kinds or len(r.new) == len(r.text)
        if not r.pseudonym_kinds:
            assert r.new == r.text
        assert not set(values.findall(r.text)) & set(values.findall(r.new))
