import random

import numpy as np
import pytest
from passbook.llm import extraction, markup
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, html string"


def article(page):
    return "\n".join(markup.read(page).article())


PAGES = [
    ("<article><h1>A &amp; B</h1><p>one <b>two</b>\n three<p>four<br>five</article>", "A & B\none two three\nfour five"),
    ("<nav>menu</nav><main><p>text</p><aside>side</aside><form><p>name</p></form></main><footer>f</footer>", "text"),
    ("<article>a<script>var x='</article>';</script>b<style>p{}</style></article>", "ab"),
    ("<article><p>in</p><div class='comments'><p>nice!</p></div><section id=comment-list>x</section></article>", "in"),
    ("<article><div class='cookie-notice'>ok?</div><div class=\"ad\">buy</div><p>body</p></article>", "body"),
    ("<article class='has-sidebar'><div class='no-ads'>kept</div><div class='header-image main'>gone</div></article>", "kept"),
    ("<article><!-- <p>no</p> --><p title='a > b'>yes &lt;tag&gt; &#233; &eacute; &#x1F600;</p></article>", "yes <tag> é é 😀"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>c1<td>c2</table></article>", "1\n2\nc1\nc2"),
    ("<ARTICLE><P>upper</P></ARTICLE>tail", "upper"),
    ("<article><p>never closed <i>at all", "never closed at all"),
    ("<article><p>a < b and 1<2</p></article>", "a < b and 1<2"),
    ("<article><header><h1>t</h1></header><p>p</p></article>", "p"),
    ("<article><p>x&nbsp;y z</p></article>", "x y z"),
    ("<article><p hidden>h</p><p aria-hidden='true'>h</p><p style='display: none'>h</p><p role=note>n</p></article>", "n"),
    ("<article><textarea><p>t</p></textarea><button>b</button><p>x</p></p></div></article>", "x"),
    ("<article><div>a<div>b</div>c</div></article>", "a\nb\nc"),
    ("<article><p>tail <b", "tail"),
    ("", ""),
    (None, ""),
    ("<p>no article</p>", ""),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_article(page, text):
    assert article(page) == text


def test_reader_takes_anything():
    rnd = random.Random(1)
    pieces = ["<p>", "</p>", "<article", ">", "<", "</", "article>", "<!--", "-->", "x", "&", "&amp", '"', "'", "=", "<b>", "<script>", "\n", "<!", "]]>"]
    for _ in range(3000):
        markup.read("".join(rnd.choice(pieces) for _ in range(rnd.randrange(30))))
    long = "<a href='" + "x" * 300_000 + "<p>" * 50_000 + "<" * 50_000
    assert markup.read(long) is not None


def test_repeated_runs_equal_brute_force():
    rnd = random.Random(2)
    for _ in range(60):
        pages = [[rnd.randrange(3) for _ in range(rnd.randrange(25))] for _ in range(rnd.randrange(1, 7))]
        ids, page, bounds = [], [], []
        for k, tokens in enumerate(pages):
            bounds.append(len(ids))
            ids += [*tokens, -1 - k]
            page += [k] * (len(tokens) + 1)
        own = {}
        for k, tokens in enumerate(pages):
            for j in range(len(tokens) - 3):
                own.setdefault(tuple(tokens[j : j + 4]), set()).add(k)
        expected = [bounds[k] + j for k, t in enumerate(pages) for j in range(len(t) - 3) if len(own[tuple(t[j : j + 4])]) > 1]
        found = extraction.repeated(np.array(ids), np.array(page), 4, 2)
        assert found.tolist() == expected


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 3, 200)
    order, shared = extraction.suffix_array(ids, 200)
    suffixes = [tuple(ids[k:]) for k in order]
    assert suffixes == sorted(suffixes)
    for k in range(1, len(order)):
        a, b = suffixes[k - 1], suffixes[k]
        same = next((j for j in range(min(len(a), len(b))) if a[j] != b[j]), min(len(a), len(b)))
        assert shared[k] == same


def site(n, words=12):
    """Pages without an article: the same frame around own text."""
    top = "Home News About Contact Terms of use apply to every page of this site at all times"
    end = "Copyright by the owner of this site who keeps all rights to each of its many pages"
    out = []
    for k in range(n):
        own = " ".join(f"p{k}w{j}" for j in range(words))
        out.append((k, f"http://u@Host.org:80/{k}", f"<div>{top}</div><p>{own}</p><div>{end}</div>", own))
    return out


@pytest.mark.parametrize("shard", [20, 100, 200_000])
def test_template_text_goes_and_unique_runs_stay(spark, shard):
    rows = site(30)
    pages = spark.createDataFrame([r[:3] for r in rows], SCHEMA).repartition(5)
    found = extraction.extract(pages, shard_tokens=shard).collect()
    assert {r.page_id: r.text for r in found} == {r[0]: r[3] for r in rows}
    assert all(r.n_chars == len(r.text) and r.n_unique_words == 12 and r.n_template_words == 34 for r in found)


@pytest.mark.parametrize("shard", [10, 200_000])
def test_copies_are_no_template_and_hosts_are_apart(spark, shard):
    text = "<p>" + " ".join(f"w{k}" for k in range(40)) + "</p>"
    other = "<p>" + " ".join(f"v{k}" for k in range(40)) + "</p>"
    rows = [(1, "http://a.org/1", text), (2, "http://a.org/2", text), (1, "http://a.org/1", text), (3, "http://b.org/", text), (4, "//a.org/x", other)]
    found = extraction.extract(spark.createDataFrame(rows, SCHEMA), shard_tokens=shard).collect()
    assert sorted(r.page_id for r in found) == [1, 1, 2, 3, 4]
    assert all(len(r.text.split()) == 40 and r.n_template_words == 0 for r in found)


def test_article_is_kept_however_often_it_is_repeated(spark):
    body = " ".join(f"w{k}" for k in range(30))
    rows = [(k, "http://a.org/", f"<nav>menu one two {k}</nav><article><p>{body}</p><p>own {k}</p></article><p>after</p>") for k in range(9)]
    found = extraction.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in found} == {k: f"{body}\nown {k}" for k in range(9)}


def test_edge_rows(spark):
    rows = [
        (None, None, None), (1, None, "<article>a</article>"), (1, None, "<article>a</article>"), (2, "not a url", ""),
        (3, "http://x/", "   "), (4, "http://x/", "plain"), (5, "", "<article><p>" + "long " * 200_000 + "</p></article>"), (None, "http://x/", "<p>b</p>"),
    ]
    pages = spark.createDataFrame(rows, SCHEMA)
    for name in ("text", "key", "host", "article", "starts"):
        pages = pages.withColumn(name, F.lit("x"))
    found = extraction.extract(pages)
    texts = sorted(((r.page_id, r.url, r.text[:9], r.n_chars) for r in found.collect()), key=repr)
    expected = [
        (None, None, "", 0), (1, None, "a", 1), (1, None, "a", 1), (2, "not a url", "", 0), (3, "http://x/", "", 0),
        (4, "http://x/", "plain", 5), (5, "", "long long", 999_999), (None, "http://x/", "b", 1),
    ]
    assert texts == sorted(expected, key=repr)
    assert extraction.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_pages_of_the_tables(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    expected = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S).group(1).replace("<br>", " ")
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", body))
        expected[r.page_id] = "\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in extraction.extract(pages).collect()} == expected


def prose(seed, n):
    rnd = random.Random(seed)
    return [f"{rnd.choice('abcdefgh')}{rnd.randrange(500)}" for _ in range(n)]


@pytest.mark.parametrize("shard", [100, 200_000])
def test_near_copies_without_article_keep_their_text(spark, shard):
    rows = []
    for k in range(12):  # near copies: the same two paragraphs, two closing words of their own
        body = "".join(f"<p>{' '.join(prose(p, 40))}</p>" for p in (1, 2))
        rows.append((k, "http://a.org/x", f"{body}<p>changed c{k}</p>"))
    found = extraction.extract(spark.createDataFrame(rows, SCHEMA), shard_tokens=shard).collect()
    assert {r.page_id: len(r.text.split()) for r in found} == {k: 82 for k in range(12)}
    assert all(r.n_template_words == 0 for r in found)


@pytest.mark.parametrize("shard", [100, 200_000])
def test_quotation_stays_and_frame_goes(spark, shard):
    quoted = " ".join(prose(99, 12))
    frame = " ".join(prose(98, 15))
    rows, expected = [], {}
    for k in range(20):
        own = " ".join(prose(k, 60)) + (f" {quoted}" if k < 5 else "")
        rows.append((k, "http://a.org/x", f"<div>{frame}</div><p>{own}</p>"))
        expected[k] = own
    found = extraction.extract(spark.createDataFrame(rows, SCHEMA), shard_tokens=shard).collect()
    assert {r.page_id: r.text for r in found} == expected


def test_families_are_near_copies_only(spark):
    schema = "host string, page long, n_tokens long, values binary, bands array<long>"
    base = prose(5, 400)
    texts = [base, [*base[:200], "x", *base[201:]], [*base[:50], "y", *base[51:]], [*base[:200], *prose(6, 200)], prose(7, 400), ["a"], ["a"]]
    rows = []
    for k, values in enumerate(extraction.min_hashes([" ".join(words) for words in texts])):
        rows.append(("h", k, 1, bytearray(values.astype(np.uint8).tobytes()), extraction.bands_of(values)))
    rows.append(("other", 8, *rows[0][2:]))
    found = extraction.families(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page, r.family) for r in found) == [(0, 0), (1, 0), (2, 0), (5, 5), (6, 5)]


@pytest.mark.parametrize("shard", [100, 200_000])
def test_words_of_declared_articles_are_in_the_streams(spark, shard):
    shared = " ".join(prose(97, 15))
    rows = [(k, "http://a.org/x", f"<nav>menu {k}</nav><article><p>{shared}</p><p>{' '.join(prose(k, 60))}</p></article>") for k in range(20)]
    rows.append((20, "http://a.org/x", f"<p>{shared}</p><p>{' '.join(prose(20, 60))}</p>"))
    found = {r.page_id: r for r in extraction.extract(spark.createDataFrame(rows, SCHEMA), shard_tokens=shard).collect()}
    # a run that articles repeat is found: it is counted there, and it is no text of a page without article
    assert all(found[k].text == f"{shared}\n{' '.join(prose(k, 60))}" for k in range(20))
    assert found[20].text == " ".join(prose(20, 60))
    assert all(found[k].n_template_words == 15 for k in range(21))
    assert [found[k].n_unique_words for k in (0, 20)] == [62, 60]


def test_texts_cross_the_network_once(spark):
    rows = [r[:3] for r in site(30)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = extraction.extract(spark.createDataFrame([*rows, *[rows[0]] * 200], SCHEMA).coalesce(1), shard_tokens=100)
        plan = found._jdf.queryExecution().executedPlan().toString()
        texts = sorted(r.text for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # only the marks of template runs are dealt, to where the shards are
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert texts == sorted([r[3] for r in site(30)] + [site(1)[0][3]] * 200)
