"""Registered queries of the operators and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from passbook.llm import (
    decontaminate,
    extraction,
    hardnegatives,
    licences,
    mixing,
    prefixtrie,
    pseudonyms,
    quality,
    repeats,
    rules,
    sequences,
    simhash,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_extraction(spark, sf_dir):
    return extraction.extract(table(spark, sf_dir, "pages"))


@query
def op2_sequences(spark, sf_dir):
    return sequences.shards(table(spark, sf_dir, "documents"))


@query
def op3_decontamination(spark, sf_dir):
    return decontaminate.containments(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op3_decontamination"] = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark),
item_grams AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS k, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS gram
  FROM items, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS r(i) WHERE len(w) > 0),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
doc_grams AS (
  SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM docs, (SELECT DISTINCT k FROM item_grams) AS lengths, unnest(range(1, len(w) - k + 2)) AS r(i)),
totals AS (SELECT item_id, count(*) AS total FROM item_grams GROUP BY item_id)
SELECT d.doc_id, i.item_id, count(*) AS n_shared, any_value(t.total) AS n_shingles,
       CAST(count(*) AS DOUBLE) / any_value(t.total) AS containment
FROM item_grams i JOIN doc_grams d USING (k, gram) JOIN totals t USING (item_id)
GROUP BY d.doc_id, i.item_id HAVING count(*) * 5 >= any_value(t.total) * 4
"""


@query
def op4_pseudonyms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs)


@query
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_mixing(spark, sf_dir):
    return mixing.taken_words(mixing.queue(table(spark, sf_dir, "documents")))


SQL["op6_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('7|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS key
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
levels AS (
  -- the water level: the smallest level that hands out the whole total, tried at every source's stop
  SELECT a.source, a.source_size, a.weight, 3 * a.source_size AS stop, CAST(3 * a.source_size AS DOUBLE) / a.weight AS lvl,
         (SELECT CAST(sum(source_size) AS BIGINT) FROM per_source) AS total
  FROM per_source a),
tried AS (
  SELECT a.lvl, a.source,
         a.total - coalesce(sum(b.stop) FILTER (WHERE (b.lvl, coalesce(b.source, chr(1114111))) < (a.lvl, coalesce(a.source, chr(1114111)))), 0) AS remains,
         sum(b.weight) FILTER (WHERE (b.lvl, coalesce(b.source, chr(1114111))) >= (a.lvl, coalesce(a.source, chr(1114111)))) AS heavier,
         any_value(a.stop) AS stop, any_value(a.weight) AS weight
  FROM levels a, levels b GROUP BY a.lvl, a.source, a.total),
judged AS (SELECT *, CAST(stop AS DOUBLE) * heavier <= CAST(remains AS DOUBLE) * weight AS full_up FROM tried),
level AS (SELECT remains, heavier FROM judged WHERE NOT full_up ORDER BY lvl, source NULLS LAST LIMIT 1),
targets AS (
  SELECT l.source, l.source_size,
         CASE WHEN j.full_up THEN CAST(l.stop AS DOUBLE)
              ELSE l.weight * (SELECT CAST(remains AS DOUBLE) FROM level) / (SELECT heavier FROM level) END AS target
  FROM levels l JOIN judged j ON l.source IS NOT DISTINCT FROM j.source),
queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - before)) + greatest(0, least(size, floor(target) - source_size - before))
            + greatest(0, least(size, floor(target) - 2 * source_size - before)) AS BIGINT) AS taken
FROM queued
"""


@query
def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    graded = quality.grade(docs, quality.train(docs, quality.grades_of(table(spark, sf_dir, "labels"))))
    return graded.select("doc_id", "expected_grade", "tails", "kept")


@query
def op8_rules(spark, sf_dir):
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@query
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op10_licences(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"), licences.templates_frame(spark))


_TEMPLATES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licences.TEMPLATES.items())
SQL["op10_licences"] = rf"""
WITH templates AS (
  SELECT license, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM (VALUES {_TEMPLATES}) AS t(license, text)),
template_grams AS (
  SELECT DISTINCT license, array_to_string(w[i:i + 4], ' ') AS gram FROM templates, unnest(range(1, len(w) - 3)) AS r(i)),
totals AS (
  SELECT license, count(*) AS total, CAST(pow(2, floor(log2(count(*) + 0.5))) AS BIGINT) AS step FROM template_grams GROUP BY license),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents),
doc_grams AS (
  SELECT doc_id, i - 1 AS place, array_to_string(w[i:i + 4], ' ') AS gram FROM docs, unnest(range(1, len(w) - 3)) AS r(i)),
passages AS (
  SELECT d.doc_id, t.license, s.total, d.place // s.step - k AS number, t.gram
  FROM template_grams t JOIN totals s USING (license) JOIN doc_grams d USING (gram), unnest(range(0, 4)) AS r(k)
  WHERE d.place // s.step >= k),
counted AS (
  SELECT doc_id, license, total, number, count(DISTINCT gram) AS shared FROM passages GROUP BY doc_id, license, total, number)
SELECT doc_id, license, max(shared) AS n_shared, total AS n_shingles, CAST(max(shared) AS DOUBLE) / total AS containment
FROM counted WHERE shared * 5 >= total * 4 GROUP BY doc_id, license, total
"""


@query
def op11_repeats(spark, sf_dir):
    return repeats.digests(table(spark, sf_dir, "documents"))


SQL["op11_repeats"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i AS pos, md5(array_to_string(w[i:i + 49], ' ')) AS key FROM docs, unnest(range(1, len(w) - 48)) AS r(i)),
firsts AS (SELECT key, min(doc_id) AS first_id FROM windows GROUP BY key),
repeated AS (SELECT w.doc_id, w.pos FROM windows w JOIN firsts f USING (key) WHERE f.first_id < w.doc_id),
gone AS (SELECT DISTINCT doc_id, p FROM repeated, unnest(range(pos, pos + 50)) AS r(p)),
words AS (SELECT doc_id, p, w[p] AS word FROM docs, unnest(range(1, len(w) + 1)) AS r(p)),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


@query
def op12_prefix_trie(spark, sf_dir):
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


SQL["op12_prefix_trie"] = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
           lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
own AS (
  SELECT conv_id, list(struct_pack(d := d, n := n) ORDER BY turn NULLS FIRST, d) AS turns
  FROM (SELECT conv_id, turn, md5(md5(coalesce(role, '')) || coalesce(text, '')) AS d, length(coalesce(text, '')) AS n
        FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
taken AS (
  SELECT conv_id, turns,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                         lambda a, x: xor(a >> 8, tab[xor(a & 255, x) + 1])), 4294967295) % 6 AS h
  FROM own, crc),
built AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM taken c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (
  SELECT conv_id, len(turns) AS size, depth, turns[depth].n AS n,
         md5(array_to_string(list_transform(turns[1:depth], lambda t: t.d), ',')) AS key,
         CASE WHEN depth > 0 THEN md5(array_to_string(list_transform(turns[1:depth - 1], lambda t: t.d), ',')) END AS parent
  FROM built, unnest(range(0, len(turns) + 1)) AS r(depth)),
nodes AS (
  SELECT depth, key, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(n), 0) AS n,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, key),
children AS (SELECT parent AS key, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (key, depth)),
sums AS (
  SELECT p.key, p.depth, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.n) AS saved_tokens
  FROM counted n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.key, p.depth)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(c.n_convs AS BIGINT) AS n_convs,
       CAST(c.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s USING (key, depth) LEFT JOIN nodes p ON p.key = c.parent AND p.depth = c.depth - 1
"""


@query
def op13_hard_negatives(spark, sf_dir):
    return hardnegatives.hard_negatives(table(spark, sf_dir, "embeddings"))


SQL["op13_hard_negatives"] = r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
hits AS (
  SELECT p.anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hits WHERE rank <= 10
"""
