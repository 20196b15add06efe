"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import bwt_dedup, byte_bpe, hidden_markov, html_templates, kd_search, kneser_ney, line_dedup, line_rules, lsh_forest, mixing, spelling, super_windows, token_alignment
from lexiloom.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


def public_ranks() -> tuple[str, str]:
    """Rank file and split pattern of the public multilingual tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks, pattern = public_ranks()
    return byte_bpe.encode(docs, ranks, pattern, ids=False, digests=True).drop("text")


_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_PASSES = rf"""(NOT regexp_matches(l, '[^\x20\x09-\x0D]') OR NOT (
    (len({_WORDS.format("l")}) < 4 AND NOT regexp_matches(l, '{line_rules.END_MARK.replace("'", "''")}'))
    OR (len(regexp_extract_all(l, '{line_rules.SEPARATOR}')) >= 2
        AND len(regexp_extract_all(l, '{line_rules.SEPARATOR}')) * 100 >= 20 * len({_WORDS.format("l")}))
    OR len(regexp_extract_all(l, '{line_rules.SYMBOLS}')) * 100 >= 20 * len({_WORDS.format("l")})
    OR (NOT regexp_matches(l, '{line_rules.SMALL}') AND regexp_matches(l, '({line_rules.CAPITAL}[^a-z]*){{4}}'))
    OR regexp_matches(lower(l), '{line_rules.BOILERPLATE}')))"""


@query(
    "op7_line_rules",
    rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, t, {_WORDS.format("t")} AS w, string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT doc_id, i, w[i]||' '||w[i+1]||' '||w[i+2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w)-1)) AS i FROM s WHERE len(w) >= 3)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
m AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, i FROM r UNION SELECT doc_id, i+1 FROM r
  UNION SELECT doc_id, i+2 FROM r) GROUP BY doc_id),
b AS (SELECT s.doc_id, t, ls, len(w)::BIGINT AS n_words,
  length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  (len(list_filter(ls, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
    - len(list_distinct(list_filter(ls, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
  coalesce(m.n, 0)::BIGINT AS n_repeat_words FROM s LEFT JOIN m ON m.doc_id = s.doc_id),
f AS (SELECT *, n_words < 50 OR 100*n_repeat_words > 50*n_words AS base_failed,
  array_to_string(list_filter(ls, lambda l: {_PASSES}), chr(10)) AS clean FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100*length(clean) >= 60*length(t) AS kept, sha256(clean) AS clean_sha256 FROM f""",
)
def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = line_rules.measure(docs).drop("text")
    return measured.withColumn("clean_sha256", F.sha2(F.col("clean_text").cast("binary"), 256)).drop("clean_text")


@query(
    "op5_line_dedup",
    r"""WITH l AS (SELECT doc_id, i-1 AS pos, ls[i] AS line, length(ls[i]) AS len FROM
  (SELECT doc_id, ls, unnest(range(1, len(ls)+1)) AS i
   FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
w AS (SELECT doc_id, pos, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM l),
k AS (SELECT *, array_to_string(w, ' ') AS k, len(w) AS n FROM w WHERE len(w) > 0),
f AS (SELECT k, w, n, min(doc_id::HUGEINT * 2147483648 + pos) AS o FROM k GROUP BY k, w, n),
v AS (SELECT k, n, o, i, array_to_string(w[:i-1], ' ')||chr(1)||array_to_string(w[i+1:], ' ') AS place_key,
  array_to_string(list_concat(w[:i-1], w[i+1:]), ' ') AS d
  FROM (SELECT *, unnest(range(1, n+1)) AS i FROM f WHERE n >= 6)),
r AS (SELECT o FROM (SELECT o, min(o) OVER (PARTITION BY n, i, place_key) AS m FROM v) WHERE m < o
  UNION SELECT v.o FROM v JOIN f ON f.k = v.d WHERE f.n >= 6 AND f.o < v.o
  UNION SELECT f.o FROM v JOIN f ON f.k = v.d WHERE f.n >= 6 AND v.o < f.o),
g AS (SELECT k.doc_id, k.pos FROM k JOIN f ON f.k = k.k
  WHERE f.o <> k.doc_id::HUGEINT * 2147483648 + k.pos OR f.o IN (SELECT o FROM r))
SELECT l.doc_id, count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]'))::BIGINT AS n_lines,
  count(g.pos)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id""",
)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.deduplicate(docs).drop("text")
    return out.withColumn("kept_sha256", F.sha2(F.col("dedup_text").cast("binary"), 256)).drop("dedup_text")


@query("op4_mixing")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.Mix(docs).per_document().withColumnRenamed("_doc", "doc_id")


@query(
    "op2_kd_search",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id,
  list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * v.e[i]))::BIGINT AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
)
def op2_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return kd_search.top_k(vectors, F.col("vec_id") % 50 == 0)


@query(
    "op3_lsh_forest",
    r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i]||' '||w[i+1]||' '||w[i+2]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, label) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node),
m AS (SELECT node, min(label) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
)
def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lsh_forest.near_duplicates(docs, width=3, percent=85)


@query("op9_html_templates")
def op9_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_templates.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op10_kneser_ney")
def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_hidden_markov")
def op8_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return hidden_markov.score(docs, remainder == 2)


@query(
    "op6_bwt_dedup",
    """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, row_number() OVER () AS r FROM documents),
w AS (SELECT r, s, md5(substr(h, 2*s + 1, 400)) AS m FROM
  (SELECT r, h, unnest(range(0, len(h)//2 - 199)) AS s FROM d WHERE len(h) >= 400)),
c AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY m) AS n FROM w) WHERE n > 1),
g AS (SELECT r, s, sum(CASE WHEN s <= p + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY s) AS g
  FROM (SELECT r, s, lag(s, 1, -1000) OVER (PARTITION BY r ORDER BY s) AS p FROM c)),
x AS (SELECT r, min(s) AS a, max(s) + 200 AS b FROM g GROUP BY r, g),
e AS (SELECT r, a, b, lead(a) OVER (PARTITION BY r ORDER BY a) AS next FROM x),
k AS (SELECT d.r, sum(b - a)::BIGINT AS n, count(*)::BIGINT AS spans,
  substr(any_value(h), 1, 2*min(a)::BIGINT)
    || string_agg(substr(h, 2*b + 1, 2*(coalesce(next, len(h)//2) - b)), '' ORDER BY a) AS left_
  FROM e JOIN d ON d.r = e.r GROUP BY d.r)
SELECT doc_id, (len(h)//2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(left_, h))) AS kept_sha256 FROM d LEFT JOIN k ON k.r = d.r""",
)
def op6_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bwt_dedup.remove_repeats(docs).drop("kept_bytes")


@query(
    "op11_super_windows",
    r"""WITH d AS (SELECT doc_id, row_number() OVER () AS r,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT r, i, md5(array_to_string(w[i:i+34], ' ')) AS m FROM
  (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
c AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY m) AS n FROM v) WHERE n > 1),
g AS (SELECT r, i, sum(CASE WHEN i <= p + 35 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g
  FROM (SELECT r, i, lag(i, 1, -1000) OVER (PARTITION BY r ORDER BY i) AS p FROM c)),
x AS (SELECT r, min(i) AS a, max(i) + 35 AS b FROM g GROUP BY r, g),
e AS (SELECT r, a, b, lead(a) OVER (PARTITION BY r ORDER BY a) AS next FROM x),
k AS (SELECT d.r, sum(b - a)::BIGINT AS n, list_concat(any_value(w)[1:min(a)-1],
    flatten(list(w[b:coalesce(next, len(w) + 1) - 1] ORDER BY a))) AS left_
  FROM e JOIN d ON d.r = e.r GROUP BY d.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(coalesce(left_, w), ' '), '')) AS kept_sha256 FROM d LEFT JOIN k ON k.r = d.r""",
)
def op11_super_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = super_windows.remove_windows(docs)
    return out.withColumn("kept_sha256", F.sha2(F.col("kept_text").cast("binary"), 256)).drop("kept_text")


# CRC-32 in SQL: its table of 256 entries by the rule, then one look-up a byte.
_CRC = """t AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""


@query(
    "op12_spelling",
    rf"""WITH RECURSIVE {_CRC},
o AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n FROM
  (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents)
  WHERE length(r) >= 6 GROUP BY ALL),
b AS (SELECT r, n, list_transform(string_split(rtrim(regexp_replace(hex(encode(coalesce(doc_id::VARCHAR, '')||':'||r)), '(..)', '\1 ', 'g')), ' '),
    lambda x: ('0x'||x)::BIGINT) AS b FROM o),
h AS (SELECT r, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM b, t),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r))||substr(r, h % length(r) + 2) ELSE r END AS w, sum(n)::BIGINT AS n
  FROM h GROUP BY 1),
v AS MATERIALIZED (SELECT w, n, length(w) AS l FROM w WHERE length(w) >= 6 AND n >= 5),
d AS MATERIALIZED (SELECT w, n, l, i, substr(w, 1, i - 1) AS p, substr(w, i + 1) AS s FROM (SELECT *, unnest(range(1, l + 1)) AS i FROM v)),
near AS (SELECT a.w, b.w AS x, b.n FROM d a JOIN d b ON a.i = b.i AND a.p = b.p AND a.s = b.s AND a.l = b.l AND a.w <> b.w
  UNION SELECT d.w, v.w, v.n FROM d JOIN v ON v.w = d.p||d.s UNION SELECT v.w, d.w, d.n FROM d JOIN v ON v.w = d.p||d.s),
best AS (SELECT w, count(*)::BIGINT AS n_near, arg_min(x, (-n, x)) AS x, max(n) AS xn FROM near GROUP BY w),
f AS MATERIALIZED (SELECT v.w, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN xn >= 5 * v.n THEN x END AS form,
  CASE WHEN xn >= 5 * v.n THEN xn END AS form_n FROM v LEFT JOIN best ON best.w = v.w),
c(w, root) AS (SELECT w, w FROM f UNION ALL SELECT c.w, f.form FROM c JOIN f ON f.w = c.root WHERE f.form IS NOT NULL)
SELECT f.w AS word, form, c.root, n, n_near, form_n FROM f
  JOIN (SELECT c.w, c.root FROM c JOIN f ON f.w = c.root WHERE f.form IS NULL) c ON c.w = f.w""",
)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group_variants(spelling.vocabulary(docs))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align(docs, *paths, groups=False).withColumnRenamed("groups", "groups_sha256")
