"""The registered queries of the pipeline operators, and SQL for those that SQL can express."""

from __future__ import annotations

import os
import secrets

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.llm import (kdshards, langid, licenses, mixing, ordermh, packing, phrases, prefixtrie, quotes, simhash, surrogates, topk,
                          urlfilter)
from tidecast.session import configure

#: The rules of the url filter: host, path, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


#: Key of the surrogates; whoever holds it can tell which entity a surrogate stands for.  Without one, each session draws its own.
KEY = os.environ.get("TIDECAST_PII_KEY") or secrets.token_hex(32)


def vocabulary() -> str:
    """Path of the tokenizer's file; ``TIDECAST_VOCABULARY`` names another."""
    if path := os.environ.get("TIDECAST_VOCABULARY"):
        return path
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"), vocabulary())


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, folder, "documents"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    return urlfilter.filter_urls(pages, urlfilter.build_rules(urlfilter.rules_table(spark, RULES)))


def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return ordermh.order_minhash(read(spark, folder, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(read(spark, folder, "documents"))


def op7_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, KEY, counted="entities")


def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return langid.predict(docs, langid.learn(docs))


def op10_quote_linking(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.reply_ordered(read(spark, folder, "conversations"))


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.prefix_trie(read(spark, folder, "conversations"))


def op13_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    return kdshards.kd_shards(read(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_license_scan, op3_url_filter, op4_order_minhash, op5_simhash_near_dedup, op6_mixing, op7_pii_surrogates, op8_top_k,
                                 op9_language_id, op10_quote_linking, op11_phrases, op12_prefix_trie, op13_kd_shards)}

#: The rules as SQL rows.
_RULES_SQL = ", ".join(str(rule) for rule in RULES)

ORACLES: dict[str, str] = {
    "op3_url_filter": rf"""WITH u AS (SELECT row_number() OVER () AS place, page_id,
  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT place, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS cased FROM u),
p AS (SELECT place, page_id, translate(cased, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(cased) + 1), '^[^?#]*') AS path FROM h),
r(rule_host, rule_path, verdict) AS (VALUES {_RULES_SQL}),
fits AS (SELECT place, rule_host || rule_path AS rule, verdict, row_number() OVER (
    PARTITION BY place ORDER BY length(rule_host) + length(rule_path) DESC, length(rule_host) DESC) AS n
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM fits WHERE n = 1) f USING (place)""",
    "op6_mixing": rf"""WITH s AS (SELECT row_number() OVER () AS place, doc_id, source,
  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
  md5(coalesce(doc_id::VARCHAR, '')) AS key, md5(coalesce(text, '')) AS text_key FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY 1),
w AS (SELECT *, {list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
  {mixing.PASSES} * source_size AS cap, sum(source_size) OVER () AS budget FROM t),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
  sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others FROM w),
f AS (SELECT *, cap * others <= weight * (budget - given) AS capped FROM o),
g AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE
  (weight * (budget - coalesce(sum(cap) FILTER (capped) OVER (), 0)))::DOUBLE / (sum(weight) FILTER (NOT capped) OVER ())::DOUBLE END AS target FROM f),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, text_key, place
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM s),
c AS (SELECT place, doc_id, key, text_key, b.source, size, target, copy, copy * source_size + before AS start
  FROM b JOIN g ON b.source IS NOT DISTINCT FROM g.source, range({mixing.PASSES}) AS copies(copy)),
d AS (SELECT place, doc_id, key, text_key, source, copy, greatest(0, least(size, floor(target)::BIGINT - start)) AS words, (start + size)::DOUBLE / target AS finish FROM c),
e AS (SELECT place, words, coalesce(sum(words) OVER (ORDER BY finish, source NULLS FIRST, key, doc_id, text_key, place, copy
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS position FROM d WHERE words > 0),
m AS (SELECT place, sum(words)::BIGINT AS taken, min(position) AS first_position FROM e GROUP BY 1)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, coalesce(first_position, -1) AS first_position
FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source LEFT JOIN m USING (place)""",
    "op8_top_k": """WITH v AS (SELECT row_number() OVER () AS place, vec_id,
  [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.place, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.place <> c.place WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_phrases": rf"""WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT doc, lang, unnest(range(len(pieces))) AS piece, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS words FROM d),
w AS (SELECT doc, lang, piece, unnest(range(len(words))) AS place, unnest(words) AS word FROM p),
s AS (SELECT lang, word AS w1, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3, lead(word, 3) OVER o AS w4
  FROM w WINDOW o AS (PARTITION BY doc, piece ORDER BY place)),
f AS (SELECT lang, w1 AS phrase, 1 AS m, count(*) AS a FROM s GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2, 2, count(*) FROM s WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) FROM s WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4, count(*) FROM s WHERE w4 IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
g AS MATERIALIZED (SELECT * FROM f WHERE a >= {phrases.LEAST}),
c AS (SELECT lang, phrase, m, a, string_split(phrase, ' ') AS ws FROM g WHERE m > 1),
cuts AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:m], ' ') AS rp FROM c, range(1, 4) t(k) WHERE k < m),
scored AS (SELECT cuts.*, x.a AS l, y.a AS r, (({phrases.SCALE}::HUGEINT * cuts.a) // (x.a + y.a))::BIGINT AS score FROM cuts
  JOIN g x ON x.lang = cuts.lang AND x.phrase = lp JOIN g y ON y.lang = cuts.lang AND y.phrase = rp),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (SELECT lang, array_to_string(ws[i:i + len_ - 1], ' ') AS phrase, max(a) AS longer
  FROM c, range(2, 4) t(len_), range(1, 4) u(i) WHERE len_ < m AND i + len_ - 1 <= m GROUP BY 1, 2),
kept AS (SELECT l.* FROM lowest l LEFT JOIN inner_phrases i USING (lang, phrase) WHERE coalesce(100 * longer < {phrases.COVERED} * a, true)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {phrases.BEST}""",
    "op12_prefix_trie": rf"""WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tb),
t AS (SELECT conv_id, turn, length(coalesce(text, '')) AS n, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'d': d, 'n': n}} ORDER BY turn NULLS FIRST, d) AS turns FROM t GROUP BY conv_id),
h AS (SELECT o.*, (xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda a, b: xor(tb[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % {prefixtrie.SHARED})::INTEGER AS h FROM o, crc),
r AS (SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h], h.turns[h + 1:]) AS s
  FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % {prefixtrie.FAMILY}),
k AS (SELECT conv_id, s, len(s) AS turns, coalesce(array_to_string(list_transform(s, lambda x: x.d), ''), '') AS path FROM r),
p AS (SELECT conv_id, turns, depth, left(path, 32 * depth) AS id, CASE WHEN depth > 0 THEN s[depth].n ELSE 0 END AS chars
  FROM k, range((SELECT max(turns) + 1 FROM k)) u(depth) WHERE depth <= turns),
n AS (SELECT id, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = depth), '')) AS ends_sha256 FROM p GROUP BY ALL),
c AS (SELECT left(id, 32 * (depth - 1)) AS id, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (id)),
a AS (SELECT left(m.id, 32 * u.depth) AS id, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
  FROM m, range((SELECT max(depth) + 1 FROM m)) u(depth) WHERE u.depth <= m.depth GROUP BY 1)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, m.ends_sha256
FROM m JOIN a USING (id) LEFT JOIN m q ON m.depth > 0 AND q.id = left(m.id, 32 * (m.depth - 1))""",
}
