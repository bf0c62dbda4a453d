"""The queries opN_<name> and ``pipeline``, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm.bpe import encode_documents
from quillspark.llm.common import table
from quillspark.llm.importance import resample
from quillspark.llm.lang_cnn import fit_language_model, identify_languages
from quillspark.llm.line_templates import dedup_lines
from quillspark.llm.media_avi import encode_avi, media_digests
from quillspark.llm.merkle import manifest
from quillspark.llm.mixing import measured_weights, mixed_places
from quillspark.llm.packing import packed_rows
from quillspark.llm.sharding import shard_documents
from quillspark.llm.simhash import near_duplicates
from quillspark.llm.topk import top_k
from quillspark.llm.toxicity import fit_toxicity_model, score_toxicity
from quillspark.llm.url_rules import CONFIDENCE, COUNT, LOWER, SUPPORT, UPPER, judge_urls

#: The vocabulary that the queries use, as a tokenizers file and as ranks.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_avi_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(encode_avi(table(spark, sf_dir, "documents")))


def op2_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    placed = mixed_places(docs, measured_weights(docs))
    return placed.select("doc_id", "source", F.col("_slot").alias("slot"), F.col("_place").alias("place"))


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"), F.length(text).alias("kept_chars"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = """
WITH split_up AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT doc_id, lines, unnest(range(len(lines))) AS pos FROM split_up),
masked AS (
  SELECT doc_id, pos, list_transform(
    string_split(trim(regexp_replace(lines[pos + 1], '[ \\t\\x0B\\f\\r]+', ' ', 'g')), ' '),
    lambda x: CASE WHEN regexp_matches(x, '[0-9@]|://') THEN '<*>' ELSE x END) AS tokens
  FROM numbered),
led AS (
  SELECT doc_id, pos, tokens, len(tokens) AS n, tokens[1:3] AS lead, tokens[4:] AS rest, len(tokens) - 3 AS r, least(len(tokens) - 3, 12) AS parts
  FROM masked WHERE len(tokens) >= 5),
parsed AS (SELECT doc_id, pos, tokens, n, lead, list_transform(range(parts), lambda i: rest[(i * r) // parts + 1 : ((i + 1) * r) // parts]) AS fields FROM led),
leaves AS (SELECT n, lead FROM parsed GROUP BY n, lead HAVING count(DISTINCT doc_id) >= 3),
variants AS (
  SELECT n, lead, tokens, any_value(fields) AS fields, count(DISTINCT doc_id) AS docs
  FROM parsed JOIN leaves USING (n, lead) GROUP BY n, lead, tokens),
cut AS (SELECT n, lead, tokens, docs, fields, unnest(range(len(fields))) AS k FROM variants),
valued AS (SELECT n, lead, tokens, docs, k, fields[k + 1] AS field FROM cut),
support AS (SELECT n, lead, k, field FROM valued GROUP BY n, lead, k, field HAVING sum(docs) >= 3),
marked AS (
  SELECT v.n, v.lead, v.tokens, v.k, s.field AS constant
  FROM valued v LEFT JOIN support s ON v.n = s.n AND v.lead = s.lead AND v.k = s.k AND v.field = s.field),
templates AS (
  SELECT n, lead, tokens, list(constant ORDER BY k) AS template FROM marked
  GROUP BY n, lead, tokens HAVING count(constant) >= 0.8 * count(*)),
found AS (SELECT doc_id, pos, n, lead, template FROM parsed JOIN templates USING (n, lead, tokens)),
recurring AS (SELECT n, lead, template, min(doc_id) AS first FROM found GROUP BY n, lead, template HAVING count(DISTINCT doc_id) >= 3),
drops AS (SELECT doc_id, list(DISTINCT pos) AS gone FROM found JOIN recurring USING (n, lead, template) WHERE doc_id <> first GROUP BY doc_id),
result AS (
  SELECT d.doc_id, string_split(d.text, chr(10)) AS lines, coalesce(gone, []) AS gone, d.text
  FROM documents d LEFT JOIN drops USING (doc_id)),
kept AS (
  SELECT doc_id, lines, gone, CASE WHEN len(gone) = 0 THEN coalesce(text, '') ELSE array_to_string(list_filter(lines, lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS kept
  FROM result)
SELECT doc_id, coalesce(len(lines), 0)::INTEGER AS n_lines, len(gone)::INTEGER AS n_dropped, length(kept)::INTEGER AS kept_chars, sha256(kept) AS kept_sha256 FROM kept
"""


def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), VOCABULARY, keep_ids=False)


def op6_packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_rows(table(spark, sf_dir, "documents"), RANKS)


def op7_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 24)


def op8_term_at_a_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20, scale=64)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.w, c.w, true), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""


#: Verdict, host and path of the listed URL rules.
LISTED = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op9_mined_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), LISTED)


OP9_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
OP9_SQL = f"""
WITH cut AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '{OP9_PARTS}', 1), ''), '{UPPER}', '{LOWER}') AS host, coalesce(regexp_extract(url, '{OP9_PARTS}', 2), '') AS path,
    coalesce(regexp_extract(url, '{OP9_PARTS}', 3), '') AS args, coalesce(regexp_extract(url, '{OP9_PARTS}', 4), '') AS frag
  FROM pages),
held AS (
  SELECT page_id, url, host, path, list_sort(list_distinct(
    list_transform(list_reverse(list_filter(string_split(host, '.'), lambda x: x <> '')), lambda x: 'h:' || x)
    || list_transform(list_filter(regexp_split_to_array(path, '[/.]'), lambda x: x <> ''), lambda x: 'p:' || x)
    || list_transform(list_filter(string_split(args, '&'), lambda x: x <> ''), lambda x: 'q:' || x)
    || list_transform(list_filter([frag], lambda x: x <> ''), lambda x: 'f:' || x))) AS items
  FROM cut),
marks AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
baskets AS (SELECT items, bad FROM held JOIN marks USING (page_id)),
least AS (SELECT ceil(greatest({SUPPORT} * count(*), {COUNT} - 0.5)) AS n FROM baskets),
masks AS (SELECT items, bad, unnest(range(1, (1 << len(items))::BIGINT)) AS mask FROM baskets),
subsets AS (SELECT list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS items, bad FROM masks),
rules AS (
  SELECT items, sum(bad) / count(*) AS confidence FROM subsets GROUP BY items
  HAVING sum(bad) >= (SELECT n FROM least) AND sum(bad) / count(*) >= {CONFIDENCE}),
kept AS (SELECT * FROM rules r WHERE NOT EXISTS (SELECT 1 FROM rules o WHERE len(o.items) < len(r.items) AND list_has_all(r.items, o.items))),
met AS (SELECT u.url, max(confidence) AS confidence FROM (SELECT DISTINCT url, items FROM held) u JOIN kept k ON list_has_all(u.items, k.items) GROUP BY u.url),
listed(verdict, h, p) AS (VALUES {", ".join(map(str, LISTED))}),
fits AS (
  SELECT url, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT url, host, path FROM held) JOIN listed ON (host = h OR suffix(host, '.' || h)) AND prefix(path, p) GROUP BY url)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN confidence IS NULL THEN 'allow' ELSE 'block' END) AS verdict, confidence
FROM held LEFT JOIN met USING (url) LEFT JOIN fits USING (url)
"""


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify_languages(docs, fit_language_model(docs))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


#: CRC-32 of a list of bytes, by a table of 256 values made in SQL.
CRC_TABLE = """(SELECT list_transform(range(256), lambda n: list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc_sql(bytes_list: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_list}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(field_sql(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


DIGITS = "list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)"
OP11_SQL = f"""
WITH RECURSIVE crc AS {CRC_TABLE},
leaves AS (
  SELECT coalesce('=' || lang, '') AS g, doc_id, {leaf_sql("n_chars")} AS leaf,
    CASE WHEN n_chars IS NOT NULL AND {crc_sql(DIGITS)} % 7 = 0 THEN {leaf_sql("(n_chars + 1)")} ELSE {leaf_sql("n_chars")} END AS now
  FROM documents, crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS size FROM leaves),
nodes AS (
  SELECT g, 0 AS level, pos, size, leaf AS d FROM placed
  UNION ALL SELECT g, level + 1, pos // 2, (size + 1) // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM nodes WHERE size > 1 GROUP BY g, level + 1, pos // 2, (size + 1) // 2),
subroots AS (SELECT g, level AS height, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1),
above AS (
  SELECT 0 AS level, pos, size, subroot AS d FROM subroots
  UNION ALL SELECT level + 1, pos // 2, (size + 1) // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM above WHERE size > 1 GROUP BY level + 1, pos // 2, (size + 1) // 2),
steps AS (
  SELECT p.g, p.pos, s.level, (p.pos >> s.level) & 1 AS odd, o.d AS sibling
  FROM placed p JOIN (SELECT DISTINCT g, level FROM nodes WHERE size > 1) s ON p.g = s.g
  LEFT JOIN nodes o ON o.g = p.g AND o.level = s.level AND o.pos = xor(p.pos >> s.level, 1)
  UNION ALL
  SELECT p.g, p.pos, r.height + s.level, (r.pos >> s.level) & 1, o.d
  FROM placed p JOIN subroots r ON p.g = r.g JOIN (SELECT DISTINCT level FROM above WHERE size > 1) s ON true
  LEFT JOIN above o ON o.level = s.level AND o.pos = xor(r.pos >> s.level, 1)),
proofs AS (SELECT g, pos, list({{'odd': odd, 'sibling': sibling}} ORDER BY level) AS path FROM steps GROUP BY g, pos),
folds AS (
  SELECT g, pos, 1 AS k, now AS d, coalesce(path, []) AS path FROM placed LEFT JOIN proofs USING (g, pos)
  UNION ALL SELECT g, pos, k + 1, sha256(CASE WHEN path[k].sibling IS NULL THEN d WHEN path[k].odd = 1 THEN path[k].sibling || d ELSE d || path[k].sibling END), path
  FROM folds WHERE k <= len(path)),
ends AS (SELECT g, pos, d AS folded_root, sha256(coalesce(array_to_string(list_filter(list_transform(path, lambda x: x.sibling), lambda x: x IS NOT NULL), ''), '')) AS proof_sha256 FROM folds WHERE k = len(path) + 1)
SELECT doc_id, leaf, subroot, a.d AS root, proof_sha256, folded_root, folded_root = a.d AS verified
FROM placed JOIN ends USING (g, pos) JOIN subroots r USING (g) JOIN (SELECT d FROM above WHERE size = 1) a ON true
"""


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def features_sql(name: str, key: str) -> str:
    """CTEs <name>_words and <name>_grams: the words of each text, and all runs of up to three of them."""
    return f"""{name}_words AS (SELECT {key} AS id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM {name}),
{name}_runs AS (SELECT id, x, lead(x) OVER own AS y, lead(x, 2) OVER own AS z FROM (SELECT id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM {name}_words) WINDOW own AS (PARTITION BY id ORDER BY i)),
{name}_grams AS (SELECT id, x AS gram FROM {name}_runs UNION ALL SELECT id, x || ' ' || y FROM {name}_runs WHERE y IS NOT NULL UNION ALL SELECT id, x || ' ' || y || ' ' || z FROM {name}_runs WHERE z IS NOT NULL)"""


GRAM_BYTES = "list_transform(regexp_extract_all(hex(encode(gram)), '..'), lambda x: ('0x' || x)::BIGINT)"
OP12_SQL = f"""
WITH crc AS {CRC_TABLE},
{features_sql("documents", "doc_id")},
{features_sql("benchmark", "item_id")},
hashed AS (SELECT gram, {crc_sql(GRAM_BYTES)} % 10000 AS bucket FROM (SELECT DISTINCT gram FROM documents_grams UNION SELECT gram FROM benchmark_grams), crc),
held AS (SELECT id, bucket FROM documents_grams JOIN hashed USING (gram)),
s AS (SELECT bucket, count(*) AS n FROM held GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM benchmark_grams JOIN hashed USING (gram) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
gains AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s.n + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), totals),
weights AS (SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM held JOIN gains USING (bucket) GROUP BY id),
scored AS (
  SELECT id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents_words LEFT JOIN weights USING (id)),
ranked AS (SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, id) END AS rank, count(*) FILTER (WHERE n_words >= 20) OVER () AS n FROM scored)
SELECT id AS doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank FROM ranked
"""


def op13_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity_model(docs, table(spark, sf_dir, "labels")))


QUERIES = (
    op1_avi_media, op2_pfair_mix, op3_simhash_groups, op4_line_templates, op5_bpe_roundtrip,
    op6_packed_rows, op7_rendezvous_shards, op8_term_at_a_time, op9_mined_url_rules, op10_byte_cnn,
    op11_merkle_manifest, op12_importance_resampling, op13_factorization_toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op4_line_templates": OP4_SQL, "op8_term_at_a_time": OP8_SQL, "op9_mined_url_rules": OP9_SQL, "op11_merkle_manifest": OP11_SQL, "op12_importance_resampling": OP12_SQL}
