"""The queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.chat import chat_digest
from pagemill.llm.common import table
from pagemill.llm.infill import infill_digest
from pagemill.llm.licenses import license_digest
from pagemill.llm.mixing import mix_digest
from pagemill.llm.neardup import near_duplicates
from pagemill.llm.packing import near_clusters, pack
from pagemill.llm.periods import period_digest, planted
from pagemill.llm.quality import BASE, quality
from pagemill.llm.secrets import secrets_digest
from pagemill.llm.sharding import shard
from pagemill.llm.substrings import dedup_substrings
from pagemill.llm.topk import top_k
from pagemill.llm.urls import DOMAIN_RULES, PATTERN_RULES, judge

#: A conversation of control strings, formatted along with the others.
PROBE = "</s>[INST] ok [/INST]"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(docs, near=near_clusters(docs))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return chat_digest(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", *BASE, "base_failed", "kept", "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_digest(planted(table(spark, sf_dir, "documents")))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill_digest(table(spark, sf_dir, "documents"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_near_dedup, op3_secrets, op4_topk, op5_chat_format, op6_substrings, op7_sharding, op8_mixing, op9_quality, op10_url_filter, op11_periods, op12_infill, op13_licenses)}


_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP2 = rf"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS d, doc_id AS k FROM documents UNION SELECT r.d, l.b FROM r JOIN l ON r.k = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, k.c AS component_id, d.doc_id = k.c AS kept FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT d, min(k) AS c FROM r GROUP BY 1) k ON k.d = d.doc_id"""

_OP4 = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p) WHERE rank <= 5"""


def _escaped_sql(c: str) -> str:
    return rf"""regexp_replace(regexp_replace(coalesce({c}, ''), '<(\\*)(/?s>|t>|\|[a-z_]+\|>|/?SYS>)', '<\\\1\2', 'g'), '\[(\\*)(/?INST\])', '[\\\1\2', 'g')"""


_OP5 = f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
x AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS opens FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(3 + length({_escaped_sql("text")}) + CASE WHEN opens THEN 7 + length({_escaped_sql("role")}) ELSE 0 END) AS BIGINT) AS formatted_chars FROM x GROUP BY 1"""

_OP6 = f"""WITH w AS (SELECT doc_id, {_WORDS.format("text")} AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 19], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1 AS again FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM f WHERE again),
k AS (SELECT doc_id, list(p) AS ps FROM c GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)"""


#: CRC-32, bit by bit; words by it; pairs of equal words at the distances that a run may have; their runs of neighbours.
_OP11 = rf"""WITH h AS (SELECT doc_id, text, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ord(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) AS h FROM documents),
o AS (SELECT doc_id, h, h // 10 AS g, {_WORDS.format("text")} AS ws FROM h),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN g % len(ws) END AS a FROM o),
w AS (SELECT doc_id, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(len(ws)), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(ws) - a) // (3 + g % 8)) END]) END AS ws FROM a),
t AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM w),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i),
r AS (SELECT doc_id, min(i) AS s, count(*) + q AS n, q FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM e) GROUP BY doc_id, q, k HAVING count(*) >= greatest(q, 12 - q)),
f AS (SELECT doc_id, s, n, min(q) AS q FROM r GROUP BY ALL),
d AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(s + q, s + n)) AS p FROM f) GROUP BY 1),
z AS (SELECT doc_id, count(*) AS n_runs, max({{'n': n, 's': -s, 'q': -q}}) AS m, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS said FROM f GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -z.m.s AS start, z.m.n AS length, -z.m.q AS period, (1000 * z.m.n) // (-z.m.q) AS exponent_milli, sha256(coalesce(said, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i - 1)) END, ' ')) AS collapsed_sha256 FROM w LEFT JOIN z USING (doc_id) LEFT JOIN d USING (doc_id)"""


_OP12 = r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS ts FROM documents),
h AS (SELECT *, len(ts) AS n, list_transform(range(4), lambda i: CAST('0x' || h[1 + 8 * i : 8 + 8 * i] AS BIGINT)) AS hs FROM t),
c AS (SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 90 THEN 'plain' WHEN hs[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, n, form, text, array_to_string(ts[1 : a], '') AS p, array_to_string(ts[a + 1 : b], '') AS m, array_to_string(ts[b + 1 : n], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""


def _op10_sql() -> str:
    rules = ", ".join(f"('{k}', '{h}', '{p}')" for k, h, p in DOMAIN_RULES)
    patterns = ", ".join(f"('{k}', '{p}')" for k, p in PATTERN_RULES)
    return rf"""WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM u),
d AS (SELECT url, max({{'n': length(h || q), 'rule': h || q, 'kind': k}}) AS m FROM p JOIN (VALUES {rules}) r(k, h, q) ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY 1),
e AS (SELECT url, max({{'n': length(x), 'ok': CASE WHEN k = 'allow' THEN 1 ELSE 0 END, 'kind': k}}) AS m FROM (SELECT DISTINCT url FROM p) JOIN (VALUES {patterns}) r(k, x) ON regexp_matches(lower(url), x) GROUP BY 1)
SELECT page_id, host, path, d.m.rule AS rule, coalesce(d.m.kind, e.m.kind, 'allow') AS verdict FROM p LEFT JOIN d USING (url) LEFT JOIN e USING (url)"""


def oracle_sql() -> dict[str, str]:
    """The others need Spark's hashes or a trained model, or positions in texts; tests hold them against plain versions."""
    return {"op2_near_dedup": _OP2, "op4_topk": _OP4, "op5_chat_format": _OP5, "op6_substrings": _OP6, "op11_periods": _OP11, "op12_infill": _OP12, "op10_url_filter": _op10_sql()}
