"""The registered queries of this subpackage: every operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import (
    conversation_repair, decontaminate, language_id, line_dedup, mixing, prefix_forest, repeated_spans, resampling, secret_scan, simhash, token_files, toxicity, url_filter,
)
from reviewmill.llm.common import crc32_modulo, prepare
from reviewmill.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its SQL twin where there is one."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_prefix_forest")
def op1_prefix_forest(spark, sf_dir):
    return prefix_forest.search(table(spark, sf_dir, "embeddings"))


@query("op2_simhash")
def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_secrets")
def op3_secrets(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


_MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 12) AS code
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sizes GROUP BY source),
shares AS (  -- the share per weight that a set of full sources leaves to the others, for every place to stop
  SELECT a.source,
         (SELECT sum(source_size) FROM sources) - coalesce(sum(3 * b.source_size) FILTER (3 * b.source_size / b.weight < 3 * a.source_size / a.weight), 0) AS remains,
         sum(b.weight) FILTER (3 * b.source_size / b.weight >= 3 * a.source_size / a.weight) AS heavy,
         3 * a.source_size / a.weight AS level
  FROM sources a, sources b GROUP BY ALL),
share AS (SELECT remains, heavy FROM shares WHERE remains < level * heavy ORDER BY level LIMIT 1),
goals AS (
  SELECT source, source_size,
         CASE WHEN heavy IS NULL OR 3 * source_size / weight <= CAST(remains AS DOUBLE) / heavy THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(remains AS DOUBLE) * weight / heavy END AS target
  FROM sources LEFT JOIN share ON true),
parts AS (
  SELECT s.source, s.code, target, source_size, least(3, floor(target / greatest(source_size, 1))) AS whole, sum(size) AS words
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source GROUP BY ALL),
running AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY code) AS upto, target - whole * source_size AS rest FROM parts),
ends AS (
  SELECT *, coalesce(lag(upto > rest) OVER (PARTITION BY source ORDER BY code), false) AS over,
         lead(code) OVER (PARTITION BY source ORDER BY code) IS NULL AS final FROM running),
chosen AS (
  SELECT source, code, whole, target, source_size,
         CASE WHEN over THEN 0 WHEN upto > rest OR final THEN CAST(words <= 2 * (rest - (upto - words)) AS INT) ELSE 1 END AS extra
  FROM ends)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(size * (whole + extra) AS BIGINT) AS taken
FROM sizes s JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source AND s.code = c.code
"""


@query("op5_mixing", _MIX_SQL)
def op5_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


_LEAK_SQL = r"""
WITH items AS (
  SELECT min(item_id) AS item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS words
  FROM benchmark WHERE text IS NOT NULL GROUP BY text),
sized AS (SELECT item_id, words, len(words) AS n FROM items WHERE len(words) >= 5),
places AS (SELECT item_id, n, unnest(generate_series(0, n - 5)) AS place, words FROM sized),
shingles AS (SELECT item_id, n, place, array_to_string(words[place + 1:place + 5], ' ') AS shingle FROM places),
texts AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS words FROM documents WHERE text IS NOT NULL),
spots AS (SELECT doc_id, len(words) AS size, unnest(generate_series(0, len(words) - 5)) AS spot, words FROM texts WHERE len(words) >= 5),
marks AS (SELECT doc_id, size, spot, array_to_string(words[spot + 1:spot + 5], ' ') AS shingle FROM spots),
windows AS (SELECT DISTINCT doc_id, item_id, n, size, greatest(0, least(spot - place, size - n)) AS start FROM marks JOIN shingles USING (shingle)),
held AS (
  SELECT w.doc_id, item_id, start, shingle, count(*) AS n FROM windows w JOIN marks m ON w.doc_id = m.doc_id AND spot BETWEEN start AND start + w.n - 5 GROUP BY ALL),
wanted AS (SELECT item_id, shingle, count(*) AS n FROM shingles GROUP BY ALL),
compared AS (
  SELECT h.doc_id, h.item_id, h.start, sum(least(h.n, coalesce(w.n, 0))) AS shared, sum(h.n) AS own
  FROM held h LEFT JOIN wanted w ON h.item_id = w.item_id AND h.shingle = w.shingle GROUP BY ALL),
valued AS (SELECT doc_id, item_id, shared / (own + s.n - 4 - shared) AS similarity FROM compared JOIN sized s USING (item_id))
SELECT doc_id, item_id, max(similarity) AS similarity FROM valued WHERE similarity >= 0.8 GROUP BY ALL
"""


@query("op6_decontaminate", _LEAK_SQL)
def op6_decontaminate(spark, sf_dir):
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity")


@query("op7_language_id")
def op7_language_id(spark, sf_dir):
    learn = F.coalesce(crc32_modulo(F.col("doc_id"), 4) != 2, F.lit(False))
    return language_id.identify(table(spark, sf_dir, "documents"), learn)


_LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents WHERE text IS NOT NULL),
normal AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM lines),
distinct_lines AS (
  SELECT words, len(words) AS n, min(struct_pack(d := doc_id, p := place)) AS first FROM normal WHERE len(words) >= 1 GROUP BY words),
cut AS (
  SELECT first, n - 1 AS n, i, array_to_string(words[1:i - 1], ' ') || chr(10) || array_to_string(words[i + 1:], ' ') AS rest
  FROM (SELECT first, n, words, unnest(generate_series(1, n)) AS i FROM distinct_lines WHERE n >= 5)
  UNION ALL
  SELECT first, n, i, array_to_string(words[1:i - 1], ' ') || chr(10) || array_to_string(words[i:], ' ')
  FROM (SELECT first, n, words, unnest(generate_series(1, n + 1)) AS i FROM distinct_lines WHERE n >= 5)),
keyed AS (SELECT first, md5_number(n || '|' || i || '|' || rest) AS variant FROM cut),
later AS (SELECT first, min(first) OVER (PARTITION BY variant) AS earliest FROM keyed),
near AS (SELECT DISTINCT first FROM later WHERE earliest < first),
judged AS (
  SELECT l.doc_id, l.place, l.line,
         coalesce(d.first <> struct_pack(d := l.doc_id, p := l.place) OR near.first IS NOT NULL, false) AS gone
  FROM normal l LEFT JOIN distinct_lines d ON l.words = d.words LEFT JOIN near ON near.first = d.first),
kept AS (
  SELECT doc_id, count(*) AS n_lines, sum(CAST(gone AS INT)) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text FROM judged GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS INT) AS n_lines, CAST(coalesce(n_removed, 0) AS INT) AS n_removed,
       CASE WHEN documents.text IS NOT NULL THEN sha256(kept.text) END AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""


@query("op8_line_dedup", _LINE_SQL)
def op8_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op9_repeated_spans")
def op9_repeated_spans(spark, sf_dir):
    left = repeated_spans.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


_URL_SQL = r"""
WITH RECURSIVE base AS (
  SELECT page_id, url, coalesce(html, '') AS html,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1) AS tail
  FROM pages),
tags AS (
  SELECT url, host || tail AS a, unnest(regexp_extract_all(html, '(?is)<link\s[^>]*rel\s*=\s*["'']?canonical["''\s/>][^>]*')) AS tag FROM base WHERE host <> ''
  UNION ALL
  SELECT url, host || tail, unnest(regexp_extract_all(html, '(?is)<meta\s[^>]*http-equiv\s*=\s*["'']?refresh["''\s/>][^>]*')) FROM base WHERE host <> ''),
links AS (
  SELECT url, a, replace(CASE WHEN lower(tag[1:5]) = '<link' THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''\s>]+)', 1)
         ELSE regexp_extract(tag, '(?is)\scontent\s*=\s*["'']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*["'']?([^"''\s>]+)', 1) END, '&amp;', '&') AS link FROM tags),
pieces AS (
  SELECT *, regexp_extract(url, '(?s)^.*?://[^/?#]*') AS root, regexp_extract(url, '(?s)^.*?://[^?#]*') AS page,
         regexp_extract(url, '(?s)^.*?://[^/?#]*((?:[^?#]*/)?)', 1) AS folder,
         regexp_extract(link, '(?s)^[^?#]*') AS own, regexp_extract(link, '(?s)^[^?#]*(.*)', 1) AS tail FROM links),
merged AS (
  SELECT *, CASE WHEN starts_with(own, '/') THEN own WHEN folder = '' THEN '/' || own ELSE folder || own END AS path FROM pieces),
walked AS (  -- dot segments resolved one by one, none above the root
  SELECT * EXCLUDE (path), CASE WHEN regexp_matches(path, '(?s)/\.\.?(?:/|\z)') THEN
    list_reduce(list_prepend('', string_split(path, '/')[2:]), lambda kept, s: CASE WHEN s = '.' THEN kept WHEN s = '..' THEN regexp_replace(kept, '/[^/]*$', '') ELSE kept || '/' || s END)
      || CASE WHEN regexp_matches(path, '(?s)/\.\.?\z') THEN '/' ELSE '' END ELSE path END AS path FROM merged),
absolute AS (
  SELECT a, CASE WHEN link = '' THEN NULL WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN starts_with(link, '//') THEN 'http:' || link WHEN starts_with(link, '#') THEN url
    WHEN starts_with(link, '?') THEN page || link ELSE root || path || tail END AS link FROM walked),
edges AS (
  SELECT a, translate(regexp_extract(link, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(link, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS b
  FROM absolute WHERE regexp_extract(link, '(?s)^.*?://([^/?#]*)', 1) <> ''),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
addresses AS (
  SELECT host || tail AS address, host, path FROM base WHERE host <> ''
  UNION SELECT a, regexp_extract(a, '^[^/?#]*'), regexp_extract(a, '^[^/?#]*([^?#]*)', 1) FROM both_ways),
ruled AS (
  SELECT address, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM addresses JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY address),
reached(address) AS (
  SELECT address FROM ruled WHERE verdict = 'block' AND address IN (SELECT a FROM both_ways)
  UNION SELECT b FROM reached JOIN both_ways ON address = a)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN r.address IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM base LEFT JOIN ruled ON ruled.address = host || tail LEFT JOIN reached r ON host <> '' AND r.address = host || tail
"""


@query("op10_url_filter", _URL_SQL)
def op10_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


_RESAMPLE_SQL = r"""
WITH crc AS (  -- the 256 entries of the crc32 table, by its rule
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS entries),
sides AS (
  SELECT true AS source, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL
  SELECT false, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
used AS (SELECT source, doc_id, unnest(words) AS word FROM sides),
spelt AS (SELECT word, hex(word) AS h FROM (SELECT DISTINCT word FROM used)),
coded AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
    lambda c, b: xor(entries[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket FROM spelt, crc),
met AS (
  SELECT bucket, count(*) FILTER (source) AS s, count(*) FILTER (NOT source) AS t FROM used JOIN coded USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * ((SELECT sum(s) FROM met) + 10000) / (CAST(s + 1 AS DOUBLE) * ((SELECT sum(t) FROM met) + 10000)))) AS BIGINT) AS gain FROM met),
heavy AS (SELECT doc_id, sum(gain) AS total FROM used JOIN coded USING (word) JOIN gain USING (bucket) WHERE source GROUP BY doc_id),
weights AS (
  SELECT doc_id, coalesce(len(words), 0) AS n_features,
         CASE WHEN coalesce(len(words), 0) = 0 THEN 0 ELSE CAST(floor(CAST(total AS DOUBLE) / len(words)) AS BIGINT) END AS weight,
         CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) AS h
  FROM sides LEFT JOIN heavy USING (doc_id) WHERE source),
scores AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weights),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scores LEFT JOIN ranked USING (doc_id)
"""


@query("op11_resampling", _RESAMPLE_SQL)
def op11_resampling(spark, sf_dir):
    scored = resampling.weighed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return resampling.drawn(scored).select("row.doc_id", "n_features", "weight", "score", "rank")


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns after the damage that crc32 of their place in the conversation deals out: nulls count as one space."""
    space = F.lit(" ")
    place = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(place.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    hurt = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), hurt.alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 0, F.array()).when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).drop("copy", "kind")


@query("op12_conversation_repair")
def op12_conversation_repair(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    return conversation_repair.audits(damaged(given), given)


@query("op13_token_files")
def op13_token_files(spark, sf_dir):
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.checksums(token_files.read(spark, path))
