"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import alignment, best_fit, bpe, embedding, html_layout, lexical, minhash, packing, pii, quality, quotes, urls, warc
from tidepool.llm.common import table

QUERIES: dict = {}
ORACLE: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         F.round("posterior", 6).alias("posterior"))


@query
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


ORACLE["op3_minhash"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.a = d.doc_id
"""


@query
def op4_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE["op4_embedding"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: c::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN lowest ON lowest.a = e.vec_id LEFT JOIN counted ON counted.a = e.vec_id
"""


@query
def op5_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link(table(spark, sf_dir, "conversations"))


ORACLE["op5_quotes"] = r"""
WITH RECURSIVE split AS (
  SELECT conv_id, turn, role, regexp_split_to_array(text, '\r?\n') AS ls FROM conversations),
lines AS (SELECT conv_id, turn, unnest(ls) AS line FROM split),
parts AS (
  SELECT conv_id, turn, length(regexp_replace(regexp_extract(line, '^[ \t]*>(?:[ \t]*>)*'), '[^>]', '', 'g')) AS depth,
    lower(trim(regexp_replace(regexp_replace(line, '^[ \t]*>(?:[ \t]*>)*', ''), '[ \t]+', ' ', 'g'), ' ')) AS plain FROM lines),
quoted AS (SELECT conv_id, turn, depth, plain, count(*) AS times FROM parts WHERE depth > 0 AND plain <> '' GROUP BY ALL),
wrote AS (SELECT conv_id, plain, min(turn) AS origin FROM parts WHERE depth = 0 AND plain <> '' GROUP BY ALL),
found AS (SELECT q.*, origin FROM quoted q JOIN wrote w ON q.conv_id = w.conv_id AND q.plain = w.plain WHERE origin < turn),
linked AS (SELECT conv_id, turn, sum(times)::BIGINT AS n_linked FROM found GROUP BY ALL),
weights AS (SELECT conv_id, turn, origin, sum(length(plain) * times) AS weight FROM found WHERE depth = 1 GROUP BY ALL),
answers AS (
  SELECT conv_id, turn, origin AS parent_turn FROM weights
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY weight DESC, origin DESC) = 1),
chain AS (
  SELECT conv_id, turn, parent_turn AS up, 1 AS steps FROM answers
  UNION ALL SELECT c.conv_id, c.turn, a.parent_turn, steps + 1 FROM chain c JOIN answers a ON a.conv_id = c.conv_id AND a.turn = c.up),
roots AS (SELECT conv_id, turn, arg_max(up, steps) AS thread_root, max(steps) AS reply_depth FROM chain GROUP BY ALL)
SELECT s.conv_id, s.turn, role, parent_turn, coalesce(thread_root, s.turn) AS thread_root, coalesce(reply_depth, 0)::BIGINT AS reply_depth,
  coalesce(len(list_filter(ls, lambda x: regexp_matches(x, '^[ \t]*>'))), 0)::BIGINT AS n_quoted,
  coalesce(list_max(list_transform(ls, lambda x: length(regexp_replace(regexp_extract(x, '^[ \t]*>(?:[ \t]*>)*'), '[^>]', '', 'g')))), 0)::BIGINT AS max_depth,
  coalesce(n_linked, 0) AS n_linked,
  array_to_string(list_filter(ls, lambda x, i: NOT regexp_matches(x, '^[ \t]*>') AND NOT (
    regexp_matches(x, '^[ \t]*(?:On .* wrote:|Am .* schrieb .*:|Le .* a écrit ?:|El .* escribió:)[ \t]*$')
    AND coalesce(regexp_matches(ls[i + 1], '^[ \t]*>'), false))), chr(10)) AS body
FROM split s LEFT JOIN answers a ON a.conv_id = s.conv_id AND a.turn = s.turn
LEFT JOIN roots r ON r.conv_id = s.conv_id AND r.turn = s.turn LEFT JOIN linked l ON l.conv_id = s.conv_id AND l.turn = s.turn
"""


@query
def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(table(spark, sf_dir, "pages"))


URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


@query
def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a label row and a page of one number are taken as one item; low quality or toxicity is the bad outcome
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.expr("quality = 0 or toxic = 1").alias("bad"))
    return urls.judge(table(spark, sf_dir, "pages"), labels, URL_RULES)


ORACLE["op7_urls"] = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
named AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
outcome AS (
  SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS b FROM named LEFT JOIN outcome ON page_id = doc_id GROUP BY host),
parts AS (SELECT *, string_split(host, '.') AS p FROM counted),
rules AS (SELECT unnest([SUFFIX_RULES]) AS fit),
tails AS (SELECT host, p, unnest(generate_series(1, len(p))) AS k FROM parts),
fitting AS (
  SELECT host, coalesce(max(k - 1) FILTER (fit[1] = '!'), max(k)) AS size FROM tails
  JOIN rules ON fit = array_to_string(p[-k:], '.') OR fit = '!' || array_to_string(p[-k:], '.')
    OR k > 1 AND fit = '*.' || array_to_string(p[-(k - 1):], '.') GROUP BY host),
hosts AS (
  SELECT parts.host, n, b, array_to_string(p[-coalesce(size, 1):], '.') AS suffix, array_to_string(p[-(coalesce(size, 1) + 1):], '.') AS domain
  FROM parts LEFT JOIN fitting ON parts.host = fitting.host),
seen AS (SELECT * FROM hosts WHERE n > 0),
domains AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(b)::BIGINT AS b FROM seen GROUP BY ALL),
tops AS (SELECT suffix, sum(n)::BIGINT AS n, sum(b)::BIGINT AS b FROM seen GROUP BY ALL),
root AS (SELECT (coalesce(sum(b), 0) + 1)::DOUBLE / (coalesce(sum(n), 0) + 2) AS m FROM seen),
levels AS (
  SELECT 'host' AS level, n, b FROM seen UNION ALL SELECT 'domain', n, b FROM domains UNION ALL SELECT 'top', n, b FROM tops),
sums AS (
  SELECT level, count(*) AS k, sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS nn, sum(b)::DOUBLE / sum(n)::DOUBLE AS m,
    sum((b * b / n)::DECIMAL(28, 12))::DOUBLE AS q FROM levels GROUP BY level),
spreads AS (SELECT *, q - m * m * n - (k - 1) * m * (1 - m) AS spread, n - nn / n AS room FROM sums),
strengths AS (
  SELECT level, CASE WHEN room <= 0 OR spread <= 0 OR m <= 0 OR m >= 1 THEN 1000.0
    ELSE least(1000.0::DOUBLE, greatest(1.0::DOUBLE, m * (1 - m) / (spread / room) - 1)) END::DOUBLE AS s FROM spreads),
s AS (
  SELECT coalesce(max(s) FILTER (level = 'top'), 1000.0)::DOUBLE AS st, coalesce(max(s) FILTER (level = 'domain'), 1000.0)::DOUBLE AS sd,
    coalesce(max(s) FILTER (level = 'host'), 1000.0)::DOUBLE AS sh FROM strengths),
tops2 AS (SELECT suffix, (b + st * m) / (n + st) AS top_mean FROM tops, s, root),
doms AS (
  SELECT h.host, h.n, h.b, sh,
    (coalesce(d.b, 0) + sd * coalesce(top_mean, m)) / (coalesce(d.n, 0) + sd) AS dm
  FROM hosts h LEFT JOIN tops2 USING (suffix) LEFT JOIN domains d ON d.domain = h.domain AND d.suffix = h.suffix, s, root),
ab AS (SELECT host, b + sh * dm AS alpha, n - b + sh * (1 - dm) AS beta FROM doms),
means AS (SELECT host, alpha / (alpha + beta) AS mean, alpha + beta AS size FROM ab),
bounds AS (SELECT host, mean, mean - 1.645::DOUBLE * sqrt(mean * (1 - mean) / (size + 1)) AS low FROM means),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM named)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN low > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  round(mean, 6) AS p_bad, round(low, 6) AS bound
FROM ruled JOIN bounds USING (host)
""".replace("SUFFIX_RULES", ", ".join(f"'{rule}'" for rule in urls.SUFFIXES))


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


CRAWL_DATE = "2024-01-01T00:00:00Z"  # pages carry no time of their own


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.build(table(spark, sf_dir, "pages"), CRAWL_DATE)


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *paths)[0]


@query
def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = best_fit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), 50)


ORACLE["op13_lexical"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
d AS (SELECT * FROM t WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS nd, sum(len(w))::BIGINT AS nl FROM d),
posts AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM posts GROUP BY term), totals),
items AS (
  SELECT DISTINCT q, item_id, unnest(
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM benchmark)),
scores AS (
  SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nl))))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN posts USING (term), totals GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""
