"""One registered query for each operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe, decontaminate, extraction, fim, jaccard, licenses, resample, sharding, simhash, topk, toxicity, urlfilter, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 16
RANK_FILE = "byte_bpe_50k.tiktoken"


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say the same, its oracle."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", sharding.text_size(F.col("text")).alias("size"), sharding.text_crc32(F.col("text")).alias("text_crc32")
    )
    assigned = sharding.assign(rows, "doc_id", [1.0] * SHARDS, grown_shard="grown_shard")
    return sharding.number_slots(assigned.withColumn("law", F.lit("key")))


@query("op2_decontamination")
def op2_decontamination(spark, sf_dir):
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_extraction")
def op3_extraction(spark, sf_dir):
    return extraction.extract(table(spark, sf_dir, "pages"))


def host_code(host: Column) -> Column:
    """A number below 4096 that stands for a host."""
    return F.conv(F.substring(F.md5(host.cast("binary")), 1, 3), 16, 10).cast("int")


def page_captures(pages: DataFrame, step: int) -> DataFrame:
    """Every page as a capture of the year 2024, at a second that its id decides."""
    second = F.lit(1_704_067_200) + F.pmod(F.col("page_id") * F.lit(step), F.lit(31_536_000))
    return pages.withColumn("fetched_at", F.timestamp_seconds(second))


def host_list(pages: DataFrame) -> DataFrame:
    """Dated list entries for the hosts of the pages: some hosts, some of their English parts, some parent
    domains are added, removed after a time that the host decides, and half of them added again."""
    hosts = pages.select(extraction.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    coded = hosts.withColumn("code", host_code(F.col("host")))
    listed = [
        coded.where("code % 3 = 0").select("host", "code", F.expr("elt(1 + (code div 3) % 3, 'adult', 'malware', 'spam')")),
        coded.where("code % 5 = 0").select(F.concat("host", F.lit("/en")), "code", F.lit("spam")),
        coded.where("code % 11 = 0").select(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), "code", F.lit("bulk")),
    ]
    entries = reduce(DataFrame.union, listed).toDF("pattern", "code", "category")
    days = F.array(
        F.struct(F.lit("add").alias("action"), F.expr("code % 200").alias("day")),
        F.struct(F.lit("remove").alias("action"), F.expr("code % 200 + 30 + code % 60").alias("day")),
        F.when(F.col("code") % 2 == 0, F.struct(F.lit("add").alias("action"), F.expr("code % 200 + 75 + code % 60").alias("day"))),
    )
    dated = entries.select("pattern", "category", F.explode(days).alias("e")).where("e is not null")
    return dated.select("pattern", "category", "e.action", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("e.day") * 86_400).alias("at"))


OP4 = r"""
WITH capture AS (
  SELECT page_id, url, 1704067200 + (page_id * 7919) % 31536000 AS fetched_at,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
coded AS (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 3))::INT AS code FROM capture WHERE host <> ''),
entry AS (
  SELECT host AS host, '' AS prefix, code, ['adult', 'malware', 'spam'][1 + (code // 3) % 3] AS category FROM coded WHERE code % 3 = 0
  UNION ALL SELECT host, '/en', code, 'spam' FROM coded WHERE code % 5 = 0
  UNION ALL SELECT regexp_extract(host, '([^.]+\.[^.]+)$', 1), '', code, 'bulk' FROM coded WHERE code % 11 = 0),
change AS (
  SELECT host, prefix, category, 'add' AS action, 1704067200 + (code % 200) * 86400 AS at FROM entry
  UNION ALL SELECT host, prefix, category, 'remove', 1704067200 + (code % 200 + 30 + code % 60) * 86400 FROM entry
  UNION ALL SELECT host, prefix, category, 'add', 1704067200 + (code % 200 + 75 + code % 60) * 86400 FROM entry WHERE code % 2 = 0),
last_change AS (
  SELECT c.page_id, c.url, c.fetched_at, h.category, h.host || h.prefix AS pattern, arg_max(h.action, (h.at, h.action)) AS action
  FROM capture c JOIN change h
    ON (c.host = h.host OR ends_with(c.host, '.' || h.host))
   AND (h.prefix = '' OR c.path = h.prefix OR starts_with(c.path, h.prefix || '/')) AND h.at <= c.fetched_at
  GROUP BY ALL),
active AS (
  SELECT page_id, url, fetched_at, string_agg(DISTINCT category, ',' ORDER BY category) AS categories,
         string_agg(DISTINCT pattern, ',' ORDER BY pattern) AS patterns
  FROM last_change WHERE action = 'add' GROUP BY ALL)
SELECT c.page_id, c.url, c.fetched_at, count(*) AS captures, max(a.page_id) IS NULL AS allowed,
       coalesce(max(a.categories), '') AS categories, coalesce(max(a.patterns), '') AS patterns
FROM capture c LEFT JOIN active a ON a.page_id = c.page_id AND a.url = c.url AND a.fetched_at = c.fetched_at
GROUP BY c.page_id, c.url, c.fetched_at"""


@query("op4_url_filters", OP4)
def op4_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    judged = urlfilter.evaluate(page_captures(pages.select("page_id", "url"), 7919), host_list(pages))
    return judged.withColumn("fetched_at", F.unix_seconds("fetched_at"))


def token_digests(documents: DataFrame, coder: bpe.ByteBpe) -> DataFrame:
    """Per document: its ids, how many there are, and digests of the ids and of the bytes they stand for."""
    coded = coder.encode(documents.select("doc_id", "text"), decoded="decoded")
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "ids",
    )


@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir):
    coder = bpe.ByteBpe(bpe.path_of(RANK_FILE))
    return token_digests(table(spark, sf_dir, "documents"), coder).drop("ids")


OP6 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5"""


@query("op6_top_k", OP6)
def op6_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def sql_texts(pairs) -> str:
    return ", ".join("(" + ", ".join("'" + t.replace("'", "''") + "'" for t in pair) + ")" for pair in pairs)


OP7 = f"""
WITH template(license, words) AS (
  SELECT license, string_split(trim(regexp_replace(lower(template), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')
  FROM (VALUES {sql_texts(licenses.TEMPLATES)}) AS t(license, template)),
template_set AS (
  SELECT license, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS t FROM template),
unit AS (
  SELECT doc_id, 0 AS line, text AS unit FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1))::INT, unnest(string_split(text, chr(10)))
  FROM documents WHERE text IS NOT NULL),
worded AS (
  SELECT doc_id, line, string_split(trim(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS words FROM unit),
unit_set AS (
  SELECT doc_id, line, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS u
  FROM worded WHERE len(words) > 1),
judged AS (
  SELECT DISTINCT doc_id, line, license, len(u)::INT AS unit_size, len(t)::INT AS template_size, len(list_intersect(u, t))::INT AS common,
         round(2.0::DOUBLE * len(list_intersect(u, t)) / (len(u) + len(t)), 9) AS dice
  FROM unit_set JOIN template_set ON len(u) <= 1.5 * len(t) AND len(t) <= 1.5 * len(u)),
unit_match AS (
  SELECT * FROM judged WHERE dice >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license) = 1),
text_words AS (SELECT doc_id, words FROM worded WHERE line = 0 AND len(words) > 1),
place AS (SELECT doc_id, unnest(range(1, len(words)))::BIGINT AS pos, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS b FROM text_words),
template_bigram AS (SELECT license, len(t) AS n, unnest(t) AS b FROM template_set),
hit AS (SELECT doc_id, license, n, pos, b, lag(pos) OVER (PARTITION BY doc_id, license, b ORDER BY pos) AS before FROM place JOIN template_bigram USING (b)),
new_hit AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY pos) AS k FROM hit WHERE before IS NULL OR pos - before > 1.5 * n),
weighed AS (
  SELECT *, min((2000 * (k - 1) - 800 * (pos - 1), -pos)) OVER (PARTITION BY doc_id, license ORDER BY pos ROWS UNBOUNDED PRECEDING) AS least FROM new_hit),
run AS (
  SELECT doc_id, license, n, -least[2] AS first_word, pos + least[2] + 2 AS n_words FROM weighed WHERE 2000 * k - 800 * pos - least[1] >= 800 * n
  QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY 2000 * k - 800 * pos - least[1] DESC, pos) = 1),
run_set AS (
  SELECT run.*, t, list_distinct(list_transform(range(first_word, first_word + n_words - 1), lambda i: words[i] || ' ' || words[i + 1])) AS u
  FROM run JOIN text_words USING (doc_id) JOIN template_set USING (license)),
run_match AS (
  SELECT doc_id, license, first_word, n_words, len(u)::INT AS unit_size, len(t)::INT AS template_size, len(list_intersect(u, t))::INT AS common,
         round(2.0::DOUBLE * len(list_intersect(u, t)) / (len(u) + len(t)), 9) AS dice FROM run_set),
run_best AS (
  SELECT * FROM run_match r WHERE dice >= 0.8 AND NOT EXISTS (
    SELECT 1 FROM run_match o WHERE o.doc_id = r.doc_id AND o.dice >= 0.8 AND r.first_word < o.first_word + o.n_words AND o.first_word < r.first_word + r.n_words
      AND (-o.dice, -o.n_words, o.license) < (-r.dice, -r.n_words, r.license)))
SELECT doc_id, line, license, unit_size, template_size, common, dice, NULL::BIGINT AS first_word, NULL::BIGINT AS n_words FROM unit_match
UNION ALL
SELECT doc_id, NULL, license, unit_size, template_size, common, dice, first_word::BIGINT, n_words::BIGINT FROM run_best r
WHERE NOT EXISTS (SELECT 1 FROM unit_match m WHERE m.doc_id = r.doc_id AND m.license = r.license)"""


@query("op7_licenses", OP7)
def op7_licenses(spark, sf_dir):
    found = licenses.licenses(table(spark, sf_dir, "documents")).drop("text_hash")
    return found.withColumns({c: F.col(c).cast("long") for c in ("first_word", "n_words")})


@query("op8_simhash")
def op8_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def archive_records(pages: DataFrame) -> DataFrame:
    """Every page as an archive record: a third of them not-modified answers without a body, entity tags that
    change every 90 days and are missing on every seventh record."""
    timed = page_captures(pages, 104_729)
    revisit = F.col("page_id") % 3 == 1
    version = F.expr("unix_seconds(fetched_at) div 7776000").cast("string")
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.concat(warc.canonical_url(F.col("url")), version).cast("binary")), 1, 8), F.lit('"'))
    headers = F.create_map(
        F.lit("ETag"), F.when(F.col("page_id") % 7 != 0, tag),
        F.lit("Date"), F.unix_seconds("fetched_at").cast("string"),
        F.lit("Content-Length"), F.when(revisit, "0").otherwise(F.coalesce(F.octet_length("html"), F.lit(0)).cast("string")),
        F.lit("Content-Type"), F.when(~revisit, "text/html"),
        F.lit("Cache-Control"), F.concat(F.lit("max-age="), (F.col("page_id") % 1000).cast("string")),
    )
    return timed.select("page_id", "url", "fetched_at", F.when(revisit, 304).otherwise(200).alias("status"), headers.alias("headers"))


OP9 = r"""
WITH parted AS (
  SELECT page_id, html, regexp_replace(url, '#.*$', '') AS plain, 1704067200 + (page_id * 104729) % 31536000 AS t FROM pages),
canonical AS (
  SELECT page_id, html, t,
         regexp_replace(lower(regexp_extract(plain, '^[a-z]+://([^/?]*)', 1)), '^www[0-9]*\.', '') AS host,
         regexp_replace(regexp_extract(plain, '^[a-z]+://[^/?]*([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(plain, '\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^((ref|fbclid|gclid|msclkid|sessionid|sid)(=|$)|utm_)'))), '&') AS query
  FROM parted),
record AS (
  SELECT page_id, t, strlen(html) AS size, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS u
  FROM canonical),
tagged AS (
  SELECT *, CASE WHEN page_id % 7 <> 0 THEN '"' || substr(md5(u || (t // 7776000)), 1, 8) || '"' END AS etag FROM record),
stored AS (
  SELECT * FROM tagged WHERE page_id % 3 <> 1 QUALIFY row_number() OVER (PARTITION BY u, t ORDER BY page_id DESC) = 1),
joined AS (
  SELECT r.page_id, r.u AS canonical_url, r.t AS fetched_at, s.page_id AS refers_to, r.etag AS new_tag, s.etag AS old_tag, s.size
  FROM (SELECT * FROM tagged WHERE page_id % 3 = 1) r ASOF LEFT JOIN stored s ON r.u = s.u AND r.t > s.t),
judged AS (
  SELECT *, CASE WHEN refers_to IS NULL THEN 'no_original' WHEN new_tag IS NULL OR old_tag IS NULL THEN 'unverified'
                 WHEN new_tag = old_tag THEN 'resolved' ELSE 'mismatch' END AS state FROM joined)
SELECT page_id, canonical_url, fetched_at, refers_to, state,
       CASE WHEN state = 'resolved' THEN
         'cache-control: max-age=' || (page_id % 1000) || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html'
         || chr(10) || 'date: ' || fetched_at || chr(10) || 'etag: ' || new_tag END AS headers
FROM judged"""


@query("op9_warc_revisits", OP9)
def op9_warc_revisits(spark, sf_dir):
    found = warc.resolve(archive_records(table(spark, sf_dir, "pages")))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(F.array_sort(lines), "\n")).withColumn("fetched_at", F.unix_seconds("fetched_at"))


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    return toxicity.score_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11 = r"""
WITH unit AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || doc_id) AS h FROM documents),
drawn AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90
              THEN 'plain' WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM unit),
cut AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b FROM drawn),
part AS (
  SELECT *, array_to_string(list_slice(u, 1, a), '') AS prefix, array_to_string(list_slice(u, a + 1, b), '') AS middle,
         array_to_string(list_slice(u, b + 1, n), '') AS suffix
  FROM (SELECT *, regexp_extract_all(t, '(?s:.)') AS u FROM cut)),
written AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM part)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(output) AS output_sha256, sha256(t) AS restored_sha256
FROM written"""


@query("op11_fill_in_middle", OP11)
def op11_fill_in_middle(spark, sf_dir):
    made = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"))


#: The check sum of a word's bytes by its rule: a table of 256 steps, then byte by byte.
OP12 = r"""
WITH step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS of_byte),
worded AS (
  SELECT doc_id, 'd' AS side, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL
  SELECT item_id, 'b', regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
counted AS (SELECT doc_id, side, word, count(*) AS n FROM (SELECT doc_id, side, unnest(words) AS word FROM worded) GROUP BY ALL),
numbered AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(hex(encode(word))) // 2),
           lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, of_byte[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM counted), step),
filled AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
  FROM counted JOIN numbered USING (word) GROUP BY bucket),
whole AS (SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM filled),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain FROM filled, whole),
weighed AS (
  SELECT doc_id, sum(n * gain)::BIGINT AS weight FROM counted JOIN numbered USING (word) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id),
scored AS (
  SELECT w.doc_id, len(w.words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || w.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM worded w LEFT JOIN weighed USING (doc_id) WHERE side = 'd'),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fit FROM scored WHERE n_features >= 20)
SELECT scored.*, CASE WHEN place <= 10 * fit // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)"""


@query("op12_importance_resampling", OP12)
def op12_importance_resampling(spark, sf_dir):
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


OP13 = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM worded),
element AS (SELECT doc_id, len(g) AS n, unnest(g) AS e FROM grams),
link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM element a JOIN element b ON a.e = b.e AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON reach.y = both_ways.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id FROM grams JOIN least ON x = doc_id"""


@query("op13_ngram_jaccard", OP13)
def op13_ngram_jaccard(spark, sf_dir):
    return jaccard.join_components(table(spark, sf_dir, "documents"))
