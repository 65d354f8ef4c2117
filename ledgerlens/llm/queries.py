"""One query per operator, with its DuckDB twin where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import chat, clusters, fingerprints, jaccard, lines, mixing, outliers, packing, pieces, records, suffixes, urls, whitening
from ledgerlens.llm.common import documents, new_folder, saved

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op10_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality(documents(spark, sf_dir)).select("doc_id", *outliers.COUNTS, "base_failed", "kept", "distance")


@query
def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", *pieces.digests(F.col("ids"), F.col("decoded")))


@query
def op3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = new_folder(spark, "records")
    index = records.write(documents(spark, sf_dir), tokenizer, folder, end_id=1)
    found = records.starts(records.read(index, folder, tokenizer), index)
    return found.select("doc_id", "start", (F.octet_length("payload") / 4).cast("long").alias("n_tokens"), F.crc32("payload").alias("ids_crc32"))


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


@query
def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", lines.host(F.col("url")).alias("host"), lines.html_lines(F.col("html")).alias("text"))
    # Pages are taken apart once, not for each of the two passes over their lines.
    left = lines.drop_boilerplate(saved(pages, "page-lines"), "host", "text")
    return left.select("page_id", "host", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


# An HTML page's lines, then each host's frequent ones; the patterns are those of lines.py.
ORACLES["op8_lines"] = rf"""
WITH flat AS (
  SELECT page_id, nullif(rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.'), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(html, '{lines.UNSEEN}', '', 'g'), '{lines.BLOCK}', chr(10), 'g'), '{lines.TAG}', '', 'g') AS t
  FROM pages),
decoded AS (SELECT page_id, host, replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS t FROM flat),
texts AS (SELECT page_id, host, trim(regexp_replace(t, '\s*\n\s*', chr(10), 'g'), chr(10) || ' ') AS t FROM decoded),
cut AS (
  SELECT page_id, host, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS n FROM texts),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS b FROM cut),
totals AS (SELECT host, count(*) AS pages FROM texts GROUP BY host),
common AS (
  SELECT host, b FROM bare JOIN totals USING (host) WHERE b <> '' GROUP BY host, b, pages
  HAVING count(DISTINCT page_id) >= {lines.LEAST} AND count(DISTINCT page_id) > {lines.RATIO} * pages),
marked AS (SELECT bare.*, common.b IS NOT NULL AS gone FROM bare LEFT JOIN common ON bare.host = common.host AND bare.b = common.b)
SELECT page_id, any_value(host) AS host, count(*) FILTER (b <> '') AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS text_sha256
FROM marked GROUP BY page_id"""


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = chat.whole(chat.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return rotated.select("conv_id", "participant", "n_turns", F.sha2("rendered", 256).alias("rendered_sha256"), spans.alias("spans"))


ORACLES["op5_chat"] = f"""
WITH t AS (
  SELECT conv_id, turn, replace(coalesce(role, '{chat.UNKNOWN}'), '<|im_', '<| im_') AS s, replace(coalesce(text, ''), '<|im_', '<| im_') AS x FROM conversations),
people AS (SELECT DISTINCT conv_id, s AS participant FROM t WHERE s <> '{chat.SYSTEM}'),
said AS (
  SELECT conv_id, participant, turn, s, x, s = participant AS own,
    '{chat.START}' || CASE WHEN s = participant THEN 'assistant' WHEN s = '{chat.SYSTEM}' THEN s ELSE 'user name=' || s END || chr(10) AS head, x || '{chat.END}' AS body
  FROM t JOIN people USING (conv_id)),
placed AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, participant ORDER BY turn, s, x ROWS UNBOUNDED PRECEDING) - length(body) - 1 AS begins FROM said)
SELECT conv_id, participant, count(*) AS n_turns, sha256(string_agg(head || body || chr(10), '' ORDER BY turn, s, x)) AS rendered_sha256,
  coalesce(string_agg(CASE WHEN own THEN CAST(begins AS BIGINT) || '-' || CAST(begins + length(body) AS BIGINT) END, ',' ORDER BY turn, s, x), '') AS spans
FROM placed GROUP BY conv_id, participant"""

# The table of pages has no fetch times and no lists: both follow from its rows. Page n is fetched n * 7919 minutes (modulo two
# years) after the epoch below. Hosts of the three advertising kinds are listed from a day on, taken off and listed again; every
# tenth address is listed for 200 days.
EPOCH = "2024-01-01 00:00:00"
LISTED = "casino|bets|pills"


@query
def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    day = lambda n: (F.lit(EPOCH).cast("timestamp") + F.make_dt_interval(n))
    minutes = F.pmod(F.col("page_id") * 7919, F.lit(2 * 365 * 24 * 60)).cast("int")
    captures = pages.withColumn("fetched_at", F.lit(EPOCH).cast("timestamp") + F.make_dt_interval(mins=minutes))
    hosts = pages.select(urls.host(F.col("url")).alias("value")).distinct().where(F.col("value").rlike(LISTED))
    length = F.length("value").cast("int")
    history = F.array(*[F.struct(day(length + F.lit(n)).alias("listed_at"), F.lit(a).alias("action")) for n, a in ((30, urls.ADD), (200, urls.REMOVE), (400, urls.ADD))])
    by_host = hosts.select(F.lit("host").alias("kind"), "value", F.lit("spam").alias("category"), F.explode(history).alias("h"))
    tenth = pages.where(F.pmod("page_id", F.lit(10)) == 3).select(urls.address(F.col("url")).alias("value"), F.pmod("page_id", F.lit(300)).cast("int").alias("n"))
    history = F.array(*[F.struct(day(F.col("n") + F.lit(n)).alias("listed_at"), F.lit(a).alias("action")) for n, a in ((0, urls.ADD), (200, urls.REMOVE))])
    by_url = tenth.select(F.lit("url").alias("kind"), "value", F.lit("takedown").alias("category"), F.explode(history).alias("h"))
    entries = by_host.union(by_url).select("kind", "value", "category", "h.listed_at", "h.action")
    return urls.judge(captures, urls.validity(entries)).select("page_id", "url", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), "blocked", "n_entries", "category")


ORACLES["op6_urls"] = rf"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '{EPOCH}' + to_minutes((page_id * 7919) % (2 * 365 * 24 * 60)) AS t,
    regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)', 1) AS rest FROM pages),
hosts AS (SELECT DISTINCT host AS value FROM captures WHERE regexp_matches(host, '{LISTED}')),
entries AS (
  SELECT 'host' AS kind, value, 'spam' AS category, TIMESTAMP '{EPOCH}' + to_days(CAST(length(value) + n AS INTEGER)) AS day, off
  FROM hosts, (VALUES (30, false), (200, true), (400, false)) v(n, off)
  UNION ALL
  SELECT 'url', host || rest, 'takedown', TIMESTAMP '{EPOCH}' + to_days(CAST(page_id % 300 + n AS INTEGER)), off
  FROM captures, (VALUES (0, false), (200, true)) v(n, off) WHERE page_id % 10 = 3),
dated AS (SELECT kind, value, category, day, bool_or(off) AS off FROM entries GROUP BY ALL),
changes AS (SELECT * FROM (SELECT *, lag(off, 1, true) OVER (PARTITION BY kind, value, category ORDER BY day) AS before FROM dated) WHERE before <> off),
valid AS (SELECT * FROM (SELECT *, coalesce(lead(day) OVER (PARTITION BY kind, value, category ORDER BY day), TIMESTAMP '9999-12-31 00:00:00') AS till FROM changes) WHERE NOT off),
by_host AS (SELECT page_id, v.category FROM captures c JOIN valid v ON v.kind = 'host' AND c.t >= v.day AND c.t < v.till AND (c.host = v.value OR ends_with(c.host, '.' || v.value))),
by_url AS (
  SELECT page_id, v.category FROM captures c JOIN valid v ON v.kind = 'url' AND c.t >= v.day AND c.t < v.till AND split_part(v.value, '/', 1) = c.host AND starts_with(c.host || c.rest, v.value)
    AND substr(c.host || c.rest, length(v.value) + 1, 1) IN ('', '/', '?')),
hits AS (SELECT page_id, count(*) AS n, min(category) AS category FROM (SELECT * FROM by_host UNION ALL SELECT * FROM by_url) GROUP BY page_id)
SELECT page_id, url, strftime(t, '%Y-%m-%d %H:%M:%S') AS fetched_at, n IS NOT NULL AS blocked, coalesce(n, 0) AS n_entries, category
FROM captures LEFT JOIN hits USING (page_id)"""


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.with_next_half(documents(spark, sf_dir))
    own, edited = fingerprints.fingerprint(F.col("text")), fingerprints.fingerprint(F.col("edited"))
    # Between the steps a fingerprint is binary, half as long as its hex form.
    both = saved(rows.select("doc_id", "next_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                             F.unhex(own).alias("own"), F.unhex(edited).alias("edited")), "fingerprints")
    after = both.groupBy(F.col("doc_id").alias("__id")).agg(F.min("own").alias("__next"))
    near = both.join(after, F.col("next_id") == F.col("__id"), "left")
    own, edited, next_ = (F.lower(F.hex(c)) for c in ("own", "edited", "__next"))
    return near.select("doc_id", "n_chars", "edited_sha256", own.alias("fingerprint"), edited.alias("edited_fingerprint"),
                       fingerprints.likeness(own, edited).alias("near_edited"), fingerprints.likeness(own, next_).alias("near_next"))


@query
def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove(documents(spark, sf_dir))
    return left.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


@query
def op11_ns_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _k_means_sql(dims: int = 64, k: int = 40, rounds: int = 5, scale: int = 256, seed: str = "2") -> str:
    """Plain k-means on whole numbers: every round compares every vector with every centroid."""
    kept = f"len(embedding) = {dims} AND list_aggregate(list_transform(embedding, lambda c: CASE WHEN isfinite(c) THEN 0 ELSE 1 END), 'sum') = 0 AND list_count(embedding) = {dims}"
    parts = [
        f"x AS MATERIALIZED (SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(floor({scale} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v FROM embeddings WHERE {kept})",
        f"""c0 AS MATERIALIZED (
  SELECT s.c, x.i, x.v FROM x JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM (SELECT DISTINCT vec_id FROM x) QUALIFY c < {k}) s USING (vec_id))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, c, d FROM (
    SELECT x.vec_id, m.c, sum((x.v - m.v) * (x.v - m.v)) AS d FROM x JOIN c{r} m USING (i) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if r < rounds:
            parts.append(f"""m{r} AS MATERIALIZED (
  SELECT c, i, (s - ((s % n) + n) % n) // n AS v FROM (SELECT c, i, sum(v) AS s, count(*) AS n FROM x JOIN a{r} USING (vec_id) GROUP BY ALL)),
c{r + 1} AS MATERIALIZED (SELECT c, i, CAST(coalesce(m{r}.v, c{r}.v) AS BIGINT) AS v FROM c{r} LEFT JOIN m{r} USING (c, i))""")
    return f"""WITH {", ".join(parts)},
shas AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN shas USING (c)"""


ORACLES["op11_ns_bounds"] = _k_means_sql()


@query
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    plan = packing.pack(cut)
    # Only the checksum of a piece's ids goes through the join.
    light = cut.select("row", "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"))
    return packing.place(light, plan)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
