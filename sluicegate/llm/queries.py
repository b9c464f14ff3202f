"""One query for each operator, with the SQL another engine answers it with where SQL can."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import functions as F

from ..registered.base import table
from ..session import scratch_dir
from . import alignment, decontaminate, frames, lm, mixing, packing, quality, ranking, simhash, tokens, topk, toxicity, urls
from .base import registered, removed_at_exit


@registered(r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
weighed AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST(list_extract([5, 2, 1], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)) AS BIGINT) AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS ceiling, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
    coalesce(sum(3 * source_size) OVER before, 0) AS full_before, coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM weighed
  WINDOW before AS (ORDER BY source_size * 3 * (10 // weight), source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (
  SELECT *, (total - full_before) * weight >= ceiling * (all_weight - weight_before) AS is_full FROM levels),
shared AS (
  SELECT *, sum(CASE WHEN is_full THEN ceiling ELSE 0 END) OVER () AS filled,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS open_weight
  FROM marked),
rated AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN CAST(ceiling AS DOUBLE)
         ELSE CAST(weight * (total - filled) AS DOUBLE) / CAST(open_weight AS DOUBLE) END AS target
  FROM shared),
drawn AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / CAST(source_size AS DOUBLE) ELSE 0 END AS rate,
    CAST(CAST('0x' || substr(md5('mix:#' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS chance
  FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM drawn
""")
def op5_mix_sources(spark, sf_dir):
    """Words each document gives to the mix of all sources."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


@registered()
def op8_simhash_near_duplicates(spark, sf_dir):
    """Fingerprints of four-word shingles, linked within four bits, and the least document each reaches."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, radius=4)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


#: Patterns of the SQL, written apart from the operator's.
_NAMES = r"([\p{L}\p{N},;][ \t]+)(\p{Lu}[-'\p{Ll}]+(?:[ \t]\p{Lu}[-'\p{Ll}]+)*)"
_NUMBERS = r"(\p{N}+(?:[:/.,]\p{N}+)*)"
_UNITS = (
    r"(\x02[/:.,\p{N}]+)[\t ]*(mm|cm|km|m|in|inch|inches|ft|foot|feet|yd|yards?|mi|miles?|mg|g|kg|t|oz|lb|ml|cl|l|ms|s|secs?|mins?|h|hrs?"
    r"|[kmgt]b|w|[km]w|v|a|hz|[kmg]hz|k?j|k?cal|seconds?|minutes?|hours?|days?|weeks?|months?|years?|meters?|metres?|kilometers?|kilometres?"
    r"|centimeters?|grams?|kilograms?|tons?|tonnes?|pounds?|ounces?|liters?|litres?|gallons?|degrees?|percent|dollars?|cents?|euros?|%|°)"
    r"([^\p{N}\p{L}]|$)"
)
_WORDS = r"\x01[- \t''\p{L}]+\x01|[\x02\x03]?[\p{N}\p{L}](?:[-\p{M}\p{N}\p{L}.,:/'']*[\p{M}\p{N}\p{L}])?|\x03[%°]"


def _tokens_sql(text: str) -> str:
    """The slot-marked words of a text in DuckDB."""
    named = f"regexp_replace(coalesce({text}, ''), '{_NAMES.replace(chr(39), chr(39) * 2)}', '\\1' || chr(1) || '\\2' || chr(1), 'g')"
    numbered = f"regexp_replace(lower({named}), '{_NUMBERS}', chr(2) || '\\1', 'g')"
    measured = f"regexp_replace({numbered}, '{_UNITS}', '\\1 ' || chr(3) || '\\2\\3', 'g')"
    return f"regexp_extract_all({measured}, '{_WORDS}')"


@registered(f"""
WITH document_words AS (
  SELECT DISTINCT doc_id, text, {_tokens_sql("text")} AS words FROM documents),
item_words AS (
  SELECT DISTINCT item_id, {_tokens_sql("text")} AS words FROM benchmark),
sizes AS (SELECT DISTINCT least(len(words), 8) AS size FROM item_words WHERE len(words) >= 4),
document_spans AS (
  SELECT doc_id, md5(text) AS body, size,
    unnest(list_transform(range(0, len(words) - size + 1), lambda i: {{'at': i, 'words': words[i + 1:i + size]}})) AS span
  FROM document_words JOIN sizes ON len(words) >= size),
item_spans AS (
  SELECT item_id, words, size,
    unnest(list_transform(range(0, len(words) - size + 1), lambda i: {{'at': i, 'words': words[i + 1:i + size]}})) AS span
  FROM item_words JOIN sizes ON size = least(len(words), 8)),
document_windows AS (
  SELECT doc_id, body, size, span.at AS at, list_filter(span.words, lambda t: t < chr(4)) AS slots,
    array_to_string(list_transform(span.words, lambda t: CASE WHEN t < chr(4) THEN substr(t, 1, 1) ELSE t END), ' ') AS template
  FROM document_spans),
item_windows AS (
  SELECT item_id, words, size, span.at AS at, list_filter(span.words, lambda t: t < chr(4)) AS slots,
    array_to_string(list_transform(span.words, lambda t: CASE WHEN t < chr(4) THEN substr(t, 1, 1) ELSE t END), ' ') AS template
  FROM item_spans),
aligned AS (
  SELECT d.doc_id, d.body, i.item_id, i.words, i.size, list(DISTINCT i.at) AS places,
    list_distinct(flatten(list(list_zip(i.slots, d.slots)))) AS pairs
  FROM document_windows d JOIN item_windows i ON d.template = i.template AND d.size = i.size
    AND (len(i.slots) <= 3 AND i.size = 8 OR i.slots = d.slots)
  GROUP BY d.doc_id, d.body, i.item_id, i.words, i.size, d.at - i.at),
consistent AS (
  SELECT *, list_distinct(flatten(list_transform(places, lambda p: range(p, p + size)))) AS covering FROM aligned
  WHERE len(pairs) = len(list_distinct(list_transform(pairs, lambda p: p[1])))),
covered AS (
  SELECT doc_id, body, item_id, words, pairs, len(covering) AS run, unnest(covering) AS word FROM consistent)
SELECT doc_id, item_id, CAST(len(words) AS INTEGER) AS item_words, CAST(count(DISTINCT word) AS INTEGER) AS words_covered,
  bool_or(len(list_filter(pairs, lambda p: p[1] <> p[2])) > 0) AS reworded
FROM covered GROUP BY doc_id, body, item_id, words HAVING count(DISTINCT word) >= len(words) * 0.5 OR max(run) >= 25
""")
def op10_benchmark_leaks(spark, sf_dir):
    """Benchmark items found in documents, also with other numbers, names or units in their slots."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


@registered()
def op9_token_id_shards(spark, sf_dir):
    """Every document's place, length and checksum, read back from shards of token ids."""
    folder = removed_at_exit(spark, scratch_dir(spark, "token-ids"))
    path = public_tokenizers.path("byte_bpe_50k.json")
    manifest = frames.write_token_ids(table(spark, sf_dir, "documents"), folder, path)
    return frames.scan_shards(manifest, frames.crc32).withColumnRenamed("value", "ids_crc32")


@registered()
def op2_token_counts(spark, sf_dir):
    """Tokens of every document under a word-level byte-pair vocabulary."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@registered()
def op4_quality_scores(spark, sf_dir):
    """Quality of every document by the quadratic discriminant."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered("""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""")
def op6_top_inner_products(spark, sf_dir):
    """The five vectors of largest integer inner product for every fiftieth vector, among all others."""
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_inner_products(vectors.filter("vec_id % 50 = 0"), vectors, k=5)


def captures(spark, sf_dir):
    """Pages with the time of their capture: an hour apart in order of page_id, as the pages carry no time."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 3600)
    return table(spark, sf_dir, "pages").select("page_id", "url", at.alias("fetched_at"))


def list_entries(spark, sf_dir):
    """A dated list made from the pages: a third of the hosts are blocked for a while and half of these again, and half of
    the sections of such hosts are allowed ten days after they were first seen."""
    seen = captures(spark, sf_dir).groupBy(
        urls.host_of(F.col("url")).alias("host"), F.regexp_extract(urls.path_of(F.col("url")), "^/([^/]+)", 1).alias("section")
    ).agg(F.min("fetched_at").alias("first"))
    days = "unix_seconds(first) + 86400 * "
    drawn = "conv(substr(md5({0}), 1, 6), 16, 10)"
    hosts = seen.filter("host IS NOT NULL").groupBy("host").agg(F.min("first").alias("first"))
    listed = hosts.withColumn("draw", F.expr(drawn.format("host")).cast("long")).filter("draw % 3 = 0")
    dated = listed.select(F.col("host").alias("pattern"), F.inline(F.expr(f"""array(
        struct('block' AS action, {days} (draw % 20) AS at), struct('remove' AS action, {days} (40 + draw % 100) AS at),
        struct(IF(draw % 2 = 0, 'block', 'remove') AS action, {days} 200 AS at))""")))  # fmt: skip
    sections = seen.filter("section <> ''").join(listed.select("host"), "host").withColumn("pattern", F.concat_ws("/", "host", "section"))
    allowed = sections.filter(F.expr(drawn.format("pattern")).cast("long") % 2 == 0)
    entries = dated.union(allowed.select("pattern", F.lit("allow").alias("action"), F.expr(f"{days} 10").alias("at")))
    return entries.withColumn("at", F.timestamp_seconds("at"))


@registered(r"""
WITH parsed AS (
  SELECT page_id, url, 1704067200 + page_id * 3600 AS ts,
    nullif(regexp_replace(regexp_replace(
      regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '^www[.]', ''), '[.]+$', ''), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages),
seen AS (
  SELECT host, regexp_extract(path, '^/([^/]+)', 1) AS section, min(ts) AS seen_at FROM parsed
  WHERE host IS NOT NULL GROUP BY ALL),
listed AS (
  SELECT * FROM (
    SELECT host, min(seen_at) AS seen_at, CAST('0x' || substr(md5(host), 1, 6) AS BIGINT) AS draw FROM seen GROUP BY host)
  WHERE draw % 3 = 0),
entries AS (
  SELECT host AS pattern, 'block' AS action, seen_at + 86400 * (draw % 20) AS ts FROM listed
  UNION ALL SELECT host, 'remove', seen_at + 86400 * (40 + draw % 100) FROM listed
  UNION ALL SELECT host, CASE WHEN draw % 2 = 0 THEN 'block' ELSE 'remove' END, seen_at + 86400 * 200 FROM listed
  UNION ALL SELECT seen.host || '/' || section, 'allow', seen.seen_at + 86400 * 10 FROM seen JOIN listed USING (host)
    WHERE section <> '' AND CAST('0x' || substr(md5(seen.host || '/' || section), 1, 6) AS BIGINT) % 2 = 0),
spans AS (
  SELECT pattern, action, ts AS valid_from, lead(ts) OVER (PARTITION BY pattern ORDER BY ts) AS valid_to
  FROM (SELECT pattern, ts, max(action) AS action FROM entries GROUP BY pattern, ts)),
pieces AS (
  SELECT page_id, url, ts, host, string_split(host, '.') AS labels,
    list_filter(string_split(path, '/'), lambda p: p <> '') AS parts
  FROM parsed),
looked AS (
  SELECT page_id, url, ts, unnest(list_distinct(list_concat(
    list_transform(range(1, greatest(len(labels) - 1, 1) + 1), lambda i: array_to_string(labels[i:], '.')),
    list_transform(range(1, least(len(parts), 3) + 1), lambda n: host || '/' || array_to_string(parts[1:n], '/'))))) AS pattern
  FROM pieces WHERE host IS NOT NULL),
met AS (
  SELECT page_id, l.ts, row(length(s.pattern), s.pattern, s.action, s.valid_from) AS entry
  FROM looked l JOIN spans s ON l.pattern = s.pattern AND s.action <> 'remove' AND l.ts >= s.valid_from
    AND (s.valid_to IS NULL OR l.ts < s.valid_to)),
best AS (SELECT page_id, max(entry) AS entry FROM met GROUP BY page_id)
SELECT p.page_id, CAST(p.ts AS BIGINT) AS fetched_at, coalesce(entry[3] = 'block', false) AS blocked, entry[2] AS pattern,
  entry[3] AS action, CAST(entry[4] AS BIGINT) AS valid_from
FROM parsed p LEFT JOIN best USING (page_id)
""")
def op3_url_filter(spark, sf_dir):
    """Every page, judged by the list as it was when the page was captured."""
    judged = urls.judge(captures(spark, sf_dir), list_entries(spark, sf_dir))
    seconds = {c: F.unix_seconds(c) for c in ("fetched_at", "valid_from")}
    return judged.drop("url").withColumns(seconds)


@registered()
def op7_cross_entropy_difference(spark, sf_dir):
    """How much more each document's words are like the benchmark's texts than like all documents."""
    docs = table(spark, sf_dir, "documents")
    target = table(spark, sf_dir, "benchmark").select("text")
    return lm.score_documents(docs, target, docs.select("text"), of_words=True, order=2)


@registered()
def op1_toxicity_scores(spark, sf_dir):
    """Toxicity of every document, by its most toxic window."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered()
def op12_pack_sequences(spark, sf_dir):
    """Where every document's ids lie in sequences of 4,096."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@registered(r"""
WITH held AS (
  SELECT doc_id, row_number() OVER () AS doc,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT query, item_id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT item_id, text, row_number() OVER () AS query FROM (SELECT DISTINCT item_id, text FROM benchmark))),
counted AS (SELECT doc, any_value(doc_id) AS doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM held GROUP BY doc, term),
sized AS (SELECT doc, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY doc),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized),
weighed AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counted, corpus GROUP BY term),
impacts AS (
  SELECT doc, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))) AS impact
  FROM counted JOIN sized USING (doc) JOIN weighed USING (term), corpus),
scored AS (
  SELECT query, any_value(item_id) AS item_id, doc, any_value(doc_id) AS doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) GROUP BY query, doc),
ranked AS (
  SELECT item_id, doc_id, score,
    CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""")
def op13_rank_documents(spark, sf_dir):
    """The ten documents that each benchmark item's terms rank highest."""
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@registered()
def op11_align_tokenizers(spark, sf_dir):
    """How every document's tokens line up under two tokenizers, and how common its linked ids are."""
    paths = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.align(table(spark, sf_dir, "documents"), *paths, kept=_sha256)
    return found.withColumnRenamed("groups", "groups_sha256")
