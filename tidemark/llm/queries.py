"""The registered query of each operator, over its whole table, with its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup, importance_resampling, language_id, lexical_search, minhash, packing, quality_classifier, quality_rules, secret_scan, sentencepiece_fst, substring_dedup, token_counts, warc
from .shared import crc_bucket, scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats_in_batches(_table(spark, sf_dir, "documents"), 20, digest=True)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(crc_bucket(F.col("doc_id"), 4) != 2))
    return language_id.identify(docs, model).select("doc_id", (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"), rows=crc_bucket(F.col("doc_id"), 3) != 1)
    return quality_classifier.classify(docs, model).select("doc_id", (crc_bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048, 1)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepiece_fst.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_xxhash64"), F.sha2("text", 256).alias("decoded_sha256"), "restored")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.98)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), top=10)


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.find_secrets(_table(spark, sf_dir, "documents")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_substring_dedup, op3_token_counts, op4_language_id, op5_quality_classifier, op6_packing, op7_minhash, op8_sentencepiece, op9_embedding_dedup, op10_warc, op11_lexical_search, op12_secret_scan, op13_importance_resampling)}

_ASSIGN_SQL = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
_KINDS_SQL = " UNION ALL ".join(
    f"SELECT rid, {i} AS ord, '{kind}' AS kind, regexp_extract_all(text, '{pattern}') AS vals, string_split_regex(text, '{pattern}') AS gaps FROM d"
    for i, (kind, pattern) in enumerate((("assign", _ASSIGN_SQL), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+"), ("markov", "[A-Za-z0-9+/_=-]{16,}")))
)

ORACLE_SQL = {
    "op1_quality_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, words[i:i+2] AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) AS t(k) GROUP BY rid),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')))::BIGINT AS n_upper, len(lines) AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_upper > 30 * word_chars OR 100 * n_dup_lines > 50 * n_lines OR word_chars > 12 * n_words) AS kept
FROM b""",
    "op2_substring_dedup": r"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(words[i:i+19], ' ')) AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)),
r AS MATERIALIZED (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, i + k AS i FROM r, range(0, 20) AS t(k)),
p AS (SELECT doc_id, i, words[i] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM p ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)""",
    "op7_minhash": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN words ELSE words[i:i+2] END AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, least(len(words), 1)) + 1)) AS i FROM w)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
h AS MATERIALIZED (SELECT doc_id, md5(array_to_string(g, ' ')) AS g FROM s),
links AS MATERIALIZED (SELECT u, v FROM (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM h a JOIN h b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL) p
  JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
c AS (SELECT u AS doc_id, min(v) AS m FROM reach GROUP BY u)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id <= coalesce(m, doc_id) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)""",
    "op9_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda e: e * e)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
n AS (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u),
reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
c AS (SELECT u AS vec_id, min(v) AS m FROM reach GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)""",
    "op10_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY sha1(html)) AS first FROM p),
bits AS (SELECT *, list_reduce(list_transform(range(1, 41), lambda i: substr(bin(16 + strpos('0123456789abcdef', substr(h, i::INT, 1)) - 1), 2)), lambda a, b: a || b) AS b FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * substr(b, (5 * i + 1)::INT, 1)::INT + 8 * substr(b, (5 * i + 2)::INT, 1)::INT + 4 * substr(b, (5 * i + 3)::INT, 1)::INT
      + 2 * substr(b, (5 * i + 4)::INT, 1)::INT + substr(b, (5 * i + 5)::INT, 1)::INT, 1)), lambda x, y: x || y) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits""",
    "op13_importance_resampling": r"""
WITH bits AS (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS t(b)),
crc AS MATERIALIZED (SELECT list(v ORDER BY b) AS tab FROM bits),
texts AS (SELECT row_number() OVER () AS rid, doc_id, text, false AS target FROM documents UNION ALL SELECT -row_number() OVER (), NULL, text, true FROM benchmark),
w AS MATERIALIZED (SELECT rid, target, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
f AS MATERIALIZED (SELECT rid, target, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature FROM w),
h AS (SELECT feature, hex(encode(feature)) AS x FROM (SELECT DISTINCT feature FROM f)),
b AS MATERIALIZED (SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::INT, 2))::BIGINT)), lambda c, y: xor(tab[(xor(c, y) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM h, crc),
n AS (SELECT bucket, count(*) FILTER (WHERE NOT target) AS s, count(*) FILTER (WHERE target) AS t FROM f JOIN b USING (feature) GROUP BY bucket),
a AS (SELECT sum(s) AS ss, sum(t) AS tt FROM n),
g AS MATERIALIZED (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (ss + 10000)::DOUBLE / ((s + 1)::DOUBLE * (tt + 10000)::DOUBLE)))::BIGINT AS gain FROM n, a),
m AS (SELECT rid, count(*) AS n_features, sum(gain)::BIGINT AS total FROM f JOIN b USING (feature) JOIN g USING (bucket) WHERE NOT target GROUP BY rid),
e AS (SELECT rid, doc_id, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
  ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM texts LEFT JOIN m USING (rid) WHERE NOT target),
r AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score, n_features >= 39 AS fit FROM e),
o AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY fit) AS n FROM r)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN fit AND place <= 25 * n // 100 THEN place END AS rank FROM o""",
    "op11_lexical_search": r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
q AS MATERIALIZED (SELECT DISTINCT iid, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark)),
c AS (SELECT count(*) AS n, sum(len(terms))::BIGINT AS l FROM d WHERE len(terms) > 0),
p AS MATERIALIZED (SELECT rid, doc_id, term, size, count(*) AS tf FROM (SELECT rid, doc_id, len(terms) AS size, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS MATERIALIZED (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
s AS (SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n) // l))))::BIGINT AS score FROM q JOIN w USING (term) JOIN p USING (term), c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 10""",
    "op12_secret_scan": rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({_KINDS_SQL}),
m AS (SELECT rid, ord, kind, i, vals[i] AS v, length(gaps[i]) + coalesce(length(vals[i - 1]), 0) AS step FROM (SELECT *, unnest(range(1, len(vals) + 1)) AS i FROM f)),
p AS (SELECT rid, ord, kind, v, (sum(step) OVER (PARTITION BY rid, ord ORDER BY i))::BIGINT AS a FROM m),
s AS MATERIALIZED (SELECT rid, ord, kind, a, a + length(v) AS z, CASE WHEN ord = 0 THEN regexp_extract(v, '{_ASSIGN_SQL}', 2) ELSE v END AS v FROM p
  WHERE length(CASE WHEN ord = 0 THEN regexp_extract(v, '{_ASSIGN_SQL}', 2) ELSE v END) >= [6, 20, 24, 16][ord + 1]),
base AS MATERIALIZED (SELECT * FROM s WHERE ord < 3),
free AS MATERIALIZED (SELECT * FROM s WHERE ord = 3 AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = s.rid AND b.a < s.z AND s.a < b.z)),
x AS (SELECT sha256(range::VARCHAR) AS h, to_base64(unhex(sha256(range::VARCHAR))) AS e FROM range(2000)),
halves AS (SELECT v, substr(v, 1, 8) AS h, substr(v, 9) AS t FROM free),
learn AS (SELECT v, 1 AS label FROM base UNION ALL SELECT v, 0 FROM free
  UNION ALL SELECT unnest([upper(v), h || upper(t[1]) || substr(t, 2), h || '_' || t, h || '-' || t, h || '/' || t, upper(h || '_' || t)]), 0 FROM halves WHERE regexp_full_match(v, '[a-z]+') UNION ALL SELECT unnest([h, e, upper(translate(e, '+/=', '')), lower(translate(e, '+/=', ''))]), 1 FROM x),
c AS (SELECT label, list_transform(string_split(v, ''), lambda y: strpos('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-', y)) AS l FROM learn),
t AS (SELECT label, unnest(list_zip(list_prepend(0, l), list_append(l, 0))) AS t FROM c),
n AS (SELECT t[1] AS "from", t[2] AS "to", count(*) FILTER (WHERE label = 1) AS r, count(*) FILTER (WHERE label = 0) AS o FROM t GROUP BY ALL),
cell AS (SELECT 69 * i + j AS id, i, coalesce(r, 0) AS r, coalesce(o, 0) AS o FROM range(69) AS q(i), range(69) AS w(j) LEFT JOIN n ON n."from" = i AND n."to" = j),
g AS (SELECT list(floor(1000 * (ln((r + 69 * ((tr + 1)::DOUBLE / (ar + 69)::DOUBLE)) / (sr + 69)::DOUBLE) - ln((o + 69 * ((te + 1)::DOUBLE / (ao + 69)::DOUBLE)) / (so + 69)::DOUBLE)))::BIGINT ORDER BY id) AS gains
  FROM (SELECT *, sum(r) OVER (PARTITION BY i) AS sr, sum(o) OVER (PARTITION BY i) AS so, sum(r) OVER (PARTITION BY id % 69) AS tr, sum(o) OVER (PARTITION BY id % 69) AS te, sum(r) OVER () AS ar, sum(o) OVER () AS ao FROM cell)),
e AS (SELECT free.*, list_transform(string_split(v, ''), lambda y: strpos('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-', y)) AS l FROM free),
added AS (SELECT rid, ord, kind, a, z, v FROM e, g WHERE list_sum(list_transform(list_zip(list_prepend(0, l), list_append(l, 0)), lambda k: gains[69 * k[1] + k[2] + 1])) >= 5000),
spans AS (SELECT rid, count(*) FILTER (WHERE ord = 0) AS n0, count(*) FILTER (WHERE ord = 1) AS n1, count(*) FILTER (WHERE ord = 2) AS n2,
  string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, ord) FILTER (WHERE ord < 3) AS b, string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, ord) AS w
  FROM (FROM base UNION ALL FROM added) GROUP BY rid)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(w, '') AS spans
FROM d LEFT JOIN spans USING (rid)""",
}
