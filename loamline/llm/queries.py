"""One query an operator, over its whole table, with the SQL that gives the same rows."""

from __future__ import annotations

import json

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import (
    arc_to_warc, chat_format, exact_dedup, language_spans, main_text, mixing, near_dedup, piece_codec, quality,
    resample, secret_spans, token_store, vector_codes,
)

BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_distribution_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return quality.scored(_table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op2_addressable_codes(spark: SparkSession, sf: str) -> DataFrame:
    return token_store.stored_documents(
        _table(spark, sf, "documents"), public_tokenizers.path(BPE)
    ).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_randomness_battery(spark: SparkSession, sf: str) -> DataFrame:
    return secret_spans.secrets(_table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex",
        F.sha2("base_spans", 256).alias("base_sha256"), "spans",
    )


def op4_splitting_tree(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed_sizes(_table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def op5_host_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    return main_text.extract(_table(spark, sf, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op6_minhash_components(spark: SparkSession, sf: str) -> DataFrame:
    # Kept as the contract words it: rows whose id is the component's.
    return near_dedup.grouped(_table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )


def op7_language_viterbi(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_spans.train(docs, ~held_out)
    # The id is carried through; the hold-out mark is worked out from it afterwards.
    return language_spans.identify(docs, model).select(
        F.col("id").alias("doc_id"),
        F.coalesce(F.crc32(F.col("id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"), "lang_pred", "score",
    )


def op8_piece_prefix_table(spark: SparkSession, sf: str) -> DataFrame:
    return piece_codec.digests(_table(spark, sf, "documents"), public_tokenizers.path(PIECES)).select(
        F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256"
    )


def op9_arc_converter(spark: SparkSession, sf: str) -> DataFrame:
    return arc_to_warc.archived(_table(spark, sf, "pages"))


def op10_extendible_hash(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.duplicates(_table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", F.col("group_size"), "kept", "text_sha256"
    )


#: A conversation whose texts hold the template's own control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op11_schema_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    table = chat_format.canonical_rows(_table(spark, sf, "conversations"), ("conv_id", "turn", "role", "text"))
    messages = [{"role": role, "content": CONTROL_TEXT} for role in ("user", "assistant")]
    own = spark.createDataFrame([(json.dumps({"conv_id": -1, "messages": messages}),)], "json string")
    turns = chat_format.turns_of(table.unionByName(chat_format.canonical_json(own)))
    return chat_format.read_back(spark, chat_format.write_formatted(turns)).withColumnRenamed("conv", "conv_id")


def op12_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    drawn = resample.resampled(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_orchard_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.compressed(_table(spark, sf, "embeddings")).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256"
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_distribution_divergence, op2_addressable_codes, op3_randomness_battery, op4_splitting_tree,
        op5_host_suffix_array, op6_minhash_components, op7_language_viterbi, op8_piece_prefix_table,
        op9_arc_converter, op10_extendible_hash, op11_schema_fingerprint, op12_importance_resampling,
        op13_orchard_codes,
    )
}

_BLANKS = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_BIN = """CASE WHEN {p} > 0 THEN 0.5 * {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END
        + CASE WHEN {q} > 0 THEN 0.5 * {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END"""

QUALITY_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
c AS (
  SELECT *, len(w) AS n_words, length(regexp_replace(t, '{_BLANKS}', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(t, '[^a-z]', '', 'g')) AS c0, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS c1,
         length(regexp_replace(t, '[^0-9]', '', 'g')) AS c2,
         length(regexp_replace(t, '[\\x00-\\x7F]', '', 'g')) AS c3,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
win AS (
  SELECT r, i, n_words, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, n_words, unnest(range(1, n_words - 1)) AS i FROM c WHERE n_words >= 3)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM hit, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
held AS (SELECT lang FROM d WHERE lang IS NOT NULL GROUP BY lang
         HAVING count(*) >= {quality.LEAST_LANGUAGE} * (SELECT count(*) FROM d)),
k AS (SELECT c.*, held.lang AS key FROM c LEFT JOIN held ON c.lang = held.lang),
word AS (SELECT r, key, unnest(w) AS x FROM k),
per AS (SELECT key, x, count(*) AS n FROM word GROUP BY key, x),
keyed AS (SELECT key, x, n FROM per WHERE key IS NOT NULL
          UNION ALL SELECT NULL, x, sum(n) FROM per GROUP BY x),
common AS (SELECT key, x, n / total AS q FROM
             (SELECT key, x, n, sum(n) OVER (PARTITION BY key) AS total FROM keyed)
           WHERE n >= {quality.COMMON} * total),
q_all AS (SELECT key, sum(q) AS q FROM common GROUP BY key),
mine AS (SELECT r, word.key, word.x, count(*) AS n FROM word
         JOIN common ON word.key IS NOT DISTINCT FROM common.key AND word.x = common.x
         GROUP BY r, word.key, word.x),
met AS (SELECT mine.r, mine.n / k.n_words AS p, common.q FROM mine JOIN k ON k.r = mine.r
        JOIN common ON mine.key IS NOT DISTINCT FROM common.key AND mine.x = common.x),
present AS (SELECT r, sum({_BIN.format(p="p", q="q")} - 0.5 * q) AS s, sum(p) AS p FROM met GROUP BY r),
words AS (
  SELECT k.r, coalesce(present.s, 0) + 0.5 * coalesce(q_all.q, 0) + (
      SELECT {_BIN.format(p="po", q="qo")}
      FROM (SELECT greatest(1 - coalesce(present.p, 0), 0) AS po, greatest(1 - coalesce(q_all.q, 0), 0) AS qo)) AS jsd
  FROM k LEFT JOIN present ON present.r = k.r LEFT JOIN q_all ON q_all.key IS NOT DISTINCT FROM k.key),
parts AS (SELECT r, key, word_chars, unnest([c0, c1, c2, c3, n_symbols, word_chars - c0 - c1 - c2 - c3 - n_symbols]) AS n,
                 generate_subscripts([1, 2, 3, 4, 5, 6], 1) AS b FROM k),
sums AS (SELECT key, b, sum(n) AS n FROM parts GROUP BY key, b),
refs AS (SELECT key, b, n / sum(n) OVER (PARTITION BY key) AS q FROM
           (SELECT key, b, n FROM sums WHERE key IS NOT NULL UNION ALL SELECT NULL, b, sum(n) FROM sums GROUP BY b)),
signs AS (SELECT r, sum({_BIN.format(p="p", q="q")}) AS jsd
          FROM (SELECT parts.r, parts.n / parts.word_chars AS p, refs.q FROM parts
                JOIN refs ON refs.b = parts.b AND refs.key IS NOT DISTINCT FROM parts.key WHERE parts.word_chars > 0)
          GROUP BY r),
rows AS (
  SELECT k.r, doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words FROM k LEFT JOIN rep ON rep.r = k.r),
base AS (SELECT *, n_words < {quality.BASE_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM rows)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed
       AND NOT (n_words >= {quality.LEAST_WORDS} AND sqrt(greatest(words.jsd, 0)) > {quality.MOST_WORD_DISTANCE})
       AND NOT (word_chars >= {quality.LEAST_SIGNS} AND sqrt(greatest(signs.jsd, 0)) > {quality.MOST_SIGN_DISTANCE}) AS kept
FROM base JOIN words ON words.r = base.r LEFT JOIN signs ON signs.r = base.r
"""

NEAR_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_sets AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
              GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM both_sets JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * k >= {near_dedup.THRESHOLD} * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 5 * k}, 5))::BIGINT >> {shift}) & 31)::INT, 1)"
    for k in range(8) for shift in (15, 10, 5, 0)
)

WARC_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM m
"""

EXACT_SQL = f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '{_BLANKS}', '', 'g')) AS text_sha256
           FROM documents),
g AS (SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
             first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

_ESCAPED = r"regexp_replace({x}, '<(\\*)\|', '<\1\\|', 'g')"
_ROLE = _ESCAPED.format(x="replace(replace(role, '%', '%25'), chr(10), '%0A')")

CHAT_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('{chat_format.OPEN}' || {_ROLE} || chr(10) || {_ESCAPED.format(x="text")} || '{chat_format.CLOSE}' || chr(10)))::BIGINT
         AS formatted_chars
FROM c GROUP BY conv_id
"""


def _crc_table() -> list[int]:
    """The byte table of CRC-32, from its reflected polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


_CRC32 = f"""xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, {_crc_table()}[(xor(c, b) & 255) + 1])))"""
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_FEATURE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

RESAMPLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '{_FEATURE}') AS w
           FROM documents),
f AS (SELECT r, w, count(*) AS k FROM (SELECT r, unnest(w) AS w FROM d) GROUP BY r, w),
g AS (SELECT w, count(*) AS k FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '{_FEATURE}')) AS w
                                    FROM benchmark) GROUP BY w),
v AS (SELECT w, {_CRC32} % {resample.BUCKETS} AS b
      FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM f UNION SELECT w FROM g))),
s AS (SELECT b, sum(k) AS n FROM f JOIN v ON v.w = f.w GROUP BY b),
t AS (SELECT b, sum(k) AS n FROM g JOIN v ON v.w = g.w GROUP BY b),
totals AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS s_all, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE AS t_all),
gain AS (
  SELECT w, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + {resample.BUCKETS})
                            / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + {resample.BUCKETS}))))::BIGINT AS gain
  FROM v LEFT JOIN s ON s.b = v.b LEFT JOIN t ON t.b = v.b, totals),
per AS (SELECT r, sum(k * gain)::BIGINT AS weight FROM f JOIN gain ON gain.w = f.w GROUP BY r),
h AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256('{resample.SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN per ON per.r = d.r),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM h),
placed AS (SELECT doc_id, n_features, score, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place,
                  count(*) OVER () AS able FROM scored WHERE n_features >= {resample.LEAST_WORDS})
SELECT s.doc_id, s.n_features, s.weight, s.score,
       CASE WHEN place <= {resample.DRAW_PERCENT} * able // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed p ON p.doc_id IS NOT DISTINCT FROM s.doc_id AND p.score = s.score AND p.n_features = s.n_features
"""


def _codes_sql(parts: int, entries: int, rounds: int) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(
            f"a{k} AS (SELECT r, p, min(struct_pack(d := d, e := e)) AS best FROM ("
            f"SELECT r, x.p, e, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d "
            f"FROM x JOIN c{k} c ON c.p = x.p) GROUP BY r, p)"
        )
        if k < rounds:
            steps.append(
                f"m{k} AS (SELECT p, e, list(m ORDER BY j) AS v FROM (SELECT a.p, best.e AS e, j, floor(sum(x.v[j])::DOUBLE / count(*))::BIGINT AS m "
                f"FROM a{k} a JOIN x ON x.r = a.r AND x.p = a.p, LATERAL (SELECT unnest(range(1, len(x.v) + 1)) AS j) GROUP BY a.p, best.e, j) GROUP BY p, e), "
                f"c{k + 1} AS (SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN m{k} m ON m.p = c.p AND m.e = c.e)"
            )
    last = f"a{rounds}"
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda y: floor(256 * y::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(embedding) > 0),
x AS (SELECT r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v
      FROM kept, (SELECT unnest(range(0, {parts})) AS p)),
c0 AS (SELECT p, r - 1 AS e, v FROM x WHERE r <= {entries}),
{", ".join(steps)},
done AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM {last} GROUP BY r),
whole AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS digest FROM c{rounds}),
by_label AS (SELECT label, sum(error)::BIGINT AS label_error FROM kept JOIN done ON done.r = kept.r GROUP BY label)
SELECT vec_id, code, error, label_error, digest AS codebooks_sha256
FROM kept JOIN done ON done.r = kept.r JOIN by_label ON by_label.label IS NOT DISTINCT FROM kept.label, whole
"""


CODES_SQL = _codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS)

ORACLES = {
    "op11_schema_fingerprint": CHAT_SQL,
    "op12_importance_resampling": RESAMPLE_SQL,
    "op13_orchard_codes": CODES_SQL,
    "op1_distribution_divergence": QUALITY_SQL,
    "op6_minhash_components": NEAR_SQL,
    "op9_arc_converter": WARC_SQL,
    "op10_extendible_hash": EXACT_SQL,
}
