"""Registered queries of the operators, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import codes, decontaminate, html, infill, interleave, language, licenses, minhash, packing, quality, quotes, secrets, substrings

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = quotes.link_quotations(_table(spark, sf_dir, "conversations"))
    return linked.select("row.conv_id", "row.turn", "row.role", *(c for c in linked.columns if c != "row"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(_table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(_table(spark, sf_dir, "documents"))


def op4_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), VOCABULARY)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality(_table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    distances = (F.round(c, 4).alias(c) for c in ("class_distance", "word_distance"))
    return scored.select("row.doc_id", *counts, *distances, "kept")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(_table(spark, sf_dir, "embeddings"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleave.places(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", *interleave.ADDED, "source")


def op13_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_quotations": op1_quotations,
    "op2_secrets": op2_secrets,
    "op3_licenses": op3_licenses,
    "op4_repeated_substrings": op4_repeated_substrings,
    "op5_main_text": op5_main_text,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_language": op7_language,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_decontamination": op10_decontamination,
    "op11_vector_codes": op11_vector_codes,
    "op12_sharding": op12_sharding,
    "op13_infilling": op13_infilling,
    "pipeline": pipeline,
}

_RULES = quality.Rules()
_COUNT = "CAST(length(regexp_replace(t, '{0}', '', 'g')) AS BIGINT)"
_CLASS_COUNTS = ", ".join(
    _COUNT.format(("[^" + (p[1:-1] if p.startswith("[") else p) + "]").replace("'", "''")) + f" AS c{i}"
    for i, (_, p) in enumerate(quality.CLASSES)
)
_N = len(quality.CLASSES)
_KNOWN = " + ".join(f"c{i}" for i in range(_N))
_JS = """
  SELECT r, sqrt(greatest(0, sum(
      CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS d
  FROM {0} GROUP BY r
"""

#: Words are split as in Spark; the distances are sums over one row per document and bin.
OP9_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT r, doc_id, lang, t, [w FOR w IN string_split_regex(t, '[\x20\x09-\x0D]+') IF w <> ''] AS ws,
    [x FOR x IN string_split(t, chr(10)) IF regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> ''] AS ls
  FROM texts),
counted AS (
  SELECT r, doc_id, lang, ws, CAST(len(ws) AS BIGINT) AS n_words,
    {_COUNT.format(r'[\x20\x09-\x0D]')} AS word_chars,
    {_COUNT.format('[^#*$%&|<>]')} AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, length(t) AS n_all, {_CLASS_COUNTS}
  FROM split),
windows AS (
  SELECT r, i, array_to_string(ws[i : i + {quality.WINDOW - 1}], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {quality.WINDOW - 2})) AS i FROM counted)),
starts AS (
  SELECT r, i, lag(i, 1, -100) OVER (PARTITION BY r ORDER BY i) AS last
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT r, CAST(sum(least({quality.WINDOW}, i - last)) AS BIGINT) AS n_repeat_words FROM starts GROUP BY r),
base AS (
  SELECT *, coalesce(n_repeat_words, 0) AS n_rep,
    n_words < {_RULES.min_words}
      OR 100 * coalesce(n_repeat_words, 0) > {_RULES.max_repeat_percent} * n_words AS base_failed
  FROM counted LEFT JOIN repeats USING (r)),
class_rows AS (
  SELECT r, lang, n_all, unnest([{", ".join(f"c{i}" for i in range(_N))}, n_all - word_chars,
    word_chars - ({_KNOWN})]) AS n, unnest(range({_N + 2})) AS k FROM base),
class_refs AS (SELECT lang, k, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q
  FROM class_rows WHERE lang IS NOT NULL GROUP BY lang, k),
word_rows AS (SELECT r, lang, unnest(ws) AS w FROM base),
totals AS (
  SELECT lang, count(*) AS total FROM word_rows WHERE lang IS NOT NULL
  GROUP BY lang HAVING count(*) >= {_RULES.min_reference_words}),
common AS (
  SELECT lang, w, count(*) AS n FROM word_rows WHERE lang IS NOT NULL
  GROUP BY lang, w
  QUALIFY n > coalesce(nth_value(n, {_RULES.common_words + 1}) OVER (
    PARTITION BY lang ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0)),
word_refs AS (
  SELECT lang, w, n / total AS q FROM common JOIN totals USING (lang)
  UNION ALL
  SELECT lang, NULL, (any_value(total) - sum(n)) / any_value(total) FROM common JOIN totals USING (lang) GROUP BY lang),
hits AS (
  SELECT r, lang, c.w, count(*) AS n FROM word_rows LEFT JOIN common c USING (lang, w) GROUP BY r, lang, c.w),
class_pairs AS (
  SELECT r, n / n_all AS p, q FROM class_rows JOIN class_refs USING (lang, k)
  WHERE n_all >= {_RULES.min_class_chars} AND lang IN (SELECT lang FROM totals)),
word_pairs AS (
  SELECT b.r, coalesce(h.n, 0) / b.n_words AS p, f.q
  FROM base b JOIN word_refs f ON f.lang = b.lang
  LEFT JOIN hits h ON h.r = b.r AND h.w IS NOT DISTINCT FROM f.w
  WHERE b.n_words >= {_RULES.min_common_words}),
by_class AS ({_JS.format("class_pairs")}),
by_word AS ({_JS.format("word_pairs")})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_rep AS n_repeat_words, base_failed,
  round(c.d, 4) AS class_distance, round(w.d, 4) AS word_distance,
  NOT base_failed AND coalesce(c.d, 0) <= {_RULES.max_class_distance}
    AND coalesce(w.d, 0) <= {_RULES.max_word_distance} AS kept
FROM base LEFT JOIN by_class c USING (r) LEFT JOIN by_word w USING (r)
"""

_MARKS = r"^[ \t]*((?:>[ \t]?)+)"
_LEVEL = rf"""CASE WHEN regexp_matches(x, '{quotes._ANNOUNCED}') THEN -1
  ELSE length(regexp_replace(regexp_extract(x, '{_MARKS}', 1), '[^>]', '', 'g')) END"""
_BODY = f"regexp_replace(x, '{_MARKS}', '')"

OP1_SQL = rf"""
WITH messages AS (
  SELECT row_number() OVER () AS r, conv_id, turn, role, text,
    string_split_regex(coalesce(text, ''), '\r?\n') AS xs FROM conversations),
lines AS (
  SELECT r, conv_id, turn, i, {_LEVEL} AS level,
    trim(regexp_replace(lower({_BODY}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS words
  FROM (SELECT r, conv_id, turn, unnest(xs) AS x, generate_subscripts(xs, 1) AS i
    FROM messages WHERE conv_id IS NOT NULL AND turn IS NOT NULL)),
numbered AS (SELECT *, i - row_number() OVER (PARTITION BY r, level ORDER BY i) AS run FROM lines),
runs AS (
  SELECT conv_id, turn, level, string_split(string_agg(words, ' ' ORDER BY i), ' ') AS ws
  FROM numbered WHERE words <> '' GROUP BY r, conv_id, turn, level, run),
passages AS (
  SELECT conv_id, turn, level, ws, least(len(ws), {quotes.WINDOW}) AS size, count(*) AS n
  FROM runs WHERE level > 0 GROUP BY ALL),
quoted AS (
  SELECT DISTINCT conv_id, turn, level, ws, n, array_to_string(ws[j:j + size - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS j FROM passages)),
own AS (
  SELECT * FROM runs JOIN (SELECT DISTINCT conv_id, size FROM passages) USING (conv_id)
  WHERE level = 0 AND len(ws) >= size),
said AS (
  SELECT DISTINCT conv_id, turn, array_to_string(ws[j:j + size - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS j FROM own)),
found AS (
  SELECT q.conv_id, q.turn, q.level, q.ws, q.w, any_value(q.n) AS n, max(s.turn) AS before
  FROM quoted q LEFT JOIN said s ON s.conv_id = q.conv_id AND s.w = q.w AND s.turn < q.turn
  GROUP BY q.conv_id, q.turn, q.level, q.ws, q.w),
origins AS (
  SELECT conv_id, turn, level, ws, any_value(n) AS n,
    max(struct_pack(windows := windows, before := before)) FILTER (before IS NOT NULL) AS most
  FROM (SELECT conv_id, turn, level, ws, before, any_value(n) AS n, count(*) AS windows FROM found GROUP BY conv_id, turn, level, ws, before)
  GROUP BY conv_id, turn, level, ws),
votes AS (
  SELECT conv_id, turn, level, most.before AS before, sum(most.windows * n) AS windows, sum(n) AS n
  FROM origins GROUP BY conv_id, turn, level, most.before),
links AS (
  SELECT conv_id, turn,
    max(struct_pack(near := -level, windows := windows, before := before)) FILTER (before IS NOT NULL) AS most,
    sum(n) AS n_quoted, coalesce(sum(n) FILTER (before IS NOT NULL), 0) AS n_linked, max(level) AS quote_depth
  FROM votes GROUP BY conv_id, turn),
turns AS (
  SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS previous
  FROM (SELECT DISTINCT conv_id, turn FROM messages WHERE conv_id IS NOT NULL AND turn IS NOT NULL)),
replies AS (
  SELECT t.*, coalesce(most.before, previous) AS reply_to, n_quoted, n_linked, quote_depth
  FROM turns t LEFT JOIN links USING (conv_id, turn)),
branches AS (
  SELECT *, max(CASE WHEN reply_to IS NULL OR reply_to <> previous THEN turn END)
    OVER (PARTITION BY conv_id ORDER BY turn) AS branch
  FROM replies)
SELECT m.conv_id, m.turn, m.role,
  CASE WHEN m.text IS NOT NULL THEN regexp_replace(array_to_string(
    [{_BODY} FOR x IN m.xs IF {_LEVEL} = 0], chr(10)), '^\s+|\s+$', '', 'g') END AS own_text,
  b.reply_to, b.branch, o.reply_to AS branch_of,
  CAST(CASE WHEN b.turn IS NOT NULL THEN coalesce(b.n_quoted, 0) END AS BIGINT) AS n_quoted,
  CAST(CASE WHEN b.turn IS NOT NULL THEN coalesce(b.n_linked, 0) END AS BIGINT) AS n_linked,
  CAST(CASE WHEN b.turn IS NOT NULL THEN coalesce(b.quote_depth, 0) END AS BIGINT) AS quote_depth
FROM messages m LEFT JOIN branches b ON b.conv_id = m.conv_id AND b.turn = m.turn
LEFT JOIN branches o ON o.conv_id = b.conv_id AND o.turn = b.branch
"""



def _assigned(name: str, books: str) -> str:
    """Distances of all parts to all entries, and the nearest entry of each part."""
    return f"""
{name}_far AS (
  SELECT r, part, entry, sum((v - c) * (v - c))::BIGINT AS d
  FROM parts JOIN {books} USING (part, pos) GROUP BY r, part, entry),
{name} AS (SELECT * FROM {name}_far QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1)"""


def _moved(name: str, assigned: str, books: str) -> str:
    return f"""
{name} AS (
  SELECT part, entry, pos, coalesce(m, c) AS c FROM {books} LEFT JOIN (
    SELECT part, entry, pos, CAST(floor(sum(v) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS m
    FROM {assigned} JOIN parts USING (r, part) GROUP BY part, entry, pos) USING (part, entry, pos))"""


OP11_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding AS e, len(embedding) // {codes.PARTS} AS width
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT r, (i - 1) // width AS part, (i - 1) % width AS pos, CAST(floor({codes.SCALE} * CAST(e[i] AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM kept)),
seeds AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {codes.ENTRIES}),
b0 AS (SELECT part, entry, pos, v AS c FROM seeds JOIN parts USING (r)),
{_assigned("a0", "b0")}, {_moved("b1", "a0", "b0")}, {_assigned("a1", "b1")}, {_moved("b2", "a1", "b1")}, {_assigned("a2", "b2")},
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b2) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""

#: The checksum goes byte by byte, with its table made by rule.
OP12_SQL = f"""
WITH RECURSIVE steps(i, k, c) AS (
  SELECT range, 0, range FROM range(256) UNION ALL
  SELECT i, k + 1, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS crc FROM steps WHERE k = 8),
bytes AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) AS n_bytes, hex(encode(coalesce(text, ''))) AS h,
    md5('{interleave.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce('=' || text, '')) AS digest,
    coalesce('=' || source, '') AS s
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY digest) - 1 AS rank, count(*) OVER (PARTITION BY s) AS n FROM bytes),
placed AS (
  SELECT *, count(*) OVER () AS total,
    (CAST(rank AS DOUBLE) + CAST(('0x' || md5('{interleave.SEED}:' || s)[1:8]) AS BIGINT) / CAST(4294967296 AS DOUBLE))
      / CAST(n AS DOUBLE) AS f
  FROM ranked),
cut AS (
  SELECT *, row_number() OVER (ORDER BY f, s, digest) - 1 AS place, place * {interleave.SHARDS} // total AS shard FROM placed)
SELECT doc_id, source, CAST(n_bytes + 1 AS BIGINT) AS size,
  xor(list_reduce(list_prepend(4294967295, list_transform(range(n_bytes), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
    lambda a, b: xor(a >> 8, crc[xor(a & 255, b) + 1])), 4294967295) AS text_crc32,
  '{interleave.LAW}' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(place - (shard * total + {interleave.SHARDS - 1}) // {interleave.SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut, crc
"""

OP13_SQL = rf"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{infill.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
numbers AS (
  SELECT *, len(units) AS n, [CAST('0x' || d[8 * i + 1 : 8 * i + 8] AS BIGINT) FOR i IN range(4)] AS h FROM cut),
planned AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= {infill.PERCENT_CHANGED} THEN 'plain'
      WHEN h[4] % 100 < {infill.PERCENT_SPM} THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1 : b], '') AS middle,
    array_to_string(units[b + 1 :], '') AS suffix
  FROM planned)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quotations": OP1_SQL,
    "op9_quality": OP9_SQL,
    "op11_vector_codes": OP11_SQL,
    "op12_sharding": OP12_SQL,
    "op13_infilling": OP13_SQL,
}
