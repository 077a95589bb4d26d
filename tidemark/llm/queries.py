"""One registered query per operator, each over its whole table, and the SQL that checks it where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, embedding_dedup, fingerprints, language, mixing, near_duplicates, neighbours, packing, perplexity, phrases, sharding, url_rules
from .tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


@_query(
    "op1_mix_sources",
    """
WITH sizes AS (SELECT source, sum(coalesce(strlen(text), 0) + 1) AS size FROM documents GROUP BY source),
pulls AS (SELECT source, size, round(sqrt(size::DOUBLE), 6) AS pull FROM sizes),
totals AS (SELECT sum(size)::DOUBLE AS bytes, sum(pull::DECIMAL(38, 6))::DOUBLE AS others FROM pulls),
rates AS (
  SELECT source, 1.0::DOUBLE * pull / others * bytes / size AS rate FROM pulls, totals
),
parts AS (SELECT source, rate, greatest(ceil(rate / 16.0), 1)::BIGINT AS parts FROM rates),
terms AS (
  SELECT source, k, CASE WHEN k = 0 THEN exp(-rate / parts) ELSE exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)) END AS p
  FROM parts, range(0, 200) t(k) WHERE k <= ceil(rate / parts + 12 * sqrt(rate / parts) + 20)
),
cum AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
draws AS (
  SELECT d.doc_id, d.source, d.text, p.rate, j,
    ((('0x' || substr(md5(concat_ws('|', '20240611', coalesce(d.doc_id::VARCHAR, 'null'), j::VARCHAR)), 1, 15))::BIGINT) + 0.5::DOUBLE) / 1152921504606846976::DOUBLE AS u
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, range(1, 200) t(j) WHERE j <= p.parts
),
counts AS (
  SELECT doc_id, source, text, rate, sum((SELECT count(*) FROM cum c WHERE c.source IS NOT DISTINCT FROM draws.source AND c.c <= draws.u))::INT AS copies
  FROM draws GROUP BY doc_id, source, text, rate
)
SELECT doc_id, source, copy::INT AS copy, copies, round(rate, 9) AS rate,
  ('0x' || substr(md5(concat_ws('|', '20240611', coalesce(doc_id::VARCHAR, 'null'), copy::VARCHAR, 'order')), 1, 15))::BIGINT AS shuffle_key,
  strlen(text)::INT AS n_bytes
FROM counts, range(1, 10000) t(copy) WHERE copy <= copies
""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Square-root mixture of the sources at the size of the corpus; texts cross the shuffle with their copies."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "copy", "copies", F.round("rate", 9).alias("rate"), "shuffle_key", F.octet_length("text").alias("n_bytes"))


@_query(
    "op2_near_duplicates",
    f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT u, v FROM shared JOIN sets a ON a.doc_id = u JOIN sets b ON b.doc_id = v WHERE 100 * n >= 75 * (len(a.s) + len(b.s) - n)
),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.v FROM reach r JOIN both_ways l ON r.b = l.u),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM sets s JOIN component c USING (doc_id)
""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op3_pitman_yor")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.score_corpus(table(spark, sf_dir, "documents"))


@_query(
    "op4_quotation_threads",
    r"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS row, conv_id, turn, role, text, string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS lines FROM conversations
),
lines AS (
  SELECT row, conv_id, turn, pos, line, length(regexp_replace(regexp_extract(line, '^([ \t]*>)+', 0), '[^>]', '', 'g')) AS level
  FROM (SELECT row, conv_id, turn, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM rows WHERE contains(text, '>'))
),
own AS (
  SELECT r.row, r.conv_id, r.turn, CASE WHEN NOT contains(coalesce(text, ''), '>') THEN coalesce(text, '')
    ELSE coalesce((SELECT regexp_replace(string_agg(line, chr(10) ORDER BY pos), '^\s+|\s+$', '', 'g') FROM lines l WHERE l.row = r.row AND level = 0), '') END AS body
  FROM rows r
),
runs AS (SELECT *, pos - row_number() OVER (PARTITION BY row, level ORDER BY pos) AS run FROM lines),
passages AS (
  SELECT row, conv_id, turn, level, run, string_agg(regexp_replace(line, '^([ \t]*>)+[ \t]?', ''), chr(10) ORDER BY pos) AS passage
  FROM runs WHERE level > 0 GROUP BY row, conv_id, turn, level, run
),
units AS (
  SELECT DISTINCT row, conv_id, turn, level, run, trim(regexp_replace(lower(u), '\s+', ' ', 'g')) AS unit
  FROM (SELECT *, unnest(list_concat([passage], list_concat(regexp_split_to_array(passage, '\n\s*\n'), string_split(passage, chr(10))))) AS u FROM passages)
),
said AS (
  SELECT DISTINCT conv_id, turn, trim(regexp_replace(lower(u), '\s+', ' ', 'g')) AS unit
  FROM (SELECT conv_id, turn, unnest(list_concat([body], list_concat(regexp_split_to_array(body, '\n\s*\n'), string_split(body, chr(10))))) AS u
    FROM own WHERE conv_id IN (SELECT conv_id FROM passages))
),
found AS (
  SELECT q.row, q.level, q.run, length(q.unit) AS size, max(s.turn) AS original FROM units q JOIN said s ON s.conv_id = q.conv_id AND s.unit = q.unit AND s.turn < q.turn
  WHERE q.unit <> '' GROUP BY q.row, q.level, q.run, q.unit
),
linked AS (
  SELECT row, count(DISTINCT (level, run)) AS n_linked, first(original ORDER BY level, size DESC, original DESC) AS parent_turn FROM found GROUP BY row
),
counted AS (SELECT row, count(*) AS n_passages, max(level) AS max_level FROM passages GROUP BY row),
replies AS (SELECT conv_id, turn, max(parent_turn) AS parent_turn FROM linked JOIN rows USING (row) GROUP BY conv_id, turn),
up AS (
  SELECT conv_id, turn, turn AS root_turn, 0 AS depth FROM (SELECT DISTINCT conv_id, turn FROM rows)
  UNION ALL SELECT u.conv_id, u.turn, p.parent_turn, depth + 1 FROM up u JOIN replies p ON p.conv_id = u.conv_id AND p.turn = u.root_turn
),
top AS (SELECT conv_id, turn, arg_max(root_turn, depth) AS root_turn, max(depth) AS depth FROM up GROUP BY conv_id, turn)
SELECT r.conv_id, r.turn, r.role, o.body, coalesce(n_passages, 0) AS n_passages, coalesce(n_linked, 0) AS n_linked, coalesce(max_level, 0) AS max_level,
  parent_turn, t.root_turn, t.depth, row_number() OVER (PARTITION BY r.conv_id ORDER BY t.root_turn, t.depth, r.turn, r.row) AS position
FROM rows r JOIN own o USING (row) LEFT JOIN counted c ON c.row = r.row LEFT JOIN linked k ON k.row = r.row
LEFT JOIN top t ON t.conv_id IS NOT DISTINCT FROM r.conv_id AND t.turn IS NOT DISTINCT FROM r.turn
""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations")).select(
        "conv_id", "turn", "role", "body", "n_passages", "n_linked", "max_level", "parent_turn", "root_turn", "depth", "position"
    )


@_query(
    "op5_embedding_dedup",
    """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
unit AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS e FROM good),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND list_inner_product(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.v FROM reach r JOIN links l ON r.b = l.u),
component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.vec_id, (SELECT count(*) FROM links WHERE u = c.vec_id) AS n_links, component_id, c.vec_id = component_id AS kept FROM component c
""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@_query("op6_shuffle_rows")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shuffle_rows(table(spark, sf_dir, "documents"))
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    return sharded.select("doc_id", size.alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), "law", "shard", "slot", "grown_shard")


@_query("op7_pack_best_fit")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@_query("op8_language_ppm")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", (language.fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@_query("op9_forest_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@_query(
    "op10_url_rules",
    f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS r FROM pages),
parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(r, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}'), '') AS host,
    coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest
),
rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(str(r) for r in url_rules.RULES)}),
fits AS (
  SELECT page_id, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path) AS k
  FROM parts JOIN rules ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND k = 1
""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@_query(
    "op11_collocations",
    f"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece_no, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
  )
),
lists AS (SELECT piece_no, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
words AS (SELECT piece_no, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS pos FROM lists),
sizes AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
next AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4, lead(w1, 4) OVER p AS w5
  FROM words WINDOW p AS (PARTITION BY piece_no ORDER BY pos)
),
grams AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM next UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM next UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM next
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM next UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM next
),
counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams WHERE phrase IS NOT NULL GROUP BY lang, k, phrase HAVING k = 1 OR f >= 100),
keyed AS MATERIALIZED (SELECT lang || chr(1) || phrase AS name, f FROM counts),
candidates AS MATERIALIZED (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2),
cuts AS MATERIALIZED (
  SELECT lang, phrase, f, k, j, lang || chr(1) || array_to_string(w[1:j], ' ') AS one, lang || chr(1) || array_to_string(w[j + 1:], ' ') AS two
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates)
),
firsts AS MATERIALIZED (SELECT u.*, c.f AS l FROM cuts u JOIN keyed c ON c.name = u.one),
scores AS (
  SELECT u.lang, u.phrase, u.k, u.f AS a, j, l, c.f AS r, s.n, ((1000::HUGEINT * u.f * s.n) // (l::HUGEINT * c.f))::BIGINT AS score
  FROM firsts u JOIN keyed c ON c.name = u.two JOIN sizes s ON s.lang = u.lang
),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM candidates d WHERE d.lang = c.lang AND d.k > c.k AND 100 * d.f >= 100 * c.a AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ')
  )
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@_query("op12_quartile_digest")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@_query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))
