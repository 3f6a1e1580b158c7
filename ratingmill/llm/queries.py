"""The registered queries of this package and the SQL they are checked against.

SQL texts use only functions that DuckDB has; each query reads its whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingmill.llm import (
    decontamination,
    exact_dedup,
    importance,
    licenses,
    line_dedup,
    lm_mixing,
    mixing,
    near_dedup,
    phrases,
    substring_dedup,
    suffix_dedup,
    tool_calls,
    toxicity,
)

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    r"""WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)"""
)
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


@query(
    r"""WITH RECURSIVE sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
            ('0x' || substr(md5(doc_id::VARCHAR), 1, 10))::BIGINT AS k
        FROM documents),
    per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (
        SELECT *, source_size * 3.0::DOUBLE AS cap,
            CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w
        FROM per),
    ordered AS (
        SELECT *, sum(cap) OVER (ORDER BY cap / w, source NULLS LAST) - cap AS used,
            sum(w) OVER (ORDER BY cap / w DESC, source DESC NULLS FIRST) AS open
        FROM weighed),
    level AS (
        SELECT *, ((SELECT sum(source_size) FROM per)::DOUBLE - used) / open AS lv FROM ordered),
    first_free AS (SELECT max(lv) AS lv FROM level WHERE NOT cap <= lv * w),
    budget AS (
        SELECT source, source_size, CASE WHEN cap <= level.lv * w THEN cap ELSE first_free.lv * w END AS target FROM level, first_free),
    placed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id) - size AS start FROM sized)
    SELECT doc_id, p.source, size, source_size, target,
        (CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END * size
        + greatest(0, least(size, CASE WHEN source_size > 0 THEN round(target)::BIGINT % source_size ELSE 0 END - start)))::BIGINT AS taken
    FROM placed p JOIN budget b ON p.source IS NOT DISTINCT FROM b.source"""
)
def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query(
    r"""WITH items AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
        FROM benchmark),
    texts AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
        FROM documents),
    wanted AS (
        SELECT DISTINCT item_id, least(5, len(ws)) AS width, array_to_string(ws[i : i + least(5, len(ws)) - 1], ' ') AS s
        FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM items WHERE len(ws) > 0)),
    held AS (
        SELECT DISTINCT doc_id, width, array_to_string(ws[i : i + width - 1], ' ') AS s
        FROM (SELECT doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) AS i FROM texts, (SELECT DISTINCT width FROM wanted))),
    n AS (SELECT item_id, count(*) AS item_shingles FROM wanted GROUP BY item_id),
    shared AS (SELECT item_id, doc_id, count(*) AS shared FROM wanted JOIN held USING (width, s) GROUP BY item_id, doc_id)
    SELECT item_id, doc_id, item_shingles, shared, shared / item_shingles AS containment
    FROM shared JOIN n USING (item_id) WHERE shared * 100 >= 80 * item_shingles"""
)
def op5_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, folder, "documents"))


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query(
    r"""WITH l AS (
        SELECT doc_id, i, line, lower_ascii AS k FROM (
            SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
            FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents))),
    f AS (SELECT k, min(doc_id) AS first_doc, count(DISTINCT doc_id) AS docs FROM l WHERE length(k) >= 10 GROUP BY k),
    m AS (SELECT doc_id, i, line, coalesce(docs >= 2 AND doc_id <> first_doc, false) AS gone FROM l LEFT JOIN f USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id"""
)
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.line_dedup(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op10_repeat_removal(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op2_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm_mixing.score(table(spark, folder, "documents"))


_SENTENCE_ROWS = ", ".join(f"('{n}', '{w}')" for n, w in licenses.known_pieces(licenses.SENTENCES))
_RULE_ROWS = ", ".join(f"('{first}', '{name}', '{ids}')" for first, name, ids in licenses.rule_rows(licenses.SENTENCES, licenses.RULES))


@query(
    rf"""WITH catalogue(sentence, norm) AS (VALUES {_SENTENCE_ROWS}),
    rules(sentence, license, ids) AS (VALUES {_RULE_ROWS}),
    cuts AS (
        SELECT doc_id, 0 AS cut, coalesce(text, '') AS t FROM documents
        UNION ALL
        SELECT doc_id, 1, replace(replace(regexp_replace(coalesce(text, ''), '\n[ \t\r]*\n\s*', chr(1), 'g'), chr(10), ' '), chr(1), chr(10)) FROM documents),
    pieces AS (SELECT doc_id, cut, string_split(regexp_replace(t, '([.!?;:])[ \t]+', '\1' || chr(10), 'g'), chr(10)) AS p FROM cuts),
    parts AS (SELECT doc_id, cut, unnest(p) AS part, generate_subscripts(p, 1) - 1 AS pos FROM pieces),
    known AS (
        SELECT DISTINCT doc_id, cut, pos, sentence FROM (
            SELECT doc_id, cut, pos, trim(regexp_replace(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')) AS norm FROM parts)
        JOIN catalogue USING (norm)),
    seqs AS (SELECT doc_id, cut, '|' || string_agg(sentence, '|' ORDER BY pos, sentence) || '|' AS text_ids, count(*) AS n FROM known GROUP BY doc_id, cut)
    SELECT doc_id, license, max(n) AS n_known, min(pos) AS first_pos
    FROM known JOIN seqs USING (doc_id, cut) JOIN rules USING (sentence) WHERE contains(text_ids, ids) GROUP BY doc_id, license"""
)
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents"))


@query(
    """WITH t AS (SELECT conv_id, turn, coalesce(role, 'user') AS role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
    calls AS (
        SELECT conv_id || '-' || turn AS call_id, conv_id, turn, CASE WHEN role = 'system' THEN 'configure' ELSE 'reply' END AS name,
            text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS depth
        FROM t WHERE role <> 'assistant'),
    results AS (SELECT conv_id || '-' || (turn - 1) AS call_id, text AS content FROM t WHERE role = 'assistant')
    SELECT call_id, depth, name, 1::BIGINT AS n_calls, CASE WHEN r.call_id IS NULL THEN 0 ELSE 1 END::BIGINT AS n_results, true AS valid, '' AS errors,
        '{"arguments":{"prompt":' || to_json(text) || ',"turn":' || turn || '},"id":' || to_json(call_id) || ',"name":' || to_json(name)
        || CASE WHEN r.call_id IS NULL THEN '' ELSE ',"result":' || to_json(content) END || '}' AS message
    FROM calls LEFT JOIN results r USING (call_id)"""
)
def op4_tool_links(spark: SparkSession, folder: str) -> DataFrame:
    return tool_calls.link_calls(*tool_calls.turn_calls(table(spark, folder, "conversations")))


@query(
    r"""WITH tab AS MATERIALIZED (
      SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
      FROM range(256) r(i)),
    texts AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
    ws AS MATERIALIZED (
      SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM texts),
    grams AS MATERIALIZED (
      SELECT side, id, array_to_string(w[i : i + n - 1], ' ') AS f, count(*) AS c
      FROM (SELECT side, id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM ws, range(1, 4) r(n)) GROUP BY ALL),
    hashed AS MATERIALIZED (
      SELECT f, xor(list_reduce([4294967295] || [('0x' || h[2 * k + 1 : 2 * k + 2])::BIGINT for k in range(len(h) // 2)],
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
      FROM (SELECT DISTINCT f, hex(encode(f)) AS h FROM grams), tab),
    counted AS MATERIALIZED (SELECT bucket, sum(c) FILTER (side = 0) AS s, sum(c) FILTER (side = 1) AS t FROM grams JOIN hashed USING (f) GROUP BY bucket),
    totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM counted),
    gains AS MATERIALIZED (
      SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
      FROM counted, totals),
    weighed AS (SELECT id, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight FROM grams JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 0 GROUP BY id),
    scored AS (
      SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM ws LEFT JOIN weighed USING (id) WHERE side = 0),
    placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20)
    SELECT s.*, CASE WHEN rank <= (SELECT count(*) FROM placed) * 5 // 100 THEN rank END AS rank FROM scored s LEFT JOIN placed USING (doc_id)"""
)
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    r"""WITH d AS MATERIALIZED (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    starts AS MATERIALIZED (
      SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
    again AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first_doc FROM starts) WHERE first_doc < doc_id),
    ws AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
    marked AS (
      SELECT doc_id, word, ws.i, coalesce(ws.i - max(again.i) OVER (PARTITION BY doc_id ORDER BY ws.i) < 50, false) AS gone
      FROM ws LEFT JOIN again USING (doc_id, i)),
    runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM marked),
    kept AS (
      SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_repeats, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS t
      FROM runs GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(n_repeats, 0) AS n_repeats, sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)"""
)
def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    n_repeats = F.size("repeats").cast("bigint").alias("n_repeats")
    return kept.select("doc_id", "n_words", "n_removed", n_repeats, F.sha2("kept", 256).alias("kept_sha256"))


@query(
    r"""WITH pieces AS MATERIALIZED (
      SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
    f AS MATERIALIZED (
      SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) r(k)) GROUP BY ALL),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    often AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE f >= 100),
    candidates AS (SELECT * FROM often WHERE k > 1),
    inner_parts AS (
      SELECT lang, f, k, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
      FROM (SELECT lang, f, k, w, m, unnest(range(1, k - m + 2)) AS i FROM candidates, range(2, 5) r(m) WHERE m < k)),
    dropped AS (SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inner_parts p ON p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.f >= 100 * c.f),
    cuts AS (
      SELECT c.lang, c.phrase, c.f AS a, cut, n, l.f AS l, r.f AS r, ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c ANTI JOIN dropped d ON d.lang = c.lang AND d.phrase = c.phrase
        JOIN total USING (lang)
        JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : cut], ' ')
        JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1 :], ' ')),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best
    QUALIFY rank <= 2000"""
)
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))
