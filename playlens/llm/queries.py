"""Registered queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm.chat import link_messages
from playlens.llm.common import table
from playlens.llm.decontamination import decontaminate
from playlens.llm.embedding_dedup import embedding_near_dups
from playlens.llm.importance import importance_resample
from playlens.llm.licenses import license_scan
from playlens.llm.line_dedup import line_dedup
from playlens.llm.merkle import merkle_manifest
from playlens.llm.mixing import mix_plan
from playlens.llm.packing import pack
from playlens.llm.quality_classifier import quality_scores
from playlens.llm.quality_rules import quality_rules
from playlens.llm.simhash import hex_fingerprint, simhash_groups
from playlens.llm.url_filters import url_filter


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules(table(spark, sf_dir, "documents"), trusted).drop("text_key")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    out = quality_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return out.select("doc_id", "held_out", "score", "predicted")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_messages(table(spark, sf_dir, "conversations"))


def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The pipeline's limit too: where sources differ by more, the exponent lies inside its range.
    plan = mix_plan(table(spark, sf_dir, "documents"), max_repeats=2.0)
    return plan.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("src") != "null", F.expr("substr(src, 2)")).alias("source"),
        F.col("tokens").alias("n_tokens"),
        "epoch",
        "block",
        "position",
        "weight",
        "exponent",
    )


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return groups.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id", "keeper")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("text_key")


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.drop("text")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dups(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.drop("url")


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10)
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, min_words=20)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id has a CRC-32 divisible by 7 are folded with another ``n_chars``."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = F.col("n_chars") + F.when(hit, F.lit(1)).otherwise(F.lit(0))
    return merkle_manifest(
        table(spark, sf_dir, "documents"),
        ["doc_id", "source", "lang", "n_chars", "text"],
        group_col="lang",
        id_col="doc_id",
        changed={"n_chars": tampered},
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_temperature_mixing": op4_temperature_mixing,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_license_scans": op7_license_scans,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_url_filters": op9_url_filters,
    "op10_line_dedup": op10_line_dedup,
    "op11_benchmark_decontamination": op11_benchmark_decontamination,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    # Messages of one turn are ordered by a hash in the operator; here (conv_id, turn) names a message.
    "op3_chat_formatting": r"""
WITH RECURSIVE messages AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position
    FROM conversations),
owned AS (
    SELECT * EXCLUDE (text, lines), lines,
           CASE WHEN list_bool_or([regexp_matches(x, '^[ \t]*>') FOR x IN lines])
                THEN trim(array_to_string(
                    [lines[i] FOR i IN range(1, len(lines) + 1)
                     IF NOT regexp_matches(lines[i], '^[ \t]*>')
                        AND NOT (regexp_matches(lines[i], '^(?:On|Le|Am|El) .+(?:wrote|écrit|schrieb|escribió) ?:[ \t]*$')
                                 AND coalesce(regexp_matches([y FOR y IN lines[i + 1:] IF NOT regexp_full_match(y, '[ \t]*')][1], '^[ \t]*>'),
                                              false))],
                    chr(10)), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))
                ELSE text END AS content
    FROM messages),
marked AS (
    SELECT conv_id, position, pos, lines[pos] AS line, regexp_extract(lines[pos], '^(?:[ \t]*>)+[ \t]?') AS mark
    FROM owned, LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS pos) t),
levels AS (
    SELECT conv_id, position, pos, length(regexp_replace(mark, '[^>]', '', 'g')) AS level, substr(line, length(mark) + 1) AS body
    FROM marked),
turned AS (
    SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY conv_id, position ORDER BY pos) THEN 0 ELSE 1 END AS new
    FROM levels),
runs AS (
    SELECT *, sum(new) OVER (PARTITION BY conv_id, position ORDER BY pos) AS run FROM turned),
quotes AS (
    SELECT conv_id, position, run, level, string_agg(body, chr(10) ORDER BY pos) AS quote
    FROM runs WHERE level > 0 GROUP BY conv_id, position, run, level),
pieces AS (
    SELECT conv_id, position, level, quote AS whole FROM quotes
    UNION ALL SELECT conv_id, position, 0, content FROM owned),
cut AS (
    SELECT conv_id, position, level, unnest([whole]) AS part, 1 AS least FROM pieces
    UNION ALL
    SELECT conv_id, position, level,
           unnest(list_concat(string_split_regex(whole, '\n[ \t]*(?:\n[ \t]*)+'), string_split(whole, chr(10)))), 8
    FROM pieces),
plain AS (
    SELECT conv_id, position, level, least,
           translate(trim(regexp_replace(part, '[\x20\x09-\x0D]+', ' ', 'g'), ' '),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS p
    FROM cut),
passages AS (SELECT DISTINCT conv_id, position, level, p FROM plain WHERE length(p) >= least),
writers AS (
    SELECT conv_id, p, min(position) AS writer FROM passages WHERE level = 0 GROUP BY conv_id, p),
links AS (
    SELECT conv_id, q.position, level, writer FROM passages q JOIN writers w USING (conv_id, p)
    WHERE level > 0 AND writer < q.position),
best AS (
    SELECT conv_id, position, first(writer ORDER BY level, writer DESC) AS quoted, count(DISTINCT level) AS n_linked
    FROM links GROUP BY conv_id, position),
counts AS (
    SELECT conv_id, position, count(*) AS n_quotes FROM quotes GROUP BY conv_id, position),
told AS (
    SELECT o.conv_id, turn, role, o.position, content, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked,
           coalesce(quoted, CASE WHEN o.position > 0 THEN o.position - 1 END) AS reply_to
    FROM owned o LEFT JOIN best b ON o.conv_id = b.conv_id AND o.position = b.position
         LEFT JOIN counts c ON o.conv_id = c.conv_id AND o.position = c.position),
follows AS (
    SELECT conv_id, reply_to, min(position) AS position FROM told WHERE reply_to IS NOT NULL GROUP BY conv_id, reply_to),
threads AS (
    SELECT conv_id, position, position AS thread, 0 AS seq FROM told t
    WHERE NOT EXISTS (SELECT 1 FROM follows f WHERE f.conv_id = t.conv_id AND f.position = t.position)
    UNION ALL
    SELECT f.conv_id, f.position, thread, seq + 1
    FROM threads t JOIN follows f ON f.conv_id = t.conv_id AND f.reply_to = t.position)
SELECT conv_id, turn, role, position, reply_to, thread, seq, n_quotes, n_linked, content
FROM told JOIN threads USING (conv_id, position)""",
    "op9_url_filters": r"""
WITH RECURSIVE parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
ruled AS (
    SELECT page_id, host, path,
           CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
           string_split(regexp_replace(regexp_replace(translate(path,
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '/+', '/', 'g'), '^/|/$', '', 'g'), '/') AS raw
    FROM parts),
judged AS (
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS said,
           CASE WHEN said IS NOT NULL THEN said
                WHEN regexp_matches(host, '(?:^|[.-])(?:ads|adult|bets|casino|pills|porn|spam)(?:[.-]|$)') THEN 'block' END AS label,
           [CASE WHEN regexp_full_match(s, '[0-9]+([.][a-z]+)?') THEN '{num}' || regexp_extract(s, '([.][a-z]+)?$')
                 WHEN regexp_full_match(s, '[0-9a-f]{8,}(-[0-9a-f]{4,})*([.][a-z]+)?') AND regexp_matches(s, '^[a-f]*[0-9]')
                 THEN '{hex}' || regexp_extract(s, '([.][a-z]+)?$')
                 WHEN regexp_full_match(s, '[^/.]*[0-9][^/.]*([.][a-z]+)?') THEN '{id}' || regexp_extract(s, '([.][a-z]+)?$')
                 ELSE s END FOR s IN raw] AS typed
    FROM ruled),
paths AS (
    SELECT host, typed, count(*) AS n, count(label) AS labelled, count(*) FILTER (WHERE label = 'block') AS bad
    FROM judged GROUP BY host, typed),
-- From the roots down: the children of a crowded node become wildcards before their own children are counted.
levels AS (
    SELECT host, typed, CAST([] AS VARCHAR[]) AS done FROM paths
    UNION ALL
    SELECT host, typed,
           list_append(done, CASE WHEN count(DISTINCT seg) OVER w > 16 OR bool_or(seg = '*') OVER w THEN '*' ELSE seg END)
    FROM (SELECT *, typed[len(done) + 1] AS seg FROM levels WHERE len(done) < len(typed))
    WINDOW w AS (PARTITION BY host, done)),
general AS (
    SELECT host, typed, n, labelled, bad, done AS segs
    FROM levels JOIN paths USING (host, typed) WHERE len(done) = len(typed)),
nodes AS (
    SELECT host, typed, n, labelled, bad, pos, segs[pos] AS seg, segs[1:pos - 1] AS above, coalesce(segs[pos + 1], '') AS below
    FROM general, LATERAL (SELECT unnest(range(1, len(segs) + 1)) AS pos) t),
kinds AS (
    SELECT host, above, seg, CASE WHEN below = '' OR below[1] IN ('{', '*') THEN below ELSE 'literal' END AS kind,
           sum(n) AS n, sum(labelled) AS labelled, sum(bad) AS bad
    FROM nodes GROUP BY ALL),
looks AS (
    SELECT host, above, seg, list(kind ORDER BY kind) AS names, map_from_entries(list((kind, n))) AS per,
           sum(n) AS n, sum(labelled) AS labelled, sum(bad) AS bad
    FROM kinds GROUP BY host, above, seg),
pairs AS (
    SELECT a.host, a.above, a.seg AS x, b.seg AS y
    FROM looks a JOIN looks b ON a.host = b.host AND a.above = b.above AND a.seg < b.seg
    WHERE list_sum([abs(coalesce(a.per[k], 0) / a.n - coalesce(b.per[k], 0) / b.n) / 2
                    FOR k IN list_concat(a.names, [z FOR z IN b.names IF NOT list_contains(a.names, z)])]) <= 0.2::DOUBLE
      AND CASE WHEN a.labelled = 0 AND b.labelled = 0 THEN true
               WHEN a.labelled > 0 AND b.labelled > 0
               THEN abs(a.bad / a.labelled - b.bad / b.labelled)
                    <= 1.96::DOUBLE * sqrt((a.bad + b.bad) / (a.labelled + b.labelled)
                                           * (1 - (a.bad + b.bad) / (a.labelled + b.labelled)) * (1 / a.labelled + 1 / b.labelled))
               ELSE false END),
links AS (SELECT * FROM pairs UNION ALL SELECT host, above, y AS x, x AS y FROM pairs),
reach AS (
    SELECT host, above, seg AS x, seg AS y FROM looks
    UNION
    SELECT r.host, r.above, r.x, l.y FROM reach r JOIN links l ON r.host = l.host AND r.above = l.above AND r.y = l.x),
merged AS (
    SELECT host, above, x AS seg, min(y) AS name FROM reach GROUP BY host, above, x),
templates AS (
    SELECT host, typed, labelled, bad, '/' || array_to_string(list(name ORDER BY pos), '/') AS template
    FROM nodes JOIN merged USING (host, above, seg) GROUP BY host, typed, n, labelled, bad),
pure AS (
    SELECT host, template, (sum(bad)::DOUBLE + 0.8::DOUBLE) / (sum(labelled)::DOUBLE + 4) AS purity FROM templates GROUP BY host, template)
SELECT page_id, host, path, rule, template, purity,
       coalesce(said, CASE WHEN purity >= 0.8::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict
FROM judged JOIN templates USING (host, typed) JOIN pure USING (host, template)""",
    "op10_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, t.pos, string_split(coalesce(text, ''), chr(10))[t.pos] AS line
    FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos) t),
keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines),
shared AS (
    SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
    GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
    SELECT doc_id, pos, line, coalesce(doc_id <> keeper, false) AS dropped FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op11_benchmark_decontamination": r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS part
    FROM item_words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) t WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
runs AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS part
    FROM texts, lengths, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) t),
found AS (
    SELECT doc_id, i, r.n, item_id FROM runs r JOIN windows v ON r.n = v.n AND r.part = v.part),
hits AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, LATERAL (SELECT unnest(range(0, n)) AS k) t GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
    # CRC-32 bit by bit over the bytes, from their hexadecimal digits.
    "op12_importance_resampling": r"""
WITH texts AS (
    SELECT doc_id, 0 AS side, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL
    SELECT item_id, 1, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
used AS (
    SELECT doc_id, side, f, count(*) AS n
    FROM (SELECT doc_id, side, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM texts)
    GROUP BY doc_id, side, f),
hashed AS (
    SELECT f, (4294967295 - list_reduce(
                  list_concat([4294967295::BIGINT], [('0x' || h[2 * i + 1:2 * i + 2])::BIGINT FOR i IN range(length(h) // 2)]),
                  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
                                           lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) % 10000 AS bucket
    FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM used))),
counts AS (
    SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE side = 1), 0)::DOUBLE AS t
    FROM used JOIN hashed USING (f) GROUP BY bucket),
sums AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain FROM counts, sums),
weights AS (
    SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
    FROM used JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id),
scored AS (
    SELECT doc_id, len(w) >= 20 AS eligible, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                           / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM texts LEFT JOIN weights USING (doc_id) WHERE side = 0),
ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE eligible)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= 25 * (SELECT count(*) FROM ranked) // 100 THEN CAST(rank AS BIGINT) END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)""",
    # One list of digests for each group and level; a node's siblings are the rest of its pair.
    "op13_merkle_manifest": r"""
WITH RECURSIVE rows AS (
    SELECT doc_id, lang, source, n_chars, text, n_chars + CASE WHEN (4294967295 - list_reduce(
               list_concat([4294967295::BIGINT], [ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
               lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
                                        lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) % 7 = 0 THEN 1 ELSE 0 END AS other
    FROM documents),
parts AS (
    SELECT doc_id, lang,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') AS head,
           coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars, coalesce(strlen(other::VARCHAR) || ':' || other, '-') AS changed,
           coalesce(strlen(text) || ':' || text, '-') AS tail
    FROM rows),
leaves AS (
    SELECT doc_id, lang, sha256(head || chars || tail) AS leaf, sha256(head || changed || tail) AS changed,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
    FROM parts),
levels AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM leaves GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, [sha256(array_to_string(nodes[2 * i + 1:2 * i + 2], '')) FOR i IN range((len(nodes) + 1) // 2)]
    FROM levels WHERE len(nodes) > 1),
subroots AS (
    SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM levels WHERE len(nodes) = 1),
tops AS (
    SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
    UNION ALL
    SELECT level + 1, [sha256(array_to_string(nodes[2 * i + 1:2 * i + 2], '')) FOR i IN range((len(nodes) + 1) // 2)]
    FROM tops WHERE len(nodes) > 1),
steps AS (
    SELECT doc_id, level, pos >> level AS node, nodes
    FROM leaves JOIN levels ON leaves.lang IS NOT DISTINCT FROM levels.lang WHERE len(nodes) > 1
    UNION ALL
    SELECT doc_id, 1000 + level, place >> level, nodes
    FROM leaves JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang, tops WHERE len(nodes) > 1),
sides AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS step,
           CASE WHEN node % 2 = 1 THEN nodes[node] ELSE '' END AS before, CASE WHEN node % 2 = 0 THEN coalesce(nodes[node + 2], '') ELSE '' END AS after
    FROM steps),
proofs AS (SELECT doc_id, string_agg(before || after, '' ORDER BY step) AS proof FROM sides GROUP BY doc_id),
folds AS (
    SELECT doc_id, 0::BIGINT AS step, changed AS digest FROM leaves
    UNION ALL
    SELECT f.doc_id, s.step, sha256(before || digest || after) FROM folds f JOIN sides s ON s.doc_id = f.doc_id AND s.step = f.step + 1),
folded AS (SELECT doc_id, arg_max(digest, step) AS folded_root FROM folds GROUP BY doc_id),
top AS (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang JOIN folded USING (doc_id) LEFT JOIN proofs USING (doc_id), top""",
}
