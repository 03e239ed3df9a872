"""Registered queries of this subpackage, and equivalent SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from . import chat, classifier, decontaminate, jaccard, licences, mixing, periodic_runs, prefix_trie, quality_rules, simhash, suffix_dedup, token_counts, token_files
from .common import space_words, table
from .license_texts import listed

RUNS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def call(spark: SparkSession, folder: str) -> DataFrame:
        return run(tune(spark), folder)

    RUNS[run.__name__] = call
    return run


@query
def op1_simhash(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, bits=3)
    return found.select("doc_id", simhash.hex_digits("fingerprint").alias("fingerprint"), "component_id")


@query
def op2_token_counts(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query
def op3_licences(spark, folder):
    return licences.licence_scan(table(spark, folder, "documents"))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(expression: str) -> str:
    form = f"' ' || regexp_replace(lower(line), '{licences.GAPS}', ' ', 'g') || ' '"
    for one, other in licences.SPELLINGS:
        form = f"replace({form}, '{one}', '{other}')"
    whole = f"regexp_replace(part, {_text(licences.INLINE)}, ' \\1', 'g')"
    statement = f"regexp_matches(line, {_text(licences.SIGNED)}) OR regexp_matches(line, {_text(licences.HELD)}) AND NOT regexp_matches(line, {_text(licences.WORDED)})"
    lines = f"[{whole} for part in string_split(coalesce({expression}, ''), chr(10))]"
    return f"[x for x in [trim(regexp_replace({form}, ' +', ' ', 'g')) for line in {lines} if NOT ({statement})] if x <> '']"


SQL["op3_licences"] = f"""
    WITH listed(license_id, text) AS (VALUES {", ".join(f"({_text(n)}, {_text(t)})" for n, t in listed())}),
    known AS (SELECT sha256(array_to_string({_canonical("text")}, ' ')) AS digest, min(license_id) AS license_id FROM listed GROUP BY 1),
    d AS (SELECT row_number() OVER () AS row, doc_id, {_canonical("text")} AS lines FROM documents),
    t AS (SELECT row, doc_id, CAST(len(lines) AS BIGINT) AS n_lines, sha256(array_to_string(lines, ' ')) AS text_sha256, lines FROM d),
    named AS (SELECT row, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
              FROM (SELECT row, sha256(unnest(lines)) AS digest FROM t) JOIN known USING (digest) GROUP BY row)
    SELECT t.doc_id, n_lines, text_sha256, license_id, coalesce(notices, '') AS notices
    FROM t LEFT JOIN known ON t.text_sha256 = known.digest LEFT JOIN named USING (row)
"""


@query
def op4_chat(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    odd = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(odd)))


_SAFE = r"replace(replace(replace({}, '\', '\\'), '<', '\l'), chr(10), '\n')"
SQL["op4_chat"] = f"""
    WITH r AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, t, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(t, r))
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(15 + length({_SAFE.format("role")}) + length({_SAFE.format("text")})) AS BIGINT) AS formatted_chars
    FROM r GROUP BY conv_id
"""


@query
def op5_mixing(spark, folder):
    drawn = mixing.mix(table(spark, folder, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return drawn.select("doc_id", "size", "source_size", "target", (F.size("shards") * F.col("size")).alias("taken"), "shards")


@query
def op6_token_files(spark, folder):
    return token_files.token_files(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)


@query
def op7_quality_rules(spark, folder):
    return quality_rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _rules_sql() -> str:
    q = quality_rules
    share = {rule: f"CASE WHEN {whole} > 0 THEN floor(1000 * {part} / ({weight} * {whole})) ELSE 0 END" for rule, (part, whole, weight) in q.RULES.items()}
    worst = f"greatest({', '.join(share.values())})"
    tests = ", ".join(f"({c})" for c in q.CUTOFFS)
    spaces = "[\\x20\\x09-\\x0D]+"
    return f"""
    WITH d AS (
        SELECT doc_id, lang AS stratum, coalesce(text, '') AS text,
               [w for w in regexp_split_to_array(coalesce(text, ''), '{spaces}') if w <> ''] AS words,
               [l for l in string_split(coalesce(text, ''), chr(10)) if regexp_matches(l, '[^\\x20\\x09-\\x0D]')] AS lines FROM documents),
    w AS (SELECT doc_id, p, list_slice(words, p, p + 4) AS five FROM d, UNNEST(range(1, len(words) - 3)) AS t(p)),
    twice AS (SELECT doc_id, p FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
    covered AS (SELECT doc_id, count(DISTINCT q) AS n FROM twice, UNNEST(range(p, p + 5)) AS t(q) GROUP BY doc_id),
    m AS (
        SELECT doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
               CAST(len(lines) AS BIGINT) AS n_lines, CAST(length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_capitals
        FROM d LEFT JOIN covered USING (doc_id)),
    f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
    marks AS (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id HAVING min(quality) = max(quality)),
    labelled AS (SELECT f.*, quality = 1 AS good FROM f JOIN marks USING (doc_id) WHERE NOT base_failed),
    sized AS (SELECT *, count(*) OVER () AS strata FROM (
        SELECT stratum, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS n_bad FROM labelled GROUP BY stratum) WHERE n > 0),
    tested AS (
        SELECT g.stratum, cutoff, count(*) FILTER (good AND {worst} > cutoff) AS k, count(*) FILTER (NOT good AND {worst} > cutoff) AS k_bad
        FROM labelled g, (VALUES {tests}) AS t(cutoff) GROUP BY ALL),
    tails AS (
        SELECT t.*, k_bad * n - k * greatest(n_bad, 1) AS gap,
               k < n * {q.RISK} AND list_sum([exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({q.RISK}) + (n - j) * ln(1 - {q.RISK}))
               for j in range(0, k + 1)]) <= {q.DOUBT} / strata AS passed
        FROM tested t JOIN sized s ON t.stratum IS NOT DISTINCT FROM s.stratum),
    chosen AS (
        SELECT stratum, cutoff FROM tails t
        WHERE NOT EXISTS (SELECT 1 FROM tails u WHERE u.stratum IS NOT DISTINCT FROM t.stratum AND u.cutoff >= t.cutoff AND NOT u.passed)
        QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY gap DESC, cutoff DESC) = 1)
    SELECT f.*, NOT base_failed AND NOT coalesce({worst} > cutoff, false) AS kept
    FROM f LEFT JOIN chosen c ON f.stratum IS NOT DISTINCT FROM c.stratum
    """


SQL["op7_quality_rules"] = _rules_sql()


@query
def op8_suffix_dedup(spark, folder):
    found = suffix_dedup.without_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s.stop - s.start)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_quality(spark, folder):
    return classifier.scores(table(spark, folder, "documents"), table(spark, folder, "labels"), limit=0.3)


@query
def op10_decontaminate(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=13)


SQL["op10_decontaminate"] = """
    WITH d AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
    i AS (
        SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark WHERE item_id IS NOT NULL),
    v AS (
        SELECT DISTINCT item, list_slice(words, p, p + least(13, len(words)) - 1) AS w
        FROM i, UNNEST(range(1, greatest(1, len(words) - 12) + 1)) AS t(p) WHERE len(words) > 0),
    sizes AS (SELECT DISTINCT len(w) AS n FROM v),
    grams AS (
        SELECT doc_id, p, list_slice(words, p, p + n - 1) AS w, n
        FROM d, sizes, UNNEST(range(1, len(words) - n + 2)) AS t(p)),
    hits AS (SELECT g.doc_id, g.p, g.n, v.item FROM grams g JOIN v ON g.w = v.w),
    covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, UNNEST(range(p, p + n)) AS t(q) GROUP BY doc_id),
    named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.words) AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op11_jaccard(spark, folder):
    found = jaccard.similar_sets(table(spark, folder, "documents"), shingle=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


_SPACES = "[\\x20\\x09-\\x0D]+"
SQL["op11_jaccard"] = f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '{_SPACES}'), lambda w: w <> '') AS words FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(words, p, p + least(4, len(words)) - 1), ' ') AS g
          FROM d, UNNEST(range(1, greatest(1, len(words) - 3) + 1)) AS t(p) WHERE len(words) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    link AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""


@query
def op12_prefix_trie(spark, folder):
    turns = prefix_trie.numbered(table(spark, folder, "conversations"))
    ids = table(spark, folder, "conversations").filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    heads = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % 9).alias("shared"))
    return prefix_trie.trie(prefix_trie.with_shared_beginnings(turns, heads, most=8), ids)


SQL["op12_prefix_trie"] = """
    WITH crc_table AS (
        SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
        FROM range(256) AS r(b)),
    own AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
        SELECT conv_id, conv_id - conv_id % 5 AS base,
               xor(list_reduce([ord(x) for x in string_split(CAST(conv_id AS VARCHAR), '')],
                   lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM own), crc_table),
    rebuilt AS (
        SELECT c.conv_id, row_number() OVER (PARTITION BY c.conv_id ORDER BY pos) AS d, role, text
        FROM convs c JOIN own o ON (o.conv_id = c.base AND pos <= h) OR (o.conv_id = c.conv_id AND pos > h)),
    path AS (
        SELECT conv_id, d, sha256(array_to_string(list(sha256(strlen(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY d), '')) AS node, strlen(text) AS bytes
        FROM rebuilt UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
    placed AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY d) AS parent, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM path),
    node AS (
        SELECT node, min(conv_id) AS conv_id, min(d) AS depth, min(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS own,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM placed GROUP BY node),
    kids AS (SELECT parent AS node, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent),
    totals AS (
        SELECT p.node, count(*) FILTER (k.n IS NULL) AS n_leaves, CAST(sum(x.own) AS BIGINT) AS saved_tokens
        FROM node x JOIN path p ON p.conv_id = x.conv_id AND p.d <= x.depth LEFT JOIN kids k ON k.node = x.node GROUP BY p.node)
    SELECT x.conv_id, x.depth, above.conv_id AS parent_conv_id, x.n_convs, coalesce(k.n, 0) AS n_children, n_leaves, saved_tokens, x.ends_sha256
    FROM node x JOIN totals USING (node) LEFT JOIN kids k USING (node) LEFT JOIN node above ON above.node = x.parent
"""


def _made_periodic(docs: DataFrame) -> DataFrame:
    """Texts of documents whose hash ends in 0 go on from some word with a period; the others stay as they are."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    turn = F.floor(hashed / 10)
    rows = docs.select("doc_id", "text", hashed.alias("h"), turn.alias("g"), F.when(hashed % 10 == 0, space_words("text")).alias("words"))
    n = F.size("words").cast("long")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    p = F.lit(1).cast("long") + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))
    rows = rows.withColumn("p", p)
    cycle = F.flatten(F.array_repeat(F.expr("slice(words, int(a) + 1, int(p))"), F.ceil((n - F.col("a")) / F.col("p")).cast("int")))
    tail = F.slice(cycle, F.lit(1), (n - F.col("a")).cast("int"))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), tail), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark, folder):
    found = periodic_runs.find_runs(_made_periodic(table(spark, folder, "documents")))
    best = F.col("strongest")
    line = lambda r: F.concat_ws(",", *(r[n].cast("string") for n in ("start", "length", "period")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
                        best["period"].alias("period"), F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
