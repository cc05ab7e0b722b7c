"""The registered queries of the training-data operators and the SQL some are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.llm import containment, licenses, lines, mixing, parity, quality, rtree, runs, secrets, sharding, suffixes, urls, warc
from rankloom.session import prepare, scratch_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# The characters 0x20 and 0x09-0x0D (fixed values) as SQL.
_SPACES_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER_SQL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words_sql(text: str) -> str:
    return rf"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"


@_query
def op1_line_dedup(spark, sf_dir):
    kept = lines.deduplicate_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op1_line_dedup"] = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
numbered AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
),
keyed AS (
    SELECT doc_id, pos, line, {_LOWER_SQL.format(f"trim(line, {_SPACES_SQL})")} AS key FROM numbered
),
firsts AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) > 1
),
marked AS (
    SELECT doc_id, pos, line, coalesce(doc_id > first, false) AS dropped FROM keyed LEFT JOIN firsts USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@_query
def op3_warc_reassembly(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_records(spark, path)


# 160 bits as 8 groups of 20, each four letters of base 32
_BASE32_SQL = """array_to_string(list_transform(range(0, 40, 5), lambda g:
    array_to_string(list_transform([32768, 1024, 32, 1], lambda d:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(h, g + 1, 5))::BIGINT // d) % 32)::INT, 1)), '')), '')"""

ORACLE["op3_warc_reassembly"] = f"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT html, min(page_id) AS first FROM hashed GROUP BY html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_BASE32_SQL} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, NULL AS problem
FROM hashed JOIN firsts USING (html)"""


@_query
def op5_hilbert_shards(spark, sf_dir):
    return sharding.hilbert_shards(table(spark, sf_dir, "documents"))


@_query
def op6_quality_ledger(spark, sf_dir):
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    return rows.withColumns(
        {
            "base_failed": quality.fails(quality.POLICIES["base"]),
            "kept": ~quality.fails(quality.POLICIES[quality.CURRENT]),
        }
    )


_RULES_SQL = " + ".join(
    f"CASE WHEN {condition} THEN {1 << bit} ELSE 0 END" for bit, condition in enumerate(quality.RULES.values())
)
_SHOUTED_SQL = quality.SHOUTED
_MEASURES_SQL = f"""
worded AS (SELECT doc_id, coalesce(text, '') AS text, {_words_sql('text')} AS words FROM documents),
windows AS (
    SELECT doc_id, i, words[i : i + 4] AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM worded)
),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM again, range(5) AS r(j) GROUP BY doc_id
),
measured AS (
    SELECT doc_id, len(words) AS n_words,
           coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls,
           len(list_filter(words, lambda w: regexp_matches(w, '\\p{{L}}'))) AS n_letter_words,
           len(list_filter(words, lambda w: regexp_matches(w, '{_SHOUTED_SQL}'))) AS n_shouted_words
    FROM worded
),
ledger AS (
    SELECT doc_id, n_words, word_chars, n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_word_lines, n_letter_words, n_shouted_words
    FROM measured LEFT JOIN covered USING (doc_id)
)"""
ORACLE["op6_quality_ledger"] = f"""
WITH {_MEASURES_SQL},
judged AS (SELECT *, ({_RULES_SQL})::BIGINT AS fail_bits FROM ledger)
SELECT *, fail_bits & {quality.POLICIES['base'].bits} <> 0 AS base_failed,
       fail_bits & {quality.POLICIES[quality.CURRENT].bits} = 0 AS kept
FROM judged"""


def _shingle_sets_sql(name: str, source: str, id_col: str) -> str:
    """CTE ``name(id, s)``: the distinct five-word shingles of each row of ``source``."""
    return f"""
{name}_words AS (SELECT {id_col} AS id, {_words_sql(_LOWER_SQL.format('text'))} AS w FROM {source}),
{name} AS (
    SELECT id, CASE WHEN len(w) >= 5
        THEN list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM {name}_words
)"""


@_query
def op7_benchmark_containment(spark, sf_dir):
    found = containment.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared")


ORACLE["op7_benchmark_containment"] = f"""
WITH {_shingle_sets_sql('d', 'documents', 'doc_id')},
{_shingle_sets_sql('b', 'benchmark', 'item_id')},
items AS (SELECT id AS item_id, len(s) AS n_item, unnest(s) AS h FROM b),
held AS (SELECT id AS doc_id, unnest(s) AS h FROM d)
SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM held JOIN items USING (h)
GROUP BY ALL HAVING count(*) * 100 >= n_item * {containment.PERCENT}"""


@_query
def op8_parity_jaccard(spark, sf_dir):
    return parity.jaccard_components(table(spark, sf_dir, "documents"))


ORACLE["op8_parity_jaccard"] = f"""
WITH RECURSIVE {_shingle_sets_sql('d', 'documents', 'doc_id')},
held AS (SELECT id, len(s) AS n, unnest(s) AS h FROM d),
links AS (
    SELECT x.id AS a, y.id AS b FROM held x JOIN held y ON x.h = y.h AND x.id <> y.id
    GROUP BY x.id, y.id, x.n, y.n HAVING count(*) * 100 >= (x.n + y.n - count(*)) * {parity.PERCENT}
),
reach AS (SELECT id AS a, id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT id AS doc_id, len(s) AS n_shingles, component_id,
       CASE WHEN len(s) = 0 THEN id ELSE min(id) OVER (PARTITION BY s) END AS class_id
FROM d JOIN lowest ON id = a"""


@_query
def op2_soft_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


@_query
def op4_url_models(spark, sf_dir):
    return urls.judged_urls(table(spark, sf_dir, "pages"))


@_query
def op10_secret_models(spark, sf_dir):
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    base = secrets.span_list(F.col("base"))
    return found.select(
        "doc_id",
        *(secrets.kind_count(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(base, 256).alias("base_sha256"),
        secrets.span_list(F.array_sort(F.concat("base", "markov"))).alias("spans"),
        F.size("markov").cast("long").alias("n_markov"),
    )


@_query
def op9_suffix_repeats(spark, sf_dir):
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


ORACLE["op9_suffix_repeats"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (
    SELECT doc_id, p, md5(substr(x, 2 * p + 1, 100)) AS s
    FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS p FROM d)
),
later AS (SELECT doc_id, p FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY s)),
stretches AS (
    SELECT doc_id, p, p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -100) + 50 AS fresh FROM later
),
numbered AS (
    SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM stretches
),
spans AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY ALL),
gaps AS (
    SELECT doc_id, k, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
),
cut AS (
    SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
           string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(max(x), 2 * max(b) + 1) AS kept
    FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every tenth document, by a hash of its id, repeats a stretch of its words to its end."""
    docs = docs.withColumn("h", F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = docs.select("doc_id", "text", words.alias("w"), F.expr("h div 10").alias("g"))
    docs = docs.withColumn("n", F.size("w")).withColumn("a", F.expr("if(n > 0, int(g % n), 0)"))
    docs = docs.withColumn("times", (F.col("g") % 8 + 3).cast("int"))
    docs = docs.withColumn("p", F.expr("int(1 + (n - a) div times)"))
    stretch = F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.col("times"))
    words = F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), F.flatten(stretch)), F.lit(1), F.col("n"))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


@_query
def op11_grammar_runs(spark, sf_dir):
    found = runs.periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    # the runs come by start, then period, so of equal exponents the first one stays
    best = F.expr(
        "aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>),"
        " (b, r) -> if(b is null or r.length * b.period > b.length * r.period, r, b))"
    )
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n")))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}") for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query
def op12_license_rules(spark, sf_dir):
    found = licenses.license_detections(table(spark, sf_dir, "documents"))
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return found.withColumns(joined | {"n_detections": F.size("detections").cast("long")}).drop("detections")


_LICENSE_RULES_SQL = ", ".join(
    f"({k}, '{r.label}', '{r.regex}', {r.priority}, {r.strength}::DOUBLE)" for k, r in enumerate(licenses.RULES)
)
ORACLE["op12_license_rules"] = rf"""
WITH rules(rule, label, regex, priority, strength) AS (VALUES {_LICENSE_RULES_SQL}),
texts AS (
    SELECT doc_id, row_number() OVER () AS row,
           regexp_replace({_LOWER_SQL.format("coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g') AS joined
    FROM documents
),
spaced AS (SELECT doc_id, row, ' ' || trim(joined, ' ') || ' ' AS s, regexp_extract_all(joined, '[^ ]+') AS w FROM texts),
phrases(label, p) AS (
    VALUES ('mit', ['under', 'the', 'mit', 'license']), ('apache-2', ['apache', 'license', 'version', '2']),
           ('cc-by-nc', ['cc', 'by', 'nc'])
),
places AS (
    SELECT row, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1 : i + len(p)] = p)) AS pos
    FROM spaced CROSS JOIN phrases
),
base AS (
    SELECT row, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY row
),
matched AS (
    SELECT row, rule, label, priority, strength, regexp_extract_all(s, regex) AS found, string_split_regex(s, regex) AS gaps
    FROM spaced CROSS JOIN rules WHERE regexp_matches(s, regex)
),
numbered AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matched),
spans AS (
    SELECT row, rule, label, priority, strength, b, b + length(found[i]) AS e
    FROM (
        SELECT *, list_sum(list_transform(gaps[:i], lambda g: length(g)))
                  + coalesce(list_sum(list_transform(found[: i - 1], lambda m: length(m))), 0) AS b
        FROM numbered
    )
),
kept AS (
    SELECT * FROM spans x WHERE NOT EXISTS (
        FROM spans y WHERE y.row = x.row AND y.b <= x.b AND y.e >= x.e AND y.priority >= x.priority
        AND (y.e - y.b > x.e - x.b OR y.priority > x.priority OR y.rule < x.rule)
    )
),
by_label AS (
    SELECT row, label, max(strength) AS strength
    FROM (SELECT row, label, strength FROM kept UNION ALL SELECT row, label, 0.95 FROM places) GROUP BY ALL
),
scores AS (
    SELECT row, string_agg(label, ',' ORDER BY label) AS labels, round(1 - product(1 - strength), 6) AS score
    FROM by_label GROUP BY row
),
counts AS (SELECT row, count(*) AS n_detections FROM kept GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score,
       coalesce(n_detections, 0) AS n_detections
FROM spaced LEFT JOIN base USING (row) LEFT JOIN scores USING (row) LEFT JOIN counts USING (row)"""


@_query
def op13_rtree_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return rtree.hard_negatives(rows, F.col("vec_id") % 50 == 0)


ORACLE["op13_rtree_negatives"] = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank, id AS negative_id,
       positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""
