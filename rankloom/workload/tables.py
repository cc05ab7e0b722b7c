"""Views of the given tables shared by several queries, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.functions.markup import element_text, strip_html
from rankloom.session import prepare

AS_OF = "2024-06-30 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def passages(spark, sf_dir) -> DataFrame:
    """Every benchmark passage as a query."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def page_documents(spark, sf_dir) -> DataFrame:
    """Pages as documents: ``id, title, body, url``."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"),
        element_text("html", "title").alias("title"),
        strip_html("html").alias("body"),
        "url",
    )


def path_tags(url="url"):
    """The parts of a page's path, as its tags."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[^:]*://[^/]*", ""), r"[?#].*$", "")
    return F.array_remove(F.split(path, "/"), "")


# The path itself: its words are those of the tags.
PATH_TAGS_SQL = "regexp_replace(regexp_replace(url, '^[^:]*://[^/]*', ''), '[?#].*$', '')"


def words_sql(text: str) -> str:
    return rf"regexp_extract_all(lower(coalesce({text}, '')), '[\p{{L}}\p{{N}}]+')"


def strip_sql(markup: str) -> str:
    """Visible text, for the character references that occur in ``pages``."""
    text = markup
    for pattern in (
        r"(?s)<!--.*?-->",
        r"(?is)<script\b[^>]*>.*?</script\s*>",
        r"(?is)<style\b[^>]*>.*?</style\s*>",
        r"<[a-zA-Z/!?][^>]*>",
    ):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    for name, value in (
        ("middot", "·"), ("copy", "©"), ("quot", '"'), ("nbsp", " "), ("lt", "<"), ("gt", ">"), ("amp", "&"),
    ):
        text = f"replace({text}, '&{name};', '{value}')"
    return rf"trim(regexp_replace({text}, '[\s\x{{A0}}]+', ' ', 'g'))"


PAGE_DOCUMENTS_SQL = f"""
page_documents AS (
    SELECT page_id AS id,
           {strip_sql("'<i>' || regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) || '</i>'")} AS title,
           {strip_sql("html")} AS body,
           url
    FROM pages
)"""


def bm25_sql(
    source: str,
    id_col: str,
    fields: dict[str, tuple[str, float]],
    terms: str,
    term_sql: str = "term",
    prefix: str = "",
    factor: str = "",
) -> str:
    """CTEs ending in ``{prefix}scored(query_id, id, score, coverage)``.

    ``fields`` maps a field to its SQL text and weight, ``terms`` selects
    ``query_id, term, weight``, ``term_sql`` rewrites a document token.
    """
    p = prefix
    tokens = " UNION ALL ".join(
        f"SELECT {id_col} AS id, '{name}' AS field, {weight}::DOUBLE AS boost, {words_sql(text)} AS toks FROM {source}"
        for name, (text, weight) in fields.items()
    )
    return f"""
{p}doc_tokens AS ({tokens}),
{p}totals AS (
    SELECT field, count(*) AS n_docs, sum(len(toks))::DOUBLE / count(*) AS mean_len
    FROM {p}doc_tokens GROUP BY field
),
{p}post AS (
    SELECT id, field, boost, dl, {term_sql} AS term, count(*)::DOUBLE AS tf
    FROM (SELECT id, field, boost, len(toks) AS dl, unnest(toks) AS term FROM {p}doc_tokens)
    GROUP BY ALL
),
{p}freq AS (SELECT field, term, count(*) AS df FROM {p}post GROUP BY ALL),
{p}q AS ({terms}),
{p}gains AS (
    SELECT q.query_id, p.id,
           q.weight * p.boost * ln(1 + (t.n_docs - f.df + 0.5) / (f.df + 0.5)) AS gain,
           p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / t.mean_len)) AS part
    FROM {p}q q
    JOIN {p}post p ON p.term = q.term
    JOIN {p}freq f ON f.field = p.field AND f.term = p.term
    JOIN {p}totals t ON t.field = p.field
),
{p}scored AS (
    SELECT query_id, id, round(sum(gain * part){factor}, 6) AS score, sum(gain) AS coverage
    FROM {p}gains GROUP BY query_id, id
)"""


def ranked_sql(source: str, top: int | None, order: str = "score DESC, id", by: str = "query_id") -> str:
    """Rows of ``source`` with ``rank``, cut at ``top``."""
    cut = f" WHERE rank <= {top}" if top else ""
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS rank FROM {source}){cut})"


PASSAGE_TERMS_SQL = f"""
    SELECT query_id, term, count(*)::DOUBLE AS weight
    FROM (SELECT item_id AS query_id, unnest({words_sql('text')}) AS term FROM benchmark)
    GROUP BY ALL"""
