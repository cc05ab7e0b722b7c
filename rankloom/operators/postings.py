"""Term postings of documents.

Texts are read once and never shuffled: tokens are counted in the task that reads
them, and only the counts of a document's terms move. A table of postings that is laid
out by document (see :func:`save_postings`) is searched without any shuffle of pairs.

Every document carries one posting of the empty term per field, so one pass over
the postings gives document frequencies, the number of documents and the total
field length.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rankloom.functions.text import _col, tokens

WHOLE = ""  # the empty term


def document_postings(
    docs: DataFrame,
    fields: Mapping[str, Column | str],
    id_col: str = "id",
    term_of: Callable[[Column], Column] | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """One row per ``id, field, term`` with term frequency and field length.

    ``fields`` maps a field name to its text; ``term_of`` rewrites a token, for
    example to its stem. With ``wanted(term)`` only postings of these terms are made.
    """
    return (
        restrict_terms(document_terms(docs, fields, id_col, term_of), wanted)
        .groupBy("id", "field", "len", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def held_terms(docs, fields, id_col="id") -> DataFrame:
    """One row per term a row of ``docs`` holds in a field: ``id, field, len, term``.

    Made where the row is read, without the frequencies of :func:`document_postings`.
    """
    return _split_fields(docs, fields, id_col).select(
        "id", "field", (F.size("toks") - 1).alias("len"), F.explode_outer(F.array_distinct("toks")).alias("term")
    )


def document_terms(docs, fields, id_col="id", term_of=None) -> DataFrame:
    """One row per token occurrence: ``id, field, len, term``."""
    terms = _split_fields(docs, fields, id_col).select(
        "id", "field", (F.size("toks") - 1).alias("len"), F.explode_outer("toks").alias("term")
    )
    if term_of is not None:
        terms = terms.withColumn("term", term_of(F.col("term")))
    return terms


def _split_fields(docs, fields, id_col) -> DataFrame:
    """``id, field, toks``: the tokens of every field and the empty term."""
    base = docs.select(
        F.col(id_col).alias("id"), *[_col(v).alias(f"_{name}") for name, v in fields.items()]
    )
    # explode_outer: the arrays are never empty, and the plain explode would
    # tokenise a second time in a filter below.
    with_whole = {
        name: F.concat(tokens(f"_{name}"), F.array(F.lit(WHOLE))) for name in fields
    }
    if len(fields) == 1:
        (name,) = fields
        return base.select("id", F.lit(name).alias("field"), with_whole[name].alias("toks"))
    return base.select(
        "id",
        F.inline_outer(
            F.array(
                *[
                    F.struct(F.lit(name).alias("field"), toks.alias("toks"))
                    for name, toks in with_whole.items()
                ]
            )
        ),
    )


def restrict_terms(terms: DataFrame, vocabulary: DataFrame | None) -> DataFrame:
    """Only rows of the given terms; all rows where no ``vocabulary(term)`` is given."""
    return terms if vocabulary is None else terms.join(vocabulary, "term", "left_semi")


def term_statistics(postings: DataFrame) -> DataFrame:
    """``field, term, df, total_len`` summed over the documents."""
    return postings.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("len").alias("total_len")
    )


def vocabulary(docs: DataFrame, fields, id_col: str = "id", term_of=None) -> DataFrame:
    """Distinct terms with the number of documents that hold them: ``term, df``.

    Terms are made distinct per document before counting, so a term in a third of
    all documents adds one row per map task.
    """
    words = F.concat(*[tokens(v) for v in fields.values()])
    if term_of is not None:
        words = F.transform(words, term_of)
    # explode_outer for the reason given above.
    terms = docs.select(F.explode_outer(F.array_distinct(words)).alias("term"))
    return (
        terms.where(F.col("term").isNotNull()).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    )


def corpus_totals(docs: DataFrame, fields) -> DataFrame:
    """One row: number of documents, and total tokens per field."""
    return docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.size(tokens(v))).alias(f"{name}_tokens") for name, v in fields.items()],
    )


def save_postings(postings: DataFrame, table: str, path: str, buckets: int) -> None:
    """Store postings bucketed by document and sorted by term.

    Read back with ``spark.table``, the buckets give the layout above without a
    shuffle, and the sort lets Parquet skip row groups without the asked terms.
    """
    (
        postings.write.mode("errorifexists")
        .option("path", path)
        .bucketBy(buckets, "id")
        .sortBy("term")
        .saveAsTable(table)
    )


def load_postings(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
