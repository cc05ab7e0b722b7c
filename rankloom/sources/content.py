"""Content exports: JSON files of records, and landed delivery responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

DELIVERY_ITEM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("__typename", T.StringType()),
        T.StructField("url", T.StructType([T.StructField("path", T.StringType())])),
        T.StructField(
            "fields",
            T.ArrayType(
                T.StructType(
                    [T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]
                )
            ),
        ),
    ]
)
DELIVERY_PAGE = T.StructType([T.StructField("results", T.ArrayType(DELIVERY_ITEM))])


def parse_content(texts: DataFrame, text: str = "value", file: str = "file") -> DataFrame:
    """Records of JSON texts as ``file, pos, record`` with ``record`` a variant.

    A text is an array of records, an object whose ``value`` is an array of
    records, one record, or a record per line. Every record becomes a variant of
    its own, so the variant size limit applies per record and not per file.
    Malformed text, and anything that follows a whole value, fails the job.
    """
    value = F.col(text)

    def only(schema: str) -> Column:
        """The text as the single element of an array; null when more or less follows."""
        read = F.from_json(F.concat(F.lit("["), value, F.lit("]")), f"array<{schema}>")
        return F.when(F.size(read) == 1, read[0])

    lines = F.filter(F.split(value, r"\r?\n"), lambda line: line.rlike(r"\S"))
    by_line = F.from_json(F.concat(F.lit("["), F.array_join(lines, ","), F.lit("]")), "array<variant>")
    each = F.when((F.size(by_line) == F.size(lines)) & F.forall(lines, lambda line: line.rlike(r"^\s*\{")), by_line)
    one = only("variant")
    records = F.when(value.rlike(r"^\s*\["), only("array<variant>")).otherwise(
        F.coalesce(only("struct<value array<variant>>")["value"], F.when(one.isNotNull(), F.array(one)), each)
    )
    parsed = F.coalesce(records, F.raise_error(F.concat(F.lit("malformed JSON in "), F.col(file))))
    return texts.select(F.col(file).alias("file"), F.posexplode(parsed).alias("pos", "record"))


def read_content(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the ``*.json`` files directly in ``folder``.

    ``file`` and ``pos`` give the order in which the records appear; a missing
    folder is an error.
    """
    texts = (
        spark.read.option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "false")
        .text(folder, wholetext=True)
        .select("value", F.col("_metadata.file_name").alias("file"))
    )
    return parse_content(texts)


def delivery_items(pages: DataFrame) -> DataFrame:
    """One row per item of landed response pages."""
    return pages.select(F.inline("results"))


def read_delivery(spark: SparkSession, path: str) -> DataFrame:
    """Items of landed delivery responses (one JSON object per file)."""
    return delivery_items(spark.read.schema(DELIVERY_PAGE).json(path, multiLine=True, mode="FAILFAST"))
