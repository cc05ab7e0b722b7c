"""Curated answers: trigger phrases pinned to one page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from rankloom.functions.text import lookup_keys

ENTRY = "struct<triggers array<string>, id string, title string, url string, note string>"
BETS_COLUMNS = "entry_pos int, trigger_pos int, trigger string, id string, title string, url string, note string"


def parse_best_bets(texts: DataFrame, text: str = "value") -> DataFrame:
    """One row per trigger, in list order; entries that are no objects are skipped."""
    entries = F.from_json(F.col(text), "struct<entries array<variant>>")["entries"]
    return (
        texts.select(F.posexplode(entries).alias("entry_pos", "entry"))
        .where(F.schema_of_variant("entry").startswith("OBJECT"))
        .select("entry_pos", F.from_json(F.to_json("entry"), ENTRY).alias("e"))
        .select("entry_pos", "e.*")
        .select(
            "entry_pos",
            F.posexplode("triggers").alias("trigger_pos", "trigger"),
            "id",
            "title",
            "url",
            F.coalesce("note", F.lit("")).alias("note"),
        )
    )


def read_best_bets(spark: SparkSession, path: str) -> DataFrame:
    """Best bets of a JSON file; a missing file gives an empty table."""
    from pyspark.errors import AnalysisException

    try:
        texts = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BETS_COLUMNS)
    return parse_best_bets(texts)


def bet_keys(bets: DataFrame) -> DataFrame:
    """One row per lookup key; the last entry that claims a key keeps it."""
    keyed = bets.select("*", F.explode(lookup_keys("trigger")).alias("key"))
    latest = F.struct("entry_pos", "trigger_pos", "id", "title", "url", "note")
    return (
        keyed.groupBy("key")
        .agg(F.max_by(latest, F.struct("entry_pos", "trigger_pos")).alias("bet"))
        .select("key", "bet.entry_pos", "bet.id", "bet.title", "bet.url", "bet.note")
    )
