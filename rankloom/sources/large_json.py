"""JSON exports of any size: one file is read by many tasks.

The text source cuts a file into splits and every split into pieces that end at a
closing brace. Whether a piece lies in a string, and how deep, follows from all pieces before
it. So a first pass sums up each split for both cases (starting inside or outside a string),
a running total over the splits of a file says how each one really starts, and a second
pass cuts it where an element of the outer array ends. Only the pieces at the ends of
splits are put together across tasks.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from rankloom.session import settled, stored

_MAX_BYTES = "spark.sql.files.maxPartitionBytes"
_MEMBER = r'\s*"[^"\\]*"\s*:\s*(?:"(?:[^"\\]|\\.)*"|[^\s"{}\[\],]+)\s*'
# What may stand before and after the elements, by the depth of the elements.
_HEADS = {1: r"^\s*\[", 2: rf'^\s*\{{(?:{_MEMBER},)*\s*"value"\s*:\s*\['}
_TAILS = {1: r"\]\s*\z", 2: rf"\]\s*(?:,{_MEMBER})*\}}\s*\z"}


def write_arrays(records: DataFrame, path: str) -> None:
    """Every partition as one text file that holds an array of its rows, a row a line."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = "["
        for batch in batches:
            for text in batch["value"]:
                yield pd.DataFrame({"value": [before + text]})
                before = ","
        yield pd.DataFrame({"value": ["]" if before == "," else "[]"]})

    texts = records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    # Spark names these files .txt, so readers need that pattern.
    texts.mapInPandas(lines, "value string").write.mode("errorifexists").text(path)


def _pieces(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Pieces with their quotes (odd or even) and the change of depth they make.

    ``outside`` holds for a piece that starts outside a string, ``inside`` for one that starts in one;
    the closing brace behind the piece is not counted in either. A backslash never
    stands before a closing brace in valid JSON, so no piece starts behind one.
    """
    pieces = (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "false")
        .option("lineSep", "}")
        .text(folder)
        .select(
            "value",
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("size"),
        )
    )
    plain = F.regexp_replace("value", r"(?s)\\.", "")

    def depth(text: Column) -> Column:
        free = F.regexp_replace(text, r'"[^"]*+"?', "")
        opened = F.length(free) - F.length(F.translate(free, "{[", ""))
        return opened - (F.length(free) - F.length(F.translate(free, "]", "")))

    at_start = F.col("block") == 0
    return pieces.select(
        "*",
        ((F.length(plain) - F.length(F.translate(plain, '"', ""))) % 2).cast("int").alias("odd"),
        depth(plain).cast("int").alias("outside"),
        depth(F.regexp_replace(plain, r'^[^"]*+"?', "")).cast("int").alias("inside"),
        (F.octet_length("value") + 1).cast("long").alias("bytes"),
        F.when(at_start & F.col("value").rlike(_HEADS[1]), 1)
        .when(at_start & F.col("value").rlike(_HEADS[2]), 2)
        .otherwise(0)
        .alias("base"),
    )


def _runs(batch: pd.DataFrame) -> Iterator[tuple[tuple[str, int], pd.DataFrame]]:
    """The consecutive rows of each split."""
    if len(batch):
        new = (batch["file"] != batch["file"].shift()) | (batch["block"] != batch["block"].shift())
        for _, rows in batch.groupby(new.cumsum(), sort=False):
            yield (rows["file"].iloc[0], int(rows["block"].iloc[0])), rows


def _depths(rows: pd.DataFrame, in_string: int, depth: int, closed_last: bool = True):
    """Depth behind each piece, whether that is outside strings, and both at the end."""
    odd = rows["odd"].to_numpy()
    after = (in_string + np.cumsum(odd)) % 2
    change = np.where((after + odd) % 2 == 0, rows["outside"].to_numpy(), rows["inside"].to_numpy()) - (after == 0)
    if not closed_last and after[-1] == 0:
        change[-1] += 1
    return depth + np.cumsum(change), after == 0


def _sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per split: quotes, depth gained by either start, bytes, and the first piece's base."""
    key, total = None, None
    for batch in batches:
        for split, rows in _runs(batch):
            if split != key:
                if key is not None:
                    yield pd.DataFrame([total])
                key = split
                total = dict(
                    file=split[0], block=split[1], size=int(rows["size"].iloc[0]), base=int(rows["base"].iloc[0]),
                    odd=0, outside=0, inside=0, bytes=0,
                )
            for start, name in ((0, "outside"), (1, "inside")):
                total[name] += int(_depths(rows, (start + total["odd"]) % 2, 0)[0][-1])
            total["odd"] = (total["odd"] + int(rows["odd"].sum())) % 2
            total["bytes"] += int(rows["bytes"].sum())
    if key is not None:
        yield pd.DataFrame([total])


def _starts(splits: DataFrame) -> DataFrame:
    """How every split starts. A window holds the splits of one file, a row each."""
    order = W.partitionBy("file").orderBy("block")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("file")

    def earlier(value) -> Column:
        return F.coalesce(F.sum(value).over(before), F.lit(0))

    known = splits.withColumn("in_string", (earlier("odd") % 2).cast("int"))
    gained = F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside"))
    missing = F.col("size") - F.sum("bytes").over(whole)  # a byte order mark of three bytes is not read
    return known.select(
        "file",
        "block",
        "in_string",
        F.coalesce(F.sum(gained).over(before), F.lit(0)).cast("int").alias("depth"),
        earlier("bytes").cast("long").alias("start"),
        F.first("base").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("base"),
        (F.col("block") == F.max("block").over(whole)).alias("ends_file"),
        missing.isin(0, 3).alias("closed"),
    )


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts that end where an element ends, with their byte position.

    The text before the first such end of a split and the one behind the last are ``part`` of a
    chunk that may go on in another split; ``closes`` tells those that end one.
    """
    key, split = None, None

    def row(closes: bool, last: bool) -> tuple:
        whole = split["whole"] and closes
        text = "".join(split["open"])
        return split["file"], split["at"], text, split["base"], not whole, closes, last

    def finish() -> list[tuple]:
        if split["ends_file"]:
            return [row(True, True)]
        return [row(False, False)] if split["open"] else []

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["file", "at", "text", "base", "part", "closes", "last"])

    held = None  # the newest rows of a split: the last piece of a file may have no brace behind it
    for batch in batches:
        found = []
        for name, rows in _runs(batch):
            if held is not None and name == key:
                rows = pd.concat([held, rows], ignore_index=True)
            elif held is not None:
                found += _cut(split, held, True, row) + finish()
            if name != key:
                key, first = name, rows.iloc[0]
                if pd.isna(first["start"]):
                    raise ValueError(f"{name[0]} was cut otherwise in the first pass")
                split = dict(
                    file=name[0], at=int(first["start"]), next=int(first["start"]), base=int(first["file_base"]),
                    in_string=int(first["in_string"]), depth=int(first["depth"]), open=[],
                    whole=int(first["start"]) == 0, ends_file=bool(first["ends_file"]), closed=bool(first["closed"]),
                )
            found += _cut(split, rows.iloc[:-1], False, row)
            held = rows.iloc[-1:]
        if found:
            yield frame(found)
    if held is not None:
        yield frame(_cut(split, held, True, row) + finish())


def _cut(split: dict, rows: pd.DataFrame, at_end: bool, row) -> list[tuple]:
    """Chunks closed by ``rows``; what stays open is kept in ``split``."""
    if not len(rows):
        return []
    closed = split["closed"] or not (at_end and split["ends_file"])
    depths, free = _depths(rows, split["in_string"], split["depth"], closed)
    ends = free & (depths == split["base"])
    if not closed:
        ends[-1] = False
    found = []
    for i, (text, size, end) in enumerate(zip(rows["value"], rows["bytes"], ends)):
        split["open"].append(text if not closed and i == len(rows) - 1 else text + "}")
        split["next"] += int(size)
        if end:
            found.append(row(True, False))
            split.update(open=[], at=split["next"], whole=True)
    split["in_string"], split["depth"] = 0 if free[-1] else 1, int(depths[-1])
    return found


def _joined(parts: DataFrame) -> DataFrame:
    """The parts of every chunk that goes over the end of a split."""
    before = W.partitionBy("file").orderBy("at", "closes").rowsBetween(W.unboundedPreceding, -1)
    numbered = parts.withColumn("number", F.coalesce(F.sum(F.col("closes").cast("int")).over(before), F.lit(0)))
    texts = F.array_sort(F.collect_list(F.struct("at", "closes", "text")))
    return numbered.groupBy("file", "number").agg(
        F.min("at").alias("at"),
        F.array_join(F.transform(texts, lambda t: t["text"]), "").alias("text"),
        F.first("base").alias("base"),
        F.max("last").alias("last"),
    ).drop("number")


def _records(chunks: DataFrame) -> DataFrame:
    """The elements of every chunk; anything that is no element fails the job."""
    first, last, base = F.col("at") == 0, F.col("last"), F.col("base")

    def by_base(patterns: dict[int, str], use) -> Column:
        return F.when(base == 1, use(patterns[1])).when(base == 2, use(patterns[2]))

    whole = F.col("text")
    tail_fits = ~last | by_base(_TAILS, lambda p: whole.rlike(p))
    without_tail = F.when(last, by_base(_TAILS, lambda p: F.regexp_replace(whole, p, ""))).otherwise(whole)
    cut = chunks.select("file", "at", "last", "base", "text", tail_fits.alias("tail_fits"), without_tail.alias("body"))
    body = F.col("body")
    comma = body.rlike(r"^\s*,")
    inner = F.when(first, by_base(_HEADS, lambda p: F.regexp_replace(body, p, ""))).otherwise(
        F.regexp_replace(body, r"^\s*,", "")
    )
    read = F.from_json(F.concat(F.lit("[["), inner, F.lit("]]")), "array<array<variant>>")
    several = F.when(F.size(read) == 1, read[0])
    fits = F.col("tail_fits") & (
        first | (comma & (F.size(several) > 0)) | (~comma & last & ~body.rlike(r"\S"))
    )
    alone = F.from_json(F.concat(F.lit("["), whole, F.lit("]")), "array<variant>")
    nothing = F.array().cast("array<variant>")
    elements = F.when(
        base == 0,
        F.when(last, F.when(~whole.rlike(r"\S"), nothing)).when(
            whole.rlike(r"^\s*\{") & (F.size(alone) == 1), alone
        ),
    ).otherwise(F.when(fits, several))
    parsed = F.coalesce(elements, F.raise_error(F.concat(F.lit("malformed JSON in "), F.col("file"))))
    return cut.select("file", "at", F.posexplode(parsed).alias("i", "record")).select(
        "file", (F.col("at") + F.col("i")).alias("pos"), "record"
    )


@contextlib.contextmanager
def _split_size(spark: SparkSession, split_bytes: int | None):
    before = spark.conf.get(_MAX_BYTES)
    spark.conf.set(_MAX_BYTES, str(split_bytes) if split_bytes else before)
    try:
        yield
    finally:
        spark.conf.set(_MAX_BYTES, before)


def read_large_content(
    spark: SparkSession, folder: str, glob: str = "*.json", split_bytes: int | None = None
) -> DataFrame:
    """Records of the files in ``folder`` as ``file, pos, record``, each file read by many tasks.

    A file is an array of records, an object whose ``value`` is such an array with nothing but
    scalars beside it, or objects one behind the other; an empty file has no records. ``pos`` grows
    in the order of the records (the byte position of the text around one). Malformed text,
    anything behind a whole value and a file that ends too soon fail the job. Files are read twice; a
    split is at most ``split_bytes`` long, by default as the session says. Compressed files
    are one split. Records, not files, have to fit into memory.
    """
    with _split_size(spark, split_bytes):
        pieces = _pieces(spark, folder, glob)
        splits = pieces.drop("value").mapInPandas(
            _sum_up, "file string, block long, size long, base int, odd int, outside int, inside int, bytes long"
        )
        starts = settled(_starts(splits)).withColumnRenamed("base", "file_base")
        # One row per split, no more than the driver holds to plan the scan itself.
        known = pieces.drop("size", "base").join(F.broadcast(starts), ["file", "block"], "left")
        chunks = stored(
            known.mapInPandas(
                _chunks,
                "file string, at long, text string, base int, part boolean, closes boolean, last boolean",
            ),
            "chunks",
        )
    columns = ["file", "at", "text", "base", "last"]
    return _records(chunks.where("not part").select(columns).unionByName(_joined(chunks.where("part")).select(columns)))
