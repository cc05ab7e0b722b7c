"""Prefixes met with sorted terms: the terms a prefix begins are a range of them.

Terms and prefixes are cut into blocks of consecutive strings. A prefix goes to every
block its range touches, which is one unless a cut lies inside the range; a cut lies
inside the ranges of its own beginnings only, so the copies number at most the
prefixes plus the lengths of the cuts. No beginning of a term is ever written out.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

BLOCK_ROWS = 50_000
CUT_SAMPLE = 100_000  # strings the cuts are taken from, the only rows the driver sees
ROWS_PER_CUT = 10  # sampled strings a block has at least, so that blocks stay even
_LAST = "\U0010ffff"  # sorts after every character of a word


def range_cuts(strings: DataFrame, block_rows: int = BLOCK_ROWS) -> list[str]:
    """Cuts that leave about ``block_rows`` rows of ``strings(key)`` between them.

    They come from the ``CUT_SAMPLE`` strings of smallest hash; beyond
    ``CUT_SAMPLE / ROWS_PER_CUT`` blocks the blocks grow instead.
    """
    blocks = -(-strings.count() // block_rows)
    if blocks < 2:
        return []
    rows = strings.select("key").orderBy(F.xxhash64("key"), "key").limit(CUT_SAMPLE).collect()
    sample = sorted(r["key"] for r in rows)
    blocks = min(blocks, max(1, len(sample) // ROWS_PER_CUT))
    return sorted({sample[i * len(sample) // blocks] for i in range(1, blocks)})


def _block_of(cuts: list[str]):
    @F.pandas_udf("int")
    def block(keys: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(cuts, k) for k in keys], dtype="int32")

    return block


def _matches(top: int | None):
    def of_block(rows: pd.DataFrame) -> pd.DataFrame:
        terms = rows[~rows["asked"]].sort_values("key", ignore_index=True)
        keys = terms["key"].tolist()
        # Where a term stands when the most frequent come first, ties in text order.
        place = np.empty(len(keys), dtype=np.int64)
        place[np.argsort(-terms["df"].to_numpy(dtype=np.int64), kind="stable")] = np.arange(len(keys))
        prefixes, chosen = [], []
        for prefix in rows.loc[rows["asked"], "key"]:
            first, end = bisect_left(keys, prefix), bisect_left(keys, prefix + _LAST)
            span = np.arange(first, end)
            if top is not None and len(span) > top:
                span = span[np.argpartition(place[first:end], top - 1)[:top]]
            prefixes += [prefix] * len(span)
            chosen.append(span)
        found = terms.loc[np.concatenate(chosen) if chosen else [], ["key", "df"]]
        prefixes = pd.Series(prefixes, dtype="object")
        return pd.DataFrame({"prefix": prefixes, "key": found["key"].to_numpy(), "df": found["df"].to_numpy()})

    return of_block


def prefix_matches(
    prefixes: DataFrame, terms: DataFrame, top: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``prefix, key, df`` of the terms each prefix begins; with ``top`` its most frequent ones.

    ``prefixes(prefix)`` and ``terms(key, df)`` hold distinct strings without nulls and
    are read three times, so they should be stored. Ties in ``df`` go to the smaller
    key. A prefix that begins no term has no row; an empty prefix begins every term.
    """
    asked = prefixes.select(F.col("prefix").alias("key"))
    cuts = range_cuts(terms.select("key").unionByName(asked), block_rows)
    block = _block_of(cuts)
    placed = (
        terms.select("key", F.col("df").cast("long").alias("df"), F.lit(False).alias("asked"))
        .withColumn("block", block("key"))
        .unionByName(
            asked.select(
                "key", block("key").alias("first"), block(F.concat("key", F.lit(_LAST))).alias("last")
            ).select(
                "key",
                F.lit(0).cast("long").alias("df"),
                F.lit(True).alias("asked"),
                F.explode(F.sequence("first", "last")).alias("block"),
            )
        )
    )
    found = placed.groupBy("block").applyInPandas(_matches(top), "prefix string, key string, df long")
    if top is None:
        return found
    best = W.partitionBy("prefix").orderBy(F.col("df").desc(), "key")
    return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= top).drop("n")
