"""URL filtering by rules and by character language models of accepted and rejected URLs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rankloom.llm.bytework import mixed, parts

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Host and path of each rule and its verdict (fixed values).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

ORDER = 4
# All orders of a class share this many slots, whatever the corpus: the model is at most 24 MB.
SLOTS = 1 << 20
HELD_OUT = 5
_BINS_PER_UNIT = 64
_BIN_LIMIT = 1024


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for null."""
    cut = F.instr(url, "://")
    rest = F.when(cut > 0, F.substr(url, cut + 3))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null when none does."""
    name = verdict = F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: len(r[0])):
        at, _, start = rule.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{start}")
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order the packed contexts and grams of all characters; places before a URL count as byte 0."""
    ends = np.repeat(offsets[:-1], np.diff(offsets))
    place = np.arange(len(data)) - ends
    symbol = data.astype(np.uint64)
    context = np.zeros(len(data), dtype=np.uint64)
    for order in range(ORDER + 1):
        if order:
            before = np.zeros(len(data), dtype=np.uint64)
            reach = place >= order
            before[reach] = symbol[np.flatnonzero(reach) - order]
            context = context | (before << np.uint64(8 * (order - 1)))
        tag = np.uint64(order << 56)
        yield order, context | tag, (context << np.uint64(8)) | symbol | tag


def _slots(codes: np.ndarray) -> np.ndarray:
    return (mixed(codes) & np.uint64(SLOTS - 1)).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts ``label, context, gram, n``."""
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False)
        for low, high, data, offsets in parts(batch.column(0)):
            of = np.repeat(label[low:high], np.diff(offsets))
            for value in (0, 1):
                for _, context, gram in _grams(data, offsets):
                    chosen = of == value
                    grams, first, n = np.unique(gram[chosen], return_index=True, return_counts=True)
                    contexts = context[chosen][first]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(n), value, dtype=np.int32)),
                            pa.array(contexts.view(np.int64)),
                            pa.array(grams.view(np.int64)),
                            pa.array(n),
                        ],
                        names=["label", "context", "gram", "n"],
                    )


def _to_slots(column: str):
    def rows(batches):
        for batch in batches:
            codes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_slots(codes)), *(batch.column(k) for k in range(2, batch.num_columns))],
                names=["label", "slot", *batch.schema.names[2:]],
            )

    return rows


@dataclass(frozen=True)
class UrlModels:
    """Counts per class (0 rejected, 1 accepted) and slot, and the calibration of their score."""

    grams: np.ndarray
    contexts: np.ndarray
    types: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean log-likelihood difference per byte of each URL, 0 for an empty one.

        Witten-Bell smoothing: an order weighs its estimate by how often its context was
        seen against how many different symbols followed; unseen contexts leave the
        estimate of the order below.
        """
        chance = np.full((2, len(data)), 1 / 256)
        for _, context, gram in _grams(data, offsets):
            at, here = _slots(context), _slots(gram)
            for value in (0, 1):
                seen = self.contexts[value][at].astype(np.float64)
                types = self.types[value][at].astype(np.float64)
                # slots are shared, so a gram may seem more frequent than its context
                n = np.minimum(self.grams[value][here], seen)
                total = seen + types
                known = total > 0
                better = (n + types * chance[value]) / np.where(known, total, 1)
                chance[value] = np.where(known, better, chance[value])
        gain = np.concatenate([[0.0], np.cumsum(np.log(chance[1]) - np.log(chance[0]))])
        lengths = np.diff(offsets)
        return np.where(lengths > 0, (gain[offsets[1:]] - gain[offsets[:-1]]) / np.maximum(lengths, 1), 0.0)


def _table(rows: DataFrame, *names: str) -> list[np.ndarray]:
    """Dense per-class arrays; at most twice ``SLOTS`` rows reach the driver."""
    found = rows.toArrow()
    out = [np.zeros((2, SLOTS), dtype=np.float32) for _ in names]
    label, slot = found.column("label").to_numpy(), found.column("slot").to_numpy()
    for array, name in zip(out, names):
        array[label, slot] = found.column(name).to_numpy()
    return out


def _scored(urls: DataFrame, models: UrlModels) -> DataFrame:
    shared = urls.sparkSession.sparkContext.broadcast(models)
    schema = T.StructType([*urls.schema.fields, T.StructField("score", T.DoubleType())])

    def rows(batches):
        for batch in batches:
            out = [shared.value.scores(data, offsets) for _, _, data, offsets in parts(batch.column(0))]
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    return urls.mapInArrow(rows, schema)


def _logistic(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a one-variable logistic regression with a weak ridge, by Newton steps."""
    x = np.stack([scores, np.ones_like(scores)])
    at = np.array([1.0, 0.0])
    ridge = 1e-3 * np.eye(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
        slope = x @ (weights * (p - labels)) + ridge @ (at - [1.0, 0.0])
        bend = (x * (weights * p * (1 - p))) @ x.T + ridge
        step = np.linalg.solve(bend, slope)
        at = at - step
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def fit_models(labelled: DataFrame) -> UrlModels:
    """Models from all rows of ``url, label`` (1 accepted, 0 rejected); nulls are left out.

    One URL in ``HELD_OUT``, by its hash, calibrates the score; the others are counted.
    Counts leave a task once per gram and class. With no held-out URLs of both classes
    the calibration stays neutral.
    """
    known = labelled.filter("url is not null and label is not null").select("url", F.col("label").cast("int").alias("label"))
    held = F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0
    counts = known.filter(~held).mapInArrow(_count_grams, "label int, context long, gram long, n long")
    exact = counts.groupBy("label", "context", "gram").agg(F.sum("n").alias("n"))
    grams = exact.groupBy("label", "gram").agg(F.sum("n").alias("n")).mapInArrow(_to_slots("gram"), "label int, slot long, n long")
    contexts = exact.groupBy("label", "context").agg(F.sum("n").alias("n"), F.count("*").alias("t")).mapInArrow(
        _to_slots("context"), "label int, slot long, n long, t long"
    )
    (gram_n,) = _table(grams.groupBy("label", "slot").agg(F.sum("n").alias("n")), "n")
    context_n, types = _table(contexts.groupBy("label", "slot").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "n", "t")
    raw = UrlModels(gram_n, context_n, types)
    place = F.greatest(F.least(F.round(F.col("score") * _BINS_PER_UNIT), F.lit(_BIN_LIMIT)), F.lit(-_BIN_LIMIT)).cast("int")
    bins = _scored(known.filter(held), raw).groupBy("label", place.alias("bin")).count().collect()  # bounded by the bins
    if {row["label"] for row in bins} != {0, 1}:
        return raw
    table = np.array([(row["bin"] / _BINS_PER_UNIT, row["label"], row["count"]) for row in bins])
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    slope, offset = _logistic(table[:, 0], table[:, 1], table[:, 2])
    return UrlModels(gram_n, context_n, types, slope, offset)


def judged_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, least: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, score, accepted_chance`` for every row of ``pages``.

    The longest fitting rule decides. Its verdicts over all pages are also what the
    models learn from; URLs without a rule are allowed when the calibrated chance of
    being accepted is at least ``least``.

    A null URL, or one without ``://``, has empty host and path and no rule; null and
    empty URLs score 0 and so get the verdict of the calibration's offset alone. Ids may
    be null or repeat; other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(url_col).alias("url"), F.col(id_col).alias("page_id"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "says": says})
    models = fit_models(rows.select("url", (F.col("says") == "allow").cast("int").alias("label")))
    scored = _scored(rows, models)
    chance = 1 / (1 + F.exp(-(F.col("score") * models.slope + models.offset)))
    method = F.when(chance >= least, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"), "score", chance.alias("accepted_chance"))
