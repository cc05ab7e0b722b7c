"""Mixing by soft domain membership: document rates that meet token targets per domain.

A classifier trained on a labelled table gives every document a chance for each
domain. Rates are then fitted by projected gradient steps on least squares, so that
the expected tokens of each domain meet its target and no rate is negative.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rankloom.llm.bytework import mixed, parts, prefix_hashes, slice_hashes, words, _LOWER_CODES
from rankloom.llm.packing import packed, unpacked
from rankloom.session import stored

DOMAINS = ("good", "poor", "toxic")
# Shares of the expected tokens.
TARGETS = {"good": 0.85, "poor": 0.10, "toxic": 0.05}
FEATURES = 1 << 11
# The classifier is fitted on the labelled documents with the smallest hash of their id.
MAX_LABELLED = 4000
# Fitting ends when every total is this close to its target, as a share of all tokens, or
# when it gains nothing any more, as no rates can meet the targets.
TOLERANCE = 1e-6
_PATIENCE, _GAIN = 10, 0.99
# Directions in which documents differ less than this, as a share of where they differ most, are left alone.
_FLAT = 1e-5
# Sums are taken over whole thousandths of a token, so they do not depend on their order.
_UNIT = 1000.0


def domain_label(quality: Column, toxic: Column) -> Column:
    """Place in ``DOMAINS`` of a labelled document, null when it can't be told."""
    return F.when(toxic == 1, 2).when((toxic == 0) & (quality == 1), 0).when((toxic == 0) & (quality == 0), 1)


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per row, and (row, feature, value) of hashed words: root counts of unit length."""
    starts, ends, first = words(data, offsets)
    hashes = slice_hashes(prefix_hashes(data, _LOWER_CODES), starts, ends)
    counts = np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    cells, n = np.unique(rows * FEATURES + (mixed(hashes) & np.uint64(FEATURES - 1)).astype(np.int64), return_counts=True)
    row, feature = cells // FEATURES, cells % FEATURES
    value = np.sqrt(n) / np.sqrt(np.maximum(counts, 1))[row]
    return counts, row, feature, value


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in parts(batch.column(2)):
            _, row, feature, value = _features(data, offsets)
            ends = np.searchsorted(row, np.arange(high - low + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    batch.column(1).slice(low, high - low),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(feature.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(value)),
                ],
                names=["doc_id", "domain", "features", "values"],
            )


@dataclass(frozen=True)
class DomainModel:
    weights: np.ndarray  # features x domains
    bias: np.ndarray

    def chances(self, rows: int, row: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        logits = np.tile(self.bias, (rows, 1))
        for k in range(logits.shape[1]):
            logits[:, k] += np.bincount(row, weights=value * self.weights[feature, k], minlength=rows)
        logits -= logits.max(axis=1, keepdims=True)
        out = np.exp(logits)
        return out / out.sum(axis=1, keepdims=True)


def _softmax_regression(x: np.ndarray, labels: np.ndarray, classes: int, steps: int = 300, ridge: float = 1e-4) -> DomainModel:
    """Accelerated gradient descent on the mean log loss; rows of ``x`` have unit length."""
    n = max(len(x), 1)
    wanted = np.eye(classes)[labels] if len(x) else np.zeros((0, classes))
    share = (wanted.sum(axis=0) + 1) / (n + classes)
    weights, bias = np.zeros((x.shape[1], classes)), np.log(share)
    # the loss bends by at most 1 for rows of unit length and a bias
    last_w, last_b, rate = weights, bias, 1.0
    for step in range(steps if len(x) else 0):
        pull = step / (step + 3)
        w, b = weights + pull * (weights - last_w), bias + pull * (bias - last_b)
        logits = x @ w + b
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p = (p / p.sum(axis=1, keepdims=True) - wanted) / n
        last_w, last_b = weights, bias
        weights, bias = w - rate * (x.T @ p + ridge * w), b - rate * p.sum(axis=0)
    return DomainModel(weights, bias)


def fit_domains(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text") -> DomainModel:
    """A softmax regression over hashed words from at most ``max_labelled`` labelled documents.

    ``labels`` has the id and ``domain`` (place in ``DOMAINS``; nulls are left out). The
    sample are the ids of smallest hash, so it is the same for any partitioning.
    """
    known = labels.filter(F.col("domain").isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), "domain")
    sample = known.groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "domain", "text")
    found = rows.mapInArrow(_feature_rows, "doc_id long, domain int, features array<int>, values array<double>")
    # a sampled id that many rows repeat counts once
    once = found.groupBy("doc_id").agg(F.min_by(F.struct("domain", "features", "values"), F.xxhash64("features", "values")).alias("r"))
    got = sorted(once.select("doc_id", "r.*").toArrow().to_pylist(), key=lambda r: r["doc_id"])
    x = np.zeros((len(got), FEATURES))
    for k, r in enumerate(got):
        x[k, r["features"]] = r["values"]
    return _softmax_regression(x, np.array([r["domain"] for r in got], dtype=np.int64), len(DOMAINS))


_CHANCES = [f"p_{d}" for d in DOMAINS]


def memberships(docs: DataFrame, model: DomainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_tokens, p_<domain>...`` for every row: words of the whole text and domain chances."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for batch in batches:
            for low, high, data, offsets in parts(batch.column(2)):
                counts, *sparse = _features(data, offsets)
                chances = shared.value.chances(high - low, *sparse)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(low, high - low) for k in (0, 1)), pa.array(counts), *(pa.array(c) for c in chances.T)],
                    names=["doc_id", "text_hash", "n_tokens", *_CHANCES],
                )

    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return narrow.mapInArrow(rows, "doc_id long, text_hash long, n_tokens long, " + ", ".join(f"{c} double" for c in _CHANCES))


def _rates(chances: np.ndarray, moves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the given steps from 1, and the point with momentum where the next step starts.

    Each step subtracts its move from that point and clips at 0.
    """
    before = rate = ahead = np.ones(len(chances))
    for step, move in enumerate(moves, start=1):
        before, rate = rate, np.maximum(0.0, ahead - chances @ move)
        ahead = rate + (step - 1) / (step + 2) * (rate - before)
    return rate, ahead


def _expected(members: DataFrame, moves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens per domain at both points that ``moves`` lead to."""
    k = len(DOMAINS)
    names = [f"{point}_{d}" for point in ("rate", "ahead") for d in DOMAINS]

    def sums(batches):
        for batch in batches:
            chances = np.stack([batch.column(1 + j).to_numpy(zero_copy_only=False) for j in range(k)], axis=1)
            tokens = batch.column(0).to_numpy(zero_copy_only=False)
            units = [np.rint((tokens * r)[:, None] * chances * _UNIT).astype(np.int64).sum(axis=0) for r in _rates(chances, moves)]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in np.concatenate(units)], names=names)

    partial = members.select("n_tokens", *_CHANCES).mapInArrow(sums, ", ".join(f"{n} long" for n in names))
    row = partial.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names)).first()
    totals = np.array([row[n] for n in names]) / _UNIT
    return totals[:k], totals[k:]


def _spread(members: DataFrame) -> np.ndarray:
    """The sums of tokens times products of domain chances."""
    k = len(DOMAINS)
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    exact = lambda i, j: F.sum(F.round(F.col("n_tokens") * F.col(_CHANCES[i]) * F.col(_CHANCES[j]) * _UNIT).cast("long"))
    row = members.agg(*(F.coalesce(exact(i, j), F.lit(0)).alias(f"c{i}_{j}") for i, j in cells)).first()
    out = np.zeros((k, k))
    for i, j in cells:
        out[i, j] = out[j, i] = row[f"c{i}_{j}"] / _UNIT
    return out


@dataclass(frozen=True)
class Fit:
    """The steps that lead to the rates, the expected tokens they give, and the targets."""

    moves: list
    expected: np.ndarray
    wanted: np.ndarray

    @property
    def distance(self) -> float:
        """Of the expected totals from the targets."""
        return float(np.linalg.norm(self.expected - self.wanted))

    @property
    def gap(self) -> float:
        """The furthest an expected total is off its target, as a share of all tokens."""
        return float(np.abs(self.expected - self.wanted).max() / max(self.wanted.sum(), 1.0))


def fit_rates(members: DataFrame, targets: dict[str, float] = TARGETS, tolerance: float = TOLERANCE) -> Fit:
    """Projected gradient descent for rates whose expected domain tokens meet the targets.

    The targets are shares of all tokens. Residuals are weighted by the inverse of the K by
    K Gram matrix, in which domains that go together (or are rare) bend alike, so a step
    that clips no rate ends at the targets and few are needed otherwise; steps have
    momentum. It ends at ``tolerance``, or when ``_PATIENCE`` steps came no closer: the targets
    can't be met then, and :attr:`Fit.gap` says by how much. A domain that next to no
    document may belong to (its direction of the Gram matrix is flat) is left as it is
    while the others meet their targets; filling it would take rates in the thousands.

    A document's rate after any number of steps follows from its K chances and the steps'
    K numbers, so a step is one pass that returns K sums; no state is kept per document
    and a lost executor costs nothing but its share of a pass.
    """
    inverse = np.linalg.pinv(_spread(members), rcond=_FLAT, hermitian=True)
    expected, ahead = _expected(members, [])
    wanted = expected.sum() * np.array([targets[d] for d in DOMAINS]) / sum(targets.values())
    moves: list[np.ndarray] = []
    best = fit = Fit(moves, expected, wanted)
    waited = 0
    while fit.gap > tolerance and waited < _PATIENCE:
        moves = [*moves, inverse @ (ahead - wanted)]
        expected, ahead = _expected(members, moves)
        fit = Fit(moves, expected, wanted)
        waited = 0 if fit.distance < _GAIN * best.distance else waited + 1
        best = fit if fit.distance < best.distance else best
    return best


def _with_rates(members: DataFrame, fit: Fit) -> DataFrame:
    moves = fit.moves

    def rows(batches):
        for batch in batches:
            chances = np.stack([batch.column(3 + j).to_numpy(zero_copy_only=False) for j in range(len(DOMAINS))], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_rates(chances, moves)[0])], names=[*batch.schema.names, "rate"])

    return members.mapInArrow(rows, T.StructType([*members.schema.fields, T.StructField("rate", T.DoubleType())]))


def mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_tokens, p_<domain>..., rate, copies`` for every row of ``docs``.

    ``labels`` has the id, ``quality`` and ``toxic``. ``rate`` is how often the document
    is expected in the mixture, ``copies`` a whole number with that expectation: the rate
    rounded up or down by a hash of id and text, so that it is the same in every run.

    Null and empty texts have no tokens and the chances of the prior. Repeated rows are
    fitted and returned as often as given. Null ids stay null. Labels of unknown ids are
    ignored; with no labels at all the chances are even. Other columns are ignored.
    """
    named = labels.select(F.col(id_col), domain_label(F.col("quality"), F.col("toxic")).cast("int").alias("domain"))
    model = fit_domains(docs, named, id_col=id_col, text_col=text_col)
    members = stored(memberships(docs, model, id_col, text_col), "members")
    rated = _with_rates(members, fit_rates(members, targets))
    chance = F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "text_hash"), F.lit(1 << 30)) / float(1 << 30)
    return rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))


def mixture_report(mixed: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id") -> DataFrame:
    """A row per domain about the result of :func:`mixture`.

    ``domain, target, expected`` (shares of all tokens), ``gap`` (their difference), and of
    the rows whose id is labelled with the domain ``n_rows``, ``n_dropped`` (no copy) and
    ``n_repeated`` (several copies).
    """
    total = F.greatest(F.sum("n_tokens"), F.lit(1))
    shares = [F.sum(F.col("n_tokens") * F.col("rate") * F.col(c)) / total for c in _CHANCES]
    wanted = sum(targets.values())
    each = F.array(
        *(
            F.struct(F.lit(k).alias("k"), F.lit(d).alias("domain"), F.lit(targets[d] / wanted).alias("target"), F.coalesce(share, F.lit(0.0)).alias("expected"))
            for k, (d, share) in enumerate(zip(DOMAINS, shares))
        )
    )
    met = mixed.agg(each.alias("each")).select(F.inline("each"))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), domain_label(F.col("quality"), F.col("toxic")).alias("k"))
    known = known.filter("doc_id IS NOT NULL AND k IS NOT NULL").groupBy("doc_id").agg(F.min("k").alias("k"))
    rows = mixed.join(known, "doc_id").groupBy("k").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("copies") == 0).alias("n_dropped"), F.count_if(F.col("copies") > 1).alias("n_repeated")
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_dropped", "n_repeated")]
    return met.join(rows, "k", "left").select("domain", "target", "expected", (F.col("expected") - F.col("target")).alias("gap"), *counts)


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their own columns, whatever their names, as often as their copies say.

    Rows of equal id and text have equal copies, so repeated rows are repeated alike;
    null ids and null texts are documents like others.
    """
    drawn = mixture(docs, labels, targets, id_col, text_col).filter("copies > 0")
    times = drawn.select(F.col("doc_id").alias("drawn_id"), F.col("text_hash").alias("drawn_hash"), "copies").distinct()
    same = F.col("id").eqNullSafe(F.col("drawn_id")) & (F.col("text_hash") == F.col("drawn_hash"))
    joined = packed(docs, id_col, text_col).join(times, same)
    return unpacked(joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))
