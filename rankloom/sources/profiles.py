"""Scoring profiles: field weights and one freshness function."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

# Values used when a profile leaves them out (fixed values).
DEFAULT_BOOST = 2.0
DEFAULT_DURATION_DAYS = 365
DEFAULT_INTERPOLATION = "quadratic"


@dataclass(frozen=True)
class Freshness:
    field: str
    boost: float = DEFAULT_BOOST
    duration_days: int = DEFAULT_DURATION_DAYS
    interpolation: str = DEFAULT_INTERPOLATION


@dataclass(frozen=True)
class ScoringProfile:
    name: str
    weights: dict[str, float] = field(default_factory=dict)
    freshness: Freshness | None = None


# The weights and the freshness of the shipped profile (fixed values).
DEFAULT_PROFILE = ScoringProfile(
    "relevance-boost",
    {"title": 3.0, "tags": 2.0, "body": 1.0},
    Freshness("lastModified", 2.0, 365, "quadratic"),
)


# What a profile file may hold.
PROFILES = """
    profiles array<struct<
        name string,
        text_weights map<string, double>,
        freshness struct<field string, boost double, duration_days int, interpolation string>
    >>,
    default_profile string
"""


def profile_rows(spark: SparkSession, path: str) -> DataFrame:
    """A row per profile of the JSON files at ``path``, which may be on any storage Spark reads.

    ``name, weights, field, boost, duration_days, interpolation, is_default``; ``field`` and
    what follows it are null for a profile without freshness. A missing path and
    malformed JSON are errors.
    """
    specs = spark.read.schema(PROFILES).json(path, multiLine=True, mode="FAILFAST")
    rows = specs.select(F.explode("profiles").alias("p"), "default_profile")
    fresh = F.col("p.freshness")
    known = fresh.isNotNull()
    return rows.select(
        "p.name",
        F.coalesce("p.text_weights", F.create_map().cast("map<string,double>")).alias("weights"),
        fresh["field"].alias("field"),
        F.when(known, F.coalesce(fresh["boost"], F.lit(DEFAULT_BOOST))).alias("boost"),
        F.when(known, F.coalesce(fresh["duration_days"], F.lit(DEFAULT_DURATION_DAYS))).alias("duration_days"),
        F.when(known, F.coalesce(fresh["interpolation"], F.lit(DEFAULT_INTERPOLATION))).alias("interpolation"),
        F.col("p.name").eqNullSafe(F.col("default_profile")).alias("is_default"),
    )


def load_profile(spark: SparkSession, path: str, name: str | None = None) -> ScoringProfile:
    """The profile of that name, or the default one; an error unless there is exactly one."""
    wanted = F.col("is_default") if name is None else F.col("name") == name
    found = profile_rows(spark, path).where(wanted).take(2)
    if len(found) != 1:
        raise ValueError(f"{path} has {'no' if not found else 'several'} profiles for {name or 'the default'}")
    row = found[0].asDict()
    freshness = Freshness(*(row[c] for c in ("field", "boost", "duration_days", "interpolation"))) if row["boost"] is not None else None
    return ScoringProfile(row["name"], dict(row["weights"]), freshness)
