"""Quality rules as a ledger of failure bits, with versioned policies over it.

Only DataFrame functions are used: everything runs in the JVM, in the row that
holds the text, and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
# At least two capitals and no small letter.
SHOUTED = r"^\P{Ll}*\p{Lu}\P{Ll}*\p{Lu}\P{Ll}*$"
WINDOW = 5

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_word_lines", "n_letter_words",
    "n_shouted_words",
)

# Name -> SQL condition over the measures under which the rule fails. The place
# in this list is the rule's bit; new rules go to the end.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_word_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "few_letters": "100 * n_letter_words < 50 * n_words",
    "shouting": "2 * n_shouted_words > n_words",
}
BASE_RULES = ("few_words", "repeated_windows")


def mask(*rules: str) -> int:
    return sum(1 << list(RULES).index(rule) for rule in rules)


@dataclass(frozen=True)
class Policy:
    """A document is kept when it fails none of the rules in ``bits``."""

    version: str
    bits: int


POLICIES = {
    "base": Policy("base", mask(*BASE_RULES)),
    "v1": Policy("v1", mask(*RULES)),
}
CURRENT = "v1"


def _repeated(docs: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: word places covered by windows found twice or more.

    Window hashes are compared within one text. Only texts with an equal pair sort
    (hash, place) structs; the places covered are then counted from the gaps.
    """
    window = lambda i: F.xxhash64(*(F.get(F.col("_words"), i + j) for j in range(WINDOW)))
    empty = F.array().cast("array<bigint>")
    hashes = F.when(
        F.size("_words") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW), window),
    ).otherwise(empty)
    placed = F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    again = lambda x, k: (
        (F.get(F.col("_placed"), k - 1)["h"] == x["h"]) | (F.get(F.col("_placed"), k + 1)["h"] == x["h"])
    )
    places = F.array_sort(F.transform(F.filter("_placed", lambda x, k: F.coalesce(again(x, k), F.lit(False))), lambda x: x["i"]))
    gap = lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), k + 1) - p, F.lit(WINDOW)))
    covered = F.aggregate(F.transform("_places", gap), F.lit(0), lambda a, b: a + b)
    return (
        docs.withColumn("_hashes", hashes)
        .withColumn("_placed", placed)
        .withColumn("_places", places)
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .drop("_hashes", "_placed", "_places")
    )


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measures of its whole texts; a null text measures as empty."""
    count = lambda c: c.cast("long")
    staged = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    staged = staged.withColumns(
        {
            "_words": F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)),
            "_lines": F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(WORD)),
        }
    )
    return _repeated(staged).withColumns(
        {
            "n_words": count(F.size("_words")),
            "word_chars": count(F.length(F.array_join("_words", ""))),
            "n_symbols": count(F.length("_text") - F.length(F.regexp_replace("_text", SYMBOL, ""))),
            "n_dup_lines": count(F.size("_lines") - F.size(F.array_distinct("_lines"))),
            "n_word_lines": count(F.size("_lines")),
            "n_letter_words": count(F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}")))),
            "n_shouted_words": count(F.size(F.filter("_words", lambda w: w.rlike(SHOUTED)))),
        }
    ).drop("_text", "_words", "_lines")


def failure_bits() -> Column:
    """One long whose bit i is set when rule i fails."""
    bits = F.lit(0).cast("long")
    for place, condition in enumerate(RULES.values()):
        bits = bits + F.when(F.expr(condition), F.lit(1 << place)).otherwise(F.lit(0))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, <measures>, fail_bits``: every rule evaluated once per row.

    One row per row of ``docs``, in any multiplicity; null ids stay null; a null or
    empty text has no words and fails ``few_words``. Extra columns are ignored.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = measured(narrow).withColumn("fail_bits", failure_bits())
    return rows.select("doc_id", *MEASURES, "fail_bits")


def fails(policy: Policy, bits: str | Column = "fail_bits") -> Column:
    """True where a row of a ledger fails ``policy``."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(policy.bits)) != 0


def accepted(docs: DataFrame, policy: Policy = POLICIES[CURRENT], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their own columns, that pass ``policy``.

    Rows are measured beside their own columns packed in one struct, so names that
    clash with measures do no harm.
    """
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(text_col).alias("text"))
    judged = measured(packed).withColumns({"fail_bits": failure_bits(), "_at": F.monotonically_increasing_id()})
    # the place keeps Spark from moving the filter, and with it every measure, into the scan again and again
    return judged.filter(~fails(policy) & (F.col("_at") >= 0)).select("_row.*")


def ablations(rows: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """``rule, n_failed, n_only``: for each rule of ``policy`` the rows of a ledger that fail it
    and those that fail nothing else, so would be kept without it.

    The ledger is first summed up by its failure bits (at most 2**rules rows).
    """
    by_bits = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.bits)).alias("bits")).agg(F.count("*").alias("n"))
    rules = [(name, 1 << k) for k, name in enumerate(RULES) if policy.bits >> k & 1]
    named = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(b).alias("bit")) for n, b in rules)))
    counted = by_bits.select("bits", "n", named.alias("r")).select("bits", "n", "r.rule", "r.bit")
    bit = F.col("bit").cast("long")
    return counted.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == bit, F.col("n")).otherwise(0)).alias("n_only"),
    )
