"""Secrets in texts: fixed patterns, and character Markov models for the rest.

Only DataFrame functions are used. Spans are found and scored in the row that holds
the text; what is shuffled are the distinct tokens the models are trained from.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.session import stored

# The fixed patterns (kinds in their order of rank, least length of a match or its value).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 8, 16, 32

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CHARS = "[A-Za-z0-9+/_=-]"
MIN_IDENTIFIER = 12
IDENTIFIER = rf"{_CHARS}{{{MIN_IDENTIFIER},}}"
# A whole token of that length; the look-behind keeps the search linear.
RANDOM_TOKEN = rf"(?<!{_CHARS}){IDENTIFIER}"
# Least lengths of the classes of tokens that have a limit of their own: means over more characters vary less.
LENGTHS = (MIN_IDENTIFIER, 16, 20, 32)

FALSE_ALARMS = 0.001
HELD_OUT = 10
# Characters on each side of a token that tell its places apart.
_AROUND = 16
# What is known before any surely ordinary token is seen counts as so many of them.
PRIOR = 10
_BIN = 0.02
_BLOCK = 256


def _running(values: Column) -> Column:
    """Sums of all values before each place; blocks keep the copying of growing arrays short."""
    n = F.size(values)
    longs = "array<bigint>"
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")), lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))
    total = lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda s, x: s + x)
    grow = lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x).cast(longs)
    starts = F.aggregate(F.transform(blocks, total), F.array(F.lit(0)).cast(longs), grow)
    inner = F.zip_with(
        blocks,
        F.slice(starts, F.lit(1), F.size(blocks)),
        lambda block, start: F.slice(F.aggregate(block, F.array(start).cast(longs), grow), F.lit(1), F.size(block)),
    )
    return F.when(n > 0, F.flatten(inner)).otherwise(F.array().cast(longs))


def _spans(df: DataFrame, name: str, pattern: str, kind: int, group: int = 0, check: str | None = None) -> DataFrame:
    """Adds ``name``: the leftmost non-overlapping matches as ``(start, kind, end, match, value)``.

    Java's matcher gives no places, so they come from the lengths of the matches and of
    the pieces between them. Texts without a match skip all of it.
    """
    text = F.col("_text")
    any_match = text.rlike(check or pattern)
    found = F.when(any_match, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    values = F.when(any_match, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))) if group else F.col("_found")
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    staged = df.withColumn("_found", found).withColumn("_values", values)
    staged = staged.withColumn("_gaps", F.when(F.size("_found") > 0, gaps))
    steps = F.zip_with("_found", F.slice("_gaps", F.lit(1), F.size("_found")), lambda m, g: g + F.length(m))
    staged = staged.withColumn("_steps", steps).withColumn("_before", _running(F.col("_steps")))
    start = lambda i: F.get("_before", i) + F.get("_gaps", i)
    spans = F.transform(
        "_found",
        lambda m, i: F.struct(
            start(i).alias("start"),
            F.lit(kind).alias("kind"),
            (start(i) + F.length(m)).alias("end"),
            m.alias("match"),
            F.get("_values", i).alias("value"),
        ),
    )
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,match:string,value:string>>")
    return staged.withColumn(name, F.coalesce(spans, empty)).drop("_found", "_values", "_gaps", "_steps", "_before")


def with_base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_text`` and the arrays ``_assign``, ``_access`` and ``_hex`` of fixed-pattern spans."""
    df = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    df = _spans(df, "_assign", ASSIGN, 0, group=2)
    df = _spans(df, "_access", ACCESS, 1, check=f"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}")
    df = _spans(df, "_hex", HEX, 2, check=f"[0-9a-f]{{{MIN_HEX},}}")
    long = lambda name, least: F.filter(name, lambda s: F.length(s["value"]) >= least)
    return df.withColumns(
        {"_assign": long("_assign", MIN_ASSIGNED), "_access": long("_access", MIN_ACCESS), "_hex": long("_hex", MIN_HEX)}
    )


def labelled_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``token, random, sure``: every distinct token of all texts the models can learn from.

    Random strings (1) are what the fixed patterns find, assigned values with a digit
    only. All other runs of ``MIN_IDENTIFIER`` token characters may be ordinary (0), or
    keys nobody named. Sure to be ordinary are those with different text before them
    and different text after them in two places; a key in copies of a text is not.
    """
    df = with_base_spans(docs.select(F.col(text_col).alias("text")))
    assigned = F.filter(F.transform("_assign", lambda s: s["value"]), lambda v: v.rlike("[0-9]"))
    sure = F.concat(assigned, F.transform("_access", lambda s: s["value"]), F.transform("_hex", lambda s: s["value"]))
    any_base = rf"{ASSIGN}|{ACCESS}|[0-9a-f]{{{MIN_HEX},}}"
    outside = F.when(F.size(sure) > 0, F.regexp_replace("_text", any_base, " ")).otherwise(F.col("_text"))
    df = df.select(sure.alias("_sure"), outside.alias("_outside"))
    df = df.withColumn("_found", F.regexp_extract_all("_outside", F.lit(IDENTIFIER), F.lit(0)))
    df = df.withColumn("_gaps", F.when(F.size("_found") > 0, F.split("_outside", IDENTIFIER, -1)))
    token = lambda i: F.coalesce(F.get("_found", i), F.lit(""))
    before = lambda i: F.right(F.concat(token(i - 1), F.get("_gaps", i)), F.lit(_AROUND))
    after = lambda i: F.left(F.concat(F.get("_gaps", i + 1), token(i + 1)), F.lit(_AROUND))

    def row(t, random, left, right):
        return F.struct(t.alias("token"), F.lit(random).alias("random"), left.alias("left"), right.alias("right"))

    none = F.lit(0).cast("long")
    random = F.transform("_sure", lambda t: row(t, 1, none, none))
    ordinary = F.transform("_found", lambda t, i: row(t, 0, F.xxhash64(before(i)), F.xxhash64(after(i))))
    both = df.select(F.explode(F.concat(random, ordinary)).alias("t")).select("t.*")
    varied = (F.min("left") != F.max("left")) & (F.min("right") != F.max("right"))
    grouped = both.groupBy("token").agg(F.max("random").alias("random"), varied.alias("sure"))
    return grouped.select("token", "random", ((F.col("random") == 0) & F.col("sure")).alias("sure"))


def unsure_weight(tokens: DataFrame) -> float:
    """What a token that may be ordinary counts beside one that surely is.

    It falls with the square of the number of sure ones, so that what all the unsure ones
    together count vanishes however many there are for each sure one.
    """
    return (PRIOR / (PRIOR + tokens.filter("sure").count())) ** 2


def _held_out() -> Column:
    return F.pmod(F.xxhash64("token"), F.lit(HELD_OUT)) == 0


def log_ratios(tokens: DataFrame, unsure: float) -> list[float]:
    """log P(next | previous) under random strings less the same under identifiers.

    Counted over all tokens not held out, those not sure to be ordinary with the weight
    ``unsure``; smoothed by one. The pairs of alphabet characters bound what reaches the driver.
    """
    size = len(ALPHABET) + 1
    chars = tokens.filter(~_held_out()).select("random", "sure", F.concat(F.array(F.lit("")), F.split("token", "")).alias("chars"))
    pair = lambda i: F.struct(F.get("chars", i - 1).alias("a"), F.get("chars", i).alias("b"))
    pairs = chars.select("random", "sure", F.explode(F.transform(F.sequence(F.lit(1), F.size("chars") - 1), pair)).alias("p"))
    counted = pairs.groupBy("random", "sure", "p.a", "p.b").count()
    place = lambda c: F.when(F.col(c) == "", 0).otherwise(F.position(F.col(c), F.lit(ALPHABET)))
    coded = counted.groupBy("random", "sure", place("a").alias("a"), place("b").alias("b")).agg(F.sum("count").alias("n"))
    counts = [[[1.0] * size for _ in range(size)] for _ in range(2)]
    for row in coded.collect():  # at most 3 * 69 * 69 rows
        counts[row["random"]][row["a"]][row["b"]] += row["n"] * (1 if row["random"] or row["sure"] else unsure)
    share = [[[math.log(n / sum(line)) for n in line] for line in model] for model in counts]
    return [share[1][a][b] - share[0][a][b] for a in range(size) for b in range(size)]


def token_score(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio per character of a token; above 0 it looks random."""
    size = len(ALPHABET) + 1
    table = F.split(F.lit(",".join(f"{r:.12g}" for r in ratios)), ",").cast("array<double>")
    state = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("sum"))

    def step(acc, char):
        code = F.position(char, F.lit(ALPHABET)).cast("int")
        return F.struct(code.alias("at"), (acc["sum"] + F.get(table, acc["at"] * size + code)).alias("sum"))

    chars = F.split(token, "")
    return F.aggregate(chars, state, step, lambda acc: acc["sum"] / F.size(chars))


def _limit(ordinary: dict[int, float], random: dict[int, int], false_alarms: float) -> int:
    """The least bin, from 0, that at most this share of ordinary tokens exceeds.

    ``ordinary`` and ``random`` count held-out tokens per bin. Ordinary tokens that are
    keys after all score as random strings do, so what the upper half of those shows to
    be like them is left out of the share, the less so the fewer random strings there are.
    """
    n, m = sum(ordinary.values()), sum(random.values())
    if not n:
        return 0
    exceed = lambda counts, place: sum(c for b, c in counts.items() if b > place)
    places = range(max([*ordinary, *random]) + 1)
    known = [(exceed(ordinary, p) / n, exceed(random, p) / max(m, 1)) for p in places]
    alike = [o / r for o, r in known if r >= 0.5]
    keys = min([1.0, *alike]) * m / (m + 1) if alike else 0.0
    return next(p for p, (o, r) in zip(places, known) if o - keys * r <= false_alarms * (1 - keys))


def _length_class(token: Column) -> Column:
    """Place in ``LENGTHS`` of a token; shorter ones count as the first."""
    return F.greatest(F.lit(0), sum((F.length(token) >= n).cast("int") for n in LENGTHS) - 1)


def thresholds(tokens: DataFrame, ratios: list[float], unsure: float, false_alarms: float = FALSE_ALARMS) -> list[float]:
    """The least score per length class, not below 0, that at most this share of held-out identifiers exceeds.

    To the identifiers of a class come ``PRIOR`` spread like those of all lengths, so a class with few
    of its own has about the limit of all. Random strings are counted over all
    lengths, as most are as long as the fixed patterns make them.
    """
    place = F.greatest(F.lit(0), F.ceil(token_score(F.col("token"), ratios) / _BIN)).cast("int")
    scored = tokens.filter(_held_out()).select("random", "sure", _length_class(F.col("token")).alias("length"), place.alias("bin"))
    random, whole, classes = Counter(), Counter(), [Counter() for _ in LENGTHS]
    for row in scored.groupBy("random", "sure", "length", "bin").count().collect():
        for counts in (random,) if row["random"] else (whole, classes[row["length"]]):
            counts[row["bin"]] += row["count"] * (1 if row["random"] or row["sure"] else unsure)
    n = sum(whole.values())
    spread = lambda own: {b: own[b] + PRIOR * c / n for b, c in whole.items()}
    return [_limit(spread(own), random, false_alarms) * _BIN for own in classes]


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_alarms: float = FALSE_ALARMS) -> DataFrame:
    """``doc_id, base, markov``: arrays of ``(start, kind, end, match, value)`` per row of ``docs``.

    ``base`` are the fixed-pattern spans, ``markov`` whole tokens of at least
    ``MIN_IDENTIFIER`` characters, outside assigned values and long hex runs, that the
    character models score as random. Places are code points, the end exclusive.

    Null and empty texts have no spans; null ids stay null; repeated rows are returned
    as often; other columns are ignored. Without any token to learn from the models
    are equal and add nothing.
    """
    tokens = stored(labelled_tokens(docs, text_col), "tokens")
    unsure = unsure_weight(tokens)
    ratios = log_ratios(tokens, unsure)
    limits = F.array(*map(F.lit, thresholds(tokens, ratios, unsure, false_alarms)))
    df = with_base_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    df = _spans(df, "_tokens", f"(?:{ASSIGN})|{RANDOM_TOKEN}", 3, check=RANDOM_TOKEN)
    base_inside = rf"^(?i:password|passwd|secret|token|api_?key)=|(?i:password|passwd|secret|token|api_?key)=[A-Za-z0-9+/_=-]{{{MIN_ASSIGNED},}}|[0-9a-f]{{{MIN_HEX},}}|AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}"
    free = F.filter("_tokens", lambda s: s["match"].rlike(f"^{IDENTIFIER}$") & ~s["match"].rlike(base_inside))
    df = df.withColumn("_free", free)
    random = F.filter("_free", lambda s: token_score(s["match"], ratios) > F.get(limits, _length_class(s["match"])))
    found = df.select("doc_id", "_assign", "_access", "_hex", random.alias("markov")).select(
        "doc_id", F.struct(F.array_sort(F.concat("_assign", "_access", "_hex")).alias("base"), "markov").alias("found")
    )
    # As a generated row the spans are made once: filters on them, such as an explode brings, stay above.
    return found.select("doc_id", F.explode(F.array("found")).alias("found")).select("doc_id", "found.base", "found.markov")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``doc_id, text``: the texts with every found span replaced by ``mask``; ids must be unique.

    Overlapping spans are replaced as one.
    """
    spans = found.select(F.col("doc_id").alias("_id"), F.array_sort(F.concat("base", "markov")).alias("_spans"))
    joined = docs.join(spans, docs[id_col] == spans["_id"]).select(id_col, F.col(text_col).alias("text"), "_spans")
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        piece = F.substr(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = F.concat(acc["out"], F.array(F.concat(piece, F.lit(mask))))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"),
        )

    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(F.col("text"), (acc["at"] + 1).cast("int")))
    return joined.select(id_col, F.aggregate("_spans", zero, step, rest).alias(text_col))
