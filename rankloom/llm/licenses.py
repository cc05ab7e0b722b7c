"""License detections by ordered signature rules.

A rule is a regular expression over the words of a text, a word the text must hold before
the expression is tried, a priority and a strength. Rules are written for license names,
and each name is put into the phrases it is granted with; sentences of license texts have
rules of their own. A detection that lies within one of higher priority, or within
a longer one of equal priority, is suppressed; of equal ones the first rule counts.

Only DataFrame functions are used, and everything happens in the row that holds the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# The fixed phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Words are runs of other characters than these, A-Z lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words before lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# label, a word of the name, the name's words, its identifier's words (regular expressions).
NAMES = (
    ("mit", "mit", "mit( x11| expat)?", "mit"),
    ("mit-0", "mit", "mit no attribution", "mit 0"),
    ("x11", "x11", "x11", "x11"),
    ("apache-1", "apache", "apache( software)? license( version| v)? 1( [01])?", "apache 1 [01]"),
    ("apache-2", "apache", "(apache( software)? license( version| v)? 2( 0)?|apache( v)? 2( 0)?|asl 2( 0)?)", "apache 2 0"),
    ("bsd-2-clause", "bsd", "((simplified|freebsd|2 clause|two clause) bsd|bsd 2 clause)", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "((new|modified|revised|3 clause|three clause) bsd|bsd 3 clause)", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "((original|old|4 clause|four clause) bsd|bsd 4 clause)", "bsd 4 clause"),
    ("bsd-0-clause", "bsd", "(zero clause bsd|0bsd|bsd zero clause)", "0bsd"),
    ("bsd", "bsd", "(bsd|bsd style)", "bsd"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "(zlib|zlib libpng)", "zlib"),
    ("libpng", "libpng", "libpng", "libpng( 2 0)?"),
    ("boost-1", "boost", "boost software license( version)?( 1 0)?", "bsl 1 0"),
    ("gpl-1", "1", "(gnu )?(general public license|gpl)( version| v)? 1( 0)?", "gpl 1 0( only| or later)?"),
    ("gpl-2", "2", "(gnu )?(general public license|gpl)( version| v)? 2( 0)?", "gpl 2 0( only| or later)?"),
    ("gpl-3", "3", "(gnu )?(general public license|gpl)( version| v)? 3( 0)?", "gpl 3 0( only| or later)?"),
    ("gpl-2", "gplv2", "(gnu )?gplv2", "gplv2"),
    ("gpl-3", "gplv3", "(gnu )?gplv3", "gplv3"),
    ("gpl", "gnu", "gnu (general public license|gpl)", "gnu gpl"),
    ("lgpl-2", "2", "(gnu )?(library general public license|lgpl)( version| v)? 2( 0)?", "lgpl 2 0( only| or later)?"),
    ("lgpl-2.1", "2", "(gnu )?(lesser general public license|lgpl)( version| v)? 2 1", "lgpl 2 1( only| or later)?"),
    ("lgpl-3", "3", "(gnu )?(lesser general public license|lgpl)( version| v)? 3( 0)?", "lgpl 3 0( only| or later)?"),
    ("lgpl", "gnu", "gnu ((lesser|library) general public license|lgpl)", "gnu lgpl"),
    ("agpl-3", "3", "(gnu )?(affero general public license|agpl)( version| v)? 3( 0)?", "agpl 3 0( only| or later)?"),
    ("agpl", "gnu", "gnu (affero general public license|agpl)", "gnu agpl"),
    ("gfdl-1.2", "documentation", "(gnu )?free documentation license( version| v)? 1 2", "gfdl 1 2( only| or later)?"),
    ("gfdl-1.3", "documentation", "(gnu )?free documentation license( version| v)? 1 3", "gfdl 1 3( only| or later)?"),
    ("gfdl", "documentation", "gnu free documentation license", "gfdl"),
    ("mpl-1.0", "1", "(mozilla public license|mpl)( version| v)? 1 0", "mpl 1 0"),
    ("mpl-1.1", "1", "(mozilla public license|mpl)( version| v)? 1 1", "mpl 1 1"),
    ("mpl-2.0", "2", "(mozilla public license|mpl)( version| v)? 2( 0)?", "mpl 2 0"),
    ("epl-1.0", "1", "(eclipse public license|epl)( version| v)? 1( 0)?", "epl 1 0"),
    ("epl-2.0", "2", "(eclipse public license|epl)( version| v)? 2( 0)?", "epl 2 0"),
    ("edl-1.0", "eclipse", "eclipse distribution license( version| v)?( 1 0)?", "edl 1 0"),
    ("cddl-1.0", "1", "(common development and distribution license|cddl)( version| v)? 1 0", "cddl 1 0"),
    ("cddl-1.1", "1", "(common development and distribution license|cddl)( version| v)? 1 1", "cddl 1 1"),
    ("cpl-1.0", "common", "common public license( version| v)?( 1 0)?", "cpl 1 0"),
    ("ipl-1.0", "ibm", "ibm public license( version| v)?( 1 0)?", "ipl 1 0"),
    ("eupl-1.1", "1", "(european union public licen[cs]e|eupl)( version| v)? 1 1", "eupl 1 1"),
    ("eupl-1.2", "1", "(european union public licen[cs]e|eupl)( version| v)? 1 2", "eupl 1 2"),
    ("artistic-1.0", "artistic", "artistic license( version| v)? 1 0", "artistic 1 0"),
    ("artistic-2.0", "artistic", "artistic license( version| v)? 2 0", "artistic 2 0"),
    ("python-2.0", "python", "python( software foundation)?( license)?( version)? 2( 0)?", "(python|psf) 2 0"),
    ("ruby", "ruby", "ruby", "ruby"),
    ("php-3.01", "php", "php license( version| v)? 3 0?1", "php 3 01"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("unicode", "unicode", "unicode", "unicode (dfs 2016|3 0)"),
    ("ncsa", "illinois", "university of illinois( ncsa)?( open source)?", "ncsa"),
    ("w3c", "w3c", "w3c( software)?( notice and)?", "w3c"),
    ("unlicense", "unlicense", "(the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl( version 2)?", "wtfpl"),
    ("beerware", "beerware", "beerware", "beerware"),
    ("ofl-1.1", "1", "(sil open font license|open font license|sil ofl)( version| v)?( 1 1)", "ofl 1 1"),
    ("ms-pl", "microsoft", "microsoft public license( ms pl)?", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license( ms rl)?", "ms rl"),
    ("osl-3.0", "open", "open software license( version| v)? 3( 0)?", "osl 3 0"),
    ("afl-3.0", "academic", "academic free license( version| v)? 3( 0)?", "afl 3 0"),
    ("busl-1.1", "business", "business source license( version| v)? 1 1", "busl 1 1"),
    ("sspl-1.0", "side", "server side public license( version| v)?( 1)?", "sspl 1 0"),
    ("elastic-2.0", "elastic", "elastic license( version| v)? 2( 0)?", "elastic 2 0"),
    ("odbl-1.0", "open", "open (data commons open )?database license( version| v)?( 1 0)?", "odbl 1 0"),
    ("cc0-1.0", "cc0", "cc0( 1 0)?( universal)?", "cc0 1 0"),
    ("cc-by", "cc", "cc by( [1-4] [0-9])?", "cc by [1-4] [0-9]"),
    ("cc-by-sa", "cc", "cc by sa( [1-4] [0-9])?", "cc by sa [1-4] [0-9]"),
    ("cc-by-nd", "cc", "cc by nd( [1-4] [0-9])?", "cc by nd [1-4] [0-9]"),
    ("cc-by-nc", "cc", "cc by nc( [1-4] [0-9])?", "cc by nc [1-4] [0-9]"),
    ("cc-by-nc-sa", "cc", "cc by nc sa( [1-4] [0-9])?", "cc by nc sa [1-4] [0-9]"),
    ("cc-by-nc-nd", "cc", "cc by nc nd( [1-4] [0-9])?", "cc by nc nd [1-4] [0-9]"),
)
# Creative Commons licenses by their long names: label, words after "creative commons".
COMMONS = (
    ("cc-by", "attribution"),
    ("cc-by-sa", "attribution share( )?alike"),
    ("cc-by-nd", "attribution no( )?derivs|attribution no( )?derivatives"),
    ("cc-by-nc", "attribution non( )?commercial"),
    ("cc-by-nc-sa", "attribution non( )?commercial share( )?alike"),
    ("cc-by-nc-nd", "attribution non( )?commercial no( )?deriv(s|atives)"),
    ("cc0-1.0", "zero|cc0"),
)
# Addresses of license texts: label, a word of it, its words.
ADDRESSES = (
    ("mit", "opensource", "opensource org licenses? mit( license)?( php)?"),
    ("apache-2", "apache", "apache org licenses license 2 0"),
    ("gpl", "gnu", "gnu org (licenses|copyleft) gpl"),
    ("gpl-2", "gnu", "gnu org licenses( old licenses)? gpl 2 0"),
    ("gpl-3", "gnu", "gnu org licenses gpl 3 0"),
    ("lgpl-2.1", "gnu", "gnu org licenses( old licenses)? lgpl 2 1"),
    ("lgpl-3", "gnu", "gnu org licenses lgpl 3 0"),
    ("agpl-3", "gnu", "gnu org licenses agpl 3 0"),
    ("gfdl", "gnu", "gnu org licenses fdl( 1 [123])?"),
    ("mpl-2.0", "mozilla", "mozilla org mpl 2 0"),
    ("epl-2.0", "eclipse", "eclipse org legal epl 2 0"),
    ("boost-1", "boost", "boost org license 1 0"),
    ("unlicense", "unlicense", "unlicense org"),
    ("ofl-1.1", "openfontlicense", "openfontlicense org"),
    ("bsd-2-clause", "opensource", "opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "opensource", "opensource org licenses? bsd 3 clause"),
    ("cc-by", "creativecommons", "creativecommons org licenses by( [1-4] [0-9])?"),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa( [1-4] [0-9])?"),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd( [1-4] [0-9])?"),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc( [1-4] [0-9])?"),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa( [1-4] [0-9])?"),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd( [1-4] [0-9])?"),
    ("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero( 1 0)?"),
)
# Sentences of license texts: label, a word of it, its words.
SENTENCES = (
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2", "compliance", "you may not use this file except in compliance with the license"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license"),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gfdl", "permission", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("zlib", "warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("boost-1", "boost", "distributed under the boost software license version 1 0"),
    ("wtfpl", "public", "do what the fuck you want to public license"),
    ("public-domain", "domain", "(released|dedicated|placed|is) (in|into|to) the public domain"),
    ("proprietary", "reserved", "copyright( c)? [0-9]{4} [^\\n]{1,80}? all rights reserved"),
    ("proprietary", "proprietary", "(confidential and proprietary|proprietary and confidential)"),
)
# One of these is in every text that a rule or a phrase can fit.
STEMS = (
    "licen", "under", "public", "copyright", "redistribut", "permission", "advertising", "endorse", "warranty",
    "proprietary", "gpl", "fdl", "creativecommons", "apache", "mozilla", "eclipse",
)
_SPLIT_CC = r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by[\x00-\x2F\x3A-\x60\x7B-\x7F]+nc"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is over words with one space between; ``strength`` is the chance that a place is right."""

    label: str
    keyword: str
    pattern: str
    priority: int
    strength: float

    @property
    def regex(self) -> str:
        """``pattern`` over a text in which every word has a space of its own on both sides."""
        return f" ({self.pattern}) ".replace(" ", "  ")[1:-1]


def _named(label: str, keyword: str, name: str, identifier: str) -> list[Rule]:
    grant = "(licen[cs]ed|available|released|distributed|published|provided|covered|shared)"
    return [
        Rule(label, "spdx", f"spdx license identifier {identifier}", 4, 0.99),
        Rule(label, keyword, f"{grant} under( the)?( terms of)?( the)?( terms)? {name}( licen[cs]e)?", 3, 0.95),
        Rule(label, keyword, f"licen[cs]e( is)?( under)?( the)? {name}", 2, 0.8),
        Rule(label, keyword, f"{name} licen[cs]ed?", 2, 0.8),
        Rule(label, "licen", f"licen[cs]es?( id| name| type)? {identifier}", 2, 0.7),
        Rule(label, keyword, f"copyright [^\\n]{{1,60}}? {name}", 1, 0.5),
    ]


def _rules() -> tuple[Rule, ...]:
    out = [rule for row in NAMES for rule in _named(*row)]
    for label, words in COMMONS:
        out.append(Rule(label, "commons", f"creative commons ({words})( [1-4] [0-9])?( international| unported| universal)?( public)? licen[cs]e", 3, 0.95))
        out.append(Rule(label, "commons", f"licen[cs]ed under( a| the)? creative commons ({words})", 2, 0.9))
    out += [Rule(label, keyword, words, 3, 0.9) for label, keyword, words in ADDRESSES]
    out += [Rule(label, keyword, words, 5, 0.97) for label, keyword, words in SENTENCES]
    return tuple(out)


RULES = _rules()
BASE_STRENGTH = 0.95
PRIORITIES = tuple(sorted({rule.priority for rule in RULES}))
_BLOCK = 256
_FOUND = "array<struct<start:int,end:int,rule:int,priority:int,label:string,strength:double>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scan(values: Column, zero: Column, step, kind: str) -> Column:
    """``step`` over all values before each place; blocks keep the copying of growing arrays short."""
    kind = f"array<{kind}>"
    grow = lambda acc, x: F.array_append(acc, step(F.element_at(acc, -1), x)).cast(kind)
    total = lambda block: F.aggregate(block, zero, step)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)),
    )

    def within(blocks: Column) -> Column:
        starts = F.aggregate(F.transform(blocks, total), F.array(zero).cast(kind), grow)
        return F.flatten(
            F.zip_with(
                blocks,
                F.slice(starts, F.lit(1), F.size(blocks)),
                lambda block, start: F.slice(F.aggregate(block, F.array(start).cast(kind), grow), F.lit(1), F.size(block)),
            )
        )

    return F.when(F.size(values) > 0, _let(blocks, within)).otherwise(F.array().cast(kind))


def _apart(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` computed once for each row: Spark joins no projections across the generator."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _places(text: Column, rule: Column) -> Column:
    """The leftmost non-overlapping matches of a rule in ``text``.

    Java's matcher gives no places, so they come from the lengths of the matches and of the
    pieces between them.
    """

    def at(found: Column, gaps: Column) -> Column:
        steps = F.zip_with(gaps, found, lambda g, m: F.length(g) + F.length(m))
        before = lambda steps: _scan(steps, F.lit(0), lambda s, x: s + x, "int")
        pieces = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("length")))
        return F.zip_with(
            _let(steps, before),
            pieces,
            lambda b, p: F.struct(
                (b + p["gap"]).alias("start"),
                (b + p["gap"] + p["length"]).alias("end"),
                rule["rule"].alias("rule"),
                rule["priority"].alias("priority"),
                rule["label"].alias("label"),
                rule["strength"].alias("strength"),
            ),
        )

    pattern = rule["regex"]
    pieces = lambda found: F.slice(F.split(text, pattern, F.lit(-1)), F.lit(1), F.size(found))
    some = _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: _let(pieces(found), lambda gaps: at(found, gaps)))
    return F.when(F.rlike(text, pattern), some).otherwise(F.array().cast(_FOUND))


def _unsuppressed(found: Column) -> Column:
    """The detections not within one of higher priority or a longer one of equal priority.

    By start, then the longest, then the highest priority first, a detection is inside an
    earlier one when the furthest end of those of no lower priority reaches its own.
    """
    ordered = F.array_sort(
        F.transform(found, lambda d: F.struct(d["start"], (-d["end"]).alias("e"), (-d["priority"]).alias("p"), d["rule"], d.alias("d")))
    )

    def reach(rows: Column, priority: int) -> Column:
        ends = F.transform(rows, lambda r: F.when(r["p"] <= -priority, -r["e"]).otherwise(-1))
        return _let(ends, lambda values: _scan(values, F.lit(-1), lambda s, x: F.greatest(s, x), "int"))

    def kept(rows: Column) -> Column:
        reaches = F.struct(*(reach(rows, p).alias(f"p{p}") for p in PRIORITIES))
        return _let(
            reaches,
            lambda by: F.transform(
                F.filter(
                    rows,
                    lambda r, i: ~F.coalesce(
                        *(F.when(r["p"] == -p, F.get(by[f"p{p}"], i) >= -r["e"]) for p in PRIORITIES)
                    ),
                ),
                lambda r: r["d"],
            ),
        )

    return F.when(F.size(found) > 1, _let(ordered, kept)).otherwise(found)


def license_detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, detections, labels, score`` for every row.

    ``n_base`` counts the places of the fixed phrases, overlapping ones too; ``first_word``
    and ``last_word`` are their smallest and largest first word, null without any.
    ``detections`` are what rules found and nothing suppressed: first word, word after the
    last, label, priority and strength. ``labels`` are those of both, sorted; ``score`` is the chance that any
    of them is right, taking the strongest place of every label.

    Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z
    lower-cased. Null and empty texts have no words; whole texts are searched, however
    long. Rows are judged one by one, so repeated rows and ids are returned as often as
    given and null ids stay null. An empty table gives no rows. Other columns are ignored.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = _apart(df, "low", F.lower("text"))
    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | F.col("low").contains(stem)
    gate = gate | (F.col("low").contains("cc") & F.col("low").rlike(_SPLIT_CC))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(lower, SEPARATORS, "  ")), F.lit(" "))
    df = _apart(df.withColumn("n_words", F.regexp_count("text", F.lit(WORD)).cast("long")), "spaced", F.when(gate, spaced))
    text = F.col("spaced")

    # the fixed phrases
    wide = {phrase: f" {phrase} ".replace(" ", "  ")[1:-1] for phrase in BASE}
    n_words = lambda piece: (F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))) / 2
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE.items():
        has = text.contains(wide[phrase])
        counts.append(F.when(has, F.regexp_count(text, F.lit(wide[phrase]))).otherwise(0))
        firsts.append(F.when(has, n_words(F.substring_index(text, wide[phrase], 1)).cast("long")))
        tail = n_words(F.substring_index(text, wide[phrase], -1)).cast("long") + len(phrase.split())
        lasts.append(F.when(has, F.col("n_words") - tail))
        labels.append(F.when(has, F.lit(label)))
    base = F.struct(
        sum(counts, F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.array(*firsts)).alias("first_word"),
        F.array_max(F.array(*lasts)).alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base_labels"),
    )
    df = _apart(df, "base", base)

    # the rules
    rules = F.array(
        *(
            F.struct(
                F.lit(k).alias("rule"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.label).alias("label"),
                F.lit(r.strength).alias("strength"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.regex).alias("regex"),
            )
            for k, r in enumerate(RULES)
        )
    )
    tried = F.filter(rules, lambda r: F.contains(text, r["keyword"]))
    found = F.flatten(F.transform(tried, lambda r: _places(text, r)))
    df = _apart(df, "found", F.when(text.isNotNull(), found).otherwise(F.array().cast(_FOUND)))
    df = _apart(df, "kept", _unsuppressed(F.col("found")))

    word = lambda place: n_words(F.substring(text, F.lit(1), place)).cast("long")
    detections = F.transform(
        "kept",
        lambda d: F.struct(
            word(d["start"]).alias("start"), word(d["end"]).alias("end"), d["label"].alias("label"), d["priority"].alias("priority"), d["strength"].alias("strength")
        ),
    )
    strongest = F.transform(
        F.array_distinct(F.transform("kept", lambda d: d["label"])),
        lambda label: F.struct(
            label.alias("label"), F.array_max(F.transform(F.filter("kept", lambda d: d["label"] == label), lambda d: d["strength"])).alias("strength")
        ),
    )
    own = F.transform(F.col("base.base_labels"), lambda label: F.struct(label.alias("label"), F.lit(BASE_STRENGTH).alias("strength")))
    df = _apart(df, "by_label", F.concat(own, strongest))
    wrong = F.aggregate(
        F.array_sort(F.array_distinct(F.transform("by_label", lambda b: b["label"]))),
        F.lit(1.0),
        lambda s, label: s * (1 - F.array_max(F.transform(F.filter("by_label", lambda b: b["label"] == label), lambda b: b["strength"]))),
    )
    result = F.struct(
        detections.alias("detections"),
        F.array_sort(F.array_distinct(F.transform("by_label", lambda b: b["label"]))).alias("labels"),
        F.round(1 - wrong, 6).alias("score"),
    )
    df = _apart(df, "result", result)
    return df.select("doc_id", "n_words", "base.*", "result.*")
