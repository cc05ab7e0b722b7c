"""HTML to plain text as column expressions."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column, functions as F

from rankloom.functions.text import _col, collapse_whitespace

# Elements whose content is not text (fixed values). A script or style element
# left open runs to the end of the value.
_RAW_ELEMENTS = r"(?is)<(script|style)\b[^>]*(?<!/)>.*?(?:</\1\s*>|\z)"
_HIDDEN_ELEMENTS = r"(?is)<(template|rt|rp)\b[^>]*(?<!/)>.*?</\1\s*>"
_COMMENT = r"(?s)<!--.*?-->"
# A start tag may hold ">" inside quotes; the possessive groups keep the match
# iterative. The plain form after it covers an unbalanced quote.
_TAG = (
    r"<[a-zA-Z][^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+>"
    r"|<[a-zA-Z/!?][^>]*>"
)

# Looked up first; the remaining names come from the standard library's table.
_COMMON_NAMES = ("amp", "lt", "gt", "quot", "apos", "nbsp", "copy", "middot")


def _name_table() -> dict[str, str]:
    return {name.rstrip(";"): value for name, value in html.entities.html5.items()}


def _constant_map(values: dict, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), f"map<{kind},string>")


def _character(code: Column) -> Column:
    """The character of a numeric reference; 128..159 follow windows-1252."""
    legacy = {
        str(i): bytes([i]).decode("cp1252")
        for i in range(128, 160)
        if i not in (129, 141, 143, 144, 157)
    }
    valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    safe = F.when(valid, code).otherwise(F.lit(0xFFFD))
    direct = F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")
    return F.coalesce(
        F.when(
            code.between(128, 159),
            F.try_element_at(_constant_map(legacy, "string"), code.cast("string")),
        ),
        direct,
    )


def decode_entities(text) -> Column:
    """Resolve named and numeric character references once."""
    text = _col(text)
    table = _name_table()
    common = _constant_map({n: table[n] for n in _COMMON_NAMES}, "string")
    full = _constant_map(table, "string")

    def decoded(piece: Column) -> Column:
        found = F.regexp_extract(
            piece, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9.\-]*);?", 0
        )
        name = F.rtrim(found, F.lit(";"))
        rest = F.substr(piece, F.length(found) + 1)
        is_hex = name.rlike("^#[xX]")
        code = F.when(
            is_hex, F.conv(F.substr(name, F.lit(3)), 16, 10).cast("long")
        ).otherwise(F.expr("0L") + F.substr(name, F.lit(2)).try_cast("long"))
        value = F.when(name.startswith("#"), _character(code)).otherwise(
            F.coalesce(F.try_element_at(common, name), F.try_element_at(full, name))
        )
        return F.when(found == "", F.concat(F.lit("&"), piece)).otherwise(
            F.concat(F.coalesce(value, F.concat(F.lit("&"), name)), rest)
        )

    pieces = F.split(text, "&")
    joined = F.array_join(
        F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), ""
    )
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def strip_html(text) -> Column:
    """Visible text with whitespace collapsed; null becomes empty.

    Values without both angle brackets are not markup: only their whitespace is
    collapsed and their character references stay as they are.
    """
    value = F.coalesce(_col(text), F.lit(""))
    plain = F.regexp_replace(value, _COMMENT, " ")
    plain = F.regexp_replace(plain, _RAW_ELEMENTS, " ")
    plain = F.regexp_replace(plain, _HIDDEN_ELEMENTS, " ")
    plain = decode_entities(F.regexp_replace(plain, _TAG, " "))
    markup = F.contains(value, F.lit("<")) & F.contains(value, F.lit(">"))
    return collapse_whitespace(F.when(markup, plain).otherwise(value))


def element_text(markup, element: str) -> Column:
    """Plain text of the first ``element`` in a page."""
    inner = F.regexp_extract(_col(markup), rf"(?is)<{element}\b[^>]*>(.*?)</{element}\s*>", 1)
    # The wrapper makes the value markup, so its character references resolve.
    return strip_html(F.concat(F.lit("<i>"), inner, F.lit("</i>")))
