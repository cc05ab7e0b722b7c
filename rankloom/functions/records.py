"""Values out of records whose field names vary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from rankloom.functions.text import _col, collapse_ends, split_list

# Accepted source names per canonical field, best first (fixed values).
FIELD_ALIASES = {
    "id": ["id", "ItemID", "itemId", "ItemId", "documentId", "_id", "key"],
    "title": ["title", "Title", "NavigationTitle", "PageTitle", "MetaTitle", "name", "heading", "pageTitle"],
    "body": ["body", "Content", "Text", "MainText", "content", "text", "html", "Summary", "Abstract", "Introduction", "description"],
    "url": ["url", "ItemUrl", "Url", "link", "permalink", "path"],
    "contentType": ["contentType", "TemplateName", "type", "template", "category"],
    "tags": ["tags", "Tags", "keywords", "Keywords", "Categories", "labels", "topics"],
    "lastModified": ["lastModified", "__Updated", "Updated", "updated", "modified", "__Created", "date", "updatedAt"],
}


def named_values(record) -> Column:
    """The members of a variant object by name; null for anything else."""
    return F.try_variant_get(_col(record), "$", "map<string,variant>")


def value_text(value) -> Column:
    """The text of a variant."""
    return F.try_variant_get(_col(value), "$", "string")


def first_present(values, names: Sequence[str]) -> Column:
    """The first of the named values that is neither missing, null nor empty, as a variant.

    ``values`` come from :func:`named_values`. Whitespace, zero and empty lists count as present.
    """
    named = [F.try_element_at(_col(values), F.lit(n)) for n in names]
    return F.coalesce(*[F.when(value_text(v) != "", v) for v in named])


def split_tags(text) -> Column:
    """Tags out of one string: cut at comma, semicolon or pipe, trim, drop empties."""
    return F.coalesce(split_list(text, ",;|"), F.array().cast("array<string>"))


def clean_tag_list(tags) -> Column:
    """Tags out of a list: trim every element, drop empties and nulls."""
    parts = F.transform(_col(tags), lambda t: collapse_ends(t))
    return F.coalesce(F.filter(parts, lambda t: t != ""), F.array().cast("array<string>"))


def normalise_tags(value) -> Column:
    """A variant holding nothing, a string, a list or another scalar, as tags."""
    value = _col(value)
    kind = F.schema_of_variant(value)
    text = value_text(value)
    return (
        F.when(value.isNull(), F.array().cast("array<string>"))
        .when(kind.startswith("ARRAY"), clean_tag_list(F.try_variant_get(value, "$", "array<string>")))
        .when(kind == "STRING", split_tags(text))
        .when(kind == "BOOLEAN", F.array(F.initcap(text)))
        .otherwise(F.array(text))
    )


def last_named_value(fields, name: str) -> Column:
    """Value of the last ``{name, value}`` entry called ``name``."""
    hits = F.filter(_col(fields), lambda f: f["name"] == name)
    return F.try_element_at(hits, F.lit(-1))["value"]
