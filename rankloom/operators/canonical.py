"""Source records to canonical documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rankloom.functions.dates import normalise_modified
from rankloom.functions.markup import strip_html
from rankloom.functions.records import (
    FIELD_ALIASES,
    first_present,
    last_named_value,
    named_values,
    normalise_tags,
    split_tags,
    value_text,
)
from rankloom.functions.text import collapse_ends

CANONICAL = ("id", "title", "body", "url", "contentType", "tags", "lastModified")
DEFAULT_TYPE = "page"


def or_default(value, default: str) -> Column:
    """The value unless it is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def content_type(value) -> Column:
    """Lower-case type name, ``page`` when there is none."""
    return F.lower(collapse_ends(or_default(value, DEFAULT_TYPE)))


def canonicalise(records: DataFrame, as_of: Column, aliases=FIELD_ALIASES) -> DataFrame:
    """Canonical documents of variant records; other columns are carried along.

    ``id`` is null where the record has none (see :func:`require_id`).
    ``lastModified`` is text in the canonical format.
    """
    carried = F.struct(*[c for c in records.columns if c != "record"])
    # One step for the members, one for the chosen values: each is read once.
    members = records.select(carried.alias("_carried"), named_values("record").alias("_members"))
    chosen = members.select("_carried", *[first_present("_members", aliases[f]).alias(f) for f in CANONICAL])
    ident = F.col("id")
    text = {f: value_text(f) for f in CANONICAL if f != "tags"}
    # Zero and false are no usable ids either.
    falsy = ident.isNull() | (
        ~F.schema_of_variant(ident).isin("STRING")
        & F.try_variant_get(ident, "$", "string").isin("0", "0.0", "false", "[]", "{}")
    )
    return chosen.select(
        "_carried.*",
        F.when(~falsy, text["id"]).alias("id"),
        strip_html(text["title"]).alias("title"),
        strip_html(text["body"]).alias("body"),
        collapse_ends(F.coalesce(text["url"], F.lit(""))).alias("url"),
        content_type(text["contentType"]).alias("contentType"),
        normalise_tags("tags").alias("tags"),
        _modified(F.col("lastModified"), text["lastModified"], as_of).alias("lastModified"),
    )


def _modified(value: Column, text: Column, as_of: Column) -> Column:
    """Text is read as a date; zero and false are missing; other values stay as their text."""
    missing = text.isin("0", "false") | (F.try_variant_get(value, "$", "double") == 0)
    other = F.schema_of_variant(value) != "STRING"
    return F.when(other & ~F.coalesce(missing, F.lit(False)), text).otherwise(
        normalise_modified(F.when(~other, text), as_of)
    )


def require_id(docs: DataFrame) -> DataFrame:
    """Fail the job on the first document without an id."""
    checked = F.coalesce("id", F.raise_error(F.lit("document is missing an id")))
    return docs.withColumn("id", checked)


def without_id(docs: DataFrame) -> DataFrame:
    """The documents :func:`require_id` would reject."""
    return docs.where(F.col("id").isNull())


def drop_empty(docs: DataFrame) -> DataFrame:
    """Optional: only documents with a title or a body."""
    return docs.where((F.col("title") != "") | (F.col("body") != ""))


def absolute_url(path, base_url: str = "") -> Column:
    """Base plus path for rooted paths, the base alone for others, the path without base."""
    trimmed = collapse_ends(F.coalesce(path, F.lit("")))
    if not base_url:
        return trimmed
    return F.when(trimmed.startswith("/"), F.concat(F.lit(base_url.rstrip("/")), trimmed)).otherwise(
        F.lit(base_url)
    )


def delivery_records(
    items: DataFrame,
    base_url: str = "",
    title_field: str = "Title",
    body_fields: Sequence[str] = ("Content",),
    tags_field: str | None = None,
) -> DataFrame:
    """Delivery items mapped to the canonical fields; markup stays in place.

    Of several fields with one name the last counts. ``tags`` exists only when a
    tags field is configured.
    """
    fields = F.col("fields")

    def named(name):
        return F.coalesce(last_named_value(fields, name), F.lit(""))

    columns = [
        F.col("id"),
        named(title_field).alias("title"),
        F.concat_ws(" ", *[F.nullif(named(n), F.lit("")) for n in body_fields]).alias("body"),
        absolute_url(F.col("url.path"), base_url).alias("url"),
        or_default(F.col("__typename"), DEFAULT_TYPE).alias("contentType"),
        F.coalesce(
            F.nullif(last_named_value(fields, "__Updated"), F.lit("")),
            last_named_value(fields, "__Created"),
        ).alias("lastModified"),
    ]
    if tags_field:
        columns.append(named(tags_field).alias("tags"))
    return items.select(*columns)


def clean_delivery(records: DataFrame, as_of: Column) -> DataFrame:
    """The second step for delivery records: markup, tags, type and date."""
    tags = split_tags("tags") if "tags" in records.columns else F.array().cast("array<string>")
    return records.select(
        F.nullif("id", F.lit("")).alias("id"),
        strip_html("title").alias("title"),
        strip_html("body").alias("body"),
        collapse_ends(F.coalesce("url", F.lit(""))).alias("url"),
        content_type(F.col("contentType")).alias("contentType"),
        tags.alias("tags"),
        normalise_modified("lastModified", as_of).alias("lastModified"),
    )


def published_pages(
    items: DataFrame, root: str, templates: Sequence[str] = (), has_layout: bool = True
) -> DataFrame:
    """Items below ``root`` that render as pages, optionally of given templates.

    Reads ``path_ids array, has_layout boolean, templates array``.
    """
    keep = F.array_contains("path_ids", root)
    if has_layout:
        keep &= F.col("has_layout")
    wanted = [t.strip() for t in templates if t.strip()]
    if wanted:
        keep &= F.arrays_overlap("templates", F.array(*[F.lit(t) for t in wanted]))
    return items.where(keep)


def latest_by_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``.

    ``max_by`` combines on the map side, so a key with very many versions sends
    one row per task.
    """
    latest = F.max_by(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(F.col(key).alias("_key")).agg(latest.alias("r")).select("r.*")
