"""Splitting, tag lists and labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(text: Column, separator: str) -> Column:
    """Split on a literal separator, dropping trailing empty parts and keeping inner ones.

    An empty text gives one empty part; a text of separators only gives no part at all.
    """
    pattern = re.escape(separator)
    plain = F.when(~text.endswith(separator), F.split(text, pattern, -1))
    if len(separator) == 1:
        stripped = F.rtrim(text, F.lit(separator))
        return plain.when(stripped == "", F.array().cast("array<string>")).otherwise(
            F.split(stripped, pattern, -1)
        )
    # The end of "a:::" may be cut in two ways, so a longer separator is split from the left first.
    parts = F.split(text, pattern, -1)
    from_end = F.array_position(F.transform(F.reverse(parts), lambda part: part != ""), True)
    used = F.when(from_end == 0, F.lit(0)).otherwise(F.size(parts) - from_end + 1)
    return plain.otherwise(F.slice(parts, 1, used.cast("int")))


def words(text: Column) -> Column:
    return java_split(text, " ")


def tag_list(raw: Column, strict: bool = True) -> Column:
    """Tags of a URL-encoded comma list; decoded first, so an encoded comma separates too."""
    decoded = F.url_decode(raw) if strict else F.try_url_decode(raw)
    return java_split(decoded, ",")


def has_tags(tags: Column) -> Column:
    """At least one tag, and not just a single empty one."""
    return (F.size(tags) > 0) & ~((F.size(tags) == 1) & (F.get(tags, F.lit(0)) == ""))


def place_label(place: Column, tags: Column) -> Column:
    """``(place, tag, tag)``."""
    return F.concat(F.lit("("), place, F.lit(", "), F.array_join(tags, ", "), F.lit(")"))


def blank_comma(title: Column) -> Column:
    """Titles lose the comma of ``", "`` and every double quote."""
    return F.replace(F.replace(title, F.lit(", "), F.lit(" ")), F.lit('"'), F.lit(""))


def flag(text: Column) -> Column:
    """Text used as a truth value; text that is neither true nor false is null."""
    return text.try_cast("boolean")
