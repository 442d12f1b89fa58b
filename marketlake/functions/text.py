"""Column functions on text."""

from __future__ import annotations

import functools
import html
import operator
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The words looked up in listing names.
NAME_KEYWORDS = [
    "luxury", "cozy", "apartment", "studio", "downtown", "central", "beach", "sea", "ocean", "view", "modern",
    "spacious", "loft", "penthouse", "villa", "pool", "garden", "city center", "old town", "new", "renovated",
    "balcony", "terrace",
]

# Synonym groups of the grouped form.
NAME_SYNONYMS = {
    "kw_luxury": ["luxury", "luxurious"],
    "kw_cozy": ["cozy", "cosy"],
    "kw_apartment": ["apartment", "apt"],
    "kw_studio": ["studio"],
    "kw_downtown": ["downtown", "city center", "city centre", "center", "centre"],
    "kw_beach": ["beach", "seaside", "ocean"],
    "kw_view": ["view", "views"],
    "kw_modern": ["modern", "contemporary"],
}

# Synonym groups of the form with a group for nearly every word.
NAME_SYNONYMS_WIDE = {
    "kw_luxury": ["luxury", "luxurious"],
    "kw_cozy": ["cozy", "cosy"],
    "kw_apartment": ["apartment", "apt"],
    "kw_studio": ["studio"],
    "kw_downtown": ["downtown"],
    "kw_central": ["central", "city center", "citycentre", "city centre"],
    "kw_beach": ["beach"],
    "kw_sea": ["sea"],
    "kw_ocean": ["ocean"],
    "kw_view": ["view", "views"],
    "kw_modern": ["modern"],
    "kw_spacious": ["spacious", "large"],
    "kw_loft": ["loft"],
    "kw_penthouse": ["penthouse"],
    "kw_villa": ["villa"],
    "kw_pool": ["pool"],
    "kw_garden": ["garden"],
    "kw_old_town": ["old town"],
    "kw_new": ["new", "brand new", "newly"],
    "kw_renovated": ["renovated", "refurbished"],
    "kw_balcony": ["balcony"],
    "kw_terrace": ["terrace"],
}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lowered(col) -> Column:
    return F.lower(F.coalesce(_c(col), F.lit("")))


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def strip_chars(col, pattern: str) -> Column:
    """Remove every match of ``pattern``."""
    return F.regexp_replace(_c(col), pattern, "")


def lower(col) -> Column:
    return F.lower(_c(col))


def flag_name(word: str, prefix: str = "kw_") -> str:
    return prefix + word.replace(" ", "_")


def keyword_flags(col, words=NAME_KEYWORDS, prefix: str = "kw_") -> list[Column]:
    """One 0/1 column per word: does the lower-cased text contain it anywhere?"""
    return [_flag(_lowered(col).contains(w)).alias(flag_name(w, prefix)) for w in words]


def synonym_flags(col, groups: dict[str, list[str]] = NAME_SYNONYMS) -> list[Column]:
    """One 0/1 column per group: does the text contain any of its spellings?"""
    return [
        _flag(functools.reduce(operator.or_, [_lowered(col).contains(s) for s in spellings])).alias(name)
        for name, spellings in groups.items()
    ]


def word_flags(col, words=NAME_KEYWORDS, prefix: str = "kw_") -> list[Column]:
    """As :func:`keyword_flags`, but single words must stand alone; phrases still match anywhere.

    Letters of any language and digits count as part of a word.
    """
    text = _lowered(col)
    inside = r"[\p{L}\p{N}_]"
    return [
        _flag(text.contains(w) if " " in w else text.rlike(f"(?<!{inside}){re.escape(w)}(?!{inside})")).alias(flag_name(w, prefix))
        for w in words
    ]


def flag_count(flag_cols: list[str]) -> Column:
    """Sum of 0/1 columns in a row."""
    return functools.reduce(operator.add, [F.coalesce(F.col(c), F.lit(0)) for c in flag_cols], F.lit(0))


def char_len(col) -> Column:
    """Length in characters, 0 for null."""
    return F.length(F.coalesce(_c(col), F.lit("")))


def word_count(col) -> Column:
    """Number of blank-separated words, 0 for null and for blank text."""
    return F.size(F.filter(F.split(F.coalesce(_c(col), F.lit("")), r"\s+"), lambda w: w != ""))


def pair_key(a, b, sep: str = "||", missing: str = "nan") -> Column:
    """Two values joined to one text; a null side shows as ``missing``."""
    return F.concat(F.coalesce(_c(a), F.lit(missing)), F.lit(sep), F.coalesce(_c(b), F.lit(missing)))


def missing_marker(col, text: str = "NA") -> Column:
    """A category of its own for null."""
    return F.coalesce(_c(col), F.lit(text))


def sha256_hex(col) -> Column:
    return F.sha2(_c(col), 256)


def json_field(col, path: str) -> Column:
    """Field of a JSON text, e.g. ``json_field("props", "$.k")``."""
    return F.get_json_object(_c(col), path)


def _unescape(col: Column) -> Column:
    """Character references decoded, in Arrow batches. A local function travels to the executors by value, so
    they do not need this package."""

    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return F.pandas_udf(decode, StringType())(col)


def html_headings(df, id_col: str, html_col: str):
    """Text pieces inside ``title``, ``h1``, ``h2`` and ``h3`` of every page, in order.

    Returns (id, position, tag, heading). Comments, scripts and styles are taken out first; a heading that
    holds inner tags gives one row per non-blank piece of text. Pages stay where they are: no shuffle.
    """
    plain = F.regexp_replace(_c(html_col), r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</(script|style)\s*>", "")
    block = r"(?is)<(title|h[1-3])\b[^>]*>(.*?)</(?:title|h[1-3])\s*>"
    blocks = F.arrays_zip(
        F.regexp_extract_all(plain, F.lit(block), 1).alias("tag"),
        F.regexp_extract_all(plain, F.lit(block), 2).alias("inner"),
    )
    pieces = F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.filter(F.split(b["inner"], r"<[^>]*>"), lambda t: F.trim(F.regexp_replace(t, r"\s+", " ")) != ""),
                lambda t: F.struct(F.lower(b["tag"]).alias("tag"), t.alias("text")),
            ),
        )
    )
    rows = df.select(F.col(id_col), F.posexplode(pieces).alias("position", "piece"))
    text = F.col("piece.text")
    decoded = F.when(text.contains("&"), _unescape(text)).otherwise(text)
    return rows.select(
        id_col, "position", F.col("piece.tag").alias("tag"), F.regexp_replace(decoded, r"^\s+|\s+$", "").alias("heading")
    )
