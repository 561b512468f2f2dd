"""Text expressions; all JVM-side, Unicode-aware where the text may be."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse_whitespace(c: Column) -> Column:
    """Runs of any Unicode whitespace become one space, ends trimmed, null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)[\s\x1c-\x1f]+", " "))


def safe_file_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}\-_.]", "_")


def slugify(c: Column) -> Column:
    core = F.regexp_replace(c, r"[^a-zA-Z0-9]+", "_")
    bare = F.lower(F.regexp_replace(core, r"^_+|_+$", ""))
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit("figure"))


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, r"http\S+|www\S+", " ")


def strip_symbols(c: Column) -> Column:
    """Everything but letters, digits, '_', whitespace, apostrophe and hyphen becomes a space."""
    return F.regexp_replace(c, r"(?U)[^\w\s'-]", " ")


def shorten(c: Column, limit: int = 40) -> Column:
    flat = F.replace(c, F.lit("\n"), F.lit(" "))
    return F.when(F.length(flat) > limit, F.concat(F.substring(flat, 1, limit - 3), F.lit("..."))).otherwise(flat)


def last_path_part(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def parent_path_part(c: Column) -> Column:
    return F.try_element_at(F.split(c, "/"), F.lit(-2))


def file_stem(c: Column) -> Column:
    return F.regexp_replace(last_path_part(c), r"(?<=.)\.[^.]*$", "")


def whitespace_words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def headline_features(c: Column) -> dict[str, Column]:
    """Length, word count and punctuation / capitals flags; all caps needs at least one cased letter."""
    return {
        "headline_length": F.length(c),
        "word_count": F.size(whitespace_words(c)),
        "has_exclamation": F.contains(c, F.lit("!")).cast("int"),
        "has_question": F.contains(c, F.lit("?")).cast("int"),
        "is_uppercase": ((F.upper(c) == c) & (F.lower(c) != c)).cast("int"),
    }


def sentiment_label(score: Column, threshold: float = 0.05, strict: bool = False) -> Column:
    up = score > threshold if strict else score >= threshold
    down = score < -threshold if strict else score <= -threshold
    return F.when(up, "positive").when(down, "negative").otherwise("neutral")


def signed_score(label: Column, confidence: Column) -> Column:
    low = F.lower(label)
    return F.when(low.like("%pos%"), confidence).when(low.like("%neg%"), -confidence).otherwise(0.0)
