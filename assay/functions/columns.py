"""Column functions: ids, slugs, small conversions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from assay import vocab


@F.pandas_udf(T.StringType())
def fold_ascii(text: pd.Series) -> pd.Series:
    """Letters without their marks, and nothing outside ASCII (compatibility forms taken apart first)."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


def content_hash(text: Column) -> Column:
    """SHA-256 of the text with ASCII white space collapsed and trimmed."""
    return F.sha2(F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " ")), 256)


def content_id(prefix: str, *parts: Column) -> Column:
    """A short id of its parts: the same parts give the same id wherever and whenever they are hashed."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(F.concat_ws("\u001f", *[p.cast("string") for p in parts]), 256), 1, 12))


def pair_id(prefix: str, a: Column, b: Column) -> Column:
    """An id of two things that doesn't depend on their order."""
    return content_id(prefix, F.least(a, b), F.greatest(a, b))


def slugify(text: Column, most: int = 60, stopwords: tuple[str, ...] = vocab.SLUG_STOPWORDS) -> Column:
    """Lower case, ASCII, hyphens; stop words go where more than two words are there; null where nothing is left."""
    t = F.filter(F.split(F.lower(fold_ascii(text)), "[^a-z0-9]+"), lambda w: w != "")
    kept = F.filter(t, lambda w: ~w.isin(*stopwords))
    chosen = F.when((F.size(t) > 2) & (F.size(kept) > 0), kept).otherwise(t)
    slug = F.regexp_replace(F.substring(F.array_join(chosen, "-"), 1, most), "^-+|-+$", "")
    return F.when(slug != "", slug)


def diameter_mm(text: Column) -> Column:
    """".07", "07" and "0.07" (with or without mm) as 0.07; null for anything else."""
    t = F.regexp_extract(F.lower(F.trim(text)), r"^(0?\.?\d{2})\s*(?:mm)?$", 1)
    return F.when(t != "", F.concat(F.lit("0."), F.regexp_extract(t, r"(\d{2})$", 1)).cast("double"))


def curl_shape(text: Column) -> Column:
    """The letters of a curl, with or without the word curl, "l plus" as L+; null for anything else."""
    name = F.regexp_replace(F.regexp_replace(F.upper(F.trim(text)), r"\s+CURL$", ""), r"^L\s+PLUS$", "L+")
    return F.when(name.isin(*vocab.CURLS), name)


def fan_systems(text: Column) -> Column:
    """The systems that a fan of so many extensions (3D) belongs to, in the order of the vocabulary; none for anything else."""
    fan = F.regexp_extract(F.upper(F.trim(text)), r"^(\d{1,2}D)$", 1)
    systems = F.array(*[F.when(fan.isin(*fans), F.lit(system)) for system, fans in vocab.FAN_SYSTEMS.items()])
    return F.array_compact(systems)


def celsius(value: Column, unit: Column) -> Column:
    return F.when(unit == "°F", (value - 32) * 5 / 9).otherwise(value)


def clock(seconds: Column) -> Column:
    """mm:ss, or dashes without a time."""
    s = seconds.cast("int")
    return F.when(seconds.isNull(), "--:--").otherwise(F.format_string("%02d:%02d", F.floor(s / 60).cast("int"), s % 60))


def straight_quotes(text: Column) -> Column:
    return F.translate(text, "‘’“”–—", "''\"\"--")


def source_id(platform: Column, month: Column, hash_: Column) -> Column:
    """From the platform, the month as yyyymm (null for anything else) and the text's hash."""
    return F.when(month.rlike(r"^\d{6}$"), F.concat_ws("_", F.lit("src"), slugify(platform, stopwords=()), month, F.substring(hash_, 1, 8)))


def chunk_id(source: Column, sequence: Column) -> Column:
    return F.concat(F.lit("chk_"), F.substring_index(source, "_", -1), F.format_string("_%05d", sequence.cast("int")))


def claim_id(source: Column, start: Column, end: Column, statement: Column) -> Column:
    """By source, span and statement, whatever its spacing and case; the quote may change."""
    return content_id("clm", source, start, end, F.lower(F.trim(F.regexp_replace(statement, r"\s+", " "))))


def titled_id(prefix: str, field: Column, title: Column) -> Column:
    """Ids of concepts (cpt), cards (kc) and entities (ent): a domain or type, and the title's slug; a concept and its card share it."""
    return F.concat_ws("_", F.lit(prefix), field, slugify(title))


def parameter_id(card_slug: Column, name: Column) -> Column:
    return F.concat(F.lit("prm_"), card_slug, F.lit("_"), slugify(name))


def relation_id(subject: Column, predicate: Column, object_: Column, qualifier: Column | None = None) -> Column:
    return content_id("rel", subject, predicate, object_, F.lit("") if qualifier is None else F.coalesce(qualifier, F.lit("")))


def contradiction_id(concept: Column, a: Column, b: Column) -> Column:
    """The same for both orders of the two positions, and for any case and outer spaces."""
    a, b = F.lower(F.trim(a)), F.lower(F.trim(b))
    return content_id("ctr", concept, F.least(a, b), F.greatest(a, b))


def deep_link(url: Column, seconds: Column) -> Column:
    """The url at a time in whole seconds; the url itself without a time."""
    mark = F.when(F.contains(url, F.lit("?")), "&t=").otherwise("?t=")
    return F.when(seconds.isNull(), url).otherwise(F.concat(url, mark, F.floor(seconds).cast("string"), F.lit("s")))


@F.pandas_udf(T.StringType())
def composed(text: pd.Series) -> pd.Series:
    """Letters and their marks as one character where there is one (NFC)."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))
