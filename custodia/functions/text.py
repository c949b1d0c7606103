"""Sentences and word shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTENCE = r"[^.!?]+[.!?]*"
WORD = r"[^\s.,;:!?]+"


def sentences(text: Column) -> Column:
    """Trimmed sentences in order; empty ones are dropped."""
    found = F.transform(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), lambda s: F.trim(F.replace(s, F.lit("\n"), F.lit(" "))))
    return F.filter(found, lambda s: s.rlike(WORD))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def all_keywords(text: Column, keywords: Column) -> Column:
    """Does the text hold every keyword, whatever the case? A null text holds none."""
    return F.coalesce(F.forall(keywords, lambda k: F.contains(F.lower(text), F.lower(k))), F.lit(False))


def shingles(word_list: Column, n: int = 3) -> Column:
    """Distinct runs of ``n`` words; a shorter text is one shingle."""
    runs = word_list
    for i in range(1, n):
        runs = F.zip_with(runs, F.slice(word_list, i + 1, F.greatest(F.size(word_list) - i, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    full = F.array_distinct(F.filter(runs, lambda r: r.isNotNull()))
    return F.when(F.size(word_list) >= n, full).otherwise(F.array(F.array_join(word_list, " ")))


def held(df: DataFrame, name: str) -> DataFrame:
    """The same rows; filters on column ``name`` stay above it, so that it is evaluated once."""
    return df.withColumn(name, F.explode_outer(F.array(name)))


def unnest(df: DataFrame, keep: list[str], items: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per array item, with its 0-based position if asked for.

    An outer explode plus a filter: for an inner explode the optimizer infers a
    size filter that repeats the whole array expression and pushes it below.
    """
    if position is None:
        return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())
    return df.select(*keep, F.posexplode_outer(items).alias(position, name)).where(F.col(position).isNotNull())
