"""How distinctive a term is of a record: log-entropy weights."""

from __future__ import annotations

import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageatlas.functions.arrow import arrow_function

_LETTERS = regex.compile(r"\p{L}{4,}")
_TAG_BLANKS = regex.compile(r"[\s\-‐‑_]+")


def _canonical(text: str) -> str:
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).lower())


@arrow_function("array<string>")
def terms_of(summary: pd.Series, tags: pd.Series) -> pd.Series:
    """All terms, repeated as often as they occur: whole tags, and runs of 4 or more letters of the
    summary, composed and in lower case. Blanks, hyphens and underscores in a tag are one blank."""
    out = []
    for text, some in zip(summary, tags):
        terms = []
        if some is not None:
            for tag in some:
                if tag and (t := _TAG_BLANKS.sub(" ", _canonical(tag)).strip()):
                    terms.append(t)
        if text:
            terms.extend(_LETTERS.findall(_canonical(text)))
        out.append(terms)
    return pd.Series(out, dtype=object)


def term_counts(focuses: DataFrame, terms: Column | None = None) -> DataFrame:
    """(focus_id, term, tf): first aggregation. Exact duplicate rows count once."""
    rows = focuses.where(F.col("focus_id").isNotNull()).select("focus_id", "summary", "tags").distinct()
    return (
        rows.select("focus_id", F.explode(terms_of("summary", "tags") if terms is None else terms).alias("term"))
        .groupBy("focus_id", "term")
        .agg(F.count("*").alias("tf"))
    )


def term_weights(focuses: DataFrame, min_records: int = 1, max_records: int | None = None) -> DataFrame:
    """(focus_id, term, tf, records, weight) of each term of each focus.

    weight = ln(1 + tf) * (1 - H / ln N): tf is the term's count in the record, H the entropy of its
    counts over the records that carry it, N the number of records. A term of one record weighs most,
    one spread evenly over all records nothing. ``min_records`` and ``max_records`` keep the terms
    that so many distinct records carry; they are applied to the term statistics before these meet the
    counts, so a term that a third of the records carry never has to be joined for rare ones.

    Both aggregations combine map-side. A record without terms (null summary and tags, or nothing long
    enough) has no rows; an empty table gives none.
    """
    counts = term_counts(focuses)
    n = focuses.where(F.col("focus_id").isNotNull()).agg(F.count_distinct("focus_id").alias("n"))
    tf = F.col("tf").cast("double")
    stats = counts.groupBy("term").agg(
        F.count("*").alias("records"), F.sum(tf).alias("gf"), F.sum(tf * F.log(tf)).alias("tlogt")
    )
    stats = stats.where(F.col("records") >= min_records)
    if max_records is not None:
        stats = stats.where(F.col("records") <= max_records)
    entropy = F.log("gf") - F.col("tlogt") / F.col("gf")
    norm = F.log(F.greatest(F.col("n"), F.lit(2)).cast("double"))
    weights = stats.crossJoin(F.broadcast(n)).select("term", "records", (1 - entropy / norm).alias("global"))
    return counts.join(weights, "term").select(
        "focus_id", "term", "tf", "records", (F.log1p(tf) * F.col("global")).alias("weight")
    )
