"""Text helpers shared by the operators: Column builders first, Arrow functions where Unicode
rules (NFC, full case folding) have no JVM built-in."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pageatlas.functions.arrow import arrow_function

STRIP = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"
LINES = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def strip(c: Column) -> Column:
    """Remove Unicode blanks at both ends (``trim`` knows the space only)."""
    return F.regexp_replace(c, STRIP, "")


def split_lines(c: Column) -> Column:
    return F.split(c, LINES)


def collapse_blanks(c: Column) -> Column:
    return F.regexp_replace(strip(F.regexp_replace(c, r"(?U)\s+", " ")), "^ | $", "")


def same_value(text: str | None) -> str:
    """The form in which two values are compared: null is empty, blank runs are one blank,
    letters are composed."""
    if not text:
        return ""
    text = " ".join(text.split())
    return text if text.isascii() else unicodedata.normalize("NFC", text)


def fold(text: str) -> str:
    """Full Unicode case folding, kept composed."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text.casefold())


@arrow_function("struct<attrs:string,place:string>")
def _directory_keys(name: pd.Series, city: pd.Series, state: pd.Series, country: pd.Series) -> pd.DataFrame:
    attrs, place = [], []
    for row in zip(name, city, state, country):
        if row == (None, None, None, None):
            attrs.append("")
            place.append("")
            continue
        n, c, s, k = (same_value(v) for v in row)
        attrs.append("\x1f".join((n, c, s, k)))
        place.append(fold(n) + "\x1f" + fold(c))
    return pd.DataFrame({"attrs": attrs, "place": place})


def directory_keys(*columns: str) -> Column:
    """Of name, city, state and country, ``attrs``: the four in comparison form; ``place``: name and city, folded.

    Rows of ASCII letters, for which the JVM has the rules, do without Python's."""
    plain = ~F.concat_ws("", *columns).rlike(r"[^\x00-\x7f]")
    same = [F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s\x0B\x1C-\x1F]+", " ")) for c in columns]
    folded = F.concat_ws("\x1f", F.lower(same[0]), F.lower(same[1]))
    simple = F.struct(F.concat_ws("\x1f", *same).alias("attrs"), folded.alias("place"))
    return F.when(plain, simple).otherwise(_directory_keys(*[F.when(~plain, F.col(c)) for c in columns]))


@arrow_function("string")
def casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else fold(v))
