"""Text of pages: volatile lines, stated dates, quotes, excerpts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageatlas.functions.text import split_lines, strip

#: What stamps and counters look like.
VOLATILE = r"(?iU)^\W*(this page was\s+)?(last\s+)?(updated|modified|edited)\b.{0,60}$"
COUNTER = r"(?iU)\b\d[\d,]*\s+(visitors?|views?|hits|visits)\b"
STATED = r"(?i)(?:last\s+)?(?:updated|modified|edited)\s*(?:on|:|-)?\s*([^\n\r|]{4,40})"
DATE_FORMATS = ["yyyy-MM-dd", "d MMMM yyyy", "MMMM d, yyyy", "MMMM d yyyy", "d MMM yyyy", "MMM d, yyyy", "MMMM yyyy", "yyyy/MM/dd", "dd.MM.yyyy"]


def normalize(text: Column) -> Column:
    """Counters and stamp lines go, lines lose blanks at their end, runs of empty lines become one."""
    lines = F.transform(split_lines(text), lambda x: F.regexp_replace(F.regexp_replace(x, COUNTER, ""), r"(?U)\s+$", ""))
    kept = F.filter(lines, lambda x: ~strip(x).rlike(VOLATILE))
    return strip(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"))


def stated_date(text: Column) -> Column:
    """The first date, ISO, that follows a word for updating; a missing day is the first."""
    found = F.regexp_extract_all(text, F.lit(STATED), 1)

    def parse(raw):
        s = F.regexp_replace(raw, r"^[ .,:;]+|[ .,:;_*]+$", "")
        return F.coalesce(*[F.to_date(F.try_to_timestamp(s, F.lit(f))) for f in DATE_FORMATS])

    dates = F.filter(F.transform(found, parse), lambda d: d.isNotNull())
    return F.date_format(F.get(dates, F.lit(0)), "yyyy-MM-dd")


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def version_id(url: Column, hashed: Column, fetched_at: Column) -> Column:
    return F.sha1(F.concat(url, F.char(F.lit(0)), hashed, F.char(F.lit(0)), fetched_at))


def one_blank(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)[\s\x{1c}-\x{1f}]+", " "))


def valid_quotes(quotes: Column, text: Column) -> Column:
    """Quotes, blanks made single, that the page contains word for word; empty ones go."""
    page = one_blank(text)
    return F.filter(F.transform(quotes, one_blank), lambda q: (F.length(q) > 0) & F.contains(page, q))


def excerpt(text: Column, chars: int = 280) -> Column:
    """Plain text without mark-up, cut at ``chars`` with an ellipsis only if it is longer."""
    plain = one_blank(F.regexp_replace(text, r"[#*_>`\[\]]|\(http[^)]*\)", ""))
    return F.concat(F.substring(plain, 1, chars), F.when(F.length(plain) > chars, "…").otherwise(""))


def focus_text(summary: Column, tags: Column) -> Column:
    return F.when(F.size(F.coalesce(tags, F.array().cast("array<string>"))) > 0, F.concat(summary, F.lit(" ("), F.array_join(tags, ", "), F.lit(")"))).otherwise(summary)


def tokens(text: Column) -> Column:
    """Lower-case words of at least four letters and nothing else."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), 1), lambda w: w.rlike(r"^\p{L}{4,}$"))
