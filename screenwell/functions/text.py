"""Text functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from screenwell.fixed_values import MENTION_PATTERN, SPACE_PATTERN, URL_PATTERN

# Unicode white space plus the four separator controls, as one character class.
BLANK = r"[\s\x1c-\x1f]"
UNICODE = "(?U)"
# Case-blind and Unicode-aware, with a dot that stops at a line feed only.
RULE_FLAGS = "(?iUd)"


def clean_text(*parts: Column) -> Column:
    """Join parts with a blank, drop links and user/forum mentions, collapse white space."""
    text = F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])
    for pattern in (URL_PATTERN, MENTION_PATTERN, SPACE_PATTERN):
        text = F.regexp_replace(text, pattern, " ")
    return F.trim(text)


def strip_blank(text: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.regexp_replace(text, f"{UNICODE}^{BLANK}+|{BLANK}+$", "")


def words(text: Column) -> Column:
    """Lower-case words split on white space; empty parts dropped."""
    return F.array_remove(F.split(F.lower(text), f"{UNICODE}{BLANK}+"), "")


def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by white space; the mark stays."""
    return F.split(text, rf"{UNICODE}(?<=[.!?]){BLANK}+")


def any_of(patterns: list[str]) -> str:
    """One alternation for a list of patterns."""
    return RULE_FLAGS + "(?:" + "|".join(patterns) + ")"


def contains_any(text: Column, keywords: list[str]) -> Column:
    """True when any keyword is a substring of ``text``."""
    hit = F.lit(False)
    for keyword in keywords:
        hit = hit | text.contains(keyword)
    return hit


def first_json(reply: Column, opening: str, closing: str) -> Column:
    """Shortest text from the first opening bracket to the next closing one; NULL without one."""
    found = F.regexp_extract(reply, rf"(?s)\{opening}.*?\{closing}", 0)
    return F.nullif(found, F.lit(""))


def document_text(title: Column, body: Column) -> Column:
    """Title, blank line, body."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit("")))


def iso_now() -> Column:
    """Current UTC time as an ISO string."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def short_time(timestamp: Column) -> Column:
    """First 19 characters of an ISO time with a blank for the ``T``."""
    return F.replace(F.substring(timestamp, 1, 19), F.lit("T"), F.lit(" "))


def title_case(name: Column) -> Column:
    """Underscores to blanks, each word capitalised."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))
