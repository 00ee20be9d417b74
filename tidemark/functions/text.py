"""Text rules: milestones in titles and labels, redaction, display forms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns. \p{Nd} is any decimal digit; \z is the very end of the text.
LABEL_MILESTONE = r"^M\p{Nd}+\z"
TITLE_MILESTONE = r"\[(M\p{Nd}+)\]"
TITLE_PREFIX = r"^\[M\p{Nd}+\]"
MILESTONE_NUMBER = r"^M([0-9]+)\z"

REDACTED = "[REDACTED]"


def titled_milestone(title: Column) -> Column:
    """First ``[M<n>]`` anywhere in the title, or null."""
    return F.nullif(F.regexp_extract(title, TITLE_MILESTONE, 1), F.lit(""))


def has_milestone_prefix(title: Column) -> Column:
    """True when the title starts with ``[M<n>]``; null titles are false."""
    return F.coalesce(title.rlike(TITLE_PREFIX), F.lit(False))


def milestone_number(milestone: Column) -> Column:
    """Number of ``M<n>``; null for any other text or a number beyond int."""
    digits = F.nullif(F.regexp_extract(milestone, MILESTONE_NUMBER, 1), F.lit(""))
    return digits.try_cast("int")


def redact(message: Column, secrets: Sequence[str | None], max_length: int) -> Column:
    """Blank out each secret, then truncate (in this order, so none is cut in half)."""
    hidden = reduce(
        lambda text, secret: F.replace(text, F.lit(secret), F.lit(REDACTED)),
        [secret for secret in secrets if secret],
        message,
    )
    return F.left(hidden, F.lit(max_length))


def humanise(label: Column) -> Column:
    """``on_track`` -> ``On track``: only the first letter is upper case."""
    spaced = F.replace(label, F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.left(spaced, F.lit(1))), F.lower(F.substr(spaced, F.lit(2))))


def slug(label: Column) -> Column:
    """``In review`` -> ``in-review``."""
    return F.replace(F.lower(label), F.lit(" "), F.lit("-"))


def normalise_term(value: str | None) -> str:
    """A search term as typed, ready to compare with lower-cased text."""
    return (value or "").strip().lower()
