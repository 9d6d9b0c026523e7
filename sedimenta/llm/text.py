"""Words and small expression helpers that several operators share."""

from __future__ import annotations

import re
import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What ends a word: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Lower-case words made of letters, digits and everything beyond ASCII.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_PLAIN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

WORD_RE = re.compile(WORD)


def lowered_bytes(text: str | None) -> bytes:
    """A text in UTF-8 with A-Z in lower case; ``split()`` of it gives its words, since bytes know ASCII blanks only."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other letters as they are; ``lower`` is the faster way where it means the same."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def blank_words(text: Column) -> Column:
    """The words of a text, split at blanks; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), "")


def plain_words(text: Column) -> Column:
    """The lower-case alphanumeric words of a text; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_PLAIN), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
