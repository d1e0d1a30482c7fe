"""Label and message text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise(text: Column) -> Column:
    return F.lower(F.trim(text))


def present(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def ascii_boundaries(pattern: str) -> str:
    r"""Rewrite ``\b`` so that only ASCII letters, digits and ``_`` count as word characters.

    Java's own ``\b`` follows Unicode up to release 18 while ``\w`` does not; messages in
    accented languages would then split differently from the extraction this must agree with.
    A boundary in front of a word or group opens it, any other closes one, as in all patterns here.
    """
    return re.sub(r"\\b(?=[\w(])", r"(?<!\\w)", pattern).replace(r"\b", r"(?!\w)")


def contains_pattern(text: Column, pattern: str) -> Column:
    return text.rlike(ascii_boundaries(pattern))


def first_match(text: Column, pattern: str) -> Column:
    """First capture of the first match, empty when nothing matches."""
    return F.regexp_extract(text, ascii_boundaries(pattern), 1)


def owner(entity: Column) -> Column:
    return F.lower(F.split_part(entity, F.lit("/"), F.lit(1)))
