"""Names of files and cells of mappings as column expressions."""

from __future__ import annotations

import re
import string
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space at both ends, of any script; Spark's trim takes spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(name: Column) -> Column:
    """A file name without its last suffix; a leading dot begins no suffix."""
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+$", "")


def suffix(name: Column) -> Column:
    """The lower-cased suffix without its dot, or an empty string."""
    return F.lower(F.regexp_extract(name, r"(?s).\.([^.]+)$", 1))


def _class(points: list[int]) -> str:
    """A character class of Java's regular expressions, by ranges."""
    begins = [p for i, p in enumerate(points) if not i or points[i - 1] != p - 1]
    ends = [p for i, p in enumerate(points) if i + 1 == len(points) or points[i + 1] != p + 1]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(begins, ends)) + "]"


@cache
def _composing() -> str:
    """Matches an ASCII letter that composition (NFC) takes up into one with a mark.

    A mark reaches its letter over marks of other combining classes only.
    """
    classes: dict[int, list[int]] = {}
    for p in range(sys.maxunicode + 1):
        if k := unicodedata.combining(chr(p)):
            classes.setdefault(k, []).append(p)
    found = []
    for k, marks in classes.items():
        letters: dict[str, list[int]] = {}
        for m in marks:
            taken = "".join(b for b in string.ascii_letters if unicodedata.normalize("NFC", b + chr(m))[0] != b)
            if taken:
                letters.setdefault(taken, []).append(m)
        others = _class(sorted(p for c, points in classes.items() if c != k for p in points))
        found += [f"[{b}](?={others}*{_class(m)})" for b, m in letters.items()]
    return "|".join(found)


def digest(content: Column) -> Column:
    """SHA-256 of bytes, in lowercase hex digits."""
    return F.sha2(content, 256)


def sanitise(c: Column) -> Column:
    """Only ASCII letters, digits, dots and single hyphens; runs of white space and underscores become a hyphen.

    Decomposed characters count as composed ones (NFC): a letter with a mark goes as a whole.
    """
    c = F.translate(c, "\u212a", "K")  # the sign for kelvin, the one such character that composes to an ASCII letter
    c = F.when(F.rlike(c, F.lit(r"[a-zA-Z]\p{M}")), F.regexp_replace(c, _composing(), "")).otherwise(c)
    c = F.regexp_replace(c, r"(?U)[\s_]+", "-")
    c = F.regexp_replace(c, r"[^a-zA-Z0-9\-.]", "")
    c = F.regexp_replace(c, r"-{2,}", "-")
    return F.regexp_replace(c, r"^[-.]+|[-.]+$", "")


def is_safe(c: Column) -> Column:
    """Letters, digits, underscores and hyphens of any script, at least one."""
    return F.rlike(c, F.lit(r"(?U)^[\w\-]+$"))


def output_name(article: Column, part: Column) -> Column:
    return F.concat(article, F.lit("_"), part, F.lit(".jpg"))


def from_pattern(pattern: str, ext: str, **columns: Column) -> Column:
    """``pattern`` with its {placeholders} filled from columns and {ext}; an unknown one is a KeyError."""
    known = {**columns, "ext": F.lit(ext)}
    parts = [known[name] if name else F.lit(text) for text, name in re.findall(r"([^{}]+)|\{(\w+)\}", pattern)]
    return F.concat(F.lit(""), *parts)


def output_extension(fmt: str) -> str:
    return fmt.lower().replace("jpeg", "jpg")


def replace_first(c: Column, what: Column, by: Column) -> Column:
    """``c`` with the first occurrence of ``what`` replaced; unchanged without one."""
    at = F.instr(c, what)
    return F.when(at > 0, F.concat(F.substring(c, F.lit(1), at - 1), by, F.substring(c, at + F.length(what), F.length(c)))).otherwise(c)
