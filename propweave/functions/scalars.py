"""Scalar functions on property values, all but two inside Spark's own expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

__all__ = ["between", "casefold", "compose", "constant", "html_anchor", "id_prefix", "isbn13", "lookup", "mask_digits", "match", "nfc", "one_of", "prefixes", "replace", "set_replace", "slice_text", "token_sort_key", "trim", "wiki_links", "wiki_patterns"]


def trim(v: Column) -> Column:
    return F.trim(v)


def casefold(v: Column, to: str = "lower") -> Column:
    return F.lower(v) if to == "lower" else F.upper(v)


def slice_text(v: Column, start: int, end: int | None = None) -> Column:
    """Characters from start (0-based) up to end (exclusive, cut at the text's end); absent if the text isn't longer than start."""
    piece = F.substring(v, start + 1, (1 << 30) if end is None else max(0, end - start))
    return F.when(F.length(v) > start, piece)


def replace(v: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(v, pattern, by)


def match(v: Column, pattern: str, template: str | None = None) -> Column:
    """The part that matches, or a template with ${1}, ${2}...; absent without a match."""
    found = v.rlike(pattern)
    if template is None:
        return F.when(found, F.regexp_extract(v, pattern, 0))
    parts = re.split(r"\$\{(\d+)\}", template)
    pieces = [F.lit(p) if i % 2 == 0 else F.regexp_extract(v, pattern, int(p)) for i, p in enumerate(parts)]
    return F.when(found, F.concat(*pieces))


def compose(v: Column, prefix: str = "", postfix: str = "") -> Column:
    return F.concat(F.lit(prefix), v, F.lit(postfix))


def constant(v: Column, value: str) -> Column:
    return F.when(v.isNotNull(), F.lit(value))


def one_of(v: Column, values: list[str]) -> Column:
    return F.when(v.isin(values), v)


def lookup(v: Column, table: dict[str, str], default: str | None = None) -> Column:
    """A small map as an expression; use a join for maps of more than a few hundred entries."""
    entries = F.create_map(*[F.lit(x) for kv in table.items() for x in kv]) if table else F.create_map().cast("map<string,string>")
    found = F.try_element_at(entries, v)
    return found if default is None else F.when(v.isNotNull(), F.coalesce(found, F.lit(default)))


def mask_digits(v: Column, by: str = "N") -> Column:
    return F.regexp_replace(v, r"\d", by)


def prefixes(v: Column) -> Column:
    """All beginnings of a code, shortest first."""
    return F.when(F.length(v) > 0, F.transform(F.sequence(F.lit(1), F.length(v)), lambda n: F.substring(v, F.lit(1), n))).otherwise(F.array().cast("array<string>"))


def isbn13(v: Column) -> Column:
    """A valid ISBN-10 or ISBN-13 as ISBN-13 without hyphens; absent if the check digit is wrong."""
    d = F.upper(F.regexp_replace(v, r"[\s-]", ""))
    digit = lambda i: F.when(F.substring(d, i, 1) == "X", 10).otherwise(F.try_to_number(F.substring(d, i, 1), F.lit("9")).cast("int"))
    weigh13 = lambda n: sum((digit(i) * (3 if i % 2 == 0 else 1) for i in range(1, n + 1)), F.lit(0))
    ok10 = d.rlike(r"^\d{9}[\dX]$") & (sum((digit(i) * (11 - i) for i in range(1, 11)), F.lit(0)) % 11 == 0)
    ok13 = d.rlike(r"^\d{13}$") & (weigh13(13) % 10 == 0)
    body = F.concat(F.lit("978"), F.substring(d, 1, 9))
    sum10 = sum((F.try_to_number(F.substring(body, i, 1), F.lit("9")).cast("int") * (3 if i % 2 == 0 else 1) for i in range(1, 13)), F.lit(0))
    return F.when(ok13, d).when(ok10, F.concat(body, ((10 - sum10 % 10) % 10).cast("string")))


def html_anchor(v: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(f'<a href="{prefix}'), v, F.lit('">'), v, F.lit("</a>"))


def token_sort_key(v: Column) -> Column:
    """Lower-case tokens of letters and digits, different ones of two or more characters, sorted and joined; absent under four characters."""
    tokens = F.regexp_extract_all(F.lower(v), F.lit(r"[\p{L}\d]+"), F.lit(0))
    key = F.array_join(F.sort_array(F.array_distinct(F.filter(tokens, lambda t: F.length(t) >= 2))), "")
    return F.when(F.length(key) >= 4, key)


def wiki_links(v: Column) -> Column:
    """Targets of [[target|label]] links, without anchors, blanks and empty ones."""
    inner = F.regexp_extract_all(v, F.lit(r"\[\[([^\[\]]*)\]\]"), F.lit(1))
    return F.filter(F.transform(inner, lambda x: F.trim(F.regexp_replace(x, r"[|#].*", ""))), lambda x: x != "")


#: Patterns of wiki mark-up: name to pattern.
WIKI = {"reference": r"(?s)<ref[^>/]*>.*?</ref>", "template": r"\{\{[^{}]*\}\}", "url": r"https?://[^\s\]|<>\"]+", "tag": r"<[A-Za-z/][^<>]*>", "comment": r"(?s)<!--.*?-->", "language_link": r"\[\[[a-z]{2,3}(?:-[a-z]+)?:[^\[\]]*\]\]", "link": r"\[\[[^\[\]]*\]\]"}


def wiki_patterns(v: Column, kind: str) -> Column:
    return F.regexp_extract_all(v, F.lit(WIKI[kind]), F.lit(0))


def id_prefix(v: Column, marker: str = "-") -> Column:
    """What stands before the marker in an id; absent without one."""
    return F.when(F.instr(v, marker) > 0, F.substring_index(v, marker, 1))


def between(v: Column, low: str | None, high: str | None) -> Column:
    out = F.lit(True)
    if low is not None:
        out = out & (v >= low)
    return out if high is None else out & (v < high)


@F.pandas_udf(StringType())
def nfc(v: pd.Series) -> pd.Series:
    """Unicode normal form C, which Spark has no function for."""
    return v.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def set_replace(v: Column, table: dict[str, str]) -> Column:
    """Replaces many strings in one pass, the longest first.  Single characters alone stay inside Spark."""
    if all(len(k) == 1 and len(x) <= 1 for k, x in table.items()):
        pairs = sorted(table.items(), key=lambda kv: kv[1] == "")  # translate() drops the characters without a partner
        return F.translate(v, "".join(k for k, _ in pairs), "".join(x for _, x in pairs))
    pattern = re.compile("|".join(map(re.escape, sorted(table, key=len, reverse=True))))

    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else pattern.sub(lambda m: table[m[0]], x))

    return run(v)
