"""Tokenizers by name, token counts and an inverted index."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Frequent German function words (fixed values).
GERMAN_STOP_WORDS = """aber alle als also am an auch auf aus bei bin bis bist da damit dann das dass daß dein deine dem den der des dich die dies diese dieser dieses dir doch dort du durch ein eine einem einen einer eines er es euer eure für hatte hatten hattest hier hinter ich ihr ihre im in ist ja jede jedem jeden jeder jedes jener jenes jetzt kann kannst können könnt machen mein meine mit muß mußt müssen müßt nach nachdem nein nicht nun oder seid sein seine sich sie sind soll sollen sollst sollt sonst soweit sowie und unser unsere unter vom von vor wann warum was weiter weitere wenn wer werde werden werdet weshalb wie wieder wieso wir wird wirst wo woher wohin zu zum zur über""".split()


@F.pandas_udf(ArrayType(StringType()))
def _stemmed(tokens: pd.Series) -> pd.Series:
    known: dict[str, str] = {}

    def stem(w: str) -> str:
        if w not in known:
            known[w] = german_stem(w)
        return known[w]

    return tokens.map(lambda ts: None if ts is None else [stem(t) for t in ts])


def german_stem(word: str) -> str:
    """The public Snowball scheme for German with umlauts written out: regions R1 and R2, then the three suffix steps."""
    vowels = "aeiouyäöü"
    w = word.replace("ß", "ss").replace("ae", "ä").replace("oe", "ö")
    w = "".join("ü" if c == "\0" else c for c in w.replace("que", "qu\1").replace("ue", "\0").replace("\1", "e"))

    def region(start: int) -> int:
        for i in range(start, len(w) - 1):
            if w[i] in vowels and w[i + 1] not in vowels:
                return i + 2
        return len(w)

    r1 = region(0)
    r2 = region(r1)
    r1 = max(r1, 3)
    for s in sorted(("em", "ern", "er", "e", "en", "es"), key=len, reverse=True):
        if w.endswith(s):
            if len(w) - len(s) >= r1:
                w = w[: -len(s)]
                if s in ("e", "en", "es") and w.endswith("niss"):
                    w = w[:-1]
            break
    else:
        if w.endswith("s") and len(w) - 1 >= r1 and w[-2:-1] in tuple("bdfghklmnrt"):
            w = w[:-1]
    for s in ("est", "en", "er"):
        if w.endswith(s):
            if len(w) - len(s) >= r1:
                w = w[: -len(s)]
            break
    else:
        if w.endswith("st") and len(w) - 2 >= r1 and len(w) >= 6 and w[-3] in "bdfghklmnt":
            w = w[:-2]
    for s in sorted(("end", "ung", "ig", "ik", "isch", "lich", "heit", "keit"), key=len, reverse=True):
        if w.endswith(s):
            if len(w) - len(s) >= r2 and not (s in ("ig", "ik", "isch") and w[: -len(s)].endswith("e")):
                w = w[: -len(s)]
            break
    return w.translate(str.maketrans("äöü", "aou"))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\d]+"), F.lit(0))


def german_words(text: Column) -> Column:
    """Lower case, stop words, three or more characters, no numbers or mail addresses."""
    plain = F.regexp_replace(F.lower(text), r"\S+@\S+", " ")
    return F.filter(F.regexp_extract_all(plain, F.lit(r"[\p{L}\d]+"), F.lit(0)), lambda t: (F.length(t) >= 3) & ~t.isin(GERMAN_STOP_WORDS) & ~t.rlike(r"^\d+$"))


def german(text: Column) -> Column:
    """Stems of german_words()."""
    return _stemmed(german_words(text))


#: Tokenizers by name.
TOKENIZERS: dict[str, Callable[[Column], Column]] = {"words": words, "german": german, "blanks": lambda t: F.filter(F.split(t, r"\s+"), lambda w: w != "")}


def count_tokens(df: DataFrame, text: str = "text", tokenizer: str = "words") -> DataFrame:
    """(token, n).  Stems are made of the different words, after these are counted."""
    first = german_words if tokenizer == "german" else TOKENIZERS[tokenizer]
    counts = df.select(F.explode(first(F.col(text))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    if tokenizer != "german":
        return counts
    return counts.select(F.element_at(_stemmed(F.array("token")), 1).alias("token"), "n").groupBy("token").agg(F.sum("n").alias("n"))


def inverted_index(df: DataFrame, record_id: str, fields: dict[str, str]) -> DataFrame:
    """(field, term, id), each once; fields maps a field to its tokenizer."""
    parts = [df.select(F.lit(f).alias("field"), F.explode(F.array_distinct(TOKENIZERS[t](F.col(f)))).alias("term"), F.col(record_id).alias("id")) for f, t in fields.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
