"""Several values packed in one field: one row per value with its place.

Grammar (ordered alternatives, ``/`` tries the next one from the same place)::

    field     <- space (bracketed space !.  /  list)
    bracketed <- '[' list ']' / '{' list '}' / '(' list ')'
    list      <- separator* (value separator*)*
    value     <- quoted &(separator / closing / !.)  /  bare
    quoted    <- '"' ('""' / '\\' . / !'"' .)* '"'   and the same for the single quote
    bare      <- (!separator !closing .)+
    separator <- [,;|] / full-width and Arabic commas / white space / '/' with white space or an end on both sides

A quote that is never closed, or whose closing quote is followed by something that can't follow a value, makes
``quoted`` fail; the parser goes back to its first character and takes a bare value, flagged ``open_quote``. An
opening bracket without its partner (or followed by more) is skipped and the field flagged ``open_bracket``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What stands for "no value", compared without case.
FILLERS = ("", "none", "null", "nan", "-")

_COMMAS = ",;|，；、،｜"
_SEPARATOR = re.compile(rf"(?:[{_COMMAS}\s]|(?<![^\s{_COMMAS}])/(?![^\s{_COMMAS}]))+")
_BARE = re.compile(rf"(?:(?!/(?![^\s{_COMMAS}]))[^{_COMMAS}\s]|(?<=[^\s{_COMMAS}])/)+")
_QUOTED = {
    '"': re.compile(r'"((?:[^"\\]|""|\\.)*+)"', re.S),
    "'": re.compile(r"'((?:[^'\\]|''|\\.)*+)'", re.S),
}
_CLOSING = {"[": "]", "{": "}", "(": ")"}

VALUE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("at", T.IntegerType()),
    ]
)


def parse(text: str | None) -> list[tuple[str, str, str | None, int]]:
    """(value, kind, error flag or None, offset) of every value, fillers and empty places left out.

    Runs in time linear in the text: a quote kind that failed to close once isn't tried again beyond that place.
    """
    if text is None:
        return []
    lo, hi, error, wrapped = 0, len(text), None, False
    while lo < hi and text[lo].isspace():
        lo += 1
    while hi > lo and text[hi - 1].isspace():
        hi -= 1
    if lo < hi and text[lo] in _CLOSING:
        if hi - lo >= 2 and text[hi - 1] == _CLOSING[text[lo]]:
            wrapped = True
            lo, hi = lo + 1, hi - 1
        else:
            error, lo = "open_bracket", lo + 1
    out: list[tuple[str, str, str | None, int]] = []
    never: set[str] = set()  # quotes that don't close from some place on don't close later either
    while lo < hi:
        if m := _SEPARATOR.match(text, lo, hi):
            lo = m.end()
            continue
        flag, c = error, text[lo]
        if c in _QUOTED and c not in never:
            m = _QUOTED[c].match(text, lo, hi)
            if m and (m.end() == hi or _SEPARATOR.match(text, m.end(), hi) or not wrapped and error and text[m.end()] in "]})"):
                value = re.sub(r"\\(.)", r"\1", m[1].replace(c + c, c), flags=re.S).strip()
                if value.lower() not in FILLERS:
                    out.append((value, "quoted", flag, lo))
                lo = m.end()
                continue
            if not m:
                never.add(c)
            flag = "open_quote"
        elif c in _QUOTED:
            flag = "open_quote"
        m = _BARE.match(text, lo, hi)
        if m is None:  # a lone slash that the separator didn't take
            lo += 1
            continue
        value = m[0]
        if flag == "open_quote":
            value = value.strip("\"'")
        if error:
            value = value.rstrip("]})")
        if value.lower() not in FILLERS:
            out.append((value, "bracketed" if wrapped else "bare", flag, lo))
        lo = m.end()
    return out


@F.pandas_udf(T.ArrayType(VALUE))
def parse_packed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(lambda x: [dict(zip(("value", "kind", "error", "at"), v)) for v in parse(x)])


def unpack(df: DataFrame, column: str, keep: list[str], place: str = "value_no", value: str = "matched_value", flags: bool = False) -> DataFrame:
    """One row per value of ``column`` with the columns ``keep``, its ``place`` (int from 1) and the value.

    Null, empty and filler-only fields give no row; a row of ``df`` that comes twice gives its values twice. The
    result has only the columns named, so further columns of ``df`` may have any names. With ``flags`` the columns
    ``kind`` (quoted, bracketed, bare), ``error`` and ``at`` (offset in the text) come along. Fields without a
    quote, bracket or separator skip the parser.
    """
    c = F.col(f"`{column}`")
    packed = c.rlike(rf"[\"'\[\]{{}}()\s/{_COMMAS}]")
    rows = df.select(*[F.col(f"`{k}`") for k in keep], c.alias("_c"), packed.alias("_p"))
    simple = rows.where(~F.coalesce(F.col("_p"), F.lit(False))).select(*[f"`{k}`" for k in keep], F.posexplode(_single("_c")).alias("_i", "_v"))
    hard = rows.where("_p").select(*[f"`{k}`" for k in keep], parse_packed("_c").alias("_a")).select(*[f"`{k}`" for k in keep], F.posexplode("_a").alias("_i", "_v"))
    more = [F.col("_v.kind").alias("kind"), F.col("_v.error").alias("error"), F.col("_v.at").alias("at")] if flags else []
    return simple.unionByName(hard).select(*[f"`{k}`" for k in keep], (F.col("_i") + 1).cast("int").alias(place), F.col("_v.value").alias(value), *more)


def _single(name: str):
    """The array of a field that is one bare value or a filler, over the column ``name``."""
    c = F.col(name)
    one = F.array(F.struct(c.alias("value"), F.lit("bare").alias("kind"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("at"))).cast(T.ArrayType(VALUE))
    return F.when(F.lower(c).isin(*FILLERS) | c.isNull(), F.array().cast(T.ArrayType(VALUE))).otherwise(one)
