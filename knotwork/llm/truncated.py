"""Texts cut off by field limits or in transfer.

Two kinds of evidence are weighed against each other for every text.

*Length.* For each source a log-normal length distribution is fitted by maximum likelihood with the values at the
source's limits taken as right-censored. Limits are the lengths, in characters or bytes (marks such as an ellipsis set
aside), at which more values lie than the fit expects; a source may have several and longer values. The censoring posterior of a value at the limit is the mass beyond it against the density there.

*Ending.* Text is divided into blocks (notebook JSON is whole exactly if it parses). How lines look at the ends of
all inner blocks of the corpus tells how whole endings look; a cut at a hashed place of every text tells how cut
endings look. The ratio of both likelihoods is formed from the look of the last line, its last word, and the number
of cells against the number the source declared.

The share of cut texts is estimated by expectation maximisation, apart for each limit of a source and for its other
texts. At a limit the censoring posterior is its prior, with the weight of a few texts: whole texts may be filled up to
a limit, so only endings can tell them where there are many. Each text then gets its posterior.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from knotwork.operators.skew import Lookup, lookup_join, lookups
from knotwork.session import Scratch

_MARK = re.compile(r"(?:…|�|(?<=\S)\.\.\.|\[(?:truncated|cut|snip|\.\.\.)\])\s*$")
_SHAPE = re.compile(r"(?P<b>[A-Za-z0-9+/]{40,}={0,2})|(?P<d>-?\d+\.\d+)|(?P<n>-?\d+)|(?P<w>[^\W\d_]\w*)|(?P<s>\s+)|(?P<x>\x1b\[[0-9;]*m)")
_REPEAT = re.compile(r"(.{2,20}?)\1+")
_GOES_ON = re.compile(r"(?:# %%[^\n]*\n)?[#>\s]*(?:[a-zà-ÿ0-9]|$)")
_WORD_END = re.compile(r"([^\W_]+)(\W*)$")
_PREFIX = re.compile(r"^(?:In \[[ \d]*\]: |   \.\.\.: |Out\[[ \d]*\]: ?|# (?:Out\[[ \d]*\]: ?)?|    )")


def _shape_part(m: re.Match) -> str:
    kind = m.lastgroup
    if kind == "d":
        return "9." + "9" * (len(m[0]) - 1 - m[0].index("."))
    if kind == "b":  # whole encoded blocks have a multiple of four letters
        return "B" if (m.end() - m.start()) % 4 == 0 else "b"
    return {"n": "9", "w": "w", "s": " ", "x": "^"}[kind]


def shape(line: str) -> str:
    """The end of a line with its words, numbers and spaces made alike and repeated parts once; decimals keep their places."""
    return _REPEAT.sub(r"\1+", _SHAPE.sub(_shape_part, line.strip()))[-160:]


def layout_of(text: str) -> str:
    """json, percent (cell marks), transcript (prompts) or markdown."""
    head = text.lstrip()
    if head.startswith(("{", "[")):
        return "json"
    if head.startswith("# %%") or "\n# %%" in text:
        return "percent"
    if re.search(r"(?m)^(?:In|Out) ?\[[ \d]*\]:", text):
        return "transcript"
    return "markdown"


def _kind(block: str, layout: str, in_fence: bool) -> str:
    if layout == "percent":
        return "prose" if block.startswith("# %% [m") else "output" if block.startswith("# Out") else "code" if block.startswith("# %%") else "more"
    if layout == "transcript":
        return "code" if block.startswith("In [") else "output" if block.startswith("Out[") else "prose"
    if block.startswith("```") or in_fence:
        return "code"
    return "output" if block.startswith("    ") else "prose"


def look(block: str, layout: str, kind: str) -> tuple[str, str, str]:
    """(shape of the last line, its last word with what follows, how the line continues a run of like lines)."""
    lines = block.rstrip("\n").rsplit("\n", 3)[-3:]
    last = lines[-1]
    if layout == "percent" and kind == "prose":
        last = last[2:] if last.startswith("# ") else last
    elif kind != "prose":
        last = _PREFIX.sub("", last)
    m = _WORD_END.search(last[-80:])
    tail = (m[1].lower() + m[2].strip())[-40:] if m else last[-3:]
    if kind == "prose":
        if last.startswith(("#", "- ", "* ")):
            return ("H" if last[0] == "#" else "L") + str(min(9, len(last.split()))), tail, ""
        return "P" + (last.rstrip()[-1:] if last and not last.rstrip()[-1:].isalnum() else "w"), tail, "space" if last[-1:] == " " else ""
    s, run = shape(last), ""
    if len(lines) == 3 and kind == "output":
        t, u = (shape(_PREFIX.sub("", x)) for x in lines[-2::-1])
        if t == u:
            run = "same" if s == t else "break"
    return s, tail, run or ("space" if last[-1:] == " " else "")


def _balance(block: str, kind: str, layout: str) -> str:
    """Brackets and quotes of a code block: closed or open."""
    if kind != "code":
        return ""
    t = re.sub(r"(?m)^(?:In \[[ \d]*\]: |   \.\.\.: )", "", block)
    if layout == "markdown":
        return "closed" if t.count("```") % 2 == 0 else "open"
    last = t[t.rfind("\n") + 1 :].split("  # ")[0]
    ok = last.count("(") == last.count(")") and last.count("[") == last.count("]") and last.count("'") % 2 == 0 and last.count('"') % 2 == 0
    return "closed" if ok else "open"


def examine(doc_id, text: str, declared) -> tuple[str, list[tuple], list[tuple[str, str, str]]]:
    """(layout, endings, (kind, shape, tail) of the ends of inner blocks).

    An ending is (role, mark, kind, shape, tail, state, cells): role ``end`` for the real one, ``whole`` for an inner
    block's end and ``cut`` for a cut inside, both at places that depend on the id alone.
    """
    layout = layout_of(text)
    seed = zlib.crc32(str(doc_id).encode())
    mark = "mark" if _MARK.search(text[-24:]) else ""
    if layout == "json":
        try:
            json.loads(text)
            ok = "parses"
        except (ValueError, RecursionError):
            ok = "broken"
        return layout, [("end", "", "json", ok, "", "", "")], []
    body = _MARK.sub("", text[-400:]) if mark else text[-400:]
    body = (text[:-400] + body).rstrip("\n")
    blocks = body.split("\n\n")
    starts, cells, kinds = [], [], []
    at = n = 0
    fence = False
    for b in blocks:
        k = _kind(b, layout, fence)
        if layout == "markdown" and b.count("```") % 2:
            opens = not fence
            n += opens
            fence = not fence
        elif layout == "percent":
            n += b.startswith("# %%")
        elif k != "output" and k != "more" and not (fence and layout == "markdown"):
            n += bool(b.strip())
        starts.append(at)
        cells.append(n)
        kinds.append(k)
        at += len(b) + 2

    def ending(role: str, i: int, block: str, mark: str) -> tuple:
        s, tail, run = look(block, layout, kinds[i])
        d = "" if declared is None else ("fewer" if cells[i] < declared else "more" if cells[i] > declared else "equal")
        return role, mark, kinds[i], s, tail, run + "/" + _balance(block, kinds[i], layout), d

    last = len(blocks) - 1
    out = [ending("end", last, blocks[last], mark)]
    inner = [(kinds[i], *look(blocks[i], layout, kinds[i])[:2]) for i in range(last)]
    # a sentence that goes on in the next block says nothing about ends
    ends_at = [i for i in range(last) if not (kinds[i] == "prose" and inner[i][1] == "Pw" and _GOES_ON.match(blocks[i + 1]))]
    if ends_at:
        i = ends_at[seed % len(ends_at)]
        r, m, k, s, tail, state, _ = ending("whole", i, blocks[i], "")
        out.append((r, m, k, s, tail, state, ""))
    if len(body) > 20:
        cut = 10 + (seed * 2654435761 >> 7) % (len(body) - 10)
        i = int(np.searchsorted(starts, cut, side="right")) - 1
        part = blocks[i][: max(1, cut - starts[i])]
        out.append(ending("cut", i, part, ""))
    return layout, out, inner


_EXAMINED = (
    "doc_id string, source string, chars long, bytes long, h long, layout string, "
    "endings array<struct<role:string, mark:string, kind:string, shape:string, tail:string, state:string, cells:string>>, "
    "inner array<struct<kind:string, shape:string, tail:string, n:long>>"
)
_E = ("role", "mark", "kind", "shape", "tail", "state", "cells")
_I = ("kind", "shape", "tail", "n")


def _examine_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows, ends = [], Counter()
        for doc_id, source, text, declared in zip(batch["doc_id"], batch["source"], batch["text"], batch["declared"]):
            declared = None if declared is None or declared != declared else int(declared)
            layout, endings, inner = examine(doc_id, text, declared)
            ends.update(inner)
            stripped = _MARK.sub("", text) if _MARK.search(text[-24:]) else text
            rows.append((doc_id, source, len(stripped), len(stripped.encode("utf-8", "replace")), zlib.crc32(text.encode("utf-8", "replace")), layout, [dict(zip(_E, e)) for e in endings], []))
        rows.append((None, None, 0, 0, 0, None, [], [dict(zip(_I, (*k, n))) for k, n in ends.items()]))
        yield pd.DataFrame(rows, columns=["doc_id", "source", "chars", "bytes", "h", "layout", "endings", "inner"])


def _bucket(c) -> F.Column:
    c = F.coalesce(c, F.lit(0))
    return F.when(c == 0, "0").when(c < 3, "1").when(c < 10, "3").otherwise("10")


def _normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def censored_fit(n: float, s1: float, s2: float, censored, limit) -> tuple[float, float]:
    """Mean and deviation of the logarithm of the length, ``censored`` values known only to reach ``limit``.

    Both may be lists, of several limits. Expectation maximisation on the sufficient statistics of the uncensored
    values: the censored ones count with the first two moments of the normal distribution beyond their limit.
    """
    c, lim = np.atleast_1d(np.asarray(censored, float)), np.atleast_1d(np.asarray(limit, float))
    total = n + c.sum()
    mu = float(s1 + (c * lim).sum()) / max(total, 1)
    sd = math.sqrt(max(float(s2 + (c * lim**2).sum()) / max(total, 1) - mu * mu, 1e-4))
    for _ in range(200):
        z = (lim - mu) / sd
        h = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) / np.maximum([_normal_sf(v) for v in z], 1e-12)
        e1, e2 = mu + sd * h, mu * mu + sd * sd + sd * (lim + mu) * h
        new_mu = float(s1 + (c * e1).sum()) / total
        new_sd = math.sqrt(max(float(s2 + (c * e2).sum()) / total - new_mu**2, 1e-4))
        if abs(new_mu - mu) + abs(new_sd - sd) < 1e-7:
            return new_mu, new_sd
        mu, sd = new_mu, new_sd
    return mu, sd


#: A value within so many characters or bytes below a limit of its source is at it.
NEAR = 4
#: Chance that a source without a limit shows one by the number of its lengths.
CHANCE = 0.01
#: So many texts the censoring posterior counts for in the share of cut texts at a limit.
WEIGHT = 4.0
_RATES = "source string, at_limit boolean, lr double, prior double, posterior double"


def _share(cells: pd.DataFrame) -> pd.DataFrame:
    """Posterior of a cut for every likelihood ratio met in one source.

    At a limit the censoring posterior counts like WEIGHT texts, so it decides where few texts are at the limit or their
    endings say little, and endings overrule it where whole texts fill the limit up.
    """
    out = []
    for (at, prior), part in cells.groupby(["at_limit", "prior"]):
        lr, n = part["lr"].to_numpy(float), part["n"].to_numpy(float)
        weight = WEIGHT if at else 1.0
        pi = prior
        for _ in range(300):
            new = float((n * pi * lr / (pi * lr + 1 - pi)).sum() + weight * prior) / (n.sum() + weight)
            if abs(new - pi) < 1e-9:
                break
            pi = new
        out.append(pd.DataFrame({"source": part["source"], "at_limit": at, "lr": lr, "prior": part["prior"], "posterior": pi * lr / (pi * lr + 1 - pi)}))
    return pd.concat(out)


def judge(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", cells_column: str | None = "n_cells") -> DataFrame:
    """(doc_id, source, at_limit, posterior) of every text; doc_id as a string.

    Null and empty texts get posterior 0, a null source is the source ``unknown``. Repeated rows are judged alike.
    ``cells_column`` holds the number of cells the source declared, where there is one.
    """
    scratch = Scratch(spark)
    declared = F.col(f"`{cells_column}`").cast("double") if cells_column else F.lit(None).cast("double")
    base = docs.select(
        F.col(f"`{id_column}`").cast("string").alias("doc_id"), F.coalesce(F.col(f"`{source_column}`").cast("string"), F.lit("unknown")).alias("source"),
        F.col(f"`{text_column}`").alias("text"), declared.alias("declared"),
    ).where("text is not null and text <> ''")
    seen = scratch.cut(base.mapInPandas(_examine_all, _EXAMINED))
    inner = seen.where("doc_id is null").select(F.explode("inner").alias("i")).select("i.*")
    shapes = scratch.cut(inner.groupBy(F.concat_ws("\x01", "kind", "shape").alias("sk")).agg(F.sum("n").alias("sn")))
    tails = scratch.cut(inner.groupBy(F.concat_ws("\x01", "kind", "tail").alias("tk")).agg(F.sum("n").alias("tn")))
    texts = seen.where("doc_id is not null")
    ends = texts.select("doc_id", "source", "chars", "bytes", "layout", F.explode("endings").alias("e")).select("doc_id", "source", "chars", "bytes", "layout", "e.*")
    ends = ends.withColumn("_s", F.concat_ws("\x01", "kind", "shape")).withColumn("_t", F.concat_ws("\x01", "kind", "tail"))
    ends = lookups(ends, Lookup("_s", shapes, "sk", "sn", "sn", keep=True), Lookup("_t", tails, "tk", "tn", "tn", keep=True))
    # a ``whole`` ending is itself one of the counted ones
    own = F.when(F.col("role") == "whole", 1).otherwise(0)
    prose = F.col("shape").rlike("^[PHL]") & (F.col("kind") == "prose")
    ends = scratch.cut(ends.select(
        "doc_id", "source", "chars", "bytes", "layout", "role", "mark", "kind", "shape",
        F.concat_ws("|", "kind", F.when(prose, F.col("shape")).otherwise(_bucket(F.col("sn") - own)), "state").alias("g1"),
        F.concat_ws("|", "kind", F.when(prose & F.col("shape").rlike("^P[.?!:]"), "S").when(prose, F.substring("shape", 1, 1)).otherwise(_bucket(F.col("sn") - own)), _bucket(F.col("tn") - own)).alias("g2"),
        F.concat_ws("|", "layout", "cells").alias("g3"), "cells",
    ))
    # the last word is judged given the kind of line; after a sentence's end it says nothing
    lr, looks = F.lit(0.0), {}
    for g in ("g1", "g2"):
        within = F.lit("") if g == "g1" else F.substring_index("_g", "|", 2)
        t = ends.where("role in ('whole', 'cut')").groupBy(F.col(g).alias("_g")).agg(F.count_if(F.col("role") == "cut").alias("c"), F.count_if(F.col("role") == "whole").alias("w"))
        # a few thousand looks at most stand in a window
        w = Window.partitionBy(within)
        t = t.select("_g", F.log((F.col("c") + 0.5) / (F.sum("c").over(w) + 1) / ((F.col("w") + 0.5) / (F.sum("w").over(w) + 1))).alias(f"l_{g}"))
        if g == "g2":
            t = t.where(~F.col("_g").contains("|S|"))
        looks[g] = scratch.cut(t)
        lr = lr + F.coalesce(f"l_{g}", F.lit(1.0 if g == "g1" else 0.0))
    # cells: cut places say how often fewer cells remain; of whole texts the declared number is taken as true
    c = scratch.cut(ends.where("role = 'cut' and cells <> ''").groupBy("layout").agg(F.avg((F.col("cells") == "fewer").cast("double")).alias("few")))
    limits = scratch.cut(limits_of(texts))
    scored = lookups(
        ends.where("role = 'end'"), Lookup("g1", looks["g1"], "_g", "l_g1", "l_g1", keep=True), Lookup("g2", looks["g2"], "_g", "l_g2", "l_g2", keep=True),
        Lookup("layout", c, "layout", "few", "few", keep=True), Lookup("source", limits, "source", "of", "of", keep=True),
    )
    few = F.coalesce("few", F.lit(0.8))
    lr = lr + F.when(F.col("cells") == "fewer", F.log(few / 0.01)).when(F.col("cells") == "equal", F.log((1 - few + 0.01) / 0.98)).otherwise(0.0)
    lr = lr + F.when(F.col("mark") == "mark", 7.0).otherwise(0.0)
    lr = F.when(F.col("kind") == "json", F.when(F.col("shape") == "broken", 14.0).otherwise(-14.0)).otherwise(lr)
    scored = scored.withColumn("lr", F.exp(F.round(F.greatest(F.lit(-14.0), F.least(F.lit(14.0), lr)), 2)))
    x = lambda o: F.when(o["measure"] == "chars", F.col("chars")).otherwise(F.col("bytes"))
    prior = F.array_max(F.transform(F.filter("of", lambda o: (x(o) > o["limit"] - NEAR) & (x(o) <= o["limit"])), lambda o: o["prior"]))
    scored = scratch.cut(scored.select("doc_id", "source", prior.isNotNull().alias("at_limit"), "lr", F.coalesce(prior, F.lit(0.02)).alias("prior")))
    cells = scored.groupBy("source", "at_limit", "lr", "prior").agg(F.count("*").alias("n"))
    rates = scratch.cut(cells.groupBy("source").applyInPandas(_share, _RATES).select(F.concat_ws("\x01", "source", "at_limit", "lr", "prior").alias("k"), "posterior"))
    judged = lookup_join(scored.withColumn("_k", F.concat_ws("\x01", "source", "at_limit", "lr", "prior")), "_k", rates, "k", "posterior", "posterior")
    rest = docs.where(f"`{text_column}` is null or `{text_column}` = ''").select(
        F.col(f"`{id_column}`").cast("string").alias("doc_id"), F.coalesce(F.col(f"`{source_column}`").cast("string"), F.lit("unknown")).alias("source"), F.lit(False).alias("at_limit"), F.lit(0.0).alias("posterior")
    )
    return judged.select("doc_id", "source", "at_limit", "posterior").unionByName(rest)


_LIMIT = "source string, of array<struct<measure:string, limit:double, prior:double, at:long>>"


def _poisson_tail(k: int, mean: float) -> float:
    """Bound on the chance of ``k`` or more where ``mean`` are expected, for k above it (Chernoff)."""
    return math.exp(k - mean - k * math.log(k / max(mean, 1e-12))) if k > mean else 1.0


def _limits_in(x: np.ndarray, w: np.ndarray) -> list[tuple[float, float, int]]:
    """(limit, censoring posterior, values there) of lengths ``x``, ascending, that occur ``w`` times each.

    A length is a limit if more values lie within NEAR below it than the log-normal fit expects there, the values at
    the limits found so far taken as censored. The largest excess is taken first and the rest fitted again. At the
    largest length no correction for the number of places looked at is needed.
    """
    y, before = np.log(np.maximum(x, 1.0)), np.concatenate(([0], np.cumsum(w)))
    at = before[1:] - before[np.searchsorted(x, x - NEAR, side="right")]
    total, found, free, out = float(w.sum()), [], np.ones(len(x), bool), []
    while True:
        n = float(w[free].sum())
        if n < 5:
            break
        mu, sd = censored_fit(n, float((w * y)[free].sum()), float((w * y * y)[free].sum()), [at[i] for i in found], [y[i] for i in found])
        z = (y - mu) / sd
        density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) / sd * NEAR / np.maximum(x, 1.0)
        expected = density * total
        out = []
        for i in found:
            # where values go on above, only the excess was censored
            odds = min(_normal_sf(z[i]) / max(density[i], 1e-12), max(at[i] - expected[i], 0.0) / max(expected[i], 1e-12))
            out.append((float(x[i]), odds / (1 + odds), int(at[i])))
        likely = free & (at >= 3) & (at > 4 * expected + 3)
        fits = [i for i in np.flatnonzero(likely) if i == len(x) - 1 or _poisson_tail(int(at[i]), expected[i]) * len(x) < CHANCE]
        if not fits:
            # the largest length is tried as censored, too: a fit without that may follow it
            i = len(x) - 1
            if not free[i] or at[i] < 3 or w[free & (x <= x[i] - NEAR)].sum() < 5:
                break
            rest = free & (x <= x[i] - NEAR)
            m, s = censored_fit(float(w[rest].sum()), float((w * y)[rest].sum()), float((w * y * y)[rest].sum()), [at[j] for j in [*found, i]], [y[j] for j in [*found, i]])
            e = math.exp(-(((y[i] - m) / s) ** 2) / 2) / math.sqrt(2 * math.pi) / s * NEAR / x[i] * total
            if at[i] <= 4 * e + 3:
                break
            fits = [i]
        best = max(fits, key=lambda i: (at[i] - expected[i], x[i]))
        found.append(best)
        free &= ~((x > x[best] - NEAR) & (x <= x[best]))
    return out


def _limit(lengths: pd.DataFrame) -> pd.DataFrame:
    best: list[dict] = []
    for measure, part in lengths.sort_values(["measure", "x"], ascending=[False, True]).groupby("measure", sort=False):
        found = [{"measure": measure, "limit": l, "prior": p, "at": n} for l, p, n in _limits_in(part["x"].to_numpy(float), part["n"].to_numpy(float))]
        # a limit of characters echoes in bytes as many small piles
        if max((f["at"] for f in found), default=0) > max((f["at"] for f in best), default=0):
            best = found
    return pd.DataFrame({"source": [lengths["source"].iloc[0]], "of": [best or None]})


def limits_of(lengths: DataFrame) -> DataFrame:
    """(source, of) with the limits of every source that has any: measure, limit, censoring posterior, values there.

    Repeated texts (equal ``h``) count once. A source's lengths are one row each, so what a task holds grows with the longest text and not with the rows.
    """
    long = lengths.select("source", "h", F.explode(F.array(F.struct(F.lit("chars").alias("measure"), F.col("chars").alias("x")), F.struct(F.lit("bytes").alias("measure"), F.col("bytes").alias("x")))).alias("m")).select("source", "h", "m.*")
    counted = long.groupBy("source", "measure", "x").agg(F.count_distinct("h").alias("n"))
    return counted.groupBy("source").applyInPandas(_limit, _LIMIT).where("of is not null")


def truncated(spark: SparkSession, docs: DataFrame, least: float = 0.5, **columns) -> DataFrame:
    """(doc_id) of the texts whose posterior of a cut is ``least`` or more, each id once."""
    found = judge(spark, docs, **columns).where(F.col("posterior") >= least).select("doc_id").distinct()
    kind = docs.schema[columns.get("id_column", "doc_id")].dataType
    return found.select(F.col("doc_id").cast(kind).alias("doc_id"))


def truncation_rates(spark: SparkSession, docs: DataFrame, least: float = 0.5, **columns) -> DataFrame:
    """(source, documents, truncated, rate, at_limit) of every source."""
    found = judge(spark, docs, **columns)
    cut = F.count_if(F.col("posterior") >= least)
    return found.groupBy("source").agg(F.count("*").alias("documents"), cut.alias("truncated"), (cut / F.count("*")).alias("rate"), F.count_if("at_limit").alias("at_limit"))
