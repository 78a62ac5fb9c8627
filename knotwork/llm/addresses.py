"""Postal addresses of the same place, written differently.

Addresses are parsed into components whatever their order (house number, street, kind of street, town, state, postal
code; unit, floor, box and landmark are set aside), abbreviations are expanded by dictionaries of the three locales,
and the components are joined on hierarchical keys: house number and street with town, with postal code, and, where
one side names neither, with state. A missing component is no contradiction, but alone it is no evidence either: an
address without a town joins a place only if all places it agrees with are one.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knotwork.functions.memo import Memo
from knotwork.functions.similarity import jaro_winkler, osa
from knotwork.llm.groups import labels_of
from knotwork.llm.names import _near, _near_table, code, plain
from knotwork.operators.skew import lookup_join
from knotwork.session import Scratch

# States and regions with their codes.
STATES = {
    "US": "alabama al, alaska ak, arizona az, arkansas ar, california ca, colorado co, connecticut ct, delaware de, florida fl, georgia ga, hawaii hi,"
    " idaho id, illinois il, indiana in, iowa ia, kansas ks, kentucky ky, louisiana la, maine me, maryland md, massachusetts ma, michigan mi,"
    " minnesota mn, mississippi ms, missouri mo, montana mt, nebraska ne, nevada nv, new hampshire nh, new jersey nj, new mexico nm, new york ny,"
    " north carolina nc, north dakota nd, ohio oh, oklahoma ok, oregon or, pennsylvania pa, rhode island ri, south carolina sc, south dakota sd,"
    " tennessee tn, texas tx, utah ut, vermont vt, virginia va, washington wa, west virginia wv, wisconsin wi, wyoming wy",
    "India": "andhra pradesh ap, assam as, bihar br, chhattisgarh cg, delhi dl, goa ga, gujarat gj, haryana hr, himachal pradesh hp, jharkhand jh,"
    " karnataka ka, kerala kl, madhya pradesh mp, maharashtra mh, odisha od, punjab pb, rajasthan rj, tamil nadu tn, telangana tg,"
    " uttar pradesh up, uttarakhand uk, west bengal wb",
    "France": "auvergne ara, bourgogne bfc, bretagne bre, corse cor, grand est ges, hauts de france hdf, ile de france idf, normandie nor,"
    " nouvelle aquitaine naq, occitanie occ, pays de la loire pdl, provence pac",
}

# Kinds of street and their abbreviations.
KINDS = {
    "street": "street st str", "road": "road rd", "cross road": "cross|road cross|rd x|road x|rd", "lane": "lane ln", "court": "court ct crt",
    "drive": "drive dr drv", "avenue": "avenue ave av aven", "boulevard": "boulevard blvd boul bd bld bvd", "marg": "marg mg", "place": "place pl",
    "rue": "rue r", "way": "way wy", "highway": "highway hwy", "square": "square sq", "circle": "circle cir", "terrace": "terrace ter", "parkway": "parkway pkwy",
}

# Further kinds of street and of settlement, which serve where the ones above find none.
MORE_KINDS = {
    "trail": "trail trl", "hollow": "hollow holw", "ridge": "ridge rdg", "run": "run", "pike": "pike", "turnpike": "turnpike tpke", "loop": "loop",
    "crossing": "crossing xing", "point": "point", "cove": "cove cv", "alley": "alley aly", "bend": "bend bnd", "crescent": "crescent cres", "close": "close",
    "mews": "mews", "parade": "parade pde", "row": "row", "walk": "walk", "path": "path", "pass": "pass", "plaza": "plaza plz", "park": "park", "grove": "grove grv",
    "creek": "creek crk", "acres": "acres", "gardens": "gardens gdns garden", "heights": "heights hts", "hill": "hill hl", "view": "view vw", "freeway": "freeway fwy",
    "expressway": "expressway expy", "route": "route rte", "county road": "cr", "broadway": "broadway", "quay": "quay quai", "allee": "allee all", "impasse": "impasse imp",
    "chemin": "chemin che", "cours": "cours", "route de": "rte|de", "faubourg": "faubourg fbg", "sentier": "sentier", "nagar": "nagar ngr", "colony": "colony col",
    "layout": "layout lyt", "enclave": "enclave encl", "vihar": "vihar", "society": "society soc socy", "extension": "extension extn", "main": "main", "cross": "cross",
    "block": "block blk", "sector": "sector sec", "phase": "phase ph", "village": "village vill", "estate": "estate", "market": "market mkt", "bazar": "bazar bazaar", "chowk": "chowk",
    "gali": "gali galli", "puram": "puram", "bagh": "bagh", "complex": "complex", "tower": "tower twr", "plot": "plot",
}

# Ordinals in words.
ORDINALS = {w: f"{i}{e}" for i, (w, e) in enumerate(zip("first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split(), ["st", "nd", "rd", *["th"] * 9]), 1)}

# Fillers that stand for no address.
FILLERS = frozenset(["", "nan", "none", "null", "n/a", "na", "-", "unknown"])

_STATE_NAMES = {n.rsplit(" ", 1)[0].replace(" ", ""): n.rsplit(" ", 1)[0] for s in STATES.values() for n in s.split(", ")}
_STATE_CODES: dict[str, list[str]] = {}
for _s in STATES.values():
    for _n in _s.split(", "):
        _STATE_CODES.setdefault(_n.rsplit(" ", 1)[1], []).append(_n.rsplit(" ", 1)[0])
_STATE_NEAR = _near_table({n: n for n in _STATE_NAMES})
_MORE_OF = {a.replace("|", " "): k for k, v in {**KINDS, **MORE_KINDS}.items() for a in v.split()}
_KIND_OF = {a.replace("|", " "): k for k, v in KINDS.items() for a in v.split()}
_BEFORE = ("avenue", "boulevard", "place", "rue", "square")  # kinds that may stand in front of the name

_UNIT = re.compile(
    r"\b(?:apt|appt|apartment|unit|suite|ste|flat(?:\s+no)?|shop(?:\s+no)?|floor|fl|p\.?\s?o\.?\s+box|box|bat|etage|bldg|building|room|rm)\b"
    r"[\s.\-#:]*\d+[a-z]?\b|\b\d+(?:st|nd|rd|th|e|er)\s+(?:floor|etage)\b"
)
_LANDMARK = re.compile(
    r"\b(?:near|nr|opp|opposite|behind|b/h|next to|beside)\b[.\s]*[\w.]+(?:\s+[\w.]+)??\s+"
    r"(?:temple|school|market|bus\s+stand|bus\s+stop|station|hospital|bank|park|mosque|masjid|church|mall|post office|college|cinema)\b"
)
_COUNTRY = re.compile(r"(?:^|(?<=[|\s]))(?:france|india|bharat|u\.?s\.?a\.?|united states(?: of america)?)\s*(?=$|\|)")
_CUT = re.compile(r"\s*(?:[,;\n]|\s[-–|]\s)\s*")
_KIND = "|".join(sorted((re.escape(a).replace(r"\ ", r"\s+") for a in _KIND_OF), key=len, reverse=True))
_BEFORE_WORDS = "|".join(sorted((a for a, k in _KIND_OF.items() if k in _BEFORE), key=len, reverse=True))
_HOUSE = r"(?:\b(?:h\.?\s?no|door\s+no|plot\s+no|plot|house\s+no|no)\b[.:\s]*|#\s*)*(?<![\w/\-])(\d{1,6})(?:\s?/\s?[a-z0-9]\b|[a-z]\b|\s(?:bis|ter)\b)?"
_AFTER = re.compile(rf"{_HOUSE}[|\s,.]+((?:[a-z']+\s+){{0,2}}?[a-z']{{3,}})\s+({_KIND})\b\.?(?=\s*(?:$|\||\s))")
_FRONT = re.compile(rf"{_HOUSE}[|\s,.]+({_BEFORE_WORDS})\b\.?\s*([a-z']{{3,}})")
_BARE = re.compile(rf"{_HOUSE}[|\s,.]+([a-z']{{5,}})\b")
_POSTAL = re.compile(r"(?<![\w#])(\d{6}|\d{5})(?:-\d{4})?(?!\w)")
_OCR = re.compile(r"(?<![a-z0-9])(?=[0-9oilsb]*\d)[0-9oil]{2,6}(?=/[a-z0-9]\b|[^a-z0-9]|$)")
_LABEL = r"(?:\b(?:h\s?\.?\s?no|hn|house\s+no|house|door\s+no|d\.?\s?no|plot\s+nos?|plot|pt\.?\s+no|kh\.?\s+no|s\.?\s?no|survey\s+no|building\s+no|bungalow\s+no|sh?p\.?\s+no|no)\b[.:\s\-]*|#\s*)"
# a number, perhaps with a letter or two in front, and its further parts
_PARTS = r"(?!\d+(?:st|nd|rd|th)\b|no\b|hn\b)(?:[a-z]{1,2}-?)?\d{1,6}[a-z]?(?:\s1/2)?(?:[-/]\s?[a-z0-9]{1,5}(?![a-z0-9])){0,6}"
_MORE = "|".join(sorted((re.escape(a).replace(r"\ ", r"\s+") for a in _MORE_OF), key=len, reverse=True))
_ANY_AFTER = re.compile(rf"(?<![\w/\-])({_PARTS})-?[|\s,.]+((?:[a-z0-9'.\-]+\s+){{0,4}}?[a-z0-9'.\-]+)\s+({_MORE})\b\.?(?=\s*(?:$|\||\s))")
_LABELLED = re.compile(rf"{_LABEL}({_PARTS})(?!\w)")
_LEADING = re.compile(rf"(?:^|\|)\s*({_PARTS})(?!\w)")
_STREET_NEXT = re.compile(rf"[\s.]+(?!\d+\b)(?:[a-z0-9'.\-]+\s+){{1,4}}?(?:{_MORE})\b")
_SUFFIX = re.compile(r"(?<=\d)(?:[-/]?\s?[a-z])$")
_WORD = re.compile(r"[a-z0-9']+")
_LETTER = str.maketrans("013578", "oiestb")


_RUN = re.compile(r"[a-z0-9]+")
_NUMBERED = re.compile(r"\d+(?:[a-z]|st|nd|rd|th|er)?")


def _letters(m: re.Match) -> str:
    """A word in which digits were typed for letters, with letters; numbers with a letter or an ending stay."""
    w = m[0]
    if w.isalpha() or _NUMBERED.fullmatch(w):
        return w
    return re.sub(r"(?<=[aeiou])1|1(?=[aeiou])", "l", w).translate(_LETTER)


@Memo
def state_of(word: str) -> str | None:
    return _near(word, _STATE_NAMES, _STATE_NEAR, 2) if len(word) >= 4 else None


def _segments(t: str) -> tuple[str, str]:
    """(text with segments parted by bars, postal code) without units, landmarks, country and postal code."""
    t = _CUT.sub("|", t)
    t = _UNIT.sub("|", t)
    t = _LANDMARK.sub("|", t)
    t = _COUNTRY.sub("|", t)
    for m in reversed(list(_POSTAL.finditer(t))):
        # a number in front of a street is a house number, however long
        if not (t[: m.start()].rstrip(" #")[-1:] in ("", "|") and _STREET_NEXT.match(t, m.end())):
            return re.sub(r"\s+", " ", t[: m.start()] + "|" + t[m.end() :]), m[1]
    return re.sub(r"\s+", " ", t), ""


def _at_large(t: str) -> tuple[str, str, str, int, int] | None:
    """(house, street, kind, from, to) where the streets of the grammar are not met.

    In this order: a house number and some words before any kind of street or settlement; a number under a label; a
    number that begins a segment. The street is what follows in the segment, or the next segment that holds a word.
    """
    if m := _ANY_AFTER.search(t):
        house, street, kind, end = m[1], m[2], _MORE_OF[re.sub(r"\s+", " ", m[3])], m.end()
    else:
        m = _LABELLED.search(t) or _LEADING.search(t)
        if not m:
            return None
        house, street, kind, end = m[1], "", "", m.end()
        for seg in re.finditer(r"[^|]+", t[m.end() :]):
            words = [w for w in _WORD.findall(seg[0]) if not w.isdigit()]
            if any(len(w) > 1 for w in words):
                if len(words) > 1 and words[-1] in _MORE_OF:
                    kind = _MORE_OF[words.pop()]
                street, end = " ".join(words[:5]), m.end() + seg.end()
                break
        if not street:
            return None
    street = " ".join(_WORD.findall(street))
    house = _SUFFIX.sub("", house.replace(" ", "") if " 1/2" not in house else house)
    return house.lstrip("0") or "0", street, kind, m.start(), end


def parse(address: str | None) -> tuple[int | str, str, str, str, str, str] | None:
    """(house, street, kind, town, state, postal) or None where no place is denoted.

    Missing components are empty; a house number of several parts ("16-11-23/37") is text. None: null, filler, no house
    number or a masked one, no street.
    """
    if not address or plain(address).strip() in FILLERS:
        return None
    t = plain(address.replace("\xa0", " ")).strip()
    if re.search(r"#\s?#+|[*x]{2}\d|\d\*|\*\d", t):
        return None
    typed = t
    t = _OCR.sub(lambda m: m[0].translate(str.maketrans("oil", "011")), t)
    # other digits inside words are letters
    t, postal = _segments(_RUN.sub(_letters, t))
    halved = re.search(r"\d\s1/2\b", typed)
    front, after = (None, None) if halved else (_FRONT.search(t), _AFTER.search(t))
    bare = None if front or after or halved else _BARE.search(t)
    if front and not (after and after[3] not in ("r", "pl") and after.start() <= front.start() and after.end() > front.end()):
        house, kind, street, at, end = int(front[1]), _KIND_OF[front[2]], front[3], front.start(), front.end()
    elif after:
        house, street, kind, at, end = int(after[1]), after[2], _KIND_OF[re.sub(r"\s+", " ", after[3])], after.start(), after.end()
    elif bare and not _ANY_AFTER.search(t):
        house, street, kind, at, end = int(bare[1]), bare[2], "", bare.start(), bare.end()
    else:
        t, postal = _segments(typed)
        if not (found := _at_large(t)):
            return None
        house, street, kind, at, end = found
        house = int(house) if house.isdigit() else house
    street = " ".join(ORDINALS.get(w, w) for w in street.split())
    rest = t[:at] + "|" + t[end:]
    state, towns = "", []
    for seg in rest.split("|"):
        words = _WORD.findall(seg.replace("-", " "))
        words = [w for w in words if not w.isdigit() and w not in ("no", "plot", "door", "h")]
        if not words:
            continue
        whole = "".join(words)
        if not state and (x := state_of(whole)):
            state = x
            continue
        if not state and words[-1] in _STATE_CODES:
            state = words.pop()
        elif not state and len(words) > 1 and (x := state_of(words[-1])):
            state = x
            words.pop()
        elif not state and len(words) > 2 and (x := state_of("".join(words[-2:]))):
            state = x
            words = words[:-2]
        elif not state and words[0] in _STATE_CODES and len(words[0]) <= 3 and len(words) > 1:
            state = words.pop(0)
        towns += words
    if state in _STATE_CODES:
        state = _STATE_CODES[state][0 if len(_STATE_CODES[state]) == 1 or len(postal) != 6 else -1]
    return house, street.replace(" ", ""), kind, "".join(w for w in towns if len(w) > 1), state, postal


PLACE = T.StructType([T.StructField(f, T.StringType()) for f in ("house", "street", "kind", "town", "state", "postal")])


@F.pandas_udf(PLACE)
def place(addresses: pd.Series) -> pd.DataFrame:
    rows = [parse(x) or (None, None, None, None, None, None) for x in addresses]
    rows = [(None if r[0] is None else str(r[0]), *r[1:]) for r in rows]
    return pd.DataFrame(rows, columns=["house", "street", "kind", "town", "state", "postal"])


# not to be parsed a second time below an aggregation for the sake of a filter
place = place.asNondeterministic()


def _keys(house: str, street: str, town: str, state: str, postal: str) -> list[str]:
    c = code(street)
    keys = []
    if town:
        t = code(town)
        keys += [f"T|{house}|{c}|{t}", f"B|{house}|{t}|{street[0]}", f"E|{house}|{t}|{street[-3:]}", f"W|{house}|{street[:4]}|{town[:3]}", f"V|{house}|{c}|{town[0]}"]
    if postal:
        keys += [f"P|{house}|{c}|{postal}", f"Q|{house}|{postal}|{street[0]}", f"R|{house}|{postal}|{street[-3:]}"]
    keys.append(f"S|{house}|{c}")
    return keys


@F.pandas_udf(T.ArrayType(T.StringType()))
def place_keys(house: pd.Series, street: pd.Series, town: pd.Series, state: pd.Series, postal: pd.Series) -> pd.Series:
    return pd.Series([_keys(*x) for x in zip(house, street, town, state, postal)])


#: Jaro-Winkler from which two streets, and two towns, are the same.
STREET, TOWN = 0.86, 0.84


def _grade(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
    """0: other places or unknown; 1: nothing against the same place; 2: the same place. House numbers are equal."""
    sa, sb, ta, tb = (x.tolist() for x in (a["street"], b["street"], a["town"], b["town"]))
    if not sa:
        return pd.Series([], dtype="int32")
    street = (jaro_winkler(sa, sb) >= STREET) & (osa(sa, sb) <= 3)
    town = (jaro_winkler(ta, tb) >= TOWN) | pd.Series([x and y and (x.startswith(y) or y.startswith(x) or x.endswith(y) or y.endswith(x)) and min(len(x), len(y)) >= 5 for x, y in zip(ta, tb)]).astype(bool).values
    out = []
    for i, (ka, kb, za, zb, pa, pb) in enumerate(zip(a["kind"], b["kind"], a["state"], b["state"], a["postal"], b["postal"])):
        if not street[i] or ka and kb and ka != kb:
            out.append(0)
        elif ta[i] and tb[i]:
            out.append(2 if town[i] and (not za or not zb or za == zb or pa and pa == pb) else 0)
        elif za and zb and za != zb:
            out.append(0)
        elif pa and pb:
            out.append(2 if pa == pb else 0)
        else:
            out.append(1)
    return pd.Series(out, dtype="int32")


@F.pandas_udf(T.IntegerType())
def same_place(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
    return _grade(a, b)


#: What contradicts between places without a town.
_SAID = ("state", "postal", "kind")


def _torn(members: DataFrame, by: str) -> DataFrame:
    """(by) of the groups of which two members contradict each other."""
    sets = members.groupBy(by).agg(*[F.size(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in _SAID])
    return sets.where(" or ".join(f"{c} > 1" for c in _SAID)).select(by)


def classes(spark: SparkSession, df: DataFrame, id_column: str, address_column: str, parts: tuple[str, ...] = ()) -> DataFrame:
    """(id, label, and of the reading the ``parts`` asked for) for every id whose address denotes a place; equal labels denote the same premises.

    Null, filler and unreadable addresses and those without a house number get no label. An id delivered twice may
    carry two. Identical readings are merged before any comparison.
    """
    scratch = Scratch(spark)
    fields = ["house", "street", "kind", "town", "state", "postal"]
    source = df.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{address_column}`").alias("address")).where("id is not null and address is not null")
    rows = source.groupBy("address").agg(F.min("id").alias("first")).select("address", "first", place("address").alias("r"))
    rows = scratch.cut(rows.where("r.house is not null").select("address", "first", "r.*"))
    nodes = rows.groupBy(*fields).agg(F.min("first").alias("rep"))
    nodes = scratch.cut(nodes.withColumn("node", F.concat_ws("\x01", "rep", F.lower(F.hex(F.xxhash64(*fields))))))
    keyed = nodes.select("node", F.struct(*fields).alias("r"), F.explode(place_keys("house", "street", "town", "state", "postal")).alias("key"))
    pairs = keyed.toDF("na", "ra", "key").join(keyed.toDF("nb", "rb", "key"), "key").where("na < nb")
    # a weak key only serves pairs of which one side lacks town or postal code
    pairs = pairs.where(~F.col("key").startswith("S|") | (F.col("ra.town") == "") | (F.col("rb.town") == ""))
    pairs = pairs.where("ra.kind = rb.kind or ra.kind = '' or rb.kind = ''").where(F.levenshtein("ra.street", "rb.street", 6) >= 0)
    graded = scratch.cut(pairs.select("na", "nb", same_place("ra", "rb").alias("g")).where("g > 0").distinct())
    strong = graded.where("g = 2").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    firm = nodes.select("node", "town").join(labels_of(spark, strong, scratch).withColumnRenamed("id", "node"), "node", "left")
    firm = scratch.cut(firm.select("node", F.coalesce("label", "node").alias("label"), (F.col("town") != "").alias("has")))
    has = firm.groupBy("label").agg(F.max("has").alias("has"))
    firm = scratch.cut(firm.drop("has").join(has, "label"))
    ends = firm.select("node", F.struct("label", "has").alias("x"))
    weak = graded.where("g = 1").join(ends.toDF("na", "xa"), "na").join(ends.toDF("nb", "xb"), "nb").where("xa.label <> xb.label")
    weak = scratch.cut(weak.select("xa", "xb").distinct())
    both = weak.select("xa", "xb").unionByName(weak.select(F.col("xb").alias("xa"), F.col("xa").alias("xb")))
    to_firm = scratch.cut(both.where("not xa.has and xb.has").groupBy(F.col("xa.label").alias("loose")).agg(F.min("xb.label").alias("a"), F.max("xb.label").alias("b")))
    loose = both.where("not xa.has and not xb.has").select(F.col("xa.label").alias("a"), F.col("xb.label").alias("b"))
    loose = loose.join(to_firm.select(F.col("loose").alias("a")), "a", "left_anti").join(to_firm.select(F.col("loose").alias("b")), "b", "left_anti")
    loose = scratch.cut(loose.distinct())
    # places without a town are linked as far as nothing in what they link contradicts: other state, postal code or kind
    said = nodes.join(firm.select("node", "label"), "node").groupBy("label").agg(*[F.collect_set(F.when(F.col(c) != "", F.col(c))).alias(c) for c in _SAID])
    group = labels_of(spark, loose, scratch).toDF("a", "comp")
    torn = _torn(group.join(said, F.col("a") == F.col("label")), "comp")
    inside = loose.join(group, "a").join(torn.withColumnRenamed("comp", "torn"), F.col("comp") == F.col("torn"), "left")
    # in a group with a contradiction, both ends of a link must have neighbours that agree with them and each other
    around = inside.where("torn is not null").select("a", "b").unionByName(inside.where("torn is not null").select("a", F.col("a").alias("b"))).distinct()
    unclear = _torn(around.join(said, F.col("b") == F.col("label")), "a").withColumnRenamed("a", "u")
    single = inside.select("a", "b").join(unclear, F.col("a") == F.col("u"), "left_anti").join(unclear, F.col("b") == F.col("u"), "left_anti")
    # only places that incomplete ones touch can still grow
    links = to_firm.where("a = b").select(F.col("loose").alias("a"), "b").unionByName(single)
    grown = labels_of(spark, links, scratch)
    base = nodes.join(firm.select("node", "label"), "node", "left").select(*fields, F.coalesce("label", "node").alias("base"))
    of_node = base.join(grown, base["base"] == grown["id"], "left").select(*fields, F.coalesce("label", "base").alias("label"))
    of_address = rows.join(of_node, fields).select(F.col("address").alias("_a"), F.struct("label", *parts).alias("_r"))
    # one filler may be the address of any share of the rows
    return lookup_join(source, "address", of_address, "_a", "_r", "_r").select("id", "_r.*").distinct()


def same_premises(spark: SparkSession, df: DataFrame, id_column: str, address_column: str, left: str = "entity_id_a", right: str = "entity_id_b") -> DataFrame:
    """Pairs of different ids whose addresses denote the same premises, the smaller first, each once."""
    found = Scratch(spark).cut(classes(spark, df, id_column, address_column))
    a, b = found.toDF(left, "label"), found.toDF(right, "label")
    return a.join(b, "label").where(F.col(left) < F.col(right)).select(left, right).distinct()
