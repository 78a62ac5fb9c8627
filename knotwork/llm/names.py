"""Variant spellings of business names typed by people.

A name is read into parts (given name, family names, trade, number), whatever the order, script, case, legal form,
"doing business as" prefix or web address around them. A word that no table knows is a family word, so names of made-up
words, or in scripts that aren't transliterated, are compared by these. Variants are linked by the method named for the problem:

* block by phonetic codes of the sorted tokens: the code pair of both family names, and each code by itself
  together with the trade and a hint at the other token, so a mistyped consonant in one of them does no harm;
* compare with Jaro-Winkler over the tokens, given names through a nickname table;
* cluster accepted pairs by connected components.

Identical readings are merged before any comparison, so copies never meet in pairs; names without a trade (web
addresses, hashtags) join a cluster only if all clusters of that name agree on one trade.
"""

from __future__ import annotations

import hashlib
import re
import struct
import unicodedata
import zlib
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knotwork.functions.memo import Memo
from knotwork.functions.similarity import jaro_winkler
from knotwork.llm.groups import labels_of
from knotwork.llm.meeting import possible_pairs
from knotwork.operators.skew import lookup_join
from knotwork.session import Scratch

# Given names and their short forms.
NICKNAMES = {
    "abigail": "abby gail", "abraham": "abe bram", "albert": "al bert albie", "alexander": "alex xander sasha alec", "alexandra": "sandra sandy lexi", "alexandre": "alex",
    "alfred": "alf alfie fred", "amanda": "mandy", "andrew": "andy drew", "anthony": "tony", "arthur": "art artie", "barbara": "barb babs barbie", "benjamin": "ben benny benji",
    "bernard": "bernie", "catherine": "cathy cat", "charles": "charlie chuck chas", "christina": "tina chrissie", "christine": "chris chrissy", "christopher": "chris topher kit",
    "clifford": "cliff", "cynthia": "cindy", "daniel": "dan danny", "david": "dave davy", "deborah": "deb debbie debby", "dominique": "domi", "donald": "don donny", "dorothy": "dot dottie dolly",
    "douglas": "doug", "edward": "ed ted eddie ned", "eleanor": "ellie nell nora", "elizabeth": "liz beth betty eliza lizzie betsy", "emmanuel": "manu manny", "ernest": "ernie",
    "eugene": "gene", "florence": "flo flossie", "frances": "fran frankie", "francis": "frank", "francois": "fanfan", "franklin": "frank", "frederic": "fred", "frederick": "fred freddy fritz", "gabriel": "gabe",
    "genevieve": "ginette", "geoffrey": "geoff", "gerald": "gerry jerry", "gregory": "greg", "gurpreet": "guri", "harold": "hal harry", "harpreet": "happy", "henry": "hank harry hal",
    "isabelle": "isa", "jacqueline": "jacquie jackie", "james": "jim jimmy jamie", "janet": "jan", "jeffrey": "jeff", "jennifer": "jen jenny", "jessica": "jess jessie", "john": "johnny jack",
    "jonathan": "jon", "joseph": "joe joey", "joshua": "josh", "judith": "judy", "katherine": "kate kathy kat katie", "kenneth": "ken kenny", "krishnan": "krish kittu", "lakshmi": "laxmi", "laurence": "laurie",
    "lawrence": "larry", "leonard": "len lenny", "margaret": "maggie peggy meg", "matthew": "matt", "maximilian": "max", "melissa": "mel", "michael": "mike mick mickey", "mohammed": "mohamed muhammad mohd", "nathaniel": "nate",
    "nicholas": "nick nicky", "nicolas": "nico", "pamela": "pam", "patricia": "pat trish patty", "patrick": "paddy", "peter": "pete", "philip": "phil", "philippe": "phil", "priyanka": "priya",
    "rajendra": "raj raju", "raymond": "ray", "rebecca": "becky", "richard": "rick dick ric rich ricky", "robert": "rob bob bobby robbie bert", "ronald": "ron ronnie", "samantha": "sam", "samuel": "sam sammy",
    "sebastien": "seb", "stephanie": "steph", "stephen": "steve", "steven": "steve", "subramaniam": "subbu mani", "sundararajan": "sundar", "susan": "sue suzy", "theodore": "theo ted teddy", "theresa": "terry tess",
    "thomas": "tom tommy", "timothy": "tim timmy", "valerie": "val", "venkatesh": "venky venkat", "victoria": "vicky tori", "vincent": "vince", "virginia": "ginny", "walter": "walt wally", "william": "will bill billy willie",
    "yogendra": "yogi", "zachary": "zach zack",
}

# Trades and their usual short or other forms.
TRADES = {
    "academy": "acad", "accounting": "acctg accountants accountancy", "advertising": "advtg", "agency": "agcy", "apparel": "garments clothing", "architects": "architecture", "automotive": "auto autos", "bakery": "bakers boulangerie",
    "barbershop": "barbers", "beverages": "bev", "boutique": "btq", "brewing": "brew brewery", "builders": "bldrs", "cafe": "coffee", "carpentry": "carpenters", "catering": "caterers", "ceramics": "tiles", "chemicals": "chem chemical",
    "cleaning": "cleaners", "communications": "telecom telecommunications", "computers": "computer", "construction": "const constr constructions", "consulting": "cnslt consultants consultancy", "cosmetics": "beauty",
    "dairy": "milk", "dental": "dntl dentistry dentists", "design": "designs designers", "distribution": "distributors", "electrical": "electricals electricians", "electronics": "electronic elec", "energy": "solar", "engineering": "eng engg engineers", "entertainment": "ent",
    "events": "event", "excavation": "excavating", "exports": "export exporters", "farms": "farm farming", "fashion": "fashions", "finance": "financial fin", "fisheries": "seafood", "fitness": "fit gym", "flooring": "floors", "florist": "flowers florists",
    "foods": "food fds", "forestry": "timber", "foundry": "castings", "furniture": "furn furnishings", "glass": "glazing", "granite": "marble", "graphics": "graphic", "hardware": "hdwe", "healthcare": "health", "hospital": "hosp hospitals",
    "hotels": "hotel", "hvac": "heating cooling", "imports": "importers", "infrastructure": "infra infracon", "insurance": "ins", "interiors": "interior", "investments": "investment", "irrigation": "pumps", "jewellers": "jewelers jewelry jewellery", "kitchens": "kitchen",
    "laboratories": "labs laboratory", "landscaping": "landscape lndscpg landscapes", "laundry": "drycleaners", "leather": "tannery", "legal": "law attorneys", "lighting": "lights", "logistics": "lgstcs logistic", "machinery": "machines", "maintenance": "maint", "management": "mgmt",
    "manufacturing": "mfg manuf manufacturers", "marine": "boats", "marketing": "mktg", "masonry": "masons", "mechanical": "mech", "media": "multimedia", "medical": "med medicals", "metals": "metal", "mining": "minerals", "motors": "motor mtrs",
    "movers": "moving", "music": "musical", "nursery": "nurseries", "nursing": "nurses", "opticians": "optics optical", "packaging": "packagers", "painting": "painters", "paints": "coatings", "paper": "papers", "pest": "fumigation", "petroleum": "fuels oil",
    "pharmacy": "pharm pharma pharmaceuticals", "photography": "photo photos", "physiotherapy": "physio", "plastics": "plastic", "plumbing": "plbg plumb plumbers", "poultry": "hatchery", "printing": "print prtg printers", "properties": "property", "publishing": "publishers publications", "realty": "rlty realtors",
    "recycling": "scrap", "refrigeration": "fridge", "restaurant": "rest restaurants diner", "roofing": "roof roofers", "salon": "hair", "school": "schools", "security": "sec", "software": "sw", "spa": "wellness", "sports": "sporting", "staffing": "recruitment", "stationery": "stationers",
    "steel": "steels", "storage": "warehousing", "surveying": "surveyors", "sweets": "confectionery", "tailoring": "tailors", "textiles": "txtls textile", "toys": "toy", "trading": "traders trdg", "training": "coaching", "transport": "transportation haulage trucking",
    "travels": "travel trvls tours", "tutoring": "tutors tuition", "tyres": "tires", "upholstery": "upholsterers", "veterinary": "vet vets", "video": "videos", "watches": "clocks", "welding": "welders", "winery": "wines vineyards", "woodworking": "joinery", "yoga": "pilates",
}

# Family names that are near the word of a trade; inside a name they are families.
OCCUPATIONAL = frozenset("baker brewer carter cook cooper farmer fisher gardener glover mason miller painter plumber porter potter sawyer shepherd smith tailor taylor tanner turner weaver".split())

# Words of legal forms and articles, which say nothing about who is meant.
LEGAL = frozenset(
    "limited ltd llc inc incorporated corp corporation co company lp llp pc pvt private sarl eurl sas sa societe anonyme liability partnership"
    " professional praivet praiwet limited limitet the ms and et".split()
)
# Words for any kind of establishment.
GENERIC = frozenset("clinic klinik center centre".split())

#: A word of more letters is only compared for equality.
LONGEST = 40
#: A name of more family words is only compared with names that sound like it in all of them.
MANY = 8

_TRADE_OF = {w: t for t, ws in TRADES.items() for w in [t, *ws.split()]}
_GIVEN_OF: dict[str, str] = {}
for _g, _ws in NICKNAMES.items():
    for _w in [_g, *_ws.split()]:
        # a short form of several names stands for each of them
        _GIVEN_OF[_w] = f"{_GIVEN_OF[_w]}|{_g}" if _w in _GIVEN_OF else _g
_TAIL_OF = {t: x for t, x in _TRADE_OF.items() if len(t) > 4}
_DIGIT = str.maketrans("034578", "oeastb")
# Devanagari letters.
_DEVA = dict(
    zip(
        "कखगघङचछजझञटठडढणतथदधनपफबभमयरलळवशषसह",
        "k kh g gh n c ch j jh n t th d dh n t th d dh n p f b bh m y r l l v sh sh s h".split(),
    )
) | dict(zip("अआइईउऊऋएऐओऔािीुूृेैोौ", "a a i i u u ri e ai o au a i i u u ri e ai o au".split())) | {"ं": "n", "ँ": "n", "ः": "h", "्": "", "़": ""}
_DEVA_CONSONANTS = frozenset("कखगघङचछजझञटठडढणतथदधनपफबभमयरलळवशषसह")
_DEVA_MARKS = frozenset("ािीुूृेैोौ़्ं")


def transliterate(text: str) -> str:
    """Devanagari in Latin letters; a consonant before another one without a sign between carries an a."""
    out = []
    for i, c in enumerate(text):
        out.append(_DEVA.get(c, c))
        if c in _DEVA_CONSONANTS and i + 1 < len(text) and text[i + 1] in _DEVA_CONSONANTS:
            out.append("a")
    return "".join(out)


def plain(text: str) -> str:
    """Latin letters without marks, in lower case."""
    if text.isascii():
        return text.lower()
    text = transliterate(text)
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def _deletions(word: str, k: int) -> set[str]:
    found = {word}
    for _ in range(k):
        found |= {w[:i] + w[i + 1 :] for w in found for i in range(len(w))}
    return found


def _distance(a: str, b: str) -> int:
    """Edits, a swap of neighbours counted once."""
    old, now = None, list(range(len(b) + 1))
    for i, c in enumerate(a):
        nxt = [i + 1]
        for j, d in enumerate(b):
            v = min(now[j + 1] + 1, nxt[j] + 1, now[j] + (c != d))
            if old and i and j and c == b[j - 1] and a[i - 1] == d:
                v = min(v, old[j - 1] + 1)
            nxt.append(v)
        old, now = now, nxt
    return now[-1]


def _near_table(words: dict[str, str]) -> dict[str, list[str]]:
    """Words of five letters or more by what is left of them after one deletion, of eight or more after two."""
    table: dict[str, list[str]] = {}
    for w in words:
        if len(w) >= 5:
            for d in _deletions(w, 2 if len(w) >= 8 else 1):
                table.setdefault(d, []).append(w)
    return table


_TRADE_NEAR = _near_table(_TRADE_OF)
_GIVEN_NEAR = _near_table({w: g for w, g in _GIVEN_OF.items() if len(w) >= 6})
_FOLD = (("gh", "g"), ("ph", "f"), ("sh", "s"), ("ck", "k"))
_FOLD_LETTERS, _SOFT_LETTERS = str.maketrans({"x": "ks", "c": "k", "q": "k"}), str.maketrans("zwy", "jvi")
_MANY_E, _MANY_O, _TWICE, _SILENT = re.compile("e{2,}"), re.compile("o{2,}"), re.compile(r"(.)\1+"), re.compile("[aeiouh]")
_SOUNDS = str.maketrans("dgbjm", "tkpsn")


def _near(word: str, exact: dict[str, str], near: dict[str, list[str]], most: int) -> str | None:
    """The entry of ``word``, or of a word at most ``most`` edits away (one, where either has under eight letters)."""
    if word in exact:
        return exact[word]
    if not 5 <= len(word) <= LONGEST or word in OCCUPATIONAL:
        return None
    best = (most + 1, "")
    for d in _deletions(word, min(most, 2 if len(word) >= 8 else 1)):
        for w in near.get(d, ()):
            k = _distance(word, w)
            if k <= (most if len(w) >= 8 and len(word) >= 8 else 1):
                best = min(best, (k, w))
    return exact[best[1]] if best[1] else None


@Memo
def trade_of(word: str) -> str | None:
    return _near(word, _TRADE_OF, _TRADE_NEAR, 2)


@Memo
def given_of(word: str) -> str | None:
    return _near(word, _GIVEN_OF, _GIVEN_NEAR, 1)


@Memo
def fold(word: str) -> str:
    """Letters that scripts and spellings interchange made one; used where one side was transliterated."""
    for a, b in _FOLD:
        word = word.replace(a, b)
    word = word.translate(_FOLD_LETTERS).replace("ge", "je").replace("gi", "ji").replace("gy", "jy").translate(_SOFT_LETTERS)
    return _TWICE.sub(r"\1", _MANY_O.sub("u", _MANY_E.sub("i", word)))


@Memo
def code(word: str) -> str:
    """Phonetic code: the consonants in classes of like sound, without vowels, h and repeats; a vowel in front stays."""
    w = fold(word)
    if not w:
        return ""
    return _TWICE.sub(r"\1", ("a" if w[0] in "aeiou" else "") + _SILENT.sub("", w).translate(_SOUNDS))


_DBA = re.compile(r"^.*?\s(?:d/b/a|dba|t/a|doing business as|trading as|a/k/a|aka)\s+(?=\S)", re.I | re.S)
_WEB_TAIL = re.compile(r"\s[|\-–]\s*(?:https?://)?(?:www\.)?([\w\-]+)\.(?:[a-z]+\.)?[a-z]{2,8}/?\s*$", re.I)
_WEB = re.compile(r"^\W*(?:https?://)?(?:www\.)?([^\W_][\w\-]*)\.(?:(?:com|in|biz|co|org|net|fr|us|info)\.)?(?:example|com|in|biz|org|net|fr|us|info)/?\s*$", re.I)
_HASH = re.compile(r"^\s*#\s*([^\W\d_][\w\-]*)\s*$")
_DOTTED = re.compile(r"\b(?:[a-z]\.\s?){2,}(?![a-z]\.)|\b(?:[a-z]\.){1,}[a-z]\b")
# white space and punctuation; marks that belong to letters of any script stay with their word
_SPLIT = re.compile("[\\s\\x00-/:-@\\[-`{-\xbf\u2000-\u206f\u3000-\u303f\u0964]+")
_NUMBER = re.compile(r"(?:\bno\b\.?|#|№|\bn[°ºr]\.?|\bnumber\b)\s*(\d{1,4})\b|(?<=\s)(\d{1,4})(?=\s*$|[\s,\-.]+)")
_CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ][a-zà-ÿ])")


def read(name: str | None) -> tuple[str, str, str, str, str, bool] | None:
    """(given, families joined by a space, trade, number, joined, folded) of a name, or None if nothing is left.

    ``given`` is a canonical given name (several, parted by bars, for a short form of several) or a one-letter initial; ``joined`` holds families written as one word;
    ``folded`` tells that letters are uncertain because another script was used.
    """
    if not name:
        return None
    folded = not name.isascii() and any("ऀ" <= c <= "ॿ" for c in name)
    text = name.replace(" ", " ").strip()
    web = ""
    if m := _WEB_TAIL.search(text):
        web, text = m[1], text[: m.start()]
    if m := _WEB.match(text) or _HASH.match(text):
        web, text = m[1], ""
    stripped = _DBA.sub("", text)
    text = plain(_CAMEL.sub(" ", stripped))
    text = re.sub(r"\b(m/s|s\.?a\.?r\.?l|e\.?u\.?r\.?l)\b\.?", " ", text)
    text = re.sub(r"\(p\)", " ", text)
    text = _DOTTED.sub(lambda m: m[0].replace(".", "").replace(" ", "") + " ", text)
    number = ""
    if m := _NUMBER.search(text):
        number = (m[1] or m[2]).lstrip("0")
        text = text[: m.start()] + " " + text[m.end() :]
    given, trade, fams, initials = "", "", [], []
    tokens = [t for t in _SPLIT.split(text) if t]
    certain = any(t in _TRADE_OF for t in tokens)  # then a word near another trade is none
    for at, t in enumerate(tokens):
        if not t.isalpha() and any(c.isdigit() for c in t):
            if t.isdigit():
                continue
            t = re.sub(r"(?<=[aeiou])1|1(?=[aeiou])", "l", t).replace("1", "i").translate(_DIGIT)
        if t in LEGAL or t in GENERIC and len(tokens) > 1:
            continue
        if len(t) > LONGEST:
            t = hashlib.sha256(t.encode()).hexdigest()  # as unlike others as words can be
        if len(t) == 1:
            initials.append(t)
        elif (x := _TRADE_OF.get(t) if certain else trade_of(t)) and not (t in OCCUPATIONAL and 0 < at < len(tokens) - 1) and not (trade and x != trade and len(t) < 5):
            trade = trade or x
        elif not given and (x := given_of(t)):
            given = x
        elif fams and (t == fams[-1] or len(t) > 4 and len(set(t) ^ set(fams[-1])) <= 2 and t[0] == fams[-1][0] and float(jaro_winkler([t], [fams[-1]])[0]) > 0.93):
            continue
        else:
            fams.append(t)
    joined = ""
    if web:
        w = plain(web)
        parts = [p for p in re.split(r"[^a-z0-9]+", w) if p]
        if parts and (x := trade_of(parts[-1])):
            trade, parts = trade or x, parts[:-1]
        if len(parts) == 1 and not fams:
            trade, word = _without_trade(parts[0], trade)
            # a web address or hashtag may be several words without a space
            joined, parts = (word, []) if len(word) >= 6 else ("", [word])
        if not fams:
            fams = [p for p in parts if p not in LEGAL]
    if len(fams) == 1 and len(fams[0]) > 10:
        trade, word = _without_trade(fams[0], trade)
        joined, fams = (word, []) if len(word) >= 11 else ("", [word])
    if not fams and not joined:
        return None
    if initials and not given:
        given = initials[0]
    return given, " ".join(fams), trade, number, joined, folded


def _without_trade(word: str, trade: str) -> tuple[str, str]:
    """(trade, rest) of a word that ends in the word of a trade; otherwise as it is."""
    for t, x in _TAIL_OF.items():
        if word.endswith(t) and len(word) > len(t) + 5:
            return trade or x, word[: -len(t)]
    return trade, word


READING = T.StructType([T.StructField(f, T.StringType()) for f in ("given", "families", "trade", "number", "joined")] + [T.StructField("folded", T.BooleanType())])


@F.pandas_udf(READING)
def reading(names: pd.Series) -> pd.DataFrame:
    rows = [read(x) or ("", "", "", "", "", False) for x in names]
    return pd.DataFrame(rows, columns=["given", "families", "trade", "number", "joined", "folded"])


# not to be read a second time below an aggregation for the sake of a filter
reading = reading.asNondeterministic()


def _keys(given: str, families: str, trade: str, number: str, joined: str) -> list[str]:
    """Blocking keys of a reading.

    A: the sorted codes of both families. B: a family's code with the trade. C: a family's code with the first two
    letters of the other one, and with its first and last two. D: the sorted beginnings of both families. I: a family's code with the other one's
    initial, for names of which one family is an initial. Of a joined name every split is tried.
    """
    f = families.split()
    out: set[str] = set()

    def both(x: str, y: str) -> None:
        c, d = code(x), code(y)
        out.add(f"A|{min(c, d)}|{max(c, d)}|{number}")
        for e, z in ((c, y), (d, x)):
            if len(e) > 2 or not joined:
                out.update((f"C|{e}|{z[:2]}|{number}", f"C|{e}|{z[0]}{z[-2:]}|{number}", f"I|{e}|{z[0]}|{number}"))

    if joined:
        out.add(f"A|{code(joined)}||{number}")
        for i in range(2, min(len(joined), LONGEST) - 1):
            both(joined[:i], joined[i:])
        return sorted(out)
    if len(f) > MANY:
        return ["L|" + "|".join(sorted(code(x) for x in f)) + f"|{number}"]
    if trade:
        out |= {f"B|{code(x)}|{trade}|{number}" for x in f}
    if len(f) == 1:
        out.update({f"I|{code(f[0])}|{g[0]}|{number}" for g in given.split("|")} if given else [f"A|{code(f[0])}||{number}"])
    for i in range(len(f)):
        for j in range(i):
            both(f[i], f[j])
            out.add("D|" + "|".join(sorted((fold(f[i])[:3], fold(f[j])[:3]))) + f"|{number}")
    return sorted(out)


#: What is known of a reading for a first look: number of words (0: joined, ANY: more than three or too long), letters of an
#: uncertain script, trade, initials of the given name, and of the words as typed and folded the letters, beginnings and lengths.
SIGNATURE = np.dtype(
    [("words", "u1"), ("folded", "u1"), ("trade", "<u4"), ("given", "<u4"), ("of", [("mask", "<u8", 4), ("start", "<u4", 3), ("length", "<u2", 4), ("over", "u1", 4)], 2)]
)
ANY = 9
_PACKED = "<BBII" + "4Q3I4H4B" * 2


_PLACE = {chr(97 + i): 1 << 2 * i for i in range(26)}


def _letters(word: str) -> tuple[int, int, int, int, int]:
    """Two bits a letter for its first two occurrences, two for the next, how many are in none of them, how many not in the first, and the first four letters.

    Letters beyond the Latin ones share six places.
    """
    low = high = beyond = over = 0
    for c in word:
        b = _PLACE.get(c) or 1 << 52 + 2 * (ord(c) % 6)
        if not low & b:
            low |= b
        elif not low & b << 1:
            low |= b << 1
        else:
            over += 1
            if not high & b:
                high |= b
            elif not high & b << 1:
                high |= b << 1
            else:
                beyond += 1
    start = 0
    for c in word[:4]:
        start = start << 8 | ord(c) & 255
    return low, high, beyond, over, start << 8 * max(0, 4 - len(word))


letters = Memo(_letters)


def _signature(given: str, families: str, trade: str, joined: str, folded: bool) -> bytes:
    f = [joined] if joined else families.split()
    n = 0 if joined else len(f) if len(f) <= 3 and len(families) < 120 else ANY
    initials = 0
    for g in given.split("|") if given else ():
        c = g[0]
        initials |= 1 << (ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) % 6)
    out: list[int] = [n if len(joined) < 120 else ANY, bool(folded), zlib.crc32(trade.encode()) or 1 if trade else 0, initials]
    for words in (f, [fold(w) for w in f]):
        if out[0] == ANY:
            out += [0] * 15
            continue
        of = [letters(w) for w in words]
        mask, start, length, over = [[x[i] for x in of] for i in (0, 4)] + [[len(w) for w in words], [x[3] for x in of]]
        mask, start, length, over = mask + [0] * (4 - len(of)), start + [0] * (3 - len(of)), length + [0] * (4 - len(of)), over + [0] * (4 - len(of))
        if n in (0, 2):  # the letters of all words together
            whole = _letters("".join(words))
            mask[2:], length[3], over[3] = whole[:2], sum(map(len, words)), whole[2]
        out += [*mask, *start, *length, *over]
    return struct.pack(_PACKED, *out)


@F.pandas_udf(T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("signature", T.BinaryType())]))
def keyed_reading(given: pd.Series, families: pd.Series, trade: pd.Series, number: pd.Series, joined: pd.Series, folded: pd.Series) -> pd.DataFrame:
    rows = [(_keys(g, f, t, n, j), _signature(g, f, t, j, u)) for g, f, t, n, j, u in zip(given, families, trade, number, joined, folded)]
    return pd.DataFrame(rows, columns=["keys", "signature"])


# keys and signature are used by two expressions
keyed_reading = keyed_reading.asNondeterministic()


def _possible(s: np.ndarray):
    """What can be ruled out without the comparison proper: other trades, other given names, far letters.

    The letters that two words share, whatever their places, bound the Jaro similarity of lengths m and n from above by
    (c / m + c / n + 1) / 3, and this and the common beginning bound Jaro-Winkler. Beside a reading in uncertain letters both are taken folded.
    """
    words, folded, trade, given = (np.ascontiguousarray(s[c]) for c in ("words", "folded", "trade", "given"))
    mask, start, length, over = (np.ascontiguousarray(np.moveaxis(s["of"][c], 0, -1)) for c in ("mask", "start", "length", "over"))
    eps = 1e-9

    def jaro(common, m, n):
        return np.where(common > 0, (common / np.maximum(m, 1) + common / np.maximum(n, 1) + 1) / 3, 0.0)

    def word(u, i, k, j, m):
        common = np.bitwise_count(mask[u, k, i] & mask[u, m, j]) + np.minimum(over[u, k, i], over[u, m, j]).astype(np.int64)
        best = jaro(common, length[u, k, i].astype(np.int64), length[u, m, j].astype(np.int64))
        x = start[u, k, i] ^ start[u, m, j]
        same = (x < 1 << 24).astype(np.int64) + (x < 1 << 16) + (x < 1 << 8) + (x == 0)
        return best + 0.1 * same * (1 - best)

    def whole(u, i, j):
        common = np.bitwise_count(mask[u, 2, i] & mask[u, 2, j]).astype(np.int64) + np.bitwise_count(mask[u, 3, i] & mask[u, 3, j]) + np.minimum(over[u, 3, i], over[u, 3, j])
        best = jaro(common, length[u, 3, i].astype(np.int64), length[u, 3, j].astype(np.int64))
        return best + 0.4 * (1 - best) >= JOINED - eps

    def in_order(p, q):
        return (np.minimum(p, q) >= LEAST - eps) & (p + q >= 2 * MEAN - eps)

    def few_in_many(u, i, j, few, many):
        least, total = np.ones(len(i)), np.zeros(len(i))
        for k in range(few):
            best = np.max([word(u, i, k, j, m) for m in range(many)], axis=0)
            least, total = np.minimum(least, best), total + best
        return (least >= LEAST - eps) & (total >= few * MEAN - eps) if few > 1 else least >= ONE - eps

    def rule(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t, v = trade[i], trade[j]
        ok = (t == v) | (t == 0) | (v == 0)
        i, j = i[ok], j[ok]
        g, h = given[i], given[j]
        ok = (g == 0) | (h == 0) | (g & h != 0) | (np.minimum(words[i], words[j]) < 2)
        i, j = i[ok], j[ok]
        turn = words[i] > words[j]
        i, j = np.where(turn, j, i), np.where(turn, i, j)
        n, m, u = words[i], words[j], (folded[i] | folded[j]).astype(np.int64)
        ok = np.ones(len(i), bool)
        for a, b in ((0, 0), (0, 2), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 3)):
            at = np.flatnonzero((n == a) & (m == b))
            if not len(at):
                continue
            x = u[at], i[at], j[at]
            if a == 0:
                ok[at] = whole(*x)
            elif (a, b) == (2, 2):
                ok[at] = in_order(word(x[0], x[1], 0, x[2], 0), word(x[0], x[1], 1, x[2], 1)) | in_order(word(x[0], x[1], 0, x[2], 1), word(x[0], x[1], 1, x[2], 0))
            else:
                ok[at] = few_in_many(*x, a, b)
        return i[ok], j[ok]

    return rule


#: Jaro-Winkler that a pair of family names must reach each, and on average, and that joined names must reach.
LEAST, MEAN, JOINED = 0.76, 0.86, 0.9
#: Jaro-Winkler that the family word of a name of one must reach.
ONE = 0.9
#: Jaro-Winkler and letters that names of one word must reach, where nothing else is known of them.
COINED, COINED_LETTERS = 0.94, 6


def _others(g: str, h: str) -> bool:
    """Whether two given names, or initials, can't be one."""
    if not g or not h:
        return False
    a, b = set(g.split("|")), set(h.split("|"))
    return not ({x[0] for x in a} & {x[0] for x in b} if len(g) == 1 or len(h) == 1 else a & b)


def _best_of(sim, at: int, few: int, many: int) -> list[float]:
    """Similarities of ``few`` words to different ones of ``many``, the closest pairs taken first."""
    out, rows, cols = [], set(), set()
    for v, r, c in sorted(((float(sim[at + r * many + c]), -r, -c) for r in range(few) for c in range(many)), reverse=True):
        if r not in rows and c not in cols:
            out.append(v)
            rows.add(r)
            cols.add(c)
    return out


def _agree(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
    """Whether the readings in the rows of ``a`` and ``b`` name the same business.

    Every family word of the shorter name must have a partner of its own in the longer one.
    """
    n = len(a)
    fold_pair = (a["folded"].values | b["folded"].values)

    def side(x: pd.DataFrame) -> list[list[str]]:
        return [[fold(w) for w in f.split()] if u else f.split() for f, u in zip(x["families"], fold_pair)]

    fa, fb = side(a), side(b)
    ja = [fold(x) if u else x for x, u in zip(a["joined"], fold_pair)]
    jb = [fold(x) if u else x for x, u in zip(b["joined"], fold_pair)]
    ga, gb = a["given"].tolist(), b["given"].tolist()
    ta, tb = a["trade"].tolist(), b["trade"].tolist()
    xs: list[str] = []
    ys: list[str] = []
    slots: list[tuple] = []
    for i in range(n):
        if ta[i] and tb[i] and ta[i] != tb[i]:
            continue
        g, h = ga[i], gb[i]
        A, B = fa[i], fb[i]
        if ja[i] or jb[i]:  # one side is written as one word
            left = [ja[i]] if ja[i] else [x + y for k, x in enumerate(A) for m, y in enumerate(A) if k != m]
            right = [jb[i]] if jb[i] else [x + y for k, x in enumerate(B) for m, y in enumerate(B) if k != m]
            if ja[i] and jb[i]:  # the parts may stand in either order
                right += [jb[i][k:] + jb[i][:k] for k in range(2, min(len(jb[i]), LONGEST) - 1)]
            if len(A) + len(B) == 1 and not g and not h:  # the one word may be all of the name
                left, right = left or A, right or B
            if len(g) > 1 and len(h) > 1 and _others(g, h):
                continue
            one, two, gi = (A, jb[i], g) if jb[i] and not ja[i] else (B, ja[i], h) if ja[i] and not jb[i] else ([], "", "")
            if len(one) == 1 and len(gi) == 1:  # an initial and one family against both as one word
                k = len(one[0])
                if two[0] == gi and len(two) > k + 3:
                    left, right = [one[0]], [two[-k:], two[-k - 1 :]]
                elif len(two) > k + 3 and gi in (two[k], two[k - 1]):
                    left, right = [one[0]], [two[:k], two[: k - 1]]
                else:
                    continue
            for x in left:
                for y in right:
                    slots.append((i, "J", len(xs), 1))
                    xs.append(x)
                    ys.append(y)
        elif len(A) >= 2 and len(B) >= 2:
            if _others(g, h):
                continue
            few, many = (A, B) if len(A) <= len(B) else (B, A)
            if len(few) * len(many) <= 12:
                for order in permutations(range(len(many)), len(few)):
                    slots.append((i, "P", len(xs), len(few)))
                    xs += few
                    ys += [many[k] for k in order]
            else:
                slots.append((i, "G", len(xs), len(few)))
                xs += [x for x in few for _ in many]
                ys += many * len(few)
        elif len(A) == 1 and len(B) == 1:
            if not (g or h or ta[i] or tb[i]):
                if min(len(A[0]), len(B[0])) >= COINED_LETTERS:
                    slots.append((i, "C", len(xs), 1))
                    xs.append(A[0])
                    ys.append(B[0])
                continue
            if not g or not h or _others(g, h) or not (ta[i] or tb[i]):
                continue
            slots.append((i, "S", len(xs), 1))
            xs.append(A[0])
            ys.append(B[0])
        else:  # one family and perhaps an initial against two families
            one, two, gi, go = (A, B, g, h) if len(A) == 1 else (B, A, h, g)
            if not (ta[i] or tb[i]):
                continue
            for k in range(len(two)):
                rest = [two[m] for m in range(len(two)) if m != k]
                if len(gi) == 1 and any(r[0] == gi for r in rest) or len(gi) > 1 and go and not _others(gi, go) and len(go) > 1:
                    slots.append((i, "S", len(xs), 1))
                    xs.append(one[0])
                    ys.append(two[k])
    sim = jaro_winkler(xs, ys) if xs else []
    out = [False] * n
    for i, kind, at, n_few in slots:
        if kind in "PG":
            s = sim[at : at + n_few] if kind == "P" else _best_of(sim, at, n_few, max(len(fa[i]), len(fb[i])))
            ok = min(s) >= LEAST and sum(s) >= n_few * MEAN
        else:
            ok = sim[at] >= {"J": JOINED, "C": COINED, "S": ONE}[kind]
        out[i] = out[i] or ok
    return pd.Series(out)


@F.pandas_udf(T.BooleanType())
def same_name(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
    return _agree(a, b)


def classes(spark: SparkSession, df: DataFrame, id_column: str, name_column: str, parts: tuple[str, ...] = ()) -> DataFrame:
    """(id, label, and of the reading the ``parts`` asked for) for every id whose name can be read: equal labels name the same business.

    A label begins with an id of its class. Null, empty and unreadable names get no label; an id delivered twice
    may carry two. Two names are linked if their numbers are equal, their trades don't differ, their given names
    agree through the nickname table or by initial, and their family names agree by Jaro-Winkler in either order.
    """
    scratch = Scratch(spark)
    fields = ["given", "families", "trade", "number", "joined", "folded"]
    source = df.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{name_column}`").alias("name")).where("id is not null and name is not null")
    read_rows = source.groupBy("name").agg(F.min("id").alias("first")).select("name", "first", reading("name").alias("r"))
    read_rows = scratch.cut(read_rows.where("r.families <> '' or r.joined <> ''").select("name", "first", "r.*"))
    reps = read_rows.groupBy(*fields).agg(F.min("first").alias("rep"))
    # two readings may share their first id when it was delivered twice with other names
    reps = reps.withColumn("node", F.concat_ws("\x01", "rep", F.lower(F.hex(F.xxhash64(*fields))))).withColumn("n", F.monotonically_increasing_id())
    reps = scratch.cut(reps.drop("rep"))
    keyed = reps.select("n", keyed_reading(*fields).alias("k")).select("n", F.explode("k.keys").alias("key"), "k.signature")
    # initials serve pairs of which one side is a single family
    initial = F.col("key").startswith("I")
    leads = ~initial | (F.hex(F.substring("signature", 1, 1)) == "01")
    keyed = keyed.select("n", F.shiftleft(F.xxhash64("key"), 1).bitwiseOR(initial.cast("long")).alias("key"), leads.alias("leads"), "signature")
    pairs = possible_pairs(keyed, SIGNATURE, _possible)
    of = reps.select("n", F.struct("node", *fields).alias("r"))
    pairs = pairs.join(of.toDF("a", "ra").hint("merge"), "a").join(of.toDF("b", "rb").hint("merge"), "b").where("ra.number = rb.number")
    pairs = pairs.select(F.least("ra", "rb").alias("ra"), F.greatest("ra", "rb").alias("rb"))
    good = scratch.cut(pairs.where(same_name("ra", "rb")).select(F.col("ra.node").alias("na"), F.col("rb.node").alias("nb"), F.col("ra.trade").alias("ta"), F.col("rb.trade").alias("tb")))
    firm = labels_of(spark, good.where("ta <> '' and tb <> ''").select(F.col("na").alias("a"), F.col("nb").alias("b")), scratch)
    firm = scratch.cut(reps.where("trade <> ''").select("node").join(firm.withColumnRenamed("id", "node"), "node", "left").select("node", F.coalesce("label", "node").alias("label")))
    mixed = good.where("(ta = '') <> (tb = '')").select(
        F.when(F.col("ta") == "", F.col("na")).otherwise(F.col("nb")).alias("loose"), F.when(F.col("ta") == "", F.col("nb")).otherwise(F.col("na")).alias("node")
    )
    seen = scratch.cut(mixed.join(firm, "node").groupBy("loose").agg(F.min("label").alias("a"), F.max("label").alias("b")))
    unclear = seen.where("a <> b").select("loose")
    both = good.where("ta = '' and tb = ''").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    both = both.join(unclear, F.col("a") == F.col("loose"), "left_anti").join(unclear, F.col("b") == F.col("loose"), "left_anti")
    # only classes that loose names touch can still grow
    links = seen.where("a = b").select(F.col("loose").alias("a"), "b").unionByName(both)
    grown = labels_of(spark, links, scratch)
    base = reps.join(firm, "node", "left").select(*fields, F.coalesce("label", "node").alias("base"))
    of_node = base.join(grown, base["base"] == grown["id"], "left").select(*fields, F.coalesce("label", "base").alias("label"))
    of_name = read_rows.join(of_node, fields).select(F.col("name").alias("_n"), F.struct("label", *parts).alias("_r"))
    # one filler may be the name of any share of the rows
    return lookup_join(source, "name", of_name, "_n", "_r", "_r").select("id", "_r.*").distinct()


def variants(spark: SparkSession, df: DataFrame, id_column: str, name_column: str, left: str = "entity_id_a", right: str = "entity_id_b") -> DataFrame:
    """Pairs of different ids whose names mean the same business, the smaller first, each once."""
    found = Scratch(spark).cut(classes(spark, df, id_column, name_column))
    a, b = found.toDF(left, "label"), found.toDF(right, "label")
    return a.join(b, "label").where(F.col(left) < F.col(right)).select(left, right).distinct()
