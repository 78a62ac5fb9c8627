"""Fixed values of the normalisers: word lists, tables and patterns that results depend on.

Lists stand in the order in which they apply. Patterns are written for regular expression engines without look-around,
so the same text serves Spark and SQL.
"""

from __future__ import annotations

import unicodedata

# ---- Fixed values -------------------------------------------------------------------------------------------------

#: Legal forms by pattern; of cleaned names the first that occurs wins.
LEGAL_FORMS = (
    (r"\b(pvt\s*ltd|private\s*limited|p\s*ltd|pvt\s*limited)\b", "PVT_LTD"),
    (r"\b(public\s*limited|pub\s*ltd)\b", "PUB_LTD"),
    (r"\b(limited|ltd)\b", "LTD"),
    (r"\b(limited\s*liability\s*company|llc)\b", "LLC"),
    (r"\b(incorporated|inc)\b", "INC"),
    (r"\b(corporation|corp)\b", "CORP"),
    (r"\b(societe\s*anonyme|sa)\b", "SA"),
    (r"\b(societe\s*a\s*responsabilite\s*limitee|sarl)\b", "SARL"),
    (r"\b(societe\s*par\s*actions\s*simplifiee|sas)\b", "SAS"),
    (r"\b(entreprise\s*unipersonnelle|eurl)\b", "EURL"),
    (r"\b(societe\s*civile\s*immobiliere|sci)\b", "SCI"),
    (r"\b(societe|soc)\b", "SOCIETE"),
    (r"\b(limited\s*liability\s*partnership|llp)\b", "LLP"),
    (r"\b(and\s*company|and\s*co)\b", "PARTNERSHIP"),
    (r"\b(and\s*sons|and\s*brothers|bros)\b", "FAMILY_BUSINESS"),
)

NAME_STOPWORDS = (
    "the a an and of in for on at by to with pvt ltd llc inc corp co sa sarl sas llp eurl sci private limited company"
    " corporation incorporated societe services service enterprises enterprise solutions international global group"
    " holdings management india usa us france"
).split()

ACRONYM_STOPWORDS = "and of the in for at to by a an".split()

#: Replacements of cleaned addresses, in order; each result is set between spaces.
ADDRESS_ABBREVIATIONS = (
    (r"\b(street|str|st\.)\b", "st"), (r"\b(road|rd\.)\b", "rd"), (r"\b(avenue|ave\.)\b", "ave"), (r"\b(boulevard|blvd\.)\b", "blvd"),
    (r"\b(lane|ln\.)\b", "ln"), (r"\b(drive|dr\.)\b", "dr"), (r"\b(court|ct\.)\b", "ct"), (r"\b(highway|hwy\.)\b", "hwy"),
    (r"\b(building|bldg\.)\b", "bldg"), (r"\b(floor|flr\.)\b", "flr"), (r"\b(rue|r\.)\b", "rue"), (r"\b(boulevard|bd\.|bld\.)\b", "bd"),
    (r"\b(avenue|av\.)\b", "av"), (r"\b(allee|all\.)\b", "allee"), (r"\b(impasse|imp\.)\b", "imp"), (r"\b(chemin|che\.)\b", "chemin"),
    (r"\b(place|pl\.)\b", "place"), (r"\b(zone\s*industrielle|z\.i\.|zi)\b", "zi"), (r"\b(zone\s*d\s*activite|z\.a\.|za)\b", "za"),
    (r"\b(opposite|opp\.)\b", "opp"), (r"\b(near|nr\.)\b", "near"), (r"\b(behind|bh\.)\b", "behind"), (r"\b(beside|adj\.)\b", "beside"),
    (r"\b(nagar|ngr\.)\b", "nagar"), (r"\b(colony|clny\.)\b", "colony"), (r"\b(marg|mrg\.)\b", "marg"), (r"\b(chowk|chwk\.)\b", "chowk"),
    (r"\b(bazaar|bazar)\b", "bazar"),
)

ADDRESS_STOPWORDS = (
    "the a an and of in for on at by to with st rd ave blvd ln dr ct hwy bldg flr apt ste street road avenue lane drive"
    " court highway building floor rue bd av allee imp chemin place zi za cedex opp near behind beside nagar colony marg"
    " chowk bazar india usa us france box po pobox"
).split()

UNIT_PATTERNS = (
    r"(?i)\b(?:shop\s*no|flat\s*no|plot\s*no|door\s*no|house\s*no|h\.?\s*no|d\.?\s*no|apt\s*no|suite|ste|apt|apartment|flat|shop|unit|door|plot|house|no)\.?\s*[:#\.\-]?\s*([a-z0-9\-/]+)\b",
    r"(?i)#\s*([a-z0-9\-/]+)",
)
POSTAL_SIX, POSTAL_FIVE = r"\b([1-9][0-9]{5})\b", r"\b([0-9]{5})(?:-[0-9]{4})?\b"
SIX_DIGIT_COUNTRIES, FIVE_DIGIT_COUNTRIES = ("INDIA", "IN"), ("FRANCE", "FR", "UNITED STATES", "US", "USA")
NO_ADDRESS = ("", "nan", "none", "null")

#: Consonants by sound class; all other letters have none.
SOUND_CLASSES = ("BFPVCGJKQSXZDTLMNR", "111122222222334556")

DOMAIN_SUFFIXES = (
    ".com .org .net .in .co.in .co .io .ai .fr .biz .info .gov .edu .us .uk .de .eu".split()
    + [" com", " org", " net", " co in", " in", " co", " io", " ai", " fr", " biz", " info", " gov", " edu", " us"]
)

LOCALITY_WORDS = (
    "nagar colony layout phase sector sec vihar enclave society soc mohalla puram wadi pada baug bazaar bazar mandi market"
    " park village gram taluka dist district suburb hills gardens heights town ward"
).split()

LANDMARK_WORDS = (
    "opp opposite nr near adj adjacent behind bh bd beside front above below temple mandir masjid church station stn railway"
    " bus stand stop depot bridge cross circle chowk corner gate hospital school college petrol pump bank"
).split()

#: First-generation normaliser: replacements of cleaned names and addresses, and its stop words.
LEGAL_REPLACEMENTS = (
    (r"\bincorporated\b", "inc"), (r"\binc\b\.?", "inc"), (r"\bcorporation\b", "corp"), (r"\bcorp\b\.?", "corp"), (r"\bcompany\b", "co"),
    (r"\bco\b\.?", "co"), (r"\blimited liability company\b", "llc"), (r"\bllc\b\.?", "llc"), (r"\bl\.l\.c\b\.?", "llc"),
    (r"\bprivate limited\b", "pvt ltd"), (r"\bpvt\b\.?\s*\bltd\b\.?", "pvt ltd"), (r"\bp\b\.?\s*\bltd\b\.?", "pvt ltd"), (r"\blimited\b", "ltd"),
    (r"\bltd\b\.?", "ltd"), (r"\bpublic limited\b", "pub ltd"), (r"\benterprises\b", "ent"), (r"\benterprise\b", "ent"), (r"\bservices\b", "svc"),
    (r"\bservice\b", "svc"), (r"\bassociates\b", "assoc"), (r"\bassoc\b\.?", "assoc"), (r"\bsociete anonyme\b", "sa"), (r"\bs\.a\b\.?", "sa"),
    (r"\bsarl\b\.?", "sarl"), (r"\bs\.a\.r\.l\b\.?", "sarl"), (r"\bsas\b\.?", "sas"), (r"\bs\.a\.s\b\.?", "sas"), (r"\beurl\b\.?", "eurl"), (r"\bsci\b\.?", "sci"),
)
ADDRESS_REPLACEMENTS = (
    (r"\bstreet\b", "st"), (r"\bst\b\.?", "st"), (r"\broad\b", "rd"), (r"\brd\b\.?", "rd"), (r"\bavenue\b", "ave"), (r"\bave\b\.?", "ave"),
    (r"\bboulevard\b", "blvd"), (r"\bblvd\b\.?", "blvd"), (r"\blane\b", "ln"), (r"\bln\b\.?", "ln"), (r"\bdrive\b", "dr"), (r"\bdr\b\.?", "dr"),
    (r"\bcourt\b", "ct"), (r"\bct\b\.?", "ct"), (r"\bhighway\b", "hwy"), (r"\bhwy\b\.?", "hwy"), (r"\bapartment\b", "apt"), (r"\bapt\b\.?", "apt"),
    (r"\bsuite\b", "ste"), (r"\bste\b\.?", "ste"), (r"\bfloor\b", "flr"), (r"\bflr\b\.?", "flr"), (r"\bnear\b", "near"), (r"\bopposite\b", "opp"),
    (r"\bopp\b\.?", "opp"), (r"\bdoor no\b\.?", "no"), (r"\bflat no\b\.?", "no"), (r"\bh no\b\.?", "no"), (r"\bhouse no\b\.?", "no"),
)
BASIC_STOPWORDS = (
    "the a an and of in for on at by to with inc corp co llc ltd pvt sa sarl sas company enterprise enterprises service"
    " services center centre group international global solutions holdings management india usa us france"
).split()

#: French stress set: endings and kinds of street with their French counterparts, postal codes, accents.
FRENCH_ENDINGS = (
    (r"\b(llc|l\.l\.c\.)\b", "sarl"), (r"\b(inc|incorporated|inc\.)\b", "sa"), (r"\b(corp|corporation|corp\.)\b", "sas"),
    (r"\b(ltd|limited|ltd\.)\b", "societe"), (r"\b(co|company)\b", "cie"),
)
FRENCH_STREETS = (
    (r"\b(street|st|st\.)\b", "rue"), (r"\b(avenue|ave|ave\.)\b", "avenue"), (r"\b(boulevard|blvd|blvd\.)\b", "boulevard"), (r"\b(road|rd|rd\.)\b", "route"),
    (r"\b(lane|ln|ln\.)\b", "allee"), (r"\b(drive|dr|dr\.)\b", "impasse"), (r"\b(way|wy)\b", "chemin"), (r"\b(place|pl)\b", "place"),
)
FRENCH_POSTAL_CODES = "75001 75008 69002 13001 31000 44000 06000 67000 33000 59000".split()
ACCENTED = {"e": "éèêë", "a": "àâ", "c": "ç", "i": "îï", "o": "ô", "u": "ùû"}

#: Letters that become several plain ones.
EXPANSIONS = (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("½", "1 2"), ("¼", "1 4"), ("¾", "3 4"), ("™", "tm"), ("№", "no"), ("…", " "))

# ---- Tables made by rule ------------------------------------------------------------------------------------------


def _plain_letters() -> tuple[str, str]:
    """Every character whose compatible decomposition is one plain letter, digit or space with marks, and that one."""
    a, b = [], []
    for i in range(0x80, 0x1FFFF):
        c = chr(i)
        d = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()
        if len(d) == 1 and d != c and d.isascii() and (d.isalnum() or d == " "):
            a.append(c)
            b.append(d)
    return "".join(a), "".join(b)


ACCENTS_FROM, ACCENTS_TO = _plain_letters()
