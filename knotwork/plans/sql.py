"""SQL texts of the normalisers, made from the fixed values, for comparison with the Column expressions."""

from __future__ import annotations

from knotwork.functions import vocabulary as V


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listed(words) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def chained(x: str, table, pad: bool = False) -> str:
    for pattern, short in table:
        x = f"regexp_replace({x}, {q(pattern)}, {q(f' {short} ' if pad else short)}, 'g')"
    return x


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def fold(x: str) -> str:
    for a, b in V.EXPANSIONS:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return f"lower(regexp_replace(translate({x}, {q(V.ACCENTS_FROM)}, {q(V.ACCENTS_TO)}), '\\p{{M}}', '', 'g'))"


def plain(x: str) -> str:
    return squeeze(f"regexp_replace({x}, '[^a-z0-9\\s]', ' ', 'g')")


def clean_name(x: str) -> str:
    return plain(fold(f"replace(replace({x}, '&', ' and '), '@', ' at ')"))


def clean_address(x: str) -> str:
    y = fold(f"replace(replace(replace({x}, '&', ' and '), '@', ' at '), '#', ' # ')")
    return plain(chained(y, V.ADDRESS_ABBREVIATIONS, True))


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def ordered_distinct(x: str) -> str:
    return f"list_filter({x}, lambda w, i: list_position({x}, w) = i)"


def tokens(x: str, stop, least: int = 3) -> str:
    return ordered_distinct(f"list_filter({words(x)}, lambda w: length(w) >= {least} and w not in {listed(stop)})")


def legal_form(x: str) -> str:
    return "case " + " ".join(f"when regexp_matches({x}, {q(p)}) then {q(t)}" for p, t in V.LEGAL_FORMS) + " else 'NONE' end"


def core_name(x: str, form: str) -> str:
    found = "case " + " ".join(f"when {form} = {q(t)} then " + squeeze(f"regexp_replace({x}, {q(p)}, ' ', 'g')") for p, t in V.LEGAL_FORMS) + f" else {x} end"
    return f"coalesce(nullif({found}, ''), {x})"


def acronym(x: str) -> str:
    w = f"list_filter({words(x)}, lambda w: w not in {listed(V.ACRONYM_STOPWORDS)})"
    return f"case when len({w}) >= 2 then array_to_string(list_transform({w}, lambda w: w[1]), '') else '' end"


def sound_code(x: str) -> str:
    letters = f"regexp_replace(upper({x}), '[^A-Z]', '', 'g')"
    rest = f"translate(regexp_replace({letters}[2:], '[AEIOUHWY]', '', 'g'), {q(V.SOUND_CLASSES[0])}, {q(V.SOUND_CLASSES[1])})"
    for d in "123456":
        rest = f"regexp_replace({rest}, '{d}+', '{d}', 'g')"
    return f"case when {letters} = '' then '' else rpad({letters}[1] || ({rest})[1:3], 4, '0') end"


def postal_code(raw: str, country: str) -> str:
    six, five = (f"nullif(regexp_extract({raw}, {q(p)}, 1), '')" for p in (V.POSTAL_SIX, V.POSTAL_FIVE))
    return (
        f"coalesce(case when upper(coalesce({country}, '')) in {listed(V.SIX_DIGIT_COUNTRIES)} then {six}"
        f" when upper(coalesce({country}, '')) in {listed(V.FIVE_DIGIT_COUNTRIES)} then {five} end, {six}, {five}, '')"
    )


def unit_number(raw: str) -> str:
    # word boundaries here know only plain letters; an underscore stands in for others
    raw = f"regexp_replace({raw}, '[À-ÖØ-öø-ɏḀ-ỿऀ-ॿ]', '_', 'g')"
    found = [f"nullif(regexp_replace(lower(regexp_extract({raw}, {q(p)}, 1)), '[^a-z0-9\\-]', '', 'g'), '')" for p in V.UNIT_PATTERNS]
    return f"coalesce({', '.join(found)}, '')"


def digit_blocks(raw: str, least: int = 1, most: int = 8) -> str:
    return f"array_to_string(regexp_extract_all({raw}, '\\b\\d{{{least},{most}}}\\b'), ' ')"


def without_domain(x: str) -> str:
    t = f"trim({x})"
    return "case " + " ".join(f"when ends_with({t}, {q(s)}) and length({t}) > {len(s) + 2} then trim({t}[:-{len(s) + 1}])" for s in V.DOMAIN_SUFFIXES) + f" else {t} end"


def char_grams(x: str, n: int) -> str:
    t = f"replace({x}, ' ', '')"
    return f"case when length({t}) >= {n} then list_transform(range(1, length({t}) - {n - 2}), lambda i: {t}[i:i + {n - 1}]) else [] end"


def skeleton(x: str) -> str:
    y = f"regexp_replace({x}, '[aeiouyAEIOUY ]|[^a-zA-Z0-9]', '', 'g')"
    return f"lower(array_to_string(list_filter(string_split({y}, ''), lambda c, i: c <> '' and (i = 1 or c <> ({y})[i - 1])), ''))"


def jaccard(a: str, b: str) -> str:
    return f"case when len(list_distinct({a} || {b})) > 0 then len(list_intersect(list_distinct({a}), list_distinct({b}))) / len(list_distinct({a} || {b})) else 0 end"


def contained(a: str, b: str) -> str:
    return f"case when len({a}) > 0 then len(list_intersect(list_distinct({a}), list_distinct({b}))) / len(list_distinct({a})) else 0 end"


def clean_entities(source: str, name: str = "entities") -> str:
    """CTEs ``<name>_raw``, ``<name>_two``, ``<name>_three`` and ``<name>`` over a table or CTE of raw entities."""
    return f"""
{name}_raw as (
  select entity_id, country, coalesce(business_name, '') as business_name_raw,
         case when lower(trim(coalesce(business_address, ''))) in {listed(V.NO_ADDRESS)} then '' else trim(business_address) end as business_address_raw
  from {source}),
{name}_two as materialized (
  select *, {clean_name('business_name_raw')} as name_clean, {clean_address('business_address_raw')} as addr_clean from {name}_raw),
{name}_form as (select *, {legal_form('name_clean')} as legal_form from {name}_two),
{name}_three as materialized (select *, {core_name('name_clean', 'legal_form')} as name_core from {name}_form),
{name} as materialized (
  select entity_id, country, business_name_raw, business_address_raw, name_clean, name_core, legal_form,
         {tokens('name_clean', V.NAME_STOPWORDS)} as name_tokens, {acronym('name_clean')} as name_acronym, {sound_code('name_core')} as name_phonetic,
         addr_clean, {postal_code('business_address_raw', 'country')} as postal_clean, {unit_number('business_address_raw')} as addr_unit_num,
         {digit_blocks('business_address_raw')} as addr_digits, {tokens('addr_clean', V.ADDRESS_STOPWORDS)} as addr_tokens,
         cast(business_address_raw <> '' as tinyint) as has_address
  from {name}_three)"""
