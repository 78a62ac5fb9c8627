"""Names and addresses in parallel plain representations, as Column expressions that stay in generated code.

Every function takes and gives Columns. Null counts as the empty string.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.functions import vocabulary as V

TEXT = "string"


def filled(c: Column) -> Column:
    return F.coalesce(c.cast(TEXT), F.lit(""))


def fold_accents(c: Column) -> Column:
    """Lower case without accents; other scripts stay as they are."""
    c = reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), V.EXPANSIONS, filled(c))
    return F.lower(F.regexp_replace(F.translate(c, V.ACCENTS_FROM, V.ACCENTS_TO), r"\p{M}", ""))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def letters_only(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, r"[^a-z0-9\s]", " "))


def words(c: Column) -> Column:
    """Words of a text in which single spaces part them; none of an empty one."""
    return F.filter(F.split(c, " "), lambda w: w != "")


def clean_name(c: Column) -> Column:
    c = F.replace(F.replace(filled(c), F.lit("&"), F.lit(" and ")), F.lit("@"), F.lit(" at "))
    return letters_only(fold_accents(c))


def legal_form(clean: Column) -> Column:
    """Tag of the first legal form, in the order of the table, that occurs in a cleaned name; NONE without one."""
    first, *rest = V.LEGAL_FORMS
    out = F.when(clean.rlike(first[0]), first[1])
    for pattern, tag in rest:
        out = out.when(clean.rlike(pattern), tag)
    return out.otherwise("NONE")


def core_name(clean: Column, form: Column) -> Column:
    """A cleaned name without any occurrence of its legal form; the name itself if nothing would remain."""
    out = clean
    for pattern, tag in V.LEGAL_FORMS:
        out = F.when(form == tag, squeeze(F.regexp_replace(clean, pattern, " "))).otherwise(out)
    return F.when(out == "", clean).otherwise(out)


def tokens_without(clean: Column, stop: list[str], least: int = 3) -> Column:
    """Distinct words of ``least`` letters or more that aren't stop words, in order."""
    return F.array_distinct(F.filter(words(clean), lambda w: (F.length(w) >= least) & ~w.isin(*stop)))


def acronym(clean: Column) -> Column:
    """Initials of two or more words that count; otherwise empty."""
    w = F.filter(words(clean), lambda x: ~x.isin(*V.ACRONYM_STOPWORDS))
    return F.when(F.size(w) >= 2, F.array_join(F.transform(w, lambda x: F.substring(x, 1, 1)), "")).otherwise("")


def sound_code(c: Column) -> Column:
    """First letter and the classes of the consonants after it without runs, four characters filled up with zeros."""
    letters = F.regexp_replace(F.upper(filled(c)), "[^A-Z]", "")
    rest = F.translate(F.regexp_replace(F.substring(letters, 2, 1_000_000), "[AEIOUHWY]", ""), *V.SOUND_CLASSES)
    rest = F.regexp_replace(rest, r"(\d)\1+", "$1")
    return F.when(letters == "", "").otherwise(F.rpad(F.concat(F.substring(letters, 1, 1), F.substring(rest, 1, 3)), 4, "0"))


def clean_address(c: Column) -> Column:
    c = filled(c)
    for a, b in (("&", " and "), ("@", " at "), ("#", " # ")):
        c = F.replace(c, F.lit(a), F.lit(b))
    c = fold_accents(c)
    for pattern, short in V.ADDRESS_ABBREVIATIONS:
        c = F.regexp_replace(c, pattern, f" {short} ")
    return letters_only(c)


def postal_code(raw: Column, country: Column) -> Column:
    """First six-digit or five-digit code, by what the country uses, in the raw text; otherwise either, six first."""
    raw, country = filled(raw), F.upper(filled(country))
    six, five = (F.nullif(F.regexp_extract(raw, p, 1), F.lit("")) for p in (V.POSTAL_SIX, V.POSTAL_FIVE))
    own = F.when(country.isin(*V.SIX_DIGIT_COUNTRIES), six).when(country.isin(*V.FIVE_DIGIT_COUNTRIES), five)
    return F.coalesce(own, six, five, F.lit(""))


def unit_number(raw: Column) -> Column:
    raw = filled(raw)
    found = [F.nullif(F.regexp_replace(F.lower(F.regexp_extract(raw, p, 1)), r"[^a-z0-9\-]", ""), F.lit("")) for p in V.UNIT_PATTERNS]
    return F.coalesce(*found, F.lit(""))


def digit_blocks(raw: Column, least: int = 1, most: int = 8) -> Column:
    """Numbers of ``least`` to ``most`` digits that stand alone, of any script, joined by spaces."""
    return F.array_join(F.regexp_extract_all(filled(raw), F.lit(rf"(?U)\b(\d{{{least},{most}}})\b"), F.lit(1)), " ")


def without_domain(c: Column) -> Column:
    """A name without the first fitting ending of a web address, if more than two letters remain."""
    c = F.trim(filled(c))
    out = None
    for s in V.DOMAIN_SUFFIXES:
        fits = c.endswith(s) & (F.length(c) > len(s) + 2)
        kept = F.trim(F.substring(c, F.lit(1), F.length(c) - len(s)))
        out = F.when(fits, kept) if out is None else out.when(fits, kept)
    return out.otherwise(c)


def char_grams(c: Column, n: int) -> Column:
    """Runs of ``n`` letters of a text without its spaces, repeats kept."""
    c = F.replace(filled(c), F.lit(" "), F.lit(""))
    return F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def text_grams(c: Column, n: int = 3) -> Column:
    """Distinct runs of ``n`` characters with the spaces; a shorter text is its own only run."""
    c = filled(c)
    long = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1))), lambda i: F.substring(c, i, F.lit(n))))
    return F.when(F.length(c) >= n, long).when(c != "", F.array(c)).otherwise(F.array().cast("array<string>"))


def consonant_skeleton(c: Column) -> Column:
    """Letters and digits without vowels, y and neighbouring repeats."""
    return F.lower(F.regexp_replace(F.regexp_replace(filled(c), "[aeiouyAEIOUY ]|[^a-zA-Z0-9]", ""), r"(.)\1+", "$1"))


def initials_contain(acro: Column, tokens: Column) -> Column:
    """1.0 if an acronym of two letters or more is a run of the tokens' initials."""
    initials = F.lower(F.array_join(F.transform(tokens, lambda t: F.substring(t, 1, 1)), ""))
    return ((F.length(acro) >= 2) & (F.size(tokens) > 0) & initials.contains(F.lower(acro))).cast("double")


def postal_prefix(postal: Column, country: Column) -> Column:
    return F.when(country == "France", F.substring(postal, 1, 2)).otherwise(F.substring(postal, 1, 3))


def jaccard(a: Column, b: Column) -> Column:
    """Shared by all distinct elements; 0 for two empty arrays."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def containment(a: Column, b: Column) -> Column:
    """Share of the distinct elements of ``a`` that ``b`` has."""
    n = F.size(F.array_distinct(a))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(0.0)


def clean_entities(df: DataFrame, id_column: str = "entity_id", name: str = "business_name", address: str = "business_address", country: str = "country") -> DataFrame:
    """Entities with all name and address representations.

    Token lists are arrays. Addresses that are a filler count as missing; names are taken as they stand.
    """
    c = F.col
    raw = df.select(
        c(f"`{id_column}`").alias("entity_id"), c(f"`{country}`").alias("country"), filled(c(f"`{name}`")).alias("business_name_raw"),
        F.trim(filled(c(f"`{address}`"))).alias("_a"),
    )
    missing = F.lower("_a").isin(*V.NO_ADDRESS)
    raw = raw.select("entity_id", "country", "business_name_raw", F.when(missing, "").otherwise(c("_a")).alias("business_address_raw"))
    one = raw.withColumns({"name_clean": clean_name(c("business_name_raw")), "addr_clean": clean_address(c("business_address_raw"))})
    two = one.withColumn("legal_form", legal_form(c("name_clean")))
    three = two.withColumn("name_core", core_name(c("name_clean"), c("legal_form")))
    a = c("business_address_raw")
    return three.select(
        "entity_id", "country", "business_name_raw", "business_address_raw", "name_clean", "name_core", "legal_form",
        tokens_without(c("name_clean"), V.NAME_STOPWORDS).alias("name_tokens"), acronym(c("name_clean")).alias("name_acronym"),
        sound_code(c("name_core")).alias("name_phonetic"), "addr_clean", postal_code(a, c("country")).alias("postal_clean"),
        unit_number(a).alias("addr_unit_num"), digit_blocks(a).alias("addr_digits"),
        tokens_without(c("addr_clean"), V.ADDRESS_STOPWORDS).alias("addr_tokens"), (a != "").cast("tinyint").alias("has_address"),
    )


def basic_entities(df: DataFrame) -> DataFrame:
    """The first-generation representations: standardised name and address, tokens, two-word stem, long numbers."""
    def replaced(c: Column, table) -> Column:
        return squeeze(reduce(lambda x, r: F.regexp_replace(x, *r), table, c))

    name, address = F.col("business_name"), F.col("business_address")
    one = df.select("entity_id", "country", filled(address).alias("_a"), replaced(clean_name(name), V.LEGAL_REPLACEMENTS).alias("name_clean"), replaced(clean_name(address), V.ADDRESS_REPLACEMENTS).alias("addr_clean"))
    n = F.col("name_clean")
    core = F.slice(F.filter(words(n), lambda w: ~w.isin(*V.BASIC_STOPWORDS)), 1, 2)
    return one.select(
        "entity_id", "country", "name_clean", "addr_clean", F.array_join(tokens_without(n, V.BASIC_STOPWORDS), " ").alias("name_tokens"),
        F.when(F.size(core) > 0, F.array_join(core, " ")).otherwise(F.substring(n, 1, 10)).alias("core_stem"),
        digit_blocks(F.col("_a"), 3, 6).alias("postal_digits"), (F.trim("_a") != "").cast("tinyint").alias("has_address"),
    )
