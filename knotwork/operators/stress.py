"""A set of altered entities for trying a linkage on spellings it wasn't trained on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.functions import vocabulary as V
from knotwork.functions.normalize import filled
from knotwork.operators.sampling import chance

# Share of names that get accents, and of their letters.
NAMES, LETTERS = 0.35, 0.25


def french_name(name: Column, entity: Column, seed: int) -> Column:
    """Lower case, the first ending of the table that occurs made French, accents on some letters of some names."""
    out = low = F.lower(filled(name))
    for pattern, ending in reversed(V.FRENCH_ENDINGS):
        out = F.when(low.rlike(pattern), F.regexp_replace(low, pattern, ending)).otherwise(out)

    def accented(at: Column) -> Column:
        c, i = F.substring(out, at, F.lit(1)), at - 1
        new = c
        for plain, forms in V.ACCENTED.items():
            pick = F.floor(chance(seed, entity, F.lit("form"), i.cast("string")) * len(forms)).cast("int") + 1
            new = F.when(c == plain, F.substring(F.lit(forms), pick, F.lit(1))).otherwise(new)
        return F.when(chance(seed, entity, F.lit("letter"), i.cast("string")) < LETTERS, new).otherwise(c)

    places = F.when(F.length(out) > 0, F.sequence(F.lit(1), F.greatest(F.length(out), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    with_accents = F.array_join(F.transform(places, accented), "")
    return F.when(chance(seed, entity, F.lit("name")) < NAMES, with_accents).otherwise(out)


def french_address(address: Column) -> Column:
    out = F.lower(filled(address))
    for pattern, kind in V.FRENCH_STREETS:
        out = F.regexp_replace(out, pattern, kind)
    return out


def french_set(df: DataFrame, seed: int = 42) -> DataFrame:
    """(entity_id, country, name, address, postal_code, original_entity_id) of every entity in French guise."""
    # under another name, so that no function takes the new id for the old one
    df = df.withColumnRenamed("entity_id", "original_entity_id")
    e = F.col("original_entity_id")
    code = F.get(F.lit(V.FRENCH_POSTAL_CODES), F.floor(chance(seed, e, F.lit("code")) * len(V.FRENCH_POSTAL_CODES)).cast("int"))
    return df.select(
        F.concat(F.lit("FR_SYN_"), e).alias("entity_id"), F.lit("France").alias("country"), french_name(F.col("business_name"), e, seed).alias("name"),
        french_address(F.col("business_address")).alias("address"), code.alias("postal_code"), "original_entity_id",
    )
