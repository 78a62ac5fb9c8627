import pytest
from pyspark.sql import functions as F

from knotwork.functions import normalize as N


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).collect()[0].y


@pytest.mark.parametrize(
    ("raw", "clean", "core", "form", "acro", "tokens", "sound"),
    [
        ("Tata Consultancy Services Pvt. Ltd.", "tata consultancy services pvt ltd", "tata consultancy services", "PVT_LTD", "tcspl", "tata consultancy", "T325"),
        ("L.L.Bean Inc.", "l l bean inc", "l l bean", "INC", "llbi", "bean", "L415"),
        ("Societe Generale S.A.R.L.", "societe generale s a r l", "generale s a r l", "SOCIETE", "sgsrl", "generale", None),
        ("Laxmi Jewellers & Sons", "laxmi jewellers and sons", "laxmi jewellers", "FAMILY_BUSINESS", "ljs", "laxmi jewellers sons", None),
        ("State Bank of India", "state bank of india", "state bank of india", "NONE", "sbi", "state bank", None),
        ("Acme Limited Liability Company", "acme limited liability company", "acme liability company", "LTD", "allc", "acme liability", None),
        ("Café  Élan", "cafe elan", "cafe elan", "NONE", "ce", "cafe elan", "C145"), ("हिन्दी", "", "", "NONE", "", "", ""), (None, "", "", "NONE", "", "", ""),
    ],
)
def test_names(spark, raw, clean, core, form, acro, tokens, sound):
    row = N.clean_entities(spark.createDataFrame([("1", raw, None, "US")], "entity_id string, business_name string, business_address string, country string")).collect()[0]
    assert (row.name_clean, row.name_core, row.legal_form, row.name_acronym, " ".join(row.name_tokens)) == (clean, core, form, acro, tokens)
    if sound is not None:
        assert row.name_phonetic == sound


@pytest.mark.parametrize(("word", "code"), [("babab", "B100"), ("pfister", "P123"), ("", ""), ("a", "A000")])
def test_sound_code(spark, word, code):
    assert one(spark, word, N.sound_code) == code


@pytest.mark.parametrize(
    ("raw", "country", "clean", "postal", "unit", "digits"),
    [
        ("123 Main Street, Suite 400, New York, NY 10001", "US", "123 main st suite 400 new york ny 10001", "10001", "400", "123 400 10001"),
        ("Shop No 14, Ground Floor, MG Road, Indiranagar, Bangalore 560038", "India", None, "560038", "14", "14 560038"),
        ("15 Rue de Rivoli, 75004 Paris, France", "France", None, "75004", None, None), ("17560 Ellis Road, Tahlequah, OK", "US", None, "17560", None, None),
        ("12 North Street", "US", None, "", "rth", "12"), ("st. louis", "US", "st louis", "", None, ""), ("st.paul", "US", "st paul", None, None, None),
        ("nan", "US", "", "", "", ""), (None, "US", "", "", "", ""), ("12 a १२ 34", "US", None, None, None, "12 १२ 34"),
    ],
)
def test_addresses(spark, raw, country, clean, postal, unit, digits):
    row = N.clean_entities(spark.createDataFrame([("1", None, raw, country)], "entity_id string, business_name string, business_address string, country string")).collect()[0]
    for got, expected in ((row.addr_clean, clean), (row.postal_clean, postal), (row.addr_unit_num, unit), (row.addr_digits, digits)):
        assert expected is None or got == expected
    assert row.has_address == (0 if raw in (None, "nan") else 1)


def test_fragments(spark):
    assert one(spark, "summithealth com", N.without_domain) == "summithealth"
    assert one(spark, "abc in", N.without_domain) == "abc" and one(spark, "ab in", N.without_domain) == "ab in"
    assert one(spark, "ab cab", lambda c: N.char_grams(c, 3)) == ["abc", "bca", "cab"] and one(spark, "ab", lambda c: N.char_grams(c, 3)) == []
    assert one(spark, "venkateshwara", N.consonant_skeleton) == "vnktshwr"
    assert one(spark, "sbi", lambda c: N.initials_contain(c, F.array(F.lit("state"), F.lit("bank"), F.lit("india")))) == 1.0
