import re

import pytest

from knotwork.llm import addresses, matching, names

NAMES = [
    ("a1", "Kelmavor & Trudesh Plumbing Ltd"), ("a2", "Trudesh, Kelmavor Plbg"), ("a3", "KELMAVOR TRUDESH PLUMBNG"), ("a4", "Kelmavór Trudésh Plumbing"), ("a5", "K. Trudesh Plumbing Limited"),
    ("a6", "#kelmavortrudesh"), ("a7", "Nokidan LLC dba Kelmvaor Trudesh Plumbing"), ("a8", "केल्मावोर त्रुदेश Plumbing Private Limited"),
    ("b1", "Kelmavor Trudesh Plumbing No. 2"), ("b2", "Kelmavor Trudesh Plumbing #2"), ("c1", "Robert Sanodik Fevull Bakery"), ("c2", "Bob Sanodik Fevull Bakers"), ("c3", "Richard Sanodik Fevull Bakery"),
    ("d1", None), ("d2", ""), ("d3", "---"), ("d4", "Ltd"), ("e1", "x" * 20_000), ("a1", "Kelmavor & Trudesh Plumbing Ltd"),
]


def test_name_classes(spark):
    df = spark.createDataFrame([(*r, "clash") for r in NAMES], "id string, name string, label string")
    got = {(r.entity_id_a, r.entity_id_b) for r in names.variants(spark, df, "id", "name").collect()}
    a = [f"a{i}" for i in range(1, 9)]
    assert {(x, y) for x in a for y in a if x < y} <= got
    assert ("b1", "b2") in got and ("c1", "c2") in got and not any(x[0][0] != x[1][0] for x in got)
    assert ("c1", "c3") not in got and ("c2", "c3") not in got and all(x < y for x, y in got)
    assert names.variants(spark, df.limit(0), "id", "name").count() == 0


def test_loose_name_joins_no_class_of_two_trades(spark):
    rows = [("1", "Kelmavor Trudesh Plumbing"), ("2", "Kelmavor Trudesh Bakery"), ("3", "kelmavor-trudesh.com.example"), ("4", "Sanodik Fevull Roofing"), ("5", "www.sanodikfevull.example")]
    got = {tuple(r) for r in names.variants(spark, spark.createDataFrame(rows, "id string, name string"), "id", "name").collect()}
    assert got == {("4", "5")}


def linked(spark, *rows):
    df = spark.createDataFrame([(f"{i:03d}", r) for i, r in enumerate(rows)], "id string, name string")
    return {(int(r.entity_id_a), int(r.entity_id_b)) for r in names.variants(spark, df, "id", "name").collect()}


def test_names_beyond_the_tables(spark):
    got = linked(
        spark, "Walmart", "Wallmart Inc", "Anderson Clark Davis Evans Widgets", "Anderson Clark Davis Foster Widgets", "Anderson Baker Clark Davis", "Davis, Anderson Bakre Clark", "Anderson Clark Davis Quillory",
        "shahmehta.com", "Shah Mehta Widgets", "Рога и Копыта", "Копыта, Рога и", "北京贸易公司", "上海贸易公司", "Ted Quorvel Hastimun Roofing", "Edward Quorvel Hastimun Roofing", "Theodore Quorvel Hastimun Roofing",
        " ".join(f"word{chr(97 + i)}ly" for i in range(12)), " ".join(f"word{chr(97 + i)}ly" for i in reversed(range(12))), "x" * 20_000, "x" * 19_999 + "y",
        "bcdfghjklmnp qrstvwxbzcdf Roofing", "bcdgfhkjlnmp qrsvtxwbzcfd Roofing",
    )
    assert {(0, 1), (4, 5), (9, 10), (13, 14), (16, 17), (20, 21)} <= got
    assert not {(2, 3), (4, 6), (11, 12), (18, 19)} & got


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("4893 Jafanavan Court, Koner Heights, TX 23622", (4893, "jafanavan", "court", "konerheights", "texas", "23622")),
        ("texas 23622, apt 7, #4893 jafanavan ct., koner heights", (4893, "jafanavan", "court", "konerheights", "texas", "23622")),
        ("30 Pl. Drozevelan, Bât. 3, 53344 Sodomac, France", (30, "drozevelan", "place", "sodomac", "", "53344")),
        ("H.No. 18/A, Krasomorus X Road, Behind Dranidard Bus Stand, Rokenpalli, PB 199774", (18, "krasomorus", "cross road", "rokenpalli", "punjab", "199774")),
        ("4OO5 Fapefotill Ave., Nosenville", (4005, "fapefotill", "avenue", "nosenville", "", "")),
        ("17560 Ellis Road, Tahlequah, OK", (17560, "ellis", "road", "tahlequah", "oklahoma", "")), ("301 First Street, Chokio, MN", (301, "1st", "street", "chokio", "minnesota", "")),
        ("Edwall, Washington, 29511 Tucker Prairie Rd", (29511, "tuckerprairie", "road", "edwall", "washington", "")), ("259 1/2 Cavalier Way, Burlington, NC", ("259 1/2", "cavalier", "way", "burlington", "north carolina", "")),
        ("D No. 20-6-3/12, Dantuluri Vari Street, Vijayawada, Andhra Pradesh", ("20-6-3/12", "dantulurivari", "street", "vijayawada", "andhra pradesh", "")),
        ("G-3/571, Gulmohar Colony, Bhopal, Madhya Pradesh", ("g-3/571", "gulmohar", "colony", "bhopal", "madhya pradesh", "")), ("110 Meadowbrook Acres, Canler, NC", (110, "meadowbrook", "acres", "canler", "north carolina", "")),
        ("##8 Main St, Nosenville", None), ("Main St, Nosenville", None), ("N/A", None), (None, None), ("", None),
    ],
)
def test_address_parser(raw, expected):
    assert addresses.parse(raw) == expected


def test_places(spark):
    rows = [
        ("1", "4893 Jafanavan Court, Koner Heights, TX 23622"), ("2", "tx, 4893 jafanvan ct, unit 3, koner heigths"), ("3", "4893 Jafanavan Ct, 23622"), ("4", "4893 Jafanavan Ct, Texas"),
        ("5", "4894 Jafanavan Court, Koner Heights, TX 23622"), ("6", "4893 Belovik Court, Koner Heights, TX 23622"), ("7", "4893 Jafanavan Court, Sodun Falls, TX"), ("8", None), ("9", "##3 Jafanavan Court"),
        ("10", "77 Same Name St, Atown"), ("11", "77 Same Name St, Btown, Ohio"), ("12", "77 Same Name St"), ("13", "y" * 30_000),
    ]
    got = {tuple(r) for r in addresses.same_premises(spark, spark.createDataFrame(rows, "id string, address string"), "id", "address").collect()}
    assert {("1", "2"), ("1", "3"), ("2", "3")} <= got
    assert not any({"5", "6", "7", "8", "9", "12"} & set(p) for p in got)
    assert addresses.same_premises(spark, spark.createDataFrame([], "id string, address string"), "id", "address").count() == 0


def test_cascade(spark):
    cols = "entity_id string, business_name string, business_address string, country string"
    one = [("S1-1", "Kelmavor Trudesh Plumbing", "4893 Jafanavan Court, Koner Heights, TX 23622", "US"), ("S1-2", "Sanodik Fevull Bakery", "77 Belovik Street, Sodun Falls, OH", "US"), ("S1-3", None, None, None), ("S1-4", "Motamik Greval Foods", "5 Rue Cadovel, Sodomac", "France")]
    three = [("S3-1", "Trudesh & Kelmavor Plbg", "4893 jafanavan ct, koner heights", "usa"), ("S3-2", "Sanodik Fevull Bakers", None, "US"), ("S3-3", "Other Thing Roofing", "9 Nowhere Road, Atown", "US"), ("S3-1", "Trudesh & Kelmavor Plbg", "4893 jafanavan ct, koner heights", "usa"), ("S3-4", None, "", None)]
    labels = spark.createDataFrame([("S1-2", "S3-2"), ("S1-4", "")], "source1_entity_id string, matched_entity_ids string")
    l, r = spark.createDataFrame(one, cols), spark.createDataFrame(three, cols)
    got = {(x.left_id, x.right_id): x for x in matching.match(spark, l, r, matching.labelled(labels)).collect()}
    assert set(got) == {("S1-1", "S3-1"), ("S1-2", "S3-2")}
    # an entity's own label doesn't count for it: its half is graded by the other one
    assert got[("S1-2", "S3-2")].confidence == 0.5 and got[("S1-1", "S3-1")].confidence == 0.5
    assert [tuple(x) for x in matching.unlabelled_matches(spark, l, r, labels).collect()] == [("S1-1", "S3-1")]
    assert matching.match(spark, l, r.limit(0), matching.labelled(labels)).count() == 0


@pytest.mark.parametrize("name", ["p1_found", "p5_found"])
def test_on_tables(name, spark, data):
    """What is found among labelled entities agrees with the labels as far as they go."""
    from knotwork.llm.queries import QUERIES

    rows = QUERIES[name](spark, data).collect()
    assert rows and len(rows) == len({tuple(r) for r in rows}) and all(r.entity_id_a < r.entity_id_b for r in rows)
    if name == "p1_found":
        of = {}
        for r in spark.read.parquet(f"{data}/train_matched_ids.parquet").collect():
            of.update({i: r.source1_entity_id for i in re.findall(r"S3-\d+", r.matched_entity_ids or "")})
        known = [(of[r.entity_id_a], of[r.entity_id_b]) for r in rows if r.entity_id_a in of and r.entity_id_b in of]
        assert sum(a == b for a, b in known) >= 0.9 * len(known)
