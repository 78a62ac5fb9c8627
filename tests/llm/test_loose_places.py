from knotwork.llm import addresses


def test_more_spellings_of_a_place_without_town_stay_linked(spark):
    rows = [
        ("1", "5466 Kolubovik Ln"), ("2", "5466 Kolubovik Lane, KY"), ("3", "5466 Kolubovk Ln"),
        # a place that two contradicting ones could be joins neither
        ("4", "812 Trudesh Street, KY"), ("5", "812 Trudesh Street"), ("6", "812 Trudesh Street, TX"),
    ]
    got = {tuple(r) for r in addresses.same_premises(spark, spark.createDataFrame(rows, "id string, address string"), "id", "address").collect()}
    assert got == {("1", "2"), ("1", "3"), ("2", "3")}
