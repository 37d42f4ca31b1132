from pyspark.sql import functions as F

from panelkit.functions import scalars as S


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("r")).first()["r"]


def test_slug_functions(spark):
    assert one(spark, S.slug_norm, "  Alpha\t") == "alpha"
    assert one(spark, S.slug_norm, None) == ""
    host = r"(www\.)?example\.tv"
    assert one(spark, lambda c: S.slug_norm_url(c, host), " https://www.example.tv/Some One/ ") == "someone"
    assert one(spark, S.slugify, " Mr. Big_Name 42 ") == "mrbig_name42"
    assert one(spark, S.url_last_part, "/a/b/slug/") == "slug"


def test_clean_number_and_safe_int(spark):
    assert one(spark, S.clean_number, "1,234.5") == 1234.5
    assert one(spark, lambda c: S.clean_number(c, strip_commas=False), "1,234") is None
    assert one(spark, S.clean_number, " 5 ") == 5.0
    assert one(spark, S.clean_number, "12d") is None          # Java suffixes rejected
    assert one(spark, S.clean_number, "NaN") is None
    assert one(spark, S.clean_number, "abc") is None
    assert one(spark, S.clean_number, "1e3") == 1000.0
    assert one(spark, S.safe_int, "12.9") == 12
    assert one(spark, S.safe_int, "-12.9") == -12
    assert one(spark, S.safe_int, "12.0") == 12
    assert one(spark, S.safe_int, "") is None


def test_first_nonempty_and_months(spark):
    df = spark.createDataFrame([(None, "  ", " x ")], "a string, b string, c string")
    assert df.select(S.first_nonempty("a", "b", "c").alias("r")).first()["r"] == "x"
    assert df.select(S.first_nonempty("a", "b").alias("r")).first()["r"] == ""
    assert one(spark, S.month_number, " March ") == 3
    assert one(spark, S.month_number, "Marchy") is None
    df = spark.createDataFrame([(2024, " March ")], "y int, m string")
    assert df.select(S.month_key("y", "m").alias("k")).first()["k"] == "2024march"
    y, m = S.split_month_key(F.lit("2024march"))
    r = spark.range(1).select(y.alias("y"), m.alias("m")).first()
    assert (r["y"], r["m"]) == (2024, "march")


def test_created_year(spark):
    for text, year in [("2016-05-02T00:00:00Z", 2016), ("2019-01-01", 2019),
                       ("2020-02-03T04:05:06.789Z", 2020), ("garbage", None), ("", None), (None, None)]:
        assert one(spark, S.created_year, text) == year


def test_pct_round_status_bands(spark):
    df = spark.createDataFrame([(75.0, 100.0), (1.0, 0.0), (1.0, 3.0)], "a double, b double")
    got = [r[0] for r in df.select(S.guarded_pct("a", "b")).collect()]
    assert got == [75.0, 0.0, 33.33]
    assert spark.range(1).select(S.round_dp(F.lit(2.675), 2)).first()[0] == 2.68
    st = spark.createDataFrame([(True, 1), (True, 600), (True, None), (False, 3)], "h boolean, r bigint")
    assert [r[0] for r in st.select(S.panel_status("h", "r", 500)).collect()] == [
        "active_top500", "active_not_top500", "active_unranked", "inactive"]
    b = spark.createDataFrame([(0,), (499,), (500,), (9_999,), (19_999,), (20_000,)], "o bigint")
    assert [r[0] for r in b.select(S.rank_band("o")).collect()] == [0, 0, 1, 3, 4, 5]
