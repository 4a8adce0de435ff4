from decimal import Decimal

from pyspark.sql import functions as F

from pricewatch.functions.frames import first_per_group, newest
from pricewatch.functions.prices import (
    percent_off,
    plain_price_text,
    shop_domain,
    strict_least,
    text_or_null_word,
    try_price,
    whole_number,
)


def values(df):
    return [r[0] for r in df.collect()]


def test_shop_domain(spark):
    names = ["alfa_cz", "beta.cz", "gama_sk", "delta.sk", "omega", "abcz", "cz"]
    df = spark.createDataFrame([(n,) for n in names], "shop string")
    assert values(df.select(shop_domain())) == [
        "alfa.cz", "beta.cz", "gama.sk", "delta.sk", "omega.cz", "abcz", "cz.cz",
    ]


def test_price_text_is_read_leniently(spark):
    df = spark.createDataFrame([("abc",), (" 5 ",), ("12.345",), ("",)], "p string")
    assert values(df.select(try_price("p"))) == [None, Decimal("5.00"), Decimal("12.35"), None]
    assert values(df.select(whole_number(F.col("p")))) == [None, Decimal(5), Decimal(12), None]


def test_percent_off(spark):
    df = spark.createDataFrame(
        [("99.50", "149.40"), ("100", "0"), ("100", None), ("50", "100")], "c string, o string"
    )
    whole = percent_off(whole_number(F.col("c")), whole_number(F.col("o")))
    assert values(df.select(whole)) == [Decimal("32.89"), None, None, Decimal("50.00")]


def test_rounding_goes_through_decimals(spark):
    df = spark.range(1).select(F.round(F.lit(0.285).cast("decimal(24,6)"), 2))
    assert values(df) == [Decimal("0.29")]


def test_percent_off_of_the_widest_prices_does_not_overflow(spark):
    df = spark.sql("select cast(9999999999.99 as decimal(12,2)) c, cast(0.01 as decimal(12,2)) o")
    assert values(df.select(percent_off(F.col("c"), F.col("o"))))[0] < 0


def test_strict_least(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (None, 2)], "a int, b int")
    assert values(df.select(strict_least(F.col("a"), F.col("b")))) == [1, None, None]


def test_texts(spark):
    df = spark.sql("select cast(1240 as decimal(20,2)) p union all select 99.50 union all select null")
    assert values(df.select(plain_price_text("p"))) == ["1240", "99.50", ""]
    df = spark.createDataFrame([(" ",), (None,), ("x",)], "t string")
    assert values(df.select(text_or_null_word("t"))) == ["null", "null", "x"]


def test_first_per_group(spark):
    df = spark.sql("select * from values ('a', date'2024-01-01', 1), ('a', date'2024-01-03', 2), ('b', null, 3) t(k, d, v)")
    got = first_per_group(df, ["k"], [newest("d")]).collect()
    assert {r["k"]: r["v"] for r in got} == {"a": 2, "b": 3}
