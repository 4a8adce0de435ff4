"""Column helpers for price text, percentages and labels.

Every helper is a built-in JVM expression, so it stays inside whole-stage
codegen; nothing in the package needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PRICE = "decimal(12,2)"
PERCENT = "decimal(18,2)"


def not_blank(name: str) -> Column:
    """True when the text column holds something other than ''."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def try_price(name: str, precision: int = 12) -> Column:
    """Price text to decimal(precision, 2); unreadable text gives NULL."""
    return F.col(name).try_cast(f"decimal({precision},2)")


def whole_number(value: Column) -> Column:
    """Round half up to an integer, as a number conversion without a scale does."""
    return value.try_cast("decimal(38,0)")


def percent_off(price: Column, base: Column) -> Column:
    """Discount of `price` against `base` in percent; NULL for a missing or zero base.

    The ratio goes through double and decimal(24,6) before it is rounded, so
    that the two-digit result does not hang on the engine's decimal division.
    """
    ratio = price.cast("double") / F.nullif(base.cast("double"), F.lit(0.0))
    return F.round(((ratio - 1) * -100).cast("decimal(24,6)"), 2).cast(PERCENT)


def rounded_mean(total: Column, count: Column) -> Column:
    """`total / count` to two digits; NULL when there is nothing to average."""
    ratio = total.cast("double") / F.nullif(count.cast("double"), F.lit(0.0))
    return F.round(ratio.cast("decimal(24,6)"), 2).cast(PERCENT)


def null_if_not_above(original: Column, current: Column) -> Column:
    """A claimed price that is not above the selling price is no claim at all."""
    return F.when(original <= current, None).otherwise(original)


def strict_least(left: Column, right: Column) -> Column:
    """The smaller value, but NULL as soon as either side is NULL."""
    return F.when(left.isNotNull() & right.isNotNull(), F.least(left, right))


def text_or_null_word(name: str) -> Column:
    """Blank or missing text becomes the word 'null' that published documents use."""
    value = F.col(name).cast("string")
    return F.when(value.isNull() | (F.trim(value) == ""), "null").otherwise(value)


def plain_price_text(name: str) -> Column:
    """1240.00 as '1240', 99.50 as '99.50', a missing price as ''."""
    return F.coalesce(F.replace(F.col(name).cast("string"), F.lit(".00"), F.lit("")), F.lit(""))


def shop_domain(name: str = "shop") -> Column:
    """Shop label to web domain.

    In the LIKE patterns `_` stands for any one character, so a name such as
    'abcz' counts as already ending in a country code and is left alone.
    """
    shop = F.col(name)
    return (
        F.when(shop.like("%_cz"), F.replace(shop, F.lit("_cz"), F.lit(".cz")))
        .when(shop.like("%.cz"), shop)
        .when(shop.like("%_sk"), F.replace(shop, F.lit("_sk"), F.lit(".sk")))
        .when(shop.like("%.sk"), shop)
        .otherwise(F.concat(shop, F.lit(".cz")))
    )
