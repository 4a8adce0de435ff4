import datetime
import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricewatch.functions.frames import tune  # noqa: E402

SF = "/root/testdata/sf0.001"
UNIFIED_SCHEMA = (
    "shop string, p_key string, itemId string, itemName string, itemUrl string, slug string, "
    "currentPrice decimal(12,2), originalPrice decimal(12,2), officialSale decimal(18,2), "
    "itemImage string, date date, inStock string, _timestamp timestamp_ntz"
)
COMPLETE_SCHEMA = (
    UNIFIED_SCHEMA
    + ", commonPrice decimal(12,2), minPrice decimal(12,2), originalPriceHS decimal(12,2), newSale decimal(18,2)"
)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("pricewatch-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    tune(session)
    yield session
    session.stop()


def day(text):
    return datetime.date.fromisoformat(text)


def price(value):
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


def unified_row(item, on, current, original=None, shop="alfa_cz", slug=None, loaded=None, **changes):
    on = day(on) if isinstance(on, str) else on
    row = {
        "shop": shop,
        "p_key": f"key-{item}",
        "itemId": item,
        "itemName": f"Item {item}",
        "itemUrl": f"u/{item}",
        "slug": f"p-{item}" if slug is None else slug,
        "currentPrice": price(current),
        "originalPrice": price(original),
        "officialSale": None,
        "itemImage": "img",
        "date": on,
        "inStock": "true",
        "_timestamp": loaded or datetime.datetime.combine(on, datetime.time(23)),
    }
    row.update(changes)
    return row


def unified(spark, rows):
    return spark.createDataFrame(rows, UNIFIED_SCHEMA)


def completed(spark, rows):
    extra = {"commonPrice": None, "minPrice": None, "originalPriceHS": None, "newSale": None}
    return spark.createDataFrame([{**extra, **r} for r in rows], COMPLETE_SCHEMA)
