import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricewatch.operators import refprice
from tests.conftest import day, price, unified, unified_row

AS_OF = day("2024-03-31")
START = day("2024-02-01")


def series(item, changes, first_claim=None, start=START, end=AS_OF):
    """Daily rows from `start`: price 100 until the first change; a claim from `first_claim` on."""
    rows, current = [], 100
    on = start
    while on <= end:
        current = changes.get(f"{on:%m-%d}", current)
        claim = 500 if first_claim and f"{on:%m-%d}" >= first_claim else None
        rows.append(unified_row(item, on, current, claim))
        on += datetime.timedelta(1)
    return rows


FIXTURES = {
    # id: (changes, first claim, valid day and lowest price: strict, then skip)
    "F1": ({"03-11": 80}, None, ("03-11", 100), ("03-11", 100)),
    "F2": ({"03-11": 80, "03-15": 60}, None, ("03-15", 80), ("03-11", 100)),
    "F3": ({"03-11": 80, "03-15": 60}, "03-11", ("03-11", 100), ("03-11", 100)),
    "F4": ({"03-11": 80, "03-15": 60}, "03-15", ("03-15", 80), ("03-15", 80)),
    "F5": ({"03-11": 80, "03-15": 90, "03-20": 70}, None, ("03-20", 80), ("03-20", 80)),
    "F6": ({"03-11": 80, "03-15": 90}, None, ("03-15", None), ("03-15", None)),
}


@pytest.mark.parametrize("null_break,column", [("strict", 2), ("skip", 3)])
def test_worked_examples(spark, null_break, column):
    rows = [r for name, (changes, claim, *_) in FIXTURES.items() for r in series(name, changes, claim)]
    frame = unified(spark, rows)
    runs = refprice.price_runs(frame, AS_OF, 30)
    changes = refprice.price_changes(runs, F.date_sub(F.lit(AS_OF), 30))
    valid = {r["itemId"]: r for r in refprice.last_valid_change(changes, null_break=null_break).collect()}
    refs = {
        r["itemId"]: r["minPrice"]
        for r in refprice.ref_prices(frame, AS_OF, 30, 30, null_break=null_break).collect()
    }
    for name, fixture in FIXTURES.items():
        on, lowest = fixture[column]
        assert f"{valid[name]['date']:%m-%d}" == on, name
        assert refs[name] == price(lowest), name


def test_gaps_carry_the_last_price(spark):
    rows = [unified_row("F7", "2024-03-01", 100)] + [
        unified_row("F7", day("2024-03-11") + datetime.timedelta(i), 80) for i in range(21)
    ]
    runs = refprice.price_runs(unified(spark, rows), AS_OF, 30)
    filled = {str(r["date"]): (r["filled_row"], r["currentPrice"]) for r in refprice.gap_fill(runs).collect()}
    assert len(filled) == 31
    assert filled["2024-03-01"] == ("1", price(100)) and filled["2024-03-05"] == ("0", price(100))
    (common,) = refprice.common_price(runs, F.date_sub(F.lit(AS_OF), 60)).collect()
    assert common["commonPrice"] == price(80)


# --- brute force over dense days, as an independent statement of the rules ---


def brute(rows, as_of, valid, common, rule, strict, oldest, history=None, points=None, cal=151, change=None, limit=None):
    one = datetime.timedelta(1)
    history = history or valid + 30
    points = points or history
    last = max(r["date"] for r in rows)
    out = {}
    for item in {r["itemId"] for r in rows}:
        own = sorted((r for r in rows if r["itemId"] == item and r["date"] >= as_of - points * one), key=lambda r: r["date"])
        first_claim = {
            b["date"] for a, b in zip(own, own[1:]) if b["originalPrice"] is not None and a["originalPrice"] is None
        }
        by_day = {r["date"]: r["currentPrice"] for r in own}
        dense, now = [], None
        for i in range(cal):
            on = last - (cal - 1 - i) * one
            now = by_day.get(on, now)
            if now is not None and on >= as_of - history * one:
                dense.append((on, now))
        counts = Counter(p for on, p in dense if common is None or on >= as_of - common * one)
        if not counts:
            continue
        best = min(p for p, n in counts.items() if n == max(counts.values()))
        moves = [(b[0], "up" if b[1] > a[1] else "down") for a, b in zip(dense, dense[1:]) if a[1] != b[1]]
        if change is not None:
            moves = [m for m in moves if m[0] >= as_of - change * one]
        moves = moves[::-1]  # newest first: row number n is moves[n - 1]
        pick = None
        if moves:
            ups = [n for n, m in enumerate(moves, 1) if m[1] == "up"]
            since = [n for n in range(1, len(moves) + 1) if not ups or n < min(ups)]
            flagged = [n for n in since if moves[n - 1][0] in first_claim]
            last_row = max(since) + 1 if since else None
            claim_row = (max(flagged) if oldest else min(flagged)) + 1 if flagged else None
            if rule == "since_up":
                known = [x for x in (last_row, claim_row) if x is not None]
                brk = None if not known or (strict and len(known) < 2) else min(known)
            elif rule == "gradual_v2":
                brk = min(ups) if ups else len(moves) + 1
            else:
                brk = None
            rows_left = [n for n in range(1, len(moves) + 1) if n == 1 or (brk and n == brk - 1)]
            if limit is not None:
                rows_left = [n for n in rows_left if moves[n - 1][0] >= as_of - limit * one]
            if rows_left:
                pick = moves[max(rows_left) - 1]
        lowest = None
        if pick and pick[1] == "down":
            before = [p for on, p in dense if pick[0] - 30 * one <= on < pick[0]]
            lowest = min(before) if before else None
        out[item] = (best, lowest)
    return out


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(7)
    rows = []
    for i in range(120):
        on = day("2023-09-20") + datetime.timedelta(rng.randrange(150))
        density = rng.choice([0.15, 0.5, 0.95])
        current = rng.randrange(50, 60)
        while on <= AS_OF:
            if rng.random() < density:
                if rng.random() < 0.3:
                    current = max(1, current + rng.choice([-3, -2, -1, 1, 2]))
                claim = current + 10 if rng.random() < 0.4 else None
                rows.append(unified_row(f"i{i}", on, current, claim))
            on += datetime.timedelta(1)
    return rows


OPTIONS = [
    dict(rule="since_up", strict=True, oldest=False),
    dict(rule="since_up", strict=False, oldest=False),
    dict(rule="since_up", strict=True, oldest=True),
    dict(rule="since_up", strict=False, oldest=True),
    dict(rule="gradual_v2", strict=True, oldest=False),
    dict(rule="gradual_v2", strict=True, oldest=False, change=None, limit=30, history=60, points=90, cal=91),
    dict(rule="last_change", strict=True, oldest=False, change=None, limit=30, history=60, points=90, cal=91),
    dict(rule="since_up", strict=False, oldest=False, cal=40),
]


@pytest.mark.parametrize("options", OPTIONS)
def test_against_brute_force(spark, random_rows, options):
    options = {"change": 60, **options}
    expected = brute(random_rows, AS_OF, 60, 45, **options)
    got = refprice.ref_prices(
        unified(spark, random_rows),
        AS_OF,
        60,
        45,
        rule=options["rule"],
        null_break="strict" if options["strict"] else "skip",
        orig_break="max" if options["oldest"] else "min",
        change_days=options["change"],
        limit_days=options.get("limit"),
        history_days=options.get("history"),
        points_days=options.get("points"),
        calendar_days=options.get("cal", 151),
    ).collect()
    assert {r["itemId"]: (r["commonPrice"], r["minPrice"]) for r in got} == expected


def test_single_steps_agree_with_the_whole(spark, random_rows):
    frame = unified(spark, random_rows)
    runs = refprice.price_runs(frame, AS_OF, 60)
    since = F.date_sub(F.lit(AS_OF), 60)
    valid = refprice.last_valid_change(refprice.price_changes(runs, since))
    lowest = {r["itemId"]: r["min_currentPrice"] for r in refprice.min_price_before_sale(valid).collect()}
    common = {r["itemId"]: r["commonPrice"] for r in refprice.common_price(runs, F.date_sub(F.lit(AS_OF), 45)).collect()}
    for r in refprice.ref_prices(frame, AS_OF, 60, 45).collect():
        assert r["commonPrice"] == common[r["itemId"]]
        assert r["minPrice"] == lowest.get(r["itemId"])


def test_every_filled_day_lies_in_the_items_span(spark, random_rows):
    runs = refprice.price_runs(unified(spark, random_rows), AS_OF, 60)
    first = {}
    for r in random_rows:
        first[r["itemId"]] = min(first.get(r["itemId"], r["date"]), r["date"])
    for r in refprice.fill_days(runs).collect():
        assert first[r["itemId"]] <= r["date"] <= AS_OF


def test_shops_have_their_own_calendar(spark):
    rows = [unified_row("a", "2024-03-01", 100, shop="x"), unified_row("a", "2024-03-31", 90, shop="y")]
    frame = unified(spark, rows)
    runs = refprice.price_runs(frame, AS_OF, 60, keys=("shop", "itemId"), by=("shop",))
    assert {r["shop"]: str(r["run_end"]) for r in runs.collect()} == {"x": "2024-03-01", "y": "2024-03-31"}
    with pytest.raises(ValueError):
        refprice.price_runs(frame, AS_OF, 60, by=("shop",))


def test_unknown_rule_is_refused(spark):
    with pytest.raises(ValueError):
        refprice.ref_prices(unified(spark, [unified_row("a", AS_OF, 1)]), AS_OF, rule="none")


def test_long_validity_reaches_beyond_the_default_calendar(spark):
    last = datetime.date(2024, 12, 31)
    rows = [unified_row("old", last - datetime.timedelta(days=160), 200), unified_row("new", last, 10)]
    got = {r["itemId"]: r["commonPrice"] for r in refprice.ref_prices(unified(spark, rows), last, 200, 200).collect()}
    assert got["old"] == price(200) and got["new"] == price(10)


def test_silent_items_do_not_come_back(spark):
    last = datetime.date(2024, 12, 31)
    rows = [unified_row("silent", last - datetime.timedelta(days=70), 200), unified_row("seen", last - datetime.timedelta(days=70), 50)]
    rows += [unified_row("seen", last, None), unified_row("new", last, 10)]
    got = refprice.ref_prices(unified(spark, rows), last, 30, None, rule="last_change", history_days=60, points_days=90)
    assert {r["itemId"] for r in got.collect()} == {"seen", "new"}
