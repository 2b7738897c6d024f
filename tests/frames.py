"""Hand-made report frames with internal column names."""

from __future__ import annotations

from datetime import date

from prodseq.sources.reports import Reports

DAY = date(2026, 1, 2)

BOR = "report_date date, sku string, description string, loc string, norm double, virtual_norm double, stock double"
BMR = "report_date date, plant string, sku string, requirement double, penetration double"
BPR = "report_date date, sku string, loc string, location_type string, colour string, top_sku string"
DISPATCH = "plant int, sku string, amount string, quantity string"
CURING = "sku string, cure_time double"
MOULD = "report_date date, sku string, machine string, mould_life double, target_life double"
MANUAL = (
    "report_date date, `SKU Code` string, `SKU Description` string, Market string,"
    " Quantity double, `Highest Priority` int, entry_no long"
)


def sku(n: int, size: str = "15") -> str:
    return f"P{n:07d}{size}XX"


def bor_row(s, loc="1300_OE10", norm=100.0, stock=0.0, day=DAY):
    return (day, s, f"Product {s}", loc, 25.0, norm, stock)


def bpr_row(s, loc="1300_OE10", place="PWH", colour="Black", top="T", day=DAY):
    return (day, s, loc, place, colour, top)


def manual_row(s, quantity=10.0, level=0, market="OE", entry=1, day=DAY):
    return (day, s, f"Manual {s}", market, quantity, level, entry)


def reports(spark, bor=(), bmr=(), bpr=(), dispatch=(), curing=(), mould=None, manual=None):
    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    return Reports(
        bor=frame(bor, BOR),
        bmr=frame(bmr, BMR),
        bpr=frame(bpr, BPR),
        dispatch=frame(dispatch, DISPATCH),
        curing=frame(curing, CURING),
        mould=None if mould is None else frame(mould, MOULD),
        manual=None if manual is None else frame(manual, MANUAL),
    )
