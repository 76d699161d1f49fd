"""Filters, lookups and charges on invented edge rows."""

from collections import Counter

from pyspark.sql import functions as F

from fixtures import at, frame, money, random_rows
from shipreport.operators import charges, filters, lookups, stacking

KEYS = ["invoice_no", "temp_seq", "station"]


def column(df, name):
    return sorted((r[name] for r in df.select(name).collect()), key=str)


def test_eligible_invoices(spark):
    good = dict(invoice_no="I1", station="S", product_line="AMS", id_type="H", mode="AE", customer_id=1,
                invoice_date=at("2024-03-05"))
    rows = [
        good | {"source_id": 1},
        good | {"source_id": 2, "invoice_no": None}, good | {"source_id": 3, "invoice_no": "  "},
        good | {"source_id": 4, "invoice_no": "I1C"}, good | {"source_id": 5, "invoice_no": "I1c"},
        good | {"source_id": 6, "invoice_no": "I1C "},
        good | {"source_id": 7, "ref_invoice_no": "  "}, good | {"source_id": 8, "ref_invoice_no": "R"},
        good | {"source_id": 9, "customer_id": 2}, good | {"source_id": 10, "customer_id": None},
        good | {"source_id": 11, "product_line": "ams ", "mode": "ae", "id_type": "h"},
        good | {"source_id": 12, "product_line": "OMS"}, good | {"source_id": 13, "mode": "OE"},
        good | {"source_id": 14, "id_type": None},
        good | {"source_id": 15, "invoice_date": at("2024-03-01")},
        good | {"source_id": 16, "invoice_date": at("2024-03-31")},
        good | {"source_id": 17, "invoice_date": at("2024-03-31T08:30:00")},
        good | {"source_id": 18, "invoice_date": at("2024-02-29T23:59:59")},
    ]
    df = frame(spark, "invoice_header", rows)

    def found(**kw):
        return column(filters.eligible_invoices(
            df, ["AMS"], ["AE"], [1], at("2024-03-01"), at("2024-03-31"), **kw), "source_id")

    assert found() == sorted([1, 6, 7, 11, 15, 16], key=str)
    assert found(ignore_case=False) == sorted([1, 5, 6, 7, 15, 16], key=str)


def test_not_void_drops_null(spark):
    rows = [dict(house_no=s, status=s) for s in ("VOID", "void ", None, "OPEN", "")]
    df = frame(spark, "house_bill", rows)
    assert column(df.where(filters.not_void("status")), "house_no") == ["", "OPEN"]


def test_etd_window_takes_whole_days(spark):
    import datetime as dt

    df = spark.createDataFrame([(at(t),) for t in (
        "2024-01-13T23:59:59", "2024-01-14", "2024-01-20T23:59:59.999", "2024-01-21")], "etd timestamp_ntz")
    got = filters.etd_window(df, "etd", dt.date(2024, 1, 14), dt.date(2024, 1, 20))
    assert column(got, "etd") == [at("2024-01-14"), at("2024-01-20T23:59:59.999")]


def test_latest_booking(spark):
    df = frame(spark, "carrier_booking", [
        dict(master_id=1, station="S", etd=at("2024-01-02"), eta=at("2024-01-03"), flight="B"),
        dict(master_id=1, station="S", etd=at("2024-01-02"), eta=None, flight="C"),
        dict(master_id=1, station="S", etd=at("2024-01-01"), eta=at("2024-01-09"), flight="Z"),
        dict(master_id=2, station="S", etd=None, eta=None, flight="A"),
        dict(master_id=3, station="S", etd=None, eta=None, flight="Z"),
        dict(master_id=3, station="S", etd=at("2020-01-01"), eta=None, flight=None)])
    got = lookups.latest_by(df, ["master_id"], "etd", ["flight"], greatest=["eta"])
    assert {r["master_id"]: tuple(r)[1:] for r in got.collect()} == {
        1: (at("2024-01-02"), "C", at("2024-01-09")), 2: (None, "A", None), 3: (at("2020-01-01"), None, None)}


def test_latest_as_aggregate_and_as_window(spark):
    df = frame(spark, "carrier_booking", random_rows(11)["booking_AE"])
    keys = ["master_id", "station"]
    one = lookups.latest_by(df, keys, "etd", ["flight"])
    two = lookups.top1(df, keys, "etd", ["flight"]).select(*keys, "etd", "flight")
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, two.collect()))


def test_milestones(spark):
    rows = [
        dict(id=1, key="H", milestone_id=500, product_line=2, status=1, time=at("2024-01-05")),
        dict(id=2, key="H", milestone_id=500, product_line=2, status=1, time=at("2024-01-03")),
        dict(id=3, key="H", milestone_id=500, product_line=3, status=1, time=at("2024-01-09")),
        dict(id=4, key="H", milestone_id=500, product_line=2, status=0, time=at("2024-01-08")),
        dict(id=5, key="H", milestone_id=3000, product_line=2, status=1, time=at("2024-01-07")),
        dict(id=6, key="J", milestone_id=2970, product_line=2, status=1, time=at("2024-02-07")),
        dict(id=7, key="J", milestone_id=3000, product_line=2, status=1, time=at("2024-02-08")),
        dict(id=8, key="K", milestone_id=9, product_line=2, status=1, time=at("2024-02-08"))]
    df = frame(spark, "milestone", rows)
    wanted = {"shipped": 500, "delivered": 2970, "arrived": 3000}
    newest = {r["key"]: r["shipped"] for r in lookups.latest_milestones(df, wanted).collect()}
    assert newest == {"H": at("2024-01-08"), "J": None}
    found = lookups.any_milestones(df, wanted, 2, 1).withColumn(
        "day", lookups.first_of(F.col("delivered"), F.col("arrived")))
    assert {r["key"]: (r["shipped"], r["day"]) for r in found.collect()} == {
        "H": (at("2024-01-03"), at("2024-01-07")), "J": (None, at("2024-02-07"))}


def charge_rows():
    return [
        dict(invoice_no="I1", temp_seq=1, station="S", charge_id=13, amount=money(10), local_equiv=money(1)),
        dict(invoice_no="I1", temp_seq=1, station="S", charge_id=13, amount=money(5), local_equiv=None),
        dict(invoice_no="I1", temp_seq=2, station="S", charge_id=13, amount=money(100)),
        dict(invoice_no="I1", temp_seq=1, station="S", charge_id=5, amount=money(7), currency="USD"),
        dict(invoice_no="I1", temp_seq=1, station="S", charge_id=500, amount=money(9), currency="SGD"),
        dict(invoice_no="I2", temp_seq=1, station="S", charge_id=13, amount=None),
        dict(invoice_no="I3", temp_seq=1, station="T", charge_id=14, amount=money(3))]


def test_charge_pivot(spark):
    lines = frame(spark, "invoice_line", charge_rows())
    columns = {"freight": ("amount", [13]), "freight_local": ("local_equiv", [13]), "handling": ("amount", [5]),
               "other": ("amount", [14, 5])}
    got = charges.charge_pivot(lines, ["invoice_no", "station"], columns)
    assert {r["invoice_no"]: tuple(r)[2:] for r in got.collect()} == {
        "I1": (money(115), money(1), money(7), money(7)), "I2": (None, None, None, None),
        "I3": (None, None, None, money(3))}
    by_seq = charges.charge_pivot(lines, KEYS, columns)
    assert {(r["invoice_no"], r["temp_seq"]): r["freight"] for r in by_seq.collect()} == {
        ("I1", 1): money(15), ("I1", 2): money(100), ("I2", 1): None, ("I3", 1): None}


def test_cached_charges_repeat_lines_per_header(spark):
    lines = frame(spark, "invoice_line", charge_rows())
    headers = frame(spark, "invoice_header", [
        dict(source_id=1, invoice_no="I1", temp_seq=1, station="S"),
        dict(source_id=2, invoice_no="I1", temp_seq=1, station="S"),
        dict(source_id=3, invoice_no="I1", temp_seq=2, station="S"),
        dict(source_id=4, invoice_no="I9", temp_seq=1, station="S"),
        dict(source_id=5, invoice_no="I2", temp_seq=None, station="S")])
    columns = {"freight": ("amount", [13]), "handling": ("amount", [5])}
    got = charges.cached_charges(headers, lines, KEYS, columns, least={"currency": "currency"})
    want = charges.invoice_lines(headers.select(*KEYS), lines, KEYS).groupBy(*KEYS).agg(
        *[F.sum(F.when(F.col("charge_id").isin(c), F.col("amount"))).alias(n) for n, (_, c) in columns.items()],
        F.min("currency").alias("currency"))
    found = {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()}
    assert found == {("I1", 1, "S"): (money(30), money(14), "SGD"), ("I1", 2, "S"): (money(100), None, None)}
    paired = {tuple(r)[:3]: tuple(r)[3:] for r in want.collect()}
    assert all(paired[k] == v for k, v in found.items())
    assert all(v == (None, None, None) for k, v in paired.items() if k not in found)


def test_each_charge_column_adds_up_to_its_lines(spark):
    lines = frame(spark, "invoice_line", random_rows(12)["invoice_line"])
    pivot = charges.charge_pivot(lines, KEYS, {"a": ("amount", [13]), "b": ("amount", [12, 21])})
    got = pivot.agg(F.sum("a"), F.sum("b")).first()
    want = lines.agg(F.sum(F.expr("CASE WHEN charge_id = 13 THEN amount END")),
                     F.sum(F.expr("CASE WHEN charge_id IN (12, 21) THEN amount END"))).first()
    assert tuple(got) == tuple(want)


def test_unions_of_modes(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,)], "x int")
    every = stacking.union_modes({"AE": a, "AI": b}, distinct=False)
    once = stacking.union_modes({"AE": a, "AI": b}, distinct=True)
    assert sorted(map(tuple, every.collect())) == [(1, "AE"), (1, "AE"), (1, "AI"), (2, "AE")]
    assert sorted(map(tuple, once.collect())) == [(1, "AE"), (1, "AI"), (2, "AE")]
    assert sorted(map(tuple, every.distinct().collect())) == sorted(map(tuple, once.collect()))
