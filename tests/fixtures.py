"""Invented rows in the canonical schemas."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.pandas.types import to_arrow_schema

from shipreport.sources.schemas import SCHEMAS

STATION_TABLES = {
    "invoice_header": "invoice_header", "invoice_line": "invoice_line", "house_AE": "house_bill",
    "house_AI": "house_bill", "house_3A": "house_bill", "booking_AE": "carrier_booking",
    "booking_AI": "carrier_booking", "master_AE": "master_bill", "master_AI": "master_bill",
    "customer": "customer", "city": "city", "airport": "airport", "country": "country",
    "milestone": "milestone", "ocean_bill": "ocean_bill",
}


def frame(spark, schema: str, rows: list[dict]):
    """Rows of a canonical schema; columns not given are NULL."""
    struct = SCHEMAS[schema]
    unknown = {k for r in rows for k in r} - set(struct.names)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(r.get(n) for n in struct.names) for r in rows], struct)


def tables(spark, rows: dict[str, list[dict]]):
    return {name: frame(spark, schema, rows.get(name, [])) for name, schema in STATION_TABLES.items()}


def parquet_tables(spark, rows: dict[str, list[dict]], folder):
    """As ``tables``, but read from Parquet files, as another engine can as well."""
    out = {}
    for name, schema in STATION_TABLES.items():
        struct = to_arrow_schema(SCHEMAS[schema])
        path = f"{folder}/{name}.parquet"
        pq.write_table(pa.Table.from_pylist(rows.get(name, []), schema=struct), path)
        out[name] = spark.read.parquet(path)
    return out


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def money(value) -> Decimal:
    return Decimal(value).quantize(Decimal("0.01"))


def random_rows(seed: int, size: int = 120, hot: float = 0.35) -> dict[str, list[dict]]:
    """Tables full of edge cases in which single keys hold about a third of the rows."""
    rng = random.Random(seed)

    def pick(values, hot_value=None):
        return hot_value if hot_value is not None and rng.random() < hot else rng.choice(values)

    def when(nullable=True):
        if nullable and rng.random() < 0.15:
            return None
        return at("2024-03-01") + dt.timedelta(hours=rng.randrange(24 * 20), minutes=rng.choice([0, 0, 7, 45]))

    stations = ["S1", "S2"]
    ids = list(range(1, 25))
    numbers = [f"I{i}" for i in range(1, 30)] + ["I4C", "", "  ", None]
    header = [dict(
        source_id=pick(ids, 3), station=pick(stations, "S1"), invoice_no=pick(numbers, "I7"),
        temp_seq=rng.choice([1, 1, 1, 2, None]), invoice_date=when(), amount=money(rng.randrange(9999) / 7),
        lot=rng.choice(["L1", "L2", None]), mode=rng.choice(["AE", "AI", "3A", "OE"]),
        product_line=rng.choice(["AMS", "AMS", "3PS", "OMS"]), id_type=rng.choice(["H", "H", "H", "M"]),
        ref_invoice_no=rng.choice([None, None, "", " ", "R1"]), customer_id=pick([1, 2, 3, 4, None], 1),
        bill_to=pick([1, 2, 3, None], 2)) for _ in range(size)]
    line = [dict(
        invoice_no=pick(numbers, "I7"), temp_seq=rng.choice([1, 1, 1, 2, None]), station=pick(stations, "S1"),
        charge_id=rng.choice([13, 14, 15, 380, 5, 12, 21, 400, 113, 1, 500, None]),
        amount=rng.choice([None, money(rng.randrange(99999) / 9)]), currency=rng.choice(["SGD", "USD", None]),
        local_equiv=rng.choice([None, money(rng.randrange(99999) / 9)]),
        rate=Decimal(rng.randrange(1, 2000000)) / 1000000) for _ in range(3 * size)]

    def house(mode):
        booked = mode != "3A"
        return dict(
            id=pick(ids, 3), station=pick(stations, "S1"), house_no=pick([f"H{i}" for i in range(12)] + [None], "H3"),
            master_id=pick([*range(6), None], 2) if booked else None,
            master_no=None if booked else rng.choice(["M1", None]), status=rng.choice(["OPEN", "DONE", "VOID", None]),
            customer_id=pick([1, 2, 3, 4, None], 1), shipper_id=pick([1, 2, 3, 9, None], 2),
            consignee_id=pick([1, 2, 3, 9, None], 2), pcs=rng.choice([None, 0, 4, 17]),
            pcs_uom=rng.choice(["PLT", "CTN", "PCS", None]),
            sp_unit=rng.choice([0, 3, None]) if booked else None, sp_unit_uom=rng.choice(["CTN", None]) if booked else None,
            gross_wt=money(rng.randrange(999) / 3), volume_wt=None, charge_wt=money(rng.randrange(999) / 3),
            trade_term=rng.choice(["FOB", None]), flight=None if booked else rng.choice(["SQ12", "X", None]),
            origin_city=pick([1, 2, 3, None], 1), dest_city=pick([1, 2, 3, 8], 2), receipt_city=pick([1, 2, 8], 1),
            delivery_city=pick([1, 2, 3, None], 3), origin_airport=rng.choice([1, 2, None]),
            dest_airport=rng.choice([1, 2, 8]))

    def booking():
        return dict(master_id=pick(range(6), 2), station=pick(stations, "S1"), etd=when(), eta=when(),
                    flight=rng.choice(["SQ12", "MH7", "T", None]))

    def master(station, i):
        return dict(id=i, station=station, master_no=f"{station}-{i}")

    return {
        "invoice_header": header, "invoice_line": line,
        "house_AE": [house("AE") for _ in range(size)], "house_AI": [house("AI") for _ in range(size)],
        "house_3A": [house("3A") for _ in range(size)],
        "booking_AE": [booking() for _ in range(size)], "booking_AI": [booking() for _ in range(size)],
        "master_AE": [master(s, i) for s in stations for i in range(5)],
        "master_AI": [master(s, i) for s in stations for i in range(1, 6)],
        "customer": [dict(customer_id=i, code=f"CODE{i}", name=f"Name {i}", address1=f"Road {i}",
                          address2=None if i == 3 else f"Unit {i}", country_id=i if i < 3 else None)
                     for i in (1, 2, 3, 4)],
        "city": [dict(id=i, code=f"SG{i}AB", name=f"City {i}") for i in (1, 2, 3)],
        "airport": [dict(id=i, code=f"AP{i}") for i in (1, 2)],
        "country": [dict(id=i, name=f"Country {i}") for i in (1, 2)],
        "milestone": [dict(id=i, key=pick([f"H{j}" for j in range(12)], "H3"), product_line=rng.choice([2, 2, 3]),
                           milestone_id=rng.choice([1100, 1300, 500, 2970, 3000, 7]), status=rng.choice([1, 1, 0]),
                           time=when()) for i in range(2 * size)],
    }
