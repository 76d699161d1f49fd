"""Air weight report: one row per house bill and invoice in three modes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipreport.functions.dates import fmt_date, fmt_time
from shipreport.functions.text import code_eq, code_in, left_chars, pieces_label, right_chars
from shipreport.operators.charges import cached_charges
from shipreport.operators.filters import billable, date_range, not_void
from shipreport.operators.joins import Probe, attach, fan_out, flag_in_list, in_list, thinned, with_roles
from shipreport.operators.lookups import latest_by, latest_milestones
from shipreport.operators.stacking import stack_modes
from shipreport.plans.common import MASTER, SHIPMENT, houses_of, with_join_keys
from shipreport.plans.modes import AIR_MODES, Mode, same_case
from shipreport.sources.contracts import to_contract
from shipreport.sources.reuse import holding, shared
from shipreport.sources.stations import Stations

# Charge codes of each charge column.
CHARGES: dict[str, Sequence[int]] = {
    "Freight": (13,),
    "FSC": (14,),
    "ISS": (15,),
    "Export LHC": (380,),
    "Import LHC": (5,),
    "Other": (12, 21, 22, 73, 257, 114, 35),
}
# Milestones that stand for departure and arrival of a third-party bill.
MILESTONES = {"etd": 1100, "eta": 1300}

# Result columns in order.
TEXT, AMOUNT = "string", "decimal(18,2)"
CONTRACT: tuple[tuple[str, str], ...] = (
    ("Lot", TEXT), ("Mode", TEXT), ("Forwarder", TEXT), ("CNEE", TEXT), ("SHPR", TEXT),
    ("Master Inv No.", TEXT), ("Invoice Date", TEXT), ("Invoice no.", TEXT), ("ETDDate", TEXT),
    ("HAWB", TEXT), ("Airline", TEXT), ("FLT NO", TEXT), ("ETD", TEXT), ("ETA", TEXT),
    ("TTL PCS", TEXT), ("TTL G.W", AMOUNT), ("TTL D.W", AMOUNT), ("TTL C.W", AMOUNT),
    ("ORG Country", TEXT), ("ORG City", TEXT), ("DES Country", TEXT), ("DES City", TEXT),
    ("Trade Term", TEXT), ("Currency", TEXT), ("Freight", AMOUNT), ("FSC", AMOUNT),
    ("ISS", AMOUNT), ("PICKUP", TEXT), ("Export LHC", AMOUNT), ("Import LHC", AMOUNT),
    ("Other", AMOUNT), ("Tax", TEXT), ("Total", AMOUNT),
)

INVOICE = ["invoice_key", "temp_seq", "station"]


def with_times(rows: DataFrame, tables: Mapping[str, DataFrame], modes: Sequence[Mode], probe: Probe) -> DataFrame:
    """``rows`` of house bills with flight, times, master number and pieces.

    Bookings and milestones are thinned to the keys of ``rows`` before they are aggregated.
    """
    pieces, unit = F.col("pcs"), F.col("pcs_uom")
    parts = []
    # Modes without bookings are kept out of the master and booking joins: their empty
    # master ids would all meet in one partition.
    booked = [m.code for m in modes if m.booked]
    if booked:
        masters = stack_modes({m: tables[f"master_{m}"] for m in booked})
        bookings = stack_modes({m: tables[f"booking_{m}"] for m in booked})
        own = rows.where(F.col("mode").isin(booked)).drop("master_no", "flight")
        flights = latest_by(thinned(bookings, own, MASTER), MASTER, "etd", ["flight"], greatest=["eta"])
        own = attach(own, masters.withColumnRenamed("id", "master_id"), MASTER, probe=probe)
        own = attach(own, flights, MASTER, probe=probe)
        label = pieces_label(pieces, unit, F.col("sp_unit"), F.col("sp_unit_uom"))
        parts.append(own.withColumn("pieces", label))
    others = [m.code for m in modes if not m.booked]
    if others:
        own = rows.where(F.col("mode").isin(others))
        history = thinned(tables["milestone"].withColumnRenamed("key", "house_key"), own, ["house_key"])
        own = attach(own, latest_milestones(history, MILESTONES, "house_key"), ["house_key"], probe=probe)
        parts.append(own.withColumn("pieces", pieces_label(pieces, unit)))
    return reduce(DataFrame.unionByName, parts)


def weight_rows(tables: Mapping[str, DataFrame], start: dt.datetime, end: dt.datetime,
                customers: DataFrame | Sequence[int], forwarder: str,
                modes: Sequence[Mode] = AIR_MODES, charges: Mapping[str, Sequence[int]] = CHARGES,
                ignore_case: bool = True) -> DataFrame:
    """The report on canonical tables."""
    t, modes = with_join_keys(tables, ignore_case), same_case(modes, ignore_case)
    numbered = t["invoice_header"].where(
        date_range("invoice_date", start, end)
        & code_in(F.col("product_line"), sorted({m.product_line for m in modes}), ignore_case)
        & F.col("mode").isin([m.code for m in modes])
        & billable(ignore_case=ignore_case)
    )
    headers = flag_in_list(numbered, "customer_id", customers, "listed")

    def of_branch(m: Mode) -> Column:
        rule = (F.col("mode") == m.code) & code_eq(F.col("product_line"), m.product_line, ignore_case)
        return rule & F.col("listed") if m.listed_headers else rule

    invoices = headers.where(reduce(or_, [of_branch(m) for m in modes])).select(
        *SHIPMENT, "invoice_key", "temp_seq", "invoice_no", "invoice_date", "amount", "lot")
    bills = houses_of(t, modes)
    live = in_list(bills.where(not_void("status", ignore_case=ignore_case)), "customer_id", customers)
    # The selective join comes first; all that follows is attached to its rows.
    rows = survivors = shared(
        fan_out(invoices, live, SHIPMENT, "inner", Probe(invoices, SHIPMENT), Probe(live, SHIPMENT)))
    probe = Probe(rows, INVOICE, MASTER, ["house_key"], ["consignee_id"], ["shipper_id"],
                  ["origin_city"], ["dest_city"])
    sums = cached_charges(
        thinned(headers.where("listed"), rows, INVOICE), thinned(t["invoice_line"], rows, INVOICE), INVOICE,
        {name: ("amount", codes) for name, codes in charges.items()}, least={"Currency": "currency"})
    rows = with_times(rows, t, modes, probe)
    rows = with_roles(rows, t["customer"], "customer_id",
                      {"cnee": "consignee_id", "shpr": "shipper_id"}, ["code"], probe=probe)
    rows = with_roles(rows, t["city"], "id",
                      {"org": "origin_city", "des": "dest_city"}, ["code"], probe=probe)
    rows = attach(rows, sums, INVOICE, probe=probe)
    report = rows.select(
        F.col("lot").alias("Lot"), F.col("mode").alias("Mode"), F.lit(forwarder).alias("Forwarder"),
        F.col("cnee_code").alias("CNEE"), F.col("shpr_code").alias("SHPR"),
        F.col("master_no").alias("Master Inv No."),
        fmt_date(F.col("invoice_date")).alias("Invoice Date"), F.col("invoice_no").alias("Invoice no."),
        fmt_date(F.col("etd")).alias("ETDDate"), F.col("house_no").alias("HAWB"),
        left_chars(F.col("flight"), 2).alias("Airline"), F.col("flight").alias("FLT NO"),
        fmt_time(F.col("etd")).alias("ETD"), fmt_time(F.col("eta")).alias("ETA"),
        F.col("pieces").alias("TTL PCS"),
        F.col("gross_wt").alias("TTL G.W"), F.col("volume_wt").alias("TTL D.W"),
        F.col("charge_wt").alias("TTL C.W"),
        left_chars(F.col("org_code"), 2).alias("ORG Country"),
        right_chars(F.col("org_code"), 3).alias("ORG City"),
        left_chars(F.col("des_code"), 2).alias("DES Country"),
        right_chars(F.col("des_code"), 3).alias("DES City"),
        F.col("trade_term").alias("Trade Term"), "Currency", *charges,
        F.lit("").alias("PICKUP"), F.lit("").alias("Tax"), F.col("amount").alias("Total"),
    )
    return holding(to_contract(report.distinct(), CONTRACT), survivors)


def weight_report(spark: SparkSession, stations: Stations, station: str, start: dt.datetime,
                  end: dt.datetime, customers: DataFrame | Sequence[int], forwarder: str,
                  **options) -> DataFrame:
    """The report of one station's database."""
    modes = same_case(options.get("modes", AIR_MODES), options.get("ignore_case", True))
    names = ["invoice_header", "invoice_line", "customer", "city", *(f"house_{m.code}" for m in modes)]
    for m in modes:
        names += [f"master_{m.code}", f"booking_{m.code}"] if m.booked else ["milestone"]
    return weight_rows(stations.tables(spark, station, names), start, end, customers, forwarder, **options)
