"""All-mode invoice report: one wide row per invoice of one customer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipreport.functions.dates import day_of
from shipreport.functions.text import code_eq, join_text, not_blank, pieces_by_unit
from shipreport.operators.charges import charge_pivot
from shipreport.operators.filters import date_range
from shipreport.operators.joins import (
    Probe, attach, fan_out, filter_by_code, thinned, with_country, with_roles)
from shipreport.operators.lookups import any_milestones, first_of
from shipreport.plans.common import SHIPMENT, houses_of, with_join_keys
from shipreport.plans.modes import AIR_MODES, Mode, same_case
from shipreport.sources.contracts import to_strings, with_constants
from shipreport.sources.reuse import holding, shared
from shipreport.sources.stations import Stations

# Result columns in order, one per line.
COLUMNS: tuple[str, ...] = tuple("""
CarrierID
ClientID
InvoiceType
Invoice Number
Invoice Total
Invoice Date
Shipment Number
Ship Date
Bill To Account
Weight Unit
Billed Weight
Actual Weight
DIM Weight
Volume
PCS
Rejected Pieces
Package Type
Loading meters
Service Type
Service Zone
Direction
Mode
Payment Terms
Inco terms
Distance qualifier
Distance
Bill Of Lading
MAWB
HAWB
PO Number
Reference number
Delivery Date
Delivery Time
POD Name
Notes1 (Pallets)
Notes2 (Cartons)
Notes3
Notes4
Notes5
Notes6
Notes7
Notes8
Notes9
Notes10
Notes11
Notes12
Notes13
Notes14
Notes15
Notes16
Origin(Air)Port
Destination (Air)Port
Shipper Location
Shipper Name
Shipper Company
Shipper Address1
Shipper Address2
Shipper Address3
Shipper City
Shipper state
Shipper Postcode
Shipper Country
Consignee Location
Consignee Name
Consignee Company
Consignee Address1
Consignee Address2
Consignee Address3
Consignee City
Consignee State
Consignee Postcode
Consignee Country
Amount Billed
Freight Amount - FRT
Total Shipment VAT Amount
Accessorial Charge- FSC
Accessorial Charge-FSC Amount1 - Fuel Surcharge
VAT liable flag 1
Accessorial Charge-SSC
Accessorial Charge-SSC Amount2
VAT liable flag 2
Accessorial Charge-P/U Code3
Accessorial Charge- Amount3
VAT liable flag 3
Accessorial Charge-Origin Terminal Code4
Accessorial Charge-Origin Terminal Amount4
VAT liable flag 4
Accessorial Charge-CUS Code5
Accessorial Charge-CUS Amount5
VAT liable flag 5
Accessorial Charge-Dest Terminal Code6
Accessorial Charge-dest Terminal Amount6
VAT liable flag 6
Accessorial Charge Code7
Accessorial Charge Amount7
VAT liable flag 7
Accessorial Charge Code8
Accessorial Charge Amount8
VAT liable flag 8
Accessorial Charge Code9
Accessorial Charge Amount9
VAT liable flag 9
Accessorial Charge Code10
Accessorial Charge Amount10
Accessorial 10 VAT code
Currency
Bill to Location
Bill To Company
Bill To Address1
Bill To Address2
Bill To City
Bill To State
Bill To Postcode
Bill To Country
Equipment Type
Container number
Trailer/Car ID
carrier VAT number
CLIENT VAT NUMBER
VAT percentage
Currency Exchange Rate
Overtime hours
Waiting hours
Urgent fee location count
""".strip().splitlines())

# Charge code -> columns of its amount and of its local equivalent.
CHARGES: dict[int, tuple[str, str]] = {
    13: ("Freight Amount - FRT", "Total Shipment VAT Amount"),
    14: ("Accessorial Charge-FSC Amount1 - Fuel Surcharge", "VAT liable flag 1"),
    15: ("Accessorial Charge-SSC Amount2", "VAT liable flag 2"),
    400: ("Accessorial Charge-Origin Terminal Amount4", "VAT liable flag 4"),
    5: ("Accessorial Charge-dest Terminal Amount6", "VAT liable flag 6"),
    113: ("Accessorial Charge Amount7", "VAT liable flag 7"),
    1: ("Accessorial Charge Amount8", "VAT liable flag 8"),
}
# Columns with the same text in every row.
CONSTANTS: dict[str, str] = {
    "InvoiceType": "D",
    "Weight Unit": "K",
    "Service Type": "LTL",
    "Direction": "I",
    "Mode": "Air",
    "Reference number": "Air",
    "Accessorial Charge- FSC": "FSC",
    "Accessorial Charge-SSC": "SSC",
    "Accessorial Charge-Origin Terminal Code4": "H/C",
    "Accessorial Charge-Dest Terminal Code6": "H/C",
    "Accessorial Charge Code7": "DEL",
    "Accessorial Charge Code8": "CUS",
}
# Milestones of shipping, delivery and, failing that, arrival, and the
# product line and status their rows must have.
MILESTONES = {"shipped": 500, "delivered": 2970, "arrived": 3000}
MILESTONE_LINE, MILESTONE_STATUS = 2, 1
INVOICE = ["invoice_key", "station"]
#: What the report reads of a house bill. The join that is kept holds no other columns.
BILL = ["house_no", "house_key", "customer_id", "shipper_id", "consignee_id", "receipt_city", "delivery_city",
        "origin_airport", "dest_airport", "charge_wt", "pcs", "pcs_uom"]
# Units that are counted as pallets and as cartons.
PALLET, CARTON = "PLT", "CTN"


@dataclass(frozen=True)
class Billing:
    """Whose invoices are reported, and the texts identifying the parties.

    ``texts`` holds business values of one customer by result column (CarrierID,
    ClientID, Bill To Company, ...); columns absent from it are blank.
    """

    customer_code: str
    bill_to_code: str
    texts: Mapping[str, str] = field(default_factory=dict)


def invoice_rows(tables: Mapping[str, DataFrame], billing: Billing,
                 start: dt.datetime | None = None, end: dt.datetime | None = None,
                 modes: Sequence[Mode] = AIR_MODES,
                 charges: Mapping[int, tuple[str, str]] = CHARGES,
                 ignore_case: bool = True) -> DataFrame:
    """The report on canonical tables, in native types."""
    if (start is None) != (end is None):
        raise ValueError("give both ends of the date range, or neither")
    t, modes = with_join_keys(tables, ignore_case), same_case(modes, ignore_case)
    customers = t["customer"]

    invoices = t["invoice_header"].where(
        F.col("mode").isin([m.code for m in modes]) & not_blank(F.col("invoice_no")))
    if start is not None:
        invoices = invoices.where(date_range("invoice_date", start, end))
    invoices = filter_by_code(invoices, customers, "customer_id", "bill_to",
                              code_eq(F.col("code"), billing.bill_to_code, ignore_case))
    invoices = invoices.select(*SHIPMENT, "invoice_key", "invoice_no", "invoice_date", "amount")

    bills = filter_by_code(houses_of(t, modes).select(*SHIPMENT, *BILL), customers, "customer_id", "customer_id",
                           code_eq(F.col("code"), billing.customer_code, ignore_case))
    bills = bills.drop("customer_id")
    # The selective join comes first; all that follows is attached to its rows.
    rows = survivors = shared(
        fan_out(invoices, bills, SHIPMENT, "inner", Probe(invoices, SHIPMENT), Probe(bills, SHIPMENT)))
    probe = Probe(rows, INVOICE, ["house_key"], ["shipper_id"], ["consignee_id"], ["receipt_city"],
                  ["delivery_city"], ["origin_airport"], ["dest_airport"])
    measures = {}
    for code, (amount, local) in charges.items():
        measures[amount] = ("amount", (code,))
        measures[local] = ("local_equiv", (code,))
    sums = charge_pivot(thinned(t["invoice_line"], rows, INVOICE), INVOICE, measures,
                        least={"Currency Exchange Rate": "rate"})
    history = thinned(t["milestone"].withColumnRenamed("key", "house_key"), rows, ["house_key"])
    times = any_milestones(history, MILESTONES, MILESTONE_LINE, MILESTONE_STATUS, "house_key")
    rows = attach(rows, times, ["house_key"], probe=probe)
    rows = with_roles(rows, customers, "customer_id", {"shp": "shipper_id"},
                      ["name", "address1", "address2"], probe=probe)
    rows = with_roles(rows, with_country(customers, t["country"]), "customer_id",
                      {"cnee": "consignee_id"}, ["name", "address1", "address2", "country_name"], probe=probe)
    rows = with_roles(rows, t["city"], "id",
                      {"receipt": "receipt_city", "delivery": "delivery_city"}, ["name"], probe=probe)
    rows = with_roles(rows, t["airport"], "id",
                      {"origin": "origin_airport", "dest": "dest_airport"}, ["code"], probe=probe)
    rows = attach(rows, sums, INVOICE, probe=probe)
    shipper_address = join_text(F.col("shp_address1"), F.col("shp_address2"))
    consignee_address = join_text(F.col("cnee_address1"), F.col("cnee_address2"))
    values: dict[str, Column] = {
        "Invoice Number": F.col("invoice_no"),
        "Invoice Total": F.col("amount"),
        "Invoice Date": F.col("invoice_date"),
        "Shipment Number": F.col("house_no"),
        "Ship Date": day_of(F.col("shipped")),
        "Billed Weight": F.col("charge_wt"),
        "Actual Weight": F.col("charge_wt"),
        "PCS": F.col("pcs"),
        "Package Type": F.col("pcs_uom"),
        "Delivery Date": first_of(F.col("delivered"), F.col("arrived")),
        "Notes1 (Pallets)": pieces_by_unit(F.col("pcs"), F.col("pcs_uom"), PALLET, ignore_case),
        "Notes2 (Cartons)": pieces_by_unit(F.col("pcs"), F.col("pcs_uom"), CARTON, ignore_case),
        "Notes3": F.col("house_no"),
        "Origin(Air)Port": F.col("origin_code"),
        "Destination (Air)Port": F.col("dest_code"),
        "Shipper Name": F.col("shp_name"),
        "Shipper Company": F.col("shp_name"),
        "Shipper Address1": shipper_address,
        "Shipper City": F.col("receipt_name"),
        "Shipper Country": F.col("receipt_name"),
        "Consignee Name": F.col("cnee_name"),
        "Consignee Company": F.col("cnee_name"),
        "Consignee Address1": consignee_address,
        "Consignee City": F.col("delivery_name"),
        # The address again: kept as the report has always shown it.
        "Consignee Postcode": consignee_address,
        "Consignee Country": F.col("cnee_country_name"),
        "Amount Billed": F.col("amount"),
        "Currency Exchange Rate": F.col("`Currency Exchange Rate`"),
    }
    values |= {name: F.col(f"`{name}`") for name in measures}
    texts = CONSTANTS | dict(billing.texts)
    report = with_constants(
        rows.select(*[value.alias(name) for name, value in values.items()]),
        {name: texts.get(name, "") for name in COLUMNS if name not in values})
    return holding(report.select(*[f"`{name}`" for name in COLUMNS]), survivors)


def invoice_report(spark: SparkSession, stations: Stations, station: str, billing: Billing,
                   start: dt.datetime | None = None, end: dt.datetime | None = None,
                   text: bool = True, **options) -> DataFrame:
    """The report of one station's database; all columns as text unless ``text`` is off."""
    modes = same_case(options.get("modes", AIR_MODES), options.get("ignore_case", True))
    names = ["invoice_header", "invoice_line", "milestone", "customer", "country", "city", "airport",
             *(f"house_{m.code}" for m in modes)]
    rows = invoice_rows(stations.tables(spark, station, names), billing, start, end, **options)
    return holding(to_strings(rows, COLUMNS), rows) if text else rows
