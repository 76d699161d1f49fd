"""Canonical table schemas and the physical tables and columns behind them.

Reports use the canonical names only. ``STATION_TABLES`` and ``MASTER_TABLES`` map them to
the tables of a station database and of the shared master database.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

_HOUSE = """id BIGINT, station STRING, house_no STRING, master_id BIGINT, master_no STRING,
    status STRING, customer_id BIGINT, shipper_id BIGINT, consignee_id BIGINT,
    pcs INT, pcs_uom STRING, sp_unit INT, sp_unit_uom STRING,
    gross_wt DECIMAL(18,2), volume_wt DECIMAL(18,2), charge_wt DECIMAL(18,2), trade_term STRING,
    flight STRING, origin_city BIGINT, dest_city BIGINT, receipt_city BIGINT, delivery_city BIGINT,
    origin_airport BIGINT, dest_airport BIGINT"""

_DDL = {
    "invoice_header": """source_id BIGINT, station STRING, invoice_no STRING, temp_seq INT,
        invoice_date TIMESTAMP_NTZ, amount DECIMAL(18,2), lot STRING, mode STRING,
        product_line STRING, id_type STRING, ref_invoice_no STRING, customer_id BIGINT,
        bill_to BIGINT""",
    "invoice_line": """invoice_no STRING, temp_seq INT, station STRING, charge_id INT,
        amount DECIMAL(18,2), currency STRING, local_equiv DECIMAL(18,2), rate DECIMAL(18,6)""",
    "house_bill": _HOUSE,
    "carrier_booking": """master_id BIGINT, station STRING, etd TIMESTAMP_NTZ,
        eta TIMESTAMP_NTZ, flight STRING""",
    "master_bill": "id BIGINT, station STRING, master_no STRING",
    "customer": """customer_id BIGINT, code STRING, name STRING, address1 STRING,
        address2 STRING, country_id BIGINT""",
    "city": "id BIGINT, code STRING, name STRING",
    "airport": "id BIGINT, code STRING",
    "country": "id BIGINT, name STRING",
    "milestone": """id BIGINT, key STRING, product_line INT, milestone_id INT, status INT,
        time TIMESTAMP_NTZ""",
    "ocean_bill": "id BIGINT, delivery_city BIGINT",
    "document": """doc_id BIGINT, house_no STRING, file_name STRING, current_type STRING,
        text STRING""",
    "document_page": "doc_id BIGINT, page_no INT, text STRING",
    "change_log": "house_no STRING, status STRING, file_name STRING, old_type STRING, new_type STRING",
}
_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(), "DECIMAL(18,2)": T.DecimalType(18, 2),
    "DECIMAL(18,6)": T.DecimalType(18, 6),
}


def _struct(ddl: str) -> T.StructType:
    """A struct from its column list; ``StructType.fromDDL`` would need a running session."""
    pairs = re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", ddl)
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}

# Physical table and column names. Canonical columns that a table does
# not hold are NULL. A name of several tables stands for one table per mode.
_BOOKED_HOUSE = {
    "id": "ID", "station": "StationID", "house_no": "HAWBNo", "master_id": "MAWBID",
    "status": "STATUS", "customer_id": "Customer", "shipper_id": "Shipper", "consignee_id": "cnee",
    "pcs": "ActPCS", "pcs_uom": "ActPCSUOM", "sp_unit": "SPUnit", "sp_unit_uom": "SPUnitUOM",
    "gross_wt": "GWT", "volume_wt": "VWT", "charge_wt": "CWT", "trade_term": "TradeTerm",
    "origin_city": "PortOfDEPT", "dest_city": "PortOfDSTN",
    "receipt_city": "PlaceOfRCPT", "delivery_city": "PortOfDSTN",
    "origin_airport": "airportofdept", "dest_airport": "airportofdstn",
}
_THIRD_PARTY_HOUSE = {
    "id": "ID", "station": "StationID", "house_no": "HouseNo", "master_no": "MasterNo",
    "status": "LotStatus", "customer_id": "CustomerID", "shipper_id": "Shipper",
    "consignee_id": "cnee", "pcs": "ActPCS", "pcs_uom": "ActPCSUOM",
    "gross_wt": "GWT", "volume_wt": "VWT", "charge_wt": "CWT", "trade_term": "TradeTerm",
    "flight": "OnboardFLT", "origin_city": "Receipt", "dest_city": "Delivery",
    "receipt_city": "Receipt", "delivery_city": "DSTN",
    "origin_airport": "airportofdept", "dest_airport": "airportofdstn",
}
_BOOKING = {"master_id": "MAWBID", "station": "StationID", "etd": "ETD", "eta": "ETA",
            "flight": "OnboardFLT"}
_MASTER = {"id": "ID", "station": "StationID", "master_no": "MAWBNo"}

STATION_TABLES: dict[str, tuple[str, str, dict[str, str]]] = {
    "invoice_header": ("invoice_header", "FMOPSource", {
        "source_id": "SourceID", "station": "StationID", "invoice_no": "InvoiceNo",
        "temp_seq": "TempSeq", "invoice_date": "InvoiceDate", "amount": "InvoiceAmount",
        "lot": "Lot", "mode": "ModeCode", "product_line": "ProductLine", "id_type": "IDType",
        "ref_invoice_no": "RefInvoiceNo", "customer_id": "CustomerID", "bill_to": "billto"}),
    "invoice_line": ("invoice_line", "FMInvoiceDetail", {
        "invoice_no": "InvoiceNo", "temp_seq": "TempSeq", "station": "StationID",
        "charge_id": "ChargeID", "amount": "SAmount", "currency": "SCurrencyCode",
        "local_equiv": "SLocalEquiv", "rate": "STransactionRate"}),
    "house_AE": ("house_bill", "AEHAWB", _BOOKED_HOUSE),
    "house_AI": ("house_bill", "AIHAWB", _BOOKED_HOUSE),
    "house_3A": ("house_bill", "TPAIRData", _THIRD_PARTY_HOUSE),
    "booking_AE": ("carrier_booking", "AECarrierBooking", _BOOKING),
    "booking_AI": ("carrier_booking", "AICarrierBooking", _BOOKING),
    "master_AE": ("master_bill", "AEMAWB", _MASTER),
    "master_AI": ("master_bill", "AIMAWB", _MASTER),
    "customer": ("customer", "smcustomerone", {
        "customer_id": "CustomerID", "code": "CustomerCode", "name": "customername",
        "address1": "customeraddress1", "address2": "CustomerAddress2", "country_id": "Country"}),
    "ocean_bill": ("ocean_bill", "OEHBL", {"id": "ID", "delivery_city": "PDelivery"}),
}
MASTER_TABLES: dict[str, tuple[str, str, dict[str, str]]] = {
    "city": ("city", "SMCity", {"id": "HQID", "code": "CityCode", "name": "CityName"}),
    "airport": ("airport", "SMAirPort", {"id": "HQID", "code": "AirportCode"}),
    "country": ("country", "smcountry", {"id": "HQID", "name": "countryname"}),
    "milestone": ("milestone", "SMMilestoneHistory", {
        "id": "ID", "key": "KEYVALUE", "product_line": "PRODUCTLINE",
        "milestone_id": "MileStoneID", "status": "Status", "time": "MilestoneTime"}),
}
