"""The test tables in the roles of the canonical tables.

The test tables know nothing of shipments, so each canonical column is derived from
one of theirs. The derivations also give blanks, credit notes, void bills, missing
masters and missing milestones, so that the filters have something to do.
"""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipreport.operators.joins import Probe, attach
from shipreport.sources.schemas import SCHEMAS
from shipreport.sources.stations import Stations

STATION = "ST1"
START, END = dt.datetime(1996, 1, 1), dt.datetime(1999, 12, 31)
LISTED_SEGMENTS = ("BUILDING", "AUTOMOBILE", "MACHINERY")
CUSTOMER_CODE, BILL_TO_CODE = "BUILDING", "MACHINERY"
FORWARDER = "Acme"
SORT_DAY = dt.date(2024, 1, 24)
MODE_OF_FLAG = {"AE": "A", "AI": "N", "3A": "R"}

# Keywords of the invented test texts, in place of invoices and permits.
TEXT_RULES = (
    ("APACHE LICENSE", "Export Customs"),
    ("LICENSE", "Others"),
    ("@", "Commercial Invoice"),
    ("PACKING LIST", "Packing List"),
    ("HTTP", "Packing List"),
    (" DER ", "Packing List"),
    (" QUE ", "Others"),
    ("{FORWARDER} INVOICE", "{Forwarder} Invoice"),
)

# Keywords that the rule lists look for, and what they do not look for.
KEYWORDS = ("PERMIT NO", "CONTRACT OF PURCHASE AND SALE", "DECLARATION", "COMMERCIAL INVOICE", "TAX INVOICE",
            "PACKING LIST", "PACKING SLIP", "PACKING", "PACKLIST", "INVOICE", "ACME INVOICE", "PERMIT", "NOTHING")

# Made-up keywords by rule: three letters and a fourth; two and three letters.
LONG_RULES = tuple(("".join(letters) + "XQ"[i % 2], f"Type {i % 7}")
                   for i, letters in enumerate(itertools.product("EISNRATULO", repeat=3)))
SHORT_WORDS = tuple("".join(letters) for n in (2, 3) for letters in itertools.product("EINRST", repeat=n))


def shaped(df: DataFrame, schema: str, columns: dict[str, str]) -> DataFrame:
    """Columns of a canonical schema from SQL expressions; the others are NULL."""
    return df.selectExpr(*[
        f"CAST({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in SCHEMAS[schema].fields])


class Roles:
    """The canonical tables over one directory of test tables, each read once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        pattern = sf_dir.rstrip("/") + "/{table}.parquet"
        self.spark = spark
        self.stations = Stations({STATION: pattern}, master=pattern)
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.stations.table(self.spark, STATION, name)
        return self._read[name]

    def path(self, name: str) -> str:
        return self.stations.master.replace("{table}", name)

    def invoice_header(self) -> DataFrame:
        return shaped(self.table("orders"), "invoice_header", {
            "source_id": "o_orderkey",
            "station": f"'{STATION}'",
            "invoice_no": """CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN '  '
                WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN NULL
                WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN o_orderkey || 'C'
                ELSE string(o_orderkey) END""",
            "temp_seq": "1",
            "invoice_date": "o_orderdate",
            "amount": "o_totalprice",
            "lot": "o_orderpriority",
            "mode": "CASE o_orderstatus WHEN 'F' THEN 'AE' WHEN 'O' THEN 'AI' ELSE '3A' END",
            "product_line": "CASE o_orderstatus WHEN 'P' THEN '3PS' ELSE 'AMS' END",
            "id_type": "CASE o_orderpriority WHEN '5-LOW' THEN 'M' ELSE 'H' END",
            "ref_invoice_no": """CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'R' || o_orderkey
                WHEN '1-URGENT' THEN '  ' WHEN '3-MEDIUM' THEN '' END""",
            "customer_id": "o_custkey",
            "bill_to": "o_custkey",
        })

    def invoice_line(self) -> DataFrame:
        return shaped(self.table("lineitem"), "invoice_line", {
            "invoice_no": "string(l_orderkey)",
            "temp_seq": "1",
            "station": f"'{STATION}'",
            "charge_id": """CASE l_linenumber WHEN 1 THEN 13 WHEN 2 THEN 14 WHEN 3 THEN 15
                WHEN 4 THEN CASE l_returnflag WHEN 'A' THEN 380 WHEN 'N' THEN 400 ELSE 113 END
                WHEN 5 THEN 5
                WHEN 6 THEN CASE l_returnflag WHEN 'A' THEN 12 WHEN 'N' THEN 21 ELSE 1 END
                ELSE CASE l_returnflag WHEN 'A' THEN 35 WHEN 'N' THEN 73 ELSE 500 END END""",
            "amount": "l_extendedprice",
            "currency": "l_returnflag || l_linestatus",
            "local_equiv": "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(4,2)))",
            "rate": "l_discount",
        })

    def houses(self, mode: str) -> DataFrame:
        rows = self.table("lineitem").where(F.col("l_returnflag") == MODE_OF_FLAG[mode])
        columns = {
            "id": "l_orderkey",
            "station": f"'{STATION}'",
            "house_no": "string(l_partkey)",
            "status": "CASE l_linenumber WHEN 7 THEN 'VOID' WHEN 6 THEN NULL ELSE 'OPEN' END",
            "customer_id": "l_suppkey",
            "shipper_id": "l_suppkey",
            "consignee_id": "l_partkey",
            "pcs": "l_quantity",
            "pcs_uom": "CASE l_linestatus WHEN 'O' THEN 'PLT' ELSE 'CTN' END",
            "gross_wt": "l_extendedprice",
            "volume_wt": "l_quantity",
            "charge_wt": "l_extendedprice",
            "trade_term": "l_linestatus",
            "origin_city": "l_linenumber",
            "dest_city": "l_quantity",
            "receipt_city": "l_linenumber",
            "delivery_city": "l_quantity",
            "origin_airport": "l_linenumber",
            "dest_airport": "l_quantity",
        }
        if mode == "3A":
            columns |= {"master_no": "'M' || l_suppkey", "flight": "l_returnflag || l_linestatus || l_suppkey",
                        "delivery_city": "l_linenumber"}
        else:
            columns |= {"master_id": "l_partkey", "sp_unit": "l_linenumber - 1",
                        "sp_unit_uom": "CASE l_linenumber WHEN 3 THEN NULL ELSE l_returnflag END"}
        return shaped(rows, "house_bill", columns)

    def bookings(self, mode: str) -> DataFrame:
        rows = self.table("lineitem").where(F.col("l_returnflag") == MODE_OF_FLAG[mode])
        return shaped(rows, "carrier_booking", {
            "master_id": "l_partkey",
            "station": f"'{STATION}'",
            "etd": "CASE WHEN l_linenumber < 7 THEN l_shipdate + make_dt_interval(0, l_linenumber, 5) END",
            "eta": "l_shipdate + make_dt_interval(l_linenumber, l_linenumber, 30)",
            "flight": "l_linestatus || l_returnflag || l_suppkey",
        })

    def masters(self) -> DataFrame:
        return shaped(self.table("part"), "master_bill", {
            "id": "CASE WHEN p_size > 5 THEN p_partkey END", "station": f"'{STATION}'", "master_no": "p_name"})

    def customers(self) -> DataFrame:
        return shaped(self.table("customer"), "customer", {
            "customer_id": "c_custkey",
            "code": "c_mktsegment",
            "name": "c_name",
            "address1": "c_name",
            "address2": "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END",
            "country_id": "c_nationkey",
        })

    def listed_customers(self) -> DataFrame:
        rows = self.table("customer")
        return rows.where(F.col("c_mktsegment").isin(*LISTED_SEGMENTS)).select("c_custkey")

    def cities(self) -> DataFrame:
        rows = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return shaped(rows, "city", {
            "id": "n_nationkey",
            "code": "substring(r_name, 1, 2) || lpad(string(n_nationkey), 3, '0')",
            "name": "n_name",
        })

    def airports(self) -> DataFrame:
        return shaped(self.table("nation"), "airport", {
            "id": "n_nationkey", "code": "'A' || n_nationkey"})

    def countries(self) -> DataFrame:
        return shaped(self.table("nation"), "country", {"id": "n_nationkey", "name": "n_name"})

    def milestones(self) -> DataFrame:
        return shaped(self.table("events"), "milestone", {
            "id": "event_id",
            "key": "string(user_id)",
            "product_line": "2",
            "milestone_id": """CASE event_type WHEN 'click' THEN 1100 WHEN 'view' THEN 1300
                WHEN 'purchase' THEN 500 WHEN 'signup' THEN 2970 ELSE 3000 END""",
            "status": "CASE WHEN value >= 30 THEN 1 ELSE 0 END",
            "time": "ts",
        })

    def ocean_bills(self) -> DataFrame:
        return shaped(self.table("lineitem"), "ocean_bill", {
            "id": "l_orderkey", "delivery_city": "l_quantity"})

    def tables(self) -> dict[str, DataFrame]:
        """All canonical tables, as ``Stations.tables`` gives them."""
        out = {f"house_{m}": self.houses(m) for m in MODE_OF_FLAG}
        for mode in ("AE", "AI"):
            out[f"booking_{mode}"] = self.bookings(mode)
            out[f"master_{mode}"] = self.masters()
        return out | {
            "invoice_header": self.invoice_header(),
            "invoice_line": self.invoice_line(),
            "customer": self.customers(),
            "city": self.cities(),
            "airport": self.airports(),
            "country": self.countries(),
            "milestone": self.milestones(),
            "ocean_bill": self.ocean_bills(),
        }

    def shipments(self) -> DataFrame:
        """Shipments with their departure: one per event."""
        return self.table("events").selectExpr(
            "'SHP' || upper(left(event_type, 3)) || event_id AS house_no", "ts AS etd")

    def documents(self, raw: DataFrame | None = None) -> DataFrame:
        """Documents of shipments, named after them, after a part of their number, or otherwise."""
        rows = (self.table("documents") if raw is None else raw).selectExpr(
            "doc_id", "7 * doc_id AS event_id", "text", "lang", "source")
        labels = self.table("labels").select("doc_id", "quality", "toxic")
        events = self.table("events").select("event_id", "event_type")
        probe = Probe(rows, ["doc_id"], ["event_id"])
        rows = attach(attach(rows, labels, ["doc_id"], probe=probe), events, ["event_id"], probe=probe)
        house = "'SHP' || upper(left(event_type, 3)) || event_id"
        return shaped(rows, "document", {
            "doc_id": "doc_id",
            "house_no": house,
            "file_name": f"""CASE WHEN toxic = 1 THEN ' ' || lower({house}) || '.pdf'
                WHEN quality = 0 THEN lower(left(event_type, 3)) || '_' || source || '.jpg'
                WHEN lang = 'es' THEN source || '.jpg'
                ELSE source || '.pdf ' END""",
            "current_type": """CASE WHEN toxic = 1 THEN '*hawb' WHEN lang = 'fr' THEN 'Others '
                WHEN lang = 'de' THEN NULL ELSE '* Commercial invoice' END""",
            "text": "text",
        })

    def keyworded_texts(self) -> DataFrame:
        """The test texts in upper case, each with two keywords of real documents at its end."""
        words = ", ".join(f"'{w}'" for w in KEYWORDS)
        return self.table("documents").selectExpr(
            "doc_id", f"""upper(text) || ' ' || array({words})[cast(doc_id % 13 AS int)]
                || ' ' || array({words})[cast(doc_id div 13 % 13 AS int)] AS content""")

    def pages(self) -> DataFrame:
        """Document pages: the turns of the conversations."""
        return shaped(self.table("conversations"), "document_page", {
            "doc_id": "conv_id",
            "page_no": "turn",
            "text": "CASE WHEN role = 'user' AND turn = 2 THEN NULL ELSE text END",
        })
