"""The queries as plain SQL over the test tables, for another engine to check.

Written as a report writer would: branch by branch, one correlated subquery per
looked-up value, independently of how the operators work.
"""

from __future__ import annotations

# The columns of the invoice report in order, written out here as well so that
# the report is checked against them.
COLUMNS = (
    "CarrierID",
    "ClientID",
    "InvoiceType",
    "Invoice Number",
    "Invoice Total",
    "Invoice Date",
    "Shipment Number",
    "Ship Date",
    "Bill To Account",
    "Weight Unit",
    "Billed Weight",
    "Actual Weight",
    "DIM Weight",
    "Volume",
    "PCS",
    "Rejected Pieces",
    "Package Type",
    "Loading meters",
    "Service Type",
    "Service Zone",
    "Direction",
    "Mode",
    "Payment Terms",
    "Inco terms",
    "Distance qualifier",
    "Distance",
    "Bill Of Lading",
    "MAWB",
    "HAWB",
    "PO Number",
    "Reference number",
    "Delivery Date",
    "Delivery Time",
    "POD Name",
    "Notes1 (Pallets)",
    "Notes2 (Cartons)",
    "Notes3",
    "Notes4",
    "Notes5",
    "Notes6",
    "Notes7",
    "Notes8",
    "Notes9",
    "Notes10",
    "Notes11",
    "Notes12",
    "Notes13",
    "Notes14",
    "Notes15",
    "Notes16",
    "Origin(Air)Port",
    "Destination (Air)Port",
    "Shipper Location",
    "Shipper Name",
    "Shipper Company",
    "Shipper Address1",
    "Shipper Address2",
    "Shipper Address3",
    "Shipper City",
    "Shipper state",
    "Shipper Postcode",
    "Shipper Country",
    "Consignee Location",
    "Consignee Name",
    "Consignee Company",
    "Consignee Address1",
    "Consignee Address2",
    "Consignee Address3",
    "Consignee City",
    "Consignee State",
    "Consignee Postcode",
    "Consignee Country",
    "Amount Billed",
    "Freight Amount - FRT",
    "Total Shipment VAT Amount",
    "Accessorial Charge- FSC",
    "Accessorial Charge-FSC Amount1 - Fuel Surcharge",
    "VAT liable flag 1",
    "Accessorial Charge-SSC",
    "Accessorial Charge-SSC Amount2",
    "VAT liable flag 2",
    "Accessorial Charge-P/U Code3",
    "Accessorial Charge- Amount3",
    "VAT liable flag 3",
    "Accessorial Charge-Origin Terminal Code4",
    "Accessorial Charge-Origin Terminal Amount4",
    "VAT liable flag 4",
    "Accessorial Charge-CUS Code5",
    "Accessorial Charge-CUS Amount5",
    "VAT liable flag 5",
    "Accessorial Charge-Dest Terminal Code6",
    "Accessorial Charge-dest Terminal Amount6",
    "VAT liable flag 6",
    "Accessorial Charge Code7",
    "Accessorial Charge Amount7",
    "VAT liable flag 7",
    "Accessorial Charge Code8",
    "Accessorial Charge Amount8",
    "VAT liable flag 8",
    "Accessorial Charge Code9",
    "Accessorial Charge Amount9",
    "VAT liable flag 9",
    "Accessorial Charge Code10",
    "Accessorial Charge Amount10",
    "Accessorial 10 VAT code",
    "Currency",
    "Bill to Location",
    "Bill To Company",
    "Bill To Address1",
    "Bill To Address2",
    "Bill To City",
    "Bill To State",
    "Bill To Postcode",
    "Bill To Country",
    "Equipment Type",
    "Container number",
    "Trailer/Car ID",
    "carrier VAT number",
    "CLIENT VAT NUMBER",
    "VAT percentage",
    "Currency Exchange Rate",
    "Overtime hours",
    "Waiting hours",
    "Urgent fee location count",
)
# Texts that are the same in every row of the invoice report.
CONSTANTS = {
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
    "CarrierID": "CARR",
    "ClientID": "CLNT",
    "Bill To Account": "ACCT",
    "Currency": "SGD",
    "Bill To Company": "Example Pte Ltd",
    "Bill To City": "Exampletown",
    "Bill To Country": "SG",
}

# The test tables in their roles.
ROLES = {
    "invoice_header": """
        SELECT o_orderkey AS source_id, 'ST1' AS station,
            CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN '  '
                 WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN NULL
                 WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'
                     THEN CAST(o_orderkey AS VARCHAR) || 'C'
                 ELSE CAST(o_orderkey AS VARCHAR) END AS invoice_no,
            1 AS temp_seq, o_orderdate AS invoice_date,
            CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderpriority AS lot,
            CASE o_orderstatus WHEN 'F' THEN 'AE' WHEN 'O' THEN 'AI' ELSE '3A' END AS mode,
            CASE o_orderstatus WHEN 'P' THEN '3PS' ELSE 'AMS' END AS product_line,
            CASE o_orderpriority WHEN '5-LOW' THEN 'M' ELSE 'H' END AS id_type,
            CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'R' || CAST(o_orderkey AS VARCHAR)
                 WHEN '1-URGENT' THEN '  ' WHEN '3-MEDIUM' THEN '' END AS ref_invoice_no,
            o_custkey AS customer_id, o_custkey AS bill_to
        FROM orders""",
    "invoice_line": """
        SELECT CAST(l_orderkey AS VARCHAR) AS invoice_no, 1 AS temp_seq, 'ST1' AS station,
            CASE WHEN l_linenumber = 1 THEN 13 WHEN l_linenumber = 2 THEN 14
                 WHEN l_linenumber = 3 THEN 15 WHEN l_linenumber = 5 THEN 5
                 WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN 380
                 WHEN l_linenumber = 4 AND l_returnflag = 'N' THEN 400
                 WHEN l_linenumber = 4 THEN 113
                 WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN 12
                 WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN 21
                 WHEN l_linenumber = 6 THEN 1
                 WHEN l_returnflag = 'A' THEN 35 WHEN l_returnflag = 'N' THEN 73
                 ELSE 500 END AS charge_id,
            CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
            l_returnflag || l_linestatus AS currency,
            CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(4,2)))
                 AS DECIMAL(18,2)) AS local_equiv,
            CAST(l_discount AS DECIMAL(18,6)) AS rate
        FROM lineitem""",
    "house_bill": """
        SELECT CASE l_returnflag WHEN 'A' THEN 'AE' WHEN 'N' THEN 'AI' ELSE '3A' END AS mode,
            l_orderkey AS source_id, 'ST1' AS station, CAST(l_partkey AS VARCHAR) AS house_no,
            CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS master_id,
            CASE WHEN l_returnflag = 'R' THEN 'M' || CAST(l_suppkey AS VARCHAR) END AS master_no,
            CASE l_linenumber WHEN 7 THEN 'VOID' WHEN 6 THEN NULL ELSE 'OPEN' END AS status,
            l_suppkey AS customer_id, l_suppkey AS shipper_id, l_partkey AS consignee_id,
            CAST(l_quantity AS INTEGER) AS pcs,
            CASE l_linestatus WHEN 'O' THEN 'PLT' ELSE 'CTN' END AS pcs_uom,
            CASE WHEN l_returnflag <> 'R' THEN l_linenumber - 1 END AS sp_unit,
            CASE WHEN l_returnflag <> 'R' AND l_linenumber <> 3 THEN l_returnflag END AS sp_unit_uom,
            CAST(l_extendedprice AS DECIMAL(18,2)) AS gross_wt,
            CAST(l_quantity AS DECIMAL(18,2)) AS volume_wt,
            CAST(l_extendedprice AS DECIMAL(18,2)) AS charge_wt, l_linestatus AS trade_term,
            CASE WHEN l_returnflag = 'R'
                 THEN l_returnflag || l_linestatus || CAST(l_suppkey AS VARCHAR) END AS flight,
            CAST(l_linenumber AS BIGINT) AS origin_city, CAST(l_quantity AS BIGINT) AS dest_city,
            CAST(l_linenumber AS BIGINT) AS receipt_city,
            CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS BIGINT)
                 ELSE CAST(l_quantity AS BIGINT) END AS delivery_city,
            CAST(l_linenumber AS BIGINT) AS origin_airport, CAST(l_quantity AS BIGINT) AS dest_airport
        FROM lineitem""",
    "booking": """
        SELECT CASE l_returnflag WHEN 'A' THEN 'AE' ELSE 'AI' END AS mode, l_partkey AS master_id,
            'ST1' AS station,
            CASE WHEN l_linenumber < 7
                 THEN l_shipdate + to_hours(l_linenumber) + INTERVAL 5 MINUTE END AS etd,
            l_shipdate + to_days(l_linenumber) + to_hours(l_linenumber) + INTERVAL 30 MINUTE AS eta,
            l_linestatus || l_returnflag || CAST(l_suppkey AS VARCHAR) AS flight
        FROM lineitem WHERE l_returnflag <> 'R'""",
    "master": """
        SELECT m.mode, CASE WHEN p_size > 5 THEN p_partkey END AS master_id, 'ST1' AS station,
            p_name AS master_no
        FROM part, (VALUES ('AE'), ('AI')) AS m(mode)""",
    "client": """
        SELECT c_custkey AS customer_id, c_mktsegment AS code, c_name AS name, c_name AS address1,
            CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS address2,
            CAST(c_nationkey AS BIGINT) AS country_id
        FROM customer""",
    "city": """
        SELECT CAST(n_nationkey AS BIGINT) AS id,
            substr(r_name, 1, 2) || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code, n_name AS name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "milestone": """
        SELECT event_id AS id, CAST(user_id AS VARCHAR) AS key, 2 AS product_line,
            CASE event_type WHEN 'click' THEN 1100 WHEN 'view' THEN 1300 WHEN 'purchase' THEN 500
                 WHEN 'signup' THEN 2970 ELSE 3000 END AS milestone_id,
            CASE WHEN value >= 30 THEN 1 ELSE 0 END AS status, ts AS time
        FROM events""",
    "listed": """
        SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')""",
    "shipment": """
        SELECT 'SHP' || upper(substr(event_type, 1, 3)) || CAST(event_id AS VARCHAR) AS house_no, ts AS etd
        FROM events""",
    "document": """
        SELECT d.doc_id,
            'SHP' || upper(substr(event_type, 1, 3)) || CAST(event_id AS VARCHAR) AS house_no,
            CASE WHEN toxic = 1 THEN ' shp' || substr(event_type, 1, 3) || CAST(event_id AS VARCHAR) || '.pdf'
                 WHEN quality = 0 THEN substr(event_type, 1, 3) || '_' || source || '.jpg'
                 WHEN lang = 'es' THEN source || '.jpg'
                 ELSE source || '.pdf ' END AS file_name,
            CASE WHEN toxic = 1 THEN '*hawb' WHEN lang = 'fr' THEN 'Others ' WHEN lang = 'de' THEN NULL
                 ELSE '* Commercial invoice' END AS current_type,
            upper(text) AS content
        FROM documents d LEFT JOIN labels USING (doc_id) LEFT JOIN events ON event_id = 7 * d.doc_id""",
    "page": """
        SELECT conv_id AS doc_id, turn AS page_no,
            CASE WHEN role = 'user' AND turn = 2 THEN NULL ELSE text END AS text
        FROM conversations""",
}

CONTENT_CASE = """CASE WHEN contains(content, 'APACHE LICENSE') THEN 'Export Customs'
    WHEN contains(content, 'LICENSE') THEN 'Others'
    WHEN contains(content, '@') THEN 'Commercial Invoice'
    WHEN contains(content, 'PACKING LIST') THEN 'Packing List'
    WHEN contains(content, 'HTTP') THEN 'Packing List'
    WHEN contains(content, ' DER ') THEN 'Packing List'
    WHEN contains(content, ' QUE ') THEN 'Others'
    WHEN contains(content, 'ACME INVOICE') THEN 'Acme Invoice' END"""
KEYWORDED = """SELECT doc_id, upper(text) || ' ' || words[1 + doc_id % 13] || ' ' || words[1 + doc_id // 13 % 13] AS content
    FROM documents, (SELECT ['PERMIT NO', 'CONTRACT OF PURCHASE AND SALE', 'DECLARATION', 'COMMERCIAL INVOICE',
        'TAX INVOICE', 'PACKING LIST', 'PACKING SLIP', 'PACKING', 'PACKLIST', 'INVOICE', 'ACME INVOICE', 'PERMIT',
        'NOTHING'] AS words)"""
ROLES["typed"] = f"""
    SELECT doc_id, house_no, file_name, current_type,
        CASE WHEN trim(replace(upper(trim(file_name)), '.PDF', '')) = upper(house_no) THEN 'HAWB'
             WHEN length(house_no) >= 6 AND upper(substr(trim(file_name), 1, 3)) = substr(house_no, 4, 3)
                 THEN 'Acme Invoice'
             WHEN upper(trim(file_name)) LIKE '%.PDF' THEN {CONTENT_CASE} END AS new_type
    FROM document"""
ROLES["changed"] = """
    SELECT house_no, 'Done' AS status, trim(file_name) AS file_name, trim(current_type) AS old_type, new_type
    FROM typed
    WHERE new_type IS NOT NULL
      AND upper(new_type) <> upper(trim(replace(coalesce(current_type, ''), '*', '')))"""
ROLES["opened"] = """
    SELECT DISTINCT house_no FROM shipment
    WHERE etd >= TIMESTAMP '2024-01-14' AND etd < TIMESTAMP '2024-01-21'"""

ELIGIBLE = """h.invoice_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'
    AND h.product_line IN ('AMS', '3PS') AND h.mode IN ('AE', 'AI', '3A') AND h.id_type = 'H'
    AND rtrim(coalesce(h.invoice_no, '')) <> '' AND right(h.invoice_no, 1) <> 'C'
    AND rtrim(coalesce(h.ref_invoice_no, '')) = ''
    AND h.customer_id IN (SELECT c_custkey FROM listed)"""
ROLES["cache"] = f"""
    SELECT h.*, l.charge_id, l.amount AS line_amount, l.currency
    FROM invoice_header h LEFT JOIN invoice_line l
        ON l.invoice_no = h.invoice_no AND l.temp_seq = h.temp_seq AND l.station = h.station
    WHERE {ELIGIBLE}"""

NEEDS = {"typed": ["document"], "changed": ["document", "typed"], "opened": ["shipment"],
         "cache": ["invoice_header", "invoice_line", "listed"]}


def with_roles(body: str, *names: str) -> str:
    """The body with the roles it reads, and theirs, as common table expressions."""
    order: list[str] = []
    for name in names:
        for needed in (*NEEDS.get(name, []), name):
            if needed not in order:
                order.append(needed)
    return "WITH " + ", ".join(f"{n} AS ({ROLES[n]})" for n in order) + body


def default_text(col: str) -> str:
    return (f"strftime({col}, '%b ') || lpad(CAST(day({col}) AS VARCHAR), 2, ' ') || "
            f"strftime({col}, ' %Y ') || lpad(ltrim(strftime({col}, '%I:%M%p'), '0'), 7, ' ')")


def top_booking(value: str, order: str = "etd") -> str:
    tie = ", b.flight DESC NULLS LAST" if order == "etd" else ""
    return (f"(SELECT {value} FROM booking b WHERE b.mode = a.mode AND b.master_id = a.master_id "
            f"AND b.station = a.station ORDER BY b.{order} DESC NULLS LAST{tie} LIMIT 1)")


def newest_milestone(number: int, value: str = "m.time", more: str = "", key: str = "a.house_no") -> str:
    return (f"(SELECT {value} FROM milestone m WHERE m.key = {key} AND m.milestone_id = {number}{more} "
            "ORDER BY m.id DESC LIMIT 1)")


def line_sum(measure: str, codes: str, table: str, owner: str, keys: list[str]) -> str:
    match = " AND ".join(f"t.{k} = {owner}.{k}" for k in keys)
    return (f"(SELECT CAST(sum(t.{measure}) AS DECIMAL(28,2)) FROM {table} t "
            f"WHERE {match} AND t.charge_id IN ({codes}))")


LINE_KEYS = ["invoice_no", "temp_seq", "station"]


def weight_branch(mode: str) -> str:
    booked = mode != "3A"
    if booked:
        master = ("(SELECT g.master_no FROM master g WHERE g.mode = a.mode AND g.master_id = a.master_id "
                  "AND g.station = a.station)")
        etd_day = top_booking("strftime(b.etd, '%d/%m/%Y')")
        etd = top_booking("strftime(b.etd, '%H:%M:%S')")
        eta = top_booking("strftime(b.eta, '%H:%M:%S')", "eta")
        flight = top_booking("b.flight")
        pieces = """CASE a.sp_unit WHEN 0 THEN CAST(a.pcs AS VARCHAR) || ' ' || a.pcs_uom
            ELSE CAST(a.pcs AS VARCHAR) || ' ' || a.pcs_uom || ' ' || CAST(a.sp_unit AS VARCHAR) || ' '
                || a.sp_unit_uom END"""
        source = f"JOIN cache c ON c.product_line = 'AMS' AND c.mode = '{mode}'"
    else:
        master, flight = "a.master_no", "a.flight"
        etd_day = newest_milestone(1100, "strftime(m.time, '%d/%m/%Y')")
        etd = newest_milestone(1100, "strftime(m.time, '%H:%M:%S')")
        eta = newest_milestone(1300, "strftime(m.time, '%H:%M:%S')")
        pieces = "CAST(a.pcs AS VARCHAR) || ' ' || a.pcs_uom"
        source = """JOIN invoice_header c ON c.product_line = '3PS' AND c.mode = '3A' AND c.id_type = 'H'
            AND rtrim(coalesce(c.invoice_no, '')) <> '' AND right(c.invoice_no, 1) <> 'C'
            AND rtrim(coalesce(c.ref_invoice_no, '')) = ''"""

    def charge(codes: str) -> str:
        return f"CAST({line_sum('line_amount', codes, 'cache', 'c', LINE_KEYS)} AS DECIMAL(18,2))"

    return f"""
    SELECT c.lot AS "Lot", '{mode}' AS "Mode", 'ACME' AS "Forwarder",
        (SELECT code FROM client j WHERE j.customer_id = a.consignee_id) AS "CNEE",
        (SELECT code FROM client j WHERE j.customer_id = a.shipper_id) AS "SHPR",
        {master} AS "Master Inv No.", strftime(c.invoice_date, '%d/%m/%Y') AS "Invoice Date",
        c.invoice_no AS "Invoice no.", {etd_day} AS "ETDDate", a.house_no AS "HAWB",
        substr({flight}, 1, 2) AS "Airline", {flight} AS "FLT NO", {etd} AS "ETD", {eta} AS "ETA",
        {pieces} AS "TTL PCS", a.gross_wt AS "TTL G.W", a.volume_wt AS "TTL D.W", a.charge_wt AS "TTL C.W",
        (SELECT substr(y.code, 1, 2) FROM city y WHERE y.id = a.origin_city) AS "ORG Country",
        (SELECT right(y.code, 3) FROM city y WHERE y.id = a.origin_city) AS "ORG City",
        (SELECT substr(y.code, 1, 2) FROM city y WHERE y.id = a.dest_city) AS "DES Country",
        (SELECT right(y.code, 3) FROM city y WHERE y.id = a.dest_city) AS "DES City",
        a.trade_term AS "Trade Term",
        (SELECT min(t.currency) FROM cache t WHERE t.invoice_no = c.invoice_no
            AND t.temp_seq = c.temp_seq AND t.station = c.station) AS "Currency",
        {charge("13")} AS "Freight", {charge("14")} AS "FSC", {charge("15")} AS "ISS", '' AS "PICKUP",
        {charge("380")} AS "Export LHC", {charge("5")} AS "Import LHC",
        {charge("12, 21, 22, 73, 257, 114, 35")} AS "Other", '' AS "Tax", c.amount AS "Total"
    FROM house_bill a {source} AND c.source_id = a.source_id AND c.station = a.station
    WHERE a.mode = '{mode}' AND a.status <> 'VOID' AND a.customer_id IN (SELECT c_custkey FROM listed)
      AND c.invoice_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'"""


def invoice_branches(ranged: bool) -> str:
    """The invoice report; as text if it has a date range."""
    live = " AND m.product_line = 2 AND m.status = 1"

    def charge(measure: str, code: int) -> str:
        return line_sum(measure, str(code), "invoice_line", "inv", ["invoice_no", "station"])

    shipped = f"date_trunc('day', {newest_milestone(500, more=live)})"
    delivered = f"coalesce({newest_milestone(2970, more=live)}, {newest_milestone(3000, more=live)})"
    address = "{0}.address1 || {0}.address2"
    values = {
        "Invoice Number": "inv.invoice_no", "Invoice Total": "inv.amount",
        "Invoice Date": "inv.invoice_date", "Shipment Number": "a.house_no", "Ship Date": shipped,
        "Billed Weight": "a.charge_wt", "Actual Weight": "a.charge_wt", "PCS": "a.pcs",
        "Package Type": "a.pcs_uom", "Delivery Date": delivered,
        "Notes1 (Pallets)": "CASE WHEN a.pcs_uom = 'PLT' THEN a.pcs END",
        "Notes2 (Cartons)": "CASE WHEN a.pcs_uom = 'CTN' THEN a.pcs END",
        "Notes3": "a.house_no", "Origin(Air)Port": "'A' || CAST(oa.n_nationkey AS VARCHAR)",
        "Destination (Air)Port": "'A' || CAST(da.n_nationkey AS VARCHAR)",
        "Shipper Name": "shp.name", "Shipper Company": "shp.name",
        "Shipper Address1": address.format("shp"), "Shipper City": "rc.name", "Shipper Country": "rc.name",
        "Consignee Name": "cnee.name", "Consignee Company": "cnee.name",
        "Consignee Address1": address.format("cnee"), "Consignee City": "dc.name",
        "Consignee Postcode": address.format("cnee"), "Consignee Country": "ctry.n_name",
        "Amount Billed": "inv.amount",
        "Freight Amount - FRT": charge("amount", 13),
        "Total Shipment VAT Amount": charge("local_equiv", 13),
        "Accessorial Charge-FSC Amount1 - Fuel Surcharge": charge("amount", 14),
        "VAT liable flag 1": charge("local_equiv", 14),
        "Accessorial Charge-SSC Amount2": charge("amount", 15),
        "VAT liable flag 2": charge("local_equiv", 15),
        "Accessorial Charge-Origin Terminal Amount4": charge("amount", 400),
        "VAT liable flag 4": charge("local_equiv", 400),
        "Accessorial Charge-dest Terminal Amount6": charge("amount", 5),
        "VAT liable flag 6": charge("local_equiv", 5),
        "Accessorial Charge Amount7": charge("amount", 113),
        "VAT liable flag 7": charge("local_equiv", 113),
        "Accessorial Charge Amount8": charge("amount", 1),
        "VAT liable flag 8": charge("local_equiv", 1),
        "Currency Exchange Rate": "(SELECT min(t.rate) FROM invoice_line t "
                                  "WHERE t.invoice_no = inv.invoice_no AND t.station = inv.station)",
    }
    texts = CONSTANTS
    columns = ", ".join(f"""{values.get(n, f"'{texts.get(n, '')}'")} AS "{n}\"""" for n in COLUMNS)
    within = ("AND inv.invoice_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'"
              if ranged else "")
    native = f"""
    SELECT {columns}
    FROM invoice_header inv
    LEFT JOIN house_bill a ON a.mode = inv.mode AND a.source_id = inv.source_id AND a.station = inv.station
    LEFT JOIN client cus ON cus.customer_id = a.customer_id
    LEFT JOIN client shp ON shp.customer_id = a.shipper_id
    LEFT JOIN client cnee ON cnee.customer_id = a.consignee_id
    LEFT JOIN client billto ON billto.customer_id = inv.bill_to
    LEFT JOIN nation oa ON oa.n_nationkey = a.origin_airport
    LEFT JOIN nation da ON da.n_nationkey = a.dest_airport
    LEFT JOIN nation ctry ON ctry.n_nationkey = cnee.country_id
    LEFT JOIN city rc ON rc.id = a.receipt_city
    LEFT JOIN city dc ON dc.id = a.delivery_city
    WHERE inv.mode IN ('AE', 'AI', '3A') AND cus.code = 'BUILDING' AND billto.code = 'MACHINERY'
      AND rtrim(coalesce(inv.invoice_no, '')) <> '' {within}"""
    if not ranged:
        return native
    dates = ("Invoice Date", "Ship Date", "Delivery Date")
    shown = [default_text(f'"{n}"') if n in dates else f'CAST("{n}" AS VARCHAR)' for n in COLUMNS]
    return (f", native AS ({native}) SELECT "
            + ", ".join(f'{expr} AS "{n}"' for n, expr in zip(COLUMNS, shown)) + " FROM native")


INVOICE_ROLES = ("invoice_header", "invoice_line", "house_bill", "client", "city", "milestone")
DIRECT = {"freight": 13, "fuel": 14, "security": 15, "origin_terminal": 400, "dest_terminal": 5,
          "delivery": 113, "customs": 1}


def direct_sums(measures: dict[str, str]) -> str:
    cols = ", ".join(
        f"{line_sum(measure, str(code), 'invoice_line', 'h', ['invoice_no', 'station'])} AS {name}{suffix}"
        for name, code in DIRECT.items() for suffix, measure in measures.items())
    return with_roles(f" SELECT h.source_id, h.invoice_no, {cols} FROM invoice_header h",
                      "invoice_header", "invoice_line")


def page_form(form: str, piece: str, between: str) -> str:
    return (f" SELECT doc_id, string_agg({piece}, {between} ORDER BY page_no) AS text, "
            f"'{form}' AS form FROM page GROUP BY doc_id")


# Queries that must give another's rows by another way: laid-out tables, stored sums, a stream.
SAME_ROWS = {
    "bucketed_header_lines": "header_lines",
    "bucketed_house_bills": "house_bill_by_mode",
    "partitioned_date_range": "invoice_date_range",
    "customer_roles_once": "customer_roles",
    "charge_sum_stored": "charge_sum_direct",
    "doc_sort_stream": "doc_sort_report",
}


def oracles() -> dict[str, str]:
    house = "a.mode, a.source_id, a.house_no"
    out = {
        "station_scan": "SELECT *, 'ST1' AS station FROM orders",
        "master_scan": """SELECT event_id, user_id, event_type, n_name AS city
            FROM events LEFT JOIN nation ON n_nationkey = user_id""",
        "invoice_lines_cached": with_roles(
            """ SELECT invoice_no, temp_seq, station, source_id, mode, lot, invoice_date, charge_id,
            line_amount, currency FROM cache""", "cache"),
        "param_query": with_roles(
            """ SELECT mode, invoice_date, count(*) AS invoices,
                CAST(sum(amount) AS DECIMAL(28,2)) AS amount
            FROM invoice_header WHERE invoice_date BETWEEN TIMESTAMP '1996-01-01'
                AND TIMESTAMP '1999-12-31' GROUP BY mode, invoice_date""", "invoice_header"),
        "typed_result": with_roles(
            """ SELECT invoice_no, CAST(charge_id AS BIGINT) AS charge_id, amount, local_equiv, rate,
            currency FROM invoice_line""", "invoice_line"),
        "string_result": with_roles(
            f""" SELECT b.mode, CAST(b.master_id AS VARCHAR) AS master_id, {default_text("b.etd")} AS etd,
            {default_text("b.eta")} AS eta, b.flight, g.master_no
            FROM booking b LEFT JOIN master g
                ON g.mode = b.mode AND g.master_id = b.master_id AND g.station = b.station""",
            "booking", "master"),
        "change_log": with_roles(
            ' SELECT house_no AS "HAWB No", status AS "Status", file_name AS "PDF Name", '
            'old_type AS "Old Type", new_type AS "New Type" FROM changed', "changed"),
        "constant_columns": with_roles(
            """ SELECT source_id, invoice_no, 'K' AS unit, 'LTL' AS service, '' AS volume, '' AS tax
            FROM invoice_header""", "invoice_header"),
        "report_aliases": with_roles(
            ' SELECT house_no AS "HAWB", gross_wt AS "TTL G.W", pcs AS "Notes1 (Pallets)", '
            'master_no AS "Master Inv No." FROM house_bill', "house_bill"),
        "pieces_by_unit": with_roles(
            f""" SELECT {house}, pcs, CASE WHEN pcs_uom = 'PLT' THEN pcs ELSE NULL END AS pallets,
            CASE WHEN pcs_uom = 'CTN' THEN pcs ELSE NULL END AS cartons FROM house_bill a""", "house_bill"),
        "pieces_label": with_roles(
            f""" SELECT {house}, gross_wt, CAST(volume_wt AS VARCHAR) AS volume_text,
            CASE sp_unit WHEN 0 THEN CAST(pcs AS VARCHAR) || ' ' || pcs_uom
                ELSE CAST(pcs AS VARCHAR) || ' ' || pcs_uom || ' ' || CAST(sp_unit AS VARCHAR) || ' '
                    || sp_unit_uom END AS label,
            CAST(pcs AS VARCHAR) || ' ' || pcs_uom AS short_label FROM house_bill a""", "house_bill"),
        "address_concat": with_roles(
            " SELECT customer_id, address1 || address2 AS address FROM client", "client"),
        "code_parts": with_roles(
            f""" SELECT {house}, a.flight, left(y.code, 2) AS country, right(y.code, 3) AS city,
            left(a.flight, 2) AS airline FROM house_bill a LEFT JOIN city y ON y.id = a.origin_city""",
            "house_bill", "city"),
        "date_text": with_roles(
            """ SELECT mode, master_id, flight, strftime(etd, '%d/%m/%Y') AS etd_date,
            strftime(eta, '%d/%m/%Y') AS eta_date FROM booking""", "booking"),
        "time_text": "SELECT event_id AS id, strftime(ts, '%H:%M:%S') AS clock FROM events",
        "ship_day": "SELECT event_id AS id, date_trunc('day', ts) AS day FROM events",
        "delivery_date": with_roles(
            f""" SELECT a.mode, a.source_id, a.house_no AS key,
            coalesce({newest_milestone(2970)}, {newest_milestone(3000)}) AS delivery_date
            FROM house_bill a""", "house_bill", "milestone"),
        "nonblank_invoices": with_roles(
            """ SELECT source_id, invoice_no, rtrim(coalesce(ref_invoice_no, '')) = '' AS no_reference
            FROM invoice_header WHERE rtrim(coalesce(invoice_no, '')) <> ''""", "invoice_header"),
        "norm_file_name": with_roles(
            """ SELECT doc_id, trim(replace(upper(trim(file_name)), '.PDF', '')) AS name,
            upper(trim(replace(coalesce(current_type, ''), '*', ''))) AS stored_type FROM document""",
            "document"),
        "key_slice_match": with_roles(
            """ SELECT doc_id, house_no, length(house_no) >= 6
                AND upper(substr(trim(file_name), 1, 3)) = substr(house_no, 4, 3) AS matches
            FROM document""", "document"),
        "last_week_window": """
            SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
                CAST(CAST(o_orderdate AS DATE) - CAST(isodow(o_orderdate) % 7 + 7 AS INTEGER) AS DATE) AS from_day,
                CAST(CAST(o_orderdate AS DATE) - CAST(isodow(o_orderdate) % 7 + 1 AS INTEGER) AS DATE) AS to_day
            FROM orders""",
        "country_of_city": with_roles(
            f""" SELECT {house}, a.dest_city,
            (SELECT left(y.code, 2) FROM city y WHERE y.id = a.dest_city) AS country_code
            FROM house_bill a""", "house_bill", "city"),
        "eligible_invoices": with_roles(
            f""" SELECT source_id, mode, invoice_no, customer_id, invoice_date, amount
            FROM invoice_header h WHERE {ELIGIBLE}""", "invoice_header", "listed"),
        "customer_in_list": with_roles(
            """ SELECT source_id, customer_id FROM invoice_header
            WHERE customer_id IN (SELECT c_custkey FROM listed)""", "invoice_header", "listed"),
        "invoice_date_range": """SELECT o_orderkey AS source_id, o_orderdate AS invoice_date FROM orders
            WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'""",
        "not_void": with_roles(
            " SELECT mode, source_id, house_no, status FROM house_bill WHERE status <> 'VOID'", "house_bill"),
        "no_credit_notes": with_roles(
            " SELECT source_id, invoice_no FROM invoice_header WHERE right(invoice_no, 1) <> 'C'",
            "invoice_header"),
        "filter_by_code": with_roles(
            """ SELECT h.source_id, h.bill_to, h.amount FROM invoice_header h
            LEFT JOIN client b ON b.customer_id = h.bill_to WHERE b.code = 'MACHINERY'""",
            "invoice_header", "client"),
        "etd_window": with_roles(
            """ SELECT house_no, etd FROM shipment
            WHERE CAST(etd AS DATE) BETWEEN DATE '2024-01-14' AND DATE '2024-01-20'""", "shipment"),
        "header_lines": with_roles(
            """ SELECT h.invoice_no, h.temp_seq, h.station, h.source_id, h.invoice_date, l.charge_id,
            l.amount, l.local_equiv
            FROM invoice_header h LEFT JOIN invoice_line l ON l.invoice_no = h.invoice_no
                AND l.temp_seq = h.temp_seq AND l.station = h.station""", "invoice_header", "invoice_line"),
        "house_bill_by_mode": with_roles(
            " UNION ALL ".join(
                f""" SELECT h.mode, h.source_id, h.station, h.invoice_no, h.amount, a.house_no,
                a.gross_wt, a.pcs FROM invoice_header h LEFT JOIN (SELECT * FROM house_bill
                    WHERE mode = '{m}') a ON a.source_id = h.source_id AND a.station = h.station
                WHERE h.mode = '{m}'""" for m in ("AE", "AI", "3A")),
            "invoice_header", "house_bill"),
        "on_condition_join": with_roles(
            """ SELECT a.mode, a.source_id, a.station, a.house_no, a.gross_wt, c.invoice_no, c.amount
            FROM house_bill a LEFT JOIN invoice_header c ON c.source_id = a.source_id
                AND c.station = a.station AND c.mode = a.mode AND c.product_line = 'AMS'
                AND c.id_type = 'H' AND rtrim(coalesce(c.invoice_no, '')) <> ''
                AND right(c.invoice_no, 1) <> 'C' AND rtrim(coalesce(c.ref_invoice_no, '')) = ''""",
            "house_bill", "invoice_header"),
        "customer_roles": with_roles(
            f""" SELECT {house}, cus.code AS cus_code, cus.name AS cus_name, shp.code AS shp_code,
            shp.name AS shp_name, cnee.code AS cnee_code, cnee.name AS cnee_name
            FROM house_bill a LEFT JOIN client cus ON cus.customer_id = a.customer_id
            LEFT JOIN client shp ON shp.customer_id = a.shipper_id
            LEFT JOIN client cnee ON cnee.customer_id = a.consignee_id""", "house_bill", "client"),
        "origin_destination": with_roles(
            f""" SELECT {house}, d.code AS org_code, d.name AS org_name, e.code AS des_code,
            e.name AS des_name FROM house_bill a LEFT JOIN city d ON d.id = a.origin_city
            LEFT JOIN city e ON e.id = a.dest_city""", "house_bill", "city"),
        "consignee_country": with_roles(
            f""" SELECT {house}, j.name AS cnee_name, n_name AS cnee_country_name FROM house_bill a
            LEFT JOIN client j ON j.customer_id = a.consignee_id
            LEFT JOIN nation ON n_nationkey = j.country_id""", "house_bill", "client"),
        "master_bill": with_roles(
            f""" SELECT {house}, CASE a.mode WHEN '3A' THEN a.master_no ELSE (SELECT g.master_no
                FROM master g WHERE g.mode = a.mode AND g.master_id = a.master_id
                    AND g.station = a.station) END AS master_no FROM house_bill a""",
            "house_bill", "master"),
        "unused_join_free": with_roles(
            """ SELECT DISTINCT h.mode, h.lot, s.code AS shp_code, a.trade_term
            FROM house_bill a JOIN invoice_header h ON h.mode = a.mode AND h.source_id = a.source_id
                AND h.station = a.station
            LEFT JOIN client b ON b.customer_id = a.shipper_id
            LEFT JOIN client f ON f.customer_id = a.customer_id
            LEFT JOIN client s ON s.customer_id = a.shipper_id""",
            "house_bill", "invoice_header", "client"),
        "latest_eta": with_roles(
            f""" SELECT a.mode, a.master_id, {top_booking("b.etd")} AS etd, {top_booking("b.eta", "eta")} AS eta
            FROM (SELECT DISTINCT mode, master_id, station FROM booking) a""", "booking"),
        "latest_milestone": with_roles(
            f""" SELECT a.key, {newest_milestone(1100, key="a.key")} AS departed,
            {newest_milestone(1300, key="a.key")} AS landed
            FROM (SELECT DISTINCT key FROM milestone WHERE milestone_id IN (1100, 1300)) a""", "milestone"),
        "milestone_any": with_roles(
            " SELECT a.key, " + ", ".join(
                newest_milestone(n, more=" AND m.product_line = 2 AND m.status = 1", key="a.key") + f" AS {name}"
                for name, n in {"shipped": 500, "delivered": 2970, "arrived": 3000}.items())
            + """ FROM (SELECT DISTINCT key FROM milestone WHERE milestone_id IN (500, 2970, 3000)
                AND product_line = 2 AND status = 1) a""", "milestone"),
        "exchange_rate": with_roles(
            " SELECT invoice_no, station, min(rate) AS rate FROM invoice_line GROUP BY ALL", "invoice_line"),
        "invoice_currency": with_roles(
            """ SELECT a.*, (SELECT DISTINCT t.currency FROM invoice_line t WHERE t.invoice_no = a.invoice_no
                AND t.temp_seq = a.temp_seq AND t.station = a.station ORDER BY 1 LIMIT 1) AS currency
            FROM (SELECT DISTINCT invoice_no, temp_seq, station FROM invoice_line) a""", "invoice_line"),
        "charge_sum_direct": direct_sums({"": "amount"}),
        "charge_two_measures": direct_sums({"": "amount", "_local": "local_equiv"}),
        "charge_sum_cached": with_roles(
            " SELECT a.invoice_no, " + ", ".join(
                f"CAST({line_sum('line_amount', codes, 'cache', 'a', LINE_KEYS)} AS DECIMAL(38,2)) AS {name}"
                for name, codes in {"freight": "13", "fuel": "14", "security": "15",
                                    "export_handling": "380", "import_handling": "5"}.items())
            + """, (SELECT min(t.currency) FROM cache t WHERE t.invoice_no = a.invoice_no
                AND t.temp_seq = a.temp_seq AND t.station = a.station) AS currency
            FROM (SELECT DISTINCT invoice_no, temp_seq, station FROM cache WHERE charge_id IS NOT NULL) a""",
            "cache"),
        "charge_bucket": with_roles(
            f""" SELECT a.invoice_no,
            {line_sum("amount", "12, 21, 22, 73, 257, 114, 35", "invoice_line", "a", LINE_KEYS)} AS other
            FROM (SELECT DISTINCT invoice_no, temp_seq, station FROM invoice_line
                WHERE charge_id IN (12, 21, 22, 73, 257, 114, 35)) a""", "invoice_line"),
        "distinct_countries": with_roles(
            """ SELECT DISTINCT (SELECT left(y.code, 2) FROM city y WHERE y.id = CAST(l_quantity AS BIGINT))
                AS country_code FROM lineitem""", "city"),
        "change_counts": with_roles(
            """, per AS (
                SELECT o.house_no, CAST(1 AS BIGINT) AS opened,
                    (SELECT count(*) FROM typed t WHERE t.house_no = o.house_no) AS documents,
                    (SELECT count(*) FROM changed c WHERE c.house_no = o.house_no) AS changed
                FROM opened o)
            SELECT * FROM per UNION ALL
            SELECT '(all)', CAST(sum(opened) AS BIGINT), CAST(sum(documents) AS BIGINT),
                CAST(sum(changed) AS BIGINT) FROM per""", "opened", "typed", "changed"),
        "union_distinct_modes": with_roles(
            " UNION ".join(f" SELECT lot, customer_id, id_type, '{m}' AS mode FROM invoice_header "
                           f"WHERE mode = '{m}'" for m in ("AE", "AI", "3A")), "invoice_header"),
        "union_all_modes": with_roles(
            " UNION ALL ".join(f" SELECT lot, customer_id, id_type, '{m}' AS mode FROM invoice_header "
                               f"WHERE mode = '{m}'" for m in ("AE", "AI", "3A")), "invoice_header"),
        "page_concat": with_roles(
            " UNION ALL ".join([
                page_form("lines", "coalesce(text, '')", "chr(10)"),
                page_form("upper", "CASE WHEN coalesce(text, '') <> '' THEN upper(replace(text, 'ß', 'ss')) || ' ' "
                                   "ELSE '' END", "''"),
                page_form("plain", "upper(replace(coalesce(text, ''), 'ß', 'ss'))", "''")]), "page"),
        "content_rules": f"""SELECT doc_id, {CONTENT_CASE} AS new_type
            FROM (SELECT doc_id, upper(text) AS content FROM documents)""",
        # One search a word and text, whatever their number.
        "keyword_list": """WITH letter AS (SELECT unnest(range(1, 11)) AS i),
            word AS (SELECT 100 * (a.i - 1) + 10 * (b.i - 1) + c.i - 1 AS rule,
                         substr('EISNRATULO', a.i, 1) || substr('EISNRATULO', b.i, 1) || substr('EISNRATULO', c.i, 1)
                             || CASE c.i % 2 WHEN 1 THEN 'X' ELSE 'Q' END AS word
                     FROM letter a, letter b, letter c),
            content AS (SELECT doc_id, upper(replace(text, 'ß', 'ss')) AS content FROM documents)
            SELECT d.doc_id, CAST(min(w.rule) AS INTEGER) AS rule,
                CASE WHEN min(w.rule) IS NULL THEN 'Others' ELSE 'Type ' || (min(w.rule) % 7) END AS new_type
            FROM content d LEFT JOIN word w ON contains(d.content, w.word) GROUP BY d.doc_id""",
        "keyword_spread": """WITH letter AS (SELECT unnest(string_split('E,I,N,R,S,T', ',')) AS x),
            word AS (SELECT a.x || b.x AS word FROM letter a, letter b
                     UNION ALL SELECT a.x || b.x || c.x FROM letter a, letter b, letter c),
            content AS (SELECT upper(replace(text, 'ß', 'ss')) AS content FROM documents)
            SELECT word, count(*) AS documents FROM content JOIN word ON contains(content, word) GROUP BY word""",
        "content_rules_listed": f"""SELECT doc_id, CASE WHEN contains(content, 'PERMIT NO') THEN 'Export Customs'
                WHEN contains(content, 'CONTRACT OF PURCHASE AND SALE') THEN 'Commercial Invoice'
                WHEN contains(content, 'DECLARATION') THEN 'Others'
                WHEN contains(content, 'COMMERCIAL INVOICE') THEN 'Commercial Invoice'
                WHEN contains(content, 'TAX INVOICE') THEN 'Commercial Invoice'
                WHEN contains(content, 'PACKING LIST') THEN 'Packing List'
                WHEN contains(content, 'PACKING SLIP') THEN 'Packing List'
                WHEN contains(content, 'PACKING') THEN 'Packing List'
                WHEN contains(content, 'PACKLIST') THEN 'Packing List'
                WHEN contains(content, 'INVOICE') THEN 'Commercial Invoice'
                WHEN contains(content, 'ACME INVOICE') THEN 'Acme Invoice' END AS new_type
            FROM ({KEYWORDED})""",
        "older_rules_listed": f"""SELECT doc_id, CASE WHEN contains(content, 'COMMERCIAL INVOICE') THEN 'Commercial Invoice'
                WHEN contains(content, 'PACKING LIST') THEN 'Packing List'
                WHEN contains(content, 'PERMIT') THEN 'Export Permit'
                WHEN contains(content, 'ACME INVOICE') THEN 'Acme Invoice'
                WHEN contains(content, 'INVOICE') THEN 'Commercial Invoice' ELSE 'Others' END AS new_type
            FROM ({KEYWORDED})""",
        "name_equals_key": with_roles(
            """ SELECT doc_id, coalesce(trim(replace(upper(trim(file_name)), '.PDF', '')) = upper(house_no),
                false) AS named_after_key FROM document""", "document"),
        "doc_cascade": with_roles(" SELECT doc_id, house_no, file_name, new_type FROM typed", "typed"),
        "empty_text_skip": """
            SELECT part, count(*) FILTER (WHERE body <> '') AS read, count(*) FILTER (WHERE body = '') AS skipped
            FROM (SELECT lang AS part, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS body
                  FROM documents
                  UNION ALL
                  SELECT role, CASE WHEN turn = 2 THEN ''
                      ELSE trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) END FROM conversations)
            GROUP BY part""",
        "name_prefix_rules": """
            SELECT p_partkey, CASE WHEN starts_with(upper(trim(p_type)), 'ECO') THEN 'HAWB'
                WHEN substr(upper(trim(p_type)), 1, 2) IN ('II', 'ME', 'IN', 'IZ', 'IR', 'IM', 'IT', 'ID',
                    'IG', 'OO', 'OD', 'OT', 'TT', 'TW') THEN 'Import Customs' END AS new_type
            FROM part""",
        "keyword_flags": with_roles(
            """, whole AS (SELECT doc_id, upper(string_agg(coalesce(text, ''), chr(10) ORDER BY page_no)) AS text
                FROM page GROUP BY doc_id)
            SELECT doc_id, contains(text, 'THE') AS own, contains(text, 'CH') AS packing,
                contains(text, 'IN') AS invoice,
                CASE WHEN contains(text, 'THE') THEN 'Acme Invoice'
                     WHEN contains(text, 'IN') AND contains(text, 'CH') THEN 'Commercial Invoice'
                     WHEN contains(text, 'CH') THEN 'Packing List'
                     WHEN contains(text, 'IN') THEN 'Commercial Invoice' END AS new_type
            FROM whole""", "page"),
        "rules_with_default": with_roles(
            """, whole AS (SELECT doc_id, string_agg(CASE WHEN coalesce(text, '') <> ''
                    THEN upper(text) || ' ' ELSE '' END, '' ORDER BY page_no) AS text
                FROM page GROUP BY doc_id)
            SELECT doc_id, 'hawb' || CAST(doc_id * 7 AS VARCHAR) || '.pdf' AS file_name,
                CASE WHEN doc_id * 7 >= 100 THEN 'HAWB' WHEN contains(text, 'THE ') THEN 'Packing List'
                     WHEN contains(text, 'ION') THEN 'Export Permit' ELSE 'Others' END AS new_type
            FROM whole""", "page"),
        "permit_check": """
            SELECT doc_id, CASE WHEN contains(upper(text), 'PERMIT') THEN 'Export Permit' END AS permit,
                CASE WHEN contains(upper(text), 'LICENSE') THEN 'Export Permit' END AS licence
            FROM documents""",
        "type_changes": with_roles(" SELECT * FROM changed", "changed"),
        "weight_report": with_roles(
            " UNION ".join(weight_branch(m) for m in ("AE", "AI", "3A")),
            "cache", "house_bill", "booking", "master", "client", "city", "milestone"),
        "invoice_report_range": with_roles(
            invoice_branches(True), *INVOICE_ROLES),
        "invoice_report_all": with_roles(
            invoice_branches(False), *INVOICE_ROLES),
        "doc_sort_report": with_roles(
            " SELECT * FROM changed WHERE house_no IN (SELECT house_no FROM opened)", "changed", "opened"),
    }
    latest = with_roles(
        f""" SELECT a.mode, a.master_id, {top_booking("b.etd")} AS etd, {top_booking("b.flight")} AS flight,
        {top_booking("substr(b.flight, 1, 2)")} AS airline
        FROM (SELECT DISTINCT mode, master_id, station FROM booking) a""", "booking")
    out |= {"latest_booking": latest, "top1_window": latest}
    return out | {name: out[other] for name, other in SAME_ROWS.items()}
