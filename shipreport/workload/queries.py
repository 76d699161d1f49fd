"""Named queries: each operator and report over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipreport.functions import dates, keywords, text
from shipreport.operators import charges, documents, filters, joins, lookups, stacking
from shipreport.plans import invoices, sorting, weight
from shipreport.plans.common import MASTER, SHIPMENT, houses_of
from shipreport.plans.modes import AIR_MODES
from shipreport.sources import contracts
from shipreport.sources.changelog import change_log as log_rows
from shipreport.sources.charge_store import ChargeStore
from shipreport.sources.folders import shared_folder
from shipreport.sources.layout import Laid, co_located, lay_out
from shipreport.sources.reuse import holding
from shipreport.sources.stations import run_sql
from shipreport.streaming.sorting import document_stream, read_sorted, sort_stream
from shipreport.workload import roles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE_KEYS = ["invoice_no", "temp_seq", "station"]
BILLING = invoices.Billing(
    roles.CUSTOMER_CODE, roles.BILL_TO_CODE,
    {"CarrierID": "CARR", "ClientID": "CLNT", "Bill To Account": "ACCT", "Currency": "SGD",
     "Bill To Company": "Example Pte Ltd", "Bill To City": "Exampletown", "Bill To Country": "SG"})
SHIPPED, DELIVERED, ARRIVED = 500, 2970, 3000


def query(fn: Callable[[roles.Roles], DataFrame]) -> Callable[[roles.Roles], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(roles.Roles(spark, sf_dir))
    return fn


def _headers(r):
    return r.invoice_header()


def _lines(r):
    return r.invoice_line()


def _houses(r):
    return houses_of({f"house_{m.code}": r.houses(m.code) for m in AIR_MODES}, AIR_MODES)


def _bookings(r):
    return stacking.stack_modes({m: r.bookings(m) for m in ("AE", "AI")})


def _masters(r):
    found = stacking.stack_modes({m: r.masters() for m in ("AE", "AI")})
    return found.withColumnRenamed("id", "master_id")


def _eligible(r):
    return filters.eligible_invoices(
        _headers(r), ["AMS", "3PS"], ["AE", "AI", "3A"], r.listed_customers(),
        roles.START, roles.END)


# Scans, sources, sinks


@query
def station_scan(r):
    """All order rows of the station, found through the station map."""
    return r.stations.table(r.spark, "st1 ", "orders").withColumn("station", F.lit(roles.STATION))


@query
def master_scan(r):
    """Events with the shared city table's name for their user's city."""
    nations = r.stations.shared(r.spark, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("user_id"), F.col("n_name").alias("city"))
    events = r.stations.table(r.spark, roles.STATION, "events")
    return joins.attach(events.select("event_id", "user_id", "event_type"), nations, ["user_id"])


@query
def invoice_lines_cached(r):
    """The intermediate of the weight report: eligible headers with their lines."""
    headers = _eligible(r).select(*LINE_KEYS, "source_id", "mode", "lot", "invoice_date")
    lines = _lines(r).select(*LINE_KEYS, "charge_id", F.col("amount").alias("line_amount"), "currency")
    return charges.invoice_lines(headers, lines, LINE_KEYS)


@query
def param_query(r):
    """SQL with typed named parameters."""
    return run_sql(
        r.spark,
        """SELECT mode, invoice_date, count(*) AS invoices, sum(amount) AS amount
           FROM {headers} WHERE invoice_date BETWEEN :start AND :end
           GROUP BY mode, invoice_date""",
        {"start": roles.START, "end": roles.END},
        headers=_headers(r))


@query
def typed_result(r):
    """Invoice lines under a declared result."""
    return contracts.to_contract(_lines(r), [
        ("invoice_no", "string"), ("charge_id", "bigint"), ("amount", "decimal(18,2)"),
        ("local_equiv", "decimal(18,2)"), ("rate", "decimal(18,6)"), ("currency", "string")])


@query
def string_result(r):
    """House bills and bookings as text only."""
    rows = joins.attach(_bookings(r), _masters(r), MASTER)
    return contracts.to_strings(rows, ["mode", "master_id", "etd", "eta", "flight", "master_no"])


@query
def change_log(r):
    """The change log under its headings."""
    return log_rows(_changes(r))


# Projections and scalar expressions


@query
def constant_columns(r):
    rows = _headers(r).select("source_id", "invoice_no")
    return contracts.with_constants(rows, {"unit": "K", "service": "LTL", "volume": "", "tax": ""})


@query
def report_aliases(r):
    return contracts.rename(_houses(r), {
        "house_no": "HAWB", "gross_wt": "TTL G.W", "pcs": "Notes1 (Pallets)", "master_no": "Master Inv No."})


@query
def pieces_by_unit(r):
    pcs, uom = F.col("pcs"), F.col("pcs_uom")
    return _houses(r).select(
        "mode", "source_id", "house_no", "pcs",
        text.pieces_by_unit(pcs, uom, "PLT").alias("pallets"),
        text.pieces_by_unit(pcs, uom, "ctn ").alias("cartons"))


@query
def pieces_label(r):
    args = F.col("pcs"), F.col("pcs_uom"), F.col("sp_unit"), F.col("sp_unit_uom")
    return _houses(r).select(
        "mode", "source_id", "house_no", "gross_wt",
        text.pieces_label(*args).alias("label"), text.pieces_label(*args[:2]).alias("short_label"),
        text.to_text(F.col("volume_wt")).alias("volume_text"))


@query
def address_concat(r):
    joined = text.join_text(F.col("address1"), F.col("address2"))
    return r.customers().select("customer_id", joined.alias("address"))


@query
def code_parts(r):
    city, flight = F.col("origin_code"), F.col("flight")
    rows = joins.with_roles(_houses(r), r.cities(), "id",
                            {"origin": "origin_city"}, ["code"])
    return rows.select(
        "mode", "source_id", "house_no", "flight",
        text.left_chars(city, 2).alias("country"), text.right_chars(city, 3).alias("city"),
        text.left_chars(flight, 2).alias("airline"))


@query
def date_text(r):
    return _bookings(r).select(
        "mode", "master_id", "flight", dates.fmt_date(F.col("etd")).alias("etd_date"),
        dates.fmt_date(F.col("eta")).alias("eta_date"))


@query
def time_text(r):
    return r.milestones().select("id", dates.fmt_time(F.col("time")).alias("clock"))


@query
def ship_day(r):
    return r.milestones().select("id", dates.day_of(F.col("time")).alias("day"))


@query
def delivery_date(r):
    """Delivery milestone, else arrival, for every house bill."""
    found = lookups.latest_milestones(
        r.milestones(), {"delivered": DELIVERED, "arrived": ARRIVED})
    rows = _houses(r).select("mode", "source_id", F.col("house_no").alias("key"))
    return joins.attach(rows, found, ["key"]).select(
        "mode", "source_id", "key",
        lookups.first_of(F.col("delivered"), F.col("arrived")).alias("delivery_date"))


@query
def nonblank_invoices(r):
    rows = _headers(r).where(text.not_blank(F.col("invoice_no")))
    return rows.select("source_id", "invoice_no", text.is_blank(F.col("ref_invoice_no")).alias("no_reference"))


@query
def norm_file_name(r):
    return r.documents().select(
        "doc_id", text.norm_name(F.col("file_name")).alias("name"),
        text.clean_type(F.col("current_type")).alias("stored_type"))


@query
def key_slice_match(r):
    match = text.slice_match(F.col("file_name"), F.col("house_no"))
    return r.documents().select("doc_id", "house_no", match.alias("matches"))


@query
def last_week_window(r):
    """The last full week before each order date."""
    day = F.col("o_orderdate").cast("date")
    first, last = dates.last_week(day)
    return r.table("orders").select(
        "o_orderkey", day.alias("day"), first.alias("from_day"), last.alias("to_day"))


@query
def country_of_city(r):
    rows = _houses(r).select("mode", "source_id", "house_no", "dest_city")
    return joins.country_of_city(rows, r.cities(), "dest_city")


# Filters and predicates


@query
def eligible_invoices(r):
    return _eligible(r).select("source_id", "mode", "invoice_no", "customer_id", "invoice_date", "amount")


@query
def customer_in_list(r):
    rows = joins.in_list(_headers(r), "customer_id", r.listed_customers())
    return rows.select("source_id", "customer_id")


@query
def invoice_date_range(r):
    rows = _headers(r).where(filters.date_range("invoice_date", roles.START, roles.END))
    return rows.select("source_id", "invoice_date")


@query
def not_void(r):
    rows = _houses(r).where(filters.not_void("status"))
    return rows.select("mode", "source_id", "house_no", "status")


@query
def no_credit_notes(r):
    rows = _headers(r).where(filters.not_credit_note("invoice_no"))
    return rows.select("source_id", "invoice_no")


@query
def filter_by_code(r):
    rows = joins.filter_by_code(
        _headers(r), r.customers(), "customer_id", "bill_to",
        text.code_eq(F.col("code"), "machinery "))
    return rows.select("source_id", "bill_to", "amount")


@query
def etd_window(r):
    first, last = dates.last_week_of(roles.SORT_DAY)
    return filters.etd_window(r.shipments(), "etd", first, last)


# Joins


@query
def header_lines(r):
    headers = _headers(r).select(*LINE_KEYS, "source_id", "invoice_date")
    lines = _lines(r).select(*LINE_KEYS, "charge_id", "amount", "local_equiv")
    return joins.fan_out(headers, lines, LINE_KEYS)


@query
def house_bill_by_mode(r):
    """Every invoice with its house bills of its own mode."""
    rows = _headers(r).select(*SHIPMENT, "invoice_no", "amount")
    bills = _houses(r).select(*SHIPMENT, "house_no", "gross_wt", "pcs")
    return joins.fan_out(rows, bills, SHIPMENT)


def _laid(r, rows, keys, date=None) -> Laid:
    folder = shared_folder(r.spark, "laid")
    name = "laid_" + folder.rsplit("-", 1)[1]
    return lay_out(rows, name, folder, keys, int(r.spark.conf.get("spark.sql.shuffle.partitions")), date)


@query
def bucketed_header_lines(r):
    """``header_lines`` over tables in buckets of the invoice key."""
    headers = _laid(r, _headers(r).select(*LINE_KEYS, "source_id", "invoice_date"), LINE_KEYS, "invoice_date")
    return co_located(headers, _laid(r, _lines(r).select(*LINE_KEYS, "charge_id", "amount", "local_equiv"), LINE_KEYS))


@query
def bucketed_house_bills(r):
    """``house_bill_by_mode`` over tables in buckets of the shipment key."""
    rows = _laid(r, _headers(r).select(*SHIPMENT, "invoice_no", "amount"), SHIPMENT)
    return co_located(rows, _laid(r, _houses(r).select(*SHIPMENT, "house_no", "gross_wt", "pcs"), SHIPMENT))


@query
def partitioned_date_range(r):
    """``invoice_date_range`` from the folders of its months."""
    rows = _laid(r, _headers(r).select(*LINE_KEYS, "source_id", "invoice_date"), LINE_KEYS, "invoice_date")
    return rows.between("invoice_date", roles.START, roles.END).select("source_id", "invoice_date")


@query
def on_condition_join(r):
    """House bills with those invoices that meet the conditions of the join."""
    kept = _headers(r).where(
        text.code_eq(F.col("product_line"), "AMS") & filters.billable())
    bills = _houses(r).select(*SHIPMENT, "house_no", "gross_wt")
    return joins.fan_out(bills, kept.select(*SHIPMENT, "invoice_no", "amount"), SHIPMENT)


@query
def customer_roles(r):
    """House bills with their customer, shipper and consignee, all from one table."""
    rows = joins.with_roles(
        _houses(r), r.customers(), "customer_id",
        {"cus": "customer_id", "shp": "shipper_id", "cnee": "consignee_id"}, ["code", "name"])
    return rows.select("mode", "source_id", "house_no", "cus_code", "cus_name", "shp_code",
                       "shp_name", "cnee_code", "cnee_name")


@query
def customer_roles_once(r):
    """``customer_roles`` by one join for all roles."""
    rows = joins.with_roles_once(
        _houses(r).select("mode", "source_id", "house_no", "customer_id", "shipper_id", "consignee_id"), r.customers(), "customer_id",
        {"cus": "customer_id", "shp": "shipper_id", "cnee": "consignee_id"}, ["code", "name"])
    return rows.drop("customer_id", "shipper_id", "consignee_id")


@query
def origin_destination(r):
    rows = joins.with_roles(_houses(r), r.cities(), "id",
                            {"org": "origin_city", "des": "dest_city"}, ["code", "name"])
    return rows.select("mode", "source_id", "house_no", "org_code", "org_name", "des_code", "des_name")


@query
def consignee_country(r):
    named = joins.with_country(r.customers(), r.countries())
    rows = joins.with_roles(_houses(r), named, "customer_id", {"cnee": "consignee_id"},
                            ["name", "country_name"])
    return rows.select("mode", "source_id", "house_no", "cnee_name", "cnee_country_name")


@query
def master_bill(r):
    """The master bill's number, or the house bill's own in third-party mode."""
    bills = _houses(r).withColumnRenamed("master_no", "own_no")
    own = bills.where("mode = '3A'")
    booked = joins.attach(bills.where("mode <> '3A'"), _masters(r), MASTER)
    return booked.select("mode", "source_id", "house_no", "master_no").unionByName(
        own.select("mode", "source_id", "house_no", F.col("own_no").alias("master_no")))


@query
def unused_join_free(r):
    """Distinct codes and lots without the joins that nothing is taken from."""
    bills = joins.with_roles(_houses(r), r.customers(), "customer_id",
                             {"shp": "shipper_id"}, ["code"])
    rows = joins.fan_out(_headers(r).select(*SHIPMENT, "lot"),
                         bills.select(*SHIPMENT, "shp_code", "trade_term"), SHIPMENT, "inner")
    return rows.select("mode", "lot", "shp_code", "trade_term").distinct()


# Latest row per key


@query
def latest_booking(r):
    found = lookups.latest_by(_bookings(r), MASTER, "etd", ["flight"])
    return found.select("mode", "master_id", "etd", "flight",
                        text.left_chars(F.col("flight"), 2).alias("airline"))


@query
def latest_eta(r):
    """Latest departure and, from its own order, latest arrival in one aggregation."""
    found = lookups.latest_by(_bookings(r), MASTER, "etd", ["flight"], greatest=["eta"])
    return found.select("mode", "master_id", "etd", "eta")


@query
def latest_milestone(r):
    return lookups.latest_milestones(r.milestones(), {"departed": 1100, "landed": 1300})


@query
def milestone_any(r):
    return lookups.any_milestones(
        r.milestones(),
        {"shipped": SHIPPED, "delivered": DELIVERED, "arrived": ARRIVED}, 2, 1)


@query
def exchange_rate(r):
    return lookups.any_of(_lines(r), ["invoice_no", "station"], "rate")


@query
def invoice_currency(r):
    return lookups.any_of(_lines(r), LINE_KEYS, "currency")


@query
def top1_window(r):
    """``latest_booking`` as a window."""
    return lookups.top1(_bookings(r), MASTER, "etd", ["flight"]).select(
        "mode", "master_id", "etd", "flight", text.left_chars(F.col("flight"), 2).alias("airline"))


# Aggregations


DIRECT_CHARGES = {
    "freight": ("amount", [13]), "fuel": ("amount", [14]), "security": ("amount", [15]),
    "origin_terminal": ("amount", [400]), "dest_terminal": ("amount", [5]),
    "delivery": ("amount", [113]), "customs": ("amount", [1])}


@query
def charge_sum_direct(r):
    sums = charges.charge_pivot(_lines(r), ["invoice_no", "station"], DIRECT_CHARGES)
    rows = _headers(r).select("source_id", "invoice_no", "station")
    return joins.attach(rows, sums, ["invoice_no", "station"]).drop("station")


@query
def charge_sum_stored(r):
    """``charge_sum_direct`` from stored sums, brought up to date for the months that lines arrived in."""
    headers = _headers(r).select("source_id", "invoice_no", "station", "invoice_date")
    keys = ("invoice_no", "station")
    lines = _lines(r).select(*keys, "charge_id", "amount")
    early = headers.where(F.col("invoice_date") < roles.END).select(*keys)
    # All lines of earlier invoices, and some of later ones, are there first.
    known = joins.flag_known(lines, early, keys, "early")
    first = known.where("early OR charge_id IN (13, 14)").drop("early")
    store = ChargeStore(r.spark, shared_folder(r.spark, "charges"), keys, DIRECT_CHARGES)
    store.refresh(headers, first)
    arrived = known.where("NOT early AND charge_id NOT IN (13, 14)").drop("early")
    store.refresh(headers, lines, store.touched(headers, arrived))
    return joins.attach(headers.select("source_id", *keys), store.read(), keys).drop("station")


@query
def charge_two_measures(r):
    measures = {}
    for name, code in {"freight": 13, "fuel": 14, "security": 15, "origin_terminal": 400,
                       "dest_terminal": 5, "delivery": 113, "customs": 1}.items():
        measures[name] = ("amount", [code])
        measures[f"{name}_local"] = ("local_equiv", [code])
    sums = charges.charge_pivot(_lines(r), ["invoice_no", "station"], measures)
    rows = _headers(r).select("source_id", "invoice_no", "station")
    return joins.attach(rows, sums, ["invoice_no", "station"]).drop("station")


@query
def charge_sum_cached(r):
    """Sums over the header and line pairs of eligible invoices."""
    return charges.cached_charges(
        _eligible(r), _lines(r), LINE_KEYS,
        {"freight": ("amount", [13]), "fuel": ("amount", [14]), "security": ("amount", [15]),
         "export_handling": ("amount", [380]), "import_handling": ("amount", [5])},
        least={"currency": "currency"}).drop("station", "temp_seq")


@query
def charge_bucket(r):
    return charges.charge_pivot(_lines(r), LINE_KEYS, {
        "other": ("amount", weight.CHARGES["Other"])}).select("invoice_no", "other")


@query
def distinct_countries(r):
    """Country codes of the delivery cities of ocean bills."""
    # One row per city is enough to know its country.
    bills = r.ocean_bills().select("delivery_city").distinct()
    rows = joins.country_of_city(bills, r.cities(), "delivery_city")
    return rows.select("country_code").distinct()


@query
def change_counts(r):
    """Documents and changes of each shipment of the week, and in all."""
    return sorting.doc_sort_counts(
        r.shipments(), r.documents(), roles.SORT_DAY, roles.FORWARDER, roles.TEXT_RULES, total="(all)")


# Set operations


def _branches(r):
    rows = _headers(r)
    return {m.code: rows.where(F.col("mode") == m.code).select("lot", "customer_id", "id_type")
            for m in AIR_MODES}


@query
def union_distinct_modes(r):
    return stacking.union_modes(_branches(r), distinct=True)


@query
def union_all_modes(r):
    return stacking.union_modes(_branches(r), distinct=False)


# Documents


RULES = documents.for_forwarder(roles.TEXT_RULES, roles.FORWARDER)
OWN_TYPE = f"{roles.FORWARDER} Invoice"


def _texts(r):
    return r.table("documents").select("doc_id", F.upper("text").alias("content"))


def _changes(r):
    typed = documents.cascade(r.documents(), RULES, OWN_TYPE)
    return documents.type_changes(typed)


@query
def page_concat(r):
    """The page texts of each document in every form."""
    forms = ("lines", "upper", "plain")
    whole = documents.page_forms(r.pages(), "doc_id", "page_no", "text", forms)
    each = F.explode(F.array(*[F.struct(F.col(f).alias("text"), F.lit(f).alias("form")) for f in forms]))
    return whole.select("doc_id", each.alias("found")).select("doc_id", "found.text", "found.form")


@query
def content_rules(r):
    return _texts(r).select(
        "doc_id", documents.content_type(F.col("content"), RULES).alias("new_type"))


@query
def content_rules_listed(r):
    """The content rules as they stand, over texts that hold their keywords."""
    rules = documents.for_forwarder(documents.CONTENT_RULES, roles.FORWARDER)
    return r.keyworded_texts().select("doc_id", documents.content_type(F.col("content"), rules).alias("new_type"))


@query
def older_rules_listed(r):
    """The older content rules as they stand, with their default."""
    rules = documents.for_forwarder(documents.OLDER_CONTENT_RULES, roles.FORWARDER)
    found = documents.content_type(F.col("content"), rules, "Others")
    return r.keyworded_texts().select("doc_id", found.alias("new_type"))


@query
def keyword_list(r):
    """A list of 1,000 rules over every text, in one pass."""
    content = F.col("content")
    return _texts(r).select("doc_id", keywords.first_rule(content, roles.LONG_RULES).alias("rule"),
                            documents.content_type(content, roles.LONG_RULES, "Others").alias("new_type"))


@query
def keyword_spread(r):
    """How many documents hold each of 252 keywords, of which some begin others."""
    return documents.keyword_spread(_texts(r), F.col("content"), roles.SHORT_WORDS)


@query
def name_equals_key(r):
    match = documents.name_equals_key(F.col("file_name"), F.col("house_no"))
    return r.documents().select("doc_id", match.alias("named_after_key"))


@query
def doc_cascade(r):
    typed = documents.cascade(r.documents(), RULES, OWN_TYPE)
    return typed.select("doc_id", "house_no", "file_name", "new_type")


@query
def empty_text_skip(r):
    """Documents and pages with a text, and how many have none, per language or role."""
    docs = r.table("documents").select(F.col("lang").alias("part"), "text")
    pages = r.table("conversations").select(
        F.col("role").alias("part"), F.expr("CASE WHEN turn = 2 THEN ' \n' ELSE text END").alias("text"))
    empty = documents.is_empty(F.col("text")).cast("int")
    return docs.unionAll(pages).groupBy("part").agg(
        F.sum(1 - empty).alias("read"), F.sum(empty).alias("skipped"))


@query
def name_prefix_rules(r):
    return r.table("part").select(
        "p_partkey", documents.name_prefix_type(F.col("p_type"), "eco").alias("new_type"))


@query
def keyword_flags(r):
    """Types from keywords on any page, without joining the pages."""
    flags = documents.keyword_flags(
        r.pages(), ["doc_id"], "text", {"own": "THE", "packing": "CH", "invoice": "IN"})
    found = documents.flag_type(F.col("own"), F.col("packing"), F.col("invoice"), OWN_TYPE)
    return flags.select("doc_id", "own", "packing", "invoice", found.alias("new_type"))


@query
def rules_with_default(r):
    """House-bill name, else content rules with a default, over the joined pages."""
    whole = documents.page_concat(r.pages(), "doc_id", "page_no", "text", "upper")
    name = F.expr("'hawb' || (doc_id * 7) || '.pdf'")
    rules = documents.for_forwarder([("THE ", "Packing List"), ("ION", "Export Permit")], roles.FORWARDER)
    found = F.when(documents.numbered_name(name), "HAWB").otherwise(
        documents.content_type(F.col("text"), rules, "Others"))
    return whole.select("doc_id", name.alias("file_name"), found.alias("new_type"))


@query
def permit_check(r):
    permit = documents.content_type(F.col("content"), [("PERMIT", "Export Permit")])
    licence = documents.content_type(F.col("content"), [("LICENSE", "Export Permit")])
    return _texts(r).select("doc_id", permit.alias("permit"), licence.alias("licence"))


@query
def type_changes(r):
    return _changes(r)


# Whole reports


@query
def weight_report(r):
    return weight.weight_rows(
        r.tables(), roles.START, roles.END, r.listed_customers(),
        roles.FORWARDER.upper())


@query
def invoice_report_range(r):
    rows = invoices.invoice_rows(r.tables(), BILLING, roles.START, roles.END)
    return holding(contracts.to_strings(rows, invoices.COLUMNS), rows)


@query
def invoice_report_all(r):
    return invoices.invoice_rows(r.tables(), BILLING)


@query
def doc_sort_report(r):
    return sorting.doc_sort_report(
        r.shipments(), r.documents(), roles.SORT_DAY, roles.FORWARDER,
        roles.TEXT_RULES)


@query
def doc_sort_stream(r):
    """``doc_sort_report`` as a stream over the document files."""
    place = shared_folder(r.spark, "sorting")
    sort_stream(document_stream(r.spark, r.path("documents")), r.documents, r.shipments(), roles.SORT_DAY, roles.FORWARDER,
                f"{place}/log", f"{place}/checkpoint", "first", roles.TEXT_RULES)
    return read_sorted(r.spark, f"{place}/log", "first")
