"""Station routing, result contracts, the change log."""

from collections import Counter
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from fixtures import at, frame, money, random_rows
from shipreport.plans.invoices import COLUMNS, Billing, invoice_report
from shipreport.plans.weight import CONTRACT, weight_report, weight_rows
from shipreport.sources import changelog, contracts
from shipreport.sources.reuse import holding, shared
from shipreport.sources.schemas import MASTER_TABLES, SCHEMAS, STATION_TABLES
from shipreport.sources.stations import Stations, canonical, run_sql

START, END = at("2024-03-04"), at("2024-03-15")


def write_physical(rows, specs, folder):
    """Canonical rows as the physical tables that would give them."""
    folder.mkdir()
    for key, (schema, table, columns) in specs.items():
        kinds = {f.name: f for f in to_arrow_schema(SCHEMAS[schema])}
        physical = {p: kinds[c].type for c, p in columns.items()}
        data = [{p: r.get(c) for c, p in columns.items()} for r in rows.get(key, [])]
        pq.write_table(pa.Table.from_pylist(data, schema=pa.schema(list(physical.items()))),
                       folder / f"{table}.parquet")


@pytest.fixture(scope="module")
def two_stations(tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    write_physical(random_rows(21, 200), STATION_TABLES, base / "sg")
    write_physical(random_rows(22, 200), STATION_TABLES, base / "my")
    write_physical(random_rows(21, 200), MASTER_TABLES, base / "shared")
    return Stations({"SG": f"{base}/sg/{{table}}.parquet", "MY": f"{base}/my/{{table}}.parquet"},
                    master=f"{base}/shared/{{table}}.parquet")


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_reports_of_a_station(spark, two_stations):
    args = (START, END, [1, 2], "ACME")
    reports = {s: bag(weight_report(spark, two_stations, s, *args)) for s in ("SG", "my ")}
    assert reports["SG"] == bag(weight_rows(two_stations.tables(spark, "sg"), *args))
    assert reports["SG"] != reports["my "] and all(reports.values())
    billing = Billing("CODE1", "CODE2", {"CarrierID": "CARR"})
    text = invoice_report(spark, two_stations, "SG", billing, START, END)
    assert text.columns == list(COLUMNS) and {t for _, t in text.dtypes} == {"string"}
    native = dict(invoice_report(spark, two_stations, "SG", billing, text=False).dtypes)
    assert native["Invoice Date"] == "timestamp_ntz" and native["Invoice Total"] == "decimal(18,2)"
    row = text.first()
    assert row["CarrierID"] == "CARR" and row["ClientID"] == "" and row["Mode"] == "Air"


def test_weight_contract(spark, two_stations):
    df = weight_report(spark, two_stations, "SG", START, END, [1], "ACME")
    assert df.dtypes == [(n, t) for n, t in CONTRACT] and len(CONTRACT) == 33


def test_third_party_columns(spark, two_stations):
    bill = two_stations.tables(spark, "SG")["house_3A"]
    raw = two_stations.table(spark, "SG", "TPAIRData")
    cols = bill.select("dest_city", "delivery_city", "receipt_city", "origin_city", "master_id")
    assert bag(cols) == bag(raw.select("Delivery", "DSTN", "Receipt", "Receipt", F.lit(None).cast("bigint")))


def test_unknown_station_and_column(spark, two_stations):
    with pytest.raises(KeyError):
        two_stations.locate("XX")
    with pytest.raises(ValueError, match="no column"):
        canonical(spark.range(1).withColumnRenamed("id", "HQID"), "city", MASTER_TABLES["city"][2])


def test_tables_of_a_catalog_schema(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS station_kl LOCATION '{tmp_path / 'kl'}'")
    try:
        spark.range(3).withColumnRenamed("id", "HQID").write.saveAsTable("station_kl.smcountry")
        stations = Stations({"KL": "station_kl"}, master="station_kl")
        assert stations.table(spark, "kl", "smcountry").count() == 3
        assert stations.shared(spark, "smcountry").count() == 3
    finally:
        spark.sql("DROP DATABASE station_kl CASCADE")


def test_named_parameters(spark):
    df = spark.createDataFrame([(at("2024-01-01"), 1), (at("2024-01-02"), 2)], "t timestamp_ntz, v int")
    got = run_sql(spark, "SELECT v FROM {rows} WHERE t >= :since", {"since": at("2024-01-02")}, rows=df)
    assert [r.v for r in got.collect()] == [2]


def test_contracts(spark):
    df = spark.createDataFrame([(1, money("12.5"), at("2024-03-05T14:05:00"), None)],
                               "n int, m decimal(18,2), t timestamp_ntz, x string")
    text = contracts.to_strings(df, ["t", "m", "n", "x"])
    assert tuple(text.first()) == ("Mar  5 2024  2:05PM", "12.50", "1", None)
    named = contracts.rename(df, {"m": "TTL G.W", "n": "Notes1 (Pallets)", "x": "odd`name"})
    assert named.columns == ["TTL G.W", "Notes1 (Pallets)", "odd`name"]
    typed = contracts.to_contract(named, [("Notes1 (Pallets)", "string"), ("TTL G.W", "decimal(18,1)")])
    assert tuple(typed.first()) == ("1", Decimal("12.5"))
    fixed = contracts.with_constants(df.select("n"), {"a.b": "it's a \\ 'x'", "none": None})
    assert tuple(fixed.first()) == (1, "it's a \\ 'x'", None)


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_change_log_round_trip(spark, tmp_path, file_format):
    changes = frame(spark, "change_log", [
        dict(house_no="H1", status="Done", file_name="a, b.pdf", old_type="Others", new_type="HAWB"),
        dict(house_no="H2", status="Done", file_name='say "x".pdf', old_type=None, new_type="Packing List")])
    path = str(tmp_path / "log")
    first = changelog.write_changes(changes.limit(0), path, file_format)
    assert changelog.read_changes(spark, path, file_format).count() == 0
    for _ in range(2):
        changelog.write_changes(changes, path, file_format)
    assert bag(changelog.read_changes(spark, path, file_format)) == bag(changes)
    assert changelog.read_changes(spark, path, file_format, first).count() == 0
    assert spark.read.option("header", True).format(file_format).load(path).columns == [
        "HAWB No", "Status", "PDF Name", "Old Type", "New Type", "run"]


def test_a_failed_run_leaves_the_former_log(spark, tmp_path):
    changes = frame(spark, "change_log", [
        dict(house_no=f"H{i}", status="Done", file_name="a.pdf", old_type="Others", new_type="HAWB") for i in range(20)])
    path = str(tmp_path / "log")
    changelog.write_changes(changes, path)
    broken = changes.repartition(4).withColumn("new_type", F.when(
        F.col("house_no") == "H7", F.raise_error(F.lit("broken"))).otherwise(F.col("new_type")))
    with pytest.raises(Exception, match="broken"):
        changelog.write_changes(broken, path)
    assert bag(changelog.read_changes(spark, path)) == bag(changes)


def test_shared_intermediate(spark):
    df = spark.range(10)
    kept = shared(df.where("id > 3"))
    out = holding(kept.select("id"), kept)
    del kept
    assert out.count() == 6 and df.where("id > 3").storageLevel.useMemory
    del out
    assert not df.where("id > 3").storageLevel.useMemory
