"""Joins give the same rows whichever way they are carried out."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shipreport.operators import joins


def sides(spark, seed, rows=2000):
    rng = random.Random(seed)

    def key():
        return rng.choices([7, None, rng.randrange(60)], [3, 1, 5])[0]

    left = [(key(), "a", i % 5) for i in range(rows)]
    right = [(k, "a", f"v{k}") for k in range(0, 80, 2)] + [(7, "a", "v7"), (7, "b", "other"), (None, "a", "none")]
    many = [(key(), "a", i) for i in range(300)]
    return (spark.createDataFrame(left, "k bigint, s string, x int"),
            spark.createDataFrame(right, "k bigint, s string, v string"),
            spark.createDataFrame(many, "k bigint, s string, y int"))


def bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup(spark, shuffled, how):
    left, right, _ = sides(spark, 1)
    want = bag(left.join(right, ["k", "s"], how))
    assert joins.Probe(left).hot(["k", "s"])
    assert bag(joins.attach(left, right, ["k", "s"], how)) == want


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_fan_out(spark, shuffled, how):
    left, _, many = sides(spark, 2)
    assert joins.Probe(left).hot(["k", "s"]) and joins.Probe(many).hot(["k", "s"])
    assert bag(joins.fan_out(left, many, ["k", "s"], how)) == bag(left.join(many, ["k", "s"], how))


def test_fan_out_with_a_hot_right_side_only(spark, shuffled):
    left = spark.createDataFrame([(i, f"h{i}") for i in range(100)], "k bigint, h string")
    right = spark.createDataFrame([(5, i) for i in range(900)] + [(i, i) for i in range(50)], "k bigint, y int")
    assert not joins.Probe(left).hot(["k"]) and joins.Probe(right).hot(["k"])
    assert bag(joins.fan_out(left, right, ["k"])) == bag(left.join(right, ["k"], "left"))


def test_a_hot_key_is_spread_over_tasks(spark, shuffled):
    left = spark.range(0, 6000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("copy").alias("x"))
    right = spark.range(6000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        hot = joins.Probe(left).hot(["k"])
        assert len(hot) == 1 and hot[0][1] == 11
        joined = joins.salted_join(left, right, ["k"], "left", hot)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = left.join(right.hint("merge"), "k", "left")
        plain_sizes = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == sum(plain_sizes) == 6000
    assert max(plain_sizes) > 2000 > 1300 > max(sizes)


def test_nothing_is_salted_without_hot_keys(spark, shuffled):
    left = spark.range(1000).withColumnRenamed("id", "k")
    assert joins.Probe(left).hot(["k"]) == []


def test_few_rows_are_only_counted(spark):
    probe = joins.Probe(spark.range(10).withColumnRenamed("id", "k"))
    assert probe.hot(["k"]) == [] and probe._rows == 10


def test_a_small_side_is_left_to_catalyst(spark):
    probe = joins.Probe(spark.range(10).withColumnRenamed("id", "k"))
    probe._search = None
    assert joins.attach(probe.df, probe.df, ["k"], probe=probe).count() == 10


def test_a_key_of_a_small_share_is_split_where_partitions_are_many(spark, shuffled):
    rows = spark.range(40_000).select(F.when(F.col("id") % 2000 == 0, -1).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", "20000")
    try:
        hot = joins.Probe(rows).hot(["k"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [salts for _, salts in hot] == [10]  # 20 of 40000 rows, ten fair partitions' worth


def test_thinned_keeps_what_a_later_join_needs(spark, request):
    left, right, many = sides(spark, 3)
    want = bag(many.join(left.select("k", "s").distinct(), ["k", "s"], "left_semi"))
    assert bag(joins.thinned(many, left, ["k", "s"])) == want != bag(many)
    request.getfixturevalue("shuffled")
    thin = joins.thinned(many, left, ["k", "s"])
    assert bag(thin) == want and thin.columns == many.columns


def test_key_types_must_agree(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1,)], "k bigint")
    with pytest.raises(TypeError):
        joins.attach(left, right, ["k"])


def test_hot_right_side_needs_an_inner_join(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        joins.salted_join(df, df, ["k"], "left", [], [(1, 2)])


def test_list_as_literals_and_as_table(spark, shuffled):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "id bigint, x string")
    table = spark.createDataFrame([(1,), (1,), (9,)], "ids bigint")
    for ids in ([1, 9], table):
        assert bag(joins.in_list(df, "id", ids)) == bag(df.where("id = 1"))
        flagged = joins.flag_in_list(df, "id", ids, "listed")
        assert bag(flagged) == bag(df.withColumn("listed", F.coalesce(F.col("id") == 1, F.lit(False))))


@pytest.mark.parametrize("fixture", [None, "shuffled", "even"])
def test_roles_by_one_join(spark, request, fixture):
    """Like one join a role: repeated rows, NULL and unknown ids, a hot id, odd names."""
    if fixture:
        request.getfixturevalue(fixture)
    rng = random.Random(6)
    ids = [None, 7, 7, 7, *range(20)]
    rows = [(rng.choice(ids), rng.choice(ids), rng.choice("ab"), None) for _ in range(600)] + [(None, None, None, None)] * 3
    rows = [(*r, [1, None] if i % 2 else [None, 1]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "`a id` bigint, b bigint, `x.y` string, z string, v array<int>")
    dim = spark.createDataFrame([(i, f"n{i}", None if i % 3 else "c") for i in range(2, 30)], "id bigint, name string, code string")
    roles = {"one": "a id", "two": "b"}
    want = joins.with_roles(df, dim, "id", roles, ["name", "code"])
    got = joins.with_roles_once(df, dim, "id", roles, ["name", "code"])
    assert sorted(got.columns) == sorted(want.columns)
    rows_of = lambda d: Counter(tuple(repr(r[c]) for c in sorted(d.columns)) for r in d.collect())
    assert rows_of(got) == rows_of(want)
    assert not joins.with_roles_once(df.limit(0), dim, "id", roles, ["name"]).count()


def test_roles_by_one_join_shuffle_the_dimension_once(spark, even):
    from shipreport.workload.queries import QUERIES
    from test_plans import SF, plan

    text = plan(QUERIES["customer_roles_once"](spark, SF))
    assert text.count("customer.parquet") == 1 and text.count("Exchange hashpartitioning") == 3
    assert plan(QUERIES["customer_roles"](spark, SF)).count("customer.parquet") == 3


def test_only_keys_of_full_buckets_are_counted_one_by_one(spark, monkeypatch):
    """A hot key of one of two lists, beside keys without number, by two small counts."""
    rows = spark.range(40_000).select(F.when(F.col("id") % 4 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    monkeypatch.setattr(joins, "BUCKETS", 16)
    made, plain = [], joins.Probe._counts
    monkeypatch.setattr(joins.Probe, "_counts", lambda self, *a: made.append((a[0], plain(self, *a))) or made[-1][1])
    probe = joins.Probe(rows, ["x"], ["k"])
    key = rows.where("k = -1").select(F.xxhash64("k")).first()[0]
    assert probe.hot(["k"]) == [(key, 2)] and probe.hot(["x"]) == [] and probe._rows == 40_000
    assert [lists for lists, _ in made] == [[("k",), ("x",)], [("k",)]]
    assert all(len(found) <= 17 for _, found in made)


def test_thinned_copies_no_keys(spark, even):
    df = spark.range(1000).withColumnRenamed("id", "k")
    from test_plans import plan

    text = plan(joins.thinned(df, df.where("k % 3 = 0"), ["k"]).groupBy("k").count())
    # Both sides meet, and the aggregate has tasks of its own.
    assert "Generate" not in text and text.count("Exchange hashpartitioning") == 3


def test_rows_are_told_apart_by_the_key_list(spark, even):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "a")], "k bigint, x string")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k bigint")
    assert bag(joins.flag_known(df, keys, ["k"], "known")) == bag(df.withColumn("known", F.coalesce(F.col("k") == 1, F.lit(False))))


def test_roles_by_one_join_make_no_rows_for_missing_ids(spark, even):
    df = spark.createDataFrame([(1, None), (None, None), (2, 1)], "a bigint, b bigint")
    dim = spark.createDataFrame([(1, "n1")], "id bigint, name string")
    seen = []
    attach = joins.attach
    joins.attach = lambda left, *a, **k: seen.append(left.count()) or attach(left, *a, **k)
    try:
        got = joins.with_roles_once(df, dim, "id", {"one": "a", "two": "b"}, ["name"])
    finally:
        joins.attach = attach
    assert seen == [4] and bag(got) == bag(joins.with_roles(df, dim, "id", {"one": "a", "two": "b"}, ["name"]))


@pytest.mark.parametrize("fixture", [None, "shuffled", "even"])
def test_roles_from_a_hash_table(spark, request, tmp_path, monkeypatch, fixture):
    """Like plain joins: NULL, unknown and hot ids, equal rows, ids that the dimension holds twice or as NULL."""
    if fixture:
        request.getfixturevalue(fixture)
    rng = random.Random(8)
    ids = [None, 7, 7, 7, *range(40)]
    df = spark.createDataFrame([(rng.choice(ids), rng.choice(ids), rng.choice("ab")) for _ in range(900)], "a bigint, b bigint, x string")
    named = [(i, f"n{i}") for i in range(30)] + [(7, "again"), (None, "none"), (3, None)]
    spark.createDataFrame(named, "id bigint, name string").write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim")
    want = df
    for prefix, column in (("one", "a"), ("two", "b")):
        want = want.join(dim.select(F.col("id").alias(column), F.col("name").alias(f"{prefix}_name")), column, "left")
    got = bag(joins.with_roles(df, dim, "id", {"one": "a", "two": "b"}, ["name"]))
    assert got == bag(want) and sum(got.values()) > 900
    monkeypatch.setattr(joins, "HELD_BYTES", 0)
    assert bag(joins.with_roles(df, dim, "id", {"one": "a", "two": "b"}, ["name"])) == got


@pytest.mark.parametrize("name,roles", [
    ("customer_roles", 3), ("customer_roles_once", 1), ("consignee_country", 1), ("origin_destination", 2)])
def test_roles_sort_no_house_bills(spark, even, monkeypatch, name, roles):
    from shipreport.workload.queries import QUERIES
    from test_plans import SF, plan

    assert plan(QUERIES[name](spark, SF)).count("ShuffledHashJoin") == roles
    # A dimension of which a task cannot hold its part is sorted.
    monkeypatch.setattr(joins, "HELD_BYTES", 0)
    assert "ShuffledHashJoin" not in plan(QUERIES[name](spark, SF))


def test_salted_roles_sort_nothing(spark, shuffled, tmp_path):
    from test_plans import plan

    spark.range(50).selectExpr("id", "string(id) AS name").write.parquet(f"{tmp_path}/dim")
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 7, id % 60) AS a", "id AS x")
    assert joins.Probe(df).hot(["a"])
    text = plan(joins.with_roles(df, spark.read.parquet(f"{tmp_path}/dim"), "id", {"one": "a"}, ["name"]))
    assert text.count("ShuffledHashJoin") == 1 and "SortMergeJoin" not in text


def test_a_table_of_unknown_size_is_not_held(spark):
    assert joins.held_by_tasks(spark.range(1000))
    assert not joins.held_by_tasks(spark.createDataFrame([(1,)], "id bigint"))
