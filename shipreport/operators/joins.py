"""Joins that stay whole and balanced when one key holds much of the data.

A right side that Catalyst itself takes for small (``spark.sql.autoBroadcastJoinThreshold``)
is left to Catalyst, without a hint, so that adaptive execution may still decide otherwise.
Any other join is a shuffle. Where the session lets adaptive execution split skewed
partitions, it does so on every side that it can, and nothing is counted first. The rest,
which is the inner side of an outer join, or every side without adaptive execution, is
salted: keys that hold more rows than a fair partition are found by an exact count with
map-side partials, of which only those keys come back: fewer than the number of partitions,
by definition. It first counts keys in buckets of their hash, a few for each partition, and then
single keys of those buckets alone that hold more than a partition's share. They are spread over as many salts as their share asks for, and the other
side is copied for those keys only.

``attach`` joins a dimension or a table with one or few rows per key, ``fan_out`` two large
tables of which either may hold many rows per key, ``thinned`` leaves out rows that no key
of another frame needs. The count only decides how rows are spread; every row is joined.
A dimension of which every task can hold its part is joined by hash (``held_by_tasks``), so that
the other side is not sorted and nothing of it spills, however few the partitions are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

# A key of fewer rows than this is no burden for one task. With 0 every side is counted.
HOT_ROWS = 100_000
# Buckets that keys are counted in together: so many at least, and for each partition.
BUCKETS, BUCKETS_A_PARTITION = 1024, 8
# A task may hold so many bytes of a dimension, as they are stored; in memory they are a few times more.
HELD_BYTES = 16 << 20


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def left_to_catalyst(df: DataFrame) -> bool:
    """Catalyst's estimate is under its own broadcast threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return planned_bytes(df) <= limit


def stored_bytes(df: DataFrame) -> int:
    """The size of all that ``df`` is read from, by Catalyst; a join of it does not multiply sizes here."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def held_by_tasks(df: DataFrame) -> bool:
    """A partition's share of a dimension fits a hash table; a table of unknown size does not."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored_bytes(df) <= HELD_BYTES * partitions


def _key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in on])


class Probe:
    """The hot keys of a frame, by hash, for all ``key_lists`` at once.

    They are looked for when first asked for, by one job that counts rows and keys. A report
    probes a frame that is cheap to read, not the joins on top of it, and names all key
    lists it will ask for.
    """

    def __init__(self, df: DataFrame, *key_lists: Sequence[str]):
        self.df = df
        self._wanted = [tuple(k) for k in key_lists]
        self._hot: dict[tuple[str, ...], list[tuple[int, int]]] = {}
        self._rows: int | None = None

    def hot(self, on: Sequence[str]) -> list[tuple[int, int]]:
        """(key hash, number of salts) of the keys with more than a fair share of rows."""
        keys = tuple(on)
        if keys not in self._hot:
            self._search([keys, *(k for k in self._wanted if k != keys and k not in self._hot)])
        return self._hot[keys]

    def _search(self, lists: list[tuple[str, ...]]) -> None:
        partitions = int(self.df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self._hot |= {keys: [] for keys in lists}
        if self._rows is not None and self._rows <= max(HOT_ROWS, self._rows / partitions):
            return
        # Keys are counted together first, in buckets of their hash. No bucket holds less than one of its
        # keys, so only keys of buckets with too many rows are counted one by one, often none.
        buckets = max(BUCKETS, BUCKETS_A_PARTITION * partitions)
        found = self._counts(lists, F.pmod(F.col("key.hash"), F.lit(buckets)), None)
        self._rows = next((row["rows"] for row in found if row["list"] < 0), 0)
        limit = max(HOT_ROWS, self._rows / partitions)
        large = [(row["list"], row["part"]) for row in found if row["list"] >= 0 and row["rows"] > limit]
        if not large:
            return
        some = sorted({i for i, _ in large})
        table = self.df.sparkSession.createDataFrame([(some.index(i), part) for i, part in large], "list int, part long")
        for row in self._counts([lists[i] for i in some], F.col("key.hash"), (table, buckets)):
            if row["rows"] > limit:
                salts = math.ceil(row["rows"] / self._rows * partitions)
                self._hot[lists[some[row["list"]]]].append((row["part"], salts))

    def _counts(self, lists: list[tuple[str, ...]], part: Column, within: tuple[DataFrame, int] | None) -> list:
        """Rows by list and ``part`` of the key's hash, of those with more than ``HOT_ROWS``, and of all under list -1.

        No more parts than partitions can hold more than a partition's share, so no more come back of a list.
        """
        partitions = int(self.df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        keys = [F.struct(F.lit(-1).alias("list"), F.lit(0).cast("long").alias("hash")), *[
            F.struct(F.lit(i).alias("list"), _key_hash(k).alias("hash")) for i, k in enumerate(lists)]]
        rows = self.df.select(F.explode(F.array(*keys)).alias("key"))
        if within is not None:
            table, buckets = within
            rows = rows.withColumns({"list": F.col("key.list"), "part": F.pmod(F.col("key.hash"), F.lit(buckets))})
            rows = rows.join(F.broadcast(table), ["list", "part"], "left_semi")
        counts = rows.groupBy(F.col("key.list").alias("list"), part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
        counts = counts.where((F.col("rows") > HOT_ROWS) | (F.col("list") < 0))
        return counts.orderBy(F.desc("rows"), "list").limit(partitions * len(lists) + 1).collect()


def split_by_spark(df: DataFrame) -> bool:
    """Adaptive execution splits what is hot on a side that a join may split, whatever joins follow.

    It sees sizes when the rows are there, so nothing has to be counted first. It can split both
    sides of an inner join, and the left one of a left, semi or anti join.
    """
    conf = df.sparkSession.conf
    return HOT_ROWS > 0 and all(conf.get(f"spark.sql.adaptive.{name}", "false") == "true" for name in (
        "enabled", "skewJoin.enabled", "forceOptimizeSkewedJoin"))


def _probe(df: DataFrame, probe: Probe | None) -> Probe:
    return Probe(df) if probe is None else probe


def _with_salts(df: DataFrame, on: Sequence[str], name: str,
                hot: list[tuple[int, int]], spread: bool) -> DataFrame:
    """Add a salt column: one salt per row if ``spread``, else one copy per salt."""
    if not hot:
        return df.withColumn(name, F.lit(0))
    table = F.broadcast(df.sparkSession.createDataFrame(hot, "_hash bigint, _salts int"))
    out = df.withColumn("_hash", _key_hash(on)).join(table, "_hash", "left")
    if spread:
        # The row's place in its partition, and its content: equal rows of one partition get
        # different salts. Which salt a row gets does not change the result.
        mixed = F.xxhash64(F.monotonically_increasing_id(), *[F.col(f"`{c}`") for c in df.columns])
        salt = F.coalesce(F.pmod(mixed, F.col("_salts")).cast("int"), F.lit(0))
    else:
        salt = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    return out.withColumn(name, salt).drop("_hash", "_salts")


def _check_key_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    for key in on:
        a, b = left.schema[key].dataType, right.schema[key].dataType
        if a != b:
            raise TypeError(f"join key {key}: {a.simpleString()} against {b.simpleString()}")


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                hot_left: list[tuple[int, int]],
                hot_right: list[tuple[int, int]] = (), hashed: bool = False) -> DataFrame:
    """Equi-join with hot keys of either side spread over salts.

    A pair of matching rows meets in exactly one salt combination. Hot keys on the
    right need an inner join: copies of an outer left row would each look unmatched.
    """
    on = list(on)
    if not hot_left and not hot_right:
        return left.join(right.hint("shuffle_hash") if hashed else right, on, how)
    if hot_right and how != "inner":
        raise ValueError("hot keys on the right side need an inner join")
    a = _with_salts(_with_salts(left, on, "_salt_l", hot_left, True), on, "_salt_r", hot_right, False)
    b = _with_salts(_with_salts(right, on, "_salt_r", hot_right, True), on, "_salt_l", hot_left, False)
    return a.join(b.hint("shuffle_hash") if hashed else b, [*on, "_salt_l", "_salt_r"], how).drop("_salt_l", "_salt_r")


def attach(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
           probe: Probe | None = None, hashed: bool = False) -> DataFrame:
    """Join ``left`` to a dimension, or to a table with one or few rows per key.

    ``hashed`` asks for a hash table of each partition of ``right``, where that is not left to Catalyst.
    """
    on = list(on)
    _check_key_types(left, right, on)
    if left_to_catalyst(right):
        return left.join(right, on, how)
    hot = [] if split_by_spark(left) else _probe(left, probe).hot(on)
    return salted_join(left, right, on, how, hot, hashed=hashed)


def fan_out(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
            probe_left: Probe | None = None, probe_right: Probe | None = None) -> DataFrame:
    """Left or inner join in which many rows of either side may share a key."""
    on = list(on)
    _check_key_types(left, right, on)
    by_spark = split_by_spark(left)
    if (by_spark and how == "inner") or left_to_catalyst(right) or (how == "inner" and left_to_catalyst(left)):
        return left.join(right, on, how)
    # The inner side of a left join is the one that only a count can find hot.
    hot_right = _probe(right, probe_right).hot(on)
    hot_left = [] if by_spark else _probe(left, probe_left).hot(on)
    if how == "inner" or not hot_right:
        return salted_join(left, right, on, how, hot_left, hot_right)
    matched = salted_join(left, right, on, "inner", hot_left, hot_right)
    alone = salted_join(left, right.select(*on).distinct(), on, "left_anti", hot_left)
    return matched.unionByName(alone, allowMissingColumns=True)


def paired(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of two sides that hold one row per key, so that none is hot and nothing is counted."""
    _check_key_types(left, right, on)
    return left.join(right, list(on))


def thinned(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose key ``keys`` has.

    Meant for a large table that is aggregated by the key next. Only hot keys are salted, so that
    they are met by several tasks. The join is by one column more than the aggregate, which
    therefore runs in tasks of its own: none sorts the table and holds the aggregate as well.
    """
    on = list(on)
    _check_key_types(df, keys, on)
    wanted = keys.select(*on).distinct()
    if left_to_catalyst(wanted):
        return df.join(wanted, on, "left_semi")
    part = F.pmod(_key_hash(on), F.lit(BUCKETS)).cast("int")
    return attach(df.withColumn("_part", part), wanted.withColumn("_part", part), [*on, "_part"], "left_semi").drop("_part")


def flag_known(df: DataFrame, keys: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """``thinned`` as a true or false column, all rows kept: both parts of ``df`` by one join."""
    known = keys.select(*on).distinct().withColumn(name, F.lit(True))
    return attach(df, known, on).withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def with_roles(df: DataFrame, dimension: DataFrame, key: str, roles: dict[str, str],
               attributes: Sequence[str], probe: Probe | None = None) -> DataFrame:
    """Join one dimension several times under different roles.

    ``roles`` maps a prefix to the column of ``df`` that holds that role's id; the
    attributes arrive as ``<prefix>_<attribute>``. ``df`` is shuffled once a role; it is sorted
    only if the dimension is too large for a hash table of each partition.
    """
    hashed = held_by_tasks(dimension)
    if probe is None:
        probe = Probe(df, *[[column] for column in roles.values()])
    for prefix, column in roles.items():
        narrow = dimension.select(
            F.col(key).alias(column), *[F.col(a).alias(f"{prefix}_{a}") for a in attributes])
        df = attach(df, narrow, [column], probe=probe, hashed=hashed)
    return df


def with_roles_once(df: DataFrame, dimension: DataFrame, key: str, roles: dict[str, str],
                    attributes: Sequence[str]) -> DataFrame:
    """``with_roles`` by one join: for a dimension too large to broadcast and several roles.

    Role ids are unpivoted, joined with the dimension together, and pivoted back, so that the
    dimension is shuffled once and ``df`` twice, whatever the number of roles. Of the rows that
    stand for one row only the first role's carries its columns, and those of NULL ids of other
    roles are left out. Ids are taken from the melted rows again, where they are asked for. A row is known by 128 bits of
    hashes of its columns, which a task that runs again gives it again; equal rows travel as
    one and are counted. The dimension must hold an id once.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    ids = [F.col(f"`{c}`") for c in roles.values()]
    # One column at least, so that there is a row.
    own = [c for c in df.columns if c not in roles.values()] or df.columns[:1]
    # Spark's hashes pass over NULLs, so it is hashed as well where they are.
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    content = [F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if n in nested else c for n, c in zip(df.columns, columns)]
    content += [c.isNull() for c in columns]
    melted = df.select(
        F.xxhash64(F.lit(1), *content).alias("_a"), F.xxhash64(F.lit(2), *content).alias("_b"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"),
        F.posexplode(F.array(*ids)).alias("_role", key))
    melted = melted.where((F.col("_role") == 0) | F.col(f"`{key}`").isNotNull())
    melted = melted.withColumn("_row", F.when(F.col("_role") == 0, F.col("_row")))
    narrow = dimension.select(key, F.struct(*attributes).alias("_found"))
    joined = attach(melted, narrow, [key], hashed=held_by_tasks(dimension))
    first = F.col("_role") == 0
    pivoted = joined.groupBy("_a", "_b").agg(
        F.first("_row", ignorenulls=True).alias("_row"), F.count(F.when(first, 1)).alias("_copies"),
        *[F.first(F.when(F.col("_role") == i, F.col("_found")), ignorenulls=True).alias(f"_found_{i}") for i in range(len(roles))],
        *[F.first(F.when(F.col("_role") == i, F.col(f"`{key}`")), ignorenulls=True).alias(f"_id_{i}") for i in range(len(roles))])
    place = {c: i for i, c in enumerate(roles.values())}
    back = [F.col(f"_row.`{c}`") if c in own else F.col(f"_id_{place[c]}").cast(df.schema[c].dataType).alias(c) for c in df.columns]
    found = [F.col(f"_found_{i}.{a}").alias(f"{prefix}_{a}") for i, prefix in enumerate(roles) for a in attributes]
    each = pivoted.select(*back, *found, F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
    return each.drop("_copy")


def with_country(customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Customers with the name of their country; dimensions are joined to each other first."""
    names = countries.select(F.col("id").alias("country_id"), F.col("name").alias("country_name"))
    return attach(customers, names, ["country_id"])


def country_of_city(df: DataFrame, cities: DataFrame, column: str, name: str = "country_code") -> DataFrame:
    """The country code of a city id, i.e. the first two letters of the city's code."""
    codes = cities.select(F.col("id").alias(column), F.left("code", F.lit(2)).alias(name))
    return attach(df, codes, [column])


def filter_by_code(df: DataFrame, dimension: DataFrame, key: str, column: str, keep: Column) -> DataFrame:
    """Rows of ``df`` whose dimension row satisfies ``keep``."""
    return attach(df, dimension.where(keep).select(F.col(key).alias(column)), [column], "inner")


def in_list(df: DataFrame, column: str, ids: DataFrame | Sequence[int]) -> DataFrame:
    """Rows whose id is in a list: literals, or the first column of a table."""
    if isinstance(ids, DataFrame):
        return attach(df, ids.select(F.col(ids.columns[0]).alias(column)), [column], "left_semi")
    return df.where(F.col(column).isin(list(ids)))


def flag_in_list(df: DataFrame, column: str, ids: DataFrame | Sequence[int], name: str) -> DataFrame:
    """``in_list`` as a true or false column, all rows kept."""
    if isinstance(ids, DataFrame):
        listed = ids.select(F.col(ids.columns[0]).alias(column)).distinct()
        df = attach(df, listed.withColumn(name, F.lit(True)), [column])
        return df.withColumn(name, F.coalesce(F.col(name), F.lit(False)))
    return df.withColumn(name, F.coalesce(F.col(column).isin(list(ids)), F.lit(False)))
