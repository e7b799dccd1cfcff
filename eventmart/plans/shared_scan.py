"""All named queries and jobs from one scan of the events, and a second, filtered one for the top products.

Every query and job is an aggregate by a key of its own.  One ``GROUPING SETS`` aggregate takes them together: per
(key, session) the number of events and the sum, count, least and largest of the prices, then per key the same, the number of sessions, and for the
sessions the number of each depth.  Both levels combine in the map tasks, and a key with a third of all rows is spread by session.
What is left, one row a key, is staged once; each result is finished from it.

Which products are on top does not depend on their sessions, so products are counted without them, and a second
scan counts the sessions of the top ones only: no pair of a product and a session crosses the network for the rest.

The results equal those of the single plans (``plans.queries``, ``operators.jobs``), in names, types, rows and order.  Sums of
prices need a column of type double; with prices of another type the results that use them are left to their own plans.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.expressions import first_truthy, round2
from eventmart.session import run_dir

TOP = 25
#: Grouping sets by name: their key columns, and whether sessions are counted in the first scan.
SETS = {
    "day": (["day"], True), "page": (["page"], True), "category": (["category"], True), "country": (["country"], True),
    "hour": (["hour"], True), "month": (["month"], True), "session": ([], True),
    "type_key": (["type_key"], False), "category_key": (["category_key"], False), "country_key": (["country_key"], True),
    "product_category": (["product", "category"], False), "product_text": (["product_text"], False),
}
#: The set that each query and job is finished from, and whether it uses prices.
NEEDS = {
    ("query", "total_events_by_day"): ("day", False), ("query", "daily_active_users"): ("day", False),
    ("query", "top_event_types"): ("page", False), ("query", "top_products"): ("product_category", True),
    ("query", "revenue_by_category"): ("category", True), ("query", "country_device_breakdown"): ("country", True),
    ("query", "hourly_traffic"): ("hour", False), ("query", "monthly_trends"): ("month", True), ("query", "session_depth"): ("session", False),
    ("job", "event_count_by_type"): ("type_key", False), ("job", "country_event_count"): ("country_key", False),
    ("job", "revenue_by_category"): ("category_key", True), ("job", "total_events_by_day"): ("day", False),
    ("job", "daily_active_users"): ("day", False), ("job", "top_products"): ("product_text", True), ("job", "session_depth"): ("session", False),
}


def _keys(events: DataFrame) -> dict[str, Column]:
    plain = {"day": "event_date_str", "page": "page_number", "category": "category_name", "country": "country",
             "hour": "event_hour", "month": "event_month", "product": "product_id"}
    out = {key: F.col(name) for key, name in plain.items() if name in events.columns}
    if "product" in out:
        out["product_text"] = F.col("product_id").cast("string")
    return out | {"type_key": first_truthy(events, ["event_type", "page_number"], default="unknown"),
                  "category_key": first_truthy(events, ["category_name", "category_id"], default="Other"),
                  "country_key": first_truthy(events, ["country"], default="unknown")}


def grouped(base: DataFrame, sets: dict[str, tuple[list[str], bool]]) -> DataFrame:
    """One row for each key of each set: ``by`` (the set), its key columns, ``depth`` (events of a session, in the set of sessions),
    events, sessions, groups (rows of the first level), and the prices' total, number, least and largest."""
    keys = list(dict.fromkeys(k for own, _ in sets.values() for k in own))
    columns = [*keys, "session"]
    lists = {name: [*own, *(["session"] if with_sessions else [])] for name, (own, with_sessions) in sets.items()}
    pairs = base.groupingSets(list(lists.values()), *columns).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"),
        F.sum("price").alias("total"), F.count("price").alias("priced"), F.min("price").alias("least"), F.max("price").alias("largest"))
    by = None
    for name, own in lists.items():
        gid = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in own)   # a bit for each column left out
        by = (F.when if by is None else by.when)(F.col("gid") == gid, F.lit(name))
    depth = F.when(F.col("by") == "session", F.col("n"))
    return (pairs.withColumn("by", by).groupBy("by", *keys, depth.alias("depth"))
            .agg(F.sum("n").alias("events"), F.count("session").alias("sessions"), F.count(F.lit(1)).alias("groups"),
                 F.sum("total").alias("total"), F.sum("priced").alias("priced"), F.min("least").alias("least"), F.max("largest").alias("largest")))


@dataclass
class SharedScan:
    """The staged groups of the wanted items; ``result`` finishes one of them."""
    events: DataFrame
    wanted: list[tuple[str, str]]
    items: list[tuple[str, str]] = field(init=False)
    _groups: DataFrame | None = field(init=False, default=None)
    _top: DataFrame | None = field(init=False, default=None)

    def __post_init__(self):
        priced = dict(self.events.dtypes).get("price", "double") == "double"
        self.items = [i for i in self.wanted if priced or not NEEDS[i][1]]
        names = [n for n in SETS if n in {NEEDS[i][0] for i in self.items}]
        if not names:
            return
        keys = _keys(self.events)
        used = dict.fromkeys(k for n in names for k in SETS[n][0])
        session = F.col("session_id") if "session_id" in self.events.columns else F.lit(None).cast("string")
        price = F.col("price") if "price" in self.events.columns else F.lit(None).cast("double")
        base = self.events.select(*[keys[k].alias(k) for k in used], session.alias("session"), price.alias("price"))
        self._groups = self._staged(grouped(base, {n: SETS[n] for n in names}), "shared-groups")
        tops = [n for n in ("product_category", "product_text") if n in names]
        if tops:
            chosen = set()
            for n in tops:                                                   # TOP keys each, which the scan can then filter by
                chosen |= {r[0] for r in self._first(n).select(F.col(SETS[n][0][0]).cast("string")).collect()}
            text = F.col(SETS[tops[-1]][0][0]).cast("string")
            only = base.filter(text.isin([c for c in chosen if c is not None]) | (text.isNull() if None in chosen else F.lit(False)))
            self._top = self._staged(grouped(only, {n: (SETS[n][0], True) for n in tops}), "shared-top")

    @staticmethod
    def _staged(df: DataFrame, label: str) -> DataFrame:
        spark: SparkSession = df.sparkSession
        path = run_dir(spark, label)
        df.hint("rebalance").write.parquet(path)                   # files of a useful size, however few the groups are
        return spark.read.schema(df.schema).parquet(path)

    def _of(self, name: str) -> DataFrame:
        return self._groups.filter(F.col("by") == name)

    def _first(self, name: str) -> DataFrame:
        """The products with the most events."""
        keys = SETS[name][0]
        return self._of(name).orderBy(F.desc("events"), *[F.asc_nulls_last(k) for k in keys]).limit(TOP)

    def _first_with_sessions(self, name: str) -> DataFrame:
        keys = SETS[name][0]
        counted = self._top.filter(F.col("by") == name).select(*[F.col(k).alias(f"of_{k}") for k in keys], F.col("sessions").alias("counted"))
        same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
        return (self._first(name).join(counted, same).withColumn("sessions", F.col("counted"))
                .orderBy(F.desc("events"), *[F.asc_nulls_last(k) for k in keys]))

    def result(self, kind: str, name: str) -> DataFrame:
        return _FINISH[kind, name](self)


def _total(name="total_revenue"):
    return round2("total").alias(name)


def _average(name="avg_price"):
    """Of the prices there are, as SQL's AVG."""
    return round2(F.col("total") / F.col("priced")).alias(name)


# a job takes a missing price as 0, and averages its rounded total
def _total0() -> Column:
    return round2(F.coalesce("total", F.lit(0.0)))


def _average0() -> Column:
    return round2(_total0() / F.col("events"))


def _with0(pick, own: str) -> Column:
    return F.when(F.col("priced") < F.col("events"), pick(F.coalesce(own, F.lit(0.0)), F.lit(0.0))).otherwise(F.col(own))


def _events(name="total_events"):
    return F.col("events").alias(name)


def _sessions(name="unique_sessions"):
    return F.col("sessions").alias(name)


def _by_day(column: str, name: str):
    return lambda s: s._of("day").select(F.col("day").alias("event_date"), F.col(column).alias(name)).orderBy(F.asc_nulls_last("event_date"))


def _depth(s: SharedScan) -> DataFrame:
    return (s._of("session").groupBy(F.col("depth").alias("pages_per_session")).agg(F.sum("groups").alias("session_count"))
            .orderBy("pages_per_session"))


_FINISH = {
    ("query", "total_events_by_day"): _by_day("events", "total_events"),
    ("query", "daily_active_users"): _by_day("sessions", "active_users"),
    ("query", "top_event_types"): lambda s: s._of("page").select(F.col("page").alias("page_position"), _events(), _sessions())
        .orderBy(F.desc("total_events"), F.asc_nulls_last("page_position")),
    ("query", "top_products"): lambda s: s._first_with_sessions("product_category").select(
        F.col("product").alias("product_id"), F.col("category").alias("category_name"), _events("view_count"), _sessions(), _average(), _total()),
    ("query", "revenue_by_category"): lambda s: s._of("category").select(
        F.col("category").alias("category_name"), _events(), _sessions(), _total(), _average(), round2("least").alias("min_price"), round2("largest").alias("max_price"))
        .orderBy(F.desc("total_revenue"), F.asc_nulls_last("category_name")),
    ("query", "country_device_breakdown"): lambda s: s._of("country").select("country", _events(), _sessions(), _average(), _total())
        .orderBy(F.desc("total_events"), F.asc_nulls_last("country")),
    ("query", "hourly_traffic"): lambda s: s._of("hour").filter("hour is not null").select(F.col("hour").alias("event_hour"), _events(), _sessions()).orderBy("event_hour"),
    ("query", "monthly_trends"): lambda s: s._of("month").filter("month is not null").select(F.col("month").alias("event_month"), _events(), _sessions(), _total())
        .orderBy("event_month"),
    ("query", "session_depth"): _depth,
    ("job", "event_count_by_type"): lambda s: s._of("type_key").select(F.col("type_key").alias("event_type"), _events("event_count"))
        .orderBy(F.desc("event_count"), F.asc("event_type")),
    ("job", "country_event_count"): lambda s: s._of("country_key").select(F.col("country_key").alias("country"), _events(), _sessions())
        .orderBy(F.desc("total_events"), F.asc("country")),
    ("job", "revenue_by_category"): lambda s: s._of("category_key").select(
        F.col("category_key").alias("category_name"), _total0().alias("total_revenue"), _events("event_count"), _average0().alias("avg_price"),
        round2(_with0(F.least, "least")).alias("min_price"), round2(_with0(F.greatest, "largest")).alias("max_price"))
        .orderBy(F.desc("total_revenue"), F.asc("category_name")),
    ("job", "total_events_by_day"): _by_day("events", "total_events"),
    ("job", "daily_active_users"): _by_day("sessions", "active_users"),
    ("job", "top_products"): lambda s: s._first_with_sessions("product_text").select(
        F.col("product_text").alias("product_id"), _events("view_count"), _sessions(), _average0().alias("avg_price"), _total0().alias("total_revenue")),
    ("job", "session_depth"): _depth,
}
