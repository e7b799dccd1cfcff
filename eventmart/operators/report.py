"""The analysis report: each section answers from a mart when one exists,
otherwise from the raw events.

Routing is a plain check of the table store at plan time; both routes are
ordinary DataFrame plans.  Every limited section sorts explicitly (stored
tables have no order), with the group key as the tie-breaker.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.expressions import round2
from eventmart.operators import jobs
from eventmart.operators.topk import top_k_with_distinct
from eventmart.sources.lake import TableStore


class Report:
    def __init__(self, events: DataFrame, store: TableStore | None = None):
        self.events = events
        self.store = store

    def _mart(self, name: str) -> DataFrame | None:
        if self.store is not None and self.store.exists(name):
            return self.store.read(name)
        return None

    def route(self, name: str) -> str:
        return "mart" if self._mart(name) is not None else "base"

    # R1
    def overview(self) -> DataFrame:
        daily = self._mart("daily_metrics")
        if daily is not None:
            return daily.agg(F.sum("total_events").cast("bigint").alias("total_events"),
                             F.count(F.lit(1)).alias("total_days"))
        return self.events.agg(F.count(F.lit(1)).alias("total_events"),
                               F.count_distinct("event_date_str").alias("total_days"))

    def _daily(self) -> DataFrame:
        daily = self._mart("daily_metrics")
        if daily is not None:
            return daily
        return (self.events.groupBy(F.col("event_date_str").alias("event_date"))
                .agg(F.count(F.lit(1)).alias("total_events"),
                     F.count_distinct("session_id").alias("unique_sessions")))

    # R2: from raw events, sessions are counted only for the first n days
    def first_days(self, n: int = 15) -> DataFrame:
        order = [F.asc_nulls_last("event_date")]
        cols = ["event_date", "total_events", "unique_sessions"]
        daily = self._mart("daily_metrics")
        if daily is not None:
            return daily.select(*cols).orderBy(*order).limit(n)
        base = self.events.select(F.col("event_date_str").alias("event_date"), "session_id")
        return top_k_with_distinct(base, ["event_date"], [F.count(F.lit(1)).alias("total_events")],
                                   order, n, distinct="session_id",
                                   distinct_name="unique_sessions", columns=cols)

    # The mart keeps products by id; the base route groups by (product, category)
    def top_products(self, n: int = 10) -> DataFrame:
        mart = self._mart("top_products")
        if mart is not None:
            return mart.orderBy(F.desc("view_count"), F.asc_nulls_last("product_id")).limit(n)
        return (self.events.groupBy("product_id", "category_name")
                .agg(F.count(F.lit(1)).alias("view_count"),
                     round2(F.avg("price")).alias("avg_price"))
                .orderBy(F.desc("view_count"), F.asc_nulls_last("product_id"),
                         F.asc_nulls_last("category_name"))
                .limit(n))

    # R4
    def categories(self) -> DataFrame:
        mart = self._mart("category_metrics")
        if mart is not None:
            return mart.orderBy(F.desc("total_events"), F.asc_nulls_last("category_name"))
        return (self.events.groupBy("category_name")
                .agg(F.count(F.lit(1)).alias("total_events"),
                     round2(F.sum("price")).alias("total_revenue"),
                     round2(F.avg("price")).alias("avg_price"))
                .orderBy(F.desc("total_revenue"), F.asc_nulls_last("category_name")))

    # From raw events, sessions are counted only for the top n countries
    def top_countries(self, n: int = 10) -> DataFrame:
        order = [F.desc("total_events"), F.asc_nulls_last("country")]
        mart = self._mart("country_metrics")
        if mart is not None:
            return mart.orderBy(*order).limit(n)
        return top_k_with_distinct(self.events.select("country", "session_id"), ["country"],
                                   [F.count(F.lit(1)).alias("total_events")], order, n,
                                   distinct="session_id", distinct_name="unique_sessions",
                                   columns=["country", "total_events", "unique_sessions"])

    # R6
    def session_depth(self, n: int = 20) -> DataFrame:
        return jobs.session_depth(self.events).limit(n)

    # Data behind the charts
    def daily_volume(self) -> DataFrame:
        return self._daily().select("event_date", "total_events").orderBy(F.asc_nulls_last("event_date"))

    def category_share(self) -> DataFrame:
        mart = self._mart("category_metrics")
        if mart is None:
            mart = self.events.groupBy("category_name").agg(F.count(F.lit(1)).alias("total_events"))
        return (mart.select("category_name", "total_events")
                .orderBy(F.desc("total_events"), F.asc_nulls_last("category_name")))

    # R8
    def schema_preview(self) -> list[tuple[str, str]]:
        """Columns of the source (the first mart when marts exist, as the
        original report shows)."""
        for name in ("daily_metrics", "top_products", "country_metrics", "category_metrics"):
            mart = self._mart(name)
            if mart is not None:
                return mart.dtypes
        return self.events.dtypes

    def available(self) -> dict[str, bool]:
        """Whether each section can be made: its mart is there, or the events have its columns."""
        have = set(self.events.columns)
        return {name: (mart is not None and self._mart(mart) is not None) or needs <= have
                for name, (mart, needs) in SECTIONS.items()}

    def sections(self) -> dict[str, DataFrame]:
        """The sections that can be made; one whose columns are absent is left out, the others stay."""
        return {name: getattr(self, name)() for name, there in self.available().items() if there}


#: Sections: the mart that answers them, and the event columns they need without it.
SECTIONS = {
    "overview": ("daily_metrics", {"event_date_str"}),
    "first_days": ("daily_metrics", {"event_date_str", "session_id"}),
    "top_products": ("top_products", {"product_id", "category_name", "price"}),
    "categories": ("category_metrics", {"category_name", "price"}),
    "top_countries": ("country_metrics", {"country", "session_id"}),
    "session_depth": (None, {"session_id"}),
    "daily_volume": ("daily_metrics", {"event_date_str", "session_id"}),
    "category_share": ("category_metrics", {"category_name"}),
}


def report_summary(report: Report) -> DataFrame:
    """``(section, status, rows)`` of a report."""
    spark = report.events.sparkSession
    made = report.sections()
    parts = [(made[n].agg(F.count(F.lit(1)).alias("rows")) if n in made else spark.range(1).select(F.lit(0).cast("bigint").alias("rows")))
             .select(F.lit(n).alias("section"), F.lit("ok" if n in made else "skipped").alias("status"), "rows") for n in SECTIONS]
    return reduce(DataFrame.unionAll, parts)


def schema_frame(df: DataFrame) -> DataFrame:
    """``(position, column_name, type)`` of a frame's columns."""
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("type")) for i, (c, t) in enumerate(df.dtypes)])
    return df.sparkSession.range(1).select(F.inline(rows))
