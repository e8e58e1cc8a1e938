"""All results over one folder of input tables, each built from the ones below it."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoploom.functions import rules
from shoploom.plans import customers as c
from shoploom.plans import marts as m
from shoploom.plans import reports as r
from shoploom.plans import staging as s
from shoploom.session import configure, cut, inputs_state, remove, size_of, unique_path, write_files
from shoploom.sources import sample_shop as feed
from shoploom.sources.tables import source, write_table

STORES = tuple(
    rules.Store(st.name, feed.STORE_THRESHOLDS[st.name], st.default_salesperson) for st in rules.STORES
)

# Partition column, its granularity and cluster columns of the results that are kept as tables, in the order
# in which they are built.
TABLES: dict[str, tuple[str | None, str, tuple[str, ...]]] = {
    "funnel": (None, "day", ()),
    "fct_orders": ("order_date", "day", ("email", "store", "order_type")),
    "fct_order_lines": (None, "day", ("sku", "line_item_type", "store", "color")),
    "dim_customers": (None, "day", ("email", "customer_group", "customer_type")),
    "sample_conversions": ("first_sample_order_date", "month", ("sample_order_type", "conversion_ind", "cohort_month")),
    "ad_performance": ("date_day", "day", ("channel", "campaign_name")),
    "daily_performance": ("date_day", "day", ("store",)),
    "weekly_product_sales": (None, "day", ("sku", "store", "line_item_type")),
    "monthly_cohorts": ("cohort_month", "month", ("months_since_first_order",)),
    "unit_economics": ("order_date", "day", ("store", "order_id")),
    "email_performance": (None, "day", ("channel", "email_type")),
    "web_funnel": ("session_date", "day", ("deepest_funnel_stage",)),
    "fct_shipments": ("pickup_date", "day", ("carrier", "origin_state", "destination_state")),
    "channel_mix": (None, "day", ()),
    "net_sales": (None, "day", ()),
    "product_performance": (None, "day", ()),
    "sku_performance": (None, "day", ()),
    "sample_orders": (None, "day", ()),
    "sample_sku_ranking": (None, "day", ()),
    "launch_sampling": (None, "day", ()),
}

# Fixed value: files of wide rows are dealt to a table's ranges so many bytes at a time, as shuffled they take five times the room.
DEALT_AT_ONCE = 4 * 2**30


class Shop:
    """Lazy results over the input tables in `folder`.

    The two wide ones that several results read (classified orders, order fact) are written when first asked for, under
    a name made from the state of the input files: a `Shop` made after an input was replaced builds them anew. The files
    belong to whoever made the `Shop`; `release` removes them. `materialise` builds results as tables, each read by the
    ones after it.

    `columns` names the columns of the order fact that will be read, if not all: then the two hold no others, besides what
    lifetime totals and the funnel take from classified orders. All rows and steps stay.
    """

    def __init__(self, spark: SparkSession, folder: str, columns: Iterable[str] | None = None):
        self.spark, self.folder = configure(spark), folder
        self.columns = None if columns is None else [n for n in c.FCT_ORDERS if n in set(columns)]
        if columns is not None and set(columns) - set(self.columns):
            raise ValueError(f"not in the order fact: {sorted(set(columns) - set(self.columns))}")
        self.paths: list[str] = []
        self.as_of = F.lit(feed.AS_OF_ORDERS).cast("date")
        self.events_as_of = F.lit(feed.AS_OF_EVENTS).cast("date")

    def table(self, name: str) -> DataFrame:
        return source(self.spark, self.folder, name)

    @cached_property
    def state(self) -> str:
        return inputs_state(self.spark, self.folder)

    def _cut(self, name: str, make, columns: list[str] | None = None) -> DataFrame:
        df, path = cut(self.spark, name, self.state, make, columns)
        self.paths.append(path)
        return df

    def table_of(self, name: str, target: str | None = None) -> DataFrame:
        """Write one result with its partitions and clusters and read it."""
        partition, granularity, clusters = TABLES[name]
        path = f"{target.rstrip('/')}/{name}" if target else unique_path(self.spark, f"table-{name}")
        self.paths.append(path)
        if name == "weekly_product_sales":  # grouped in the ranges of its clusters, which spares the finished rows a shuffle
            return write_table(
                m.weekly_product_sales(self.fct_order_lines, clusters), path, partition, granularity, clusters, ranged=True
            )
        if name == "fct_order_lines":  # wide, with their order's context: what the join has shuffled goes before they are dealt
            rows = unique_path(self.spark, f"rows-{name}")
            try:
                write_files(self.fct_order_lines, rows)
                runs = -(-size_of(self.spark, rows) // DEALT_AT_ONCE)
                return write_table(self.spark.read.parquet(rows), path, partition, granularity, clusters, runs=runs)
            finally:
                remove(self.spark, rows)
        return write_table(getattr(self, name), path, partition, granularity, clusters)

    def materialise(self, target: str, names: Iterable[str] = tuple(TABLES)) -> dict[str, DataFrame]:
        """Build tables under the folder `target`, in order; from then on this `Shop` reads them wherever a result is asked for."""
        wanted = set(names)
        built = {}
        for name in (n for n in TABLES if n in wanted):
            columns = getattr(self, name).columns
            built[name] = self.table_of(name, target)
            self.__dict__[name] = built[name].select(*columns)
        return built

    def release(self) -> None:
        """Remove the files of this `Shop`, after which its results can't be run any more."""
        for path in self.paths:
            remove(self.spark, path)
        self.paths.clear()

    # feeds
    stores = STORES

    def by_store(self, df: DataFrame) -> dict[str, DataFrame]:
        """A feed as its stores deliver it."""
        return feed.by_store(df, [st.name for st in STORES])

    @cached_property
    def orders_feed(self) -> DataFrame:
        return feed.orders(self.spark, self.folder)

    @cached_property
    def lines_feed(self) -> DataFrame:
        return feed.order_lines(self.spark, self.folder)

    @cached_property
    def customers_feed(self) -> DataFrame:
        return feed.customers(self.spark, self.folder)

    @cached_property
    def events_feed(self) -> DataFrame:
        return feed.events(self.spark, self.folder)

    @cached_property
    def sku_lookup(self) -> DataFrame:
        return feed.sku_lookup(self.spark, self.folder)

    # staging
    @cached_property
    def orders(self) -> DataFrame:
        return s.stage_orders(self.orders_feed, STORES)

    @cached_property
    def lines(self) -> DataFrame:
        return s.stage_order_lines(self.lines_feed, STORES)

    @cached_property
    def named_lines(self) -> DataFrame:
        """Lines that a plan joins first and types then."""
        return s.name_order_lines(self.lines_feed, STORES)

    @staticmethod
    def type_lines(named: DataFrame) -> DataFrame:
        return s.type_order_lines(named, STORES)

    @cached_property
    def customers(self) -> DataFrame:
        return s.stage_customers(self.customers_feed)

    @cached_property
    def events(self) -> DataFrame:
        return s.stage_events(self.events_feed, self.events_as_of)

    @cached_property
    def social_ads(self) -> DataFrame:
        return s.stage_social_ads(feed.social_ads(self.spark, self.folder))

    @cached_property
    def search_ads(self) -> DataFrame:
        return s.stage_search_ads(feed.search_stats(self.spark, self.folder), feed.search_campaigns(self.spark, self.folder))

    @cached_property
    def email_campaigns(self) -> DataFrame:
        return s.stage_email_campaigns(feed.email_campaigns(self.spark, self.folder))

    @cached_property
    def email_flows(self) -> DataFrame:
        return s.stage_email_flows(feed.email_flows(self.spark, self.folder))

    @cached_property
    def shipments(self) -> DataFrame:
        return s.stage_shipments(feed.shipments(self.spark, self.folder))

    # orders and customers
    @cached_property
    def classified(self) -> DataFrame:
        """Read by the lifetime totals, twice by the funnel, and by reports: written once."""
        plan = c.classify_orders(self.orders, self.lines, feed.MIN_SUBTOTAL)
        wanted = None if self.columns is None else [n for n in plan.columns if n in {*c.ORDER_CORE, *self.columns}]
        return self._cut("classified", lambda: plan, wanted)

    @cached_property
    def lifetime(self) -> DataFrame:
        return c.lifetime_metrics(self.classified)

    @cached_property
    def households(self) -> DataFrame:
        return c.households(self.orders)

    @cached_property
    def funnel(self) -> DataFrame:
        return c.customer_funnel(self.classified)

    @cached_property
    def fct_orders_plan(self) -> DataFrame:
        return c.fct_orders(self.classified, self.funnel, self.columns)

    @cached_property
    def fct_orders(self) -> DataFrame:
        """Read by every mart and report on orders: written once."""
        return self._cut("fct_orders", lambda: self.fct_orders_plan, self.columns)

    def line_context(self) -> list[str] | None:
        return None if self.columns is None else [n for n in c.ORDER_CONTEXT if n in self.columns]

    @cached_property
    def fct_order_lines(self) -> DataFrame:
        return c.fct_order_lines(self.named_lines, self.fct_orders, context=self.line_context(), typed=self.type_lines)

    @cached_property
    def enriched_lines(self) -> DataFrame:
        """With the whole context of an order, lines are looked up by sku before they carry it. They are written then, so that the
        rows of this shuffle are gone before those of the next come."""
        if self.line_context() == c.LINE_CONTEXT:
            return self.report_lines
        looked_up = self._cut("looked_up_lines", lambda: r.look_up(self.named_lines, self.sku_lookup).drop(*s.UNREAD))
        lines = c.fct_order_lines(
            looked_up, self.fct_orders, extra=("cancel_reason", "financial_status"), context=self.line_context(),
            typed=self.type_lines, beside=r.ATTRIBUTES,
        )
        detail = [n for n in lines.columns if n not in ("sku", *r.ATTRIBUTES, *c.FOLLOWS)]
        return r.enrich_lines(lines.select("sku", *detail, *c.FOLLOWS, *r.ATTRIBUTES))

    @cached_property
    def report_lines(self) -> DataFrame:
        """The same lines for reports, which carry little context and group by sku: joined by sku last, they lie so already."""
        wide = c.fct_order_lines(
            self.named_lines, self.fct_orders, extra=("cancel_reason", "financial_status"), context=self.line_context(), typed=self.type_lines
        )
        return r.enrich_lines(wide, self.sku_lookup)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return c.dim_customers(self.customers, self.funnel, self.fct_orders, self.as_of, feed.SEGMENTS)

    # marts
    @cached_property
    def sample_conversions(self) -> DataFrame:
        return m.sample_conversions(self.funnel, self.dim_customers, self.fct_orders)

    @cached_property
    def ad_performance(self) -> DataFrame:
        return m.ad_performance(self.social_ads, self.search_ads)

    @cached_property
    def daily_performance(self) -> DataFrame:
        return m.daily_performance(self.fct_orders, self.ad_performance)

    @cached_property
    def weekly_product_sales(self) -> DataFrame:
        return m.weekly_product_sales(self.fct_order_lines)

    @cached_property
    def monthly_cohorts(self) -> DataFrame:
        return m.monthly_cohorts(self.dim_customers, self.fct_orders)

    @cached_property
    def unit_economics(self) -> DataFrame:
        return m.unit_economics(self.fct_orders, self.daily_performance)

    @cached_property
    def demand_features(self) -> DataFrame:
        return m.demand_features(self.fct_order_lines, self.daily_performance)

    @cached_property
    def email_performance(self) -> DataFrame:
        return m.email_performance(self.email_campaigns, self.email_flows)

    @cached_property
    def sessions(self) -> DataFrame:
        return m.session_funnel(self.events)

    @cached_property
    def web_funnel(self) -> DataFrame:
        return m.web_funnel(self.sessions)

    @cached_property
    def fct_shipments(self) -> DataFrame:
        return m.fct_shipments(self.shipments)

    # weekly reports
    @cached_property
    def channel_mix(self) -> DataFrame:
        return r.channel_mix(self.fct_orders)

    @cached_property
    def net_sales(self) -> DataFrame:
        return r.net_sales(self.fct_orders)

    @cached_property
    def product_performance(self) -> DataFrame:
        return r.product_performance(self.report_lines)

    @cached_property
    def sku_performance(self) -> DataFrame:
        return r.sku_performance(self.report_lines)

    @cached_property
    def sample_orders(self) -> DataFrame:
        return r.sample_orders(self.fct_orders, self.report_lines)

    @cached_property
    def sample_sku_ranking(self) -> DataFrame:
        return r.sample_sku_ranking(self.report_lines)

    @cached_property
    def launch_sampling(self) -> DataFrame:
        return r.launch_sampling(self.report_lines)
