"""The six source tables, derived from a TPC-H-like star schema with an event stream.

Every mapping is a projection of the table that holds the rows; joins appear only
where an attribute lives elsewhere (country of a user, order of an item). Columns
a query does not use are pruned down to the parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.sql import Moment, listed, moment, quoted, shift_days

# Fixed value: days between the event stream's dates and the last months of orders.
EVENT_SHIFT_DAYS = 8280

# How categories of the star schema read as shop categories.
SOURCE_BY_SEGMENT = {
    "AUTOMOBILE": "Search", "BUILDING": "Organic", "FURNITURE": "Facebook",
    "HOUSEHOLD": "Email", "MACHINERY": "Display",
}
SOURCE_BY_NUMBER = ["Search", "Organic", "Facebook", "Email", "Display"]
BROWSER_BY_NUMBER = ["Chrome", "Firefox", "Safari"]

# Stored columns of the tables that are read.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}

_GENDER = "CASE WHEN {0} % 2 = 0 THEN 'M' ELSE 'F' END"
_POSTAL = "lpad(CAST({0} % 100000 AS STRING), 5, '0')"
_STATUS = """CASE WHEN o_orderstatus = 'F' THEN 'Complete'
    WHEN o_orderstatus = 'O' THEN 'Shipped'
    WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'Cancelled'
    WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'Returned'
    ELSE 'Processing' END"""
_EVENT_KIND = """CASE event_type WHEN 'view' THEN 'product' WHEN 'click' THEN 'cart'
    WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'cancel'
    ELSE CASE WHEN event_id % 2 = 1 THEN 'department' ELSE 'home' END END"""
_ITEM_ID = """CAST(conv(substring(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
    to_date(l_shipdate))), 1, 15), 16, 10) AS BIGINT)"""


def _by_segment() -> str:
    cases = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in SOURCE_BY_SEGMENT.items())
    return f"CASE c_mktsegment {cases} END"


def _nth(number: str, values: list[str]) -> str:
    return f"element_at(array({listed(values)}), CAST({number} % {len(values)} + 1 AS INT))"


@dataclass(frozen=True)
class StarSchema:
    """Source tables over the parquet files of one folder."""

    spark: SparkSession
    folder: str

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(TABLES[table]).parquet(f"{self.folder.rstrip('/')}/{table}.parquet")

    def users(self) -> DataFrame:
        places = self.raw("nation").join(self.raw("region"), F.expr("n_regionkey = r_regionkey"))
        return self.raw("customer").join(places, F.expr("c_nationkey = n_nationkey")).selectExpr(
            "c_custkey AS id",
            "substring_index(c_name, '#', 1) AS first_name",
            "substring_index(c_name, '#', -1) AS last_name",
            "concat(lower(substring_index(c_name, '#', 1)), c_custkey, '@example.com') AS email",
            "CAST(c_custkey % 60 + 18 AS INT) AS age",
            f"{_GENDER.format('c_custkey')} AS gender",
            "r_name AS state",
            "concat(c_custkey, ' Main St') AS street_address",
            f"{_POSTAL.format('c_custkey')} AS postal_code",
            "concat('City ', c_custkey % 100) AS city",
            "n_name AS country",
            "CAST(c_custkey % 90 AS DOUBLE) AS latitude",
            "CAST(c_custkey % 180 AS DOUBLE) AS longitude",
            f"{_by_segment()} AS traffic_source",
            f"{moment('1995-01-01')} AS created_at",
        )

    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS id",
            "p_retailprice / 2 AS cost",
            "p_type AS category",
            "p_name AS name",
            "p_brand AS brand",
            "p_retailprice AS retail_price",
            "CASE WHEN p_partkey % 2 = 0 THEN 'Men' ELSE 'Women' END AS department",
            "concat('SKU', p_partkey) AS sku",
            "p_partkey % 10 AS distribution_center_id",
        )

    def orders(self, count_items: bool = False) -> DataFrame:
        """Orders; ``num_of_item`` stays NULL unless asked for, as it costs a join."""
        orders, items = self.raw("orders").selectExpr("*", f"{_STATUS} AS status"), "CAST(NULL AS INT)"
        if count_items:
            per_order = self.raw("lineitem").groupBy("l_orderkey").agg(F.expr("count(1) AS n_items"))
            orders = orders.join(per_order, F.expr("o_orderkey = l_orderkey"), "left")
            items = "CAST(coalesce(n_items, 0) AS INT)"
        shipped = "status IN ('Complete', 'Shipped', 'Returned')"
        return orders.selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS user_id",
            "status",
            f"{_GENDER.format('o_custkey')} AS gender",
            "o_orderdate AS created_at",
            f"CASE WHEN status = 'Returned' THEN {shift_days('o_orderdate', 10)} END AS returned_at",
            f"CASE WHEN {shipped} THEN {shift_days('o_orderdate', 1)} END AS shipped_at",
            f"CASE WHEN status IN ('Complete', 'Returned') THEN {shift_days('o_orderdate', 3)} END AS delivered_at",
            f"{items} AS num_of_item",
        )

    def order_items(self) -> DataFrame:
        """Items; their id is a digest of the line, so no order has to be numbered."""
        orders = self.raw("orders").selectExpr("*", f"{_STATUS} AS order_status")
        returned = "l_returnflag = 'R'"
        return self.raw("lineitem").join(orders, F.expr("l_orderkey = o_orderkey")).selectExpr(
            f"{_ITEM_ID} AS id",
            "l_orderkey AS order_id",
            "o_custkey AS user_id",
            "l_partkey AS product_id",
            f"{_ITEM_ID} AS inventory_item_id",
            f"CASE WHEN {returned} THEN 'Returned' ELSE order_status END AS status",
            "o_orderdate AS created_at",
            "l_shipdate AS shipped_at",
            f"CASE WHEN {returned} THEN {shift_days('o_orderdate', 3)} END AS delivered_at",
            f"CASE WHEN {returned} THEN {shift_days('o_orderdate', 10)} END AS returned_at",
            "l_extendedprice AS sale_price",
        )

    def _stream(self, until: Moment | None = None) -> DataFrame:
        events = self.raw("events")
        if until is not None:  # said on the stored column, so that the scan can skip row groups
            events = events.filter(f"ts < {moment(until, EVENT_SHIFT_DAYS)}")
        return events.selectExpr(
            "*",
            f"{shift_days('ts', -EVENT_SHIFT_DAYS)} AS created_at",
            "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
            f"{_EVENT_KIND} AS kind",
            f"concat(user_id, '-', to_date({shift_days('ts', -EVENT_SHIFT_DAYS)})) AS session_id",
        )

    def events(self, until: Moment | None = None) -> DataFrame:
        """Clickstream; a session is one user's day. ``until`` limits ``created_at``."""
        return self._stream(until).selectExpr(
            "event_id AS id",
            "user_id",
            "CAST(event_id % 20 + 1 AS INT) AS sequence_number",
            "session_id",
            "created_at",
            "concat('10.0.', user_id % 256, '.', event_id % 256) AS ip_address",
            "concat('City ', user_id % 100) AS city",
            "concat('State ', user_id % 50) AS state",
            f"{_POSTAL.format('user_id')} AS postal_code",
            f"{_nth('k', BROWSER_BY_NUMBER)} AS browser",
            f"{_nth('k', SOURCE_BY_NUMBER)} AS traffic_source",
            "concat('/', kind) AS uri",
            "kind AS event_type",
        )

    def page_timings(self) -> DataFrame:
        """Load time of each page shown, for experiment guardrails."""
        return self._stream().selectExpr("session_id", "user_id", "kind AS page", "value AS latency_ms")

    def support_tickets(self) -> DataFrame:
        """One ticket per error event, for experiment guardrails."""
        return self._stream().filter("event_type = 'error'").selectExpr("event_id AS ticket_id", "session_id", "user_id")

    def inventory_items(self) -> DataFrame:
        items = self.order_items().selectExpr("id AS item_id", "product_id", "created_at AS sold_at")
        return items.join(self.products(), F.expr("product_id = id"), "left").selectExpr(
            "item_id AS id",
            "product_id",
            f"{shift_days('sold_at', -30)} AS created_at",
            "sold_at",
            "cost",
            "category AS product_category",
            "name AS product_name",
            "brand AS product_brand",
            "retail_price AS product_retail_price",
            "department AS product_department",
            "sku AS product_sku",
            "distribution_center_id AS product_distribution_center_id",
        )
