"""The checked queries: every operator over the star-schema test tables.

Dates lie inside the test data (orders end on 2001-08-01, events are moved to
May 2001). Quotients that depend on summing doubles are rounded here, so that two
engines agree; the operators themselves do not round.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens import schemas
from basketlens.functions.sql import exact_sum, named, ratio
from basketlens.operators import (
    actions, attribution, churn, dashboards, drift, experiments, explain, metrics, models, prep, quality, sessions, smote, tuning,
)
from basketlens.plans import scoring, training
from basketlens.plans.marts import Staged
from basketlens.session import scratch_path
from basketlens.sources import readers
from basketlens.sources.keyed import KeyedTable
from basketlens.sources.layers import FolderLayer
from basketlens.sources.registry import ModelRegistry
from basketlens.sources.starschema import StarSchema
from basketlens.streaming import requests

TRAIN_SNAPSHOT = "2001-05-20"
SCORE_SNAPSHOT = "2001-08-02"
LEGACY_CUTOFF = "2001-06-01"
SALT = "cart-shipping-"
SEED = 42

# A known model, so that everything after scoring can be checked to the digit.
KNOWN_INTERCEPT = 1.2
KNOWN_WEIGHTS = {
    "recency_days": 0.002, "tenure_days": -0.0002, "frequency_60d": -0.5, "frequency_30d": -0.5,
    "frequency_all_time": -0.02, "total_events": -0.01, "view_to_cart_rate": 0.1,
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.selectExpr(*[f"round(`{c}`, {digits}) AS `{c}`" if c in columns else f"`{c}`" for c in df.columns])


def _shop(spark: SparkSession, sf: str) -> Staged:
    return Staged(StarSchema(spark, sf))


# --- sources -------------------------------------------------------------------------------


# Rows of a compressed part file, which one task reads.
PACKED_ROWS = 1_000_000


def _write_csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """With spaced, capitalized headers; ``packed`` in gzip files of at most PACKED_ROWS rows."""
    titled = df.toDF(*[c.replace("_", " ").title() for c in df.columns])
    gzip = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": PACKED_ROWS} if packed else {}
    titled.write.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS", **gzip).csv(path)


@query
def src_csv_roundtrip(spark, sf):
    """Users as CSV with spaced, capitalized headers, loaded back under their schema."""
    path = scratch_path(spark, "csv") + "/users.csv"
    _write_csv(StarSchema(spark, sf).users(), path)
    return readers.read_csv_table(spark, path, schemas.USERS)


@query
def load_report(spark, sf):
    """All six tables from CSV into a layer; one folder is not readable as its table."""
    folder, raw = scratch_path(spark, "csv"), FolderLayer(spark, scratch_path(spark, "raw"))
    shop = StarSchema(spark, sf)
    for name in schemas.SOURCE_SCHEMAS:
        _write_csv(getattr(shop, name)(), f"{folder}/{name}.csv", packed=True)
    return readers.load_csv_folder(spark, folder, raw)


@query
def src_inventory_items(spark, sf):
    return StarSchema(spark, sf).inventory_items()


# --- staging -------------------------------------------------------------------------------


@query
def stg_users(spark, sf):
    return _shop(spark, sf).users()


@query
def stg_products(spark, sf):
    return _shop(spark, sf).products()


@query
def stg_orders(spark, sf):
    from basketlens.operators.staging import stg_orders as stage

    return stage(StarSchema(spark, sf).orders(count_items=True))


@query
def stg_order_items(spark, sf):
    return _shop(spark, sf).order_items()


@query
def stg_events(spark, sf):
    return _shop(spark, sf).events()


# --- sessions ------------------------------------------------------------------------------


def _sessions(spark, sf) -> DataFrame:
    return sessions.fct_sessions(_shop(spark, sf).events())


@query
def fct_sessions(spark, sf):
    return _sessions(spark, sf)


@query
def mart_funnel(spark, sf):
    return sessions.mart_funnel(_sessions(spark, sf))


@query
def user_cohorts(spark, sf):
    return sessions.user_cohorts(_sessions(spark, sf))


@query
def user_activities(spark, sf):
    return sessions.user_activities(_sessions(spark, sf))


@query
def mart_retention(spark, sf):
    """The days come from the events, which is cheaper than building the sessions for them."""
    events = _shop(spark, sf).events()
    days = events.selectExpr("to_date(min(created_at))", "to_date(max(created_at))").first()
    return sessions.mart_retention(sessions.fct_sessions(events), tuple(days))


# --- churn marts ---------------------------------------------------------------------------


@query
def active_users(spark, sf):
    return churn.active_users(_shop(spark, sf).orders(), TRAIN_SNAPSHOT)


@query
def rfm(spark, sf):
    return churn.rfm(_shop(spark, sf).orders(), TRAIN_SNAPSHOT)


@query
def windowed_rfm(spark, sf):
    return churn.windowed_rfm(_shop(spark, sf).orders(), TRAIN_SNAPSHOT)


@query
def engagement(spark, sf):
    return churn.engagement(_events_until(spark, sf, TRAIN_SNAPSHOT), TRAIN_SNAPSHOT)


@query
def monetary(spark, sf):
    shop = _shop(spark, sf)
    return rounded(churn.monetary(shop.order_items(), shop.orders(), LEGACY_CUTOFF), "total_spend", digits=6)


def _events_until(spark, sf, snapshot) -> DataFrame:
    from basketlens.operators.staging import stg_events as stage

    return stage(StarSchema(spark, sf).events(until=snapshot))


def _features(spark, sf) -> DataFrame:
    shop = _shop(spark, sf)
    return churn.churn_features(shop.users(), shop.orders(), _events_until(spark, sf, TRAIN_SNAPSHOT), TRAIN_SNAPSHOT)


def _scoring(spark, sf) -> DataFrame:
    shop = _shop(spark, sf)
    return churn.churn_scoring(shop.users(), shop.orders(), _events_until(spark, sf, SCORE_SNAPSHOT), SCORE_SNAPSHOT)


def _train_set(spark, sf) -> DataFrame:
    return churn.train_set(_features(spark, sf), churn.churn_labels(_shop(spark, sf).orders(), TRAIN_SNAPSHOT))


def _legacy_features(spark, sf) -> DataFrame:
    shop = _shop(spark, sf)
    return churn.mart_churn_features(shop.orders(), shop.order_items(), LEGACY_CUTOFF)


@query
def churn_features(spark, sf):
    return _features(spark, sf)


@query
def churn_labels(spark, sf):
    return churn.churn_labels(_shop(spark, sf).orders(), TRAIN_SNAPSHOT)


@query
def churn_scoring(spark, sf):
    return _scoring(spark, sf)


@query
def mart_churn_features(spark, sf):
    return rounded(_legacy_features(spark, sf), "monetary", "avg_order_value", digits=6)


@query
def mart_churn_inference(spark, sf):
    shop = _shop(spark, sf)
    mart = churn.mart_churn_inference(shop.orders(), shop.order_items())
    return rounded(mart, "monetary", "avg_order_value", digits=6)


@query
def train_set(spark, sf):
    return _train_set(spark, sf)


# --- feature preparation -------------------------------------------------------------------


@query
def class_balance(spark, sf):
    return prep.class_balance(_train_set(spark, sf), churn.TARGET)


@query
def class_weights(spark, sf):
    return prep.class_weights(_train_set(spark, sf), churn.TARGET)


def _with_gaps(spark, sf) -> DataFrame:
    """Features in which users without events have no event counts (before they become 0)."""
    counts = ["total_events", "view_count", "session_count"]
    return _features(spark, sf).selectExpr(
        "user_id", "recency_days", *[f"CASE WHEN total_events > 0 THEN {c} END AS {c}" for c in counts]
    )


@query
def impute_median(spark, sf):
    layer = FolderLayer(spark, scratch_path(spark, "gaps"))
    layer.replace("gaps", _with_gaps(spark, sf))
    return prep.impute_median(layer.read("gaps"), ["recency_days", "total_events", "view_count", "session_count"])


@query
def scale_standard(spark, sf):
    features = _features(spark, sf).select("user_id", *churn.NUMERIC_FEATURES)
    return rounded(prep.scale_standard(features, churn.NUMERIC_FEATURES), *churn.NUMERIC_FEATURES, digits=6)


@query
def encode_onehot(spark, sf):
    """The encoder's nonzero slots as (user, feature, level)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    df = _features(spark, sf).select("user_id", *churn.CATEGORICAL_FEATURES)
    stages, hot = models.onehot_stages(churn.CATEGORICAL_FEATURES)
    fitted = Pipeline(stages=stages).fit(df)
    labels = dict(zip(churn.CATEGORICAL_FEATURES, fitted.stages[1].labelsArray))
    slots = [
        F.struct(
            F.lit(c).alias("feature"),
            F.element_at(
                F.array(*[F.lit(v) for v in labels[c]]), F.array_position(vector_to_array(h), 1.0).cast("int")
            ).alias("level"),
        )
        for c, h in zip(churn.CATEGORICAL_FEATURES, hot)
    ]
    return fitted.transform(df).select("user_id", F.inline(F.array(*slots)))


def _dummies(spark, sf, df: DataFrame) -> DataFrame:
    levels = prep.category_levels(_train_set(spark, sf), churn.CATEGORICAL_FEATURES)
    return prep.encode_dummies(df.select("user_id", *churn.CATEGORICAL_FEATURES), levels)


@query
def encode_dummies(spark, sf):
    return _dummies(spark, sf, _train_set(spark, sf))


@query
def aligned_features(spark, sf):
    """Scoring rows in the columns of a model that also knows a retired source."""
    encoded = _dummies(spark, sf, _scoring(spark, sf))
    wanted = ["user_id", "gender_M", "traffic_source_Affiliate", "traffic_source_Email", "traffic_source_Facebook",
              "traffic_source_Organic", "traffic_source_Search"]
    return prep.align_columns(encoded, wanted)


@query
def stratified_split(spark, sf):
    return prep.stratified_split(_train_set(spark, sf), churn.TARGET, seed=SEED).select("user_id", churn.TARGET, "is_test")


@query
def plain_split(spark, sf):
    return prep.plain_split(_legacy_features(spark, sf), seed=SEED).select("user_id", churn.TARGET, "is_test")


@query
def stratified_folds(spark, sf):
    return prep.stratified_folds(_train_set(spark, sf), churn.TARGET, seed=SEED).select("user_id", churn.TARGET, "fold")


# --- scores under the known model ----------------------------------------------------------


def _known(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", f"round({models.linear_score(KNOWN_WEIGHTS, KNOWN_INTERCEPT)}, 6) AS churn_probability")


def _scores(spark, sf) -> DataFrame:
    scored = actions.churn_scores(_known(_scoring(spark, sf)))
    return rounded(scored, "expected_uplift_value", digits=6)


@query
def confusion(spark, sf):
    return metrics.confusion(_known(_train_set(spark, sf)), churn.TARGET, "churn_probability", 0.5)


@query
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(_known(_train_set(spark, sf)), churn.TARGET, "churn_probability"), "roc_auc")


@query
def avg_precision(spark, sf):
    found = metrics.average_precision(_known(_train_set(spark, sf)), churn.TARGET, "churn_probability")
    return rounded(found, "average_precision")


@query
def churn_scores(spark, sf):
    return _scores(spark, sf)


@query
def churn_predictions(spark, sf):
    return actions.churn_predictions(_known(_scoring(spark, sf))).drop("prediction_ts")


@query
def retention_targets(spark, sf):
    return actions.retention_targets(_scores(spark, sf))


@query
def score_requests(spark, sf):
    """A request per order line, asking for the user with the product's number."""
    items = StarSchema(spark, sf).raw("lineitem")
    asked = items.selectExpr("l_orderkey AS request_id", "l_partkey AS user_id")
    return actions.answer_requests(asked, _known(actions.asked_only(asked, _scoring(spark, sf))))


@query
def score_stream(spark, sf):
    """The same requests as a stream of files, answered batch by batch until none is left."""
    layer = FolderLayer(spark, scratch_path(spark, "stream"))
    items = StarSchema(spark, sf).raw("lineitem")
    asked = items.selectExpr("l_orderkey AS request_id", "l_partkey AS user_id")
    asked.repartition(4).write.json(layer.path("requests"))
    features = KeyedTable(spark, layer.path("features"), "user_id")
    features.replace(_scoring(spark, sf))
    stream = requests.read_requests(spark, layer.path("requests"), files_per_trigger=2)
    running = requests.serve(stream, features, _known, layer.path("answers"), layer.path("state"))
    running.awaitTermination()
    return layer.read("answers").drop("batch")


@query
def explain_linear_rows(spark, sf):
    rows = explain.linear_contributions(_scoring(spark, sf), KNOWN_WEIGHTS)
    return rounded(rows, *KNOWN_WEIGHTS, digits=6)


@query
def explain_linear(spark, sf):
    rows = explain.linear_contributions(_scoring(spark, sf), KNOWN_WEIGHTS)
    return rounded(explain.mean_absolute(rows, list(KNOWN_WEIGHTS)), "importance")


# --- dashboards ----------------------------------------------------------------------------


@query
def bi_risk_kpis(spark, sf):
    return rounded(dashboards.risk_kpis(_scores(spark, sf)), "revenue_at_risk", "avg_churn_probability", digits=6)


@query
def bi_risk_histogram(spark, sf):
    return dashboards.risk_histogram(_scores(spark, sf))


@query
def bi_risk_by_source(spark, sf):
    return rounded(dashboards.risk_by_source(_scores(spark, sf)), "avg_risk")


@query
def bi_target_list(spark, sf):
    return dashboards.target_list(_scores(spark, sf), _shop(spark, sf).users())


# --- drift ---------------------------------------------------------------------------------


@query
def drift_report(spark, sf):
    report = drift.drift_report(_features(spark, sf), _scoring(spark, sf))
    return rounded(report, "reference_mean", "current_mean", "shift_percent")


@query
def drift_histogram(spark, sf):
    return rounded(drift.drift_histogram(_features(spark, sf), _scoring(spark, sf)), "bin_start", "density")


@query
def drift_density(spark, sf):
    return rounded(drift.drift_density(_features(spark, sf), _scoring(spark, sf)), "x", "density", digits=8)


# --- data quality --------------------------------------------------------------------------

# Declared checks: (table, column, kind, argument).
FEATURE_CHECKS = [
    ("src_users", "id", "unique", None), ("src_users", "id", "not_null", 1.0),
    ("src_products", "id", "unique", None), ("src_products", "id", "not_null", 1.0),
    ("src_events", "session_id", "not_null", 1.0),
    ("stg_users", "user_id", "unique", None), ("stg_users", "user_id", "not_null", 1.0),
    ("stg_users", "traffic_source", "accepted_values", schemas.TRAFFIC_SOURCES),
    ("stg_events", "event_id", "unique", None), ("stg_events", "event_id", "not_null", 1.0),
    ("stg_events", "event_type", "not_null", 1.0),
    ("stg_events", "event_type", "accepted_values", schemas.EVENT_TYPES),
    ("stg_orders", "order_id", "unique", None), ("stg_orders", "order_id", "not_null", 1.0),
    ("stg_orders", "status", "accepted_values", schemas.ORDER_STATUSES),
    ("stg_order_items", "order_item_id", "unique", None), ("stg_order_items", "order_item_id", "not_null", 1.0),
    ("stg_order_items", "order_id", "relationships", ("stg_orders", "order_id")),
    ("stg_products", "product_id", "unique", None), ("stg_products", "product_id", "not_null", 1.0),
    ("stg_products", "cost", "not_null", 1.0),
    ("fct_sessions", "session_id", "unique", None), ("fct_sessions", "session_id", "not_null", 1.0),
    ("fct_sessions", "user_id", "relationships", ("stg_users", "user_id")),
    ("mart_funnel", "traffic_source", "unique", None), ("mart_funnel", "traffic_source", "not_null", 1.0),
    ("mart_retention", "cohort_week", "not_null", 1.0), ("mart_retention", "period_number", "not_null", 1.0),
    ("mart_churn_features", "user_id", "unique", None), ("mart_churn_features", "user_id", "not_null", 1.0),
    ("mart_churn_features", "is_churned", "accepted_values", [0, 1]),
    ("churn_features", "user_id", "unique", None), ("churn_features", "user_id", "not_null", 1.0),
    ("churn_features", "recency_days", "not_null", 1.0), ("churn_features", "frequency_60d", "not_null", 1.0),
    ("churn_labels", "user_id", "unique", None), ("churn_labels", "user_id", "not_null", 1.0),
    ("churn_labels", "is_churned", "not_null", 1.0), ("churn_labels", "is_churned", "accepted_values", [0, 1]),
]

EXPECTATIONS = [
    ("src_users", "*", "row_count", (1, 10_000_000)), ("src_users", "id", "unique", None),
    ("src_users", "email", "not_null", 0.9),
    ("churn_features", "*", "row_count", (1_000, 1_000_000)), ("churn_features", "user_id", "unique", None),
    ("churn_features", "recency_days", "not_null", 1.0), ("churn_features", "frequency_60d", "not_null", 1.0),
]


def _tables(spark, sf) -> dict[str, Callable[[], DataFrame]]:
    shop, stg = StarSchema(spark, sf), _shop(spark, sf)
    return {
        "src_users": shop.users, "src_products": shop.products, "src_events": shop.events,
        "stg_users": stg.users, "stg_products": stg.products, "stg_orders": stg.orders,
        "stg_order_items": stg.order_items, "stg_events": stg.events,
        **{name: (lambda q=QUERIES[name]: q(spark, sf)) for name in (
            "fct_sessions", "mart_funnel", "mart_retention", "mart_churn_features", "churn_features", "churn_labels")},
    }


def _suites(spark, sf, declared: Sequence[tuple]) -> list[quality.Suite]:
    tables = _tables(spark, sf)
    frames: dict[str, DataFrame] = {}

    def frame(name: str) -> DataFrame:
        if name not in frames:
            frames[name] = tables[name]()
        return frames[name]

    if any(table == "fct_sessions" for table, *_ in declared):
        # Two checks and two marts read the sessions: write them once, as a mart build does.
        layer = FolderLayer(spark, scratch_path(spark, "checked"))
        layer.replace("fct_sessions", tables["fct_sessions"]())
        facts = layer.read("fct_sessions")
        frames["fct_sessions"] = facts
        tables |= {"mart_funnel": lambda: sessions.mart_funnel(facts), "mart_retention": lambda: sessions.mart_retention(facts)}

    def check(column: str, kind: str, arg) -> quality.Check:
        if kind == "row_count":
            return quality.RowCount(*arg)
        if kind == "not_null":
            return quality.NotNull(column, arg)
        if kind == "accepted_values":
            return quality.Accepted(column, tuple(arg))
        if kind == "unique":
            return quality.Unique(column)
        return quality.References(column, frame(arg[0]), arg[1])

    by_table: dict[str, list[quality.Check]] = {}
    for table, column, kind, arg in declared:
        by_table.setdefault(table, []).append(check(column, kind, arg))
    return [quality.Suite(t, frame(t), tuple(checks)) for t, checks in by_table.items()]


@query
def dq_unique(spark, sf):
    """Product names that several products share."""
    return quality.duplicates(_shop(spark, sf).products(), "name")


@query
def dq_not_null(spark, sf):
    """NULLs in the order dates: void and open orders have no delivery."""
    columns = ["created_at", "shipped_at", "delivered_at", "returned_at"]
    checks = tuple(quality.NotNull(c) for c in columns)
    return quality.run_suite(quality.Suite("stg_orders", _shop(spark, sf).orders(), checks))


@query
def dq_not_null_mostly(spark, sf):
    checks = (quality.NotNull("shipped_at", 0.6), quality.NotNull("delivered_at", 0.6), quality.NotNull("status", 0.9))
    return quality.run_suite(quality.Suite("stg_orders", _shop(spark, sf).orders(), checks))


@query
def dq_accepted_values(spark, sf):
    """Order states outside those of fulfilled orders."""
    return quality.unaccepted(_shop(spark, sf).orders(), "status", ["Complete", "Shipped"])


@query
def dq_relationships(spark, sf):
    """Order lines of users whose clickstream is unknown."""
    shop = _shop(spark, sf)
    return quality.orphans(shop.orders(), "user_id", shop.events(), "user_id")


@query
def dq_row_count(spark, sf):
    stg = _shop(spark, sf)
    return quality.run_checkpoint([
        quality.Suite("stg_users", stg.users(), (quality.RowCount(1, 10_000_000),)),
        quality.Suite("stg_products", stg.products(), (quality.RowCount(1, 100),)),
    ])


@query
def dq_suite(spark, sf):
    return quality.run_checkpoint(_suites(spark, sf, EXPECTATIONS))


@query
def dq_checkpoint(spark, sf):
    """All declared table checks in one result."""
    return quality.run_checkpoint(_suites(spark, sf, FEATURE_CHECKS))


#: Checks of marts that a build writes.
MART_CHECKS = [c for c in FEATURE_CHECKS if c[0] in ("mart_churn_features", "churn_features", "churn_labels")]


@query
def dq_written_marts(spark, sf):
    """The checks of the feature marts as a build runs them: on the written marts, several at a time."""
    layer, suites = FolderLayer(spark, scratch_path(spark, "checked")), _suites(spark, sf, MART_CHECKS)
    with ThreadPool(len(suites)) as pool:
        results = pool.map(inheritable_thread_target(spark)(lambda suite: quality.replace_checked(layer, suite)), suites)
    return functools.reduce(DataFrame.unionByName, results)


@query
def dq_summary(spark, sf):
    return quality.summary(quality.run_checkpoint(_suites(spark, sf, EXPECTATIONS)))


# --- experiments ---------------------------------------------------------------------------


def _units(spark, sf) -> DataFrame:
    """Users as units, one row each, assigned by user id.

    A user purchased if a session did; the device is that of the largest browser name,
    the day that of the first session.
    """
    users = _sessions(spark, sf).filter("user_id IS NOT NULL").groupBy("user_id").agg(
        *named(
            reached_cart="max(has_add_to_cart)", purchased="max(has_purchase)",
            browser="max(browser)", day="to_date(min(session_start_at))",
        )
    )
    units = users.selectExpr(
        "user_id AS unit_id", "reached_cart", "purchased",
        "CASE WHEN browser = 'Safari' THEN 'Mobile' ELSE 'Desktop' END AS device", "day",
    )
    return experiments.assign(units, "unit_id", SALT)


def _written_units(spark, sf) -> DataFrame:
    """The units, written once for results that read them more than once."""
    layer = FolderLayer(spark, scratch_path(spark, "units"))
    layer.replace("units", _units(spark, sf))
    return layer.read("units")


@query
def exp_assignment(spark, sf):
    """The same units in both rollout steps."""
    return _units(spark, sf).selectExpr(
        "unit_id",
        f"{experiments.variant('unit_id', SALT, experiments.RAMP_HEALTH_CHECK)} AS health_check_variant",
        "variant AS full_variant",
    )


@query
def exp_conversion(spark, sf):
    return experiments.conversion(_units(spark, sf))


def _read_outs(df: DataFrame) -> DataFrame:
    return rounded(df, "control_value", "treatment_value", "lift", "z_score", "p_value", digits=8)


@query
def exp_ztest(spark, sf):
    return _read_outs(experiments.proportion_test(experiments.conversion(_units(spark, sf))))


@query
def exp_add_to_cart(spark, sf):
    counts = experiments.conversion(_units(spark, sf))
    return _read_outs(experiments.proportion_test(counts, "cart_units", "units"))


@query
def exp_aov(spark, sf):
    """Order value by variant of the ordering user."""
    items = _shop(spark, sf).order_items()
    values = items.groupBy("order_id", "user_id").agg(*named(order_value=exact_sum("sale_price")))
    assigned = experiments.assign(values, "user_id", SALT)
    return _read_outs(experiments.mean_test(experiments.mean_by_variant(assigned, "order_value")))


@query
def exp_segments(spark, sf):
    counts = experiments.conversion(_units(spark, sf), by=["device"])
    return _read_outs(experiments.proportion_test(counts, by=["device"]))


def _guards(spark, sf, units: DataFrame) -> DataFrame:
    shop = StarSchema(spark, sf)
    timings = shop.page_timings().filter("page = 'cart'").withColumnRenamed("user_id", "unit_id")
    tickets = shop.support_tickets().withColumnRenamed("user_id", "unit_id")
    return experiments.guardrails(timings, tickets, units)


@query
def exp_guardrail(spark, sf):
    return rounded(_guards(spark, sf, _written_units(spark, sf)), "control_latency_ms", "treatment_latency_ms", "latency_change_ms", digits=6)


@query
def exp_power(spark, sf):
    """Designs per device from the observed conversion and daily cart traffic."""
    observed = _units(spark, sf).groupBy("device").agg(
        *named(
            carts="sum(reached_cart)", buyers="sum(least(reached_cart, purchased))",
            observed_days="datediff(max(day), min(day)) + 1",
        )
    )
    designs = observed.selectExpr(
        "device", f"{ratio('buyers', 'carts')} AS baseline", f"{ratio('carts', 'observed_days')} AS daily_units"
    )
    return rounded(experiments.power_plan(designs), "baseline", "daily_units")


@query
def exp_decision(spark, sf):
    units = _written_units(spark, sf)
    primary = experiments.proportion_test(experiments.conversion(units))
    return rounded(experiments.decide(primary, _guards(spark, sf, units)), "lift", "p_value", digits=8)


# --- fitted models (rows only) -------------------------------------------------------------


def _registry(spark) -> ModelRegistry:
    return ModelRegistry(FolderLayer(spark, scratch_path(spark, "registry")))


def _training_table(spark, sf) -> DataFrame:
    """The training set, written once: fitting reads it many times."""
    layer = FolderLayer(spark, scratch_path(spark, "train"))
    layer.replace("train_set", _train_set(spark, sf))
    return layer.read("train_set")


def _legacy_table(spark, sf) -> DataFrame:
    """The first-generation features, written once."""
    layer = FolderLayer(spark, scratch_path(spark, "legacy"))
    layer.replace("legacy", _legacy_features(spark, sf))
    return layer.read("legacy")


_FITTED: dict[tuple[str, str], training.Trained] = {}


def _boosted(spark, sf) -> training.Trained:
    """The boosted model of a folder of tables, fitted once per application: several results read it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        _FITTED[key] = training.train_boosted(_training_table(spark, sf))
    return _FITTED[key]


@query
def train_baseline(spark, sf):
    return training.train_baseline(_training_table(spark, sf)).metrics


@query
def train_boosted(spark, sf):
    return _boosted(spark, sf).metrics


@query
def train_legacy(spark, sf):
    return training.train_legacy(_legacy_table(spark, sf)).metrics


@query
def tune_trials(spark, sf):
    return tuning.tune_boosted(_training_table(spark, sf)).trials


@query
def tune_best(spark, sf):
    """The best trial as it was logged: its parameters as text and its score."""
    registry = _registry(spark)
    run = tuning.tune_boosted(_training_table(spark, sf)).log(registry, training.EXPERIMENT)
    return registry.run_values(run).drop("run_id")


@query
def smote_rows(spark, sf):
    made = smote.smote(_legacy_table(spark, sf), churn.LEGACY_FEATURES, churn.TARGET)
    return rounded(made, *churn.LEGACY_FEATURES, digits=6)


@query
def smote_balance(spark, sf):
    """Class sizes after oversampling the first-generation features to parity."""
    rows = smote.smote(_legacy_table(spark, sf), churn.LEGACY_FEATURES, churn.TARGET)
    return rows.groupBy(churn.TARGET, "synthetic").agg(*named(rows="count(1)"))


@query
def run_metrics(spark, sf):
    """Params and metrics of a logged baseline run."""
    registry = _registry(spark)
    run = training.train_baseline(_training_table(spark, sf)).log(registry, training.EXPERIMENT, "baseline")
    return registry.run_values(run)


@query
def run_log(spark, sf):
    """Params and metrics of the last of three logged runs of the known model, the first two logged at once."""
    registry, scored = _registry(spark), _known(_train_set(spark, sf))
    ranked = metrics.ranking_metrics(scored, churn.TARGET, "churn_probability")
    names = ["positives", "negatives", "roc_auc", "average_precision"]
    pairs = ", ".join(f"'{c}', round(CAST({c} AS DOUBLE), 9)" for c in names)
    rows = ranked.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, value)")
    early = rows.sparkSession.createDataFrame([("roc_auc", 0.0)], "metric string, value double")

    def log_early(number: int) -> str:
        return registry.log_run(training.EXPERIMENT, f"early {number}", {}, early)

    with ThreadPool(2) as pool:
        pool.map(inheritable_thread_target(spark)(log_early), range(2))
    registry.log_run(training.EXPERIMENT, "known", KNOWN_WEIGHTS, rows)
    last = registry.latest_run(training.EXPERIMENT).first()
    return registry.run_values(last["run_id"]).selectExpr(f"'{last['run_name']}' AS run_name", "kind", "key", "text", "value")


@query
def registry_latest(spark, sf):
    """The second of two registered versions is the latest."""
    registry = _registry(spark)
    trained = _boosted(spark, sf)
    for _ in range(2):
        registry.register(training.REGISTERED_MODEL, trained.model)
    return registry.latest(training.REGISTERED_MODEL).select("name", "version")


@query
def score_model(spark, sf):
    """Batch scoring with the latest registered boosted model."""
    registry = _registry(spark)
    registry.register(training.REGISTERED_MODEL, _boosted(spark, sf).model)
    return scoring.batch_score(_scoring(spark, sf), registry)


@query
def legacy_predictions(spark, sf):
    """First-generation predictions with the model of the last run."""
    shop, registry = _shop(spark, sf), _registry(spark)
    training.train_legacy(_legacy_table(spark, sf)).log(registry, training.LEGACY_EXPERIMENT, "legacy")
    return scoring.legacy_predict(churn.mart_churn_inference(shop.orders(), shop.order_items()), registry)


@query
def explain_permutation(spark, sf):
    """On the held-out rows, which the model has not seen."""
    trained = training.train_baseline(_training_table(spark, sf))
    return explain.permutation_importance(
        trained.model, trained.test, [*churn.NUMERIC_FEATURES, *churn.CATEGORICAL_FEATURES], churn.TARGET
    )


@query
def explain_splits(spark, sf):
    table = _training_table(spark, sf)
    return explain.split_importance(_boosted(spark, sf).model, table)


def _attributed(spark, sf) -> DataFrame:
    """Shares of a boosted model of the first generation's size (the tuned least gain leaves no splits on these tables)."""
    model = training.train_boosted(_training_table(spark, sf), models.LEGACY_PARAMS).model
    return attribution.attribute(model, _scoring(spark, sf))


@query
def explain_trees_rows(spark, sf):
    """What each feature adds to a boosted model's margin of each user to be scored."""
    return _attributed(spark, sf)


@query
def explain_trees(spark, sf):
    """Mean absolute share per feature over the users to be scored."""
    shared = _attributed(spark, sf)
    own = ("user_id", attribution.MARGIN, attribution.EXPECTED)
    return attribution.importance(shared, [c for c in shared.columns if c not in own])
