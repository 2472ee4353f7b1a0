"""The marts as one build: source tables in, tables of a layer out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame

from basketlens.functions.sql import Moment
from basketlens.operators import churn, sessions, staging
from basketlens.sources.layers import Layer


class Sources(Protocol):
    """Where the source tables come from, by method name."""

    def users(self) -> DataFrame: ...

    def products(self) -> DataFrame: ...

    def orders(self) -> DataFrame: ...

    def order_items(self) -> DataFrame: ...

    def events(self) -> DataFrame: ...


@dataclass(frozen=True)
class LoadedSources:
    """Source tables kept in a raw layer."""

    layer: Layer

    def users(self) -> DataFrame:
        return self.layer.read("users")

    def products(self) -> DataFrame:
        return self.layer.read("products")

    def orders(self) -> DataFrame:
        return self.layer.read("orders")

    def order_items(self) -> DataFrame:
        return self.layer.read("order_items")

    def events(self) -> DataFrame:
        return self.layer.read("events")

    def inventory_items(self) -> DataFrame:
        return self.layer.read("inventory_items")


@dataclass(frozen=True)
class Staged:
    """Staging projections over the sources, lazy."""

    sources: Sources

    def users(self) -> DataFrame:
        return staging.stg_users(self.sources.users())

    def products(self) -> DataFrame:
        return staging.stg_products(self.sources.products())

    def orders(self) -> DataFrame:
        return staging.stg_orders(self.sources.orders())

    def order_items(self) -> DataFrame:
        return staging.stg_order_items(self.sources.order_items())

    def events(self) -> DataFrame:
        return staging.stg_events(self.sources.events())


@dataclass(frozen=True)
class MartDates:
    features: Moment = churn.FEATURE_SNAPSHOT
    scoring: Moment = churn.SCORING_SNAPSHOT
    legacy_cutoff: Moment = churn.LEGACY_CUTOFF


def build_marts(sources: Sources, layer: Layer, dates: MartDates = MartDates()) -> list[str]:
    """Write all marts, replacing them; later marts read the written sessions."""
    stg = Staged(sources)
    layer.replace("fct_sessions", sessions.fct_sessions(stg.events()))
    facts = layer.read("fct_sessions")
    marts: dict[str, Callable[[], DataFrame]] = {
        "mart_funnel": lambda: sessions.mart_funnel(facts),
        "mart_retention": lambda: sessions.mart_retention(facts),
        "churn_features": lambda: churn.churn_features(stg.users(), stg.orders(), stg.events(), dates.features),
        "churn_labels": lambda: churn.churn_labels(stg.orders(), dates.features),
        "churn_scoring": lambda: churn.churn_scoring(stg.users(), stg.orders(), stg.events(), dates.scoring),
        "mart_churn_features": lambda: churn.mart_churn_features(stg.orders(), stg.order_items(), dates.legacy_cutoff),
        "mart_churn_inference": lambda: churn.mart_churn_inference(stg.orders(), stg.order_items()),
    }
    for name, build in marts.items():
        layer.replace(name, build())
    return ["fct_sessions", *marts]
