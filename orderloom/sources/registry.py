"""Which stores each feed has, and where their tables are."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class StoreSource:
    """One store's table of one feed.

    ``location`` is a table name or a parquet path. ``rename`` maps the table's own column names to
    the ones the pipelines read, for instance a connector's name for its load time.
    """

    brand: str
    location: str
    rename: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Platforms:
    """Names of the two sales platforms as they should appear in keys and rows.

    ``marketplace_tag`` marks marketplace orders inside the storefront feed: it equals the order's
    source name and occurs in the buyer's e-mail domain.
    """

    storefront: str = "Storefront"
    marketplace: str = "Marketplace"
    marketplace_tag: str = "marketplace"


# Stores per feed, display names, and the stores whose storefront feed has moved.
FEED_STORES = {
    "storefront_orders_legacy": ["STORE_A", "STORE_B", "STORE_C", "STORE_D", "STORE_E", "STORE_F"],
    "storefront_orders_replacement": ["STORE_A", "STORE_C", "STORE_E", "STORE_F", "STORE_B", "STORE_D"],
    "storefront_refunds_legacy": ["STORE_A", "STORE_B", "STORE_C", "STORE_D", "STORE_E", "STORE_F"],
    "storefront_refunds_replacement": ["STORE_A", "STORE_C", "STORE_E", "STORE_F", "STORE_B", "STORE_D"],
    "marketplace_orders": ["STORE_A", "STORE_C", "STORE_D"],
    "marketplace_returns": ["STORE_A", "STORE_C", "STORE_D"],
    "marketplace_statements": ["STORE_A", "STORE_C", "STORE_D"],
    "statement_headers": ["STORE_D", "STORE_A"],
    "statement_transactions": ["STORE_D", "STORE_A"],
    "statement_breakdowns": ["STORE_D", "STORE_A"],
}

STORE_NAMES = {
    "STORE_A": "Store A",
    "STORE_B": "Store B",
    "STORE_C": "Store C",
    "STORE_F": "Store F",
    "STORE_D": "Store D",
    "STORE_E": "Store E",
    "STORE_G": "Store G",
}

MIGRATED = ["STORE_A", "STORE_C", "STORE_E", "STORE_F", "STORE_B", "STORE_D"]


def store_mappings(
    pattern: str = "{feed}.{brand}", feeds: Mapping[str, list[str]] = FEED_STORES
) -> dict[str, list[StoreSource]]:
    """A registry with one location per feed and store, built from ``pattern``."""
    return {
        feed: [StoreSource(b.upper(), pattern.format(feed=feed, brand=b.lower())) for b in brands]
        for feed, brands in feeds.items()
    }
