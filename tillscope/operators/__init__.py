from tillscope.operators.catalogue import build_catalogue
from tillscope.operators.events import EventTables, event_lines, events_of_kind, split_events
from tillscope.operators.insights import (
    area_hour_counts,
    customers_by_zip,
    customers_per_state,
    product_counts,
    products_per_category,
    rank_areas,
    sold_by_area_hour,
    top_sold_by_category,
    top_sold_by_channel,
)

__all__ = [
    "EventTables",
    "area_hour_counts",
    "build_catalogue",
    "customers_by_zip",
    "customers_per_state",
    "event_lines",
    "events_of_kind",
    "product_counts",
    "products_per_category",
    "rank_areas",
    "sold_by_area_hour",
    "split_events",
    "top_sold_by_category",
    "top_sold_by_channel",
]
