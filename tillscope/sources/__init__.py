from tillscope.sources.files import (
    load_catalogue,
    load_customers,
    load_events,
    load_products,
    register_catalogue,
)

__all__ = [
    "load_catalogue",
    "load_customers",
    "load_events",
    "load_products",
    "register_catalogue",
]
