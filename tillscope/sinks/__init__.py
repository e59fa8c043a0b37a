from tillscope.sinks.area_table import (
    create_area_hour_table,
    refresh_area_hour_path,
    refresh_area_hour_table,
    save_area_hour_table,
)
from tillscope.sinks.catalogue_files import save_catalogue, write_catalogue

__all__ = [
    "create_area_hour_table",
    "refresh_area_hour_path",
    "refresh_area_hour_table",
    "save_area_hour_table",
    "save_catalogue",
    "write_catalogue",
]
