"""The whole batch job: log in, catalogues, answers and area table out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.operators.catalogue import (
    BROADCAST_BYTES,
    EVENT_COLUMNS,
    Dimensions,
    build_catalogue,
    join_dimension,
    size_dimensions,
)
from tillscope.operators.events import event_lines, events_of_kind
from tillscope.operators.insights import (
    product_and_area_counts,
    rank_areas,
    split_counts,
    top_sold_by_category,
    top_sold_by_channel,
)
from tillscope.operators.spread import ROWS_PER_PIECE, divide, numbered
from tillscope.scratch import remove_folders, scratch_folder
from tillscope.schemas import CATALOGUE, EVENT_LINE, KINDS
from tillscope.sinks import (
    create_area_hour_table,
    refresh_area_hour_table,
    write_catalogue,
)
from tillscope.sinks.by_hour import hour_counts, in_hour_tasks, with_hour_task
from tillscope.sources import (
    load_catalogue,
    load_customers,
    load_events,
    load_products,
    register_catalogue,
)


class RetailReport(NamedTuple):
    """The answers. They are read from ``scratch``, which the caller may remove after use."""

    purchase_catalogue: DataFrame
    top_by_channel: DataFrame
    top_by_category: DataFrame
    by_area_hour: DataFrame
    scratch: str


def catalogue_path(output_dir: str, kind: str) -> str:
    return f"{output_dir.rstrip('/')}/{kind}Catalogue"


def stage_lines(raw: DataFrame, folder: str) -> DataFrame:
    """Write the lines of all kinds as Parquet and read them back.

    The log is parsed once for three catalogues. A task writes one file in the order of
    kinds, so a catalogue skips the pages of others. A lost executor costs a re-read of
    this table, not of the log.
    """
    event_lines(raw).sortWithinPartitions("Kind").write.parquet(folder)
    return raw.sparkSession.read.schema(EVENT_LINE).parquet(folder)


def plan_catalogue(
    raw: DataFrame, kind: str, dimensions: Dimensions, lines: DataFrame | None = None
) -> DataFrame:
    """The catalogue of one kind of event, unsaved; nothing is run or written.

    Broadcast dimensions are joined in the pass that parses the log. For others the hot
    keys are counted first, in a pass of its own; ``lines`` that are staged already
    save parsing the log for it.
    """
    if lines is None:
        events = events_of_kind(raw, kind)
    else:
        events = lines.filter(F.col("Kind") == kind)
    return build_catalogue(
        events, dimensions.customers, dimensions.products, dimensions.shuffled
    )


def catalogue_by_hour(
    events: DataFrame,
    dimensions: Dimensions,
    counts: DataFrame,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """The catalogue of staged events, laid out by hour for `write_catalogue`.

    ``counts`` are the events' `hour_counts`. The events are shuffled by hour while they
    are narrow: broadcast dimensions are joined only after that.
    """
    lines, tasks = with_hour_task(
        numbered(events.select(*EVENT_COLUMNS)), "Timestamp", counts, rows_per_piece
    )
    lines, hot = divide(lines, dimensions.shuffled, rows_per_piece)
    tables = {"CustomerId": dimensions.customers, "ProductId": dimensions.products}
    for key in dimensions.shuffled:
        lines = join_dimension(lines, tables.pop(key), key, hot[key])
    lines = in_hour_tasks(lines.drop("RowPosition"), tasks)
    for key, table in tables.items():
        lines = join_dimension(lines, table, key)
    return lines.select(*CATALOGUE.names)


def save_catalogues(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    output_dir: str,
    staging_dir: str | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> dict[str, str]:
    """Save the catalogue of each kind of event; returns their paths by kind.

    The lines are staged in a folder of the session's shared folder and removed at the
    end, or else in ``staging_dir``, which is left to the caller.
    """
    spark = raw.sparkSession
    folder = staging_dir or scratch_folder(spark, "staged")
    lines = stage_lines(raw, f"{folder}/lines")
    dimensions = size_dimensions(customers, products, broadcast_limit)
    paths = {kind: catalogue_path(output_dir, kind) for kind in KINDS}
    for kind, path in paths.items():
        events = lines.filter(F.col("Kind") == kind)
        counts = _stage(hour_counts(events, "Timestamp"), f"{folder}/hours-{kind}")
        write_catalogue(catalogue_by_hour(events, dimensions, counts, rows_per_piece), path)
    if staging_dir is None:
        remove_folders(spark, folder)
    return paths


def run_retail_job(
    spark: SparkSession,
    customers_path: str,
    products_path: str,
    events_path: str,
    output_dir: str,
    area_table: str = "ProductsSoldPerCity",
    channel: str = "Mobile",
    category: str = "Electronics",
    n: int = 5,
    staging_dir: str | None = None,
) -> RetailReport:
    """Run everything; the answers come from the saved purchase catalogue.

    The catalogue is read once, for both sets of counts that the answers and the area
    table share. The counts are small and staged in the report's ``scratch``.
    """
    paths = save_catalogues(
        load_events(spark, events_path),
        load_customers(spark, customers_path),
        load_products(spark, products_path),
        output_dir,
        staging_dir,
    )
    purchases = load_catalogue(spark, paths["Purchase"])
    register_catalogue(purchases)
    scratch = scratch_folder(spark, "counts")
    sold, areas = split_counts(_stage(product_and_area_counts(purchases), scratch))
    create_area_hour_table(spark, area_table)
    refresh_area_hour_table(areas, area_table)
    return RetailReport(
        purchases,
        top_sold_by_channel(sold, channel, n),
        top_sold_by_category(sold, category, n),
        rank_areas(areas),
        scratch,
    )


def _stage(table: DataFrame, folder: str) -> DataFrame:
    table.write.parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)
