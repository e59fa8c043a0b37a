from __future__ import annotations

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F
from rows import bag

from tillscope.operators import area_hour_counts, build_catalogue, split_events
from tillscope.operators.catalogue import size_dimensions
from tillscope.plans import run_retail_job, save_catalogues
from tillscope.plans.retail_job import catalogue_by_hour
from tillscope.scratch import remove_folders, scratch_folder
from tillscope.schemas import AREA_HOUR, CATALOGUE, SAVED_CATALOGUE
from tillscope.sinks import (
    create_area_hour_table,
    refresh_area_hour_path,
    refresh_area_hour_table,
    save_area_hour_table,
    save_catalogue,
    write_catalogue,
)
from tillscope.operators.spread import numbered
from tillscope.sinks.by_hour import hour_counts, in_hour_tasks, session_settings, with_hour_task
from tillscope.sources import load_catalogue


def lines(spark, hours, city="A"):
    rows = [
        ("c", f"p{i}", hour, city, "S", "000001", "a \"b\", c", "cat", "sub", "Desk")
        for hour, n in hours.items()
        for i in range(n)
    ]
    return spark.createDataFrame(rows, CATALOGUE)


@pytest.fixture
def table(spark):
    return f"area_{uuid.uuid4().hex}"


def test_save_and_load(spark, tmp_path):
    catalogue = lines(spark, {"20-06-2019-0": 3, "20-06-2019-10": 2, "2019-06-20": 1, None: 1})
    path = str(tmp_path / "saved")
    save_catalogue(catalogue, path)
    loaded = load_catalogue(spark, path)
    assert loaded.schema.simpleString() == SAVED_CATALOGUE.simpleString()
    assert bag(loaded.select(*CATALOGUE.names)) == bag(catalogue)
    # One file per hour, and the hour is not in it.
    assert len(glob.glob(f"{path}/Timestamp=20-06-2019-0/part-*.csv")) == 1
    with open(glob.glob(f"{path}/Timestamp=20-06-2019-10/part-*.csv")[0]) as file:
        assert file.readline().strip() == ",".join(SAVED_CATALOGUE.names[:-1])

    plan = loaded.filter("Timestamp = '20-06-2019-0'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(Timestamp" in plan

    save_catalogue(lines(spark, {"x": 1}), path)
    assert load_catalogue(spark, path).count() == 1


def test_awkward_text_survives_saving(spark, tmp_path):
    texts = ["a,b", '"', 'say "hi", ok', "back\\slash", "end\\", ",\\", '\\",', "ünï", "=1+1", "'"]
    rows = [
        ("c", f"p{i}", "h", text, "S", "z", text, text, "s", "Desk")
        for i, text in enumerate(texts)
    ]
    catalogue = spark.createDataFrame(rows, CATALOGUE)
    path = str(tmp_path / "saved")
    save_catalogue(catalogue, path)
    assert bag(load_catalogue(spark, path).select(*CATALOGUE.names)) == bag(catalogue)


def test_saving_leaves_the_session_as_it_was(spark, tmp_path):
    keys = (
        "spark.sql.sources.partitionOverwriteMode",
        "hive.exec.dynamic.partition.mode",
    )
    before = [spark.conf.get(key, None) for key in keys]
    save_catalogue(lines(spark, {"x": 1}), str(tmp_path / "saved"))
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        refresh_area_hour_table(area_hour_counts(lines(spark, {"x": 1})), "no_such_table")
    assert [spark.conf.get(key, None) for key in keys] == before


def test_hot_hour_is_written_by_several_tasks(spark, tmp_path, raw_paths, customers, products):
    rows = [("c1", "p1", "h-0", "Desk")] * 300
    rows += [("c1", "p1", f"h-{i % 5 + 1}", "Desk") for i in range(50)]
    source = str(tmp_path / "events")
    spark.createDataFrame(
        rows, "CustomerId string, ProductId string, Timestamp string, Channel string"
    ).write.parquet(source)
    events = spark.read.parquet(source)
    catalogue = catalogue_by_hour(
        events,
        size_dimensions(customers, products),
        hour_counts(events, "Timestamp"),
        rows_per_piece=50,
    )
    path = str(tmp_path / "saved")
    write_catalogue(catalogue, path)
    assert load_catalogue(spark, path).count() == 350
    assert len(glob.glob(f"{path}/Timestamp=h-0/part-*.csv")) > 1
    assert len(glob.glob(f"{path}/Timestamp=h-3/part-*.csv")) == 1


def test_no_task_holds_two_pieces(spark, tmp_path):
    """200 pieces of one hour and some small hours around it."""
    source = str(tmp_path / "events")
    hour = F.when(F.col("id") < 20_000, "h-5").otherwise(F.concat(F.lit("h-"), F.col("id") % 10))
    spark.range(20_300, numPartitions=3).select(hour.alias("Timestamp")).write.parquet(source)
    events = numbered(spark.read.parquet(source))
    counts = hour_counts(events, "Timestamp")
    placed, tasks = with_hour_task(events, "Timestamp", counts, rows_per_piece=100)
    assert tasks == 203
    piece = F.pmod(F.xxhash64("RowPosition"), F.lit(201))
    hot = placed.filter("Timestamp = 'h-5'").groupBy("HourTask").agg(
        F.countDistinct(piece).alias("pieces")
    )
    assert hot.agg(F.max("pieces")).first()[0] == 1
    assert hot.count() == 201
    sizes = in_hour_tasks(placed, tasks).groupBy(F.spark_partition_id()).count()
    # Pieces are dealt by a hash, so they differ; small hours may stand beside one.
    assert sizes.agg(F.max("count")).first()[0] < 100 + 60 + 100
    assert in_hour_tasks(placed, tasks).count() == 20_300


def test_outer_spaces_survive_and_line_breaks_are_refused(spark, tmp_path):
    path = str(tmp_path / "saved")
    rows = [("c", "p", "h", "  lead", "S", "z", "trail  ", " both ", "s", "Desk")]
    catalogue = spark.createDataFrame(rows, CATALOGUE)
    save_catalogue(catalogue, path)
    assert bag(load_catalogue(spark, path).select(*CATALOGUE.names)) == bag(catalogue)
    for broken in ("a\nb", "a\rb"):
        with pytest.raises(Exception, match="line break"):
            save_catalogue(catalogue.withColumn("Product", F.lit(broken)), path)


def test_large_hour_of_unknown_size_is_cut(spark, tmp_path):
    catalogue = spark.range(40_000, numPartitions=4).select(
        *(F.concat(F.lit("v"), F.hash("id")).alias(name) for name in CATALOGUE.names)
    )
    hour = F.when(F.rand(1) < 0.9, "hot").otherwise("cold")
    catalogue = catalogue.withColumn("Timestamp", hour)
    path = str(tmp_path / "saved")
    save_catalogue(catalogue, path, rows_per_piece=10_000)
    assert load_catalogue(spark, path).count() == 40_000
    assert len(glob.glob(f"{path}/Timestamp=hot/part-*.csv")) > 1


def test_an_hour_of_equal_rows_is_cut(spark, tmp_path):
    row = tuple(f"v{k}" for k in range(len(CATALOGUE.names)))
    catalogue = spark.createDataFrame([row], CATALOGUE).crossJoin(spark.range(0, 40_000, 1, 1))
    catalogue = catalogue.drop("id").withColumn("Timestamp", F.lit("hot"))
    path = str(tmp_path / "saved")
    save_catalogue(catalogue, path, rows_per_piece=10_000)
    assert load_catalogue(spark, path).count() == 40_000
    sizes = [sum(1 for _ in open(file)) for file in glob.glob(f"{path}/Timestamp=hot/part-*.csv")]
    assert len(sizes) > 2 and max(sizes) < 30_000


def test_saving_replaces_all_hours_in_any_overwrite_mode(spark, tmp_path):
    path = str(tmp_path / "saved")
    save_catalogue(lines(spark, {"a": 1}), path)
    with session_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        save_catalogue(lines(spark, {"b": 1}), path)
    assert [row.Timestamp for row in load_catalogue(spark, path).collect()] == ["b"]


def test_hours_are_shuffled_before_broadcast_joins_and_after_others(
    spark, tmp_path, customers, products
):
    source = str(tmp_path / "events")
    spark.createDataFrame(
        [("c1", "p1", "h", "Desk")],
        "CustomerId string, ProductId string, Timestamp string, Channel string",
    ).write.parquet(source)
    events = spark.read.parquet(source)
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plans = [
            catalogue_by_hour(
                events,
                size_dimensions(customers, products, limit),
                hour_counts(events, "Timestamp"),
            )
            ._jdf.queryExecution()
            .executedPlan()
            .toString()
            for limit in (10**9, 0)
        ]
    # A plan is printed from its last step to its first.
    by_hour = [plan.index("REPARTITION_BY") for plan in plans]
    assert plans[0].count("BroadcastHashJoin", 0, by_hour[0]) == 2
    assert "Join" not in plans[1][: by_hour[1]]
    assert "CustomerIdPiece" in plans[1][by_hour[1] :]
    assert "ProductIdPiece" in plans[1][by_hour[1] :]


@pytest.mark.parametrize(("limit", "rows_per_piece"), [(10**9, 10**6), (0, 1)])
def test_save_catalogues(spark, tmp_path, raw_events, customers, products, limit, rows_per_piece):
    paths = save_catalogues(
        raw_events,
        customers,
        products,
        str(tmp_path / "out"),
        staging_dir=str(tmp_path / "staged"),
        broadcast_limit=limit,
        rows_per_piece=rows_per_piece,
    )
    assert paths == {
        kind: str(tmp_path / "out" / f"{kind}Catalogue")
        for kind in ("Purchase", "AddToCart", "ProductView")
    }
    for path, events in zip(paths.values(), split_events(raw_events), strict=True):
        saved = load_catalogue(spark, path).select(*CATALOGUE.names)
        assert bag(saved) == bag(build_catalogue(events, customers, products))


def test_refresh_path_replaces_only_covered_hours(spark, tmp_path):
    path = str(tmp_path / "area")
    refresh_area_hour_path(area_hour_counts(lines(spark, {"a": 2, "b": 3})), path)
    refresh_area_hour_path(area_hour_counts(lines(spark, {"b": 1}, city="B")), path)
    expected = {("A", "S", "000001", 2, "a"): 1, ("B", "S", "000001", 1, "b"): 1}
    assert bag(spark.read.parquet(path)) == expected
    refresh_area_hour_path(area_hour_counts(lines(spark, {"b": 1}, city="B")), path)
    assert bag(spark.read.parquet(path)) == expected


def test_refresh_table_replaces_only_covered_hours(spark, table):
    create_area_hour_table(spark, table)
    create_area_hour_table(spark, table)
    assert spark.table(table).schema.simpleString() == AREA_HOUR.simpleString()
    refresh_area_hour_table(area_hour_counts(lines(spark, {"a": 2, "b": 3})), table)
    refresh_area_hour_table(area_hour_counts(lines(spark, {"b": 1}, city="B")), table)
    expected = {("A", "S", "000001", 2, "a"): 1, ("B", "S", "000001", 1, "b"): 1}
    assert bag(spark.table(table)) == expected
    refresh_area_hour_table(area_hour_counts(lines(spark, {"b": 1}, city="B")), table)
    assert bag(spark.table(table)) == expected
    spark.sql(f"DROP TABLE {table}")


def test_save_table(spark, table):
    catalogue = lines(spark, {"a": 2, "b": 3})
    save_area_hour_table(area_hour_counts(catalogue), table)
    assert bag(spark.table(table)) == bag(area_hour_counts(catalogue))
    assert dict(spark.table(table).dtypes)["Count"] == "bigint"
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        save_area_hour_table(area_hour_counts(catalogue), table)
    spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_count_over_the_int_range_is_an_error(spark, tmp_path, ansi):
    counts = area_hour_counts(lines(spark, {"a": 1})).withColumn("Count", F.lit(2**31))
    with (
        session_settings(spark, {"spark.sql.ansi.enabled": ansi}),
        pytest.raises(Exception, match="does not fit an int"),
    ):
        refresh_area_hour_path(counts, str(tmp_path / "area"))


def test_whole_job(spark, tmp_path, raw_paths, table):
    report = run_retail_job(
        spark,
        raw_paths["customers"],
        raw_paths["products"],
        raw_paths["events"],
        str(tmp_path / "out"),
        area_table=table,
        channel="Desk",
    )
    assert [tuple(r) for r in report.top_by_channel.collect()] == [
        ("p1", "Cat Bed", "Desk", 1),
        ("p2", "Cable, 2 m", "Desk", 1),
    ]
    assert [tuple(r) for r in report.top_by_category.collect()] == [
        ("p2", "Cable, 2 m", "Electronics", 1)
    ]
    assert [tuple(r) for r in report.by_area_hour.collect()] == [("Aville", "AA", "008014", 2)]
    assert bag(spark.table(table)) == {("Aville", "AA", "008014", 2, "20-06-2019-0"): 1}
    assert spark.table("PurchaseCatalogue").count() == report.purchase_catalogue.count() == 2
    spark.sql(f"DROP TABLE {table}")


def test_whole_job_leaves_its_outputs_and_one_folder(spark, tmp_path, raw_paths, table):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    report = run_retail_job(
        spark,
        raw_paths["customers"],
        raw_paths["products"],
        raw_paths["events"],
        str(tmp_path / "out"),
        area_table=table,
    )
    assert set(os.listdir(shared)) - before == {os.path.basename(report.scratch)}
    remove_folders(spark, report.scratch)
    assert set(os.listdir(shared)) == before
    spark.sql(f"DROP TABLE {table}")


def test_folder_names_with_quotes(spark, tmp_path, table):
    create_area_hour_table(spark, table, str(tmp_path / "it's"))
    refresh_area_hour_table(area_hour_counts(lines(spark, {"a": 2})), table)
    assert spark.table(table).count() == 1
    assert os.listdir(tmp_path / "it's")
    spark.sql(f"DROP TABLE {table}")


def test_whole_job_on_a_log_without_purchases(spark, tmp_path, raw_paths, table):
    log = tmp_path / "log.json"
    log.write_text('{"timestamp":"1-1-2019 1:1","CustomerId":"c1","EventType":{}}\n')
    report = run_retail_job(
        spark,
        raw_paths["customers"],
        raw_paths["products"],
        str(log),
        str(tmp_path / "out"),
        area_table=table,
    )
    for result in (*report[:4], spark.table(table)):
        assert result.count() == 0
    spark.sql(f"DROP TABLE {table}")


def test_scratch_folder_is_in_the_shared_folder(spark):
    first, second = (scratch_folder(spark, "x") for _ in range(2))
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))
