from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from tillscope.llm import staging
from tillscope.llm.staging import scratch_tables, staged


def test_threads_write_together_and_leave_the_session_as_it_was(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    with ThreadPoolExecutor(3) as threads:
        tables = threads.map(lambda n: staged(spark.range(n), "threads"), (3, 5, 7))
        assert [table.count() for table in tables] == [3, 5, 7]
    assert spark.conf.get(setting) == before


def test_scratch_tables_are_removed(spark):
    outer = staged(spark.range(2), "outer")
    with scratch_tables(spark) as kept:
        gone, left = staged(spark.range(3), "gone"), staged(spark.range(4), "left", narrow=True)
        kept.append(left)
    folders = [staging._folders[table].removeprefix("file:") for table in (outer, gone, left)]
    assert [os.path.isdir(folder) for folder in folders] == [True, False, True]
    assert outer.count() + left.count() == 6
