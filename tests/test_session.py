"""Scratch folders: fresh ones for each run, old ones cleared."""

from __future__ import annotations

import os
import time

from crease.session import checkpoint_root, clear_scratch, scratch_path


def test_only_old_scratch_is_cleared(spark):
    old, new = scratch_path(spark, "old-table"), scratch_path(spark, "new-table")
    assert old != scratch_path(spark, "old-table") and old.startswith(checkpoint_root(spark))
    for path in (old, new):
        spark.range(3).write.parquet(path)
    local = old.removeprefix("file://").removeprefix("file:")
    then = time.time() - 1000 * 3600
    os.utime(local, (then, then))
    name = os.path.basename(local)
    assert name in clear_scratch(spark, older_than_hours=900)
    assert spark.read.parquet(new).count() == 3 and not os.path.exists(local)
    assert name not in clear_scratch(spark, older_than_hours=900)
