"""Stored tables go when their run ends."""

import os

from wattline.session import discard, materialize, scratch, shared_dir


def tables(spark):
    folder = shared_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("table-")}


def test_scratch_removes_what_was_stored_inside(spark):
    kept = materialize(spark.range(3))
    before = tables(spark)
    with scratch(spark):
        assert materialize(spark.range(5)).count() == 5
        assert len(tables(spark)) == len(before) + 1
    assert tables(spark) == before and kept.count() == 3


def test_discard(spark):
    before = tables(spark)
    stored, other = materialize(spark.range(4)), materialize(spark.range(2))
    discard(stored)
    assert len(tables(spark) - before) == 1 and other.count() == 2
