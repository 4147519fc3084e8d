"""Owners of staged folders."""

from pathlib import Path

import pytest

from roadgauge.session import own_folders, scratch_dir, stage


def test_folders_go_with_their_owner(spark):
    frame = spark.range(10)
    free = stage(frame, "free")
    with own_folders(spark) as outer:
        kept = stage(frame, "outer")
        with own_folders(spark) as inner:
            assert stage(frame, "inner").count() == 10
            scratch_dir(spark, "never-written")
        assert len(inner) == 2 and not any(Path(p).exists() for p in inner)
        assert kept.count() == 10
    assert len(outer) == 1 and not Path(outer[0]).exists()
    assert free.count() == 10


def test_folders_go_after_an_error(spark):
    with pytest.raises(ZeroDivisionError):
        with own_folders(spark) as made:
            stage(spark.range(3), "failed")
            1 / 0
    assert len(made) == 1 and not Path(made[0]).exists()
