"""Stage tables that are removed once nothing reads them."""

import os

import pytest

from voxmill.sources import staging


def folders(spark):
    root = staging.stage_root(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_settled_keeps_its_result_only(spark):
    before = folders(spark)

    def make():
        one = staging.stage(spark.range(100).selectExpr("id", "id % 7 AS k"), "one")
        two = staging.settled(spark, lambda: staging.stage(one, "inner").groupBy("k").count(), "two")
        assert len(folders(spark) - before) == 2  # `inner` is gone already
        return one.join(two, "k")

    made = staging.settled(spark, make, "made")
    after = folders(spark) - before
    assert len(after) == 1 and next(iter(after)).startswith("made-")
    assert made.count() == 100


def test_a_failed_scope_leaves_nothing(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), staging.scope(spark):
        staging.stage(spark.range(3), "one")
        with staging.scope(spark):
            staging.stage(spark.range(3), "two")
            raise ZeroDivisionError
    assert folders(spark) == before


def test_tables_outside_a_scope_stay(spark):
    kept = staging.stage(spark.range(5), "kept")
    with staging.scope(spark):
        staging.stage(kept, "gone")
    assert kept.count() == 5


def test_scopes_belong_to_their_thread(spark):
    from threading import Thread

    made = []
    with staging.scope(spark):
        other = Thread(target=lambda: made.append(staging.stage(spark.range(4), "other")))
        other.start()
        other.join()
    assert made[0].count() == 4
