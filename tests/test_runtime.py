"""Written tables that are noted and removed."""

from __future__ import annotations

from murmuro import runtime


def test_recorded_tables_are_removed_unless_still_read(spark):
    before = runtime.written(spark.range(3), "before")
    with runtime.recorded() as outer:
        one = runtime.written(spark.range(5), "one")
        with runtime.recorded() as inner:
            two = runtime.written(spark.range(7), "two")
    later = runtime.written(spark.range(9), "later")
    assert len(outer) == 2 and len(inner) == 1 and inner[0] in outer
    # What the reader reads stays, and is named.
    assert runtime.remove_folders(spark, outer, one.where("id > 1")) == [outer[0]]
    assert one.count() == 5 and before.count() == 3 and later.count() == 9
    assert not runtime.exists_folder(spark, inner[0]) and runtime.exists_folder(spark, outer[0])
    assert runtime.remove_folders(spark, outer) == []
    assert not runtime.exists_folder(spark, outer[0])
    assert two.schema == one.schema
