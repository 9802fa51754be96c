from __future__ import annotations

import pytest
from conftest import collect
from pyspark.sql import functions as F

from wardgrid.operators.bounds import fits, join_per_group, small_rows
from wardgrid.operators.grid import (
    band_ordinal,
    densify,
    drop_body_rows,
    drop_empty_columns,
    drop_empty_rows,
    heading_ordinal,
    series_lengths,
)
from wardgrid.operators.reshape import (
    headings_prefixed,
    map_measures,
    merge_series,
    pivot_series,
    select_prefixed,
    unpivot_measures,
)
from wardgrid.operators.spine import (
    attach_measures,
    build_spine,
    complete_rows,
    exclude_names,
    keys_first,
)


@pytest.mark.parametrize("block", [None, 1, 3, 4096])
def test_heading_ordinal_follows_columns_not_rows(spark, block):
    cells = [("s", 9, "open"), ("s", 5, "open"), ("s", 6, "occ"), ("s", 7, "open"), ("t", 1, "open"), ("s", 8, None), ("s", 4, None)]
    df = spark.createDataFrame(cells, "sheet string, col int, heading string")
    assert collect(heading_ordinal(df, ["sheet"], "heading", "col", block=block).select("sheet", "col", "ordinal")) == [
        ("s", 4, 0),
        ("s", 5, 0),
        ("s", 6, 0),
        ("s", 7, 1),
        ("s", 8, 1),
        ("s", 9, 2),
        ("t", 1, 0),
    ]


def test_ordinals_in_blocks_equal_one_window_on_a_hot_group(spark):
    df = spark.range(5000).select(
        (F.col("id") * 7 - 9000).alias("col"), F.when(F.col("id") < 4000, "hot").otherwise(F.col("id").cast("string")).alias("sheet")
    )
    blocks = band_ordinal(df, ["sheet"], "col", block=64)
    whole = band_ordinal(df, ["sheet"], "col", block=None)
    assert blocks.exceptAll(whole).count() == 0 and blocks.count() == 5000


def test_series_lengths(spark):
    headings = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", "b"), ("t", "a")], "sheet string, heading string")
    dates = spark.createDataFrame([("s", 1), ("s", 2)], "sheet string, d int")
    assert collect(series_lengths(headings, dates, ["sheet"], "heading")) == [
        ("s", "a", 2, 2, True),
        ("s", "b", 1, 2, False),
        ("t", "a", 1, None, False),
    ]


@pytest.mark.parametrize("limit", [1000, 1])
def test_densify_fills_every_slot(spark, limit):
    cells = spark.createDataFrame(
        [("s", 1, 1, "a"), ("s", 2, 2, "b"), ("t", 1, 5, "c")], "sheet string, row int, col int, value string"
    )
    columns = spark.createDataFrame([("s", 1), ("s", 2), ("s", 3), ("t", 5)], "sheet string, col int")
    assert collect(densify(cells, columns, ["row"], "sheet", "col", "value", limit=limit), "sheet", "row", "col") == [
        ("s", 1, 1, "a"),
        ("s", 1, 2, None),
        ("s", 1, 3, None),
        ("s", 2, 1, None),
        ("s", 2, 2, "b"),
        ("s", 2, 3, None),
        ("t", 1, 5, "c"),
    ]


def test_small_side_checks(spark):
    df = spark.range(5)
    assert fits(df, 5) and not fits(df, 4)
    assert len(small_rows(df, 5)) == 5 and small_rows(df, 4) is None


def test_salted_join_equals_broadcast_join(spark):
    rows = spark.range(1000).select(F.lit("hot").alias("g"), "id")
    groups = spark.createDataFrame([("hot", 1), ("cold", 2)], "g string, x int")
    wide = join_per_group(rows, groups, "g", ["id"], small=False)
    assert "salt" not in wide.columns
    assert wide.exceptAll(join_per_group(rows, groups, "g", ["id"], small=True)).count() == 0
    assert wide.count() == 1000


def test_row_and_column_removal(spark):
    rows = spark.createDataFrame([(1, 1, None), (2, None, None), (3, None, 0)], "body_row int, a int, b int")
    assert [r[0] for r in collect(drop_body_rows(rows, (2,)))] == [1, 3]
    assert drop_body_rows(rows, ()) is rows
    assert [r[0] for r in collect(drop_empty_rows(rows, ["a", "b"]))] == [1, 3]
    columns = spark.createDataFrame([("s", 1), ("s", 2)], "sheet string, col int")
    cells = spark.createDataFrame([("s", 2, "x"), ("s", 2, "y")], "sheet string, col int, value string")
    assert collect(drop_empty_columns(columns, cells, ["sheet", "col"])) == [("s", 2)]


def test_unpivot_keeps_nulls_and_pivot_restores(spark):
    wide = spark.createDataFrame([("a", 1, None), ("b", None, 4)], "k string, x int, y int")
    long = unpivot_measures(wide, ["k"], ["x", "y"])
    assert collect(long, "k", "metric") == [("a", "x", 1), ("a", "y", None), ("b", "x", None), ("b", "y", 4)]
    assert collect(pivot_series(long, ["k"], ["x", "y"]), "k") == collect(wide, "k")


def test_pivot_refuses_two_values_for_one_key(spark):
    long = spark.createDataFrame([("a", "x", 1), ("a", "x", 2)], "k string, metric string, value int")
    with pytest.raises(Exception, match="more than one value of x"):
        pivot_series(long, ["k"], ["x"]).collect()


def test_merge_series_counts_lone_nulls_as_zero(spark):
    adult = spark.createDataFrame([("a", 1), ("b", None)], "k string, value int")
    paediatric = spark.createDataFrame([("a", 2, "n")], "k string, value int, note string")
    assert collect(merge_series([adult, paediatric], ["k"])) == [("a", 3), ("b", 0)]


def test_prefix_selection_ignores_case(spark):
    wide = spark.createDataFrame([(1, 2, 3, 4)], ["Code", "Total Beds Open", "Total beds occ'd", "Occupancy rate"])
    assert select_prefixed(wide, ["Code"], ["total BEDS"]).columns == ["Code", "Total Beds Open", "Total beds occ'd"]
    long = spark.createDataFrame([("CC flu beds",), ("G&A flu beds",)], "heading string")
    assert collect(headings_prefixed(long, ["cc"])) == [("CC flu beds",)]


def test_map_measures(spark):
    df = spark.createDataFrame([("a", "1", "2")], "k string, x string, y string")
    mapped = map_measures(df, ["x", "y"], lambda c: c.cast("int"))
    assert mapped.columns == ["k", "x", "y"] and collect(mapped) == [("a", 1, 2)]


def test_spine_is_distinct_and_complete(spark):
    a = spark.createDataFrame([("c", "n", 1), ("c", None, 1), ("c", "n", 2)], "code string, name string, d int")
    b = spark.createDataFrame([("c", "n", 1, 9), ("e", "m", 1, 9)], "code string, name string, d int, x int")
    assert collect(build_spine([a, b], ["code", "name", "d"])) == [("c", "n", 1), ("c", "n", 2), ("e", "m", 1)]


def test_attach_measures_keeps_every_match(spark):
    spine = spark.createDataFrame([("c", "n1", 1), ("c", "n2", 1), ("e", "m", 1)], "code string, name string, d int")
    x = spark.createDataFrame([("c", 1, 10), ("c", 1, 11)], "code string, d int, x int")
    y = spark.createDataFrame([("e", 1, 5)], "code string, d int, y int")
    result = keys_first(attach_measures(spine, [x, y], ["code", "d"]), ["code", "name", "d"])
    assert result.columns == ["code", "name", "d", "x", "y"]
    assert collect(result) == [
        ("c", "n1", 1, 10, None),
        ("c", "n1", 1, 11, None),
        ("c", "n2", 1, 10, None),
        ("c", "n2", 1, 11, None),
        ("e", "m", 1, None, 5),
    ]


def test_complete_rows_and_exclusion(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", float("nan")), ("d", float("inf")), (None, 2.0)], "name string, v double")
    assert [r[0] for r in collect(complete_rows(df))] == ["a", "d"]
    assert [r[0] for r in collect(exclude_names(df, ["a", "x"]), "name")] == ["b", "c", "d"]
