"""Worksheets that differ from the winter's form: dated rightly or refused, never silently wrong."""

from __future__ import annotations

import pytest
from conftest import worksheet
from test_winters import D1, D2, S1, S2, by_key, generic_sheets, three_key_sheets

from wardgrid import load_sitreps

LONG_STAY = "Beds Occ by long stay patients"


def test_a_deep_sheet_keeps_its_own_dates(spark, make_grid):
    sheets = three_key_sheets()
    sheets[LONG_STAY] = {r if r == 3 else r + 75: cells for r, cells in sheets[LONG_STAY].items()}
    moved = load_sitreps(spark, "2020-21", make_grid("2020-21", sheets))
    assert [by_key(moved)["A1", "Alpha", d]["long_stay_7"] for d in (D1, D2)] == [None, 28]


def test_a_date_elsewhere_is_no_date_band(spark, make_grid):
    sheets = generic_sheets()
    sheets[LONG_STAY][6] = {2: "2020-03-05", 5: "2020-03-05"}
    sheets[LONG_STAY][14] = {1: "2020-03-05"}
    changed = load_sitreps(spark, "2019-20", make_grid("2019-20", sheets))
    rows = by_key(changed)
    assert [rows["A1", "Alpha", d]["long_stay_7"] for d in (D1, D2)] == [5, 6]
    assert {d for _, _, d in rows if d > D2} == {d for _, n, d in rows if n == "Gamma" and d > D2}


def test_ambulance_sheet_without_dates_takes_those_of_long_stays(spark, make_grid):
    sheets = three_key_sheets()
    del sheets["Ambulance Arrivals and Delays"][14]
    rows = by_key(load_sitreps(spark, "2020-21", make_grid("2020-21", sheets)))
    assert [rows["A1", "Alpha", d]["delays_30_60"] for d in (D1, D2)] == [None, 24]


def test_fewer_dates_than_headings_fail(spark, make_grid):
    sheets = generic_sheets()
    del sheets["G&A beds"][14][8]
    grid = make_grid("2019-20", sheets)
    with pytest.raises(ValueError, match="'G&A beds' has 2 headings .* for 1 dates"):
        load_sitreps(spark, "2019-20", grid)
    assert load_sitreps(spark, "2019-20", grid, strict=False).count() > 0


def test_a_heading_spelled_otherwise_fails(spark, make_grid):
    sheets = generic_sheets() | {
        LONG_STAY: worksheet(["over 7 days", "> 21 days"] * 2, {3: ["R", "A1", "Alpha", 5, 2, 6, None]})
    }
    with pytest.raises(ValueError, match="long stay patients' has no heading .*> 7 days"):
        load_sitreps(spark, "2019-20", make_grid("2019-20", sheets))


def test_two_values_for_one_place_fail(spark, make_grid):
    grid = make_grid("2019-20", generic_sheets())
    twice = grid.unionAll(grid.where("sheet = 'A&E Closures' AND value = '1'").selectExpr(
        "winter", "workbook", "sheet", "row_idx", "col_idx", "'4' AS value"
    ))
    with pytest.raises(Exception, match="more than one cell for one organisation"):
        load_sitreps(spark, "2019-20", twice).collect()
    # Two headings of one day.
    sheets = generic_sheets() | {"A&E Closures": worksheet([S1, S2, "2019-12-02"], {3: ["R", "A1", "Alpha", 1, None, 7]})}
    with pytest.raises(Exception, match="more than one cell for one organisation"):
        load_sitreps(spark, "2019-20", make_grid("2019-20", sheets)).collect()


def test_two_columns_of_a_day_multiply_rows(spark, make_grid):
    # The first column of the day is empty for Beta, so that organisation has one row only.
    body = {3: ["R", "A1", "Alpha", 1, None, 7], 4: ["R", "B1", "Beta", None, 2, 8]}
    sheets = generic_sheets() | {"A&E Closures": worksheet([S1, S2, "2019-12-02"], body)}
    rows = load_sitreps(spark, "2019-20", make_grid("2019-20", sheets), duplicates="multiply").collect()
    found = sorted((r.code, r.report_date, r.closures) for r in rows if r.code in ("A1", "B1") and r.closures is not None)
    assert found == [("A1", D1, 1), ("A1", D1, 7), ("B1", D1, 8), ("B1", D2, 2)]


def test_a_cell_that_comes_twice_fails_in_both_modes(spark, make_grid):
    grid = make_grid("2019-20", generic_sheets())
    again = grid.where("sheet = 'A&E Closures' AND value = '1'").selectExpr(
        "winter", "workbook", "sheet", "row_idx", "col_idx", "'4' AS value"
    )
    for duplicates in ("error", "multiply"):
        with pytest.raises(Exception, match="more than one cell for one organisation"):
            load_sitreps(spark, "2019-20", grid.unionAll(again), duplicates=duplicates).collect()


def test_an_unreadable_date_fails(spark, make_grid):
    sheets = generic_sheets()
    sheets["G&A beds"][14][8] = "3rd Dec"
    grid = make_grid("2019-20", sheets)
    with pytest.raises(ValueError, match="'G&A beds' has no readable date in column 8: '3rd Dec'"):
        load_sitreps(spark, "2019-20", grid)
    assert D2 not in {d for c, _, d in by_key(load_sitreps(spark, "2019-20", grid, strict=False)) if c == "B1"}
    sheets = generic_sheets() | {"A&E Closures": worksheet([S1, "3 Decembr"], {3: ["R", "A1", "Alpha", 1, 2]})}
    with pytest.raises(ValueError, match="'A&E Closures' has no readable date in column 6: '3 Decembr'"):
        load_sitreps(spark, "2019-20", make_grid("2019-20", sheets))


def test_load_runs_few_jobs_and_builds_no_arrays(spark, make_grid):
    grid = make_grid("2019-20", generic_sheets())
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("load-jobs", "eager jobs of a load")
    loaded = load_sitreps(spark, "2019-20", grid)
    jobs = len(tracker.getJobIdsForGroup("load-jobs"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 10
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "Generate" not in plan and "collect_list" not in plan
