"""Several winters in one plan: the rows of each load, one scan, one shuffle per step."""

from __future__ import annotations

import pytest
from conftest import worksheet
from pyspark.sql import functions as F
from test_winters import S1, generic_sheets, three_key_sheets

from wardgrid import load_sitreps, load_winters
from wardgrid.functions.dates import report_date
from wardgrid.operators.datebook import attach_dates, date_rejects
from wardgrid.sources.cells import read_cells, write_cells
from wardgrid.sources.snapshots import to_snapshot


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_rows_are_those_of_each_load_from_one_scan(spark, make_grid, tmp_path):
    grid = make_grid("2019-20", generic_sheets()).unionAll(make_grid("2020-21", three_key_sheets()))
    write_cells(grid, str(tmp_path / "cells"))
    cells = read_cells(spark, str(tmp_path / "cells"))
    both = load_winters(spark, cells, ["2019-20", "2020-21"])
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2  # cells by sheet row, panel by join keys
    assert "ObjectHashAggregate" not in plan and "collect_list" not in plan
    single = [to_snapshot(load_sitreps(spark, w, grid), w) for w in ("2019-20", "2020-21")]
    assert both.columns == single[0].columns and rows(both) == rows(single[0].unionAll(single[1]))
    assert rows(load_winters(spark, cells, ["2020-21"])) == rows(single[1])


def test_faults_name_the_winter(spark, make_grid):
    sheets = generic_sheets()
    del sheets["G&A beds"][15]
    grid = make_grid("2019-20", sheets).unionAll(make_grid("2020-21", three_key_sheets()))
    with pytest.raises(ValueError, match="2019-20: no heading row .*G&A beds"):
        load_winters(spark, grid, ["2020-21", "2019-20"])
    sheets = generic_sheets() | {"A&E Closures": worksheet([S1, "soon"], {3: ["R", "A1", "Alpha", 1, 2]})}
    with pytest.raises(ValueError, match="2019-20: .*'A&E Closures' has no readable date in column 6: 'soon'"):
        load_winters(spark, make_grid("2019-20", sheets), ["2019-20"])
    twice = generic_sheets() | {"A&E Closures": worksheet([S1], {3: ["R", "A1", "Alpha", 1], 4: ["R", "A1", "Alias", 2]})}
    with pytest.raises(Exception, match="2019-20: more than one closures row"):
        load_winters(spark, make_grid("2019-20", twice), ["2019-20"]).collect()
    with pytest.raises(ValueError, match="unknown winter"):
        load_winters(spark, grid, ["1999-00"])


@pytest.mark.parametrize("limit", [100, 1])
def test_dates_by_distinct_text(spark, limit):
    texts = [(1, "43801"), (2, "43801"), (3, "2-Dec-19"), (4, "3rd Dec"), (5, None), (6, " "), (7, "3rd Dec")]
    frame = spark.createDataFrame(texts, "id int, raw string")

    def read(text):
        return report_date(text, ("serial", "text"))

    dated = attach_dates(frame, "raw", {"day": read}, limit)
    assert rows(dated) == rows(frame.withColumn("day", read(F.col("raw"))))
    assert rows(date_rejects(frame, "raw", read)) == [("3rd Dec", 2)]
