from __future__ import annotations

import datetime as dt

import pytest
from conftest import collect, worksheet

from wardgrid import load_trusts, read_snapshot, write_snapshot
from wardgrid.sources.cells import CELL_SCHEMA, read_cells, write_cells
from wardgrid.sources.directory import DIRECTORY_COLUMNS
from wardgrid.sources.snapshots import write_snapshots


def test_directory_reads_quotes_blanks_and_na(spark, tmp_path):
    first = ["R1A", '"The ""Old"" Trust, North"', " Y54 ", "", "1 High St", "NA"]
    lines = [",".join(first + [""] * 21), ",".join(["RXX", "Plain"] + [""] * 25)]
    (tmp_path / "etr.csv").write_text("\n".join(lines) + "\n")
    table = load_trusts(spark, str(tmp_path / "etr.csv"))
    assert tuple(table.columns) == DIRECTORY_COLUMNS and len(table.columns) == 27
    assert {t for _, t in table.dtypes} == {"string"}
    rows = {r["Organisation code"]: r for r in table.collect()}
    assert rows["R1A"]["Name"] == 'The "Old" Trust, North'
    assert rows["R1A"]["National grouping"] == "Y54"
    assert rows["R1A"]["High level health geography"] is None
    assert rows["R1A"]["Address line 2"] is None
    assert rows["RXX"]["Null 12"] is None


def test_directory_records_with_line_breaks_or_missing_fields(spark, tmp_path):
    broken = ",".join(["R1A", '"The\nTrust"'] + [""] * 25)
    (tmp_path / "etr.csv").write_text(broken + "\n")
    (row,) = load_trusts(spark, str(tmp_path / "etr.csv"), multi_line=True).collect()
    assert row["Name"] == "The\nTrust"
    (tmp_path / "short.csv").write_text("R1A,Two fields\n")
    for path in ("etr.csv", "short.csv"):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            load_trusts(spark, str(tmp_path / path)).select("Name").collect()


def test_cells_round_trip_and_csv(spark, make_grid, tmp_path):
    grid = make_grid("2019-20", {"G&A beds": worksheet(["43801"], {1: ["-", "R1", "One", 5]})})
    path = str(tmp_path / "cells")
    write_cells(grid, path)
    assert collect(read_cells(spark, path)) == collect(grid)
    csv = str(tmp_path / "csv")
    grid.write.option("header", True).csv(csv)
    assert collect(read_cells(spark, csv, "csv")) == collect(grid)
    with pytest.raises(ValueError, match="lacks"):
        read_cells(spark, grid.drop("value"))
    assert read_cells(spark, grid).schema == CELL_SCHEMA


def snapshot_row(spark, winter, **values):
    from wardgrid.layouts import LAYOUTS

    layout = LAYOUTS[winter]
    schema = ", ".join(f"{c} {layout.column_type(c)}" for c in layout.columns)
    return spark.createDataFrame([tuple(values.get(c) for c in layout.columns)], schema)


def test_snapshots_replace_one_winter_only(spark, tmp_path):
    path = str(tmp_path / "saved")
    day = dt.date(2019, 12, 2)
    write_snapshot(snapshot_row(spark, "2019-20", code="R1", report_date=day, cc_beds_open=2.5), "2019-20", path)
    write_snapshot(snapshot_row(spark, "2022-23", code="R1", region="X", report_date=day, cc_beds_open=2), "2022-23", path)
    write_snapshot(snapshot_row(spark, "2022-23", code="R2", region="X", report_date=day, cc_beds_open=3), "2022-23", path)
    old, new = read_snapshot(spark, path, "2019-20"), read_snapshot(spark, path, "2022-23")
    assert [(r["code"], r["cc_beds_open"]) for r in old.collect()] == [("R1", 2.5)]
    assert [(r["code"], r["region"], r["cc_beds_open"]) for r in new.collect()] == [("R2", "X", 3)]
    assert len(old.columns) == 17 and len(new.columns) == 19
    assert dict(old.dtypes)["cc_beds_open"] == "double" and dict(new.dtypes)["cc_beds_open"] == "int"


def test_an_empty_winter_replaces_its_copy(spark, tmp_path):
    path = str(tmp_path / "saved")
    rows = {w: snapshot_row(spark, w, code="R1") for w in ("2019-20", "2020-21", "2022-23")}
    write_snapshots(list(rows.items()), path)
    nothing = spark.createDataFrame([], rows["2020-21"].schema)
    write_snapshots([("2020-21", nothing), ("2022-23", rows["2022-23"].unionAll(rows["2022-23"]))], path)
    assert [read_snapshot(spark, path, w).count() for w in rows] == [1, 0, 2]
    write_snapshot(rows["2019-20"].where("code = 'none'"), "2019-20", path)
    write_snapshot(nothing, "2021-22", path)
    assert [read_snapshot(spark, path, w).count() for w in (*rows, "2021-22")] == [0, 0, 2, 0]


def test_snapshot_reads_one_partition(spark, tmp_path, capsys):
    path = str(tmp_path / "saved")
    write_snapshot(snapshot_row(spark, "2019-20", code="R1"), "2019-20", path)
    read_snapshot(spark, path, "2019-20").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(winter" in plan
