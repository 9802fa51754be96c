from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardgrid.session import build_session  # noqa: E402
from wardgrid.sources.cells import CELL_SCHEMA  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "wardgrid-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_grid(spark):
    """Cell table from {sheet name: {row: {col: value}}} or {(workbook, sheet): ...}."""

    def make(winter, sheets):
        cells = []
        for place, rows in sheets.items():
            workbook, sheet = place if isinstance(place, tuple) else ("main", place)
            for row, values in rows.items():
                for col, value in values.items():
                    cells.append((winter, workbook, sheet, row, col, value))
        return spark.createDataFrame(cells, CELL_SCHEMA)

    return make


def worksheet(headings, rows, dates=None, header_row=15, keys=("NHS England Region", None, "Code", "Name")):
    """Rows of one worksheet: keys, headings from column 5 on, dates above the given columns.

    rows: {body row: [region, code, name, *values]}; None is an empty cell.
    dates: {heading number: text}.
    """
    sheet = {header_row: {i: key for i, key in enumerate(keys, start=1) if key}}
    sheet[header_row] |= {5 + i: h for i, h in enumerate(headings) if h is not None}
    if dates:
        sheet[header_row - 1] = {5 + i: text for i, text in dates.items()}
    sheet[3] = {1: "Title:"}
    for body_row, (region, code, name, *values) in rows.items():
        cells = {1: region, 3: code, 4: name} | {5 + i: v for i, v in enumerate(values)}
        sheet[header_row + body_row] = {c: str(v) for c, v in cells.items() if v is not None}
    return sheet


def collect(df, *order):
    return [tuple(row) for row in df.orderBy(*(order or df.columns)).collect()]
