"""Tidy winter situation-report tables from cell grids, as lazy Spark DataFrames."""

from wardgrid.layouts import LABELS, LAYOUTS, WINTERS
from wardgrid.plans.refresh import refresh_snapshots
from wardgrid.plans.seasons import load_winters
from wardgrid.plans.winter import load_sitreps, load_trusts
from wardgrid.session import build_session
from wardgrid.sources.snapshots import read_snapshot, write_snapshot

__all__ = [
    "LABELS",
    "LAYOUTS",
    "WINTERS",
    "build_session",
    "load_sitreps",
    "load_trusts",
    "load_winters",
    "read_snapshot",
    "refresh_snapshots",
    "write_snapshot",
]
