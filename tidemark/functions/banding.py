"""Value bands and first-match categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Load band edges and labels, issue categories in order of precedence, severity ranks.
LOAD_EDGES = [0.60, 0.75, 0.90, 1.00]
LOAD_LABELS = ["<60%", "60-75%", "75-90%", "90-100%", ">100%"]
ISSUE_ORDER = [
    ("lost_flag", "Lost"),
    ("damaged_flag", "Damaged"),
    ("no_scan_flag", "No Scan"),
    ("delayed_flag", "Delayed"),
]
SEVERITY_RANK = {"Critical": 4, "High": 3, "Medium": 2}


def first_match(branches: list[tuple[Column, object]], default: object) -> Column:
    """Value of the first branch whose condition holds."""
    result = F.when(branches[0][0], branches[0][1])
    for condition, value in branches[1:]:
        result = result.when(condition, value)
    return result.otherwise(default)


def load_band(load: Column | str, right: bool = False) -> Column:
    """Load band of a factor. ``right=False``: bands hold their lower edge and 1.00 closes the
    fourth band. ``right=True``: bands hold their upper edge, and values at or below 0 have none."""
    load = F.col(load) if isinstance(load, str) else load
    if right:
        branches = [(load <= edge, label) for edge, label in zip(LOAD_EDGES, LOAD_LABELS)]
        return F.when(load > 0, first_match(branches, LOAD_LABELS[-1]))
    branches = [(load < edge, label) for edge, label in zip(LOAD_EDGES[:-1], LOAD_LABELS)]
    branches.append((load <= LOAD_EDGES[-1], LOAD_LABELS[3]))
    return first_match(branches, LOAD_LABELS[-1])


def issue_category() -> Column:
    return first_match([(F.col(name) == 1, label) for name, label in ISSUE_ORDER], "Normal")


def severity_rank(severity: Column | str) -> Column:
    severity = F.col(severity) if isinstance(severity, str) else severity
    return first_match([(severity == name, rank) for name, rank in SEVERITY_RANK.items()], 1)


def lookup(key: Column | str, table: dict, default: object = None) -> Column:
    """Value of a small fixed table for a key column."""
    key = F.col(key) if isinstance(key, str) else key
    return first_match([(key == name, F.lit(value)) for name, value in table.items()], F.lit(default))
