"""Null markers, boolean text and label maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pathogenicity labels of the score files and their short forms.
PATHOGENICITY_LABELS = {
    "Likely benign": "benign",
    "Likely pathogenic": "pathogenic",
    "ambiguous": "ambiguous",
    "benign": "benign",
    "pathogenic": "pathogenic",
}


def without_markers(col: Column, markers: list[str]) -> Column:
    """Null where the text is one of the null markers."""
    return F.when(~col.isin(markers), col)


def strict_boolean(col: Column) -> Column:
    """TRUE and FALSE in any case; anything else is null."""
    text = F.upper(col.cast("string"))
    return F.when(text == "TRUE", True).when(text == "FALSE", False)


def lenient_boolean(col: Column) -> Column:
    """TRUE, T, 1 and FALSE, F, 0 in any case; anything else is null."""
    text = F.upper(col.cast("string"))
    return F.when(text.isin("TRUE", "T", "1"), True).when(text.isin("FALSE", "F", "0"), False)


def mapped_label(col: Column, mapping: dict[str, str]) -> Column:
    """The mapped label, exact case; null when it is not in the map."""
    branches = None
    for source, target in mapping.items():
        branches = (
            F.when(col == source, target) if branches is None else branches.when(col == source, target)
        )
    return branches
