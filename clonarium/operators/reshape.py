"""Wide to long, paired lists to rows, nested matrices to rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonarium.functions.ids import build_tumour_id

# Source column per lesion ({n} is the lesion number), tidy name.
LESION_COLUMNS = {
    "Lesion{n}_site_central.reviewed": "lesion_site",
    "histology{n}_central.reviewed": "histology",
    "histology{n}_group_central.reviewed": "histology_group",
    "pTStage_v8_lesion{n}_central.reviewed": "pT_stage",
    "pNStage_lesion{n}_central.reviewed": "pN_stage",
    "pTNMStage_v8_lesion{n}_central.reviewed": "pTNM_stage",
    "SizePath_lesion{n}_central.reviewed": "size_path_mm",
    "PathPleuInv_lesion{n}_central.reviewed": "pleural_invasion",
    "margin_status_lesion{n}_central.reviewed": "margin_status",
}


def quoted(name: str) -> str:
    """A column name that may hold dots, ready for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def melt(
    df: DataFrame,
    id_columns: Sequence[str],
    value_columns: Sequence[str] | None = None,
    variable: str = "variable",
    value: str = "value",
    value_type: str = "double",
) -> DataFrame:
    """Wide matrix to (ids, variable, value); empty cells are kept."""
    if value_columns is None:
        value_columns = [c for c in df.columns if c not in set(id_columns)]
    ids = [quoted(c) for c in id_columns]
    names = text_array(value_columns)
    return (
        packed(df, id_columns, value_columns, "_cells", value_type)
        .selectExpr(*ids, f"explode(arrays_zip({names}, _cells)) AS _cell")
        .selectExpr(*ids, f"_cell.`0` AS {quoted(variable)}", f"_cell._cells AS {quoted(value)}")
    )


def packed(
    df: DataFrame,
    id_columns: Sequence[str],
    value_columns: Sequence[str],
    out: str,
    value_type: str = "double",
) -> DataFrame:
    """(ids, one array of the value columns).

    The row is one SQL expression, as thousands of Column objects are slow to build.
    """
    cells = ", ".join(_as_type(df, c, value_type) for c in value_columns)
    return df.selectExpr(*[quoted(c) for c in id_columns], f"array({cells}) AS {quoted(out)}")


def _as_type(df: DataFrame, name: str, kind: str) -> str:
    if df.schema[name].dataType.simpleString() == kind:
        return quoted(name)
    return f"cast({quoted(name)} AS {kind})"


def text_array(values: Sequence[str]) -> str:
    """SQL for a constant array of texts."""
    escaped = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return "array(" + ", ".join(f"'{v}'" for v in escaped) + ")"


def numbered_groups_to_rows(
    df: DataFrame,
    id_columns: Sequence[str],
    columns: dict[str, str],
    numbers: Sequence[int],
    ordinal: str,
) -> DataFrame:
    """One row per id and number, from column groups named by a ``{n}`` pattern.

    A source column that is missing gives null; a row whose values are all null is
    dropped. All groups are read in one pass.
    """
    present = set(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}

    def tidy_type(pattern: str) -> str:
        found = {types[pattern.format(n=n)].simpleString() for n in numbers if pattern.format(n=n) in present}
        return found.pop() if len(found) == 1 else "string"

    kinds = {pattern: tidy_type(pattern) for pattern in columns}

    def group(n: int) -> Column:
        cells = [
            (F.col(quoted(p.format(n=n))) if p.format(n=n) in present else F.lit(None))
            .cast(kinds[p])
            .alias(tidy)
            for p, tidy in columns.items()
        ]
        return F.struct(F.lit(n).alias(ordinal), *cells)

    rows = df.select(
        *[F.col(quoted(c)) for c in id_columns], F.inline(F.array(*[group(n) for n in numbers]))
    )
    some_value = reduce(lambda a, b: a | b, [F.col(t).isNotNull() for t in columns.values()])
    return rows.where(some_value)


def lesions_to_tumours(clinical: DataFrame, patient: str = "Patient_ID") -> DataFrame:
    """The two lesion column groups of a patient row as one row per tumour."""
    rows = numbered_groups_to_rows(clinical, [patient], LESION_COLUMNS, (1, 2), "tumour_ordinal")
    return rows.withColumn("tumour_id", build_tumour_id(F.col(patient), F.col("tumour_ordinal")))


def paired_lists_to_rows(
    df: DataFrame, lists: dict[str, str], position: str = "position", separator: str = ";"
) -> DataFrame:
    """Delimited lists that belong together by position, one row per position.

    ``lists`` maps the list column to the name of its item column; a shorter list
    is filled up with null. The list columns are dropped.
    """
    keep = [c for c in df.columns if c not in lists]
    items = F.arrays_zip(*[F.split(F.col(c), separator).alias(item) for c, item in lists.items()])
    return df.select(*keep, F.posexplode(items).alias(position, "_item")).select(
        *keep, position, *[F.col(f"_item.{item}") for item in lists.values()]
    )


def matrix_to_rows(
    df: DataFrame,
    id_columns: Sequence[str],
    row_names: str,
    column_names: str,
    cells: str,
    row: str,
    column: str,
    value: str,
) -> DataFrame:
    """Named matrix held as arrays (row names, column names, rows of cells) to long rows."""
    by_row = df.select(
        *id_columns,
        F.col(column_names).alias("_columns"),
        F.explode(F.arrays_zip(F.col(row_names).alias("r"), F.col(cells).alias("c"))).alias("_row"),
    ).select(*id_columns, "_columns", F.col("_row.r").alias(row), F.col("_row.c").alias("_cells"))
    return by_row.select(
        *id_columns,
        row,
        F.explode(F.arrays_zip(F.col("_columns").alias("n"), F.col("_cells").alias("v"))).alias("_cell"),
    ).select(*id_columns, row, F.col("_cell.n").alias(column), F.col("_cell.v").alias(value))


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns all at once, so that a name may be freed and reused."""
    return df.select(*[F.col(quoted(c)).alias(names.get(c, c)) for c in df.columns])
