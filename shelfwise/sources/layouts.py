"""Positions and types of the columns in the headerless fact and dimension files.

Fixed values of the source systems. Ids are text, so leading zeros survive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"

COST = {
    1: ("foreign_store_id", "string"),
    2: ("foreign_item_id", "string"),
    3: ("date", "date"),
    5: ("sale_quantity", MONEY),
    6: ("total_sale", MONEY),
    7: ("total_cost", MONEY),
    13: ("cmid", "int"),
}
INVENTORY = {
    0: ("cmid", "int"),
    1: ("foreign_store_id", "string"),
    2: ("foreign_item_id", "string"),
    3: ("date", "date"),
    4: ("quantity", MONEY),
}
# Prices stay text until malformed rows are rejected.
GOODS = {
    0: ("cmid", "int"),
    1: ("barcode", "string"),
    2: ("foreign_item_id", "string"),
    3: ("item_name", "string"),
    4: ("lastin_price", "string"),
    5: ("sale_price", "string"),
    7: ("item_status", "string"),
    16: ("show_code", "string"),
}
STORES = {
    0: ("cmid", "int"),
    1: ("foreign_store_id", "string"),
    2: ("store_name", "string"),
    6: ("store_status", "string"),
}


def file_schema(layout: dict[int, tuple[str, str]]) -> str:
    """DDL of the whole file. All cells are text: they are typed, and checked, after the scan;
    unnamed positions are pruned by it."""
    return ", ".join(f"{layout[i][0] if i in layout else f'unused_{i}'} string" for i in range(max(layout) + 1))


def _typed(name: str, kind: str) -> Column:
    return F.col(name).try_cast(kind)


def _rounds(name: str, kind: str) -> Column:
    """Whether a decimal cell would lose digits: compared as text of more digits than the type keeps."""
    exact = F.coalesce(F.col(name).try_cast("decimal(38,18)") != _typed(name, kind), F.lit(False))
    return exact if kind.startswith("decimal") else F.lit(False)


def reasons(layout: dict[int, tuple[str, str]]) -> Column:
    """Reason codes of a row, one for each bad cell: `type:<column>` where it is not of its type, `rounded:<column>`
    where its type would lose digits. No code means a good row."""
    codes = []
    for name, kind in layout.values():
        if kind == "string":
            continue
        wrong = F.col(name).isNotNull() & _typed(name, kind).isNull()
        codes.append(F.when(wrong, F.lit(f"type:{name}")).when(_rounds(name, kind), F.lit(f"rounded:{name}")))
    return F.array_compact(F.array(*codes)) if codes else F.array().cast("array<string>")


def is_bad(layout: dict[int, tuple[str, str]]) -> Column:
    """Whether a row has a cell that is not of its type, or that its type would round."""
    return F.size(reasons(layout)) > 0


def typed(raw: DataFrame, layout: dict[int, tuple[str, str]], on_bad: str = "fail") -> DataFrame:
    """The named columns in their types.

    A row with a bad cell fails the query (`fail`) or is left out (`reject`); `rejected`
    returns the rows that are left out.
    """
    if on_bad not in ("fail", "reject"):
        raise ValueError(f"unknown choice {on_bad!r}")
    if on_bad == "reject":
        return raw.filter(~is_bad(layout)).select(*[_typed(name, kind).alias(name) for name, kind in layout.values()])
    checked = raw.withColumn("_bad", is_bad(layout))
    stop = F.raise_error(F.concat(F.lit("bad cell in row: "), F.concat_ws(",", *columns(layout))))
    return checked.select(
        *[F.when(F.col("_bad"), stop.cast(kind)).otherwise(_typed(name, kind)).alias(name) for name, kind in layout.values()]
    )


def rejected(raw: DataFrame, layout: dict[int, tuple[str, str]]) -> DataFrame:
    """The rows with a bad cell, as text."""
    return raw.filter(is_bad(layout)).select(*columns(layout))


def columns(layout: dict[int, tuple[str, str]]) -> list[str]:
    return [name for name, _ in layout.values()]
