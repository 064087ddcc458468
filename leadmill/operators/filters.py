"""Property ranges, checks of inputs, and text helpers."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PropertyLimits, Range


def within(limits: dict[str, tuple[float, float]]) -> Column:
    """All columns inside their ranges, ends included; a null is outside."""
    return reduce(lambda a, b: a & b, (F.col(c).between(low, high) for c, (low, high) in limits.items()))


def drug_like(rows: DataFrame, limits: PropertyLimits = PropertyLimits()) -> DataFrame:
    """The rows whose descriptors lie in their ranges. Only the descriptors that `rows` has are tested."""
    ranges = {name: (r.low, r.high) for name, r in limits.items() if name in rows.columns}
    return rows.filter(within(ranges)) if ranges else rows


def limits_of(properties: DataFrame) -> DataFrame:
    """One row of limits from rows (property, low, high); names count in either case."""
    names = [name for name, _ in PropertyLimits().items()]
    pick = lambda name, side: F.max(F.when(F.lower("property") == name, F.col(side))).alias(f"{name}_{side}")
    return properties.agg(*(pick(n, s) for n in names for s in ("low", "high")))


def chosen_limits(properties: DataFrame, default: PropertyLimits = PropertyLimits()) -> PropertyLimits:
    """The limits of rows (property, low, high); a property without a row keeps its default."""
    row = limits_of(properties).first()
    given = {n: Range(row[f"{n}_low"], row[f"{n}_high"]) for n, _ in default.items() if row[f"{n}_low"] is not None and row[f"{n}_high"] is not None}
    return replace(default, **given)


def require(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def template_lines(lines: DataFrame, drop: tuple[str, ...] = ("LIGANDFILE", "GRIDFILE")) -> DataFrame:
    """Lines (value) that are not blank and do not start with one of the words."""
    first = F.split(F.trim("value"), r"\s+")[0]
    return lines.filter((F.trim("value") != "") & ~first.isin(*drop))


def has_any(lines: DataFrame, words: tuple[str, ...]) -> bool:
    return not lines.filter(F.col("value").rlike("|".join(words))).isEmpty()


def split_record(record: Column, separator: str = "§") -> Column:
    """key, smiles and title of a joined record; the title may hold the separator."""
    parts = F.split(record, separator, 3)
    return F.struct(parts[0].alias("key"), F.get(parts, F.lit(1)).alias("smiles"), F.get(parts, F.lit(2)).alias("title"))


def job_name(path: Column) -> Column:
    """The last part of a path, up to its first dot."""
    return F.split(F.element_at(F.split(path, "/"), -1), r"\.")[0]


def iteration_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"_iter(\d+)$", 1), F.lit("")).cast("int")


def is_number(text: Column) -> Column:
    """Whether an entry field holds a number, or the start of one."""
    return text.isin("", "-") | text.try_cast("double").isNotNull()
