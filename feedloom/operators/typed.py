"""Typed projection of text rows, driven by a column specification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.operators.skew import numbered
from feedloom.plans import specs as s

# The risk rule.
ACTIVE_CODE, DIRECT_BILLING, MONTHLY_MODE = "A", "DIR", 3


def source_text(col: s.Col) -> Column:
    """The text a typed value is parsed from; NULL when there is nothing to parse."""
    raw = F.col(col.raw).cast("string")
    if col.kind == s.RAW:
        return raw
    if col.kind in (s.DATE_AS_IS, s.INT_AS_IS, s.ZIP):
        return fn.empty_to_null(raw)
    if col.kind == s.DATE_TAIL:
        return fn.drop_float_tail(raw)
    return fn.blank_to_null(raw)


def parsed(col: s.Col, text: Column) -> Column:
    """The typed value of already prepared text."""
    if col.kind in (s.DATE, s.DATE_AS_IS, s.DATE_TAIL):
        return fn.date_compact(text)
    if col.kind == s.DATE_SLASH:
        return fn.date_slash(text)
    if col.kind == s.DATE_ANY:
        return fn.date_any(text)
    if col.kind in (s.INT, s.INT_AS_IS):
        return fn.safe_int(text)
    if col.kind == s.SMALLINT:
        return fn.safe_smallint(text)
    if col.kind in (s.NUMBER, s.SIGNED):
        return fn.safe_number(text, plus_allowed=col.kind == s.SIGNED)
    return text


def prepared_text(col: s.Col, present: Sequence[str]) -> Column:
    """Source text; a zip picks its text variant where the feed has one."""
    if col.kind == s.ZIP:
        variant = f"{col.raw}_text"
        return fn.zip_code(col.raw, variant if variant in present else None)
    return source_text(col)


def with_missing(raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add absent columns as NULL text."""
    missing = {n: F.lit(None).cast("string") for n in names if n not in raw.columns}
    return raw.withColumns(missing) if missing else raw


def at_risk(code: str = "cntrct_code", form: str = "billing_form", mode: str = "billing_mode",
            paid_to: str = "paid_to_date", day: str = "file_date") -> Column:
    """Active, direct monthly billing, paid to a day before the file. Three-valued: an
    unknown conjunct gives NULL unless another one is false."""
    return (
        (F.col(code) == ACTIVE_CODE)
        & (F.col(form) == DIRECT_BILLING)
        & (F.col(mode) == MONTHLY_MODE)
        & F.col(paid_to).isNotNull()
        & F.col(day).isNotNull()
        & (F.col(paid_to) < F.col(day))
    )


def typed(raw: DataFrame, spec: s.TypedSpec) -> DataFrame:
    """One projection per feed; a value that does not parse is NULL, never an error."""
    raw = with_missing(raw, spec.optional)
    if spec.row_number:
        raw = numbered(raw, ["source_file"], ["row_id"], spec.row_number)
    # Two projections: text is prepared once, then parsed by reference. In a single one
    # every mention in the guards and parsers would prepare it again.
    texts = [prepared_text(c, raw.columns).alias(c.target) for c in spec.columns]
    carried = [F.col(c.raw).alias(c.target) for c in spec.lineage]
    if spec.row_number:
        carried.append(F.col(spec.row_number))
    file_text = [spec.file_text().alias(s.FILE_TEXT)] if spec.file_text else []
    rows = raw.select(*texts, *carried, *file_text)
    values = [parsed(c, F.col(c.target)).alias(c.target) for c in spec.columns]
    values += [F.col(n) for n in rows.columns[len(texts):] if n != s.FILE_TEXT]
    if spec.file_date:
        values.append(spec.file_date().alias("file_date"))
    rows = rows.select(*values)
    if spec.risk:
        rows = rows.withColumn("at_risk_policy", spec.risk())
    return rows.select(*spec.output) if spec.output else rows


def reject_profile(raw: DataFrame, spec: s.TypedSpec) -> DataFrame:
    """Per parsed column: rows, rows with text, and rows whose text did not parse.

    All columns are counted in one aggregation; the one-row result is then turned.
    """
    raw = with_missing(raw, spec.optional)
    checked = [c for c in spec.columns if c.kind not in (s.TEXT, s.RAW, s.ZIP)]
    texts = raw.select(*[source_text(c).alias(f"c{i}") for i, c in enumerate(checked)])
    counts = []
    for i, c in enumerate(checked):
        text = F.col(f"c{i}")
        counts.append(F.count(text).alias(f"t{i}"))
        counts.append(F.count_if(text.isNotNull() & parsed(c, text).isNull()).alias(f"r{i}"))
    total = texts.agg(F.count(F.lit(1)).alias("n"), *counts)
    lines = F.array(*[
        F.struct(
            F.lit(c.target).alias("column_name"), F.col("n").alias("row_count"),
            F.col(f"t{i}").alias("text_count"), F.col(f"r{i}").alias("reject_count"),
        )
        for i, c in enumerate(checked)
    ])
    return total.select(F.inline(lines))


def with_load(rows: DataFrame) -> DataFrame:
    """The rows, each checked to know its load."""
    cursor = F.when(F.col("load_id").isNull(), F.raise_error(F.lit("load_id is not set"))).otherwise(F.col("load_id"))
    return rows.withColumn("load_id", cursor)


def newer_loads(source: DataFrame, target: DataFrame | None) -> DataFrame:
    """Source rows loaded after the newest load already in the target.

    An unset cursor in the source is an error: such rows would never be picked up.
    The comparison is on text, the order load ids are issued in.
    """
    checked = with_load(source)
    mark = high_water_mark(target) if target is not None else None
    return checked if mark is None else checked.filter(F.col("load_id") > F.lit(mark))


def high_water_mark(target: DataFrame) -> str | None:
    """Newest load id; legacy rows carry only their own id."""
    ids = [F.col(c) for c in ("raw_load_id", "load_id") if c in target.columns]
    return target.agg(F.max(F.coalesce(*ids))).first()[0]
