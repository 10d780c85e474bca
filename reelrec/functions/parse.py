"""Delimited text -> typed rows.

One pass over the lines computes every typed field plus a ``reason`` column; good rows
and quarantined lines are two filters of that same projection.  Modes:

* ``quarantine`` (default): bad lines go to ``ParseResult.rejects`` with a reason;
* ``fail``: the first bad line raises at execution time, like the reference job;
* ``drop``: bad lines are discarded.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrec.functions.text import field, java_split, java_trim

MODES = ("quarantine", "fail", "drop")


@dataclass
class ParseResult:
    rows: DataFrame
    rejects: DataFrame | None
    staged: DataFrame | None = None     # both at once: value, the fields, ``_reason`` (null for rows)


def drop_incomplete(lines: DataFrame, delim: str, value_col: str = "value") -> DataFrame:
    """Drop lines whose last field is missing (the line ends with the delimiter)."""
    return lines.where(~F.col(value_col).endswith(delim))


def _typed(raw: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return raw
    value = raw.try_cast(dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):      # NaN and infinities are no ratings
        value = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    return value


def _reason(n_fields: Column, needed: int, raws: list[Column], typed: list[Column],
            schema: T.StructType) -> Column:
    expr = F.when(n_fields < needed, F.lit("too few fields"))
    for raw, t, f in zip(raws, typed, schema.fields):
        if not isinstance(f.dataType, T.StringType):
            expr = expr.when(t.isNull(), F.lit(f"bad {f.dataType.simpleString()}: {f.name}"))
        elif raw is not None:
            expr = expr.when(raw.isNull(), F.lit(f"missing: {f.name}"))
    return expr


def _project_once(staged: DataFrame, value_col: str, typed: list[Column], schema: T.StructType,
                  reason: Column) -> DataFrame:
    """Typed fields + reason, evaluated once per line.

    A plain projection followed by the good/bad filter lets the optimizer push the filter
    below it, inlining the split and casts into the predicate (every line split several
    times).  A one-element ``inline`` generator is a boundary the filter cannot cross."""
    record = F.struct(F.col(value_col).alias(value_col),
                      *[t.alias(f.name) for t, f in zip(typed, schema.fields)], reason.alias("_reason"))
    return staged.select(F.inline(F.array(record)))


def _finish(projected: DataFrame, schema: T.StructType, value_col: str, on_error: str) -> ParseResult:
    names = [f.name for f in schema.fields]
    if on_error not in MODES:
        raise ValueError(f"on_error must be one of {MODES}")
    if on_error == "fail":
        guard = F.when(F.col("_reason").isNotNull(),
                       F.raise_error(F.concat(F.lit("unparsable line ("), F.col("_reason"), F.lit("): "),
                                              F.col(value_col))))
        rows = projected.where(guard.isNull()).select(*names)
        return ParseResult(rows, None)
    rows = projected.where(F.col("_reason").isNull()).select(*names)
    if on_error == "drop":
        return ParseResult(rows, None)
    rejects = projected.where(F.col("_reason").isNotNull()).select(
        F.col(value_col).alias("value"), F.col("_reason").alias("reason"))
    return ParseResult(rows, rejects, projected)


def parse_delimited(lines: DataFrame, schema: T.StructType, delim: str, *,
                    on_error: str = "quarantine", value_col: str = "value",
                    drop_incomplete_lines: bool = True) -> ParseResult:
    """Split, take the first ``len(schema)`` fields by position, Java-trim, cast.

    Extra fields are ignored.  Lines ending with the delimiter are dropped first (P1),
    as the reference does.
    """
    if drop_incomplete_lines:
        lines = drop_incomplete(lines, delim, value_col)
        # no line ends with the delimiter now, so no trailing empty field exists and a plain
        # split equals Java's (saves a regex pass per line)
        parts = F.split(F.col(value_col), re.escape(delim))
    else:
        parts = java_split(F.col(value_col), delim)
    raws = [java_trim(field(F.col("_parts"), i)) for i in range(len(schema.fields))]
    typed = [_typed(r, f.dataType) for r, f in zip(raws, schema.fields)]
    staged = lines.select(F.col(value_col), parts.alias("_parts"))
    projected = _project_once(staged, value_col, typed, schema,
                              _reason(F.size("_parts"), len(schema.fields), raws, typed, schema))
    return _finish(projected, schema, value_col, on_error)


def parse_csv_quoted(lines: DataFrame, schema: T.StructType, *, on_error: str = "quarantine",
                     value_col: str = "value") -> ParseResult:
    """D17 option: RFC-4180 quoting (``"American President, The (1995)"`` stays one field)."""
    lines = drop_incomplete(lines, ",", value_col)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rec = F.from_csv(F.col(value_col), as_text.simpleString(),
                     {"mode": "PERMISSIVE", "escape": '"', "nullValue": "\u0001", "emptyValue": ""})
    raws = [java_trim(F.col("_rec").getField(f.name)) for f in schema.fields]
    typed = [_typed(r, f.dataType) for r, f in zip(raws, schema.fields)]
    # the record's own fields, as quotes may hold commas: the parser leaves those it lacks null
    n_fields = sum((r.isNotNull().cast("int") for r in raws), F.lit(0))
    staged = lines.select(F.col(value_col), rec.alias("_rec"))
    reason = _reason(F.when(F.col("_rec").isNull(), F.lit(0)).otherwise(n_fields), len(schema.fields),
                     raws, typed, schema)
    return _finish(_project_once(staged, value_col, typed, schema, reason), schema, value_col, on_error)


def parse_tag_lines(lines: DataFrame, schema: T.StructType, *, on_error: str = "quarantine",
                    value_col: str = "value") -> ParseResult:
    """Tag lines whose tag holds commas and quotes.

    Fields 1-2 and the last field are kept; everything between is joined with no
    separator and stripped of double quotes.  Fewer than three fields is a bad line
    (D18); exactly three gives an empty tag.
    """
    lines = drop_incomplete(lines, ",", value_col)
    # after the filter no trailing empty field can exist: a plain split equals Java's
    staged = lines.select(F.col(value_col), F.split(F.col(value_col), ",").alias("_parts"))
    p = F.col("_parts")
    n = F.size(p)
    middle = F.replace(F.array_join(F.slice(p, 3, F.greatest(n - 3, F.lit(0))), ""), F.lit('"'), F.lit(""))
    raws = [java_trim(field(p, 0)), java_trim(field(p, 1)), java_trim(middle), java_trim(F.element_at(p, -1))]
    typed = [_typed(r, f.dataType) for r, f in zip(raws, schema.fields)]
    projected = _project_once(staged, value_col, typed, schema, _reason(n, 3, [None] * 4, typed, schema))
    return _finish(projected, schema, value_col, on_error)
