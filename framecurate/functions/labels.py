"""Training-label text (P19, P20) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framecurate.functions.naming import once


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_float_text(x) -> Column:
    """Python ``str(float)`` for values already rounded to 6 decimals.

    Fixed notation with trailing zeros trimmed (``0.5``, ``1.0``, ``0.123457``);
    below 1e-4 Python switches to exponent form, reproduced here exactly for
    6-decimal values (``1e-05``, ``1.5e-05``, ``5e-06``)."""
    return once(_c(x).cast("double"), _float_text)


def _float_text(v: Column) -> Column:
    a = F.abs(v)
    k = F.floor(a * 1e6 + 0.5)                 # exact below 1e9, 1..99 when 0 < a < 1e-4
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    rest = k % 1_000_000
    digits = F.concat((k / 1_000_000).cast("long").cast("string"), F.lit("."), F.when(rest == 0, F.lit("0")).otherwise(
        F.rtrim(F.lpad(rest.cast("string"), 6, "0"), F.lit("0"))))
    short = F.rtrim(F.format_string("%.6f", v), F.lit("0"))
    fixed = F.when(short.endswith("."), F.concat(short, F.lit("0"))).otherwise(short)
    mant = F.when(k >= 10, F.when(k % 10 == 0, (k / 10).cast("long").cast("string"))
                  .otherwise(F.format_string("%.1f", k / 10.0))) \
            .otherwise(k.cast("string"))
    expo = F.when(k >= 10, F.lit("e-05")).otherwise(F.lit("e-06"))
    return F.when((a >= 1e-4) & (a < 1e9), F.concat(sign, digits)) \
            .when((a > 0) & (a < 1e-4), F.concat(sign, mant, expo)).otherwise(fixed)


def yolo_line(class_id, cx, cy, w, h) -> Column:
    """``"{class_id} {cx} {cy} {w} {h}"`` with Python float text."""
    return F.concat_ws(" ", _c(class_id).cast("string"),
                       py_float_text(cx), py_float_text(cy), py_float_text(w), py_float_text(h))


def label_text(lines) -> Column:
    """P20: lines joined by newline plus a final newline; empty list → ``''``."""
    arr = _c(lines)
    return F.when(F.size(arr) > 0, F.concat(F.array_join(arr, "\n"), F.lit("\n"))).otherwise(F.lit(""))
