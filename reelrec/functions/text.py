"""Java string semantics as Spark column expressions (all JVM-side, codegen friendly).

* ``String.trim`` strips every char <= U+0020; Spark's ``trim`` strips only spaces.
* ``String.split(d)`` drops trailing empty fields; Spark's ``split`` keeps them.
* ``toInt`` / ``toDouble`` failures become nulls through ``try_cast`` so the caller can
  quarantine the line instead of failing the job (ANSI mode is on by default).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Java's String.trim removes (U+0000 .. U+0020).
JAVA_TRIM_CHARS = "".join(chr(c) for c in range(0x21))

INT_MIN = -(2**31)
INT_MAX = 2**31 - 1


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    return F.btrim(col_of(c), F.lit(JAVA_TRIM_CHARS))


def java_split(c: Column | str, delim: str) -> Column:
    """``String.split(delim)`` with ``delim`` taken literally: trailing empties removed."""
    q = re.escape(delim)
    return F.split(F.regexp_replace(col_of(c), f"(?:{q})+$", ""), q)


def field(parts: Column, i: int) -> Column:
    """0-based array item, null when absent (never an ANSI index error)."""
    return F.get(parts, i)


def to_int_id(c: Column | str, what: str = "id") -> Column:
    """Narrow a bigint key to int, failing loudly instead of wrapping on overflow."""
    c = col_of(c)
    return F.when(c.isNull(), F.lit(None).cast("int")).when(
        c.between(INT_MIN, INT_MAX), c.cast("int")
    ).otherwise(F.raise_error(F.concat(F.lit(f"{what} out of int range: "), c.cast("string"))).cast("int"))


def epoch_seconds(c: Column | str) -> Column:
    """Epoch seconds of a TIMESTAMP_NTZ / TIMESTAMP, independent of the session time zone
    for NTZ input."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            col_of(c).cast("timestamp_ntz"))
