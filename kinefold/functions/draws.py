"""Random draws from hashes of keys: equal for every partitioning, retry and engine.

A uniform number is the first 8 hexadecimal digits of an MD5 over 2**32.  Each
function has a twin that gives the same draw as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parts(parts: tuple) -> list[Column]:
    return [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]


def uniform(*parts: Column | str | int) -> Column:
    """In [0, 1); null parts are skipped, as concat_ws does."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *_parts(parts))), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def uniform_sql(*parts: str | int) -> str:
    """``parts`` are SQL expressions, or quoted text."""
    return f"(('0x'||substr(md5(concat_ws('|', {', '.join(f'({p})::VARCHAR' for p in parts)})),1,8))::BIGINT/4294967296.0::DOUBLE)"


def integer(limit: Column | int, *parts: Column | str | int) -> Column:
    """Uniform in 0..limit, both included."""
    return F.floor(uniform(*parts) * (limit + 1)).cast("long")


def integer_sql(limit: str | int, *parts: str | int) -> str:
    return f"floor({uniform_sql(*parts)}*({limit}+1))::BIGINT"


def between(low: float, high: float, *parts: Column | str | int) -> Column:
    return F.lit(float(low)) + (float(high) - float(low)) * uniform(*parts)


def between_sql(low: float, high: float, *parts: str | int) -> str:
    return f"({float(low)}::DOUBLE + {float(high) - float(low)!r}::DOUBLE*{uniform_sql(*parts)})"


def normal(*parts: Column | str | int) -> Column:
    """Standard normal, by Box and Muller."""
    return F.sqrt(-2.0 * F.log(1.0 - uniform(*parts, "u1"))) * F.cos(2.0 * F.lit(3.141592653589793) * uniform(*parts, "u2"))


def normal_sql(*parts: str | int) -> str:
    return f"(sqrt(-2.0::DOUBLE*ln(1.0::DOUBLE-{uniform_sql(*parts, "'u1'")}))*cos(2.0::DOUBLE*3.141592653589793::DOUBLE*{uniform_sql(*parts, "'u2'")}))"


ALMOST_HALF = 0.5001


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounding that both engines do alike: decimal data sit on exact halves, so the cut lies a little below."""
    return F.floor(value * 10.0**digits + ALMOST_HALF) / 10.0**digits


def rounded_sql(value: str, digits: int = 6) -> str:
    return f"(floor(({value})*{10**digits}.0::DOUBLE + {ALMOST_HALF}::DOUBLE)/{10**digits}.0::DOUBLE)"
