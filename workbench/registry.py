"""Query registry: a Spark callable and, where one exists, the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workbench.views import cte

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = cte(sql)
        return fn

    return register


def r6(c: str | Column, alias: str | None = None, digits: int = 6) -> Column:
    """Rounded value without a negative zero."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col, digits) + F.lit(0.0)
    name = alias or (c if isinstance(c, str) else None)
    return out.alias(name) if name else out


def s6(expr: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"(ROUND({expr},{digits})+CAST(0 AS DOUBLE))"


def s_sep(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Haversine separation in SQL."""
    return (
        f"DEGREES(2*ASIN(SQRT(LEAST(1.0,POWER(SIN(RADIANS({dec2}-{dec1})/2),2)"
        f"+COS(RADIANS({dec1}))*COS(RADIANS({dec2}))*POWER(SIN(RADIANS({ra2}-{ra1})/2),2)))))"
    )


def s_wrap(expr: str) -> str:
    return f"(({expr})-360.0*FLOOR(({expr})/360.0))"


def s_pa(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Bearing in SQL."""
    return s_wrap(
        f"DEGREES(ATAN2(SIN(RADIANS({ra2}-{ra1}))*COS(RADIANS({dec2})),"
        f"COS(RADIANS({dec1}))*SIN(RADIANS({dec2}))"
        f"-SIN(RADIANS({dec1}))*COS(RADIANS({dec2}))*COS(RADIANS({ra2}-{ra1}))))"
    )
