"""Registry of queries, each with the SQL that should give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .views import SQL_VIEWS, Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(body: str) -> str:
    """Prefix a SELECT with the common tables it mentions, in dependency order."""
    names, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name, sql in SQL_VIEWS.items():
            if name not in names and re.search(rf"\b{name}\b", text):
                names.add(name)
                todo.append(sql)
    heads = [f"{n} AS ({SQL_VIEWS[n]})" for n in SQL_VIEWS if n in names]
    body = body.strip()
    if not heads:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(heads) + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(heads) + ",\n" + body[5:]
    return "WITH " + ",\n".join(heads) + "\n" + body


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Views` under ``name``."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Views(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round columns for comparison, without negative zeros."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in columns})


def r(expr: str, digits: int = 6) -> str:
    """The SQL counterpart of :func:`rounded`."""
    return f"(round(({expr})::DOUBLE, {digits}) + 0.0)"


def _simpson(top: str, body: str, points: int) -> str:
    """Simpson integral of ``body`` (a function of ``x``) from 0 to ``top``."""
    return (
        f"(SELECT sum((CASE WHEN k IN (0, {points}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * ({body})) * ({top}) / {3 * points} "
        f"FROM (SELECT k, ({top}) * k / {points}.0::DOUBLE AS x FROM (SELECT unnest(range(0, {points + 1})) AS k)))"
    )


def normal_p_sql(z: str, points: int = 400) -> str:
    """Two-sided normal p-value."""
    area = _simpson(f"least(abs({z}), 9)", "exp(-x * x / 2)", points)
    return f"greatest(0, 1 - 2 / sqrt(2 * pi()) * {area})"


def t_p_sql(t: str, df: str, points: int = 400) -> str:
    """Two-sided Student p-value."""
    area = _simpson(f"atan(abs({t}) / sqrt({df}))", f"pow(cos(x), {df} - 1)", points)
    return f"greatest(0, 1 - 2 * exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt(pi()) * {area})"


def f_p_sql(f: str, d1: str, d2: str, points: int = 2000) -> str:
    """Upper tail of F."""
    top = f"asin(sqrt({d2} / ({d2} + {d1} * {f})))"
    area = _simpson(top, f"pow(sin(x), {d2} - 1) * pow(cos(x), {d1} - 1)", points)
    return f"2 * exp(lgamma(({d1} + {d2}) / 2) - lgamma({d1} / 2) - lgamma({d2} / 2)) * {area}"
