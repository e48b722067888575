"""Small helpers shared by the tests."""

from __future__ import annotations


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())
