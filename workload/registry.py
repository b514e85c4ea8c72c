"""Registration of queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.fixtures import FIXTURES, Lake, oracle_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Named SQL views built on fixtures, for use in checking SQL: name -> (needs, text).
ORACLE_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def oracle_view(name: str, uses: tuple[str, ...], text: str) -> None:
    ORACLE_VIEWS[name] = (uses, text.strip())


def _collect(names, seen: dict[str, str]) -> None:
    for name in names:
        if name in seen:
            continue
        if name in ORACLE_VIEWS:
            needs, text = ORACLE_VIEWS[name]
            _collect(needs, seen)
            seen[name] = text
        else:
            seen[name] = oracle_text(name)


def oracle(uses: tuple[str, ...], body: str) -> str:
    seen: dict[str, str] = {}
    _collect(uses, seen)
    body = body.strip()
    if not seen:
        return body
    head = "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in seen.items())
    return head + ("," + body[4:] if body.startswith("WITH") else "\n" + body)


def query(name: str, sql: str | None = None, uses: tuple[str, ...] | str = ()):
    """Register ``fn(lake)`` under a name; ``sql`` is its check, if it has one."""
    uses = (uses,) if isinstance(uses, str) else uses

    def register(fn: Callable[[Lake], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Lake(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(uses, sql)
        return fn

    return register


__all__ = ["FIXTURES", "ORACLES", "QUERIES", "oracle", "oracle_view", "query"]
