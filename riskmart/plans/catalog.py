"""Registry of queries, each with the SQL it is checked against."""

from __future__ import annotations

import functools
import re

from riskmart.plans import views
from riskmart.session import tune

QUERIES: dict = {}
ORACLES: dict = {}
PARTS: dict = {}


def part(name: str, sql: str) -> None:
    """A named SELECT for the check SQL, usable by name in other check SQL."""
    PARTS[name] = sql


def _needed(sql: str, done: list[str], open_names: tuple = ()) -> list[str]:
    """Parts and views the text names, each after those it needs itself; a part may name itself."""
    for name in [*views.TEXT, *PARTS]:
        if name not in done and name not in open_names and re.search(rf"\b{name}\b", sql):
            text = PARTS[name] if name in PARTS else views.duckdb_text(name)
            _needed(text, done, (*open_names, name))
            done.append(name)
    return done


def check_sql(sql: str) -> str:
    """The text with everything it names put before it as common table expressions."""
    names = _needed(sql, [])
    tables = [f"{n} as ({PARTS[n] if n in PARTS else views.duckdb_text(n)})" for n in names]
    own = re.match(r"\s*with\s+", sql, re.IGNORECASE)
    if own:
        return "with recursive " + ",\n".join([*tables, sql[own.end():]])
    return "with recursive " + ",\n".join(tables) + "\n" + sql if tables else sql


def query(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is the DuckDB text giving the same rows."""
    def register(fn):
        @functools.wraps(fn)
        def tuned(spark, sf_dir):
            return fn(tune(spark), sf_dir)

        QUERIES[name] = tuned
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def all_queries() -> dict:
    from riskmart.plans import (  # noqa: F401  (importing registers the queries)
        data_queries, gold_queries, lifecycle_queries, metric_queries, monitoring_queries, registry_queries,
    )
    return dict(QUERIES)


def all_oracles() -> dict:
    all_queries()
    return {name: check_sql(sql) for name, sql in ORACLES.items()}
