"""Named queries (Spark) and their DuckDB oracle SQL, filled in by the ``recheck.plans.q_*`` modules."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    from recheck.plans import q_flows, q_profile, q_recon, q_rules, q_sources, q_stats, q_summary  # noqa: F401
