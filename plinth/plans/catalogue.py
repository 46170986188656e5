"""All registered queries of the engine's own operators, with their SQL."""

from __future__ import annotations

from plinth.plans import data_plans, page_plans, rank_plans, registry, text_plans  # noqa: F401  (they register)


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
