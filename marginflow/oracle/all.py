"""All oracle SQL, keyed like ``marginflow.registry.QUERIES``."""

from __future__ import annotations

from marginflow.oracle import q_fact, q_hist, q_ops, q_plans, q_sources

ORACLE: dict[str, str] = {}
for _m in (q_fact, q_plans, q_ops, q_hist, q_sources):
    ORACLE.update(_m.ORACLE)
