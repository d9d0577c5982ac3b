"""All registered queries of the label analytics, with their SQL twins."""

from __future__ import annotations

import importlib

MODULES = ("q_labels", "q_tables", "q_sequences", "q_flows")


def _parts():
    return [importlib.import_module(f"strokelab.plans.{m}") for m in MODULES]


def queries() -> dict:
    return {k: f for m in _parts() for k, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _parts() for k, s in m.oracle_sql().items()}
