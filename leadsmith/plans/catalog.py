"""Imports every query module so the registry is complete."""

from __future__ import annotations

import importlib

from leadsmith.plans.registry import ORACLES, QUERIES

MODULES = [
    "leadsmith.plans.q_candidates",
    "leadsmith.plans.q_scalars",
    "leadsmith.plans.q_filters",
    "leadsmith.plans.q_rank",
    "leadsmith.plans.q_lookups",
    "leadsmith.plans.q_reports",
    "leadsmith.plans.q_sources",
    "leadsmith.plans.q_streaming",
    "leadsmith.plans.q_flows",
    "leadsmith.plans.q_landed",
]


def _load():
    for m in MODULES:
        importlib.import_module(m)


def queries():
    _load()
    return dict(QUERIES)


def oracle_sql():
    _load()
    return dict(ORACLES)
