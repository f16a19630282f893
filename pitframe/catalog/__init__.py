"""Registered queries; importing a case module adds its queries."""

import importlib

MODULES = ["temporal_cases", "linking_cases", "graph_cases", "quality_cases", "measure_cases", "entity_cases", "question_cases", "stream_cases", "delivery_cases", "more_cases", "rule_cases", "proof_cases", "state_cases", "branch_cases"]


def load():
    from pitframe.catalog import registry
    for name in MODULES:
        importlib.import_module(f"pitframe.catalog.{name}")
    return registry.QUERIES, registry.SQL
