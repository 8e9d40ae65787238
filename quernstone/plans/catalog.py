"""The core's queries."""

from __future__ import annotations

from quernstone.plans.registry import Registry


def core_registry() -> Registry:
    registry = Registry()
    for part in _parts():
        registry.update(part)
    return registry


def _parts() -> list[Registry]:
    from quernstone.plans import queries_exchange, queries_files, queries_packed, queries_records, queries_reports, queries_shredded, queries_snapshots

    return [queries_packed.REGISTRY, queries_snapshots.REGISTRY, queries_shredded.REGISTRY, queries_records.REGISTRY, queries_reports.REGISTRY, queries_exchange.REGISTRY, queries_files.REGISTRY]
