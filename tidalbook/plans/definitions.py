"""Feature graphs as immutable values: nodes, sets, their hashes and a registry."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable
from dataclasses import dataclass, field

KINDS = ("price", "return", "rolling", "constant", "lag", "zscore", "volatility", "metadata", "difference", "ratio", "clip")


@dataclass(frozen=True)
class Node:
    """One feature: its name is its output column."""

    name: str
    kind: str
    inputs: tuple[str, ...] = ()
    params: tuple[tuple[str, object], ...] = ()

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown node kind {self.kind!r}")

    def param(self, name: str, default: object = None) -> object:
        return dict(self.params).get(name, default)


def node(name: str, kind: str, *inputs: str, **params: object) -> Node:
    return Node(name, kind, inputs, tuple(sorted(params.items())))


@dataclass(frozen=True)
class FeatureSet:
    name: str
    version: str
    nodes: tuple[Node, ...]
    keys: tuple[str, ...] = ("symbol",)
    aliases: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        names = [n.name for n in self.nodes]
        if len(set(names)) != len(names):
            raise ValueError("two nodes have one name")

    def definition_hash(self) -> str:
        """SHA-256 of the canonical JSON of everything that changes results."""
        body = {
            "name": self.name,
            "version": self.version,
            "keys": self.keys,
            "aliases": self.aliases,
            "nodes": [{"name": n.name, "kind": n.kind, "inputs": n.inputs, "params": dict(n.params)} for n in sorted(self.nodes, key=lambda n: n.name)],
        }
        return hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":"), default=list).encode()).hexdigest()


def stages(nodes: Iterable[Node]) -> list[list[Node]]:
    """Nodes in levels: each after all of its inputs, by name inside a level.

    Inputs that no node makes are columns of the events. A cycle is an error.
    """
    by_name = {n.name: n for n in nodes}
    waiting = {n.name: {i for i in n.inputs if i in by_name} for n in by_name.values()}
    out: list[list[Node]] = []
    while waiting:
        ready = [name for name, needs in waiting.items() if not needs]
        if not ready:
            raise ValueError(f"cycle among {sorted(waiting)}")
        heapq.heapify(ready)
        level = [by_name[heapq.heappop(ready)] for _ in range(len(ready))]
        out.append(level)
        for n in level:
            del waiting[n.name]
        for needs in waiting.values():
            needs.difference_update(n.name for n in level)
    return out


def default_set(windows: Iterable[int] = (3, 5, 10, 20, 50), name: str = "default", version: str = "v1") -> FeatureSet:
    """Price, return, and for each window the mean, exponential mean, maximum and minimum."""
    nodes = [node("price", "price"), node("ret_1", "return", "price")]
    for w in windows:
        nodes += [node(f"{agg}_{w}", "rolling", "price", window=w, aggregator=agg) for agg in ("sma", "ema", "max", "min")]
    return FeatureSet(name, version, tuple(nodes))


class Registry:
    """Definitions by (name, version); one that differs under a known version is refused."""

    def __init__(self) -> None:
        self._known: dict[tuple[str, str], FeatureSet] = {}
        self._active: dict[str, list[str]] = {}

    def register(self, feature_set: FeatureSet) -> None:
        key = (feature_set.name, feature_set.version)
        known = self._known.setdefault(key, feature_set)
        if known.definition_hash() != feature_set.definition_hash():
            raise ValueError(f"{key} is already defined otherwise")

    def get(self, name: str, version: str) -> FeatureSet:
        return self._known[name, version]

    def activate(self, name: str, version: str) -> None:
        self.get(name, version)
        self._active.setdefault(name, []).append(version)

    def rollback(self, name: str) -> str:
        """Drop the active version; the one before it is active again."""
        history = self._active.get(name, [])
        if len(history) < 2:
            raise ValueError(f"{name} has no earlier release")
        history.pop()
        return history[-1]

    def active(self, name: str) -> FeatureSet:
        return self.get(name, self._active[name][-1])
