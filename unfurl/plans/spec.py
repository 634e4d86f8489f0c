"""Flatten specs: a flatten declared as data.

A :class:`FlattenSpec` is an ordered list of :class:`Group` rows. Each group
names a node of the document by a path, a prefix and the leaf fields to read
from it. The same rows drive three things, so they cannot drift apart:

* the output column list (``spec.columns()``),
* the leaf expressions (one built-in Spark expression per column),
* the row-validity predicate (one check per distinct intermediate node).

Path notation: steps separated by ``/``; a step ending in ``[0]`` means
"first element of an array" (the node must be an array whose element 0 is an
object, or be missing). Keys are taken verbatim, so a key with a trailing
space (``"flt_info "``) is written as such.

Modes:

``object``
    leaves ``prefix + field`` read from the node at ``path``.
``legs``
    ``path`` names an array of objects; for every field (outer loop) and every
    slot ``i < legs`` (inner loop) the column ``prefix + i + "_" + field``
    reads ``field`` of element ``i``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Literal

Mode = Literal["object", "legs"]


@dataclass(frozen=True)
class Step:
    key: str
    first: bool = False  # ``key[0]``: first element of an array


def parse_path(path: str) -> tuple[Step, ...]:
    if path in ("", "$"):
        return ()
    steps = []
    for raw in path.split("/"):
        if raw.endswith("[0]"):
            steps.append(Step(raw[:-3], first=True))
        else:
            steps.append(Step(raw))
    return tuple(steps)


@dataclass(frozen=True)
class Group:
    path: str
    fields: tuple[str, ...]
    prefix: str = ""
    mode: Mode = "object"
    legs: int = 5
    # output-name overrides for single fields: {source field: output name}
    rename: tuple[tuple[str, str], ...] = ()

    @property
    def steps(self) -> tuple[Step, ...]:
        return parse_path(self.path)

    def out_name(self, fld: str, leg: int | None = None) -> str:
        renamed = dict(self.rename).get(fld)
        if renamed is not None:
            return renamed
        if leg is None:
            return f"{self.prefix}{fld}"
        return f"{self.prefix}{leg}_{fld}"

    def leaves(self) -> list[tuple[str, str, int | None]]:
        """(output name, field, leg index or None) in output order."""
        out: list[tuple[str, str, int | None]] = []
        if self.mode == "object":
            for f in self.fields:
                out.append((self.out_name(f), f, None))
        else:
            for f in self.fields:  # field-major, as the outputs are laid out
                for i in range(self.legs):
                    out.append((self.out_name(f, i), f, i))
        return out


NodeKind = Literal["object", "first", "legs"]


@dataclass(frozen=True)
class Node:
    steps: tuple[Step, ...]
    kind: NodeKind

    @property
    def label(self) -> str:
        return "/".join(s.key + ("[0]" if s.first else "") for s in self.steps) or "$"


@dataclass(frozen=True)
class FlattenSpec:
    name: str
    groups: tuple[Group, ...]
    # constant-NULL string columns appended after the key columns
    null_columns: tuple[str, ...] = ()
    key_columns: tuple[str, ...] = ("pk", "sk", "upsertTimestamp")
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    # ---- output schema -------------------------------------------------
    def payload_leaves(self) -> list[tuple[Group, str, str, int | None]]:
        """Every payload column once, first occurrence wins (a field listed
        twice in a group keeps its first position)."""
        seen: set[str] = set()
        out = []
        for g in self.groups:
            for name, fld, leg in g.leaves():
                if name in seen:
                    continue
                seen.add(name)
                out.append((g, name, fld, leg))
        return out

    def payload_columns(self) -> list[str]:
        return [name for _, name, _, _ in self.payload_leaves()]

    def columns(self) -> list[str]:
        keys = [k for k in self.key_columns if k not in set(self.payload_columns())]
        return self.payload_columns() + keys + list(self.null_columns)

    # ---- validity ------------------------------------------------------
    def nodes(self) -> list[Node]:
        """Distinct intermediate nodes, parents before children."""
        kinds: dict[tuple[Step, ...], NodeKind] = {}
        for g in self.groups:
            steps = g.steps
            for depth in range(1, len(steps) + 1):
                prefix = steps[:depth]
                last = prefix[-1]
                if depth == len(steps) and g.mode == "legs":
                    kind: NodeKind = "legs"
                elif last.first:
                    kind = "first"
                else:
                    kind = "object"
                old = kinds.get(prefix)
                if old is not None and old != kind:
                    raise ValueError(f"node {prefix} used as {old} and {kind}")
                kinds[prefix] = kind
        return [Node(s, k) for s, k in sorted(kinds.items(), key=lambda kv: len(kv[0]))]

    def with_path(self, old: str, new: str) -> "FlattenSpec":
        """The same spec reading ``new`` where it read ``old`` (and below it);
        output column names are unchanged. E.g. read a misspelt source key
        under its corrected name: ``SCAN.with_path(".../flt_info ", ".../flt_info")``."""
        from dataclasses import replace

        def moved(path: str) -> str:
            if path == old:
                return new
            if path.startswith(old + "/"):
                return new + path[len(old):]
            return path

        groups = tuple(replace(g, path=moved(g.path)) for g in self.groups)
        if groups == self.groups:
            raise ValueError(f"no group path starts with {old!r}")
        return replace(self, groups=groups)

    # ---- as plain data --------------------------------------------------
    def to_dict(self) -> dict:
        return {
            "name": self.name,
            "key_columns": list(self.key_columns),
            "null_columns": list(self.null_columns),
            "groups": [
                {"path": g.path, "fields": list(g.fields), "prefix": g.prefix, "mode": g.mode, "legs": g.legs,
                 "rename": dict(g.rename)}
                for g in self.groups
            ],
            "extra": {k: [v[0], list(v[1])] for k, v in self.extra.items()},
        }

    @classmethod
    def from_dict(cls, d: dict) -> "FlattenSpec":
        groups = tuple(
            Group(g["path"], tuple(g["fields"]), g.get("prefix", ""), g.get("mode", "object"), g.get("legs", 5),
                  tuple(g.get("rename", {}).items()))
            for g in d["groups"]
        )
        extra = {k: (v[0], tuple(v[1])) for k, v in d.get("extra", {}).items()}
        spec = cls(d["name"], groups, tuple(d.get("null_columns", ())),
                   tuple(d.get("key_columns", ("pk", "sk", "upsertTimestamp"))), extra)
        spec.nodes()  # reject inconsistent node kinds early
        spec.check_names()
        return spec

    def check_names(self) -> None:
        cols = self.columns()
        lowered = [c.lower() for c in cols]
        if len(set(lowered)) != len(lowered):
            dup = sorted({c for c in lowered if lowered.count(c) > 1})
            raise ValueError(f"spec {self.name}: duplicate output columns {dup}")


def load_spec(path: str) -> FlattenSpec:
    """A spec from a JSON file shaped like ``FlattenSpec.to_dict()`` (read on the driver)."""
    import json

    with open(path) as f:
        return FlattenSpec.from_dict(json.load(f))
