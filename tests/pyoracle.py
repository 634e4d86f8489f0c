"""Independent per-row Python model of the flatten rules, for tests and as a UDF baseline.

Written from the rule tables (N1-N14 for JSON), not from the Spark
implementation: a document either yields {column: text} or None (row dropped).
"""

from __future__ import annotations

import json
from decimal import Decimal

_MISSING = object()


class Drop(Exception):
    pass


def java_double(v):
    """Text of a double as the JVM prints it."""
    if v != v or v in (float("inf"), float("-inf")):
        return "NaN" if v != v else "Infinity" if v > 0 else "-Infinity"
    if v == 0 or 1e-3 <= abs(v) < 1e7:
        text = format(v, "f") if "e" in repr(v) else repr(v)
        return text
    digits, exp = f"{Decimal(repr(v)):E}".split("E")
    whole, _, part = digits.partition(".")
    return f"{whole}.{part.rstrip('0') or '0'}E{int(exp)}"


def leaf_text(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_inner(x)}" for k, x in v.items()) + "}"
    if isinstance(v, list):
        return "[" + ",".join(map(_inner, v)) + "]"
    return java_double(v) if isinstance(v, float) else str(v)


def _inner(v):
    if v is None:
        return "null"
    if isinstance(v, float) and (v != v or v in (float("inf"), float("-inf"))):
        return f'"{java_double(v)}"'  # nested text stays JSON
    return json.dumps(v, ensure_ascii=False) if isinstance(v, str) else leaf_text(v)


def _node(cur, steps):
    """Walk object / first-element steps; a missing step yields an empty object."""
    for s in steps:
        if not isinstance(cur, dict):
            raise Drop
        v = cur.get(s.key, _MISSING)
        if v is _MISSING:
            cur = {}
            continue
        if s.first:
            if not isinstance(v, list) or not v or not isinstance(v[0], dict):
                raise Drop
            v = v[0]
        elif not isinstance(v, dict):
            raise Drop
        cur = v
    return cur


def _legs(parent, key, n):
    v = parent.get(key, _MISSING)
    if v is _MISSING:
        return [{}] + [None] * (n - 1)
    if isinstance(v, (list, str, dict)):
        out = []
        for i in range(n):
            if len(v) > i:
                if not isinstance(v, list) or not isinstance(v[i], dict):
                    raise Drop
                out.append(v[i])
            else:
                out.append(None)
        return out
    raise Drop


def _node_lenient(cur, steps):
    """Lenient walk: a node of the wrong kind reads as missing (empty object)."""
    for s in steps:
        v = cur.get(s.key) if isinstance(cur, dict) else None
        if s.first:
            v = v[0] if isinstance(v, list) and v else None
        if not isinstance(v, dict):
            return {}
        cur = v
    return cur


def _legs_lenient(parent, key, n):
    v = parent.get(key)
    if not isinstance(v, list):
        return [None] * n
    return [v[i] if i < len(v) and isinstance(v[i], dict) else None for i in range(n)]


def walk(spec):
    """The spec's groups, paths and leaves, walked once: ``(group, steps, leaves)``."""
    return [(g, g.steps, g.leaves()) for g in spec.groups]


def flatten_json_py(text, spec, strict=True, walked=None):
    """``walked``: ``walk(spec)``, for callers with many documents."""
    walked = walked or walk(spec)
    if text is None:
        return None
    try:
        data = json.loads(text)
    except ValueError:
        return None
    if not isinstance(data, dict):
        return None
    out = {}
    if not strict:
        for g, steps, leaves in walked:
            if g.mode == "legs":
                legs = _legs_lenient(_node_lenient(data, steps[:-1]), steps[-1].key, g.legs)
                for name, fld, i in leaves:
                    out.setdefault(name, leaf_text(legs[i].get(fld)) if legs[i] is not None else None)
            else:
                node = _node_lenient(data, steps)
                for name, fld, _ in leaves:
                    out.setdefault(name, leaf_text(node.get(fld)))
        return out
    try:
        for g, steps, leaves in walked:
            if g.mode == "legs":
                parent = _node(data, steps[:-1])
                legs = _legs(parent, steps[-1].key, g.legs)
                for name, fld, i in leaves:
                    out.setdefault(name, leaf_text(legs[i].get(fld)) if legs[i] is not None else None)
            else:
                node = _node(data, steps)
                for name, fld, _ in leaves:
                    out.setdefault(name, leaf_text(node.get(fld)))
    except Drop:
        return None
    return out


# ---------------------------------------------------------------------------
# XML rules (X-a .. X-f), per element of the spec's paths
# ---------------------------------------------------------------------------
def _local(tag: str) -> str:
    return tag.split("}", 1)[1] if "}" in tag else tag


def _kids(el, name):
    return [c for c in el if _local(c.tag) == name]


def _has_children(el) -> bool:
    return len(el) > 0


def _xml_leaf(el, name):
    if name in el.attrib:
        return el.attrib[name]
    kids = _kids(el, name)
    if not kids:
        return None
    if len(kids) > 1:
        return json.dumps([k.text or "" for k in kids], separators=(",", ":"), ensure_ascii=False)
    return kids[0].text or None


def _xml_node(root, keys, *, legs=False, single_leg="drop"):
    """Element for ``keys`` (leg 0 for legs), None when missing; raises Drop on a bad node."""
    if _local(root.tag) != keys[0]:
        return None
    if not _has_children(root):
        raise Drop
    el = root
    for i, k in enumerate(keys[1:], start=1):
        last = i == len(keys) - 1
        if k in el.attrib:
            raise Drop
        kids = _kids(el, k)
        if not kids:
            return None
        if last and legs:
            if len(kids) == 1 and single_leg != "keep":
                raise Drop
            if not _has_children(kids[0]):
                raise Drop
            return kids[0]
        if len(kids) > 1 or not _has_children(kids[0]):
            raise Drop
        el = kids[0]
    return el


def _xml_node_lenient(root, keys, leg=0):
    """Lenient: the first occurrence of each element (``leg``-th for the last
    step of a legs path), whatever its content; None when absent."""
    if _local(root.tag) != keys[0]:
        return None
    el = root
    for i, k in enumerate(keys[1:], start=1):
        kids = _kids(el, k)
        idx = leg if i == len(keys) - 1 else 0
        if len(kids) <= idx:
            return None
        el = kids[idx]
    return el


def _scan_detail_ok(root, path):
    keys = path.split("/")
    parent = _xml_node(root, keys[:-1])
    if parent is None:
        return
    name = keys[-1]
    if name in parent.attrib:
        if parent.attrib[name] != "":
            raise Drop
        return
    kids = _kids(parent, name)
    if len(kids) > 1:
        raise Drop
    if kids and not _has_children(kids[0]) and kids[0].text:
        raise Drop


def flatten_xml_py(payload, spec, single_leg="drop", strict=True, walked=None):
    import xml.etree.ElementTree as ET

    walked = walked or walk(spec)

    if payload is None:
        return None
    try:
        data = json.loads(payload)
    except ValueError:
        return None
    if not isinstance(data, dict) or not isinstance(data.get("text"), str):
        return None
    try:
        root = ET.fromstring(data["text"])
    except ET.ParseError:
        return None
    out = {}
    if not strict:
        for g, steps, leaves in walked:
            keys = [s.key for s in steps]
            for name, fld, leg in leaves:
                node = _xml_node_lenient(root, keys, leg or 0)
                out.setdefault(name, _xml_leaf(node, fld) if node is not None else None)
        return out
    try:
        detail = spec.extra.get("scan_detail")
        if detail:
            _scan_detail_ok(root, detail[0])
        for g, steps, leaves in walked:
            keys = [s.key for s in steps]
            node = _xml_node(root, keys, legs=g.mode == "legs", single_leg=single_leg)
            for name, fld, _ in leaves:
                out.setdefault(name, _xml_leaf(node, fld) if node is not None else None)
    except Drop:
        return None
    return out
