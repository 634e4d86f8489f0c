"""Build payload documents from the driver tables, and the matching oracle SQL.

The driver tables hold no payload column, so checks and benchmarks build one:
Spark SQL nests table columns into a document along the spec's own paths
(``to_json(named_struct(...))`` for JSON, string assembly for XML), the
flatten runs over it, and DuckDB computes the expected columns with plain SQL
on the same tables. Both sides come from one ``fill`` table (output column ->
value expression), so they cannot disagree about which value lands where.

Value expressions are written in the SQL both engines accept; only integers,
strings, booleans and ISO dates are used (float text differs by engine).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from unfurl.plans.spec import FlattenSpec, parse_path


def dq(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def sq(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ---------------------------------------------------------------------------
# Lines of an order in a total order (no ties). Documents hold all of them; the
# oracle picks the slots that the output has columns for.
# ---------------------------------------------------------------------------
LEG_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


def ranked_lines_sql(table: str, n: int) -> str:
    return (
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, "
        f"l_shipdate, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LEG_ORDER}) AS rn "
        f"FROM {table}"
    )


# leg fields: spec field -> value over a lineitem row ``l``
@dataclass
class Doc:
    spec: FlattenSpec
    fill: dict[str, str]  # output column -> value SQL over o (orders), c (customer)
    legs: dict[str, dict[str, str]] = field(default_factory=dict)  # group path -> {field: value over lineitem}
    keys: dict[str, str] = field(default_factory=dict)  # key column -> SQL (both engines)
    # node path -> [(condition, spark variant SQL or NULL)]: replaces the node when the condition holds
    overrides: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    # oracle: output-column prefix filter -> condition under which the column is visible
    visible: list[tuple[callable, str]] = field(default_factory=list)
    # oracle value for a column, when it differs from CAST(fill AS VARCHAR)
    oracle_override: dict[str, str] = field(default_factory=dict)

    def leaf_index(self):
        return {name: (g, fld, leg) for g, name, fld, leg in self.spec.payload_leaves()}


class _Node:
    def __init__(self, first=False):
        self.first = first
        self.children: dict[str, object] = {}


def _insert(root: _Node, steps, key, value):
    node = root
    for s in steps:
        child = node.children.get(s.key)
        if child is None:
            child = node.children[s.key] = _Node(first=s.first)
        node = child
    node.children[key] = ("v", value)


def _render(node: _Node, path: str, doc: Doc) -> str:
    items = []
    for k, v in node.children.items():
        sub = f"{path}/{k}" if path else k
        if isinstance(v, tuple):
            val = v[1]
        else:
            val = _render(v, sub + ("[0]" if v.first else ""), doc)
        items.append(f"{sq(k)}, {val}")
    body = f"named_struct({', '.join(items)})"
    if node.first:
        body = f"array({body})"
    ov = doc.overrides.get(path)
    if ov:
        whens = " ".join(f"WHEN {cond} THEN {val}" for cond, val in ov)
        body = f"CASE {whens} ELSE to_variant_object({body}) END"
    return body


def spark_json_doc(doc: Doc, legs_col: str = "legs") -> str:
    """Spark SQL text of the JSON document (a STRING)."""
    root = _Node()
    idx = doc.leaf_index()
    for name, expr in doc.fill.items():
        g, fld, _ = idx[name]
        _insert(root, g.steps, fld, expr)
    for gpath, fields in doc.legs.items():
        steps = parse_path(gpath)
        leg = "named_struct(" + ", ".join(f"{sq(f)}, {e}" for f, e in fields.items()) + ")"
        _insert(root, steps[:-1], steps[-1].key, f"transform(coalesce({legs_col}, array()), l -> {leg})")
    return f"to_json({_render(root, '', doc)})"


def oracle_columns(doc: Doc, legs_alias: str = "lp") -> list[str]:
    """DuckDB select list producing exactly ``spec.columns()``."""
    idx = doc.leaf_index()
    leg_cols = {}
    for gpath, fields in doc.legs.items():
        for name, (g, fld, leg) in idx.items():
            if g.path == gpath and g.mode == "legs" and fld in fields:
                leg_cols[name] = f"{legs_alias}.{dq(name)}"
    out = []
    for name in doc.spec.columns():
        if name in doc.oracle_override:
            val = doc.oracle_override[name]
        elif name in doc.fill:
            val = f"CAST({doc.fill[name]} AS VARCHAR)"
        elif name in leg_cols:
            val = leg_cols[name]
        elif name in doc.keys:
            val = doc.keys[name]
        else:
            val = "CAST(NULL AS VARCHAR)"
        conds = [cond for match, cond in doc.visible if match(name)]
        if conds and name not in doc.keys:
            val = f"CASE WHEN {' AND '.join(conds)} THEN {val} END"
        out.append(f"{val} AS {dq(name)}")
    return out


def oracle_leg_pivot(doc: Doc, ranked: str, slots: int) -> str:
    """DuckDB: one row per order, one column per (leg field, slot)."""
    idx = doc.leaf_index()
    cols = []
    for gpath, fields in doc.legs.items():
        for name, (g, fld, leg) in idx.items():
            if g.path == gpath and g.mode == "legs" and fld in fields and leg < slots:
                expr = fields[fld].replace("l.", "")
                cols.append(f"max(CASE WHEN rn = {leg + 1} THEN CAST({expr} AS VARCHAR) END) AS {dq(name)}")
    return f"SELECT l_orderkey, {', '.join(cols)} FROM ({ranked}) r GROUP BY l_orderkey"


# ---------------------------------------------------------------------------
# XML documents
# ---------------------------------------------------------------------------
def xml_esc(expr: str) -> str:
    return f"replace(replace(replace(CAST({expr} AS STRING), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _xml_leaf(tag: str, expr: str) -> str:
    return f"concat('<{tag}>', coalesce({xml_esc(expr)}, ''), '</{tag}>')"


@dataclass
class XmlDoc(Doc):
    root_open: str = "<Envelope>"  # may declare namespaces
    tag_prefix: dict = field(default_factory=dict)  # element name -> namespace prefix
    attrs: dict = field(default_factory=dict)  # element path -> SQL producing attribute text ('' for none)
    raw: dict = field(default_factory=dict)  # element path -> SQL of extra XML appended inside it


def spark_xml_doc(doc: XmlDoc, legs_col: str = "legs", damage=None) -> str:
    """Spark SQL text of the JSON-wrapped XML document (a STRING).

    ``damage``: optional function from the XML text SQL to a changed one."""
    tree: dict = {}
    idx = doc.leaf_index()

    def node_at(keys):
        t = tree
        for k in keys:
            t = t.setdefault(k, {})
        return t

    for name, expr in doc.fill.items():
        g, fld, _ = idx[name]
        node_at([s.key for s in g.steps])[("leaf", fld)] = expr
    for gpath, fields in doc.legs.items():
        keys = [s.key for s in parse_path(gpath)]
        node_at(keys[:-1])[("legs", keys[-1])] = fields

    def tag(k):
        p = doc.tag_prefix.get(k)
        return f"{p}:{k}" if p else k

    def render(t: dict, path: str) -> tuple[str, str | None]:
        parts, guard = [], None
        for k, v in t.items():
            if isinstance(k, tuple) and k[0] == "leaf":
                parts.append(_xml_leaf(tag(k[1]), v))
            elif isinstance(k, tuple) and k[0] == "legs":
                leg = "concat(" + ", ".join(_xml_leaf(tag(f), e) for f, e in v.items()) + ")"
                parts.append(
                    f"array_join(transform(coalesce({legs_col}, array()), l -> "
                    f"concat('<{tag(k[1])}>', {leg}, '</{tag(k[1])}>')), '')"
                )
                guard = f"size(coalesce({legs_col}, array())) > 0"
            else:
                sub = f"{path}/{k}" if path else k
                inner, g = render(v, sub)
                if sub in doc.raw:
                    inner = f"concat({inner}, {doc.raw[sub]})"
                attr = doc.attrs.get(sub)
                open_tag = f"concat('<{tag(k)}', {attr}, '>')" if attr else f"'<{tag(k)}>'"
                el = f"concat({open_tag}, {inner}, '</{tag(k)}>')"
                parts.append(f"CASE WHEN {g} THEN {el} ELSE '' END" if g else el)
        return "concat(" + ", ".join(parts) + ")", guard

    env = tree.pop("Envelope")
    inner, _ = render(env, "Envelope")
    xml = f"concat({sq(doc.root_open)}, {inner}, '</Envelope>')"
    if damage:
        xml = damage(xml)
    return f"to_json(named_struct('text', {xml}))"
