"""``flatten_json``: JSON payload column -> wide all-string table.

Plan shape (one narrow stage, no shuffle, no Python)::

    Project   g_i.field AS column ...             <- plain struct field reads
    Generate  explode(CASE WHEN valid(w, g) THEN array(true) END)
    Project   keys, w, g_i = node_i of v          <- plain struct field reads
    Project   keys, w = try_parse_json('[' || payload || ',mark]') unless fine,
              v = o.d[1], or from_json(payload, struct of the whole spec)
    Project   keys, o, taken(o), fine(o)
    Project   keys, o = from_json('{"d":[mark,' || payload || ',mark]}')
    Filter    payload IS NOT NULL                 <- pushed to the scan
    Scan      (payload and key columns only)

Values come from ``v``: its string fields have the text of the JSON leaf as the
JVM prints it (``5.0`` stays ``5.0``, ``0.0001`` is ``1.0E-4``). The Variant
``w`` serves the row checks (which node is missing, null, of another kind).

Most documents need no Variant. ``o`` reads the document as strictly as the Variant
does, as the second of three elements whose first and last hold a hash of it: both are in
their places only if the text is one value, and ``from_json`` reports any node of another
kind than the spec's. A row without a report, an explicit null and an empty array that is
read by its first element passes all checks (``fine``); a null is looked for only if some node was not read. Any other row is read and checked
node by node.

``from_json`` drops a whole array if any element is not of the declared kind,
while the row rules look at the first elements only; such an array is read
again as texts, element by element (``_array``), which no other document pays for.

The ``Generate`` is the row filter. A plain ``Filter`` on ``valid(...)``
would be pushed below the projections it reads and their expressions
(parses) would be computed twice, once in the filter and once for the
output; ``explode`` of a zero-or-one element array drops the row without
that rewrite. The not-null filter touches a source column only, so it can be
pushed without that.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame

from ..functions import variant as V
from ..plans.spec import FlattenSpec, Step

_W = "__doc"
_V = "__values"
_T = "__text"
_FINE, _TAKEN = "__fine", "__taken"
_ONE, _MARK, _UNREAD = "__one", "__mark", "__unread"
_DUP_KEYS_CONF = "spark.sql.variant.allowDuplicateKeys"


@contextlib.contextmanager
def duplicate_keys_last(spark, enabled: bool = True):
    """Parse with "last duplicate key wins" while a plan is being built.

    The setting is read when the parse expression is analysed and then kept
    inside the plan, so it is enough to hold it while the DataFrame is built;
    the session is restored afterwards.
    """
    if not enabled:
        yield
        return
    old = spark.conf.get(_DUP_KEYS_CONF, "false")
    spark.conf.set(_DUP_KEYS_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(_DUP_KEYS_CONF, old)


def _legs_per_node(spec: FlattenSpec) -> dict:
    out: dict = {}
    for g in spec.groups:
        if g.mode == "legs":
            out[g.steps] = max(out.get(g.steps, 0), g.legs)
    return out


class _Member:
    """A key of the spec's value tree: a leaf, an object, or an array of objects."""

    def __init__(self, kind: str = "object"):
        self.kind, self.leaf, self.members = kind, False, {}

    def ddl(self, texts: bool = False) -> str:
        if self.kind == "leaf":
            return "string"
        if texts:
            return "array<string>"
        own = ", ".join(f"{V.ident(k)}: {m.ddl()}" for k, m in self.members.items())
        return f"array<struct<{own}>>" if self.kind == "array" else f"struct<{own}>"


def _value_tree(spec: FlattenSpec) -> _Member:
    root = _Member()
    for g in spec.groups:
        node = root
        for i, s in enumerate(g.steps):
            array = s.first or (g.mode == "legs" and i == len(g.steps) - 1)
            below = node.members.get(s.key)
            if below is None:
                below = node.members[s.key] = _Member("array" if array else "object")
            elif below.kind == "leaf":
                below.kind, below.leaf = "array" if array else "object", True
            node = below
        for f in g.fields:
            m = node.members.setdefault(f, _Member("leaf"))
            if m.kind != "leaf":
                m.leaf = True  # also read as a leaf: its JSON text
    return root


def _path_ddl(keys: list[str], last: str) -> str:
    """Struct that holds one path only."""
    for k in reversed(keys):
        last = f"struct<{V.ident(k)}: {last}>"
    return last


def _from_json(text: str, ddl: str) -> str:
    return f"from_json({text}, {V.sql_str(ddl)}, {V.READ_ALL})"


class _Plan:
    """Column names and SQL for one spec: group structs and row checks.

    Each group's node is one struct (or array of structs for legs) inside the
    parsed values. A node that is there as a struct also answers the "is an object"
    test; other nodes are probed in the Variant by path, and "is it missing" is
    only asked once a node is not an object.
    """

    def __init__(self, spec: FlattenSpec, strict: bool):
        self.spec = spec
        self.strict = strict
        self.key_length = max([64, *(len(s.key) for g in spec.groups for s in g.steps)])
        self.nodes = spec.nodes()
        self.legs = _legs_per_node(spec)
        self.tree = _value_tree(spec)
        # one struct per (node, mode); groups on the same node share it
        self.group_col: dict = {}
        for g in spec.groups:
            self.group_col.setdefault((g.steps, g.mode), f"__g{len(self.group_col)}")
        # array nodes read by their first element, outer before inner
        firsts = {g.steps[:i + 1] for g in spec.groups for i, s in enumerate(g.steps) if s.first}
        self.first_col = {st: f"__f{i}" for i, st in enumerate(sorted(firsts, key=lambda st: (len(st), [s.key for s in st])))}
        # the member that only the marks around a document have
        self.mark = _MARK
        while self.mark.lower() in map(str.lower, self.tree.members):
            self.mark += "_"
        self.tree.members[self.mark] = _Member("leaf")

    def _member(self, steps) -> _Member:
        node = self.tree
        for s in steps:
            node = node.members[s.key]
        return node

    def _base(self, steps) -> tuple[str, str, list[str]]:
        """The innermost first-element column above a node, its JSON text (read anew from the
        payload: only rare branches use it), and the keys below it."""
        for i in range(len(steps), 0, -1):
            if steps[:i] in self.first_col:
                return V.ident(self.first_col[steps[:i]]), f"get({self._texts(steps[:i])}, 0)", [s.key for s in steps[i:]]
        return V.ident(_V), V.ident(_T), [s.key for s in steps]

    def _array(self, steps) -> tuple[str, str, str]:
        """An array node, whether it is an array that ``from_json`` did not take whole, and
        the same node of the Variant, whose elements are NULL unless they are objects."""
        base, _, keys = self._base(steps[:-1])
        keys = [*keys, steps[-1].key]
        arr = ".".join([base, *map(V.ident, keys)])
        path = V.vpath(steps[:-1]) + V._quote(steps[-1].key)
        objects = V.vget(_W, path, "array<struct<>>")
        return arr, f"({arr} IS NULL AND {objects} IS NOT NULL)", objects

    def _texts(self, steps) -> str:
        """The elements of an array node as JSON texts."""
        _, text, keys = self._base(steps[:-1])
        keys = [*keys, steps[-1].key]
        return ".".join([_from_json(text, _path_ddl(keys, "array<string>")), *map(V.ident, keys)])

    def read_once(self, text: str, mark: str) -> str:
        """The document between its marks, for texts whose strings are read as they stand (``overflows`` looks at the numbers)."""
        wrapped = f"concat('{{\"d\":[{{\"{self.mark}\":', {mark}, '}},', {text}, ',{{\"{self.mark}\":', {mark}, '}}]}}')"
        ddl = f"struct<d: array<{self.tree.ddl()}>, {_UNREAD}: string>"
        return f"CASE WHEN octet_length({text}) <= {V.PARSER_TEXT_LIMIT} THEN from_json({wrapped}, {V.sql_str(ddl)}, {V.read_strictly(_UNREAD)}) END"

    def no_read(self) -> str:
        return f"CAST(NULL AS struct<d: array<{self.tree.ddl()}>, {_UNREAD}: string>)"

    def taken(self, mark: str) -> str:
        """``read_once`` took one value, an object, and nothing in it was of another kind than declared."""
        element = lambda i: f"get({_ONE}.d, {i})"
        same = lambda i: f"{element(i)}.{V.ident(self.mark)} = CAST({mark} AS STRING)"
        conds = [f"NOT {self.overflows()}", f"{_ONE} IS NOT NULL", f"{_ONE}.{_UNREAD} IS NULL", f"size({_ONE}.d) = 3", same(0), same(2), f"{element(1)} IS NOT NULL"]
        return f"coalesce({' AND '.join(conds)}, false)"

    def _once(self, steps, array: bool = False) -> str:
        """A node of the document that was read once; ``array``: the array itself where its first element is read."""
        node = f"get({_ONE}.d, 1)"
        for i, s in enumerate(steps):
            node += f".{V.ident(s.key)}"
            if s.first and not (array and i == len(steps) - 1):
                node = f"get({node}, 0)"
        return node

    def overflows(self) -> str:
        """A leaf of what was read is a number beyond a double: its text has quotes then, as few strings have."""
        leaves = []
        for g, _, fld, leg in self.spec.payload_leaves():
            if not self._member(g.steps).members[fld].leaf:
                node = self._once(g.steps, array=leg is not None)
                leaves.append(f"{node if leg is None else f'get({node}, {leg})'}.{V.ident(fld)}")
        return f"""coalesce(arrays_overlap(array({', '.join(leaves)}), array('"Infinity"', '"-Infinity"')), false)""" if leaves else "false"

    def fine(self, text: str) -> str:
        """What was taken is as the spec has it: nothing is left to check."""
        conds = [_TAKEN]
        if self.strict:
            for steps in self.first_col:
                arr = self._once(steps, array=True)
                conds.append(f"({arr} IS NULL OR size({arr}) > 0)")
            # a node that is not there may be a null of the text
            there = []
            for n in self.nodes:
                node = self._once(n.steps, array=n.kind == "legs")
                there.append(f"{node} IS NOT NULL")
                if n.kind == "legs":
                    there += [f"(size({node}) <= {i} OR get({node}, {i}) IS NOT NULL)" for i in range(self.legs[n.steps])]
            conds.append(f"(({' AND '.join(there) or 'true'}) OR NOT contains({text}, 'null'))")
        return f"coalesce({' AND '.join(conds)}, false)"

    def first_expr(self, steps) -> str:
        """The first element of an array node."""
        col, member = self.first_col[steps], self._member(steps)
        arr, mixed, objects = self._array(steps)
        element = member.ddl().removeprefix("array<").removesuffix(">")
        again = f"CASE WHEN get({objects}, 0) IS NOT NULL THEN {_from_json(f'get({self._texts(steps)}, 0)', element)} END"
        return f"CASE WHEN {mixed} THEN {again} ELSE get({arr}, 0) END AS {col}"

    def group_exprs(self) -> list[str]:
        out = []
        for (steps, mode), col in self.group_col.items():
            if mode == "legs":
                arr, mixed, objects = self._array(steps)
                element = self._member(steps).ddl().removeprefix("array<").removesuffix(">")
                again = (f"transform(slice({self._texts(steps)}, 1, {self.legs[steps]}), "
                         f"(x, i) -> CASE WHEN get({objects}, i) IS NOT NULL THEN {_from_json('x', element)} END)")
                out.append(f"CASE WHEN {mixed} THEN {again} ELSE {arr} END AS {col}")
            else:
                base, _, keys = self._base(steps)
                out.append(".".join([base, *map(V.ident, keys)]) + f" AS {col}")
        return out

    def leaf_text_exprs(self) -> list[str]:
        """Leaves that are also subtrees: their JSON text, read once more where there is one."""
        out = []
        for (steps, mode), col in self.group_col.items():
            for f, m in self._member(steps).members.items():
                if m.leaf and mode == "object":
                    base, text, keys = self._base(steps)
                    node = ".".join([base, *map(V.ident, [*keys, f])])
                    there = f"CASE WHEN {_FINE} THEN {node} IS NOT NULL ELSE {V.vget(_W, V.vpath(steps, leaf=f), 'variant')} IS NOT NULL END"
                    read = ".".join([_from_json(text, _path_ddl([*keys, f], "string")), *map(V.ident, [*keys, f])])
                    out.append(f"CASE WHEN {there} THEN {read} END AS {self.text_col(steps, f)}")
        return out

    def text_col(self, steps, f: str) -> str:
        return V.ident(f"__t_{self.group_col[(steps, 'object')]}_{f}")

    def _is_object(self, steps) -> str:
        col = self.group_col.get((steps, "object"))
        if col:
            return f"({col} IS NOT NULL)"
        # a descendant group is only there when every node on its path is an
        # object, so a non-NULL one answers without probing this node
        below = [c for (st, _mode), c in self.group_col.items() if len(st) > len(steps) and st[: len(steps)] == steps]
        probe = V.is_object(_W, V.vpath(steps))
        return "(" + " OR ".join([f"{c} IS NOT NULL" for c in below] + [probe]) + ")"

    def checks(self) -> list[tuple[str, str]]:
        checks = [("malformed", V.parsed_ok(_W, V.end_mark(_T))), ("not_object", V.top_is_object(_W))]
        if self.strict:
            for n in self.nodes:
                steps = n.steps
                if n.kind == "object":
                    missing = V.is_missing(_W, V.vpath(steps))
                elif n.kind == "first":
                    # steps end in key[0]: the array itself may be missing
                    missing = V.is_missing(_W, V.vpath(steps[:-1]) + V._quote(steps[-1].key))
                else:
                    arr = self.group_col.get((steps, "legs"))
                    checks.append((f"node:{n.label}", V.legs_ok(_W, V.vpath(steps), self.legs[steps], arr)))
                    continue
                checks.append((f"node:{n.label}", f"(CASE WHEN {self._is_object(steps)} THEN true ELSE {missing} END)"))
        return [(label, f"coalesce({c}, false)") for label, c in checks]

    def keep_condition(self) -> str:
        """The AND of ``checks()``, nested along the node tree: a node's
        descendants are only tested when the node is present (a missing subtree
        costs one probe, not one per node below it)."""
        return f"(CASE WHEN {_FINE} THEN true ELSE {self._kept_by_node()} END)"

    def _kept_by_node(self) -> str:
        base = [c for label, c in self.checks()[:2]]
        if not self.strict:
            return " AND ".join(base)
        children: dict = {}
        for n in self.nodes:
            children.setdefault(n.steps[:-1], []).append(n)

        def subtree(n) -> str:
            steps = n.steps
            if n.kind == "legs":
                arr = self.group_col.get((steps, "legs"))
                own = f"coalesce({V.legs_ok(_W, V.vpath(steps), self.legs[steps], arr)}, false)"
                kids = [subtree(c) for c in children.get(steps, [])]
                return "(" + " AND ".join([own, *kids]) + ")"
            if n.kind == "first":
                missing = V.is_missing(_W, V.vpath(steps[:-1]) + V._quote(steps[-1].key))
            else:
                missing = V.is_missing(_W, V.vpath(steps))
            body = " AND ".join(subtree(c) for c in children.get(steps, [])) or "true"
            return f"(CASE WHEN {self._is_object(steps)} THEN ({body}) WHEN {missing} THEN true ELSE false END)"

        return " AND ".join(base + [subtree(n) for n in children.get((), [])])

    def leaf_exprs(self) -> list[str]:
        out = []
        for g, name, fld, leg in self.spec.payload_leaves():
            col = self.group_col[(g.steps, g.mode)]
            if g.mode == "object" and self._member(g.steps).members[fld].leaf:
                out.append(f"{self.text_col(g.steps, fld)} AS {V.ident(name)}")
                continue
            src = col if leg is None else f"get({col}, {leg})"
            out.append(f"{src}.{V.ident(fld)} AS {V.ident(name)}")
        return out

    def columns(self) -> list[str]:
        texts = [e.rsplit(" AS ", 1)[-1] for e in self.leaf_text_exprs()]
        return [*self.group_col.values(), *texts]

    def build(self, df: DataFrame, payload: str, keys, extra: tuple[str, ...] = (), once: bool = True) -> DataFrame:
        """Keys (+ extra), the parsed document and the group structs.

        ``once``: documents may be read without a Variant, which has its own mind about repeated keys.
        """
        carry = [V.ident(c) for c in [*keys, *[e.rsplit(" AS ", 1)[-1] for e in extra]]]
        out = df.selectExpr(
            *[f"CAST({V.ident(k)} AS STRING) AS {V.ident(k)}" for k in keys],
            *extra,
            f"CAST({V.ident(payload)} AS STRING) AS __given",
        ).selectExpr(*carry, "__given", f"{V.end_mark('__given')} AS {_MARK}"
        ).selectExpr(*carry, "__given", _MARK, f"{self.read_once('__given', _MARK) if once else self.no_read()} AS {_ONE}"
        ).selectExpr(*carry, "__given", _ONE, f"{self.taken(_MARK)} AS {_TAKEN}"
        ).selectExpr(*carry, "__given", _ONE, _TAKEN, f"{self.fine('__given')} AS {_FINE}"
        ).selectExpr(*carry, "__given", _ONE, _TAKEN, _FINE, f"NOT {_TAKEN} AND {V.rare_text('__given')} AS __rare"
        ).selectExpr(*carry, _ONE, _TAKEN, _FINE, "__rare", f"{V.finite_text('__given', '__rare')} AS {_T}"
        ).selectExpr(*carry, _ONE, _TAKEN, _FINE, _T, f"CASE WHEN NOT {_FINE} THEN {V.parse_strict(_T, self.key_length, '__rare')} END AS {_W}"
        ).selectExpr(*carry, _FINE, _T, _W, f"CASE WHEN {_TAKEN} THEN get({_ONE}.d, 1) WHEN {_W} IS NOT NULL AND {V.parsed_ok(_W, V.end_mark(_T))} THEN {_from_json(_T, self.tree.ddl())} END AS {_V}")
        firsts: list[str] = []
        for steps in self.first_col:  # outer before inner
            out = out.selectExpr(*carry, _FINE, _T, _W, _V, *firsts, self.first_expr(steps))
            firsts.append(self.first_col[steps])
        return out.selectExpr(*carry, _FINE, _T, _W, *self.group_exprs(), *self.leaf_text_exprs())


def too_large_action(how: str) -> str:
    """SQL of the row filter for a payload that may be beyond the size of a Variant."""
    if how == "drop":
        return "CAST(NULL AS ARRAY<BOOLEAN>)"
    if how != "error":
        raise ValueError("too_large is 'error' or 'drop'")
    return "CAST(raise_error('a payload is malformed or has over 100,000,000 bytes beside its long strings, which is beyond the limits of a Variant; too_large=\"drop\" leaves it out') AS ARRAY<BOOLEAN>)"


def flatten_json(
    df: DataFrame,
    payload: str,
    spec: FlattenSpec,
    *,
    keys: tuple[str, ...] | None = None,
    strict: bool = True,
    duplicate_keys: str = "last",
    too_large: str = "error",
) -> DataFrame:
    """Flatten JSON text in column ``payload`` per ``spec``.

    Output: ``spec.columns()`` (payload leaves in spec order, then ``keys``,
    then the spec's constant-NULL columns), all strings.

    Rows are dropped when the payload is NULL, not exactly one JSON value, or
    not an object. With ``strict=True`` (default) a row is also dropped when
    any intermediate node on a spec path is present but of the wrong kind
    (explicit null, scalar, array where an object is read, empty array where
    a first element is read, ...); a *missing* node only yields NULL leaves.
    ``strict=False`` turns those wrong-kind nodes into NULL leaves instead.

    ``NaN``, ``Infinity`` and ``-Infinity`` are numbers, as are numbers that overflow a
    double: their leaf text is the literal's (inside a nested leaf, a JSON string).
    Strings and numbers may have any length. Only a document with over 100,000,000 bytes
    beside its long strings may be beyond the size of a Variant; it cannot be told from a
    malformed one then, and stops the job with an error that says so, or is dropped
    with ``too_large="drop"`` (``json_rejects`` labels it ``too_large``).
    """
    keys = tuple(spec.key_columns if keys is None else keys)
    plan = _Plan(spec, strict)
    with duplicate_keys_last(df.sparkSession, duplicate_keys == "last"):
        cols = plan.build(df.where(f"{V.ident(payload)} IS NOT NULL"), payload, keys, once=duplicate_keys == "last")
    ok = plan.keep_condition()
    keep = f"CASE WHEN {V.maybe_too_large(_T, _W, plan.key_length)} THEN {too_large_action(too_large)} WHEN {ok} THEN array(true) END"
    kept = cols.selectExpr(*[V.ident(k) for k in keys], *plan.columns(), f"explode({keep}) AS __keep")
    payload_cols = set(spec.payload_columns())
    return kept.selectExpr(
        *plan.leaf_exprs(),
        *[V.ident(k) for k in keys if k not in payload_cols],
        *[f"CAST(NULL AS STRING) AS {V.ident(c)}" for c in spec.null_columns],
    )


def json_rejects(
    df: DataFrame,
    payload: str,
    spec: FlattenSpec,
    *,
    keys: tuple[str, ...] | None = None,
    strict: bool = True,
    duplicate_keys: str = "last",
) -> DataFrame:
    """Rows ``flatten_json`` drops: keys, the payload text and the first failed check."""
    keys = tuple(spec.key_columns if keys is None else keys)
    plan = _Plan(spec, strict)
    with duplicate_keys_last(df.sparkSession, duplicate_keys == "last"):
        cols = plan.build(df, payload, keys, extra=(f"CAST({V.ident(payload)} AS STRING) AS payload",), once=duplicate_keys == "last")
    whens = " ".join(f"WHEN NOT {c} THEN '{label}'" for label, c in plan.checks())
    reason = f"CASE WHEN payload IS NULL THEN 'null_payload' WHEN {_FINE} THEN NULL WHEN {V.maybe_too_large(_T, _W, plan.key_length)} THEN 'too_large' {whens} END"
    # explode instead of a filter, so the document is parsed once (see module doc)
    tagged = cols.selectExpr(*[V.ident(k) for k in keys], "payload", f"{reason} AS __reason")
    return tagged.selectExpr(
        *[V.ident(k) for k in keys],
        "payload",
        "explode(CASE WHEN __reason IS NOT NULL THEN array(__reason) END) AS reject_reason",
    )


def json_outcomes(
    df: DataFrame,
    payload: str,
    spec: FlattenSpec,
    *,
    keys: tuple[str, ...] | None = None,
    strict: bool = True,
    duplicate_keys: str = "last",
) -> DataFrame:
    """Every row of ``df`` with its outcome, from one parse: the columns of ``flatten_json``, then
    ``payload`` and ``reject_reason`` as in ``json_rejects``, both NULL for the rows that are kept.

    ``unfurl.sinks.outcomes.write_outcomes`` splits it into the two tables.
    """
    keys = tuple(spec.key_columns if keys is None else keys)
    plan = _Plan(spec, strict)
    with duplicate_keys_last(df.sparkSession, duplicate_keys == "last"):
        cols = plan.build(df, payload, keys, extra=(f"CAST({V.ident(payload)} AS STRING) AS __payload",), once=duplicate_keys == "last")
    whens = " ".join(f"WHEN NOT {c} THEN '{label}'" for label, c in plan.checks())
    # kept rows answer by the nested condition; only others look for the first failed check
    reason = (f"CASE WHEN __payload IS NULL THEN 'null_payload' WHEN {V.maybe_too_large(_T, _W, plan.key_length)} THEN 'too_large' "
              f"WHEN {plan.keep_condition()} THEN NULL ELSE CASE {whens} END END")
    tagged = cols.selectExpr(*[V.ident(k) for k in keys], "__payload", *plan.columns(), f"{reason} AS reject_reason")
    payload_cols = set(spec.payload_columns())
    leaf = lambda e: "CASE WHEN reject_reason IS NULL THEN {} END AS {}".format(*e.rsplit(" AS ", 1))
    return tagged.selectExpr(
        *map(leaf, plan.leaf_exprs()),
        *[V.ident(k) for k in keys if k not in payload_cols],
        *[f"CAST(NULL AS STRING) AS {V.ident(c)}" for c in spec.null_columns],
        "CASE WHEN reject_reason IS NOT NULL THEN __payload END AS payload",
        "reject_reason",
    )
