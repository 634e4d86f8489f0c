"""Sources: key-value table exports and catalog tables.

A table export is a set of JSON-lines files (optionally gzip), one item per
line, every attribute wrapped in a type tag::

    {"Item": {"pk": {"S": "p1"}, "n": {"N": "5"}, "ok": {"BOOL": true}, "x": {"NULL": true}}}

``unnest_typed`` removes the tags with built-in Variant expressions; files
are split across tasks by Spark's file source, nothing passes the driver.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..functions.variant import end_mark, ident, parse_strict, parsed_ok, quoted_key, sql_str
from ..sinks.versions import current_version

# public export format: tags of scalars (binary is base64 text), of sets, and of nested values
TEXT_TAGS, BARE_TAGS = ("S", "B"), ("N", "BOOL")
TEXT_SETS, NUMBER_SETS = ("SS", "BS"), ("NS",)
#: Attribute names are columns of the result; more in one export are an error.
MAX_ATTRIBUTES = 10_000


def _quoted(text: str) -> str:
    """A JSON string: that of an array of one text without its brackets."""
    return f"transform(array(to_json(array({text}))), j -> substring(j, 2, length(j) - 2))[0]"


def _tags(*names: str) -> str:
    return "(" + ", ".join(sql_str(n) for n in names) + ")"


def _entries(node: str) -> str:
    """A tagged value as a map of its one tag to the content."""
    return f"try_variant_get({node}, '$', 'map<string,variant>')"


def _untagged_json(node: str, entries: str, depth: int, nested: bool = True) -> str:
    """JSON text of a tagged value without its tags: maps are objects, lists and sets arrays,
    numbers and flags bare, text and binary quoted. ``depth``: levels of maps and lists inside it.

    ``entries`` is the node's ``_entries``, read once for all of its tags. Not ``nested``:
    the value of an attribute, whose scalars are text and whose NULL is one. Each level is one lambda over
    the members of a map, or the elements of a list, which have no key.
    """
    tag, content = f"map_keys({entries})[0]", f"map_values({entries})[0]"
    text, texts = f"try_variant_get({content}, '$', 'string')", f"try_variant_get({content}, '$', 'array<string>')"
    cases = [
        f"WHEN size({entries}) <> 1 OR {entries} IS NULL THEN to_json({node})",  # no tagged value: it stays as it is
        f"WHEN {tag} IN {_tags(*TEXT_TAGS)} THEN {_quoted(text) if nested else text}",
        f"WHEN {tag} IN {_tags(*BARE_TAGS)} THEN {text}",
        f"WHEN {tag} = 'NULL' THEN {'\'null\'' if nested else 'NULL'}",
        f"WHEN {tag} IN {_tags(*TEXT_SETS)} THEN to_json({texts})",
        f"WHEN {tag} IN {_tags(*NUMBER_SETS)} THEN concat('[', array_join({texts}, ','), ']')",
    ]
    if depth:
        e = f"e{depth}"
        members = (f"CASE {tag} WHEN 'M' THEN transform(map_entries({_entries(content)}), y -> struct(y.key AS k, y.value AS v, {_entries('y.value')} AS m)) "
                   f"ELSE transform(try_variant_get({content}, '$', 'array<variant>'), y -> struct(CAST(NULL AS STRING) AS k, y AS v, {_entries('y')} AS m)) END")
        member = f"concat(CASE WHEN {e}.k IS NULL THEN '' ELSE concat({_quoted(f'{e}.k')}, ':') END, {_untagged_json(f'{e}.v', f'{e}.m', depth - 1)})"
        cases.append(f"WHEN {tag} IN ('M', 'L') THEN concat(CASE {tag} WHEN 'M' THEN '{{' ELSE '[' END, array_join(transform({members}, {e} -> {member}), ','), CASE {tag} WHEN 'M' THEN '}}' ELSE ']' END)")
    return f"CASE {' '.join(cases)} ELSE to_json({node}) END"


@contextlib.contextmanager
def _deep_plans(spark: SparkSession, depth: int):
    """Let the analyzer take as many rounds as nested lambdas need, while a plan is built."""
    name = "spark.sql.analyzer.maxIterations"
    old = spark.conf.get(name, "100")
    spark.conf.set(name, str(max(int(old), 20 * depth)))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def _nesting(line: str) -> str:
    """Levels of maps and lists inside the attributes of an item: half of the brackets open at once, beside those of
    the line, the item and an attribute's tag. Strings do not count."""
    strings, others = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', r"[^\[\]{}]+"
    brackets = f"regexp_replace(regexp_replace({line}, {sql_str(strings)}, ''), {sql_str(others)}, '')"
    deepest = (f"aggregate(split({brackets}, ''), named_struct('d', 0, 'm', 0), (s, c) -> named_struct('d', s.d + CASE WHEN c IN ('{{', '[') THEN 1 WHEN c = '' THEN 0 ELSE -1 END, "
               "'m', greatest(s.m, s.d + CASE WHEN c IN ('{', '[') THEN 1 WHEN c = '' THEN 0 ELSE -1 END)), s -> s.m)")
    return f"CASE WHEN {line} RLIKE {sql_str('\"[ML]\"')} THEN CAST(ceil(greatest({deepest} - 3, 0) / 2) AS INT) ELSE 0 END"


def _parsed_items(df: DataFrame, value_col: str, item_key: str, keep: Iterable[str]) -> DataFrame:
    """``keep``, ``__line`` and ``__attrs``: the item's attributes, NULL for a malformed line."""
    keep = [ident(k) for k in keep]
    parsed = df.selectExpr(*keep, f"{ident(value_col)} AS __line", f"{parse_strict(ident(value_col))} AS __item")
    ok = parsed_ok("__item", end_mark("__line"))
    return parsed.selectExpr(*keep, "__line", f"CASE WHEN {ok} THEN try_variant_get(__item, {sql_str('$[0]' + quoted_key(item_key))}, 'map<string,variant>') END AS __attrs")


def export_attributes(df: DataFrame, value_col: str, *, item_key: str = "Item") -> list[str]:
    """Names of all attributes in the items, sorted: a distributed distinct over the keys.

    The names are the columns of the result, so they are few by nature; over ``MAX_ATTRIBUTES`` are an error.
    """
    return _shape(df, value_col, item_key, True)[0]


def _shape(df: DataFrame, value_col: str, item_key: str, named: bool) -> tuple[list[str], int]:
    """The attribute names (if asked for) and the deepest nesting, in one pass."""
    items = _parsed_items(df, value_col, item_key, ())
    if not named:
        return [], items.where("__attrs IS NOT NULL").selectExpr(f"max({_nesting('__line')})").collect()[0][0] or 0
    keys = items.selectExpr(f"{_nesting('__line')} AS d", "map_keys(__attrs) AS k").selectExpr("d", "explode(k) AS k").groupBy("k").agg({"d": "max"})
    rows = keys.limit(MAX_ATTRIBUTES + 1).collect()
    if len(rows) > MAX_ATTRIBUTES:
        raise ValueError(f"the items have over {MAX_ATTRIBUTES} different attributes; name those to read")
    return sorted(r[0] for r in rows), max((r[1] for r in rows), default=0)


def unnest_typed(df: DataFrame, value_col: str, attributes: Iterable[str] | None = None, *, item_key: str = "Item",
                 keep: Iterable[str] = (), depth: int | None = None) -> DataFrame:
    """One string column per attribute of type-tagged JSON items in ``value_col``
    (``attributes=None``: every attribute that any item has, found by a first pass).

    ``S``/``N``/``BOOL``/``B`` give their value as text, ``NULL`` (or a missing
    attribute) gives NULL, ``M``, ``L`` and sets the JSON text of their content with the tags
    inside taken off, at any depth: the deepest nesting is found by the same pass (``depth``: where it
    is known, levels of maps and lists inside an attribute; deeper ones then keep their tags). An object that
    is no tagged value stays as it is. Lines
    that are not one JSON object with ``item_key`` are left out; ``export_rejects`` has them.
    """
    keep = list(keep)
    if attributes is None or depth is None:
        found, deepest = _shape(df, value_col, item_key, attributes is None)
        attributes, depth = found if attributes is None else attributes, deepest if depth is None else depth
    items = _parsed_items(df, value_col, item_key, keep)
    names = list(attributes)
    # explode instead of a filter, so the line is parsed once
    kept = items.selectExpr(*[ident(k) for k in keep], "explode(CASE WHEN __attrs IS NOT NULL THEN array(__attrs) END) AS __attrs")
    carry = [ident(k) for k in keep]
    nodes = kept.selectExpr(*carry, *[f"try_element_at(__attrs, {sql_str(a)}) AS __a{i}" for i, a in enumerate(names)])
    tagged = nodes.selectExpr(*carry, *[x for i in range(len(names)) for x in (f"__a{i}", f"{_entries(f'__a{i}')} AS __m{i}")])
    with _deep_plans(df.sparkSession, depth):
        return tagged.selectExpr(*carry, *[f"CASE WHEN __a{i} IS NOT NULL THEN {_untagged_json(f'__a{i}', f'__m{i}', depth, nested=False)} END AS {ident(a)}" for i, a in enumerate(names)])


def export_rejects(df: DataFrame, value_col: str, *, item_key: str = "Item", keep: Iterable[str] = ()) -> DataFrame:
    """The lines ``unnest_typed`` leaves out (blank lines are no items and are not listed)."""
    keep = list(keep)
    items = _parsed_items(df, value_col, item_key, keep)
    bad = "explode(CASE WHEN __attrs IS NULL AND trim(__line) <> '' THEN array(__line) END) AS line"
    return items.selectExpr(*[ident(k) for k in keep], bad)


def export_lines(spark: SparkSession, path: str, *, recursive: bool = False, file_glob: str | None = None) -> DataFrame:
    """The raw lines of an export folder (column ``value``; ``.gz`` read transparently)."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.text(path)


def read_export(spark: SparkSession, path: str, attributes: Iterable[str] | None = None, *, item_key: str = "Item",
                recursive: bool = False, file_glob: str | None = None, depth: int | None = None) -> DataFrame:
    """Scan an export folder (JSON lines) and unnest ``attributes``, by default all.

    ``recursive`` reads data files in nested folders; ``file_glob`` (e.g.
    ``"*.json.gz"``) keeps manifest or marker files next to them out of the scan.
    """
    return unnest_typed(export_lines(spark, path, recursive=recursive, file_glob=file_glob), "value", attributes, item_key=item_key, depth=depth)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a file table by path (``/``, ``:`` in the name): the committed
    version of a table that ``replace_table`` writes, or else the files there."""
    if "/" in name_or_path or ":" in name_or_path:
        version = current_version(spark, name_or_path) if fmt == "parquet" else None
        return spark.read.format(fmt).load(version or name_or_path)
    return spark.table(name_or_path)
