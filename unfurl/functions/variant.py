"""SQL expression builders over Spark's Variant type for document flattening.

Everything here is text of built-in Spark SQL expressions (``try_parse_json``,
``try_variant_get``), handed to ``selectExpr`` in one call: a 400-column
flatten is analysed in a fraction of a second, and it runs inside the JVM
with no Python worker on the row path.

The parsed document is kept as element 0 of a Variant *array* ``w`` (the text
is parsed as ``[ text , mark ]``): trailing garbage such as ``{"a":1} x``,
``{"a":1}{"b":2}`` or ``{"a":1}] x``, which a bare ``try_parse_json`` accepts,
fails the parse or displaces the mark. The document itself is then ``w[0]``, and every
path below starts with ``$[0]``, so no sub-document is ever copied.

Node tests, none of which copies the node:

* object: ``try_variant_get(w, p, 'struct<>') IS NOT NULL``
* array: ``try_variant_get(w, p, 'array<struct<>>')`` is NULL unless the node
  is an array; its element ``i`` is NULL unless that element is an object
* missing: ``try_variant_get(w, p, 'variant') IS NULL``, evaluated only after
  the object test failed, i.e. only on rows that are already suspicious.
"""

from __future__ import annotations

from ..plans.spec import Step


def _quote(key: str) -> str:
    if "'" in key or "\\" in key:
        raise ValueError(f"key with a quote or backslash is not supported in a path: {key!r}")
    return f"['{key}']"


def quoted_key(key: str) -> str:
    """A key as a step of a Variant path."""
    return _quote(key)


def vpath(steps: tuple[Step, ...], *, leaf: str | None = None, index: int | None = None, root: str = "$[0]") -> str:
    """Variant path below the wrapper array: ``$[0]['a']['b'][0]...``."""
    out = root
    for s in steps:
        out += _quote(s.key)
        if s.first:
            out += "[0]"
    if index is not None:
        out += f"[{index}]"
    if leaf is not None:
        out += _quote(leaf)
    return out


def sql_str(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def vget(w: str, path: str, dtype: str) -> str:
    return f"try_variant_get({ident(w)}, {sql_str(path)}, '{dtype}')"


def end_mark(text_expr: str) -> str:
    """A number that a text cannot name in itself."""
    return f"xxhash64({text_expr})"


_BODY = r'(?:[^"\\\x00-\x1F]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+'  # of a well-formed string literal
# A text in pieces that join to it again: whole string literals, numbers, and what lies between.
_PIECES = rf'(?s)"{_BODY}"|-?[0-9][0-9.eE+-]*+|[^"0-9-]++|.'
# What stands before a non-finite literal outside strings, and the literal, if it is no key.
_LITERAL = rf'\G((?:[^"NI-]++|"{_BODY}"|-(?!Infinity))*+)(NaN|-?Infinity)(?![ \t\n\r]*+:)'
# Texts that may hold a non-finite literal, or a number that is no finite double or too long for the parsers.
_RARE = r"[0-9](?:[eE][+]?[0-9]{3}|[0-9]{299})"
_FLOAT = r"^-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][+-]?[0-9]+)?$"
_INTEGER = r"^-?(0|[1-9][0-9]*)$"


def rare_text(text: str) -> str:
    """The text may need what few texts need: a look at its single literals."""
    return f"(contains({text}, 'NaN') OR contains({text}, 'Infinity') OR {text} RLIKE {sql_str(_RARE)})"


def finite_text(text: str, rare: str | None = None) -> str:
    """The text with the literals ``NaN``, ``Infinity`` and ``-Infinity`` as strings of that name, and
    numbers that overflow a double likewise: what a lenient reader takes as numbers without digits. Long
    fractions are cut to the double they are. Other texts (all but few) are taken as they are.

    Inside strings nothing is changed, and a literal used as a key stays as it is (malformed).
    ``rare`` is ``rare_text``, here and below, where a plan has it as a column.
    """
    is_float = f"x RLIKE {sql_str(_FLOAT)} AND NOT x RLIKE {sql_str(_INTEGER)}"
    piece = (f"CASE WHEN NOT ({is_float}) THEN x "
             "WHEN abs(try_cast(x AS DOUBLE)) = double('infinity') THEN CASE WHEN startswith(x, '-') THEN '\"-Infinity\"' ELSE '\"Infinity\"' END "
             "WHEN length(x) > 300 THEN CAST(try_cast(x AS DOUBLE) AS STRING) ELSE x END")
    named = f"CASE WHEN contains({text}, 'NaN') OR contains({text}, 'Infinity') THEN regexp_replace({text}, {sql_str(_LITERAL)}, '$1\"$2\"') ELSE {text} END"
    numbers = f"array_join(transform(regexp_extract_all({named}, {sql_str(_PIECES)}, 0), x -> {piece}), '')"
    return f"CASE WHEN NOT {rare or rare_text(text)} THEN {text} WHEN {text} RLIKE {sql_str(_RARE)} THEN {numbers} ELSE {named} END"


# The Variant parser reads no string of more than 20,000,000 characters and no number of more than 1,000.
PARSER_TEXT_LIMIT = 20_000_000
PARSER_NUMBER_LIMIT = 1_000
# Integers of more digits are no numbers to the readers whose results this library repeats.
INTEGER_DIGITS = 4_300
# ``from_json`` has options for its limits.
READ_ALL = "map('maxStringLen', '2147483647', 'maxNumLen', '2147483647')"


def read_strictly(unread: str) -> str:
    """Options with which ``from_json`` reads what the Variant parser reads, and no number of 300 digits; column
    ``unread`` then holds the texts that are malformed or not of the declared kinds."""
    return f"map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false', 'maxStringLen', '2147483647', 'maxNumLen', '299', 'columnNameOfCorruptRecord', {sql_str(unread)})"


def read_members(text: str) -> str:
    """The members of an object, as texts, between two marks (see ``only_member``)."""
    mark = f"concat('{{\"mark\":', {end_mark(text)}, '}}')"
    ddl = "struct<d: array<map<string, string>>, unread: string>"
    return f"CASE WHEN octet_length({text}) <= {PARSER_TEXT_LIMIT} THEN from_json(concat('{{\"d\":[', {mark}, ',', {text}, ',', {mark}, ']}}'), {sql_str(ddl)}, {read_strictly('unread')}) END"


def only_member(text: str, key: str, read: str | None = None) -> str:
    """The string under ``key`` of a text that is an object of this member alone, else NULL: what most documents
    with one string are. ``read`` is ``read_members``, where a plan has it as a column: the text is one value if both
    marks are in their places."""
    read = read or f"({read_members(text)})"
    space = r"[ \t\n\r]*+"
    starts = rf'\A{space}\{{{space}"{key}"{space}:{space}"'
    same = lambda i: f"get({read}.d, {i})['mark'] = CAST({end_mark(text)} AS STRING)"
    conds = [f"{read}.unread IS NULL", f"size({read}.d) = 3", f"size(get({read}.d, 1)) = 1", same(0), same(2), f"{text} RLIKE {sql_str(starts)}"]
    return f"CASE WHEN {' AND '.join(conds)} THEN get({read}.d, 1)[{sql_str(key)}] END"


def is_long(text: str, rare: str | None = None) -> str:
    """The text may hold a string or a number beyond the limits of the Variant parser."""
    return f"(octet_length({text}) > {PARSER_TEXT_LIMIT} OR (octet_length({text}) > {PARSER_NUMBER_LIMIT} AND {rare or rare_text(text)} AND {text} RLIKE '[0-9]{{{PARSER_NUMBER_LIMIT}}}'))"


def skeleton(text: str, keep: int = 64, rare: str | None = None) -> str:
    """The text with its long strings cut and its long numbers replaced by 0, where the Variant parser could
    not read it as it is: the same nodes, of the same kinds, under the same keys of up to ``keep`` characters.

    Only well-formed literals are changed, so a malformed text stays one.
    """
    unit = r'(?:[^"\\\x00-\x1F]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))'
    cut = f"regexp_replace({text}, {sql_str(rf'("{unit}{{0,{keep + 1}}}+){_BODY}"')}, '$1\"')"
    number = rf"(?<![0-9.eE+])[1-9][0-9]{{{PARSER_NUMBER_LIMIT - 1},{INTEGER_DIGITS - 1}}}+(?![0-9.eE])"
    return f"CASE WHEN {is_long(text, rare)} THEN regexp_replace({cut}, {sql_str(number)}, '0') ELSE {text} END"


def parse_strict(text: str, keep: int = 64, rare: str | None = None) -> str:
    """Variant array of the document (its ``skeleton``) and its end mark, NULL on malformed text.

    The mark stands behind the text: a stray ``]`` closes the array before it,
    a second value comes between. So the text is one value exactly if the mark
    is element 1 and there is no element 2.
    """
    return f"try_parse_json(concat('[', {skeleton(text, keep, rare)}, ',', {end_mark(text)}, ']'))"


def parsed_ok(w: str, mark: str) -> str:
    """Exactly one JSON value (of any kind); ``mark`` is the text's end mark."""
    return (
        f"({ident(w)} IS NOT NULL AND coalesce({vget(w, '$[1]', 'bigint')} = {mark}, false) "
        f"AND {vget(w, '$[2]', 'variant')} IS NULL)"
    )


# A Variant holds 128 MB; a text whose skeleton is shorter than this always fits.
VARIANT_LIMIT = 100_000_000


def maybe_too_large(text: str, w: str, keep: int = 64, rare: str | None = None) -> str:
    """The text was not parsed, and even its skeleton may be beyond the size of a Variant."""
    return f"({ident(w)} IS NULL AND octet_length({text}) > {VARIANT_LIMIT} AND octet_length({skeleton(text, keep, rare)}) > {VARIANT_LIMIT})"


def top_is_object(w: str) -> str:
    """The single value is an object."""
    return f"({vget(w, '$[0]', 'struct<>')} IS NOT NULL)"


def is_object(w: str, path: str) -> str:
    return f"({vget(w, path, 'struct<>')} IS NOT NULL)"


def is_missing(w: str, path: str) -> str:
    return f"({vget(w, path, 'variant')} IS NULL)"


def is_string(w: str, path: str) -> str:
    return f"(schema_of_variant({vget(w, path, 'variant')}) = 'STRING')"


def legs_ok(w: str, path: str, legs: int, arr: str | None = None) -> str:
    """Leg array usable for slots ``0..legs-1``.

    Fine: missing, an empty object, an empty string, or an array whose first
    ``legs`` elements are each absent or an object. Anything else (null,
    number, bool, non-empty string or object, non-object element) fails.
    """
    # ``arr``: the node cast to an array of structs, when the caller has one
    arr = arr or vget(w, path, "array<struct<>>")
    slots = " AND ".join(f"(size({arr}) <= {i} OR get({arr}, {i}) IS NOT NULL)" for i in range(legs))
    text = vget(w, path, "string")
    return (
        f"(CASE WHEN {arr} IS NOT NULL THEN ({slots}) "
        f"WHEN {is_missing(w, path)} THEN true "
        f"WHEN {is_object(w, path)} THEN {text} = '{{}}' "
        f"ELSE coalesce({text} = '', false) END)"
    )
