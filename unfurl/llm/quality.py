"""Quality rules by distribution divergence (DataFrame operations only).

Two histograms of a document are compared with a reference for each language:

* character classes: small and capital ASCII letters, digits, white space,
  symbols ``#*$%&|<>``, other ASCII marks, everything else;
* common words: how often each of the language's ``COMMON`` most frequent words
  occurs, and all other words together.

The distance is Jensen-Shannon (the square root of the divergence in bits, 0 to
1). A document's distance is that to the nearest language, so a wrong label or a
text in several languages does not count against it. A distance counts only for
texts long enough to have a stable histogram (``MIN_CHARS``, ``MIN_WORDS``). A
document is kept if it passes the base rules and neither distance is above its
limit.

The references come from all documents with a language: a frequent-items
aggregate over every word names candidates for each language's common words, which
are then counted; their shares and those of the classes are exact sums over the
measured documents. All of these send few small rows per language and task. What reaches the driver is bounded by
``MAX_LANGS`` languages times ``CANDIDATES`` words and the classes, checked. Texts are
read three times and never shuffled; the measures are written once to the shared folder.

Defined cases: a NULL or empty text has no words and fails the base rules; with no
labelled document there is no reference and only the base rules decide; a
repeated row is judged like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, stored, with_columns_aside, words

COMMON = 12
CANDIDATES, SKETCH_ITEMS = 4 * COMMON, 16384
MAX_LANGS = 256
MIN_CHARS, MIN_WORDS = 200, 50
#: Limits of the two distances: nearly all documents that labels call good
#: are nearer, nearly all that they call bad and the base rules pass are not (0 of 3,243 and 291 of 291 go at 10,000 documents).
MAX_CHAR_JS, MAX_WORD_JS = 0.28, 0.3
#: Base rules.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

#: Patterns of the classes, removed from a text without white space one after the
#: other; what is left is the last class.
CLASSES = (
    ("lower", "[a-z]+"),
    ("other", "[^\\x00-\\x7F]+"),
    ("upper", "[A-Z]+"),
    ("digit", "[0-9]+"),
    ("symbol", "[#*$%&|<>]+"),
)
#: Bits of a packed window that hold its position.
_PLACE_BITS = 20
_PLACE = (1 << _PLACE_BITS) - 1
NAMES = ["space", *(n for n, _ in CLASSES), "mark"]


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in ``w``.

    Windows are compared by 64-bit hashes. Only if some are equal are they sorted
    with their positions; equal neighbours give the repeated positions, each of
    which covers up to three words.
    """
    def windows(x: Column) -> Column:
        h = F.transform(x, lambda a, i: F.xxhash64(a, F.get(x, i + 1), F.get(x, i + 2)))
        return F.slice(h, 1, F.size(x) - 2)

    def starts(h: Column) -> Column:  # positions of repeated windows, ascending
        # sorted by the upper bits of the hash with the position in the lower ones; windows
        # with equal upper bits are neighbours and are compared by their whole hashes
        packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long"))))
        place = lambda x: x.bitwiseAND(F.lit(_PLACE)).cast("int")
        top = lambda x: F.shiftrightunsigned(x, _PLACE_BITS)

        def same(s: Column, x: Column, k: Column, step: int) -> Column:
            y = F.get(s, k + step)
            return F.coalesce((top(y) == top(x)) & (F.get(h, place(y)) == F.get(h, place(x))), F.lit(False))

        def hit(s: Column) -> Column:
            alike = lambda x, k: F.coalesce(top(F.get(s, k + 1)) == top(x), F.lit(False)) | F.coalesce(top(F.get(s, k - 1)) == top(x), F.lit(False))
            near = lambda x, k: alike(x, k) & (same(s, x, k, -1) | same(s, x, k, 1) | same(s, x, k, -2) | same(s, x, k, 2))
            return F.sort_array(F.transform(F.filter(s, near), place))

        return let(packed, hit)

    def starts_of_very_long(h: Column) -> Column:  # the same with positions beyond the lower bits
        def hit(s: Column) -> Column:
            same = lambda x, k, step: F.coalesce(F.get(s, k + step)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x, k, -1) | same(x, k, 1)), lambda x: x["i"]))

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), hit)

    def covered(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def count(h: Column) -> Column:
        found = F.when(F.size(h) <= _PLACE, starts(h)).otherwise(starts_of_very_long(h))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(found, covered)).otherwise(0)

    return F.when(F.size(w) >= 4, let(w, lambda x: let(windows(x), count))).otherwise(0).cast("long")


def features(docs: DataFrame, carry: list[str], vocabulary: list[str]) -> DataFrame:
    """``carry``, the base columns, code points by class (``__c_<class>``) and
    ``__hits``: how often each word of ``vocabulary`` occurs."""
    own = [docs[c] for c in carry]
    names = list(carry)
    out = docs.select(*own, F.col("text").alias("__text"), words(F.col("text")).alias("__words"))
    out = out.select(*names, "__text", "__words", F.array_join("__words", "").alias("__left"))
    out = out.select(
        *names,
        F.size("__words").cast("long").alias("__n_words"),
        F.coalesce(F.length("__text"), F.lit(0)).cast("long").alias("__chars"),
        F.length("__left").cast("long").alias("__word_chars"),
        n_dup_lines(F.col("__text")).alias("__n_dup_lines"),
        n_repeat_words(F.col("__words")).alias("__n_repeat_words"),
        (F.filter("__words", lambda x: x.isin(vocabulary)) if vocabulary else F.array().cast("array<string>")).alias("__common"),
        "__left",
    )
    names = [c for c in out.columns if c != "__left"]
    for name, pattern in CLASSES:
        out = out.select(*names, F.length("__left").alias("__had"), F.regexp_replace("__left", pattern, "").alias("__left"))
        out = out.select(*names, (F.col("__had") - F.length("__left")).cast("long").alias(f"__c_{name}"), "__left")
        names.append(f"__c_{name}")
    hits = let(F.col("__common"), lambda k: F.array(
        *[F.size(k) - F.size(F.array_remove(k, v)) for v in vocabulary]).cast("array<long>"))
    return out.select(
        *[c for c in names if c != "__common"],
        F.length("__left").cast("long").alias("__c_mark"),
        (F.col("__chars") - F.col("__word_chars")).alias("__c_space"),
        hits.alias("__hits"),
    )


def common_words(docs: DataFrame) -> dict[str, list[str]]:
    """The ``COMMON`` most frequent words of each language in ``docs`` (of equals, the first by
    code point). A frequent-items sketch over every word names ``CANDIDATES`` for each
    language, its error being far below the share of a common word; a second pass
    counts those exactly."""
    known = docs.where("lang IS NOT NULL").select("lang", words(F.col("text")).alias("w"))
    top = known.select("lang", F.explode("w").alias("w")).groupBy("lang").agg(F.expr(f"approx_top_k(w, {CANDIDATES}, {SKETCH_ITEMS})").alias("top"))
    found = top.limit(MAX_LANGS + 1).collect()
    if len(found) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    names = sorted({x.item for r in found for x in r.top})
    if not names:
        return {}
    hits = known.select("lang", F.explode(F.filter("w", lambda x: x.isin(names))).alias("w"))
    out: dict[str, list[str]] = {}
    for r in sorted(hits.groupBy("lang", "w").count().collect(), key=lambda r: (-r["count"], r.w)):  # languages x candidates
        if len(out.setdefault(r.lang, [])) < COMMON:
            out[r.lang].append(r.w)
    return {lang: sorted(ws) for lang, ws in sorted(out.items())}


def references(measured: DataFrame, common: dict[str, list[str]], vocabulary: list[str]) -> list[tuple[list[float], list[float]]]:
    """For each language the shares of the classes, and those of all words of
    ``vocabulary`` (0 for other languages' words) and the rest: exact sums over all
    measured documents of the language."""
    sums = measured.where("lang IS NOT NULL").groupBy("lang").agg(
        F.sum("__n_words").alias("n"),
        *[F.sum(f"__c_{c}").alias(c) for c in NAMES],
        *[F.sum(F.get("__hits", F.lit(i))).alias(f"w{i}") for i in range(len(vocabulary))],
    ).collect()
    out = []
    for r in sorted(sums, key=lambda r: r.lang):
        total = sum(r[c] for c in NAMES)
        if total and r["n"] and r["lang"] in common:
            shares = [r[f"w{i}"] / r["n"] if w in common[r["lang"]] else 0.0 for i, w in enumerate(vocabulary)]
            out.append(([r[c] / total for c in NAMES], [*shares, 1.0 - sum(shares)]))
    return out


def js_distance(shares: Column, ref: list[float]) -> Column:
    """Jensen-Shannon distance of the array ``shares`` to the shares ``ref``."""
    def part(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

    parts = F.zip_with(shares, F.array(*[F.lit(float(q)) for q in ref]), part)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) / 2, F.lit(0.0)))


def judged(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` (with ``lang``), the base columns, both distances, ``__base_failed`` and ``__kept``."""
    common = common_words(docs)
    vocabulary = sorted({w for ws in common.values() for w in ws})
    measured = stored(features(docs, carry, vocabulary), "quality")
    refs = references(measured, common, vocabulary)

    def nearest(shares, which: int) -> Column:
        each = [js_distance(shares(r[which]), r[which]) for r in refs]
        return F.array_min(F.array(*each)) if each else F.lit(None).cast("double")

    by_class = lambda _: F.transform(F.array(*[F.col(f"__c_{c}") for c in NAMES]), lambda x: x / F.col("__chars"))

    def by_word(ref: list[float]) -> Column:  # only this language's words; all others are the rest
        own = F.zip_with(F.col("__hits"), F.array(*[F.lit(q > 0) for q in ref[:-1]]), lambda c, mine: F.when(mine, c).otherwise(F.lit(0).cast("long")))
        return let(own, lambda x: F.transform(
            F.concat(x, F.array(F.col("__n_words") - F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b))),
            lambda c: c / F.col("__n_words")))

    out = measured.select(
        *carry, "__n_words", "__word_chars", F.col("__c_symbol").alias("__n_symbols"), "__n_dup_lines", "__n_repeat_words",
        F.when(F.col("__chars") >= MIN_CHARS, nearest(by_class, 0)).alias("__char_js"),
        F.when(F.col("__n_words") >= MIN_WORDS, nearest(by_word, 1)).alias("__word_js"),
        ((F.col("__n_words") < LEAST_WORDS) | (100 * F.col("__n_repeat_words") > MOST_REPEATED_PERCENT * F.col("__n_words"))).alias("__base_failed"),
    )
    diverges = (F.coalesce(F.col("__char_js"), F.lit(0.0)) > MAX_CHAR_JS) | (F.coalesce(F.col("__word_js"), F.lit(0.0)) > MAX_WORD_JS)
    return out.withColumn("__kept", ~F.col("__base_failed") & ~diverges)


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document with the base columns and the verdict."""
    out = judged(docs.select("doc_id", "text", "lang"), ["doc_id", "lang"])
    return out.select("doc_id", *[F.col(f"__{n}").alias(n) for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, columns as in ``docs``."""
    return with_columns_aside(docs, ("doc_id", "text", "lang"), lambda d: judged(d, d.columns).where("__kept").select(*d.columns))
