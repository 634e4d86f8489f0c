"""Operators around the flattens: mapping projection, map-to-columns,
previous-day window, SQL over named frames or a query file.

All are declarative DataFrame/SQL plans: Catalyst prunes columns into the
scan, folds the date arithmetic to constants and pushes what it can.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.variant import ident


def apply_mapping(
    df: DataFrame, mappings: Iterable[tuple[str, str, str, str]], *, lenient: bool = True
) -> DataFrame:
    """Select, cast and rename by ``(source, source_type, target, target_type)`` rows.

    Columns not named in the mappings are dropped; source names resolve without
    case (an exact name first), whatever the session's setting. ``lenient=True`` casts with
    ``try_cast`` (a bad value becomes NULL instead of failing the job).
    """
    fn = "try_cast" if lenient else "cast"
    by_lower = {c.lower(): c for c in reversed(df.columns)}
    named = lambda src: src if src in df.columns else by_lower.get(src.lower(), src)
    return df.selectExpr(*[f"{fn}({ident(named(src))} AS {tt}) AS {ident(tgt)}" for src, _st, tgt, tt in mappings])


def map_to_columns(df: DataFrame, map_col: str, keys: Iterable[str], *, keep: Iterable[str] = ()) -> DataFrame:
    """One column per key of a ``map<string, …>`` column; a missing key is NULL."""
    keep = list(keep)
    return df.select(*keep, *[F.col(map_col).getItem(k).alias(k) for k in keys])


_LAST = "\U0010ffff"


def _day_ranges(s: str, day: str) -> str:
    """A condition on the text ``s`` that holds for every text that reads as a timestamp from the day before
    ``day`` to ``day``, made of comparisons with constants, so that it reaches file statistics.

    A zone in the text may be 18 hours from UTC and the session's 14, so its date may be two days off on either side. Within
    these days padded dates are one range; months or days of one digit, dates without day or month, and times without a
    date have ranges of their own. Texts that start with another character than 1 to 9 (blanks, signs, zeros, ``T``)
    are all kept. Years beyond four digits: everything is kept.
    """
    days = [f"date_add({day}, {k})" for k in range(-3, 3)]
    form = lambda d, f: f"date_format({d}, '{f}')"
    between = lambda low, high: f"({s} >= {low} AND {s} < {high})"
    ranges = [f"{s} < '1'", f"{s} >= ':'", between(form(days[0], "yyyy-MM-dd"), form(f"date_add({day}, 3)", "yyyy-MM-dd"))]
    for d in days:
        ranges.append(f"(month({d}) < 10 AND {s} >= concat({form(d, 'yyyy-M')}, '-') AND {s} < concat({form(d, 'yyyy-M')}, '.'))")
        short = form(d, "yyyy-MM-d")
        ranges.append(f"(day({d}) < 10 AND (({s} >= {short} AND {s} < concat({short}, '0')) OR ({s} >= concat({short}, ':') AND {s} < concat({short}, '{_LAST}'))))")
        ranges.append(f"(day({d}) = 1 AND ({between(form(d, 'yyyy-MM'), f"concat({form(d, 'yyyy-MM')}, '-')")} OR (month({d}) < 10 AND {between(form(d, 'yyyy-M'), f"concat({form(d, 'yyyy-M')}, '-')")}) "
                      f"OR (month({d}) = 1 AND {between(form(d, 'yyyy'), f"concat({form(d, 'yyyy')}, '-')")})))")
    ranges += [between(f"'{h}:'", f"'{h};'") for h in range(1, 24)]  # times without a date: today's
    return f"(NOT year({day}) BETWEEN 1001 AND 9998 OR {' OR '.join(ranges)})"


def previous_day(
    df: DataFrame,
    ts_col: str = "upsertTimestamp",
    *,
    run_date: str | _dt.date | None = None,
    inclusive_end: bool = True,
) -> DataFrame:
    """Rows whose timestamp text falls on the day before ``run_date``.

    The window is ``[run_date - 1 day, run_date]``: both ends included by
    default, so a row stamped exactly at midnight belongs to two daily runs;
    ``inclusive_end=False`` gives the half-open day. Text that does not read
    as a timestamp (``try_cast``) is excluded, never an error. ``run_date``
    defaults to ``current_date()``. On text columns a wider condition of plain string
    ranges goes before the exact one (``_day_ranges``), so files and row groups whose
    statistics rule the days out are not read.
    """
    if run_date is None:
        day = "current_date()"
    else:
        day = f"DATE '{_dt.date.fromisoformat(str(run_date)).isoformat()}'"
    start = f"CAST(date_sub({day}, 1) AS TIMESTAMP)"
    end = f"{start} + INTERVAL 1 DAY"
    ts = f"try_cast({ident(ts_col)} AS TIMESTAMP)"
    cond = f"{ts} BETWEEN {start} AND {end}" if inclusive_end else f"{ts} >= {start} AND {ts} < {end}"
    if any(f.name.lower() == ts_col.lower() and f.dataType == StringType() for f in df.schema):
        df = df.where(_day_ranges(ident(ts_col), day))
    return df.where(cond)


def sql_over(spark: SparkSession, query: str, frames: Mapping[str, DataFrame], *, register: bool = False) -> DataFrame:
    """Run ``query`` with each DataFrame visible under its alias.

    ``{alias}`` placeholders are bound as named DataFrame arguments (no global
    name); with ``register=True`` the frames become temp views instead, for
    query text that names them as plain tables.
    """
    if register:
        for alias, frame in frames.items():
            frame.createOrReplaceTempView(alias)
        return spark.sql(query)
    return spark.sql(query, **dict(frames))


def read_query_text(spark: SparkSession, path: str) -> str:
    """The whole text of a (small) query file, read by Spark from any supported store."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one query file at {path}, found {'several' if rows else 'none'}")
    return rows[0][0]


def sql_file(spark: SparkSession, path: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Run the SQL stored at ``path`` over ``frames`` registered as temp views.

    The whole file is the query (a one-line file behaves like reading its first
    line). A trailing ``;`` is ignored. Returns the lazy result; the caller
    decides the sink.
    """
    text = read_query_text(spark, path).strip().rstrip(";")
    return sql_over(spark, text, frames, register=True)
