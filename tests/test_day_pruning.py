"""The string ranges before the previous-day window lose no row, and reach the scan."""

import os
import random

import pytest
from pyspark.sql import functions as F

from unfurl import previous_day
from unfurl.operators.relational import _day_ranges


def _texts(n, seed, days):
    rnd = random.Random(seed)
    out = ["", " ", "T", "T00:00", "T23:59:59", "00:00", "0:0", "9:5:1", "12:30", "23:59", "24:00", "+2024-01-01", "-2024-01-01", "002024-01-01", "02024-01-01", "12024-01-01", "epoch", "bad", "\uff12", None]
    for _ in range(n):
        y, m, d = rnd.choice(days)
        d = max(1, min(28 if m == 2 else 30, d + rnd.randint(-4, 4)))
        date = rnd.choice([f"{y:04d}-{m:02d}-{d:02d}"] * 6 + [f"{y}-{m}-{d}", f"{y}-{m}-{d:02d}", f"{y}-{m:02d}-{d}", f"{y}-{m:02d}", f"{y}-{m}", f"{y}", f"+{y}-{m:02d}-{d:02d}", f"00{y}-{m:02d}-{d:02d}"])
        time = rnd.choice(["", "", " ", "T", f"T{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}", f" {rnd.randint(0, 23)}:{rnd.randint(0, 59)}:{rnd.randint(0, 59)}.{rnd.randint(0, 999999)}", " 00:00:00", "T24:00:00"])
        zone = rnd.choice(["", "", "Z", f"{rnd.choice('+-')}{rnd.randint(0, 18):02d}:00", f"{rnd.choice('+-')}{rnd.randint(0, 9)}:30", " UTC", " Pacific/Kiritimati", " Etc/GMT+12", " GMT-14:00"]) if ":" in time else ""
        out.append(rnd.choice(["", "", "", " ", "\t", "\x01"]) + date + time + zone + rnd.choice(["", "", "", " ", "\n"]))
    return out


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Kiritimati", "Etc/GMT+12"])
def test_no_row_is_lost(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for run_date in ("2024-01-01", "2024-01-02", "2024-10-10", "2024-03-01", None):
            today = spark.sql("SELECT current_date() AS d").collect()[0].d if run_date is None else None
            y, m, d = (today.year, today.month, today.day) if today else map(int, run_date.split("-"))
            texts = _texts(7000, hash(run_date) % 1000, [(y, m, d)] * 4 + [(y, max(1, m - 1), 30), (y - 1, 12, 31), (y, m % 12 + 1, 1)])
            df = spark.createDataFrame([(t,) for t in texts], "upsertTimestamp string")
            day = "current_date()" if run_date is None else f"DATE '{run_date}'"
            ts = "try_cast(upsertTimestamp AS TIMESTAMP)"
            inside = f"{ts} >= CAST(date_sub({day}, 1) AS TIMESTAMP) AND {ts} <= CAST(date_sub({day}, 1) AS TIMESTAMP) + INTERVAL 1 DAY"
            both = df.selectExpr(f"coalesce({inside}, false) AS exact", f"coalesce({_day_ranges('upsertTimestamp', day)}, false) AS wide", "upsertTimestamp").collect()
            lost = [r.upsertTimestamp for r in both if r.exact and not r.wide]
            assert not lost, (zone, run_date, lost[:5])
            assert sum(r.exact for r in both) > 300
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ranges_reach_the_scan_and_skip_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "days")
    stamped = spark.range(0, 4000).select(F.concat(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).cast("string"), F.lit(" 10:00:00")).alias("upsertTimestamp"), "id")
    stamped.coalesce(1).sortWithinPartitions("upsertTimestamp").write.option("parquet.block.size", "8192").option("parquet.page.size", "1024").parquet(path)
    df = previous_day(spark.read.parquet(path), run_date="2024-05-15")
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(upsertTimestamp,2024-05-12)" in pushed and "LessThan(upsertTimestamp,2024-05-18)" in pushed
    assert [r.upsertTimestamp for r in df.collect()] == ["2024-05-14 10:00:00"]
