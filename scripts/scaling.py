"""How query time grows with rows: the given tables replicated k times.

Usage: python scripts/scaling.py [sf_dir] [k ...]   (default: sf0.1, k = 1 10)

Each copy of ``events`` / ``orders`` gets shifted user and order ids, so
copies are new users and orders rather than duplicates (the dedup would
otherwise collapse them). Times are medians of 3 runs (noop sink) after a
warm-up, printed as one JSON line per (k, query).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from viewlog.operators import reports as R  # noqa: E402
from viewlog.operators.clean import dedup_hashed  # noqa: E402
from viewlog.operators.profiles import user_profiles  # noqa: E402
from viewlog.plans.transform import build_fact  # noqa: E402
from viewlog.session import get_spark  # noqa: E402
from viewlog.sources.tables import read_table, sessions_ev, sessions_or  # noqa: E402


def replicate_events(events, k: int):
    rep = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint"))).alias("_rep")
    return (events.select("*", rep)
            .withColumn("user_id", F.col("user_id") + F.col("_rep") * 1_000_000)
            .withColumn("event_id", F.col("event_id") + F.col("_rep") * 100_000_000)
            .drop("_rep"))


def replicate_orders(orders, k: int):
    rep = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint"))).alias("_rep")
    return (orders.select("*", rep)
            .withColumn("o_custkey", F.col("o_custkey") + F.col("_rep") * 10_000_000)
            .withColumn("o_orderkey", F.col("o_orderkey") + F.col("_rep") * 1_000_000_000)
            .drop("_rep"))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    ks = [int(x) for x in sys.argv[2:]] or [1, 10]
    spark = get_spark("local[8]", 16, extra={"spark.driver.memory": "8g"})
    events, orders = read_table(spark, sf, "events"), read_table(spark, sf, "orders")
    for k in ks:
        ev = build_fact(sessions_ev(replicate_events(events, k)))
        orr = build_fact(sessions_or(replicate_orders(orders, k)))
        cases = {
            "fact_sessions": lambda: build_fact(sessions_ev(replicate_events(events, k)), dedup_hashed),
            "fact_sessions_sorted": lambda: ev,
            "daily_active_users": lambda: R.daily_active_users(ev),
            "user_profiles": lambda: user_profiles(orr),
        }
        rows = {"events": 100_000 * k, "orders": 150_000 * k}
        for name, mk in cases.items():
            mk().write.format("noop").mode("overwrite").save()
            ts = []
            for _ in range(3):
                t0 = time.perf_counter()
                mk().write.format("noop").mode("overwrite").save()
                ts.append(time.perf_counter() - t0)
            print(json.dumps({"k": k, "query": name, "input_rows": rows,
                              "sec": round(statistics.median(ts), 3)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
