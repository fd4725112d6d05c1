"""Q1 surface: shapes whose test data cannot show everything, checked
against brute force on small overlapping fixtures."""

import datetime as dt
import random

from tablepipe.plans.catalog import QUERIES


def test_asof_against_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    orders = [(i, rnd.randrange(5), base + dt.timedelta(days=rnd.randrange(90)), "O", 1.0, "1-URGENT")
              for i in range(300)]
    # ties on the same timestamp for one key
    orders += [(1000 + j, 1, base + dt.timedelta(days=40), "O", 1.0, "1-URGENT") for j in range(3)]
    events = [(i, base + dt.timedelta(days=rnd.randrange(100), hours=rnd.randrange(24)), rnd.randrange(6),
               "view", 1.0, "{}") for i in range(400)]
    o = spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
                                      "o_orderstatus string, o_totalprice double, o_orderpriority string")
    e = spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                                      "value double, props string")
    d = f"{spark.conf.get('spark.sql.warehouse.dir')}/asof_fixture"
    o.write.mode("overwrite").parquet(f"{d}/orders.parquet")
    e.write.mode("overwrite").parquet(f"{d}/events.parquet")
    got = {r.event_id: r.last_orderkey for r in QUERIES["sql_asof"](spark, d).collect()}
    want = {}
    for ev_id, ts, user, *_ in events:
        cands = [(t, k) for k, c, t, *_ in orders if c == user and t <= ts]
        want[ev_id] = max(cands)[1] if cands else None
    assert got == want
