"""Hot key: one user holds a third of all events (derived from the driver's events table).

Sessions, latest documents and key ids must stay exact; DuckDB runs the same
derivation on the base table as the oracle.
"""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tributary.functions.variants import field
from tributary.operators import envelope, routing, state, windows
from tributary.sources import fixtures as fx

SF = "/root/testdata/sf0.01"
HOT = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END"


@pytest.fixture(scope="module")
def skewed(spark):
    e = fx.read_table(spark, SF, "events").withColumn(
        "user_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(0).cast("long")).otherwise(F.col("user_id")))
    cols = [F.col("event_id"), F.col("user_id"), F.col("event_type")]
    op = F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("update"))
    envs = fx.dms_envelopes(e, table="events", key="event_id", columns=cols, event_time=F.col("ts"), operation=op)
    return routing.route(routing.only_data(envelope.parse_dms(envs)), id_mode="key", key_columns=["user_id"])


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    c.execute(f"CREATE VIEW events AS SELECT event_id, ts, {HOT} AS user_id, event_type "
              f"FROM read_parquet('{SF}/events.parquet')")
    return c


pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_hot_user_latest_documents(skewed, con):
    got = sorted((r["doc_id"], r["seq"], r["n_versions"]) for r in state.latest_documents(skewed, False).collect())
    want = sorted(con.execute(
        "SELECT md5(unhex(md5('4:TPCH.events{user_id=' || length(CAST(user_id AS VARCHAR)) || ':' || user_id || '}'))), arg_max(event_id, ts), count(*) "
        "FROM events GROUP BY user_id").fetchall())
    assert got == want
    hot = [g for g in got if g[2] > 1000]
    assert len(hot) == 1


def test_hot_user_sessions(skewed, con):
    kept = skewed.withColumn("user_id", field(F.col("data"), "user_id", "bigint"))
    s = windows.session_counts(kept, "30 minutes", "user_id")
    got = sorted((r["user_id"], r["session_start"].strftime("%Y-%m-%d %H:%M:%S.%f"), r["n"]) for r in s.collect())
    want = sorted(con.execute("""
        WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
        g AS (SELECT user_id, ts, sum(CASE WHEN p IS NULL OR ts - p > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
        SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f'), count(*) FROM g GROUP BY user_id, sid""").fetchall())
    assert got == want
