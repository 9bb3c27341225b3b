"""Queries over histories of changing rows and joins by time."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import intervals, ranges
from lakeops.plans.tables import table

KEYS, AT, SEQUENCE, GONE = ["o_custkey"], "o_orderdate", "o_orderkey", "gone"
AS_OF = "1997-07-01"


def _changes(spark, folder):
    """Every order states its customer's latest status and priority; one in ten ends the customer instead."""
    return table(spark, folder, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority",
        (F.col("o_orderkey") % 10 == 0).alias(GONE))


def _merge(state, changes, **options):
    return intervals.merge_history(state, changes, KEYS, AT, SEQUENCE, GONE, **options)


def scd2_merge(spark, folder):
    """Two batches; the second arrives late and splits stretches of the first all over time."""
    changes = _changes(spark, folder)
    first = _merge(None, changes.filter(F.col(SEQUENCE) % 3 != 0))
    return _merge(first, changes.filter(F.col(SEQUENCE) % 3 == 0))


def scd2_collapsed(spark, folder):
    """One batch, without the changes that change nothing."""
    return _merge(None, _changes(spark, folder), collapse=True)


def scd2_as_of(spark, folder):
    """Three batches in an order unlike that of time, then the customers at one date."""
    changes, state = _changes(spark, folder), None
    for batch in (2, 0, 1):
        state = _merge(state, changes.filter(F.col(SEQUENCE) % 3 == batch))
    return intervals.as_of(state, F.lit(AS_OF).cast("timestamp_ntz"))


def _windows(spark, folder):
    """Some minutes after every error, a day after some, and one stretch without an end."""
    errors = table(spark, folder, "events").filter("event_type = 'error'")
    minutes = F.when(F.col("event_id") % 50 == 0, 1440).otherwise(F.col("event_id") % 7)
    return errors.select(
        F.col("event_id").alias("error_id"), F.col("ts").alias("begin"),
        F.when(F.col("event_id") % 997 != 0, F.timestamp_add("MINUTE", minutes.cast("int"), F.col("ts"))).alias("until"))


def point_in_interval(spark, folder):
    """The purchases in the time after each error, by nothing but time."""
    bought = table(spark, folder, "events").filter("event_type = 'purchase'").select("event_id", "ts", "user_id")
    return ranges.point_join(bought, _windows(spark, folder), "ts", ("begin", "until"), closed=False).select(
        "event_id", "error_id", "ts")


def interval_overlap(spark, folder):
    """Pairs of error times that overlap, each pair of errors once."""
    found = ranges.overlap_join(_windows(spark, folder), _windows(spark, folder), ("begin", "until"), ("begin", "until"))
    return found.filter("error_id < error_id_right").select("error_id", "error_id_right")


def interval_overlap_keys(spark, folder):
    """Pairs of orders of one customer whose twenty days overlap."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.timestamp_add(
        "DAY", F.lit(20), F.col("o_orderdate")).alias("until"))
    found = ranges.overlap_join(orders, orders, ("o_orderdate", "until"), ("o_orderdate", "until"), ["o_custkey"], closed=False)
    return found.filter("o_orderkey < o_orderkey_right").select("o_custkey", "o_orderkey", "o_orderkey_right")


QUERIES = {f.__name__: f for f in (
    scd2_merge, scd2_collapsed, scd2_as_of, point_in_interval, interval_overlap, interval_overlap_keys)}

_WINDOWS = """
    SELECT event_id AS error_id, ts AS begin_at, CASE WHEN event_id % 997 <> 0 THEN
               ts + to_minutes(CASE WHEN event_id % 50 = 0 THEN 1440 ELSE event_id % 7 END) END AS until
    FROM events WHERE event_type = 'error'"""


def _events(order: str) -> str:
    """One event per customer and time: the last in ``order``."""
    return f"""
        SELECT o_custkey, o_orderdate AS valid_from, o_orderkey % 10 = 0 AS deleted,
               CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS o_orderstatus,
               CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS o_orderpriority
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY {order}) = 1"""


_STRETCHES = """
    SELECT o_custkey, o_orderstatus, o_orderpriority, valid_from,
           lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_to, deleted
    FROM ({events})"""

ORACLES = {
    "point_in_interval": f"""
        SELECT e.event_id, w.error_id, e.ts
        FROM events e JOIN ({_WINDOWS}) w ON w.begin_at <= e.ts AND (w.until IS NULL OR e.ts < w.until)
        WHERE e.event_type = 'purchase'""",
    "interval_overlap": f"""
        SELECT a.error_id, b.error_id AS error_id_right
        FROM ({_WINDOWS}) a JOIN ({_WINDOWS}) b ON a.error_id < b.error_id
             AND (b.until IS NULL OR a.begin_at <= b.until) AND (a.until IS NULL OR b.begin_at <= a.until)""",
    "interval_overlap_keys": """
        SELECT a.o_custkey, a.o_orderkey, b.o_orderkey AS o_orderkey_right
        FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey
             AND a.o_orderdate < b.o_orderdate + INTERVAL 20 DAY AND b.o_orderdate < a.o_orderdate + INTERVAL 20 DAY""",
    "scd2_merge": _STRETCHES.format(events=_events("o_orderkey % 3 <> 0, o_orderkey DESC")),
    "scd2_collapsed": _STRETCHES.format(events=f"""
        SELECT * EXCLUDE (before)
        FROM (SELECT *, lag({{'d': deleted, 's': o_orderstatus, 'p': o_orderpriority}})
                            OVER (PARTITION BY o_custkey ORDER BY valid_from) AS before
              FROM ({_events('o_orderkey DESC')}))
        WHERE CASE WHEN before IS NULL THEN NOT deleted
                   ELSE before.d <> deleted OR before.s IS DISTINCT FROM o_orderstatus
                        OR before.p IS DISTINCT FROM o_orderpriority END"""),
    "scd2_as_of": f"""
        SELECT o_custkey, o_orderstatus, o_orderpriority
        FROM (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '{AS_OF}'
              QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
                  CASE o_orderkey % 3 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END, o_orderkey DESC) = 1)
        WHERE o_orderkey % 10 <> 0""",
}
