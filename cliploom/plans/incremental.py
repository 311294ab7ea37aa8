"""Queries of problem 1: shards whose state is new or changed since it was last recorded."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.operators import merkle
from cliploom.session import shared_dir, table

COMPARED = ["stage", "scored", "uploaded", "finished_at"]


def current_states(spark: SparkSession, d: str) -> DataFrame:
    """The save with the greatest save_seq of each shard."""
    return merkle.latest(table(spark, d, "shard_state").select("shard", *COMPARED, "save_seq"), ["shard"], ["save_seq"])


def recorded_states(spark: SparkSession, d: str) -> DataFrame:
    """What the newest successful run that recorded a shard noted of it."""
    good = table(spark, d, "run_log").where("status = 'success'").select("run_id").distinct()
    rows = table(spark, d, "run_ledger").select("shard", *COMPARED, "run_id").join(good, "run_id", "left_semi")
    return merkle.latest(rows, ["shard"], ["run_id"])


def changed_states(spark: SparkSession, d: str) -> DataFrame:
    """New, changed and deleted shards against a store that begins with what successful runs have recorded."""
    store = merkle.MerkleStore(spark, f"{shared_dir(spark)}/cliploom/states-{uuid.uuid4().hex}", ["shard"], COMPARED)
    store.bootstrap(recorded_states(spark, d))
    return store.changes(current_states(spark, d)).where(F.col(merkle.KIND) != "deleted")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return changed_states(spark, d).select("shard")


def p1_change_kinds(spark: SparkSession, d: str) -> DataFrame:
    """How many of the shards to process are new, and how many changed, by current stage."""
    return changed_states(spark, d).groupBy("stage", F.col(merkle.KIND).alias("kind")).agg(F.count(F.lit(1)).alias("shards"))


QUERIES = {"p1_found": p1_found, "p1_change_kinds": p1_change_kinds}

_STATES = """
WITH cur AS (
  SELECT DISTINCT shard, stage, scored, uploaded, finished_at FROM shard_state s
  WHERE save_seq = (SELECT max(save_seq) FROM shard_state t WHERE t.shard = s.shard)),
led AS (SELECT DISTINCT l.shard, l.stage, l.scored, l.uploaded, l.finished_at, l.run_id FROM run_ledger l
        WHERE l.run_id IN (SELECT run_id FROM run_log WHERE status = 'success')),
old AS (SELECT * FROM led WHERE run_id = (SELECT max(run_id) FROM led m WHERE m.shard = led.shard)),
found AS (SELECT cur.shard, cur.stage, old.shard IS NULL AS fresh FROM cur LEFT JOIN old ON cur.shard = old.shard
  WHERE old.shard IS NULL OR cur.stage IS DISTINCT FROM old.stage OR cur.scored IS DISTINCT FROM old.scored
     OR cur.uploaded IS DISTINCT FROM old.uploaded OR cur.finished_at IS DISTINCT FROM old.finished_at)
"""

ORACLE = {
    "p1_found": _STATES + "SELECT shard FROM found",
    "p1_change_kinds": _STATES + "SELECT stage, CASE WHEN fresh THEN 'new' ELSE 'changed' END AS kind, count(*) AS shards FROM found GROUP BY ALL",
}
