"""Process state: what to do next, what is ready, what may be published, what has changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.functions.scalar import phase_rank

TASKS = ("Transcoding", "Alignment", "Captioning", "KeyFrame", "Spacy", "Stanford", "EntityResolution")


def next_candidate(segments: DataFrame, states: DataFrame, locks: DataFrame, key: str = "segment_id", include_failures: bool = False) -> DataFrame:
    """The first segment, by id, that isn't ready, has no lock and (unless failures are included) no failed task."""
    open_ = segments.where("ready <> 'Y'").join(locks.select(key), key, "left_anti")
    if not include_failures:
        open_ = open_.join(states.where("state = 'F'").select(key), key, "left_anti")
    return open_.orderBy(key).limit(1)


def next_state(current: Column, requirements_met: Column, succeeded: Column, forced: Column) -> Column:
    """The task state machine: complete tasks stay so unless forced; unmet requirements leave a task pending; else it runs
    and is complete or failed."""
    return F.when((current == "C") & ~forced, "C").when(~requirements_met, "P").when(succeeded, "C").otherwise("F")


def ready_flag(states: DataFrame, key: str, state: str = "state") -> DataFrame:
    """F if any task failed, Y if all are complete, else N."""
    return states.groupBy(key).agg(F.when(F.bool_or(F.col(state) == "F"), "F").when(F.bool_and(F.col(state) == "C"), "Y").otherwise("N").alias("ready"))


def session_outcome(segments: DataFrame, key: str, pending: Column, ready: Column) -> DataFrame:
    """wait while any segment is pending; report if any isn't ready; else publish."""
    return segments.groupBy(key).agg(F.when(F.bool_or(pending), "wait").when(F.bool_or(~ready), "report").otherwise("publish").alias("outcome"))


def moved_phase(current: Column, wanted: Column, up: bool = True) -> Column:
    """The wanted phase if it ranks above (or, for a recall, below) the current one."""
    ahead = phase_rank(wanted) > phase_rank(current) if up else phase_rank(wanted) < phase_rank(current)
    return F.when(ahead, wanted).otherwise(current)


def may_publish(segments: DataFrame, key: str, checks: list[Column], phase: Column, to_production: bool) -> DataFrame:
    """Per session: whether all segments pass all checks, and a draft doesn't go to production."""
    ok = F.lit(True)
    for c in checks:
        ok = ok & F.coalesce(c, F.lit(False))
    if to_production:
        ok = ok & (phase != "D")
    return segments.groupBy(key).agg(F.bool_and(ok).alias("may_publish"), F.count_if(~ok).alias("failing"))


def tag_sync(remote: DataFrame, local: DataFrame, key: str = "segment_id") -> DataFrame:
    """Status of each remote record: new without a local one, changed if the times differ, else unchanged."""
    met = remote.join(local.select(key, F.col("last_modified").alias("_l")), key, "left")
    return met.withColumn("status", F.when(F.col("_l").isNull(), "new").when(F.col("_l") != F.col("last_modified"), "changed").otherwise("unchanged")).drop("_l")


def best_pass(results: DataFrame, key: str) -> DataFrame:
    """Of several aligner passes the one with fewer unaligned words, then the shorter longest run, then the earlier."""
    rest = [c for c in results.columns if c != key]
    return results.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("unaligned", "max_run", "pass")).alias("_r")).select(key, "_r.*")


def acquire(locks: DataFrame, wanted: DataFrame) -> DataFrame:
    """locks and wanted (segment_id, pid, host) -> the locks after it. A segment has one lock and a process (pid, host) holds one: of
    the requests for what is free, first the least process of each segment, then the least segment of each process."""
    free = wanted.join(locks, "segment_id", "left_anti").join(locks, ["pid", "host"], "left_anti").select("segment_id", "pid", "host").distinct()
    mine = free.groupBy("segment_id").agg(F.min(F.struct("host", "pid")).alias("p")).select("segment_id", "p.pid", "p.host")
    return locks.unionByName(mine.groupBy("pid", "host").agg(F.min("segment_id").alias("segment_id")))


def release(locks: DataFrame, done: DataFrame) -> DataFrame:
    """The locks without those of the segments done, each by the process that holds it."""
    return locks.join(done, ["segment_id", "pid", "host"], "left_anti")
