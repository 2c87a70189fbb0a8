"""Live match state (L-1 ... L-9, F-7, F-8, U-1, U-2).

The reference handles each snapshot in a loop on one machine and keeps the
current state of each match in a database by keyed upsert.  Here every step is
a column expression over a DataFrame of snapshots, and the upsert is one keyed
aggregate -- so the same functions run over a batch of landed responses or a
stream of them.

Order: a snapshot is ordered by (fetched_at, seq, position in the response).
The latest snapshot wins, whatever order files arrive in.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.functions import live as L
from crease.functions.core import built_once
from crease.schemas import CACHE_TTL_SECONDS, CORRUPT_COLUMN, CURRENT_OVER_DECIMAL, REQUIRED_RATE_DECIMAL, VARCHAR_LIMITS

ARRIVAL = "arrived_at"  # when a response was landed, if the source tells
FIRST_SEEN = ("team1", "team2", "venue")
LAST_SEEN = (
    "team1_score",
    "team2_score",
    "status",
    "is_ongoing",
    "is_completed",
    "current_over",
    "target",
    "required_rate",
    "winner",
    "result_margin",
)
NEVER_FILLED = (("date_time", "string"), ("toss_winner", "string"), ("balls_remaining", "int"))


def snapshot_rows(responses: DataFrame) -> DataFrame:
    """L-1: one row per match snapshot from landed responses
    (``fetched_at, seq, data``, and the reader's corrupt-record column if
    there is one).  Venue defaults to "Unknown".

    A response without readable ``data`` stays as one row without a position
    (:func:`validate_snapshots` sets it aside); an empty list of matches
    gives no row.  ``raw`` is the snapshot as JSON, or the response's text;
    ``score`` what is read of its score array
    (:func:`crease.functions.live.score_summary`).
    """
    text = F.to_json(F.struct("fetched_at", "seq"))
    if CORRUPT_COLUMN in responses.columns:
        text = F.coalesce(F.col(CORRUPT_COLUMN), text)
    # outer + explicit filter: the optimizer infers no size() filter to push into the scan
    arrival = [ARRIVAL] if ARRIVAL in responses.columns else []
    exploded = responses.select(
        "fetched_at",
        "seq",
        *arrival,
        F.when(F.col("data").isNull(), text).alias("response"),
        # scores are read here, once a snapshot: a column of the generator is not computed again by what reads it
        F.posexplode_outer(F.transform("data", lambda m: F.struct(m.alias("m"), L.score_summary(m["score"]).alias("score")))).alias("pos", "e"),
    )
    m = F.col("e")["m"]
    return exploded.filter(F.col("pos").isNotNull() | F.col("response").isNotNull()).select(
        "fetched_at",
        "seq",
        "pos",
        F.coalesce(F.col("response"), F.to_json(m), F.lit("null")).alias("raw"),
        m["id"].alias("match_id"),
        m["status"].alias("status"),
        F.coalesce(m["venue"], F.lit("Unknown")).alias("venue"),
        F.get(m["teamInfo"], 0)["name"].alias("team1"),
        F.get(m["teamInfo"], 1)["name"].alias("team2"),
        F.col("e")["score"].alias("score"),
        *arrival,
    )


@built_once
def _required_field_problem() -> Column:
    checks = [
        ("pos", "unparsable response"),
        ("match_id", "missing id"),
        ("status", "missing status"),
        ("team1", "missing team 1"),
        ("team2", "missing team 2"),
        ("fetched_at", "missing time"),
    ]
    expr = None
    for c, reason in checks:
        expr = (F.when(F.col(c).isNull(), F.lit(reason))) if expr is None else expr.when(F.col(c).isNull(), F.lit(reason))
    return expr.when(F.col("score")["unreadable"], F.lit("unreadable score"))


def validate_snapshots(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F-7: (valid, quarantine).  A response that does not parse, a snapshot
    without id, status, two team names or time, or with a score that is no
    finite number, is set aside with its text and a reason; the others go on."""
    tagged = snapshots.withColumn("problem", _required_field_problem())
    valid = tagged.filter(F.col("problem").isNull()).drop("problem")
    quarantine = tagged.filter(F.col("problem").isNotNull()).select(
        "fetched_at", "seq", "pos", "match_id", "raw", F.col("problem").alias("reason")
    )
    return valid, quarantine


def rejected_snapshots(responses: DataFrame) -> DataFrame:
    """Everything the current-state table leaves out, with text and reason:
    the quarantine of :func:`validate_snapshots` and the rows that would not
    fit the table (F-8).  One pass and no shuffle, on a batch or a stream."""
    tagged = snapshot_rows(responses).withColumn("problem", _required_field_problem())
    arrival = [ARRIVAL] if ARRIVAL in tagged.columns else []
    rows = tagged.select("*", *_flag_columns()).select("raw", "problem", *_row_columns(), *arrival)
    reason = F.coalesce(F.col("problem"), _store_problem())
    rejected = rows.select("fetched_at", "seq", "pos", "match_id", "raw", reason.alias("reason"), *arrival)
    return rejected.filter(F.col("reason").isNotNull())


def reject_key() -> Column:
    """What tells rejects apart: time, number, position and text of the snapshot."""
    return F.md5(F.to_json(F.struct("fetched_at", "seq", "pos", "raw"), {"ignoreNullFields": "false"}))


def unique_rejects(rejected: DataFrame) -> DataFrame:
    """Each reject once, however often its response was landed."""
    return rejected.withColumn("__key", reject_key()).dropDuplicates(["__key"]).drop("__key")


@built_once
def _flag_columns() -> list[Column]:
    return [L.is_ongoing("status").alias("is_ongoing"), L.is_completed("status").alias("is_completed")]


@built_once
def _row_columns() -> list[Column]:
    t1_score, t2_score = L.score_texts("score")
    target, rate = L.chase("score")
    winner, margin = L.result("status", "team1", "team2", F.col("is_completed"))
    return [
        F.col("fetched_at"),
        F.col("seq"),
        F.col("pos"),
        F.col("match_id"),
        F.col("team1"),
        F.col("team2"),
        t1_score.alias("team1_score"),
        t2_score.alias("team2_score"),
        F.col("status"),
        F.col("is_ongoing"),
        F.col("is_completed"),
        F.col("venue"),
        L.current_over("score").alias("current_over"),
        target.alias("target"),
        rate.alias("required_rate"),
        winner.alias("winner"),
        margin.alias("result_margin"),
        L.state_label("is_ongoing", "is_completed").alias("state"),
    ]


def live_rows(valid: DataFrame) -> DataFrame:
    """L-2 ... L-8 on validated snapshots: flags, score texts, current over,
    target and required rate, winner and margin, state label."""
    return valid.select("*", *_flag_columns()).select(*_row_columns())


def _decimal(name: str, spec: tuple[int, int]) -> Column:
    return F.col(name).try_cast(f"decimal({spec[0]},{spec[1]})")


@built_once
def _store_problem() -> Column:
    problem = None
    for c, n in VARCHAR_LIMITS.items():
        cond = F.length(c) > n
        reason = F.lit(f"{c} longer than {n}")
        problem = F.when(cond, reason) if problem is None else problem.when(cond, reason)
    return (
        problem.when(_decimal("current_over", CURRENT_OVER_DECIMAL).isNull(), F.lit("current_over overflow"))
        .when(F.col("target").try_cast("int").isNull(), F.lit("target overflow"))
        .when(_decimal("required_rate", REQUIRED_RATE_DECIMAL).isNull(), F.lit("required_rate overflow"))
    )


def storable(rows: DataFrame) -> DataFrame:
    """F-8: add ``store_problem`` -- why the row would not fit the state table
    (a text longer than its column, a number beyond its decimal precision), or
    null.  Numbers are rounded to the stored precision as a database would."""
    return rows.withColumn("store_problem", _store_problem())


def _order() -> Column:
    return F.struct("fetched_at", "seq", "pos")


def current_state_aggregate(rows: DataFrame) -> DataFrame:
    """U-1 core: per match, first-seen identity and last-seen mutable state.

    One aggregate (``min_by`` / ``max_by`` on the snapshot order) instead of a
    row-by-row upsert; both are algebraic, so Spark combines partial results
    map-side and a match with millions of snapshots costs one row per task in
    the shuffle.  Works unchanged on a stream (update or complete mode).
    """
    stored = storable(rows).filter(F.col("store_problem").isNull())
    first = F.struct(*FIRST_SEEN)
    last = F.struct(*LAST_SEEN, F.col("fetched_at").alias("updated_at"))
    return stored.groupBy("match_id").agg(
        F.min_by(first, _order()).alias("first"),
        F.max_by(last, _order()).alias("last"),
    )


def current_state_columns(agg: DataFrame) -> DataFrame:
    """Shape the aggregate as the live_matches table (current over and
    required rate as the declared decimals, rounded half-up; the columns no
    code fills are typed nulls)."""
    return agg.select(*_state_columns())


@built_once
def _state_columns() -> list[Column]:
    cols = [F.col("match_id")]
    cols += [F.col(f"first.{c}").alias(c) for c in ("team1", "team2")]
    cols += [F.col(f"last.{c}").alias(c) for c in ("team1_score", "team2_score", "status", "is_ongoing", "is_completed")]
    cols.append(F.col("first.venue").alias("venue"))
    cols.append(_decimal("last.current_over", CURRENT_OVER_DECIMAL).alias("current_over"))
    cols.append(F.col("last.target").cast("int").alias("target"))
    cols.append(_decimal("last.required_rate", REQUIRED_RATE_DECIMAL).alias("required_rate"))
    cols += [F.col(f"last.{c}").alias(c) for c in ("winner", "result_margin", "updated_at")]
    cols += [F.lit(None).cast(t).alias(c) for c, t in NEVER_FILLED]
    return cols


def current_state(rows: DataFrame) -> DataFrame:
    """U-1: the live_matches current-state table from live rows."""
    return current_state_columns(current_state_aggregate(rows))


def cache_entries(valid_rows: DataFrame, as_of: _dt.datetime | None = None, ttl_seconds: int = CACHE_TTL_SECONDS) -> DataFrame:
    """U-2: the recent-state cache as of ``as_of`` (default: the latest
    snapshot time).

    Every valid snapshot writes its summary, stored or not; an entry lives
    ``ttl_seconds`` after its last write.  So: latest valid snapshot per match,
    kept when written after ``as_of - ttl``.  Because expiry grows with the
    write time, the cut can come first: only the last ``ttl`` seconds of
    snapshots reach the aggregate (and the filter reaches the scan), not the
    whole history.  The payload is proper JSON.
    """
    # the latest time stays in the plan as a scalar subquery (null without snapshots: no entry)
    as_of_col = valid_rows.agg(F.max("fetched_at")).scalar() if as_of is None else F.lit(str(as_of))
    as_of_col = as_of_col.cast(valid_rows.schema["fetched_at"].dataType)
    cutoff = as_of_col - F.make_dt_interval(secs=F.lit(ttl_seconds))
    summary = F.struct(
        F.concat_ws(" vs ", "team1", "team2").alias("teams"),
        F.col("team1_score").alias("score1"),
        F.col("team2_score").alias("score2"),
        "status",
    )
    recent = valid_rows.filter((F.col("fetched_at") > cutoff) & (F.col("fetched_at") <= as_of_col))
    latest = recent.groupBy("match_id").agg(
        F.max_by(F.struct(summary.alias("summary"), F.col("fetched_at").alias("written_at")), _order()).alias("l")
    )
    return latest.select(
        F.concat(F.lit("live:"), F.col("match_id")).alias("cache_key"),
        F.to_json("l.summary").alias("payload"),
        F.col("l.written_at").alias("written_at"),
        (F.col("l.written_at") + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("expires_at"),
    )


def live_report(state: DataFrame) -> DataFrame:
    """L-9: the live report from the current state, one row per match with
    fixture, venue, both scores, status and state.

    ``live_over``, ``live_target`` and ``live_rate`` only for an ongoing match
    past its first ball, the last two only when above zero; ``winner`` and
    ``result_margin`` only for a decided match.
    """
    live = F.col("is_ongoing") & (F.col("current_over") > 0)
    decided = F.col("is_completed") & (F.col("winner") != "")
    return state.select(
        "match_id",
        F.concat_ws(" vs ", "team1", "team2").alias("fixture"),
        "venue",
        "team1_score",
        "team2_score",
        "status",
        L.state_label("is_ongoing", "is_completed").alias("state"),
        F.when(live, F.col("current_over")).alias("live_over"),
        F.when(live & (F.col("target") > 0), F.col("target")).alias("live_target"),
        F.when(live & (F.col("required_rate") > 0), F.col("required_rate")).alias("live_rate"),
        F.when(decided, F.col("winner")).alias("winner"),
        F.when(decided, F.col("result_margin")).alias("result_margin"),
    )
