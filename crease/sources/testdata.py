"""Cricket-shaped data derived from the provided TPC-H-style tables.

The domain's own match files are not available, so matches, deliveries, match
documents and live snapshots are derived deterministically from ``orders``,
``lineitem`` and ``events``.  Every derivation is a Spark job over the whole
tables, so its work grows with them.

Mapping (one order = one match, one line item = one delivery, one event = one
live snapshot):

* match_id = o_orderkey; season = year of o_orderdate as text; match_date =
  o_orderdate as date; venue = 'V' || o_custkey
* team1 = 'T' || o_custkey % 10; team2 = 'T' || (o_custkey + 1 + o_orderkey % 9) % 10
* winner: status F -> team1, O -> team2, P -> none; toss winner: even key ->
  team1, odd -> team2; toss decision: key % 3 = 0 -> bat, else field
* win_by_runs = floor(o_totalprice) % 100 + 1 when team1 won;
  win_by_wickets = o_custkey % 10 + 1 when team2 won
* player_of_match = ['B' || o_orderkey % 200] when there is a winner, else []
* delivery: batting team = team1 when l_linestatus = 'O' else team2; over =
  l_linenumber - 1; batter 'B' || l_partkey % 200; bowler 'W' || l_suppkey %
  120; non-striker 'B' || (l_partkey + 100) % 200
* runs: batter = int(l_quantity) % 7; extras = 1 when l_returnflag = 'N' and
  l_tax >= 0.06; total = batter + extras
* wicket when l_returnflag = 'R' and l_discount >= 0.08: the batter is out,
  kind 'caught' (l_tax >= 0.04), 'bowled' (0 < l_tax < 0.04) or unknown (null,
  l_tax = 0); with l_discount >= 0.1 the non-striker is also run out.  Other
  'A' lines carry an empty wickets array, the rest none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.schemas import WICKET
from crease.sources.tables import by_key, tasks_for


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table, as its files are split."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tag(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


# --- matches ------------------------------------------------------------------------


def match_rows(spark: SparkSession, sf_dir: str, n: int | None = None) -> DataFrame:
    """One flat row per match (order) with every match-level attribute; ``n``: dealt
    by match to so many partitions."""
    o = by_key(load(spark, sf_dir, "orders"), n, "o_orderkey")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    team1 = _tag("T", cust % 10)
    team2 = _tag("T", (cust + 1 + key % 9) % 10)
    winner = F.when(F.col("o_orderstatus") == "F", team1).when(F.col("o_orderstatus") == "O", team2)
    return o.select(
        key.alias("match_id"),
        F.year("o_orderdate").cast("string").alias("season"),
        F.to_date("o_orderdate").alias("match_date"),
        _tag("V", cust).alias("venue"),
        team1.alias("team1"),
        team2.alias("team2"),
        winner.alias("winner"),
        F.when(F.col("o_orderstatus") == "F", F.floor("o_totalprice") % 100 + 1).alias("win_by_runs"),
        F.when(F.col("o_orderstatus") == "O", cust % 10 + 1).alias("win_by_wickets"),
        F.when(key % 2 == 0, team1).otherwise(team2).alias("toss_winner"),
        F.when(key % 3 == 0, F.lit("bat")).otherwise(F.lit("field")).alias("toss_decision"),
        # no winner, no player of the match: an empty list
        F.filter(F.array(_tag("B", key % 200)), lambda _: winner.isNotNull()).alias("player_of_match"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat matches table (same columns and types as the flatten output,
    minus the nested carry-over and the load timestamp)."""
    m = match_rows(spark, sf_dir)
    return m.select(
        "match_date",
        "venue",
        F.array("team1", "team2").alias("teams"),
        "season",
        F.lit("T20").alias("match_type"),
        "winner",
        "win_by_runs",
        "win_by_wickets",
        "toss_winner",
        "toss_decision",
        "player_of_match",
        "match_id",
    )


# --- deliveries -----------------------------------------------------------------------


def _delivery_columns() -> dict[str, Column]:
    partkey, suppkey = F.col("l_partkey"), F.col("l_suppkey")
    runs_batter = F.col("l_quantity").cast("bigint") % 7
    runs_extras = F.when((F.col("l_returnflag") == "N") & (F.col("l_tax") >= 0.06), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    is_wicket = (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.08)
    batter = _tag("B", partkey % 200)
    non_striker = _tag("B", (partkey + 100) % 200)
    kind = F.when(F.col("l_tax") >= 0.04, F.lit("caught")).when(F.col("l_tax") > 0, F.lit("bowled"))
    out = F.struct(batter.alias("player_out"), kind.alias("kind"))
    run_out = F.struct(non_striker.alias("player_out"), F.lit("run out").alias("kind"))
    empty = F.filter(F.array(out), lambda _: F.lit(False))
    wickets = (
        F.when(is_wicket & (F.col("l_discount") >= 0.1), F.array(out, run_out))
        .when(is_wicket, F.array(out))
        .when(F.col("l_returnflag") == "A", empty)
    )
    return {
        "is_team1_batting": F.col("l_linestatus") == "O",
        "over_number": (F.col("l_linenumber") - 1).cast("bigint"),
        "batter": batter,
        "bowler": _tag("W", suppkey % 120),
        "non_striker": non_striker,
        "runs_batter": runs_batter,
        "runs_extras": runs_extras,
        "runs_total": runs_batter + runs_extras,
        "wickets": wickets.cast(f"array<{WICKET.simpleString()}>"),
    }


def delivery_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions for a shuffle of all deliveries, None for the session's number."""
    return tasks_for(load(spark, sf_dir, "lineitem"))


def delivery_rows(spark: SparkSession, sf_dir: str, by_match: bool = False, n: int | None = None) -> DataFrame:
    """One row per delivery keyed by its order; no match attributes yet.

    ``by_match``: hash-partition the line items on the order (match) key
    first, so the delivery columns are derived after that single exchange,
    in parallel, and every later grouping by match reuses it.  ``n``: the same,
    to so many partitions.
    """
    cols = _delivery_columns()
    lines = load(spark, sf_dir, "lineitem")
    if n is not None:
        lines = by_key(lines, n, "l_orderkey")
    elif by_match:
        lines = lines.repartition("l_orderkey")
    return lines.select(F.col("l_orderkey").alias("match_id"), *[c.alias(n) for n, c in cols.items()])


def balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat ball-by-ball table (flatten output shape minus the load
    timestamp and the surrogate ball id): deliveries joined to their match.

    Large tables are dealt by match to a number of partitions that follows the
    rows; what groups by match afterwards needs no further exchange."""
    from crease.functions.cricket import wicket_details, wicket_flag

    n = delivery_tasks(spark, sf_dir)
    d = delivery_rows(spark, sf_dir, n=n)
    m = match_rows(spark, sf_dir, n).select("match_id", "season", "venue", "match_date", "team1", "team2")
    j = d.join(m, "match_id")
    return j.select(
        "match_id",
        "season",
        F.array("team1", "team2").alias("teams"),
        "venue",
        "match_date",
        F.when(F.col("is_team1_batting"), F.col("team1")).otherwise(F.col("team2")).alias("batting_team"),
        "over_number",
        "batter",
        "bowler",
        "non_striker",
        "runs_batter",
        "runs_extras",
        "runs_total",
        wicket_flag("wickets").alias("is_wicket"),
        wicket_details("wickets").alias("wicket_details"),
    )


def live_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(deliveries, matches) as events with instants: a match begins at noon UTC of
    its date, an innings takes 100 minutes, an over 5, so that the first ball of over k
    of the second innings is bowled 100 + 5 k minutes after the start.  Deliveries are
    dealt by match; matches are as the files are split."""
    from crease.functions.cricket import wicket_flag

    n = delivery_tasks(spark, sf_dir)
    began = F.to_timestamp(F.concat(F.col("match_date").cast("string"), F.lit(" 12:00:00+00:00")))
    minutes = F.when(F.col("is_team1_batting"), F.lit(0)).otherwise(F.lit(100)) + 5 * F.col("over_number")
    starts = match_rows(spark, sf_dir, n).select("match_id", began.alias("began_at"))
    deliveries = delivery_rows(spark, sf_dir, n=n).join(starts, "match_id").select(
        "match_id",
        (F.col("began_at") + F.make_dt_interval(mins=minutes.cast("int"))).alias("bowled_at"),
        F.col("is_team1_batting").alias("first_innings"),
        "over_number",
        "batter",
        "bowler",
        "runs_batter",
        "runs_total",
        wicket_flag("wickets").alias("is_wicket"),
    )
    return deliveries, match_rows(spark, sf_dir).select("match_id", began.alias("began_at"), "season", "venue", "team1", "team2")


# --- nested match documents ------------------------------------------------------------


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested match documents (``match_id, info, innings, meta``) built from the
    flat tables: deliveries -> overs -> innings -> match.

    Lines are hash-partitioned on the match key once; the three nesting
    aggregations and the join with the match rows all reuse that partitioning,
    so each input row crosses the network once.  A document is one match, so
    no group is larger than a match.  Arrays are sorted so a document is the
    same on every recomputation.
    """
    n = delivery_tasks(spark, sf_dir)
    d = delivery_rows(spark, sf_dir, by_match=True, n=n)
    delivery = F.struct(
        "batter",
        "bowler",
        "non_striker",
        F.struct(
            F.col("runs_batter").alias("batter"),
            F.col("runs_extras").alias("extras"),
            F.col("runs_total").alias("total"),
        ).alias("runs"),
        "wickets",
    )
    overs = d.groupBy("match_id", "is_team1_batting", "over_number").agg(
        F.array_sort(F.collect_list(delivery)).alias("deliveries")
    )
    innings = overs.groupBy("match_id", "is_team1_batting").agg(
        F.array_sort(F.collect_list(F.struct(F.col("over_number").alias("over"), "deliveries"))).alias("overs")
    )
    per_match = innings.groupBy("match_id").agg(
        # team1 bats first: sort on "not team1" so its innings comes first
        F.array_sort(F.collect_list(F.struct((~F.col("is_team1_batting")).alias("second"), "overs"))).alias("inn")
    )
    m = match_rows(spark, sf_dir, n)
    j = m.join(per_match, "match_id", "left")
    innings_col = F.transform(
        "inn",
        lambda i: F.struct(F.when(i["second"], F.col("team2")).otherwise(F.col("team1")).alias("team"), i["overs"].alias("overs")),
    )
    info = F.struct(
        F.lit(6).cast("bigint").alias("balls_per_over"),
        F.lit(None).cast("string").alias("city"),
        F.array(F.col("match_date").cast("string")).alias("dates"),
        F.lit("male").alias("gender"),
        F.lit(None).cast("string").alias("match_type"),
        F.struct(
            F.col("winner").alias("winner"),
            F.struct(F.col("win_by_runs").alias("runs"), F.col("win_by_wickets").alias("wickets")).alias("by"),
        ).alias("outcome"),
        F.lit(20).cast("bigint").alias("overs"),
        F.col("player_of_match"),
        F.col("season"),
        F.lit("club").alias("team_type"),
        F.array("team1", "team2").alias("teams"),
        F.struct(F.col("toss_decision").alias("decision"), F.col("toss_winner").alias("winner")).alias("toss"),
        F.col("venue"),
        F.struct(
            F.create_map(F.col("team1"), _tag("p", F.xxhash64("team1")), F.col("team2"), _tag("p", F.xxhash64("team2"))).alias(
                "people"
            )
        ).alias("registry"),
    )
    meta = F.struct(
        F.col("match_date").cast("string").alias("created"),
        F.lit("1.0").alias("data_version"),
        F.lit(1).cast("bigint").alias("revision"),
    )
    return j.select("match_id", info.alias("info"), innings_col.alias("innings"), meta.alias("meta"))


# --- live snapshots -----------------------------------------------------------------


def live_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed API response per event (``fetched_at, seq, data``).

    match id 'm' || user_id; k = props.k.  Status by event type: purchase ->
    "<Reds|Blues> won by k <runs|Wickets>" (Reds when k is even, Wickets when
    k % 3 = 0); view -> "Match in Progress"; click -> "Innings Break"; signup ->
    "Match starts at 7:30 PM"; error -> "No result".  Status is missing when
    event_id % 211 = 0 and the second team when event_id % 101 = 0 (both land
    in the quarantine).  team1 'City' || user_id % 7 || ' Reds', team2 'Port'
    || event_id % 5 || ' Blues'; venue 'Ground ' || user_id % 9, missing when
    user_id % 4 = 0.  Score: signup none, error empty, click one entry, view
    and purchase two: first (r = floor(value), w = k % 10, o = 20.0; r missing
    when k % 9 = 0), second (r = floor(value / 2), w = k % 7, missing when
    k % 4 = 0, o = k % 25 + 0.5).  Numbers come as text, the first r with a
    fraction (".75") when k % 5 = 0 and unreadable ("n/a") when event_id % 97 = 0.
    Extremes: the first r is the largest int when event_id % 103 = 0 (and 97 does
    not divide it), the second r the smallest one when event_id % 113 = 0, the
    first w beyond an int when event_id % 199 = 0, the second o infinite when
    event_id % 197 = 0 and no number (NaN) when event_id % 193 = 0.
    """
    # k is parsed once; every later expression reads the column
    e = load(spark, sf_dir, "events").select(
        "ts", "event_id", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k")
    )
    k = F.col("k")
    et = F.col("event_type")
    eid, uid = F.col("event_id"), F.col("user_id")
    won = F.concat(
        F.when(k % 2 == 0, F.lit("Reds")).otherwise(F.lit("Blues")),
        F.lit(" won by "),
        k.cast("string"),
        F.lit(" "),
        F.when(k % 3 == 0, F.lit("Wickets")).otherwise(F.lit("runs")),
    )
    status = (
        F.when(eid % 211 == 0, F.lit(None).cast("string"))
        .when(et == "purchase", won)
        .when(et == "view", F.lit("Match in Progress"))
        .when(et == "click", F.lit("Innings Break"))
        .when(et == "signup", F.lit("Match starts at 7:30 PM"))
        .when(et == "error", F.lit("No result"))
    )
    team1 = F.struct(F.concat(F.lit("City"), (uid % 7).cast("string"), F.lit(" Reds")).alias("name"))
    team2 = F.struct(F.concat(F.lit("Port"), (eid % 5).cast("string"), F.lit(" Blues")).alias("name"))
    team_info = F.when(eid % 101 == 0, F.array(team1)).otherwise(F.array(team1, team2))
    runs = F.floor("value").cast("int").cast("string")
    runs = (
        F.when(eid % 97 == 0, F.lit("n/a"))
        .when(eid % 103 == 0, F.lit("2147483647"))
        .when(k % 5 == 0, F.concat(runs, F.lit(".75")))
        .otherwise(runs)
    )
    wickets = F.when(eid % 199 == 0, F.lit("1e12")).otherwise((k % 10).cast("string")).alias("w")
    runs2 = F.when(eid % 113 == 0, F.lit("-2147483648")).otherwise(F.floor(F.col("value") / 2).cast("int").cast("string"))
    over2 = F.when(eid % 197 == 0, F.lit("Infinity")).when(eid % 193 == 0, F.lit("NaN")).otherwise(((k % 25) + F.lit(0.5)).cast("string"))
    first = F.struct(F.when(k % 9 != 0, runs).alias("r"), wickets, F.lit("20").alias("o"))
    second = F.struct(
        runs2.alias("r"),
        F.when(k % 4 != 0, (k % 7).cast("string")).alias("w"),
        over2.alias("o"),
    )
    first_only = F.struct(runs.alias("r"), wickets, F.lit("20").alias("o"))
    empty = F.filter(F.array(first), lambda _: F.lit(False))
    score = (
        F.when(et.isin("view", "purchase"), F.array(first, second))
        .when(et == "click", F.array(first_only))
        .when(et == "error", empty)
    )
    match = F.struct(
        F.concat(F.lit("m"), uid.cast("string")).alias("id"),
        status.alias("status"),
        F.when(uid % 4 != 0, F.concat(F.lit("Ground "), (uid % 9).cast("string"))).alias("venue"),
        team_info.alias("teamInfo"),
        score.alias("score"),
    )
    return e.select(F.col("ts").alias("fetched_at"), eid.alias("seq"), F.array(match).alias("data"))
