"""Schemas: the nested match document, the live snapshot payload and the
storage limits of the live current-state table."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_L = T.LongType()


def _f(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True)


# --- match document (one JSON document = one match) --------------------------
# The field names and nesting of the match documents.

WICKET = T.StructType([_f("player_out", _S), _f("kind", _S)])

RUNS = T.StructType([_f("batter", _L), _f("extras", _L), _f("total", _L)])

DELIVERY = T.StructType(
    [
        _f("batter", _S),
        _f("bowler", _S),
        _f("non_striker", _S),
        _f("runs", RUNS),
        _f("wickets", T.ArrayType(WICKET)),
    ]
)

OVER = T.StructType([_f("over", _L), _f("deliveries", T.ArrayType(DELIVERY))])

INNINGS = T.StructType([_f("team", _S), _f("overs", T.ArrayType(OVER))])

INFO = T.StructType(
    [
        _f("balls_per_over", _L),
        _f("city", _S),
        _f("dates", T.ArrayType(_S)),
        _f("gender", _S),
        _f("match_type", _S),
        _f(
            "outcome",
            T.StructType(
                [_f("winner", _S), _f("by", T.StructType([_f("runs", _L), _f("wickets", _L)]))]
            ),
        ),
        _f("overs", _L),
        _f("player_of_match", T.ArrayType(_S)),
        _f("season", _S),
        _f("team_type", _S),
        _f("teams", T.ArrayType(_S)),
        _f("toss", T.StructType([_f("decision", _S), _f("winner", _S)])),
        _f("venue", _S),
        _f("registry", T.StructType([_f("people", T.MapType(_S, _S))])),
    ]
)

META = T.StructType([_f("created", _S), _f("data_version", _S), _f("revision", _L)])

MATCH_DOCUMENT = T.StructType([_f("info", INFO), _f("innings", T.ArrayType(INNINGS)), _f("meta", META)])

CORRUPT_COLUMN = "_corrupt_record"

# The reader schema: the document plus the column PERMISSIVE mode fills with
# the raw text of a document that does not parse.
MATCH_DOCUMENT_READ = T.StructType(MATCH_DOCUMENT.fields + [_f(CORRUPT_COLUMN, _S)])


# --- live snapshot payload ------------------------------------------------------
# The field names of the feed's responses.

# Numbers as the feed sends them -- 142, 142.0 or "142" -- read as text, so that an
# unreadable one can be told from a missing one.
SCORE = T.StructType([_f("r", _S), _f("w", _S), _f("o", _S)])

LIVE_MATCH = T.StructType(
    [
        _f("id", _S),
        _f("status", _S),
        _f("venue", _S),
        _f("teamInfo", T.ArrayType(T.StructType([_f("name", _S)]))),
        _f("score", T.ArrayType(SCORE)),
    ]
)

# One landed API response. ``fetched_at`` / ``seq`` are added when the response
# is landed: the payload itself carries no time, and the current-state fold
# needs an order that a late file cannot break.
LIVE_RESPONSE = T.StructType(
    [_f("fetched_at", T.TimestampNTZType()), _f("seq", _L), _f("data", T.ArrayType(LIVE_MATCH))]
)

# The reader schema: with the raw text of a response that does not parse.
LIVE_RESPONSE_READ = T.StructType(LIVE_RESPONSE.fields + [_f(CORRUPT_COLUMN, _S)])


# --- storage limits of the live current-state table, cache lifetime ----------------
# Column widths and numeric precisions of the live_matches table as
# the reference declares them (a row that does not fit is not stored), and the
# lifetime of a cache entry in seconds.

VARCHAR_LIMITS = {
    "match_id": 100,
    "team1": 100,
    "team2": 100,
    "team1_score": 200,
    "team2_score": 200,
    "status": 200,
    "venue": 200,
    "winner": 100,
    "result_margin": 100,
}
CURRENT_OVER_DECIMAL = (4, 1)
REQUIRED_RATE_DECIMAL = (4, 2)
CACHE_TTL_SECONDS = 600
