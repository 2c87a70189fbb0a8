"""Expressions over one live match snapshot: state flags, score text, chase
arithmetic, winner and margin.  Each is a column expression, so the same code
serves a batch DataFrame and a streaming one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from crease.functions.core import col_or

# The status words, margin patterns, placeholder texts and the
# chase length that must equal the reference's for the same results.
ONGOING_WORDS = ("live", "in progress", "innings break", "batting", "bowling")
COMPLETED_WORDS = ("won", "complete", "finished", "result")
MARGIN_PATTERNS = (r"(\d+)\s+runs?", r"(\d+)\s+wickets?", r"(\d+)\s+balls?")
NOT_STARTED = "Not started"
YET_TO_BAT = "Yet to bat"
NO_SCORE = "0/0 (0.0)"
CHASE_OVERS = 20.0
LABEL_LIVE, LABEL_COMPLETED, LABEL_UPCOMING = "LIVE", "COMPLETED", "UPCOMING"


def _contains_any(text: Column, words) -> Column:
    return reduce(lambda acc, w: acc | text.contains(w), words[1:], text.contains(words[0]))


def is_ongoing(status: str | Column) -> Column:
    return _contains_any(F.lower(col_or(status)), ONGOING_WORDS)


def is_completed(status: str | Column) -> Column:
    return _contains_any(F.lower(col_or(status)), COMPLETED_WORDS)


def state_label(ongoing: str | Column, completed: str | Column) -> Column:
    """LIVE / COMPLETED / UPCOMING; ongoing takes precedence."""
    return (
        F.when(col_or(ongoing), F.lit(LABEL_LIVE))
        .when(col_or(completed), F.lit(LABEL_COMPLETED))
        .otherwise(F.lit(LABEL_UPCOMING))
    )


LARGEST_DOUBLE = 1.7976931348623157e308


def _entry_numbers(entry: Column) -> list[Column]:
    r, w, o = (entry[n].try_cast("double") for n in ("r", "w", "o"))
    return [r.try_cast("int"), w.try_cast("int"), F.when(o.between(-LARGEST_DOUBLE, LARGEST_DOUBLE), o)]


def score_summary(score: Column) -> Column:
    """What is read of a score array, as one struct: ``n`` entries, the numbers
    of the first two -- ``r`` and ``w`` int (a decimal loses its fraction), ``o``
    a finite double -- and ``unreadable``: whether one of these is there and is no
    such number."""
    entries = [F.get(score, 0), F.get(score, 1)]
    numbers = [_entry_numbers(e) for e in entries]
    bad = [e[name].isNotNull() & x.isNull() for e, xs in zip(entries, numbers) for name, x in zip("rwo", xs)]
    return F.struct(
        F.greatest(F.coalesce(F.size(score), F.lit(0)), F.lit(0)).alias("n"),
        *[x.alias(f"{name}{k}") for k, xs in enumerate(numbers, 1) for name, x in zip("rwo", xs)],
        F.coalesce(reduce(lambda x, y: x | y, bad), F.lit(False)).alias("unreadable"),
    )


def score_entry_text(score: Column, k: int) -> Column:
    """``r/w (o ov)`` of entry ``k`` when r, w and o are all present, else ``0/0 (0.0)``."""
    r, w, o = (score[f"{name}{k}"] for name in "rwo")
    text = F.concat(r.cast("string"), F.lit("/"), w.cast("string"), F.lit(" ("), o.cast("string"), F.lit(" ov)"))
    return F.coalesce(text, F.lit(NO_SCORE))


def score_texts(score: str | Column) -> tuple[Column, Column]:
    """(team1_score, team2_score) from a score summary.

    Missing or empty array: both ``Not started``; one entry: the second is
    ``Yet to bat``.
    """
    s = col_or(score)
    n = s["n"]
    t1 = F.when(n >= 1, score_entry_text(s, 1)).otherwise(F.lit(NOT_STARTED))
    t2 = F.when(n >= 2, score_entry_text(s, 2)).when(n >= 1, F.lit(YET_TO_BAT)).otherwise(F.lit(NOT_STARTED))
    return t1, t2


def current_over(score: str | Column) -> Column:
    """Overs of the second entry, else of the first, else 0.0."""
    s = col_or(score)
    return F.coalesce(s["o2"], s["o1"], F.lit(0.0))


def chase(score: str | Column) -> tuple[Column, Column]:
    """(target, required_rate).

    Only with two entries and a first-innings total: target = r1 + 1 and
    rate = (target - r2) / (20 - o2) when the divisor is positive, else 0.0
    (missing r2 / o2 count as 0).  Otherwise (0, 0.0).  No clamp: the rate can
    be zero or negative once the chase is over.  Runs are added as bigint, so
    that no score overflows.
    """
    s = col_or(score)
    applies = (s["n"] >= 2) & s["r1"].isNotNull()
    target = s["r1"].cast("bigint") + F.lit(1)
    runs2 = F.coalesce(s["r2"], F.lit(0)).cast("bigint")
    remaining = F.lit(CHASE_OVERS) - F.coalesce(s["o2"], F.lit(0.0))
    rate = F.when(remaining > 0, (target - runs2).cast("double") / remaining).otherwise(F.lit(0.0))
    return (
        F.when(applies, target).otherwise(F.lit(0).cast("bigint")),
        F.when(applies, rate).otherwise(F.lit(0.0)),
    )


def last_word(name: str | Column) -> Column:
    """Last space-separated word, lower-cased.  Trailing spaces are trimmed
    first because a JVM ``split`` drops trailing empty pieces."""
    return F.element_at(F.split(F.rtrim(F.lower(col_or(name))), " "), -1)


def margin(status: str | Column) -> Column:
    """First hit of the runs / wickets / balls patterns on the lower-cased
    status, tried in that order; the status itself when none matches."""
    low = F.lower(col_or(status))
    hits = [F.nullif(F.regexp_extract(low, p, 0), F.lit("")) for p in MARGIN_PATTERNS]
    return F.coalesce(*hits, col_or(status))


def result(status: str | Column, team1: str | Column, team2: str | Column, completed: Column) -> tuple[Column, Column]:
    """(winner, result_margin).

    Completed and the status says "won": the team whose last name-word the
    status contains (team1 checked first) with its margin; no team found: ""
    and the status.  Completed otherwise: "" and the status.  Not completed:
    "" and "".
    """
    st = col_or(status)
    low = F.lower(st)
    won = low.contains("won")
    t1_hit = won & low.contains(last_word(team1))
    t2_hit = won & low.contains(last_word(team2))
    winner = (
        F.when(~completed, F.lit(""))
        .when(t1_hit, col_or(team1))
        .when(t2_hit, col_or(team2))
        .otherwise(F.lit(""))
    )
    result_margin = (
        F.when(~completed, F.lit(""))
        .when(t1_hit | t2_hit, margin(st))
        .otherwise(st)
    )
    return winner, result_margin
