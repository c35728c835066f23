"""Delivery text parsing as pure Column expressions (no Python worker).

Every function maps Columns to a Column, so the same code serves batch and
streaming DataFrames and stays inside whole-stage codegen. Text-to-number
steps use the ``try_`` forms: malformed text becomes NULL (and is counted by
the quality rules) instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake import constants as K


def _event_group(event: Column, index: int) -> Column:
    return F.trim(F.regexp_extract(event, K.EVENT_PATTERN, index))


def bowler_text(event: Column) -> Column:
    """Bowler as written in "<bowler> to <batsman>, <outcome>"; '' when the text does not match."""
    return _event_group(event, 1)


def batsman_text(event: Column) -> Column:
    return _event_group(event, 2)


def outcome_text(event: Column) -> Column:
    """Outcome part with the "(no ball)" tag removed, trimmed."""
    return F.trim(F.regexp_replace(_event_group(event, 3), K.NO_BALL_TAG, ""))


def extras_class(outcome: Column, event: Column) -> Column:
    """First match wins: wide, no-ball (tested on the whole event), leg byes, byes, else normal."""
    return (
        F.when(outcome.contains("wide"), K.EXTRAS_WIDE)
        .when(event.contains("no ball"), K.EXTRAS_NOBALL)
        .when(outcome.contains("leg bye"), K.EXTRAS_LEGBYES)
        .when(outcome.contains("bye"), K.EXTRAS_BYES)
        .otherwise(K.EXTRAS_NORMAL)
    )


def _ball_part(ball: Column, index: int) -> Column:
    return F.get(F.split(ball.cast("string"), r"\."), index).try_cast("int")


def over_number(ball: Column) -> Column:
    """1-based over from "<completed overs>.<ball>"; NULL when not a number."""
    return _ball_part(ball, 0) + F.lit(1)


def ball_in_over(ball: Column) -> Column:
    return _ball_part(ball, 1)


def runs_scored(outcome: Column, extras: Column) -> Column:
    """Runs of the delivery, plus the one-run penalty on a no-ball.

    Only the exact words below and leading digits are understood, so
    "OUT, 1 run" scores 0 and a bare "SIX" scores 0.
    """
    base = (
        F.when(outcome == "OUT", F.lit(0))
        .when(outcome.isin("no run", ""), F.lit(0))
        .when(outcome == "FOUR runs", F.lit(4))
        .when(outcome == "SIX runs", F.lit(6))
        .when(outcome.rlike(r"^\d+"), F.regexp_extract(outcome, K.LEADING_DIGITS, 1).try_cast("int"))
        .otherwise(F.lit(0))
    )
    return F.when(extras == K.EXTRAS_NOBALL, base + F.lit(1)).otherwise(base)


# Dismissal kinds, in the order the rules are tried. Index 0 is "not out".
_DISMISSAL_RULES = (
    (K.RUN_OUT, K.RUN_OUT_MATCH, K.RUN_OUT_BY),
    (K.CAUGHT_AND_BOWLED, K.CAUGHT_AND_BOWLED_MATCH, K.CAUGHT_AND_BOWLED_BY),
    (K.CAUGHT, K.CAUGHT_MATCH, K.CAUGHT_BY),
    (K.LBW, K.LBW_MATCH, K.LBW_BY),
    (K.STUMPED, K.STUMPED_MATCH, K.STUMPED_BY),
    (K.BOWLED, K.BOWLED_MATCH, K.BOWLED_BY),
)


def dismissal_kind(outcome: Column, commentary: Column) -> Column:
    """0 = not out, else 1-based index into the rule list.

    Rules apply only when the outcome contains "OUT"; a NULL outcome does not
    stop the chain, so the commentary still decides (kept on purpose).
    """
    expr = F.when(~outcome.contains("OUT"), F.lit(0))
    for i, (_, match, _) in enumerate(_DISMISSAL_RULES, start=1):
        expr = expr.when(commentary.rlike(match), F.lit(i))
    return expr.otherwise(F.lit(0))


def dismissal_method(kind: Column) -> Column:
    labels = [K.NOT_OUT] + [label for label, _, _ in _DISMISSAL_RULES]
    return F.element_at(F.array(*[F.lit(x) for x in labels]), kind + F.lit(1))


def dismissed_by(kind: Column, commentary: Column) -> Column:
    """Fielder/bowler credited, keeper mark removed; NULL when not out."""
    expr = None
    for i, (_, _, extract) in enumerate(_DISMISSAL_RULES, start=1):
        branch = F.regexp_extract(commentary, extract, 1)
        expr = F.when(kind == i, branch) if expr is None else expr.when(kind == i, branch)
    return F.trim(F.regexp_replace(expr, K.KEEPER_MARK, ""))


def super_over_label(team: Column) -> Column:
    """The team label itself for super-over innings, otherwise "normal" (NULL team -> normal)."""
    return F.when(team.contains(K.SUPER_OVER), team).otherwise(F.lit(K.NORMAL_INNINGS))


def toss_winner(toss: Column) -> Column:
    return F.trim(F.get(F.split(toss, ","), 0))


def toss_decision(toss: Column) -> Column:
    return F.trim(F.get(F.split(toss, ","), 1))


def result_winner(result: Column) -> Column:
    return F.regexp_extract(result, K.WINNER_PATTERN, 1)


def result_margin(result: Column) -> Column:
    return F.regexp_extract(result, K.MARGIN_PATTERN, 1)


def result_type(result: Column) -> Column:
    """First substring match on the lower-cased text ("run" is tested first, so
    "Brunei won by 5 wickets" is "by runs"); NULL text is "other"."""
    low = F.lower(result)
    expr = None
    for needle, label in K.RESULT_TYPES:
        expr = F.when(low.contains(needle), label) if expr is None else expr.when(low.contains(needle), label)
    return expr.otherwise(K.RESULT_OTHER)
