"""Silver datasets: de-duplicated line-ups, enriched metadata, parsed deliveries.

Each function takes a bronze DataFrame that may be batch or streaming; the
static inputs (line-ups snapshot, zone dimension) are batch DataFrames and are
joined stream-static. Nothing is collected and no Python worker is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.functions import clock, names, parse
from pitchlake.operators import lookups

PLAYER_KEYS = ("matchid", "player_name", "team")
METADATA_KEYS = ("matchid",)


def deduplicate(df: DataFrame, keys: Sequence[str], watermark: str | None = None,
                event_time: str = "load_timestamp") -> DataFrame:
    """First arrival per key.

    Without ``watermark`` the streaming state keeps every key for ever (exact,
    unbounded state; use the RocksDB state store). With a delay such as
    "2 days", keys are forgotten once the watermark passes them.
    """
    if watermark and df.isStreaming:
        return df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def as_bronze(feed: DataFrame, run_id: str = "fixture", source: str | None = None) -> DataFrame:
    """Adds the bronze provenance columns to a feed that was not read from files."""
    return feed.select(
        F.lit(run_id).alias("Batchid"),
        *feed.columns,
        F.lit(source).cast("string").alias("source_file"),
        F.current_timestamp().alias("load_timestamp"),
    )


def silver_players(bronze_players: DataFrame, watermark: str | None = None) -> DataFrame:
    df = deduplicate(bronze_players, PLAYER_KEYS, watermark)
    return df.select(*schemas.SILVER_PLAYERS_COLUMNS, F.current_timestamp().alias("silver_load_timestamp"))


def enrich_metadata(metadata: DataFrame, zones: DataFrame) -> DataFrame:
    """Toss split, match date, local zone and the five UTC session times."""
    df = metadata.withColumns({
        "toss": parse.toss_winner(F.col("toss")),
        "decision": parse.toss_decision(F.col("toss")),
        "match_date": clock.match_date(F.col("match_days")),
    })
    df = lookups.with_local_timezone(df, zones)
    return df.withColumns(
        clock.session_columns(F.col("hours_of_play_local_time"), F.col("match_date"), F.col("local_timezone"))
    )


def resolve_innings_teams(metadata: DataFrame, players: DataFrame | None = None,
                          lists: DataFrame | None = None) -> DataFrame:
    """first/second innings abbreviations -> team names listed for the match.

    ``lists`` (from ``lookups.match_name_lists``) may be passed precomputed,
    e.g. a table written once per streaming run, instead of ``players``.
    """
    teams = (lookups.match_team_lists(players) if lists is None
             else lookups.by_merge(lists.select("matchid", "team_index")))
    df = lookups.join_lookup(metadata, teams, "matchid", "left")
    return names.resolve_columns(df, {
        "first_innings": ("first_innings", "team_index"),
        "second_innings": ("second_innings", "team_index"),
    }).drop("team_index")


def silver_metadata(bronze_metadata: DataFrame, players: DataFrame | None, zones: DataFrame,
                    lists: DataFrame | None = None) -> DataFrame:
    # exact, without a watermark: a second row of a match would multiply its gold rows
    df = deduplicate(bronze_metadata, METADATA_KEYS)
    df = resolve_innings_teams(enrich_metadata(df, zones), players, lists)
    return df.select(*schemas.SILVER_METADATA_COLUMNS, F.current_timestamp().alias("silver_load_timestamp"))


def parse_deliveries(events: DataFrame) -> DataFrame:
    """Adds parsed short names, outcome, extras, over/ball, runs and dismissal columns.

    The short names go to ``bowler_short`` / ``batsman_short`` so they never
    clash (case-insensitively) with the raw ``bowler`` / ``batsman`` columns.
    """
    ev = F.col("event")
    df = events.withColumns({
        "bowler_short": parse.bowler_text(ev),
        "batsman_short": parse.batsman_text(ev),
        "runs_text": parse.outcome_text(ev),
    })
    df = df.withColumns({
        "Extras": parse.extras_class(F.col("runs_text"), ev),
        "over": parse.over_number(F.col("ball")),
        "over_ball_number": parse.ball_in_over(F.col("ball")),
        "_kind": parse.dismissal_kind(F.col("runs_text"), F.col("commentary")),
    })
    return df.withColumns({
        "runs": parse.runs_scored(F.col("runs_text"), F.col("Extras")),
        "dismissal_method": parse.dismissal_method(F.col("_kind")),
        "dismissed_by": parse.dismissed_by(F.col("_kind"), F.col("commentary")),
    }).drop("_kind")


def resolve_delivery_names(parsed: DataFrame, players: DataFrame | None = None,
                           lists: DataFrame | None = None, null_keys_bypass: bool = True) -> DataFrame:
    """Team, batsman and bowler resolved against the match's line-up lists.

    Left join on matchid: a delivery whose match has no line-up keeps its short
    names. The list side is one row per match; the planner broadcasts it or merges on
    matchid by its size (written ``lists`` are always merged), which then also clusters the
    deliveries for the per-match aggregates downstream.
    """
    if lists is None:
        lists = lookups.match_name_lists(players).select("matchid", "team_index", "player_index")
    else:
        lists = lookups.by_merge(lists.select("matchid", "team_index", "player_index"))
    if null_keys_bypass:
        # Rows without a matchid can never match a list. Routing them around the
        # join keeps them out of one hot shuffle partition when the join is a
        # sort-merge join (a broken path can leave a large share of rows NULL).
        keyed = lookups.join_lookup(parsed.where(F.col("matchid").isNotNull()), lists, "matchid", "left")
        unkeyed = parsed.where(F.col("matchid").isNull()).select(
            *parsed.columns,
            F.lit(None).cast(lists.schema["team_index"].dataType).alias("team_index"),
            F.lit(None).cast(lists.schema["player_index"].dataType).alias("player_index"))
        df = keyed.unionByName(unkeyed)
    else:
        df = lookups.join_lookup(parsed, lists, "matchid", "left")
    df = names.resolve_columns(df, {
        "team": ("innings", "team_index"),
        "batsman_resolved": ("batsman_short", "player_index"),
        "bowler_resolved": ("bowler_short", "player_index"),
    })
    return df.withColumn("super_over_team", parse.super_over_label(F.col("team"))).drop(
        "team_index", "player_index")


def silver_events(bronze_events: DataFrame, players: DataFrame | None, lists: DataFrame | None = None,
                  null_keys_bypass: bool = True) -> DataFrame:
    df = resolve_delivery_names(parse_deliveries(bronze_events), players, lists, null_keys_bypass)
    df = df.drop("bowler", "batsman").withColumnsRenamed(
        {"bowler_resolved": "bowler", "batsman_resolved": "batsman"})
    return df.select(*schemas.SILVER_EVENTS_COLUMNS, F.current_timestamp().alias("silver_load_timestamp"))
