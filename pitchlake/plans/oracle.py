"""SQL oracles (DuckDB dialect) for the registered queries.

Written from the dataset definitions, not generated from the Spark plans:
the fixture feeds, the parsing rules and every aggregate are restated in SQL
over the pre-registered ``events`` view. Streaming queries are checked
against the batch SQL of the same result (provenance reduced to the
``matchid=<n>`` directory).
"""

from __future__ import annotations

from pitchlake import constants as K
from pitchlake import schemas
from pitchlake.sources import proxies as P


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _pick(values, idx: str) -> str:
    return f"list_extract({_list(values)}, CAST(({idx}) AS BIGINT) + 1)"


# --------------------------------------------------------------------------- fixture feeds

def _player_sql(team: str, slot: str, s: str) -> tuple[str, str]:
    x = f"(CASE WHEN {slot} = 5 THEN ({team} + {s}) % 8 ELSE {team} END)"
    return _pick(P.FIRST_NAMES, f"({x} * 5 + {slot}) % 12"), _pick(P.LAST_NAMES, f"({x} * 3 + {slot}) % 13")


def _deliveries_cte() -> str:
    bf, bl = _player_sql("tb", "bs", "s")
    wf, wl = _player_sql("tw", "ws", "s")
    outcome = (f"CASE WHEN (m * 7 + ov + i) % 11 = 0 THEN 'no run' WHEN star THEN 'SIX runs' "
               f"WHEN m % 4 = 3 AND i = 0 AND ov % 5 = 2 AND q % 2 = 1 THEN 'OUT' "
               f"ELSE {_pick(P.OUTCOMES, '(event_id * 31 + user_id) % 24')} END")
    wicket = (
        "CASE (event_id // 24) % 8 "
        "WHEN 0 THEN bl || ' c Root b ' || wl || ' 12 (9b)' "
        "WHEN 1 THEN bl || ' b ' || wl || ' 7 (5b)' "
        "WHEN 2 THEN bl || ' lbw b ' || wl || ' 3 (4b)' "
        "WHEN 3 THEN bl || ' st †Azam b ' || wl || ' 20 (18b)' "
        "WHEN 4 THEN bl || ' run out (Curran/†Azam) 8 (6b)' "
        "WHEN 5 THEN bl || ' c & b ' || wl || ' 31 (22b)' "
        "WHEN 6 THEN bl || ' hit wicket b ' || wl || ' 2 (3b)' "
        "ELSE bl || ' retired out 40 (30b)' END"
    )
    return f"""
px_d1 AS (
  SELECT event_id, user_id, event_id // 240 AS m, event_id % 240 AS k FROM events
),
px_d2 AS (
  SELECT *, k // 120 AS i, k % 120 AS q, m % 8 AS t0, (m + 3) % 8 AS t1, m // 4 AS s FROM px_d1
),
px_d3 AS (
  SELECT *, q // 6 AS ov, (m % 5 = 0 AND q >= 114) AS so,
         CASE WHEN i = 0 THEN t0 ELSE t1 END AS tb, CASE WHEN i = 0 THEN t1 ELSE t0 END AS tw,
         (m % 4 = 2 AND ((i = 0 AND q % 4 = 0) OR (i = 1 AND q % 12 = 0))) AS star,
         CASE WHEN star THEN 3 ELSE (q // 7 + event_id) % 11 END AS bs, (q // 6) % 5 + 6 AS ws
  FROM px_d2
),
px_d4 AS (
  SELECT *, {bf} AS bf, {bl} AS bl, {wf} AS wf, {wl} AS wl, {outcome} AS outcome, event_id % 4 AS form
  FROM px_d3
),
px_d5 AS (
  SELECT *,
    CASE form WHEN 0 THEN bf || ' ' || bl WHEN 1 THEN bl WHEN 2 THEN left(bf, 1) || left(bl, 1) ELSE bf END AS bat_short,
    CASE form WHEN 0 THEN wl WHEN 1 THEN wf || ' ' || wl WHEN 2 THEN wf ELSE left(wf, 1) || left(wl, 1) END AS bowl_short
  FROM px_d4
),
px_deliveries AS (
  SELECT
    CAST(k + 1 AS BIGINT) AS match_ball_number,
    (CASE WHEN so THEN '0' ELSE CAST(ov AS VARCHAR) END) || '.' || CAST(q % 6 + 1 AS VARCHAR) AS ball,
    CASE WHEN event_id % 193 = 1 THEN CAST(NULL AS VARCHAR)
         WHEN event_id % 97 = 0 THEN 'Drinks break'
         ELSE bowl_short || ' to ' || bat_short || ', ' || outcome END AS event,
    CASE WHEN outcome = 'OUT' THEN {wicket} ELSE {_q(P.NOT_OUT_COMMENTARY)} END AS commentary,
    bowl_short AS bowler,
    bat_short AS batsman,
    {_pick(P.TEAM_CODES, 'tb')} || CASE WHEN so THEN ' Super Over' ELSE '' END AS innings,
    CAST(1000 + m AS BIGINT) AS matchid,
    so AS is_super_over
  FROM px_d5
)"""


def _players_cte() -> str:
    first, last = _player_sql("t", "p", "s")
    return f"""
px_m AS (SELECT DISTINCT event_id // 240 AS m FROM events),
px_slots AS (
  SELECT m, side, p, CASE WHEN side = 0 THEN m % 8 ELSE (m + 3) % 8 END AS t, m // 4 AS s
  FROM px_m, (SELECT unnest([0, 1]) AS side) AS sides, (SELECT unnest(range(11)) AS p) AS slots
),
px_players AS (
  SELECT CAST(1000 + m AS BIGINT) AS matchid,
         {_pick(P.TEAM_CODES, 't')} AS innings,
         {_pick(P.TEAM_NAMES, 't')} AS team,
         {first} || ' ' || {last} AS player_name,
         p < 8 AS batted,
         CAST(p + 1 AS INTEGER) AS batting_position,
         {_pick(P.PLAYER_TYPES, 'p % 4')} AS player_type,
         'False' AS retired,
         'False' AS not_out,
         CASE WHEN p >= 6 THEN 'True' ELSE 'False' END AS bowled
  FROM px_slots
)"""


def _metadata_cte() -> str:
    t0n, t1n = _pick(P.TEAM_NAMES, "t0"), _pick(P.TEAM_NAMES, "t1")
    return f"""
px_mm AS (SELECT m, m % 8 AS t0, (m + 3) % 8 AS t1 FROM (SELECT DISTINCT event_id // 240 AS m FROM events) WHERE m % 13 <> 12),
px_metadata AS (
  SELECT
    {_pick(P.GROUNDS, 'm % 6')} AS ground,
    CASE WHEN m % 9 = 4 THEN {t0n} ELSE {t0n} || ', elected to field first' END AS toss,
    'Series ' || CAST(m // 6 AS VARCHAR) AS series,
    CAST(2020 + m // 12 AS VARCHAR) AS season,
    'Player ' || CAST(m % 17 AS VARCHAR) AS player_of_the_match,
    'Player ' || CAST((m // 6) % 17 AS VARCHAR) AS player_of_the_series,
    CASE WHEN m % 7 = 6 THEN CAST(NULL AS VARCHAR) WHEN m % 3 = 1 THEN {_q(P.HOURS_MORNING)}
         ELSE {_q(P.HOURS_EVENING)} END AS hours_of_play_local_time,
    CASE WHEN m % 11 = 10 THEN CAST(NULL AS VARCHAR) WHEN m % 11 = 9 THEN 'date unknown'
         ELSE strftime(DATE '2020-01-05' + CAST(9 * m AS INTEGER), '%-d %B %Y') || ' - night (20-over match)'
    END AS match_days,
    'None' AS t20_debut,
    'None' AS t20i_debut,
    'Umpire ' || CAST(m % 5 AS VARCHAR) || ', Umpire ' || CAST((m + 1) % 5 AS VARCHAR) AS umpires,
    'Umpire ' || CAST((m + 2) % 5 AS VARCHAR) AS tv_umpire,
    'Umpire ' || CAST((m + 3) % 5 AS VARCHAR) AS reserve_umpire,
    'Referee ' || CAST(m % 3 AS VARCHAR) AS match_referee,
    {t0n} || ' 2, ' || {t1n} || ' 0' AS points,
    'T20I no. ' || CAST(1000 + m AS VARCHAR) AS match_number,
    CAST(1000 + m AS BIGINT) AS matchid,
    CAST(NULL AS VARCHAR) AS player_replacements,
    {_pick(P.TEAM_CODES, 't0')} AS first_innings,
    {_pick(P.TEAM_CODES, 't1')} AS second_innings,
    m % 5 = 0 AS has_super_over,
    CAST(CASE WHEN m % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS super_over_count,
    CASE m % 8
      WHEN 0 THEN {t0n} || ' won by 20 runs'
      WHEN 1 THEN {t1n} || ' won by 5 wickets'
      WHEN 2 THEN 'Match tied (' || {t0n} || ' won the Super Over)'
      WHEN 3 THEN 'No result'
      WHEN 4 THEN 'Match tied'
      WHEN 5 THEN 'Brunei won by 5 wickets'
      WHEN 6 THEN CAST(NULL AS VARCHAR)
      ELSE 'Abandoned' END AS series_result
  FROM px_mm
)"""


def _zones_cte() -> str:
    rows = ", ".join(f"({_q(g)}, {_q(z)})" for g, z in P.ZONES)
    return f"px_zones AS (SELECT * FROM (VALUES {rows}) AS z(ground, local_timezone))"


# --------------------------------------------------------------------------- rules restated in SQL

def _parse_cte(source: str = "px_deliveries", name: str = "px_parsed") -> str:
    ev = _q(K.EVENT_PATTERN)
    kinds = [
        (K.RUN_OUT_MATCH, K.RUN_OUT_BY), (K.CAUGHT_AND_BOWLED_MATCH, K.CAUGHT_AND_BOWLED_BY),
        (K.CAUGHT_MATCH, K.CAUGHT_BY), (K.LBW_MATCH, K.LBW_BY),
        (K.STUMPED_MATCH, K.STUMPED_BY), (K.BOWLED_MATCH, K.BOWLED_BY),
    ]
    kind = "CASE WHEN NOT contains(runs_text, 'OUT') THEN 0 " + " ".join(
        f"WHEN regexp_matches(commentary, {_q(m)}) THEN {i}" for i, (m, _) in enumerate(kinds, 1)) + " ELSE 0 END"
    by = "CASE kind " + " ".join(
        f"WHEN {i} THEN regexp_extract(commentary, {_q(x)}, 1)" for i, (_, x) in enumerate(kinds, 1)) + " END"
    methods = [K.NOT_OUT, K.RUN_OUT, K.CAUGHT_AND_BOWLED, K.CAUGHT, K.LBW, K.STUMPED, K.BOWLED]
    return f"""
{name}_1 AS (
  SELECT *,
    trim(regexp_extract(event, {ev}, 1)) AS bowler_short,
    trim(regexp_extract(event, {ev}, 2)) AS batsman_short,
    trim(regexp_replace(trim(regexp_extract(event, {ev}, 3)), {_q(K.NO_BALL_TAG)}, '', 'g')) AS runs_text
  FROM {source}
),
{name}_2 AS (
  SELECT *,
    CASE WHEN contains(runs_text, 'wide') THEN 'wide' WHEN contains(event, 'no ball') THEN 'noball'
         WHEN contains(runs_text, 'leg bye') THEN 'legbyes' WHEN contains(runs_text, 'bye') THEN 'byes'
         ELSE 'normal' END AS Extras,
    TRY_CAST(split_part(CAST(ball AS VARCHAR), '.', 1) AS INTEGER) + 1 AS over,
    TRY_CAST(split_part(CAST(ball AS VARCHAR), '.', 2) AS INTEGER) AS over_ball_number,
    CASE WHEN runs_text = 'OUT' THEN 0 WHEN runs_text IN ('no run', '') THEN 0
         WHEN runs_text = 'FOUR runs' THEN 4 WHEN runs_text = 'SIX runs' THEN 6
         WHEN regexp_matches(runs_text, '^\\d+') THEN TRY_CAST(regexp_extract(runs_text, '^(\\d+)', 1) AS INTEGER)
         ELSE 0 END AS base_runs,
    {kind} AS kind
  FROM {name}_1
),
{name} AS (
  SELECT * EXCLUDE (base_runs, kind),
    CASE WHEN Extras = 'noball' THEN base_runs + 1 ELSE base_runs END AS runs,
    {_pick(methods, 'kind')} AS dismissal_method,
    trim(regexp_replace({by}, {_q(K.KEEPER_MARK)}, '', 'g')) AS dismissed_by
  FROM {name}_2
)"""


def _resolve(short: str, names: str) -> str:
    """SQL form of the name resolver for a short-name expression and a sorted name list."""
    abbr = f"regexp_replace({short}, '^\\s+|\\s+$', '', 'g')"
    up = f"upper({abbr})"
    nw = f"len(list_filter(string_split_regex({abbr}, '\\s+'), lambda w: w <> ''))"
    parts = "list_filter(string_split_regex(n, '\\s+'), lambda w: w <> '')"
    initials = f"upper(array_to_string(list_transform({parts}, lambda w: left(w, 1)), ''))"
    upper_initials = (f"upper(array_to_string(list_transform(list_filter({parts}, lambda w: "
                      f"upper(left(w, 1)) = left(w, 1) AND lower(left(w, 1)) <> left(w, 1)), "
                      f"lambda w: left(w, 1)), ''))")
    last = f"upper(list_extract({parts}, len({parts})))"
    tail = (f"upper(array_to_string(list_slice({parts}, len({parts}) - {nw} + 1, len({parts})), ' '))")
    cond = (
        f"({up} = {initials}) OR ({up} = {upper_initials} AND {upper_initials} <> {initials}) "
        f"OR (length({abbr}) >= 2 AND {nw} = 1 AND starts_with(upper(n), {up})) "
        f"OR ({nw} = 1 AND {up} = {last}) "
        f"OR ({nw} >= 2 AND len({parts}) > {nw} AND {tail} = {up})"
    )
    known = "CASE " + up + " " + " ".join(
        f"WHEN {_q(k)} THEN {_q(v)}" for k, v in K.TEAM_ABBREVIATIONS.items()) + " END"
    return (
        f"(CASE WHEN {short} IS NULL OR {short} = '' THEN {short} "
        f"WHEN {names} IS NULL OR len({names}) = 0 THEN {short} "
        f"WHEN list_contains({names}, {short}) OR contains({short}, 'Super Over') THEN {short} "
        f"ELSE coalesce(list_filter({names}, lambda n: upper(n) = upper({known}))[1], "
        f"list_filter({names}, lambda n: {cond})[1], {short}) END)"
    )


def _name_lists_cte(players: str = "px_players") -> str:
    return f"""
px_lists AS (
  SELECT matchid,
         list_sort(list(DISTINCT team) FILTER (WHERE team IS NOT NULL)) AS team_names,
         list_sort(list(DISTINCT player_name) FILTER (WHERE player_name IS NOT NULL)) AS player_names
  FROM {players} WHERE matchid IS NOT NULL GROUP BY matchid
)"""


def _silver_events_cte(source: str = "px_deliveries") -> str:
    return _parse_cte(source, "px_parsed") + "," + _name_lists_cte() + f""",
px_resolved AS (
  SELECT d.*,
    {_resolve('d.innings', 'l.team_names')} AS team,
    {_resolve('d.batsman_short', 'l.player_names')} AS batsman_resolved,
    {_resolve('d.bowler_short', 'l.player_names')} AS bowler_resolved
  FROM px_parsed AS d LEFT JOIN px_lists AS l ON d.matchid = l.matchid
),
px_silver_events AS (
  SELECT * EXCLUDE (bowler, batsman, batsman_resolved, bowler_resolved),
    bowler_resolved AS bowler, batsman_resolved AS batsman,
    CASE WHEN contains(team, 'Super Over') THEN team ELSE 'normal' END AS super_over_team
  FROM px_resolved
)"""


def _utc(pattern: str) -> str:
    t = f"trim(regexp_extract(hours_of_play_local_time, {_q(pattern)}, 1))"
    local = (f"CASE WHEN {t} <> '' THEN try_strptime(strftime(match_date, '%Y-%m-%d') || ' ' || {t}, "
             f"'%Y-%m-%d %H.%M') END")
    return f"timezone('UTC', timezone(local_timezone, {local}))"


def _silver_metadata_cte(source: str = "px_metadata") -> str:
    sessions = ",\n    ".join(f"{_utc(p)} AS {name}" for name, p in K.SESSION_PATTERNS)
    return _zones_cte() + f""",
px_meta_1 AS (
  SELECT m.* EXCLUDE (toss),
    trim(string_split(m.toss, ',')[1]) AS toss,
    CASE WHEN len(string_split(m.toss, ',')) >= 2 THEN trim(string_split(m.toss, ',')[2]) END AS decision,
    CAST(try_strptime(trim(regexp_extract(m.match_days, {_q(K.MATCH_DATE_PATTERN)}, 1)), '%d %B %Y') AS DATE) AS match_date,
    coalesce(z.local_timezone, 'UTC') AS local_timezone
  FROM {source} AS m LEFT JOIN px_zones AS z ON m.ground = z.ground
),
px_meta_2 AS (
  SELECT *,
    {sessions}
  FROM px_meta_1
),
px_team_lists AS (
  SELECT matchid, list_sort(list(DISTINCT team) FILTER (WHERE team IS NOT NULL)) AS team_names
  FROM px_players WHERE matchid IS NOT NULL GROUP BY matchid
),
px_silver_metadata AS (
  SELECT p.* EXCLUDE (first_innings, second_innings),
    {_resolve('p.first_innings', 'l.team_names')} AS first_innings,
    {_resolve('p.second_innings', 'l.team_names')} AS second_innings
  FROM px_meta_2 AS p LEFT JOIN px_team_lists AS l ON p.matchid = l.matchid
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _base(*parts: str) -> str:
    return _with(_deliveries_cte(), _players_cte(), _metadata_cte(), *parts)


def _round(expr: str, digits: int) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def _strike(runs: str, balls: str) -> str:
    return f"CASE WHEN {balls} > 0 THEN {_round(f'{runs} / {balls} * 100', 2)} ELSE 0.0 END"


def _average(runs: str, outs: str) -> str:
    return f"CASE WHEN {outs} > 0 THEN {_round(f'{runs} / {outs}', 2)} ELSE CAST({runs} AS DOUBLE) END"


def _overs(legal: str) -> str:
    return _round(f"floor({legal} / 6) + ({legal} % 6) / 10", 1)


def _economy(runs: str, legal: str) -> str:
    return f"CASE WHEN {legal} > 0 THEN {_round(f'{runs} / ({legal} / 6)', 2)} ELSE 0.0 END"


def _per_wicket(num: str, wk: str) -> str:
    return f"CASE WHEN {wk} > 0 THEN {_round(f'{num} / {wk}', 2)} ELSE CAST(NULL AS DOUBLE) END"


def _i64(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _count_if(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


# --------------------------------------------------------------------------- gold SQL

_BATTING_MATCH = """
bat_flags AS (
  SELECT matchid, batsman, team,
    CASE WHEN Extras IN ('legbyes', 'byes', 'wide') THEN 0 ELSE runs END AS batsman_runs,
    CASE WHEN Extras = 'wide' THEN 0 ELSE 1 END AS ball_faced,
    dismissal_method <> 'Not Out' AS dismissed
  FROM px_silver_events
),
bat_agg AS (
  SELECT matchid, batsman, team,
    CAST(sum(ball_faced) AS BIGINT) AS balls_faced,
    CAST(sum(batsman_runs) AS BIGINT) AS total_runs,
    {dots} AS dot_balls,
    {r1} AS runs_1s, {r2} AS runs_2s, {r3} AS runs_3s, {r4} AS runs_4s, {r5} AS runs_5s, {r6} AS runs_6s,
    {outs} AS times_dismissed
  FROM bat_flags GROUP BY matchid, batsman, team
),
batting_match AS (
  SELECT a.matchid, m.series, m.season, a.batsman, a.team, a.balls_faced, a.total_runs,
    {strike} AS strike_rate,
    a.dot_balls, a.runs_1s, a.runs_2s, a.runs_3s, a.runs_4s, a.runs_5s, a.runs_6s,
    a.times_dismissed = 0 AS not_out, a.times_dismissed
  FROM bat_agg AS a LEFT JOIN px_silver_metadata AS m ON a.matchid = m.matchid
)""".format(
    dots=_count_if("batsman_runs = 0"),
    r1=_count_if("batsman_runs = 1"), r2=_count_if("batsman_runs = 2"), r3=_count_if("batsman_runs = 3"),
    r4=_count_if("batsman_runs = 4"), r5=_count_if("batsman_runs = 5"), r6=_count_if("batsman_runs >= 6"),
    outs=_count_if("dismissed"),
    strike=_strike("a.total_runs", "a.balls_faced"),
)

_RUNS = ("runs_1s", "runs_2s", "runs_3s", "runs_4s", "runs_5s", "runs_6s")

_BATTING_SERIES = """
batting_series_agg AS (
  SELECT series, season, batsman,
    CAST(count(DISTINCT matchid) AS BIGINT) AS matches_played,
    CAST(sum(balls_faced) AS BIGINT) AS total_balls_faced,
    CAST(sum(total_runs) AS BIGINT) AS total_runs,
    CAST(sum(dot_balls) AS BIGINT) AS dot_balls,
    {runs},
    {g30} AS scores_gte_30, {g50} AS scores_gte_50, {g100} AS scores_gte_100,
    {no} AS not_out_count,
    CAST(sum(times_dismissed) AS BIGINT) AS total_dismissals
  FROM batting_match GROUP BY series, season, batsman
),
batting_series AS (
  SELECT series, season, batsman, matches_played, total_balls_faced, total_runs,
    {strike} AS strike_rate, {avg} AS batting_average,
    dot_balls, runs_1s, runs_2s, runs_3s, runs_4s, runs_5s, runs_6s,
    scores_gte_30, scores_gte_50, scores_gte_100, not_out_count, total_dismissals
  FROM batting_series_agg
)""".format(
    runs=", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _RUNS),
    g30=_count_if("total_runs >= 30"), g50=_count_if("total_runs >= 50"), g100=_count_if("total_runs >= 100"),
    no=_count_if("not_out"),
    strike=_strike("total_runs", "total_balls_faced"), avg=_average("total_runs", "total_dismissals"),
)

_BATTING_OVERALL = """
batting_overall_agg AS (
  SELECT batsman,
    CAST(count(DISTINCT series) AS BIGINT) AS series_played,
    CAST(sum(matches_played) AS BIGINT) AS total_matches,
    {sums}
  FROM batting_series GROUP BY batsman
),
batting_overall AS (
  SELECT batsman, series_played, total_matches, total_balls_faced, total_runs,
    {strike} AS strike_rate, {avg} AS batting_average,
    dot_balls, runs_1s, runs_2s, runs_3s, runs_4s, runs_5s, runs_6s,
    scores_gte_30, scores_gte_50, scores_gte_100, not_out_count, total_dismissals
  FROM batting_overall_agg
)""".format(
    sums=", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in (
        "total_balls_faced", "total_runs", "dot_balls", *_RUNS, "scores_gte_30", "scores_gte_50",
        "scores_gte_100", "not_out_count", "total_dismissals")),
    strike=_strike("total_runs", "total_balls_faced"), avg=_average("total_runs", "total_dismissals"),
)

_CONCEDED = tuple(f"runs_{n}s_conceded" for n in range(1, 7))

_BOWLING_MATCH = """
bowl_flags AS (
  SELECT matchid, bowler, over,
    CASE WHEN Extras IN ('wide', 'noball') THEN 0 ELSE 1 END AS legal,
    CASE WHEN Extras IN ('legbyes', 'byes') THEN 0 ELSE runs END AS bowler_runs,
    dismissal_method <> 'Not Out' AND dismissal_method <> 'Run Out' AS wicket
  FROM px_silver_events WHERE bowler IS NOT NULL
),
bowl_over AS (
  SELECT matchid, bowler, over, sum(legal) AS legal_in_over, sum(bowler_runs) AS runs_in_over
  FROM bowl_flags GROUP BY matchid, bowler, over
),
bowl_maiden AS (
  SELECT matchid, bowler, {maiden} AS maiden_overs FROM bowl_over GROUP BY matchid, bowler
),
bowl_agg AS (
  SELECT matchid, bowler,
    CAST(count(*) AS BIGINT) AS total_deliveries,
    CAST(sum(legal) AS BIGINT) AS legal_balls_bowled,
    CAST(sum(bowler_runs) AS BIGINT) AS runs_conceded,
    {dots} AS dot_balls,
    {conceded},
    {wk} AS wickets_taken
  FROM bowl_flags GROUP BY matchid, bowler
),
bowling_match AS (
  SELECT a.matchid, m.series, m.season, a.bowler, a.total_deliveries, a.legal_balls_bowled,
    {overs} AS overs_bowled, a.runs_conceded, {econ} AS economy_rate,
    b.maiden_overs, a.dot_balls, {conceded_cols}, a.wickets_taken
  FROM bowl_agg AS a
  JOIN bowl_maiden AS b ON a.matchid IS NOT DISTINCT FROM b.matchid AND a.bowler = b.bowler
  LEFT JOIN px_silver_metadata AS m ON a.matchid = m.matchid
)""".format(
    maiden=_count_if("legal_in_over = 6 AND runs_in_over = 0"),
    dots=_count_if("legal = 1 AND bowler_runs = 0"),
    conceded=", ".join(
        [f"{_count_if(f'bowler_runs = {n}')} AS runs_{n}s_conceded" for n in range(1, 6)]
        + [f"{_count_if('bowler_runs >= 6')} AS runs_6s_conceded"]),
    wk=_count_if("wicket"),
    overs=_overs("a.legal_balls_bowled"), econ=_economy("a.runs_conceded", "a.legal_balls_bowled"),
    conceded_cols=", ".join(f"a.{c}" for c in _CONCEDED),
)

_BOWL_SUMS = ("total_deliveries", "total_legal_balls", "total_runs_conceded", "total_maiden_overs",
              "total_dot_balls", "total_wickets", *_CONCEDED, "five_wicket_hauls")

_BOWLING_SERIES = """
bowling_series_agg AS (
  SELECT series, season, bowler,
    CAST(count(DISTINCT matchid) AS BIGINT) AS matches_played,
    CAST(sum(total_deliveries) AS BIGINT) AS total_deliveries,
    CAST(sum(legal_balls_bowled) AS BIGINT) AS total_legal_balls,
    CAST(sum(runs_conceded) AS BIGINT) AS total_runs_conceded,
    CAST(sum(maiden_overs) AS BIGINT) AS total_maiden_overs,
    CAST(sum(dot_balls) AS BIGINT) AS total_dot_balls,
    CAST(sum(wickets_taken) AS BIGINT) AS total_wickets,
    {conceded},
    {five} AS five_wicket_hauls
  FROM bowling_match GROUP BY series, season, bowler
),
bowling_series AS (
  SELECT series, season, bowler, matches_played, total_deliveries, total_legal_balls,
    {overs} AS total_overs_bowled, total_runs_conceded, {econ} AS economy_rate,
    {avg} AS bowling_average, {sr} AS bowling_strike_rate,
    total_maiden_overs, total_dot_balls, {conceded_cols}, total_wickets, five_wicket_hauls
  FROM bowling_series_agg
)""".format(
    conceded=", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _CONCEDED),
    five=_count_if("wickets_taken >= 5"),
    overs=_overs("total_legal_balls"), econ=_economy("total_runs_conceded", "total_legal_balls"),
    avg=_per_wicket("total_runs_conceded", "total_wickets"), sr=_per_wicket("total_legal_balls", "total_wickets"),
    conceded_cols=", ".join(_CONCEDED),
)

_BOWLING_OVERALL = """
bowling_overall_agg AS (
  SELECT bowler,
    CAST(count(DISTINCT series) AS BIGINT) AS series_played,
    CAST(sum(matches_played) AS BIGINT) AS total_matches,
    {sums}
  FROM bowling_series GROUP BY bowler
),
bowling_overall AS (
  SELECT bowler, series_played, total_matches, total_deliveries, total_legal_balls,
    {overs} AS total_overs_bowled, total_runs_conceded, {econ} AS economy_rate,
    {avg} AS bowling_average, {sr} AS bowling_strike_rate,
    total_maiden_overs, total_dot_balls, {conceded_cols}, total_wickets, five_wicket_hauls
  FROM bowling_overall_agg
)""".format(
    sums=", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _BOWL_SUMS),
    overs=_overs("total_legal_balls"), econ=_economy("total_runs_conceded", "total_legal_balls"),
    avg=_per_wicket("total_runs_conceded", "total_wickets"), sr=_per_wicket("total_legal_balls", "total_wickets"),
    conceded_cols=", ".join(_CONCEDED),
)

_SPANS = """
appearances AS (
  SELECT DISTINCT matchid, player_name, team FROM (
    SELECT matchid, batsman AS player_name, team FROM px_silver_events
    UNION ALL
    SELECT matchid, player_name, team FROM px_players
  )
),
spans AS (
  SELECT a.player_name, a.team, min(m.match_date) AS first_match_date, max(m.match_date) AS last_match_date,
         CAST(count(DISTINCT a.matchid) AS BIGINT) AS matches_for_team
  FROM appearances AS a JOIN px_silver_metadata AS m ON a.matchid = m.matchid
  WHERE m.match_date IS NOT NULL
  GROUP BY a.player_name, a.team
)"""

_INNINGS = """
innings AS (
  SELECT *,
    CAST(sum(runs) OVER w AS BIGINT) AS innings_score,
    CAST(sum(CASE WHEN dismissal_method <> 'Not Out' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS wickets_lost
  FROM px_silver_events
  WINDOW w AS (PARTITION BY matchid, team, super_over_team
               ORDER BY over ASC NULLS FIRST, match_ball_number ASC NULLS FIRST,
                        over_ball_number ASC NULLS FIRST, event ASC NULLS FIRST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


def _silver_all() -> str:
    return _base(_silver_events_cte(), _silver_metadata_cte())


# --------------------------------------------------------------------------- quality SQL

def _report(dataset: str, source: str, rules: dict[str, str]) -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE NOT coalesce(({p}), false)) AS {name}" for name, p in rules.items())
    unions = " UNION ALL ".join(
        f"SELECT {_q(dataset)} AS dataset, {_q(name)} AS rule, CAST(total_rows AS BIGINT) AS total_rows, "
        f"CAST({name} AS BIGINT) AS failed_rows FROM counts" for name in rules)
    return f"counts AS (SELECT count(*) AS total_rows, {cols} FROM {source})", unions


# The quality contract, stated again (not imported from the rules under test).
_MATCHID = {"matchid_not_null": "matchid IS NOT NULL"}
_POSITIVE = {"matchid_positive": "matchid > 0"}
_SERIES = {"series_not_null": "series <> ''"}
_PLAYER = {"player_name_not_null": "player_name <> ''", "team_not_null": "team <> ''"}
_RULES = {
    "bronze_events": {
        **_MATCHID, **_POSITIVE, "ball_not_null": "ball <> ''", "innings_not_null": "innings <> ''",
        "source_file_present": "source_file IS NOT NULL",
    },
    "bronze_metadata": {**_MATCHID, **_POSITIVE, **_SERIES},
    "bronze_players": {**_MATCHID, **_POSITIVE, **_PLAYER},
    "silver_players": {**_MATCHID, **_PLAYER},
    "silver_metadata": {**_MATCHID, **_SERIES, "match_date_present": "match_date IS NOT NULL"},
    "silver_events": {
        **_MATCHID, "runs_not_null": "runs IS NOT NULL", "runs_valid_range": "runs BETWEEN 0 AND 7",
        "over_not_null": "over IS NOT NULL",
        "extras_valid_domain": "Extras IN ('normal', 'wide', 'noball', 'legbyes', 'byes')",
        "dismissal_valid": "dismissal_method IN ('Not Out', 'Caught', 'Bowled', 'LBW', 'Run Out', 'Stumped', 'Caught & Bowled')",
    },
    "gold_events": {
        "innings_score_non_negative": "innings_score >= 0", "wickets_range": "wickets_lost BETWEEN 0 AND 10",
    },
}


def _dq(dataset: str, source_ctes: tuple[str, ...], source: str) -> str:
    cte, body = _report(dataset, source, _RULES[dataset])
    return _with(*source_ctes, cte) + body


def _delivery_n(prefix: str = "") -> str:
    return f"(({prefix}matchid - 1000) * 240 + {prefix}match_ball_number - 1)"


_DIRTY_EVENTS = f"""
dirty AS (
  SELECT
    CASE WHEN {_delivery_n()} % 50 = 0 THEN NULL ELSE ball END AS ball,
    CASE WHEN {_delivery_n()} % 70 = 1 THEN '' ELSE innings END AS innings,
    CASE WHEN {_delivery_n()} % 90 = 2 THEN -matchid WHEN {_delivery_n()} % 110 = 3 THEN NULL ELSE matchid END AS matchid,
    CASE WHEN {_delivery_n()} % 130 = 4 THEN NULL ELSE 'fixture/deliveries' END AS source_file
  FROM px_deliveries
)"""

_DIRTY_METADATA = """
dirty AS (
  SELECT
    CASE WHEN (matchid - 1000) % 50 = 0 THEN NULL WHEN (matchid - 1000) % 70 = 1 THEN '' ELSE series END AS series,
    CASE WHEN (matchid - 1000) % 90 = 2 THEN -matchid WHEN (matchid - 1000) % 110 = 3 THEN NULL ELSE matchid END AS matchid
  FROM px_metadata
)"""

_DIRTY_PLAYERS = """
dirty AS (
  SELECT
    CASE WHEN ((matchid - 1000) * 11 + batting_position - 1) % 50 = 0 THEN NULL ELSE player_name END AS player_name,
    CASE WHEN ((matchid - 1000) * 11 + batting_position - 1) % 70 = 1 THEN '' ELSE team END AS team,
    CASE WHEN ((matchid - 1000) * 11 + batting_position - 1) % 90 = 2 THEN -matchid
         WHEN ((matchid - 1000) * 11 + batting_position - 1) % 110 = 3 THEN NULL ELSE matchid END AS matchid
  FROM px_players
)"""


# --------------------------------------------------------------------------- the register

_EVENTS_COLS = "match_ball_number, ball, event, commentary, bowler, batsman, innings, matchid, is_super_over"
_META_COLS = ("ground, toss, series, season, player_of_the_match, player_of_the_series, hours_of_play_local_time, "
              "match_days, t20_debut, t20i_debut, umpires, tv_umpire, reserve_umpire, match_referee, points, "
              "match_number, matchid, player_replacements, first_innings, second_innings, has_super_over, "
              "super_over_count, series_result")
_PLAYER_COLS = ("matchid, innings, team, player_name, batted, batting_position, player_type, retired, "
                "not_out, bowled")
_SILVER_META_COLS = (
    "'fixture' AS Batchid, matchid, ground, toss, decision, series, season, player_of_the_match, "
    "player_of_the_series, t20_debut, t20i_debut, umpires, tv_umpire, reserve_umpire, match_referee, points, "
    "player_replacements, match_number, match_date, match_start_utc, first_innings_start_utc, "
    "first_innings_end_utc, second_innings_start_utc, second_innings_end_utc, first_innings, second_innings, "
    "has_super_over, super_over_count, series_result")
_SILVER_EVENT_COLS = (
    "'fixture' AS Batchid, matchid, event, ball, over, over_ball_number, match_ball_number, runs, commentary, "
    "bowler, batsman, team, is_super_over, super_over_team, runs_text, Extras, dismissal_method, dismissed_by")
_SUMMARY = (
    "SELECT matchid, match_number, series, season, first_innings AS team_1, second_innings AS team_2, "
    "ground AS venue, match_date, match_start_utc, toss AS toss_winner, decision AS toss_decision, "
    "series_result AS result_text, "
    f"regexp_extract(series_result, {_q(K.WINNER_PATTERN)}, 1) AS winner, "
    f"regexp_extract(series_result, {_q(K.MARGIN_PATTERN)}, 1) AS win_margin, "
    "CASE " + " ".join(f"WHEN contains(lower(series_result), {_q(n)}) THEN {_q(lbl)}" for n, lbl in K.RESULT_TYPES)
    + f" ELSE {_q(K.RESULT_OTHER)} END AS result_type, "
    "has_super_over, super_over_count, player_of_the_match, umpires, tv_umpire, match_referee, points "
    "FROM px_silver_metadata")


def oracle_sql() -> dict[str, str]:
    parsed = _base(_parse_cte())
    silver_all = _silver_all()
    batting = silver_all.rstrip("\n") + "," + _BATTING_MATCH.strip() + "\n"
    batting_s = batting.rstrip("\n") + "," + _BATTING_SERIES.strip() + "\n"
    batting_o = batting_s.rstrip("\n") + "," + _BATTING_OVERALL.strip() + "\n"
    bowling = silver_all.rstrip("\n") + "," + _BOWLING_MATCH.strip() + "\n"
    bowling_s = bowling.rstrip("\n") + "," + _BOWLING_SERIES.strip() + "\n"
    bowling_o = bowling_s.rstrip("\n") + "," + _BOWLING_OVERALL.strip() + "\n"
    spans = silver_all.rstrip("\n") + "," + _SPANS.strip() + "\n"
    meta_only = _base(_silver_metadata_cte())
    silver_events = _base(_silver_events_cte())

    sql = {
        "parse_delivery": parsed + "SELECT matchid, match_ball_number, ball, event, bowler_short, batsman_short, "
                                   "runs_text, over, over_ball_number, runs FROM px_parsed",
        "classify_extras": parsed + "SELECT matchid, match_ball_number, runs_text, Extras FROM px_parsed",
        "classify_dismissal": parsed + "SELECT matchid, match_ball_number, commentary, dismissal_method, "
                                       "dismissed_by FROM px_parsed",
        "super_over_label": _base() + "SELECT matchid, match_ball_number, innings, is_super_over, "
                                      "CASE WHEN contains(innings, 'Super Over') THEN innings ELSE 'normal' END "
                                      "AS super_over_team FROM px_deliveries",
        "parse_toss": _base() + "SELECT matchid, toss, trim(string_split(toss, ',')[1]) AS toss_winner, "
                                "CASE WHEN len(string_split(toss, ',')) >= 2 THEN trim(string_split(toss, ',')[2]) "
                                "END AS toss_decision FROM px_metadata",
        "match_dates_utc": meta_only + "SELECT matchid, ground, local_timezone, match_date, match_start_utc, "
                                       "first_innings_start_utc, first_innings_end_utc, second_innings_start_utc, "
                                       "second_innings_end_utc FROM px_meta_2",
        "ground_timezone_lookup": _base(_zones_cte()) + "SELECT m.ground, m.matchid, "
                                  "coalesce(z.local_timezone, 'UTC') AS local_timezone "
                                  "FROM px_metadata AS m LEFT JOIN px_zones AS z ON m.ground = z.ground",
        "distinct_grounds": _base() + "SELECT DISTINCT ground FROM px_metadata WHERE ground IS NOT NULL",
        "match_summary": meta_only + _SUMMARY,
        "match_name_lists": _base(_name_lists_cte()) + "SELECT matchid, array_to_string(team_names, '|') AS "
                            "team_names, array_to_string(player_names, '|') AS player_names FROM px_lists",
        "resolve_delivery_names": silver_events + "SELECT matchid, match_ball_number, innings, team, batsman_short, "
                                  "batsman, bowler_short, bowler FROM px_silver_events",
        "resolve_innings_teams": _base(
            "px_team_lists AS (SELECT matchid, list_sort(list(DISTINCT team) FILTER (WHERE team IS NOT NULL)) "
            "AS team_names FROM px_players WHERE matchid IS NOT NULL GROUP BY matchid)")
        + "SELECT m.matchid, m.first_innings AS first_innings_code, m.second_innings AS second_innings_code, "
        + f"{_resolve('m.first_innings', 'l.team_names')} AS first_innings, "
        + f"{_resolve('m.second_innings', 'l.team_names')} AS second_innings "
        + "FROM px_metadata AS m LEFT JOIN px_team_lists AS l ON m.matchid = l.matchid",
        "innings_progress": silver_events.rstrip("\n") + "," + _INNINGS.strip() + "\n"
        + "SELECT matchid, match_ball_number, team, super_over_team, over, over_ball_number, runs, "
          "dismissal_method, innings_score, wickets_lost FROM innings",
        "batting_per_match": batting + "SELECT * FROM batting_match",
        "batting_per_series": batting_s + "SELECT * FROM batting_series",
        "batting_overall": batting_o + "SELECT * FROM batting_overall",
        "maiden_overs": bowling + "SELECT b.matchid, b.bowler, m.series, m.season, b.maiden_overs "
                                  "FROM bowl_maiden AS b LEFT JOIN px_silver_metadata AS m ON b.matchid = m.matchid",
        "bowling_per_match": bowling + "SELECT * FROM bowling_match",
        "bowling_per_series": bowling_s + "SELECT * FROM bowling_series",
        "bowling_overall": bowling_o + "SELECT * FROM bowling_overall",
        "appearances_union": spans + "SELECT matchid, player_name, team FROM appearances",
        "player_team_spans": spans + "SELECT * FROM spans",
        "player_team_scd2": spans + "SELECT player_name, team, first_match_date AS start_date, "
                                    "lead(first_match_date) OVER w AS end_date, "
                                    "lead(first_match_date) OVER w IS NULL AS is_active, matches_for_team "
                                    "FROM spans WINDOW w AS (PARTITION BY player_name "
                                    "ORDER BY first_match_date ASC NULLS FIRST, team ASC NULLS FIRST)",
        "dq_bronze_events": _dq("bronze_events", (_deliveries_cte(), _DIRTY_EVENTS), "dirty"),
        "dq_bronze_metadata": _dq("bronze_metadata", (_metadata_cte(), _DIRTY_METADATA), "dirty"),
        "dq_bronze_players": _dq("bronze_players", (_players_cte(), _DIRTY_PLAYERS), "dirty"),
        "dq_silver_players": _dq("silver_players", (
            _players_cte(), _DIRTY_PLAYERS,
            "dedup AS (SELECT DISTINCT matchid, player_name, team FROM dirty)"), "dedup"),
        "dq_silver_metadata": _dq("silver_metadata", (
            _deliveries_cte(), _players_cte(), _metadata_cte(),
            "px_metadata_dirty AS (SELECT * REPLACE (CASE WHEN (matchid - 1000) % 70 = 1 THEN '' ELSE series END "
            "AS series) FROM px_metadata)",
            _silver_metadata_cte("px_metadata_dirty")), "px_silver_metadata"),
        "dq_silver_events": _dq("silver_events", (
            _deliveries_cte(), _players_cte(), _metadata_cte(), _silver_events_cte(),
            f"""dirty AS (SELECT
                CASE WHEN {_delivery_n()} % 110 = 3 THEN NULL ELSE matchid END AS matchid,
                CASE WHEN {_delivery_n()} % 50 = 0 THEN 9 ELSE runs END AS runs,
                CASE WHEN {_delivery_n()} % 70 = 1 THEN 'other' ELSE Extras END AS Extras,
                CASE WHEN {_delivery_n()} % 90 = 2 THEN NULL ELSE over END AS over,
                CASE WHEN {_delivery_n()} % 130 = 4 THEN 'Retired' ELSE dismissal_method END AS dismissal_method
              FROM px_silver_events)"""), "dirty"),
        "dq_gold_events": _dq("gold_events", (
            _deliveries_cte(), _players_cte(), _metadata_cte(), _silver_events_cte(), _INNINGS,
            f"""dirty AS (SELECT
                CASE WHEN {_delivery_n()} % 50 = 0 THEN -1 ELSE innings_score END AS innings_score,
                CASE WHEN {_delivery_n()} % 70 = 1 THEN 11 WHEN {_delivery_n()} % 90 = 2 THEN NULL
                     ELSE wickets_lost END AS wickets_lost
              FROM innings)"""), "dirty"),
        "ingest_events_csv": _base() + f"SELECT 'fixture' AS Batchid, {_EVENTS_COLS}, "
                                       "'matchid=' || CAST(matchid AS VARCHAR) AS source_dir FROM px_deliveries",
        "ingest_metadata_json": _base() + f"SELECT 'fixture' AS Batchid, {_META_COLS}, "
                                          "'matchid=' || CAST(matchid AS VARCHAR) AS source_dir FROM px_metadata",
        "ingest_players_csv": _base() + f"SELECT 'fixture' AS Batchid, {_PLAYER_COLS}, "
                                        "'matchid=' || CAST(matchid AS VARCHAR) AS source_dir FROM px_players",
        "dedup_players_stream": _base() + f"SELECT DISTINCT {_PLAYER_COLS} FROM px_players",
        "dedup_metadata_stream": _base() + f"SELECT DISTINCT {_META_COLS} FROM px_metadata",
        "dedup_state_keys": _base() + "SELECT matchid, team, count(DISTINCT player_name) AS held_keys FROM px_players GROUP BY 1, 2",
        "ingest_rescued_values": _base("""kept AS (
            SELECT matchid, 'weather' AS column_name, 'dry, "' || match_ball_number || '"' AS value FROM px_deliveries WHERE match_ball_number % 5 = 0
            UNION ALL SELECT matchid, 'is_super_over', 'maybe' FROM px_deliveries WHERE match_ball_number % 11 = 0
            UNION ALL SELECT matchid, 'match_ball_number', 'no. ' || match_ball_number FROM px_deliveries WHERE match_ball_number % 7 = 0)""")
        + "SELECT matchid, column_name, count(*) AS n_values, min(value) AS first_value FROM kept GROUP BY 1, 2",
        "ingest_events_table": _base() + """SELECT CASE WHEN matchid % 3 = 0 THEN 'second' ELSE 'first' END AS Batchid, matchid,
            count(*) AS n_rows, CAST(sum(match_ball_number) AS BIGINT) AS ball_numbers, 'bronze' AS quality, 'matchid' AS partition_by,
            true AS has_comment FROM px_deliveries GROUP BY matchid""",
        "gold_published_rebuild": batting + """SELECT reader, matchid, batsman, total_runs FROM batting_match,
            (VALUES ('holding'), ('next')) AS v(reader) WHERE reader = 'next' OR matchid % 2 = 0""",
        "ingest_redelivered": _base() + f"SELECT 'first' AS Batchid, {', '.join(schemas.BRONZE_EVENTS_COLUMNS)} FROM px_deliveries",
        "gold_audit_times": _base() + "SELECT matchid, count(*) AS n_rows, count(*) AS n_ordered FROM px_deliveries GROUP BY matchid",
        "silver_players_stream": _base() + f"SELECT DISTINCT 'fixture' AS Batchid, {_PLAYER_COLS} FROM px_players",
        "silver_metadata_stream": meta_only + f"SELECT {_SILVER_META_COLS} FROM px_silver_metadata",
        "silver_events_stream": silver_events + f"SELECT {_SILVER_EVENT_COLS} FROM px_silver_events",
        "gold_write_roundtrip": batting + "SELECT * FROM batting_match",
        "ingest_events_by_header": _base()
        + "SELECT v.Batchid, " + ", ".join(
            "CASE WHEN matchid % 2 = 0 THEN is_super_over END AS is_super_over" if c == "is_super_over" else c
            for c in schemas.BRONZE_EVENTS_COLUMNS)
        + " FROM px_deliveries, (VALUES ('stream'), ('batch')) AS v(Batchid)",
        "ingest_rerun_settings": _base()
        + f"SELECT CASE WHEN matchid % 3 = 0 THEN 'run-second' ELSE 'run-first' END AS Batchid, {_PLAYER_COLS} FROM px_players",
    }
    for feed, head, extra in (("events", "match_ball_number,ball,event,commentary,bowler,batsman,innings,is_super_over", ",weather"),
                              ("players", "innings,team,player_name,batted,batting_position,player_type,retired,not_out,bowled", "")):
        layouts = f"""SELECT CASE WHEN matchid % 2 = 0 THEN 'first' ELSE 'second' END AS run, 'match_{feed}' AS feed,
            '{head}' || CASE WHEN matchid % 2 = 1 THEN '{extra}' ELSE '' END AS columns FROM px_{'deliveries' if feed == 'events' else 'players'}"""
        part = f"SELECT min(run) AS Batchid, feed, columns FROM ({layouts}) GROUP BY feed, columns"
        sql["ingest_header_history"] = sql["ingest_header_history"] + " UNION ALL " + part if "ingest_header_history" in sql else _base() + part
    player_rules = {"matchid_not_null": "matchid IS NULL", "matchid_positive": "NOT coalesce(matchid > 0, false)",
                    "player_name_not_null": "coalesce(player_name, '') = ''", "team_not_null": "coalesce(team, '') = ''"}
    sql["dq_history_two_runs"] = _base("""planted AS (SELECT * REPLACE (
            CASE WHEN matchid % 3 = 0 AND batting_position = 3 THEN NULL ELSE player_name END AS player_name,
            CASE WHEN matchid % 4 = 1 AND batting_position = 5 THEN NULL ELSE team END AS team),
            CASE WHEN matchid % 5 = 0 THEN 'second' ELSE 'first' END AS run_id FROM px_players)""") + " UNION ALL ".join(
        f"SELECT run_id, 'bronze_players' AS dataset, '{rule}' AS rule, count(*) AS total_rows, count(*) FILTER ({failed}) AS failed_rows "
        "FROM planted GROUP BY run_id" for rule, failed in player_rules.items())
    for table, same_as in {
        "innings_progress_chunked": "innings_progress", "gold_match_events": "innings_progress",
        "gold_batting_stats_per_match": "batting_per_match", "gold_batting_stats_per_series": "batting_per_series",
        "gold_batting_stats_overall": "batting_overall", "gold_bowling_stats_per_match": "bowling_per_match",
        "gold_bowling_stats_per_series": "bowling_per_series", "gold_bowling_stats_overall": "bowling_overall",
        "gold_match_summary": "match_summary", "gold_player_team_scd2": "player_team_scd2",
        "gold_refresh_two_runs": "batting_overall", "gold_batting_repaired": "batting_overall",
        "silver_events_repaired": "silver_events_stream", "bucketed_batting_per_match": "batting_per_match",
        "bucketed_bowling_per_match": "bowling_per_match", "bucketed_innings_progress": "innings_progress",
    }.items():
        sql[table] = sql[same_as]
    return sql
