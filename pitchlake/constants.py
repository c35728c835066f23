"""Fixed values and names shared by the whole library.

The block marked FIXED VALUES must stay exactly as written: the parsed
results (runs, extras, dismissals, resolved names, session times) depend on
these literal patterns, formats and lookup entries.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — patterns, formats and lookup entries that define the parsed
# results. Do not reorder or edit.
# ---------------------------------------------------------------------------

# Delivery text "<bowler> to <batsman>, <outcome>": three capture groups.
EVENT_PATTERN = r"([A-Za-z\s\'\\-]*)\sto\s([A-Za-z\s\'\\-]*)\,\s+([0-9A-Za-z\,\s\(\)]*)"
NO_BALL_TAG = r"\(no ball\)"
LEADING_DIGITS = r"^(\d+)"

# Dismissal detection on the commentary, in priority order.
RUN_OUT_MATCH = r"run out\s*\("
CAUGHT_AND_BOWLED_MATCH = r"c & b\s+"
CAUGHT_MATCH = r"\bc\s+.+?\s+b\s+.+?\s+\d+\s*\("
LBW_MATCH = r"lbw\s+b\s+"
STUMPED_MATCH = r"(?:^|[^a-zA-Z])st\s+[^a-zA-Z]*[A-Z].+?\s+b\s+.+?\s+\d+\s*\("
BOWLED_MATCH = r"(?:^|[^a-zA-Z])b\s+\w+\s+\d+\s*\("

# Fielder / bowler extraction for each dismissal kind (group 1). The score
# suffix "<n> (" is consumed instead of looked ahead at; group 1 is the same.
RUN_OUT_BY = r"run out\s*\(([^/\)]+)"
CAUGHT_AND_BOWLED_BY = r"c & b\s+(.+?)\s+\d+\s*\("
CAUGHT_BY = r"\bc\s+(.+?)\s+b\s+"
LBW_BY = r"lbw\s+b\s+(.+?)\s+\d+\s*\("
STUMPED_BY = r"st\s+(.+?)\s+b\s+"
BOWLED_BY = r"(?:^|[^a-zA-Z])b\s+(.+?)\s+\d+\s*\("
KEEPER_MARK = "†"

# Match date and session times in the metadata text.
MATCH_DATE_PATTERN = r"^(\d+\s+\w+\s+\d{4})"
MATCH_DATE_FORMAT = "d MMMM yyyy"
# hour and minute of an "H.mm" time
SESSION_TIME_PATTERN = r"^([0-9]{1,2})\.([0-9]{2})$"
SESSION_PATTERNS = (
    ("match_start_utc", r"^(\d+\.\d+)\s+start"),
    ("first_innings_start_utc", r"First Session\s+(\d+\.\d+)"),
    ("first_innings_end_utc", r"First Session\s+\d+\.\d+-(\d+\.\d+)"),
    ("second_innings_start_utc", r"Second Session\s+(\d+\.\d+)"),
    ("second_innings_end_utc", r"Second Session\s+\d+\.\d+-(\d+\.\d+)"),
)

# Result text.
WINNER_PATTERN = r"^(.+?)\s+won\s+by"
MARGIN_PATTERN = r"won\s+by\s+(.+)$"
RESULT_TYPES = (
    ("run", "by runs"),
    ("wicket", "by wickets"),
    ("super over", "super over"),
    ("no result", "no result"),
    ("tie", "tie"),
)
RESULT_OTHER = "other"

SUPER_OVER = "Super Over"
NORMAL_INNINGS = "normal"

# Team abbreviations understood by the name resolver.
TEAM_ABBREVIATIONS = {
    "USA": "United States Of America",
    "NED": "Netherlands",
    "BHR": "Bahrain",
    "NZ": "New Zealand",
    "WI": "West Indies",
    "SL": "Sri Lanka",
    "PNG": "Papua New Guinea",
    "UAE": "United Arab Emirates",
    "HK": "Hong Kong",
    "RSA": "South Africa",
    "SA": "South Africa",
    "ENG": "England",
    "AUS": "Australia",
    "IND": "India",
    "PAK": "Pakistan",
    "BAN": "Bangladesh",
    "AFG": "Afghanistan",
    "ZIM": "Zimbabwe",
    "IRE": "Ireland",
    "SCO": "Scotland",
    "NAM": "Namibia",
    "NEP": "Nepal",
    "OMA": "Oman",
    "CAN": "Canada",
    "UGA": "Uganda",
}

# ---------------------------------------------------------------------------
# Domains and labels (library vocabulary).
# ---------------------------------------------------------------------------

EXTRAS_NORMAL = "normal"
EXTRAS_WIDE = "wide"
EXTRAS_NOBALL = "noball"
EXTRAS_LEGBYES = "legbyes"
EXTRAS_BYES = "byes"
EXTRAS_DOMAIN = (EXTRAS_NORMAL, EXTRAS_WIDE, EXTRAS_NOBALL, EXTRAS_LEGBYES, EXTRAS_BYES)

NOT_OUT = "Not Out"
RUN_OUT = "Run Out"
CAUGHT_AND_BOWLED = "Caught & Bowled"
CAUGHT = "Caught"
LBW = "LBW"
STUMPED = "Stumped"
BOWLED = "Bowled"
DISMISSAL_DOMAIN = (NOT_OUT, CAUGHT, BOWLED, LBW, RUN_OUT, STUMPED, CAUGHT_AND_BOWLED)

# Layer names of the table layout <root>/<layer>/<table>.
BRONZE = "bronze"
SILVER = "silver"
GOLD = "gold"

# Default file names of the three input feeds inside <root>/matchid=<n>/.
EVENTS_FILE = "match_events_data.csv"
METADATA_FILE = "metadata_data.json"
PLAYERS_FILE = "match_players_data.csv"
DEFAULT_RUN_ID = "default"
