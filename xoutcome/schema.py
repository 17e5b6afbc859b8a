"""Column names, types and fixed value lists of the event table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TARGET = "estimated_ba_using_speedangle"
NEXT_TARGET = "next_" + TARGET

# ---- fixed values: names and lists below must equal the source data's ----

METRICS = [
    "release_speed", "release_pos_x", "release_pos_z", "pfx_x", "pfx_z", "plate_x", "plate_z",
    "vx0", "vy0", "vz0", "ax", "ay", "az", "effective_speed", "release_spin_rate",
    "release_extension", "release_pos_y", "spin_x", "spin_z",
]

KEEP = [
    "pitch_type", "game_date", "release_speed", "release_pos_x", "release_pos_z", "batter", "pitcher",
    "events", "description", "game_type", "stand", "p_throws", "home_team", "away_team", "type",
    "balls", "strikes", "game_year", "pfx_x", "pfx_z", "plate_x", "plate_z", "vx0", "vy0", "vz0",
    "ax", "ay", "az", "effective_speed", "release_spin_rate", "bb_type", "release_extension",
    "game_pk", "release_pos_y", "estimated_ba_using_speedangle", "pitch_number", "spin_axis",
]

DEPRECATED = [
    "pitcher.1", "fielder_2.1", "umpire", "spin_dir", "spin_rate_deprecated", "break_angle_deprecated",
    "break_length_deprecated", "tfs_deprecated", "tfs_zulu_deprecated",
]

TEAMS = [
    "LAA", "HOU", "OAK", "TOR", "ATL", "MIL", "STL", "CHC", "ARI", "LAD", "SF", "CLE", "SEA", "MIA",
    "NYM", "WSH", "BAL", "SD", "PHI", "PIT", "TEX", "TB", "BOS", "CIN", "COL", "KC", "DET", "MIN",
    "CWS", "NYY",
]

TERMINAL_EVENTS = [
    "single", "double", "home_run", "triple", "field_out", "grounded_into_double_play", "force_out",
    "double_play", "sac_bunt", "sac_fly", "fielders_choice_out", "fielders_choice",
    "sac_fly_double_play", "triple_play", "sac_bunt_double_play", "strikeout",
    "strikeout_double_play", "field_error", "walk", "hit_by_pitch", "catch_interf", "catcher_interf",
]

EVENT_CLASSES = {
    "hit": ["single", "double", "home_run", "triple"],
    "field_out": [
        "field_out", "grounded_into_double_play", "force_out", "double_play", "sac_bunt", "sac_fly",
        "fielders_choice_out", "fielders_choice", "sac_fly_double_play", "triple_play",
        "sac_bunt_double_play",
    ],
    "runner_out": [
        "caught_stealing_3b", "caught_stealing_2b", "pickoff_2b", "pickoff_caught_stealing_3b",
        "caught_stealing_home", "pickoff_caught_stealing_home", "pickoff_caught_stealing_2b",
        "runner_double_play", "pickoff_3b", "other_out", "pickoff_1b",
    ],
    "stolen_base": ["stolen_base_2b", "stolen_base_home", "stolen_base_3b"],
    "free_base": ["hit_by_pitch", "walk", "catcher_interf", "catch_interf"],
    "strikeout": ["strikeout", "strikeout_double_play"],
    "strike": [
        "called_strike", "swinging_strike", "swinging_strike_blocked", "foul_bunt", "missed_bunt",
        "bunt_foul_tip", "swinging_pitchout",
    ],
    "ball": ["ball", "blocked_ball", "pitchout", "wild_pitch", "passed_ball"],
    "foul": ["foul_tip", "foul", "foul_pitchout"],
    "error": ["field_error"],
}

NO_THROW_EVENTS = [
    "other_out", "pickoff_1b", "wild_pitch", "pickoff_2b", "pickoff_caught_stealing_3b",
    "game_advisory", "caught_stealing_home", "pickoff_caught_stealing_home",
    "pickoff_caught_stealing_2b", "pitchout", "swinging_pitchout", "pickoff_3b", "foul_pitchout",
    "caught_stealing_3b", "caught_stealing_2b",
]

BY_TYPE_EVENTS = ["single", "double", "double_play", "triple", "triple_play"]
STRIKEOUT_EVENTS = ["strikeout", "strikeout_double_play"]
WALK_EVENTS = ["walk"]
UNNAMED_ACTOR_EVENTS = ["wild_pitch", "passed_ball"]

ACTION_WORDS = [
    "grounds", "singles", "doubles", "triples", "pops", "hit", "lines", "flies", "walks", "called",
    "reaches", "strikes", "homers", "out", "ground", "intentionally",
]
BASE_MARKS = ["2nd base.", "3rd base.", "home."]
CHALLENGE_MARKS = ["upheld: ", "overturned: "]
NAME_LIMIT = 40

BATTER_WINDOWS = {5: 2, 10: 3, 15: 4}  # days -> rows needed
PITCHER_WINDOWS = {7: 1, 14: 2, 21: 3}
SEASON_MONTHS = [4, 5, 6, 7, 8, 9]

# ---- end of fixed values ----

# The order of events inside a game; the raw files hold them newest first.
EVENT_ORDER = ["game_date", "game_pk", "at_bat_number", "pitch_number"]

_LONG = {"game_pk", "batter", "pitcher", "pitch_number", "at_bat_number", "on_1b", "on_2b", "on_3b"}
_INT = {"balls", "strikes", "game_year"}
_TEXT = {
    "game_date", "pitch_type", "events", "description", "game_type", "stand", "p_throws", "home_team",
    "away_team", "type", "bb_type", "des", "player_name",
}


def _type_of(name: str) -> T.DataType:
    if name in _LONG:
        return T.LongType()
    if name in _INT:
        return T.IntegerType()
    return T.StringType() if name in _TEXT else T.DoubleType()


# Raw files carry ``game_date`` as text: header lines inside the data must stay readable.
RAW_SCHEMA = T.StructType(
    [T.StructField(c, _type_of(c)) for c in
     KEEP + ["at_bat_number", "des", "player_name", "on_1b", "on_2b", "on_3b"]]
)


@dataclass(frozen=True)
class FeatureFamily:
    """A run of numbered columns ``prefix_0 .. prefix_{n-1}``, fixed before the plan is built."""

    prefix: str
    n: int

    @property
    def columns(self) -> list[str]:
        return [f"{self.prefix}_{i}" for i in range(self.n)]

    @classmethod
    def found_in(cls, columns: list[str], prefix: str) -> "FeatureFamily":
        n = 0
        while f"{prefix}_{n}" in columns:
            n += 1
        return cls(prefix, n)
