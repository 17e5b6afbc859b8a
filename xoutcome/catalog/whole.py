"""The composed runs: cleaning, rollups, features, the fresh build."""

from __future__ import annotations

from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.catalog.base import Tables, query, quoted, r6, r6s
from xoutcome.catalog.windows import (
    HARD, SOFT, _DAILY, _HARD_OUT, _SOFT_OUT, _RATES, _whole, batter_side, calendar, depth, matchups, next_view)
from xoutcome.operators.joins import matchup_feature_join
from xoutcome.operators.windows import pitcher_cluster_rolls, rolling_weighted_ratio
from xoutcome.plans.build import BuildSettings, fresh_build
from xoutcome.plans.clean import clean_events
from xoutcome.plans.features import at_bats_from_lists, batter_features, matchup_features, pitcher_features
from xoutcome.plans.rollup import at_bats, day_table, matchup_lists, segments, with_hard_clusters
from xoutcome.session import fresh_path

DAYS = ("day_fx",)


# ---- P1 ----

_CASES = " ".join(f"WHEN events IN ({quoted(names)}) THEN '{group}'" for group, names in S.EVENT_CLASSES.items())
_HOLE = " OR ".join(f"{m} IS NULL" for m in S.METRICS)


def _near(m: str, d: str) -> str:
    order = ", ".join(f"{c} {d}" for c in S.EVENT_ORDER)
    return (f"last_value(CASE WHEN NOT ({_HOLE}) THEN {m} END IGNORE NULLS) OVER "
            f"(PARTITION BY pitcher ORDER BY {order} ROWS UNBOUNDED PRECEDING)")


_TYPED = [c for c in S.KEEP if c not in (*S.METRICS, "description", "type", S.TARGET)]
_SPIN = "release_spin_rate * {f}(radians(spin_axis))"
_BY_TYPE = quoted(S.BY_TYPE_EVENTS)


@query("clean_events", f"""
WITH kept AS (SELECT * REPLACE (COALESCE(events, description) AS events, CAST(game_date AS DATE) AS game_date) FROM raw_fx
  WHERE game_date IS NOT NULL AND game_date <> 'game_date' AND game_type = 'R'),
spun AS (SELECT *, CASE {_CASES} END AS bat_event, {_SPIN.format(f='sin')} AS spin_x, {_SPIN.format(f='cos')} AS spin_z
  FROM kept WHERE events IS NULL OR events <> 'game_advisory'),
filled AS (SELECT {', '.join(_TYPED)}, at_bat_number, bat_event,
  CASE WHEN events IN ({quoted(S.STRIKEOUT_EVENTS)}) THEN 0.0 ELSE {S.TARGET} END AS y,
  {', '.join(f'COALESCE({_near(m, "ASC")}, {_near(m, "DESC")}) AS {m}' for m in S.METRICS)} FROM spun),
a AS (SELECT events, median({S.TARGET}) AS ma FROM raw_fx WHERE events NOT IN ({_BY_TYPE}) GROUP BY ALL),
b AS (SELECT events, bb_type, median({S.TARGET}) AS mb FROM raw_fx WHERE events IN ({_BY_TYPE}) GROUP BY ALL)
SELECT {', '.join(r6('spin_axis', c) if c == 'spin_axis' else f'f.{c}' for c in _TYPED)}, at_bat_number, bat_event, {r6s(*S.METRICS)},
  {r6('COALESCE(y, ma, mb)', S.TARGET)}
FROM filled f LEFT JOIN a ON f.events = a.events LEFT JOIN b ON f.events = b.events AND f.bb_type = b.bb_type""", ("raw_fx",))
def _(t: Tables):
    return clean_events(t.raw_fx)


# ---- P5 ----

def _scored_segments(t: Tables):
    """Segments of the event stream with two soft clusters that SQL can make too."""
    rows = t.pitch_fx.withColumns({
        "cluster_attribute_0": F.col("spin_axis") / 360, "cluster_attribute_1": 1 - F.col("spin_axis") / 360})
    rolled = segments(rows, ["game_date", "batter", "events", "xba", *SOFT], "pitcher", ["ts", "seq"])
    return with_hard_clusters(rolled, SOFT)


_ENDS = f"COALESCE(events IN ({quoted(S.TERMINAL_EVENTS)}), FALSE)"
_PICK = "arg_max({c}, ROW(ts, seq)) FILTER (WHERE {c} IS NOT NULL) AS {c}"
_SEGS = f"""seg AS (SELECT *, spin_axis / 360 AS cluster_attribute_0, 1 - spin_axis / 360 AS cluster_attribute_1,
  SUM(CASE WHEN {_ENDS} THEN 1 ELSE 0 END) OVER (PARTITION BY pitcher ORDER BY ts DESC, seq DESC ROWS UNBOUNDED PRECEDING)
  AS segment_id FROM pitch_fx),
first AS (SELECT pitcher, segment_id, {', '.join(_PICK.format(c=c) for c in ['game_date', 'batter', 'events', 'xba', *SOFT])},
  COUNT(*) AS pitch_count FROM seg GROUP BY pitcher, segment_id),
hard AS (SELECT *, CAST(cluster_attribute_0 >= cluster_attribute_1 AS INTEGER) AS cluster_0,
  CAST(cluster_attribute_1 >= cluster_attribute_0 AS INTEGER) AS cluster_1 FROM first)"""


def _day_sql(keys: str, spread: bool) -> str:
    spreads = "".join(f", {r6(f'{f}({c})', f'{c}_{f.lower()}')}" for c in SOFT for f in ("MAX", "MIN")) if spread else ""
    return f"""WITH {_SEGS} SELECT game_date, {keys}, CAST(SUM(CASE WHEN events = 'walk' THEN 1 ELSE 0 END) AS BIGINT) AS bb,
CAST(SUM(CASE WHEN events = 'strikeout' THEN 1 ELSE 0 END) AS BIGINT) AS k, CAST(SUM(pitch_count) AS BIGINT) AS pitch_count,
COUNT(*) AS pa, CAST(SUM(cluster_0) AS BIGINT) AS cluster_0, CAST(SUM(cluster_1) AS BIGINT) AS cluster_1, {r6('AVG(xba)', 'xba')},
{', '.join(r6(f'AVG({c})', c) for c in SOFT)}{spreads} FROM hard GROUP BY game_date, {keys}"""


for _mode, _keys in (("batter", "batter"), ("pitcher", "pitcher"), ("both", "pitcher, batter")):
    query({"both": "matchup_table"}.get(_mode, f"{_mode}_table"), _day_sql(_keys, _mode == "both"), ("pitch_fx",))(
        lambda t, mode=_mode: day_table(_scored_segments(t), mode, SOFT, HARD, target="xba"))


@query("matchup_lists", f"""WITH {_SEGS} SELECT game_date, pitcher, batter, CAST(0 AS INTEGER) AS list_part,
{', '.join(r6(f'{f}({c})', f'{c}_{f.lower()}') for c in SOFT for f in ('MAX', 'MIN'))},
{', '.join(f'list({r6(c)} ORDER BY segment_id) AS {c}_list' for c in SOFT)},
{', '.join(f'list({c} ORDER BY segment_id) AS {c}_list' for c in HARD)}, list({r6('xba')} ORDER BY segment_id) AS xba_list
FROM hard GROUP BY ALL""", ("pitch_fx",))
def _(t: Tables):
    return matchup_lists(_scored_segments(t), SOFT, HARD, "xba", ("pitcher", "segment_id"))


@query("at_bats_from_lists", f"WITH {_SEGS} SELECT batter, game_date, {r6s(*SOFT, 'xba')}, {', '.join(HARD)} FROM hard "
       "WHERE xba IS NOT NULL", ("pitch_fx",))
def _(t: Tables):
    """Unrolling the lists gives the segments that the lists were made of."""
    rows = _scored_segments(t)
    return at_bats_from_lists(matchup_lists(rows, SOFT, HARD, "xba", ("pitcher", "segment_id")), [*SOFT, *HARD, "xba"])


@query("at_bats", f"WITH {_SEGS} SELECT batter, game_date, {r6s(*SOFT, 'xba')}, {', '.join(HARD)} FROM hard "
       "WHERE xba IS NOT NULL", ("pitch_fx",))
def _(t: Tables):
    return at_bats(_scored_segments(t), SOFT, HARD, "xba")


# ---- P2, P3, P4 ----

def features_sql(entity: str, ints: list[str], extra: list[str], windows: dict, lags: int, today: bool, nxt: bool) -> str:
    source = "day_" + entity
    played = "next_play" if nxt else "play"
    deep, rates, lag_names = depth(entity, "rates", windows, lags, today)
    kept = [n for n in lag_names if not n.startswith("play")]
    whole = " AND ".join(f"{n} IS NOT NULL" for n in [*rates, *lag_names])
    steps = [f"{source} AS (SELECT pitcher AS {entity}, game_date, pa, bb, k, xba FROM day_fx)" if entity != "pitcher"
             else f"{source} AS (SELECT * FROM day_fx)", calendar(entity, source)]
    if nxt:
        steps.append(next_view(entity))
    steps += [_RATES.format(played=played, source="nxt" if nxt else "cal"), deep]
    return (f"WITH {', '.join(steps)} SELECT {entity}, game_date, {', '.join(ints)}, day_of_week, month, year, "
            f"{r6s('xba', *extra, 'k_per_pa', 'bb_per_pa', *rates, *kept)} FROM deep WHERE {whole} AND "
            f"{'next_play' if nxt else 'pa'} <> 0")


@query("batter_features", features_sql("batter", ["bb", "k", "pa", "next_play"], ["next_xba"], S.BATTER_WINDOWS, 15, True,
                                        True), DAYS)
def _(t: Tables):
    return batter_features(t.day_fx.withColumnRenamed("pitcher", "batter"), target="xba")


@query("pitcher_features", features_sql("pitcher", ["bb", "k", "pa"], [], S.PITCHER_WINDOWS, 22, False, False), DAYS)
def _(t: Tables):
    return pitcher_features(t.day_fx, target="xba")


_BATTER_OUT = [f"{c}_estimated" for c in [*SOFT, *HARD]]
_SIDES = f"""{_DAILY}, {batter_side('hard', [*SOFT, *HARD])},
b AS (SELECT * FROM batter_side WHERE {_whole(_BATTER_OUT)}),
h AS (SELECT * FROM pitcher_hard WHERE {_whole(_HARD_OUT)}), s AS (SELECT * FROM pitcher_soft WHERE {_whole(_SOFT_OUT)})"""
# A pair has one row a day here, so daily maxima and minima are made as multiples, whose rolls are multiples too.
_SPREAD = {"max": 1.5, "min": 0.5}
_SPREAD_SQL = ", ".join(r6(f"COALESCE({by}::DOUBLE * {c}_roll, 0)", f"{c}_{end}_roll") for c in SOFT for end, by in _SPREAD.items())
_FEATURES = ", ".join(r6(f"COALESCE({c}, 0)", c) for c in [*_HARD_OUT, *_SOFT_OUT, *_BATTER_OUT])


@query("matchup_features", f"""WITH {_SIDES}
SELECT m.pitcher, m.batter, m.game_date, pa, {r6s('xba')}, {_FEATURES}, {_SPREAD_SQL} FROM hard m
JOIN h ON h.pitcher = m.pitcher AND h.game_date = m.game_date JOIN s ON s.pitcher = m.pitcher AND s.game_date = m.game_date
JOIN b ON b.batter = m.batter AND b.game_date = m.game_date WHERE xba IS NOT NULL AND pa <> 0""", ("matchup_fx",))
def _(t: Tables):
    rows = matchups(t)
    wide = rows.withColumns({f"{c}_{end}": F.col(c) * by for c in SOFT for end, by in _SPREAD.items()})
    return matchup_features(wide, rows, HARD, SOFT, target="xba", spread=[f"{c}_{end}" for c in SOFT for end in _SPREAD])


@query("matchup_feature_join", f"""WITH {_SIDES}
SELECT m.pitcher, m.batter, m.game_date, {_FEATURES} FROM hard m
JOIN h ON h.pitcher = m.pitcher AND h.game_date = m.game_date JOIN s ON s.pitcher = m.pitcher AND s.game_date = m.game_date
JOIN b ON b.batter = m.batter AND b.game_date = m.game_date""", ("matchup_fx",))
def _(t: Tables):
    rows = matchups(t)
    return matchup_feature_join(rows.select("pitcher", "batter", "game_date"), pitcher_cluster_rolls(rows, HARD, SOFT),
                                rolling_weighted_ratio(rows, [*SOFT, *HARD], "xba"))


# ---- P6 ----

@query("fresh_build")
def _(t: Tables):
    """All stages over the raw events, with few restarts and trees; returns the errors of the five models."""
    small = {"numTrees": 5, "maxDepth": 5}
    settings = BuildSettings(
        min_games=1, min_rows=100, goal=0.5, clusters=(3, 4), restarts=(3, 3),
        forests={kind: small for kind in ("batter", "pitcher", "matchup", "stacked", "combined")})
    return fresh_build(t.raw_fx, fresh_path(t.spark, "build"), settings)["errors"]
