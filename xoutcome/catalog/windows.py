"""Event windows, calendars, rolling rates, lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from xoutcome.catalog.aggregates import ENDS, SEGMENTS
from xoutcome.catalog.base import Tables, query, r6, r6s
from xoutcome.functions import values as V
from xoutcome.operators import windows as W
from xoutcome.plans.features import filled_days, rate_per_pa

DAYS = ("day_fx",)
PITCH = ("pitch_fx",)
SOFT = ["cluster_attribute_0", "cluster_attribute_1"]
HARD = ["cluster_0", "cluster_1"]


@query("segment_ids", f"WITH {SEGMENTS} SELECT seq, pitcher, segment_id FROM seg", PITCH)
def _(t: Tables):
    return W.segment_ids(t.pitch_fx, ["pitcher"], ["ts", "seq"]).select("seq", "pitcher", "segment_id")


@query("segment_ids_cut", f"WITH {SEGMENTS} SELECT seq, pitcher, segment_id FROM seg", PITCH)
def _(t: Tables):
    """The same with every key of more than 60 rows cut into pieces."""
    return W.segment_ids(t.pitch_fx, ["pitcher"], ["ts", "seq"], max_rows=60).select("seq", "pitcher", "segment_id")


def _nearest(c: str, *order: str) -> str:
    return (f"last_value(CASE WHEN xba IS NOT NULL AND release_spin_rate IS NOT NULL THEN {c} END IGNORE NULLS) OVER "
            f"(PARTITION BY {order[1]} ORDER BY ts {order[0]}, seq {order[0]} ROWS UNBOUNDED PRECEDING)")


def _filled(c: str) -> str:
    return f"COALESCE({_nearest(c, 'ASC', 'pitcher')}, {_nearest(c, 'DESC', 'pitcher')})"


@query("fill_backward_forward", f"SELECT seq, {r6(_filled('xba'), 'xba')}, "
       f"{r6(_filled('release_spin_rate'), 'release_spin_rate')} FROM pitch_fx", PITCH)
def _(t: Tables):
    cols = ["xba", "release_spin_rate"]
    return W.fill_backward_forward(t.pitch_fx, cols, ["pitcher"], ["ts", "seq"]).select("seq", *cols)


@query("fill_backward_forward_cut", f"SELECT seq, {r6(_filled('xba'), 'xba')}, "
       f"{r6(_filled('release_spin_rate'), 'release_spin_rate')} FROM pitch_fx", PITCH)
def _(t: Tables):
    cols = ["xba", "release_spin_rate"]
    return W.fill_backward_forward(t.pitch_fx, cols, ["pitcher"], ["ts", "seq"], max_rows=60).select("seq", *cols)


def _same_day(c: str) -> str:
    parts = [_nearest(c, d, by) for by in ("pitcher, game_date", "pitcher") for d in ("ASC", "DESC")]
    return f"COALESCE({', '.join(parts)})"


@query("fill_same_day_first", f"SELECT seq, {r6(_same_day('xba'), 'xba')} FROM pitch_fx", PITCH)
def _(t: Tables):
    cols = ["xba", "release_spin_rate"]
    filled = W.fill_backward_forward(t.pitch_fx, cols, ["pitcher"], ["ts", "seq"], prefer_same_day=True)
    return filled.select("seq", "xba")


def calendar(entity: str, source: str = "day_fx", target: str = "xba") -> str:
    """SQL of a filled calendar ``cal`` with play flag and calendar parts."""
    return f"""span AS (SELECT {entity}, MIN(game_date) AS lo, MAX(game_date) AS hi FROM {source} GROUP BY {entity}),
every AS (SELECT {entity}, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS game_date FROM span),
cal AS (SELECT e.{entity}, e.game_date, COALESCE(d.{target}, 0) AS {target}, CAST(COALESCE(d.bb, 0) AS INTEGER) AS bb,
  CAST(COALESCE(d.k, 0) AS INTEGER) AS k, CAST(COALESCE(d.pa, 0) AS INTEGER) AS pa,
  CAST(COALESCE(d.pa, 0) > 0 AS INTEGER) AS play, CAST(dayofweek(e.game_date) AS INTEGER) AS day_of_week,
  CAST(month(e.game_date) AS INTEGER) AS month, CAST(year(e.game_date) AS INTEGER) AS year
  FROM every e LEFT JOIN {source} d ON d.{entity} = e.{entity} AND d.game_date = e.game_date)"""


@query("calendar_fill", f"WITH {calendar('pitcher')} SELECT pitcher, game_date, CAST(pa AS BIGINT) AS pa, "
       f"CAST(bb AS BIGINT) AS bb, CAST(k AS BIGINT) AS k, {r6s('xba')} FROM cal", DAYS)
def _(t: Tables):
    return W.calendar_fill(t.day_fx, "pitcher")


def _range(n: int, today: bool, entity: str = "pitcher") -> str:
    low, high = (n - 1, "CURRENT ROW") if today else (n, "INTERVAL 1 DAY PRECEDING")
    return (f"OVER (PARTITION BY {entity} ORDER BY game_date RANGE BETWEEN INTERVAL {low} DAY PRECEDING AND {high})")


def _rolled(expr: str, over: str, needed: int, how: str = "SUM") -> str:
    return f"CASE WHEN COUNT({expr}) {over} >= {needed} THEN {how}({expr}) {over} END"


_DAILY = f"""hard AS (SELECT *, CAST(cluster_attribute_0 >= cluster_attribute_1 AS INTEGER) AS cluster_0,
  CAST(cluster_attribute_1 >= cluster_attribute_0 AS INTEGER) AS cluster_1 FROM (SELECT pitcher, batter, game_date, pa, bb,
  xba, round(cluster_attribute_0, 6) AS cluster_attribute_0, round(cluster_attribute_1, 6) AS cluster_attribute_1
  FROM matchup_fx)),
daily AS (SELECT pitcher, game_date, {', '.join(f'SUM({c}) AS {c}' for c in [*SOFT, *HARD, 'pa', 'bb'])}
  FROM hard GROUP BY pitcher, game_date),
pitcher_hard AS (SELECT pitcher, game_date, {', '.join(
    f"{_rolled(c, _range(30, False), 3)} / NULLIF({_rolled('pa + bb', _range(30, False), 3)}, 0) AS {c}_roll_per_pa"
    for c in HARD)} FROM daily),
pitcher_soft AS (SELECT pitcher, game_date, {', '.join(
    f"{_rolled(c, _range(30, False), 3, 'AVG')} AS {c}_roll" for c in SOFT)} FROM daily)"""


def matchups(t: Tables):
    rows = t.matchup_fx.withColumns({c: F.round(c, 6) for c in SOFT})
    return rows.select("*", *V.hard_assign(SOFT))


def _whole(cols: list[str]) -> str:
    return " OR ".join(f"{c} IS NOT NULL" for c in cols)


_HARD_OUT = [f"{c}_roll_per_pa" for c in HARD]
_SOFT_OUT = [f"{c}_roll" for c in SOFT]


@query("rolling_cluster_hard", f"WITH {_DAILY} SELECT pitcher, game_date, {', '.join(r6(f'COALESCE({c}, 0)', c) for c in _HARD_OUT)} "
       f"FROM pitcher_hard WHERE {_whole(_HARD_OUT)}", ("matchup_fx",))
def _(t: Tables):
    return W.rolling_hard(matchups(t), HARD)


@query("rolling_cluster_soft", f"WITH {_DAILY} SELECT pitcher, game_date, {', '.join(r6(f'COALESCE({c}, 0)', c) for c in _SOFT_OUT)} "
       f"FROM pitcher_soft WHERE {_whole(_SOFT_OUT)}", ("matchup_fx",))
def _(t: Tables):
    return W.rolling_soft(matchups(t), SOFT)


def batter_side(source: str, weights: list[str]) -> str:
    """SQL of the batter's weighted rolling means ``batter_side``."""
    day = ", ".join(f"SUM(ABS(xba) * ABS({w})) AS x_{w}, SUM(ABS({w})) AS {w}" for w in weights)
    out = ", ".join(
        f"{_rolled(f'x_{w}', _range(30, False, 'batter'), 10)} / NULLIF({_rolled(w, _range(30, False, 'batter'), 10)}, 0) "
        f"AS {w}_estimated" for w in weights)
    return (f"bday AS (SELECT batter, game_date, {day} FROM {source} GROUP BY batter, game_date),\n"
            f"batter_side AS (SELECT batter, game_date, {out} FROM bday)")


_BATTER_OUT = [f"{c}_estimated" for c in SOFT]


@query("rolling_weighted_ratio", f"WITH {batter_side('matchup_fx', SOFT)} SELECT batter, game_date, "
       f"{', '.join(r6(f'COALESCE({c}, 0)', c) for c in _BATTER_OUT)} FROM batter_side WHERE {_whole(_BATTER_OUT)}",
       ("matchup_fx",))
def _(t: Tables):
    return W.rolling_weighted_ratio(t.matchup_fx, SOFT, "xba")


def _rate(n: int, today: bool, needed: int) -> str:
    over = _range(n, today)
    return f"{_rolled('xba', over, needed)} / NULLIF({_rolled('play', over, needed)}, 0)"


def _weighted(v: str, n: int, today: bool, needed: int) -> str:
    over = _range(n, today)
    base = _rolled("pa", over, needed)
    below = f"({base} + {_rolled('bb', over, needed)})" if "bb" in v else base
    return f"CASE WHEN {base} <> 0 THEN {_rolled(f'{v} * pa', over, needed)} / {below} END"


@query("rolling_rate", f"WITH {calendar('pitcher')} SELECT pitcher, game_date, {r6(_rate(7, False, 1), 'before')}, "
       f"{r6(_rate(5, True, 2), 'up_to')} FROM cal", DAYS)
def _(t: Tables):
    days = W.with_day_number(filled_days(t.day_fx, "pitcher", "xba"))
    return days.select("pitcher", "game_date",
                       W.rolling_rate("xba", W.days_before("pitcher", 7), 1).alias("before"),
                       W.rolling_rate("xba", W.days_up_to("pitcher", 5), 2).alias("up_to"))


_RATES = """rates AS (SELECT *, CASE WHEN {played} <> 0 AND pa <> 0 THEN CAST(k AS DOUBLE) / pa ELSE 0 END AS k_per_pa,
  CASE WHEN {played} <> 0 AND pa + bb <> 0 THEN CAST(bb AS DOUBLE) / (pa + bb) ELSE 0 END AS bb_per_pa FROM {source})"""


@query("rolling_rate_weighted", f"WITH {calendar('pitcher')}, {_RATES.format(played='play', source='cal')} SELECT pitcher, "
       f"game_date, {r6(_weighted('xba', 14, False, 2), 'plain')}, {r6(_weighted('bb_per_pa', 14, False, 2), 'walks')} FROM rates",
       DAYS)
def _(t: Tables):
    days = W.with_day_number(rate_per_pa(filled_days(t.day_fx, "pitcher", "xba")))
    frame = W.days_before("pitcher", 14)
    return days.select("pitcher", "game_date", W.rolling_rate_weighted("xba", frame, 2).alias("plain"),
                       W.rolling_rate_weighted("bb_per_pa", frame, 2).alias("walks"))


def _lags(columns: list[str], n: int, entity: str = "pitcher", name: bool = True) -> list[str]:
    return [f"LAG({c}, {i}) OVER (PARTITION BY {entity} ORDER BY game_date) AS {c}_{i}"
            for c in columns for i in range(1, n + 1)]


@query("lag_features", f"WITH {calendar('pitcher')}, l AS (SELECT pitcher, game_date, {', '.join(_lags(['xba', 'k'], 5))} FROM cal) "
       f"SELECT pitcher, game_date, {', '.join(r6(f'xba_{i}', f'xba_{i}') + f', k_{i}' for i in range(1, 6))} FROM l", DAYS)
def _(t: Tables):
    days = W.with_day_number(filled_days(t.day_fx, "pitcher", "xba"))
    return days.select("pitcher", "game_date", *W.lag_features(["xba", "k"], 5, W.day_window("pitcher")))


def next_view(entity: str) -> str:
    over = f"OVER (PARTITION BY {entity} ORDER BY game_date)"
    return f"""nxt AS (SELECT * FROM (SELECT {entity}, game_date, xba, bb, k, pa, play, LEAD(xba) {over} AS next_xba,
  LEAD(play) {over} AS next_play, LEAD(day_of_week) {over} AS day_of_week, LEAD(month) {over} AS month,
  LEAD(year) {over} AS year FROM cal) WHERE next_xba IS NOT NULL)"""


@query("shift_target", f"WITH {calendar('pitcher')}, {next_view('pitcher')} SELECT pitcher, game_date, bb, k, pa, play, "
       f"{r6s('xba', 'next_xba')}, next_play, day_of_week, month, year FROM nxt", DAYS)
def _(t: Tables):
    return W.next_day_view(filled_days(t.day_fx, "pitcher", "xba"), "pitcher", "xba")


def depth(entity: str, source: str, windows: dict[int, int], lags: int, today: bool) -> tuple[str, list[str], list[str]]:
    """SQL of all rolling rates and lags as ``deep``, with the names of its rates and of its lags."""
    roll, lagged = ["xba", "k_per_pa", "bb_per_pa"], ["bb_per_pa", "k_per_pa", "play", "xba"]
    named = [f"w{n} AS (PARTITION BY {entity} ORDER BY game_date " + _range(n, today, entity).split("game_date ")[1]
             for n in windows]
    rates = {}
    for v in roll:
        for n, needed in windows.items():
            enough = f"COUNT(*) OVER w{n} >= {needed}"
            below = f"(SUM(pa) OVER w{n} + SUM(bb) OVER w{n})" if "bb" in v else f"SUM(pa) OVER w{n}"
            rates[f"{v}_mean_{n}"] = f"CASE WHEN {enough} AND SUM(play) OVER w{n} <> 0 THEN SUM({v}) OVER w{n} / SUM(play) OVER w{n} END"
            rates[f"{v}_mean_weighted_{n}"] = (
                f"CASE WHEN {enough} AND SUM(pa) OVER w{n} <> 0 THEN SUM({v} * pa) OVER w{n} / {below} END")
    body = [f"{e} AS {name}" for name, e in rates.items()] + _lags(lagged, lags, entity)
    lag_names = [f"{c}_{i}" for c in lagged for i in range(1, lags + 1)]
    sql = f"deep AS (SELECT *, {', '.join(body)} FROM {source} WINDOW {', '.join(named)})"
    return sql, list(rates), lag_names


_DEEP, _DEEP_RATES, _DEEP_LAGS = depth("pitcher", "rates", {7: 1, 14: 2}, 3, False)


@query("depth_features", f"WITH {calendar('pitcher')}, {_RATES.format(played='play', source='cal')}, {_DEEP} SELECT pitcher, "
       f"game_date, {r6s(*_DEEP_RATES)}, {', '.join(n if n.startswith('play') else r6(n, n) for n in _DEEP_LAGS)} FROM deep", DAYS)
def _(t: Tables):
    days = rate_per_pa(filled_days(t.day_fx, "pitcher", "xba"))
    deep = W.depth_features(days, "pitcher", 3, {7: 1, 14: 2}, False, ["xba", "k_per_pa", "bb_per_pa"],
                            ["bb_per_pa", "k_per_pa", "play", "xba"])
    return deep.select("pitcher", "game_date", *_DEEP_RATES, *_DEEP_LAGS)


@query("feature_merge_back", f"""WITH {calendar('pitcher')}, r AS (SELECT a.pitcher, a.game_date, SUM(b.xba) AS s, SUM(b.play) AS n
  FROM cal a JOIN cal b ON a.pitcher = b.pitcher AND b.game_date >= a.game_date - INTERVAL 7 DAY AND b.game_date < a.game_date
  GROUP BY a.pitcher, a.game_date)
SELECT cal.pitcher, cal.game_date, {r6('s / NULLIF(n, 0)', 'rate')} FROM cal LEFT JOIN r
ON r.pitcher = cal.pitcher AND r.game_date = cal.game_date""", DAYS)
def _(t: Tables):
    """A window column where a merge of the feature back on its keys would give the same."""
    days = W.with_day_number(filled_days(t.day_fx, "pitcher", "xba"))
    return days.select("pitcher", "game_date", W.rolling_rate("xba", W.days_before("pitcher", 7), 1).alias("rate"))


@query("explode_aligned", f"""SELECT pitcher, game_date, {r6('xba', 'xba_list')}, batter AS batter_list FROM pitch_fx
WHERE xba IS NOT NULL""", PITCH)
def _(t: Tables):
    from xoutcome.operators.aggregates import group_spread_and_list
    lists = group_spread_and_list(t.pitch_fx, ["pitcher", "game_date"], ["ts", "seq"], [], ["xba", "batter"])
    return W.explode_aligned(lists, ["xba_list", "batter_list"], ["pitcher", "game_date"])
