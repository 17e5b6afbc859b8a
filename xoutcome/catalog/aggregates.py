"""Aggregates, joins, profiles, evaluation, sorted heads."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.catalog.base import Tables, query, quoted, r6, r6s
from xoutcome.functions.values import classify_event
from xoutcome.operators import aggregates as A
from xoutcome.operators import evaluate as E
from xoutcome.operators import joins as J
from xoutcome.operators import profile as P
from xoutcome.operators import rank as R
from xoutcome.operators.windows import segment_ids
from xoutcome.plans.rollup import segments

PITCH = ("pitch_fx",)
ENDS = f"COALESCE(events IN ({quoted(S.TERMINAL_EVENTS)}), FALSE)"
SEGMENTS = f"""seg AS (SELECT *, CAST(SUM(CASE WHEN {ENDS} THEN 1 ELSE 0 END) OVER (PARTITION BY pitcher ORDER BY ts DESC,
  seq DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id FROM pitch_fx)"""
_FIRST = "arg_max({c}, ROW(ts, seq)) FILTER (WHERE {c} IS NOT NULL)"


@query("segment_rollup", f"""WITH {SEGMENTS} SELECT pitcher, segment_id, {_FIRST.format(c='batter')} AS batter,
{_FIRST.format(c='events')} AS events, {_FIRST.format(c='bb_type')} AS bb_type, {r6(_FIRST.format(c='xba'), 'xba')},
COUNT(*) AS pitch_count FROM seg GROUP BY pitcher, segment_id""", PITCH)
def _(t: Tables):
    rows = segment_ids(t.pitch_fx, ["pitcher"], ["ts", "seq"])
    return A.segment_rollup(rows, ["pitcher", "segment_id"], ["ts", "seq"],
                            columns=["batter", "events", "bb_type", "xba"])


_ROLLED = f"""WITH {SEGMENTS}, seg1 AS (SELECT pitcher, segment_id, {_FIRST.format(c='game_date')} AS game_date,
  {_FIRST.format(c='batter')} AS batter, {_FIRST.format(c='events')} AS events, {_FIRST.format(c='xba')} AS xba,
  COUNT(*) AS pitch_count FROM seg GROUP BY pitcher, segment_id)
SELECT game_date, {{keys}}, CAST(SUM(CASE WHEN events = 'walk' THEN 1 ELSE 0 END) AS BIGINT) AS bb,
  CAST(SUM(CASE WHEN events = 'strikeout' THEN 1 ELSE 0 END) AS BIGINT) AS k, CAST(SUM(pitch_count) AS BIGINT) AS pitch_count,
  COUNT(*) AS pa, {r6('AVG(xba)', 'xba')} FROM seg1 GROUP BY game_date, {{keys}}"""


def _day_table(t: Tables, mode: str):
    rows = segments(t.pitch_fx, ["game_date", "batter", "events", "xba"], "pitcher", ["ts", "seq"])
    return A.entity_day_rollup(rows, mode, target="xba")


for _mode, _keys in (("batter", "batter"), ("pitcher", "pitcher"), ("both", "pitcher, batter")):
    query(f"entity_day_rollup_{_mode}", _ROLLED.format(keys=_keys), PITCH)(
        lambda t, mode=_mode: _day_table(t, mode))


@query("group_spread_and_list", f"""SELECT pitcher, game_date, CAST(0 AS INTEGER) AS list_part, {r6('MAX(xba)', 'xba_max')},
{r6('MIN(xba)', 'xba_min')}, list({r6('xba')} ORDER BY ts, seq) AS xba_list, list(batter ORDER BY ts, seq) AS batter_list
FROM pitch_fx GROUP BY pitcher, game_date""", PITCH)
def _(t: Tables):
    return A.group_spread_and_list(t.pitch_fx, ["pitcher", "game_date"], ["ts", "seq"], ["xba"], ["xba", "batter"])


@query("group_spread_and_list_cut", f"""SELECT pitcher, {r6('MAX(xba)', 'xba_max')}, {r6('MIN(xba)', 'xba_min')},
list({r6('xba')} ORDER BY ts, seq) AS xba_list, list(batter ORDER BY ts, seq) AS batter_list FROM pitch_fx GROUP BY pitcher""", PITCH)
def _(t: Tables):
    """Lists in pieces, put together again in the order of their parts."""
    parts = A.group_spread_and_list(t.pitch_fx, ["pitcher"], ["ts", "seq"], ["xba"], ["xba", "batter"], max_rows=60)
    rows = F.array_sort(F.collect_list(F.struct("list_part", "xba_list", "batter_list")))
    whole = parts.groupBy("pitcher", "xba_max", "xba_min").agg(rows.alias("rows"))
    return whole.select("pitcher", "xba_max", "xba_min", *[F.flatten(F.col("rows").getField(c)).alias(c) for c in ("xba_list", "batter_list")])


_WEIGHTED = ["cluster_attribute_0", "cluster_attribute_1"]
_WMEAN = "COALESCE(SUM(ABS(xba) * ABS({w})) / NULLIF(SUM(ABS({w})), 0), 0)"


def _weighted_sql(day: str) -> str:
    return (f"SELECT batter, {day}, " + ", ".join(
        f"{r6(_WMEAN.format(w=w), w + '_agg')}, {r6(f'SUM(ABS({w}))', w)}" for w in _WEIGHTED)
        + f" FROM matchup_fx GROUP BY batter, {day}")


@query("weighted_mean_by_cluster", _weighted_sql("game_date"), ("matchup_fx",))
def _(t: Tables):
    return A.weighted_mean_by_cluster(t.matchup_fx, ["batter", "game_date"], "xba", _WEIGHTED)


@query("weighted_sum_join", f"""
WITH m AS (SELECT batter, game_date, {_WMEAN.format(w=_WEIGHTED[0])} AS mean FROM matchup_fx GROUP BY ALL),
s AS (SELECT batter, game_date, SUM(ABS({_WEIGHTED[0]})) AS total FROM matchup_fx GROUP BY ALL)
SELECT m.batter, m.game_date, {r6('mean', 'cluster_attribute_0_agg')}, {r6('total', 'cluster_attribute_0')}
FROM m JOIN s USING (batter, game_date)""", ("matchup_fx",))
def _(t: Tables):
    return A.weighted_mean_by_cluster(t.matchup_fx, ["batter", "game_date"], "xba", _WEIGHTED[:1])


@query("daily_sum", f"SELECT pitcher, game_date, {r6('SUM(cluster_attribute_0)', 'cluster_attribute_0')}, "
       "CAST(SUM(pa) AS BIGINT) AS pa, CAST(SUM(bb) AS BIGINT) AS bb FROM matchup_fx GROUP BY pitcher, game_date",
       ("matchup_fx",))
def _(t: Tables):
    return A.daily_sum(t.matchup_fx, ["pitcher", "game_date"], ["cluster_attribute_0", "pa", "bb"])


# ---- medians and imputation ----

@query("median_table", f"SELECT events, {r6('median(xba)', 'median')} FROM pitch_fx WHERE xba IS NOT NULL GROUP BY events",
       PITCH)
def _(t: Tables):
    return A.median_table(t.pitch_fx, "xba")


@query("impute_median", f"""WITH m AS (SELECT events, median(xba) AS m FROM pitch_fx GROUP BY events)
SELECT seq, p.events, {r6('COALESCE(xba, m)', 'xba')} FROM pitch_fx p LEFT JOIN m ON p.events = m.events""", PITCH)
def _(t: Tables):
    return A.impute_median(t.pitch_fx, "xba").select("seq", "events", "xba")


@query("impute_median_by_year", f"""
WITH m AS (SELECT events, year(game_date) AS y, median(xba) AS m FROM pitch_fx WHERE events IN ('single', 'walk') GROUP BY ALL)
SELECT seq, {r6('COALESCE(xba, m)', 'xba')} FROM pitch_fx p LEFT JOIN m ON p.events = m.events AND year(game_date) = y""",
       PITCH)
def _(t: Tables):
    rows = t.pitch_fx.withColumn("game_year", F.year("game_date"))
    return A.impute_median(rows, "xba", ["single", "walk"], ["game_year"]).select("seq", "xba")


@query("impute_median_by_type", f"""
WITH m AS (SELECT events, bb_type, median(xba) AS m FROM pitch_fx WHERE events IN ({quoted(S.BY_TYPE_EVENTS)}) GROUP BY ALL)
SELECT seq, {r6('COALESCE(xba, m)', 'xba')} FROM pitch_fx p LEFT JOIN m ON p.events = m.events AND p.bb_type = m.bb_type""",
       PITCH)
def _(t: Tables):
    return A.impute_median(t.pitch_fx, "xba", S.BY_TYPE_EVENTS, ["bb_type"]).select("seq", "xba")


@query("impute_target", f"""
WITH a AS (SELECT events, median(xba) AS ma FROM pitch_fx WHERE events NOT IN ({quoted(S.BY_TYPE_EVENTS)}) GROUP BY ALL),
b AS (SELECT events, bb_type, median(xba) AS mb FROM pitch_fx WHERE events IN ({quoted(S.BY_TYPE_EVENTS)}) GROUP BY ALL)
SELECT seq, {r6('COALESCE(xba, ma, mb)', 'xba')} FROM pitch_fx p LEFT JOIN a ON p.events = a.events
LEFT JOIN b ON p.events = b.events AND p.bb_type = b.bb_type WHERE game_type = 'R'""", PITCH)
def _(t: Tables):
    regular = t.pitch_fx.filter("game_type = 'R'")
    return A.impute_target(regular, t.pitch_fx, "xba").select("seq", "xba")


# ---- distinct ----

@query("distinct_counts", "SELECT game_year, COUNT(DISTINCT game_pk) AS games FROM season_fx GROUP BY game_year",
       ("season_fx",))
def _(t: Tables):
    return A.distinct_counts(t.season_fx, ["game_year"], "game_pk", "games")


@query("distinct_seasons", "SELECT pitcher, COUNT(DISTINCT game_year) AS seasons FROM season_fx GROUP BY pitcher",
       ("season_fx",))
def _(t: Tables):
    return A.distinct_counts(t.season_fx, ["pitcher"], "game_year", "seasons")


@query("members_by_type", "SELECT DISTINCT pitch_type, pitcher FROM season_fx", ("season_fx",))
def _(t: Tables):
    return A.members_by_type(t.season_fx)


@query("types_by_member", "SELECT pitcher, list(DISTINCT pitch_type ORDER BY pitch_type) AS types FROM season_fx "
       "GROUP BY pitcher", ("season_fx",))
def _(t: Tables):
    return A.types_by_member(t.season_fx).select("pitcher", "types")


@query("type_count_by_member", "SELECT pitcher, COUNT(DISTINCT pitch_type) AS type_count FROM season_fx GROUP BY pitcher",
       ("season_fx",))
def _(t: Tables):
    return A.types_by_member(t.season_fx).select("pitcher", "type_count")


@query("distinct_values", "SELECT DISTINCT 'events' AS column_name, events AS value FROM pitch_fx UNION ALL "
       "SELECT DISTINCT 'pitcher', CAST(pitcher AS VARCHAR) FROM pitch_fx", PITCH)
def _(t: Tables):
    return A.distinct_values(t.pitch_fx, ["events", "pitcher"])


# ---- missing values ----

_HOLED = ["events", "bb_type", "xba", "release_spin_rate"]


def _nulls(where: str = "TRUE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL AND {where}) AS nulls FROM pitch_fx"
        for c in [*_HOLED, "batter"])


@query("null_counts", _nulls(), PITCH)
def _(t: Tables):
    return P.null_counts(t.pitch_fx, [*_HOLED, "batter"])


@query("null_counts_by_game_type", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL AND game_type = 'R') AS regular, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL AND game_type <> 'R') AS other FROM pitch_fx" for c in _HOLED), PITCH)
def _(t: Tables):
    return P.null_counts_by_game_type(t.pitch_fx, _HOLED)


@query("missing_columns", f"SELECT column_name, nulls > 0 AS has_nulls FROM ({_nulls()})", PITCH)
def _(t: Tables):
    return P.missing_columns(t.pitch_fx, [*_HOLED, "batter"])


_CASES = " ".join(f"WHEN e IN ({quoted(names)}) THEN '{group}'" for group, names in S.EVENT_CLASSES.items())


@query("missing_by_event", f"""WITH c AS (SELECT *, CASE {_CASES} END AS bat_event FROM
  (SELECT *, COALESCE(events, description) AS e FROM pitch_fx))
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT bat_event, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM c "
    "WHERE bat_event IS NOT NULL GROUP BY bat_event" for c in _HOLED) + ") WHERE nulls > 0", PITCH)
def _(t: Tables):
    rows = t.pitch_fx.withColumn("bat_event", classify_event(F.coalesce("events", "description")))
    return P.missing_by_event(rows, _HOLED)


@query("missing_pair_difference", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, COUNT(*) FILTER (WHERE {a} IS NULL AND {b} IS NOT NULL) AS only_a_null "
    "FROM pitch_fx" for a, b in permutations(_HOLED, 2)), PITCH)
def _(t: Tables):
    return P.missing_pair_difference(t.pitch_fx, _HOLED)


@query("nullity_correlation", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
    f"{r6(f'corr(CAST({a} IS NULL AS INTEGER), CAST({b} IS NULL AS INTEGER))', 'correlation')} FROM pitch_fx"
    for i, a in enumerate(_HOLED) for b in _HOLED[i + 1:]), PITCH)
def _(t: Tables):
    return P.nullity_correlation(t.pitch_fx, _HOLED)


_BINS = "unnest(range(10)) AS i"
_EDGE = "CAST(round(low + ({i}) * (high - low) / 10.0, 2) AS DOUBLE)"


@query("histogram", f"""
WITH lim AS (SELECT floor(MIN(release_spin_rate)) AS low, ceil(MAX(release_spin_rate)) AS high FROM pitch_fx),
bins AS (SELECT {_EDGE.format(i='i')} AS a, {_EDGE.format(i='i + 1')} AS b FROM (SELECT *, {_BINS} FROM lim))
SELECT {r6('a', 'low')}, {r6('b', 'high')}, COUNT(release_spin_rate) AS n FROM bins LEFT JOIN pitch_fx
ON release_spin_rate > a AND release_spin_rate <= b GROUP BY a, b""", PITCH)
def _(t: Tables):
    return P.histogram(t.pitch_fx, "release_spin_rate")


@query("histogram_few_values", "SELECT CAST(l_linenumber AS DOUBLE) AS low, CAST(l_linenumber AS DOUBLE) AS high, "
       "COUNT(*) AS n FROM lineitem GROUP BY l_linenumber")
def _(t: Tables):
    return P.histogram(t.lineitem, "l_linenumber")


@query("histogram_by_event", f"""
WITH lim AS (SELECT events, floor(MIN(release_spin_rate)) AS low, ceil(MAX(release_spin_rate)) AS high FROM pitch_fx
  WHERE release_spin_rate IS NOT NULL GROUP BY events),
bins AS (SELECT events, {_EDGE.format(i='i')} AS a, {_EDGE.format(i='i + 1')} AS b FROM (SELECT *, {_BINS} FROM lim))
SELECT bins.events, {r6('a', 'low')}, {r6('b', 'high')}, COUNT(release_spin_rate) AS n FROM bins LEFT JOIN pitch_fx p
ON p.events IS NOT DISTINCT FROM bins.events AND release_spin_rate > a AND release_spin_rate <= b GROUP BY ALL""", PITCH)
def _(t: Tables):
    return P.histogram_by(t.pitch_fx, "events", "release_spin_rate")


# ---- evaluation ----

_ERRORS = (f"{r6('avg(abs(y - pred))', 'mae')}, {r6('avg((y - pred) * (y - pred))', 'mse')}, "
           f"{r6('sum(w * abs(y - pred)) / sum(w)', 'wmae')}")


@query("mae_mse_wmae", f"SELECT model, {_ERRORS} FROM pred_fx GROUP BY model", ("pred_fx",))
def _(t: Tables):
    return E.errors(t.pred_fx, ["model"])


@query("wmae_next_weight", f"""
WITH n AS (SELECT *, LEAD(pa) OVER (PARTITION BY pitcher ORDER BY game_date) AS nw FROM day_fx)
SELECT 'pitcher' AS model, {r6('SUM(nw * ABS(xba - 0.1)) / SUM(nw)', 'wmae')} FROM n WHERE xba IS NOT NULL""", ("day_fx",))
def _(t: Tables):
    rows = t.day_fx.withColumns({"model": F.lit("pitcher"), "pred": F.lit(0.1)})
    rows = rows.withColumn("pa", F.col("pa").cast("double"))
    # A row without a target has no error and no weight.
    paired = rows.withColumnsRenamed({"xba": "y", "pa": "w"})
    return E.wmae_next_weight(paired, ["model"], ["pitcher"])


@query("eval_by_month", f"""SELECT model, split, CAST(month(game_date) AS INTEGER) AS month, {r6('avg(abs(y - pred))', 'mae')},
{r6('sum(w * abs(y - pred)) / sum(w)', 'wmae')} FROM pred_fx WHERE month(game_date) BETWEEN 4 AND 9 GROUP BY ALL""",
       ("pred_fx",))
def _(t: Tables):
    return E.eval_by_month(t.pred_fx, ["model", "split"])


@query("month_table", "SELECT model, split, " + ", ".join(
    f"{r6(f'avg(abs(y - pred)) FILTER (WHERE month(game_date) = {m})')} AS \"{m}\"" for m in S.SEASON_MONTHS)
    + " FROM pred_fx WHERE month(game_date) BETWEEN 4 AND 9 GROUP BY model, split", ("pred_fx",))
def _(t: Tables):
    return E.month_table(E.eval_by_month(t.pred_fx, ["model", "split"]), ["model", "split"], "mae")


@query("eval_table", f"SELECT model, split, {_ERRORS} FROM pred_fx GROUP BY model, split", ("pred_fx",))
def _(t: Tables):
    kinds = [(m, s) for m in ("A", "N", "R") for s in ("O", "F")]
    frames = {k: t.pred_fx.filter((F.col("model") == k[0]) & (F.col("split") == k[1])) for k in kinds}
    return E.eval_table(E.tagged(frames))


# ---- joins and unions ----

@query("stack_predictions", f"""
WITH b AS (SELECT batter, game_date, AVG(xba) AS batter_pred FROM matchup_fx GROUP BY ALL),
p AS (SELECT pitcher, game_date, AVG(xba) AS pitcher_pred FROM matchup_fx GROUP BY ALL HAVING COUNT(*) > 1)
SELECT m.pitcher, m.batter, m.game_date, {r6s('xba', 'batter_pred', 'pitcher_pred')} FROM matchup_fx m
JOIN b USING (batter, game_date) JOIN p USING (pitcher, game_date)""", ("matchup_fx",))
def _(t: Tables):
    m = t.matchup_fx
    b = m.groupBy("batter", "game_date").agg(F.avg("xba").alias("batter_pred"))
    p = m.groupBy("pitcher", "game_date").agg(F.avg("xba").alias("pitcher_pred"), F.count("*").alias("n"))
    return J.stack_predictions(m.select("pitcher", "batter", "game_date", "xba"), b, p.filter("n > 1"))


@query("rejoin_incomplete", f"SELECT seq, {r6s('xba')}, {r6('xba * 2', 'cluster_attribute_0')} FROM pitch_fx", PITCH)
def _(t: Tables):
    rows = t.pitch_fx.select("seq", "xba")
    scored = rows.filter("xba IS NOT NULL").withColumn("cluster_attribute_0", F.col("xba") * 2)
    return J.rejoin_incomplete(scored, rows.filter("xba IS NULL"))


@query("union_frames", f"SELECT seq, events, {r6s('xba')} FROM pitch_fx UNION ALL SELECT seq, NULL, {r6s('xba')} FROM pitch_fx",
       PITCH)
def _(t: Tables):
    return J.union_frames(t.pitch_fx.select("seq", "events", "xba"), t.pitch_fx.select("seq", "xba"))


# ---- sorted heads ----

@query("sort_by_day", f"SELECT pitcher, game_date, {r6s('xba')} FROM day_fx", ("day_fx",))
def _(t: Tables):
    return R.sort_by_day(t.day_fx, ["pitcher"]).select("pitcher", "game_date", "xba")


@query("top_n_per_cluster", f"""
WITH long AS (SELECT seq, 'xba' AS cluster, xba AS membership FROM pitch_fx UNION ALL
  SELECT seq, 'spin_axis', spin_axis / 360 FROM pitch_fx)
SELECT seq, cluster, {r6s('membership')}, CAST(place AS INTEGER) AS place FROM (SELECT *, ROW_NUMBER() OVER
  (PARTITION BY cluster ORDER BY membership DESC NULLS LAST, seq) AS place FROM long WHERE membership IS NOT NULL)
WHERE place <= 500""", PITCH)
def _(t: Tables):
    rows = t.pitch_fx.select("seq", "xba", (F.col("spin_axis") / 360).alias("spin_axis"))
    return R.top_n_per_cluster(rows, ["xba", "spin_axis"], ["seq"])


@query("head_of_null_rows", "SELECT seq, events, bb_type FROM pitch_fx WHERE bb_type IS NULL ORDER BY ts, seq LIMIT 20", PITCH)
def _(t: Tables):
    return R.head_of_null_rows(t.pitch_fx, "bb_type", ["ts", "seq"]).select("seq", "events", "bb_type")


@query("latest_season", "SELECT MAX(game_year) AS season FROM (SELECT game_year, COUNT(DISTINCT game_pk) AS n FROM season_fx "
       "GROUP BY game_year) WHERE n >= 1000", ("season_fx",))
def _(t: Tables):
    return R.latest_season(t.season_fx)


@query("temporal_split", """
WITH s AS (SELECT MAX(game_year) AS season FROM (SELECT game_year, COUNT(DISTINCT game_pk) AS n FROM season_fx
  GROUP BY game_year) WHERE n >= (SELECT COUNT(DISTINCT game_pk) // 7 FROM season_fx))
SELECT game_pk, game_year, CASE WHEN game_year < season THEN 'train' ELSE 'test' END AS split FROM season_fx, s
WHERE game_year <= season""", ("season_fx",))
def _(t: Tables):
    """A full season has at least the mean number of games, whatever the size of the tables; the last one does not."""
    rows = t.season_fx.select("game_pk", "game_year")
    train, test = R.temporal_split(rows, rows.select("game_pk").distinct().count() // 7)
    return train.withColumn("split", F.lit("train")).unionAll(test.withColumn("split", F.lit("test")))
