"""Filters, projections and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.catalog.base import Tables, query, quoted, r6, r6s
from xoutcome.functions import text, values
from xoutcome.operators import filters
from xoutcome.operators.windows import hard_per_pa
from xoutcome.plans import clean
from xoutcome.plans.features import cast_types, rate_per_pa

PITCH = ("pitch_fx",)
PITCH_COLUMNS = "seq, ts, game_date, pitcher, batter, events, description, bb_type"


def _pitch(cols: str = PITCH_COLUMNS) -> str:
    return f"{cols}, {r6s('xba', 'release_spin_rate', 'spin_axis')}, game_type"


def _where(condition: str) -> str:
    return f"SELECT {_pitch()} FROM pitch_fx WHERE {condition}"


@query("remove_empty", "SELECT seq, xba_day FROM (SELECT seq, CASE WHEN xba IS NOT NULL THEN game_date END AS xba_day "
       "FROM pitch_fx) WHERE xba_day IS NOT NULL", PITCH)
def _(t: Tables):
    dated = t.pitch_fx.select("seq", F.when(F.col("xba").isNotNull(), F.col("game_date")).alias("xba_day"))
    return filters.remove_empty(dated, "xba_day")


@query("remove_header_rows", "SELECT pitch_type, COUNT(*) AS n FROM raw_fx GROUP BY pitch_type", ("raw_fx",))
def _(t: Tables):
    raw = t.raw_fx.select("game_date", "pitch_type")
    header = raw.select(F.lit("game_date").alias("game_date"), "pitch_type").distinct()
    return filters.remove_header_rows(raw.unionByName(header)).groupBy("pitch_type").agg(F.count("*").alias("n"))


@query("filter_game_type", _where("game_type IN ('R')"), PITCH)
def _(t: Tables):
    return filters.filter_game_type(t.pitch_fx)


@query("drop_advisory", "SELECT at_bat_number, events FROM raw_fx WHERE events IS NULL OR events <> 'game_advisory'",
       ("raw_fx",))
def _(t: Tables):
    return filters.drop_advisory(t.raw_fx).select("at_bat_number", "events")


_RAW_DOUBLES = [c for c in S.KEEP if c in S.METRICS or c in (S.TARGET, "spin_axis")]
_RAW_OTHERS = [c for c in S.KEEP if c not in _RAW_DOUBLES]


@query("project_keep", f"SELECT {', '.join(_RAW_OTHERS)}, {r6s(*_RAW_DOUBLES)} FROM raw_fx", ("raw_fx",))
def _(t: Tables):
    return filters.project_keep(t.raw_fx)


@query("drop_after_simplify", f"SELECT {', '.join(c for c in _RAW_OTHERS if c not in ('description', 'type'))}, "
       f"{r6s(*_RAW_DOUBLES)} FROM raw_fx", ("raw_fx",))
def _(t: Tables):
    return filters.drop_after_simplify(filters.project_keep(t.raw_fx))


@query("drop_null_rows", _where("events IS NOT NULL AND bb_type IS NOT NULL AND xba IS NOT NULL "
                                "AND release_spin_rate IS NOT NULL"), PITCH)
def _(t: Tables):
    return filters.drop_null_rows(t.pitch_fx)


@query("terminal_event_flag", f"SELECT seq, COALESCE(events IN ({quoted(S.TERMINAL_EVENTS)}), FALSE) AS ends "
       "FROM pitch_fx", PITCH)
def _(t: Tables):
    return t.pitch_fx.select("seq", filters.terminal_event_flag(F.col("events")).alias("ends"))


@query("drop_no_throw", f"SELECT id, events FROM name_fx WHERE COALESCE(events NOT IN ({quoted(S.NO_THROW_EVENTS)}), TRUE)",
       ("name_fx",))
def _(t: Tables):
    return filters.drop_no_throw(t.name_fx).select("id", "events")


@query("filter_playable", f"SELECT pitcher, game_date, pa, bb, k, {r6s('xba')} FROM day_fx "
       "WHERE xba IS NOT NULL AND pa <> 0", ("day_fx",))
def _(t: Tables):
    return filters.filter_playable(t.day_fx)


@query("drop_feature_columns", f"SELECT pitcher, game_date, pa, bb, k, {r6s('xba')}, "
       "CAST(1 AS INTEGER) AS next_play FROM day_fx", ("day_fx",))
def _(t: Tables):
    helpers = {"play": F.lit(1), "play_1": F.lit(0), "days_off": F.lit(2), "next_play": F.lit(1)}
    return filters.drop_feature_columns(t.day_fx.withColumns(helpers))


@query("group_size_filter", f"SELECT pitcher, game_pk, game_year, pitch_type, {r6s('v')} FROM (SELECT *, COUNT(*) OVER "
       "(PARTITION BY pitcher, game_year) AS n FROM season_fx) WHERE n >= 3", ("season_fx",))
def _(t: Tables):
    return filters.group_size_filter(t.season_fx, ["pitcher", "game_year"], 3)


@query("group_size_filter_strict", f"SELECT pitcher, game_pk, game_year, pitch_type, {r6s('v')} FROM (SELECT *, "
       "COUNT(*) OVER (PARTITION BY pitcher) AS n FROM season_fx) WHERE n > 10", ("season_fx",))
def _(t: Tables):
    return filters.group_size_filter(t.season_fx, ["pitcher"], 10, strict=True)


@query("entity_season_select", f"""
WITH pairs AS (SELECT c_custkey AS pitcher, 1996 AS game_year FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT c_custkey, 1996 FROM customer WHERE c_nationkey = 3)
SELECT s.pitcher, s.game_year, s.game_pk, s.pitch_type, {r6('s.v', 'v')}
FROM season_fx s JOIN pairs p ON s.pitcher = p.pitcher AND s.game_year = p.game_year""", ("season_fx",))
def _(t: Tables):
    pick = lambda c: t.customer.filter(c).select("c_custkey", F.lit(1996))
    pairs = pick(F.col("c_mktsegment") == "BUILDING").unionAll(pick(F.col("c_nationkey") == 3))
    return filters.entity_season_select(t.season_fx, pairs)


@query("split_complete_rows", f"SELECT seq, pitcher, {r6s('xba', 'release_spin_rate')}, "
       "xba IS NOT NULL AND release_spin_rate IS NOT NULL AS is_complete FROM pitch_fx", PITCH)
def _(t: Tables):
    rows = t.pitch_fx.select("seq", "pitcher", "xba", "release_spin_rate")
    whole, holed = filters.split_complete_rows(rows, ["xba", "release_spin_rate"])
    return whole.withColumn("is_complete", F.lit(True)).unionAll(holed.withColumn("is_complete", F.lit(False)))


@query("feature_target_split", f"SELECT pitcher, game_date, pa AS weight, {r6('xba', 'target')}, bb, k, pa "
       "FROM day_fx", ("day_fx",))
def _(t: Tables):
    features, target, weight = filters.feature_target_split(t.day_fx, "xba", ["pitcher", "game_date"])
    return t.day_fx.select("pitcher", "game_date", F.col(weight).alias("weight"), F.col(target).alias("target"),
                           *features)


@query("focus_matchup", f"SELECT {r6s('cluster_attribute_0', 'cluster_attribute_1', 'xba')}, game_date, batter, pitcher, "
       "bb, pa FROM matchup_fx", ("matchup_fx",))
def _(t: Tables):
    return filters.focus_matchup(t.matchup_fx.withColumn("pitch_count", F.lit(1)), "xba")


@query("cluster_feature_columns", f"SELECT {r6s('cluster_attribute_0', 'cluster_attribute_1')} FROM matchup_fx",
       ("matchup_fx",))
def _(t: Tables):
    return t.matchup_fx.select(*filters.cluster_feature_columns(t.matchup_fx.columns))


@query("non_id_columns", f"SELECT game_pk, {r6s('v')} FROM season_fx", ("season_fx",))
def _(t: Tables):
    return t.season_fx.select(*filters.non_id_columns(t.season_fx.columns))


@query("rename_family", f"SELECT pitcher, batter, game_date, {r6('cluster_attribute_0', 'cluster_attribute_0_roll')}, "
       f"{r6('cluster_attribute_1', 'cluster_attribute_1_roll')} FROM matchup_fx", ("matchup_fx",))
def _(t: Tables):
    soft = ["cluster_attribute_0", "cluster_attribute_1"]
    return filters.rename_family(t.matchup_fx.select("pitcher", "batter", "game_date", *soft), soft, "_roll")


@query("filter_category_year", _where("xba IS NOT NULL AND YEAR(game_date) = 2024 AND events = 'single'"), PITCH)
def _(t: Tables):
    return filters.filter_category_year(t.pitch_fx, "xba", 2024, event="single")


# ---- scalar expressions ----

@query("fill_events", "SELECT seq, COALESCE(events, description) AS events FROM pitch_fx", PITCH)
def _(t: Tables):
    return clean.fill_events(t.pitch_fx).select("seq", "events")


@query("fill_constants", "SELECT id, COALESCE(des, 'blank') AS des, COALESCE(player_name, 'unknown') AS player_name "
       "FROM name_fx", ("name_fx",))
def _(t: Tables):
    return clean.fill_constants(t.name_fx.select("id", "des", "player_name"),
                                {"des": "blank", "player_name": "unknown"})


@query("split_date", "SELECT at_bat_number, split_part(game_date, '-', 1) AS y, split_part(game_date, '-', 2) AS m, "
       "split_part(game_date, '-', 3) AS d FROM raw_fx", ("raw_fx",))
def _(t: Tables):
    day = F.col("game_date")
    return t.raw_fx.select("at_bat_number", text.date_part(day, "year").alias("y"),
                           text.date_part(day, "month").alias("m"), text.date_part(day, "day").alias("d"))


@query("parse_date", "SELECT id, TRY_CAST(CASE WHEN id % 3 = 0 THEN 'no date' ELSE '2021-0' || CAST(id % 9 + 1 AS VARCHAR)"
       " || '-15' END AS DATE) AS parsed FROM name_fx", ("name_fx",))
def _(t: Tables):
    month = F.concat(F.lit("2021-0"), (F.col("id") % 9 + 1).cast("string"), F.lit("-15"))
    return t.name_fx.select("id", text.parse_date(
        F.when(F.col("id") % 3 == 0, "no date").otherwise(month)).alias("parsed"))


_CASES = " ".join(f"WHEN e IN ({quoted(names)}) THEN '{group}'" for group, names in S.EVENT_CLASSES.items())


@query("classify_event", f"SELECT seq, CASE {_CASES} END AS bat_event FROM (SELECT seq, COALESCE(events, description) "
       "AS e FROM pitch_fx)", PITCH)
def _(t: Tables):
    return t.pitch_fx.select("seq", values.classify_event(F.coalesce("events", "description")).alias("bat_event"))


def _one_of(words: list[str]) -> str:
    """The words as one group of a pattern, each as it stands."""
    return "(?:" + "|".join("".join("\\" + c if c in ".()[]{}*+?^$|\\" else c for c in w) for w in words) + ")"


def _before_any(expr: str, words: list[str]) -> str:
    return f"regexp_extract({expr}, '(?s)^(.*?)(?:{_one_of(words)}|$)', 1)"


def _after_all(expr: str, marks: list[str]) -> str:
    return f"regexp_extract({expr}, '(?s)^(?:.*{_one_of(marks)})?(.*)$', 1)"


@query("extract_actor", f"SELECT id, {_before_any('des', S.ACTION_WORDS)} AS actor FROM name_fx", ("name_fx",))
def _(t: Tables):
    return t.name_fx.select("id", text.extract_actor(F.col("des")).alias("actor"))


@query("after_last_base", f"SELECT id, {_after_all('des', S.BASE_MARKS)} AS rest FROM name_fx", ("name_fx",))
def _(t: Tables):
    return t.name_fx.select("id", text.after_last_base(F.col("des")).alias("rest"))


@query("after_challenge", f"SELECT id, {_after_all('des', S.CHALLENGE_MARKS)} AS rest FROM name_fx", ("name_fx",))
def _(t: Tables):
    return t.name_fx.select("id", text.after_challenge(F.col("des")).alias("rest"))


@query("null_if_long", "SELECT id, CASE WHEN length(des) <= 40 THEN des END AS des FROM name_fx", ("name_fx",))
def _(t: Tables):
    return t.name_fx.select("id", text.null_if_long(F.col("des")).alias("des"))


_UNNAMED = f"COALESCE(events IN ({quoted(S.UNNAMED_ACTOR_EVENTS)}), FALSE)"


@query("null_for_events", f"SELECT id, CASE WHEN NOT {_UNNAMED} THEN des END AS des FROM name_fx", ("name_fx",))
def _(t: Tables):
    return t.name_fx.select("id", text.null_for_events(F.col("des"), F.col("events")).alias("des"))


_ACTOR = _after_all(_after_all(_before_any("COALESCE(des, 'blank')", S.ACTION_WORDS), S.BASE_MARKS), S.CHALLENGE_MARKS)


@query("actor_name", f"SELECT id, CASE WHEN NOT {_UNNAMED} AND length(a) <= 40 THEN a END AS actor "
       f"FROM (SELECT id, events, {_ACTOR} AS a FROM name_fx)", ("name_fx",))
def _(t: Tables):
    return t.name_fx.select("id", text.actor_name(F.col("des"), F.col("events")).alias("actor"))


@query("orient_name", "SELECT id, CASE WHEN player_name LIKE '%,%' THEN trim(split_part(player_name, ',', 2)) || ' ' || "
       "trim(split_part(player_name, ',', 1)) END AS name FROM name_fx", ("name_fx",))
def _(t: Tables):
    return t.name_fx.select("id", text.orient_name(F.col("player_name")).alias("name"))


@query("spin_vector", f"SELECT seq, {r6('release_spin_rate * sin(radians(spin_axis))', 'spin_x')}, "
       f"{r6('release_spin_rate * cos(radians(spin_axis))', 'spin_z')} FROM pitch_fx", PITCH)
def _(t: Tables):
    return clean.with_spin_vector(t.pitch_fx).select("seq", "spin_x", "spin_z")


@query("occupied_flags", "SELECT seq, CAST(COALESCE(a, 0) <> 0 AS INTEGER) AS on_1b, CAST(b <> 0 AS INTEGER) AS on_2b "
       "FROM (SELECT seq, CASE WHEN seq % 3 <> 0 THEN batter END AS a, batter % 4 AS b FROM pitch_fx)", PITCH)
def _(t: Tables):
    a, b = F.when(F.col("seq") % 3 != 0, F.col("batter")), F.col("batter") % 4
    return t.pitch_fx.select("seq", values.occupied(a).alias("on_1b"), values.occupied(b).alias("on_2b"))


@query("zero_target_on_strikeout", f"SELECT seq, {r6('CASE WHEN events IN (' + quoted(S.STRIKEOUT_EVENTS) + ') THEN 0.0 ELSE xba END', 'xba')} "
       "FROM pitch_fx", PITCH)
def _(t: Tables):
    return clean.zero_target_on_strikeout(t.pitch_fx, "xba").select("seq", "xba")


_WHOLE = "xba IS NOT NULL AND release_spin_rate IS NOT NULL"


@query("null_all_if_any_null", f"SELECT seq, {r6(f'CASE WHEN {_WHOLE} THEN xba END', 'xba')}, "
       f"{r6(f'CASE WHEN {_WHOLE} THEN release_spin_rate END', 'release_spin_rate')} FROM pitch_fx", PITCH)
def _(t: Tables):
    return t.pitch_fx.select("seq", *values.null_all_if_any_null(["xba", "release_spin_rate"]))


@query("parse_list_column", f"""SELECT vec_id, [{r6("CAST(printf('%.2f', CAST(embedding[1] AS DOUBLE)) AS DOUBLE)")}, NULL,
{r6("CAST(printf('%.2f', CAST(embedding[2] AS DOUBLE)) AS DOUBLE)")}] AS parsed FROM embeddings""")
def _(t: Tables):
    item = lambda i: F.format_string("%.2f", F.element_at("embedding", i).cast("double"))
    packed = F.concat(F.lit("["), item(1), F.lit(", nan, "), item(2), F.lit("]"))
    return t.embeddings.select("vec_id", text.parse_list(packed).alias("parsed"))


@query("abs_all", f"SELECT pitcher, batter, game_date, {r6('abs(xba - 0.05)', 'xba')}, "
       f"{r6('abs(cluster_attribute_1 - 0.05)', 'cluster_attribute_1')} FROM matchup_fx", ("matchup_fx",))
def _(t: Tables):
    names = ["xba", "cluster_attribute_1"]
    moved = t.matchup_fx.withColumns({c: F.col(c) - 0.05 for c in names})
    return moved.withColumns(values.abs_all(names)).select("pitcher", "batter", "game_date", *names)


@query("clean_ratio", f"SELECT pitcher, game_date, {r6('CASE WHEN bb <> 0 THEN CAST(k AS DOUBLE) / bb ELSE 0 END', 'ratio')} "
       "FROM day_fx", ("day_fx",))
def _(t: Tables):
    return t.day_fx.select("pitcher", "game_date", values.clean_ratio(F.col("k"), F.col("bb")).alias("ratio"))


@query("event_indicators", f"SELECT seq, CAST(COALESCE(events IN ({quoted(S.STRIKEOUT_EVENTS)}), FALSE) AS INTEGER) AS k, "
       "CAST(COALESCE(events = 'walk', FALSE) AS INTEGER) AS bb, 1 AS pa FROM pitch_fx", PITCH)
def _(t: Tables):
    from xoutcome.operators.aggregates import event_indicators
    return t.pitch_fx.select("seq", *[c.alias(n) for n, c in event_indicators(F.col("events")).items()])


@query("hard_assign", "SELECT pitcher, batter, game_date, CAST(cluster_attribute_0 >= cluster_attribute_1 AS INTEGER) "
       "AS cluster_0, CAST(cluster_attribute_1 >= cluster_attribute_0 AS INTEGER) AS cluster_1 FROM ("
       "SELECT pitcher, batter, game_date, round(cluster_attribute_0, 6) AS cluster_attribute_0, "
       "round(cluster_attribute_1, 6) AS cluster_attribute_1 FROM matchup_fx)", ("matchup_fx",))
def _(t: Tables):
    soft = ["cluster_attribute_0", "cluster_attribute_1"]
    rows = t.matchup_fx.withColumns({c: F.round(c, 6) for c in soft})
    return rows.select("pitcher", "batter", "game_date", *values.hard_assign(soft))


@query("play_flag", "SELECT pitcher, game_date, CAST(pa - 3 > 0 AS INTEGER) AS play FROM day_fx", ("day_fx",))
def _(t: Tables):
    return t.day_fx.select("pitcher", "game_date", values.play_flag(F.col("pa") - 3).alias("play"))


@query("calendar_parts", "SELECT o_orderkey, CAST(dayofweek(o_orderdate) AS INTEGER) AS day_of_week, "
       "CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def _(t: Tables):
    parts = values.calendar_parts(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("rate_per_pa", f"""SELECT pitcher, game_date,
{r6('CASE WHEN pa - 3 > 0 THEN CAST(k AS DOUBLE) / pa ELSE 0 END', 'k_per_pa')},
{r6('CASE WHEN pa - 3 > 0 THEN CAST(bb AS DOUBLE) / (pa + bb) ELSE 0 END', 'bb_per_pa')} FROM day_fx""", ("day_fx",))
def _(t: Tables):
    rows = t.day_fx.withColumn("play", values.play_flag(F.col("pa") - 3))
    return rate_per_pa(rows).select("pitcher", "game_date", "k_per_pa", "bb_per_pa")


@query("cluster_rate_per_pa", f"""
WITH d AS (SELECT pitcher, game_date, k, pa, bb FROM day_fx),
r AS (SELECT pitcher, game_date, SUM(k) OVER w AS k_roll, SUM(pa + bb) OVER w AS base FROM d
  WINDOW w AS (PARTITION BY pitcher ORDER BY game_date RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT pitcher, game_date, {r6('k_roll / base', 'k_roll_per_pa')} FROM r""", ("day_fx",))
def _(t: Tables):
    return hard_per_pa(t.day_fx, ["k"])


@query("cast_types", f"SELECT pitcher, game_date, CAST(pa AS INTEGER) AS pa, CAST(bb AS DOUBLE) AS bb, {r6s('xba')} "
       "FROM day_fx", ("day_fx",))
def _(t: Tables):
    return cast_types(t.day_fx.select("pitcher", "game_date", "pa", "bb", "xba"), ["pa"], ["bb", "xba"])


@query("weight_target", f"SELECT pitcher, game_date, {r6('xba * pa', 'weighted_target')}, pa AS weighted_pa FROM day_fx",
       ("day_fx",))
def _(t: Tables):
    return t.day_fx.withColumns(values.weight_target("xba", "pa")).select("pitcher", "game_date", "weighted_target", "weighted_pa")
