"""The registered queries written independently in SQL, for the checking engine."""

from __future__ import annotations

from tallyline.queries import tables
from tallyline.plans.ledger import BUCKETS
from tallyline.queries.catalog import AS_OF_DAY, CORRECTED_DAY, FIXED_INTERVAL, SPLIT_DAY

WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _strip(x: str) -> str:
    return f"trim({x}, {WHITE})"


def _quote_name(x: str) -> str:
    return _strip(f"replace(replace(replace(lower({x}), '.', ''), '''', ''), '-', ' ')")


def _entity_name(x: str) -> str:
    text = _strip(x)
    comma = f"strpos({text}, ',')"
    turned = (
        f"CASE WHEN {comma} > 0 THEN substr({text}, {comma} + 1) || ' ' || substr({text}, 1, {comma} - 1) "
        f"ELSE {text} END"
    )
    return f"lower({_strip(f'''regexp_replace(strip_accents({turned}), '[\\s\\v\\p{{Z}}]+', ' ', 'g')''')})"


def _band(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'unknown' WHEN {x} <= 4.5 THEN '<=4.5' WHEN {x} <= 5.5 THEN '4.5-5.5' "
        f"WHEN {x} <= 6.5 THEN '5.5-6.5' WHEN {x} <= 7.5 THEN '6.5-7.5' ELSE '7.5+' END"
    )


def _rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _trailing(column: str, output: str, rows: int, least: int, value: str = "avg({})") -> str:
    frame = f"w ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING"
    return (
        f"CASE WHEN count({column}) OVER ({frame}) >= {least} "
        f"THEN {value.format(column)} OVER ({frame}) END AS {output}"
    )


MEANS = ("strikeouts", "pitches", "batters_faced", "whiff_per_pitch", "avg_velo", "avg_spin")
MEAN_NAMES = [f"{c}_last{n}" for c in MEANS for n in (3, 10)]
DISPERSION_NAMES = ["strikeouts_stddev_last10", "strikeouts_p25_last10", "strikeouts_p75_last10"]
FEATURES = (
    "pitches_last3",
    "pitches_last10",
    "whiff_per_pitch_last3",
    "avg_velo_last3",
    "avg_spin_last3",
    "k_per_pitch_last10",
    "k_rate_last10",
    "opp_strikeouts_per_game_last10",
    "opp_k_rate_last10",
)

_form_columns = ", ".join(
    [_trailing(c, f"{c}_last{n}", n, 1 if n == 3 else 3) for c in MEANS for n in (3, 10)]
    + [
        _trailing("strikeouts", "strikeouts_stddev_last10", 10, 3, "stddev_pop({})"),
        _trailing("strikeouts", "strikeouts_p25_last10", 10, 3, "quantile_cont({}, 0.25)"),
        _trailing("strikeouts", "strikeouts_p75_last10", 10, 3, "quantile_cont({}, 0.75)"),
    ]
)

_spans = ", ".join(
    f"CAST(count(*) FILTER (rn <= {n}) AS BIGINT) AS starts_last{n}_available, "
    + ", ".join(
        f"avg({m}) FILTER (rn <= {n}) AS {m}_last{n}"
        for m in ("strikeouts", "pitches", "batters_faced", "whiffs", "avg_velo", "avg_spin")
    )
    + f", sum(strikeouts) FILTER (rn <= {n}) / nullif(sum(pitches) FILTER (rn <= {n}), 0) AS k_per_pitch_last{n}"
    f", sum(strikeouts) FILTER (rn <= {n}) / nullif(sum(batters_faced) FILTER (rn <= {n}), 0) AS k_rate_last{n}"
    f", sum(whiffs) FILTER (rn <= {n}) / nullif(sum(pitches) FILTER (rn <= {n}), 0) AS whiff_per_pitch_last{n}"
    for n in (3, 5, 10)
)

_books = (
    "CASE {b} WHEN 'draftkings' THEN 'DraftKings' WHEN 'fanduel' THEN 'FanDuel' WHEN 'betmgm' THEN 'BetMGM' "
    "WHEN 'williamhill_us' THEN 'Caesars' ELSE {b} END"
)


def _outcome(book: str, side: str, line: str, price: str) -> str:
    return f"""SELECT 'evt_' || event_id AS event_id, strftime(event_day, '%Y-%m-%d') || 'T18:00:00Z' AS commence_time,
 'HOM' AS home_team, 'AWY' AS away_team, {_books.format(b=book)} AS bookmaker, {book} AS bookmaker_key,
 strftime(event_day, '%Y-%m-%d') AS book_last_update, 'pitcher_strikeouts' AS market_key, player_name,
 {_quote_name('player_name')} AS player_name_norm, {side} AS side, {line} AS line, {price} AS price
 FROM seeds WHERE event_id % 17 <> 0 AND event_id % 11 <> 0"""


_instant = "epoch_us(TRY_CAST({} AS TIMESTAMP))"


def _normalized(source: str) -> str:
    """Raw line rows of one market in the 17-column layout."""
    commence = _instant.format("replace(replace(commence_time, 'T', ' '), 'Z', '')")
    return f"""SELECT game_date, {_strip('player_name')} AS player_name,
 {_quote_name(_strip('player_name'))} AS player_name_norm, market_key, {_strip('bookmaker')} AS bookmaker,
 coalesce(nullif({_strip('bookmaker_key')}, ''), {_strip('bookmaker')}) AS bookmaker_key, {_strip('side')} AS side,
 TRY_CAST(line AS DOUBLE) AS line, TRY_CAST(price AS DOUBLE) AS price, event_id, {commence} AS commence_time,
 'latest_pregame_snapshot_per_game_player_book_side' AS selection_rule,
 coalesce(source, 'native_raw_historical_lines') AS source, {_instant.format('pulled_at')} AS pulled_at,
 'raw_snapshot' AS snapshot_type, false AS is_closing_line, TRY_CAST(snapshot_rank AS DOUBLE) AS snapshot_rank
 FROM ({source}) WHERE market_key = 'pitcher_strikeouts'"""


_pregame = "coalesce(pulled_at <= commence_time, false)"


def _implied(p: str) -> str:
    return f"CASE WHEN {p} < 0 THEN -{p} / (100 - {p}) ELSE 100 / ({p} + 100) END"


def _ranked_sides(source: str, keys: str) -> str:
    """Every quote with its place on its side and its participant's first forecast."""
    return f"""SELECT *, row_number() OVER (PARTITION BY {keys}, side_norm ORDER BY
 CASE WHEN side_norm = 'over' THEN line ELSE -line END, price DESC NULLS LAST, bookmaker, game_date) AS place,
 first_value(predicted_strikeouts) OVER (PARTITION BY {keys} ORDER BY game_date, predicted_strikeouts) AS first_forecast
 FROM (SELECT *, lower({_strip('side')}) AS side_norm FROM {source})"""


def _chosen(ranked: str, keys: str) -> str:
    """The better side of every participant."""
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
 ORDER BY side_edge DESC, CASE WHEN side_norm = 'over' THEN 0 ELSE 1 END) AS pick_place
 FROM (SELECT *, CASE WHEN side_norm = 'over' THEN first_forecast - line ELSE line - first_forecast END AS side_edge
 FROM {ranked} WHERE place = 1 AND side_norm IN ('over', 'under'))) WHERE pick_place = 1"""


def _scored(chosen: str, official: float, lean: float, high: float, medium: float, low: float) -> str:
    return f"""SELECT *, CASE WHEN abs(edge) >= {official} THEN 'official' WHEN abs(edge) >= {lean} THEN 'lean'
 ELSE 'pass' END AS pick_type, CASE WHEN value_score >= {high} THEN 'high' WHEN value_score >= {medium} THEN 'medium'
 WHEN value_score >= {low} THEN 'low' ELSE 'thin' END AS confidence_tier
 FROM (SELECT * EXCLUDE (edge), side_edge AS edge, side_norm AS pick_side, player_name_proj AS player_name,
 bookmaker AS book, {_implied('price')} AS implied_probability,
 abs(side_edge) * (1 - ({_implied('price')})) AS value_score FROM {chosen})"""


def _graded(picks: str) -> str:
    units = "CASE WHEN price > 0 THEN price / 100 ELSE 100 / abs(price) END"
    return f"""SELECT *, outcome = 'win' AS is_win, outcome = 'loss' AS is_loss, outcome = 'push' AS is_push,
 outcome <> 'push' AS decision,
 CASE outcome WHEN 'push' THEN 0.0 WHEN 'loss' THEN -1.0 ELSE {units} END AS profit_units
 FROM (SELECT *, CASE WHEN actual_strikeouts = line THEN 'push'
 WHEN (actual_strikeouts > line) = (pick_side = 'over') THEN 'win' ELSE 'loss' END AS outcome,
 {_band('line')} AS line_band FROM {picks})"""


def _parsed_odds(x: str) -> str:
    return f"nullif(TRY_CAST(ltrim({_strip(x)}, '+') AS DOUBLE), 0)"


# Common tables by name, each may refer to the ones before it.
COMMON = {
    "ev": tables.EVENTS.sql(),
    "fl": """SELECT *, CASE WHEN events IN ('strikeout', 'strikeout_double_play') THEN 1 ELSE 0 END AS is_k,
 CASE WHEN description IN ('swinging_strike', 'swinging_strike_blocked') THEN 1 ELSE 0 END AS is_whiff,
 CASE WHEN inning_topbot = 'Top' THEN home_team ELSE away_team END AS fielding,
 CASE WHEN inning_topbot = 'Top' THEN away_team ELSE home_team END AS batting FROM ev""",
    "per": """SELECT *, whiffs / nullif(pitches, 0) AS whiff_per_pitch FROM (
 SELECT game_date, game_pk, pitcher, player_name, count(pitch_type) AS pitches,
 CAST(sum(is_k) AS BIGINT) AS strikeouts, CAST(sum(is_whiff) AS BIGINT) AS whiffs, avg(release_speed) AS avg_velo,
 avg(release_spin_rate) AS avg_spin, count(DISTINCT batter) AS batters_faced, min(home_team) AS home_team,
 min(away_team) AS away_team, min(p_throws) AS p_throws, min(fielding) AS pitching_team, min(batting) AS opponent_team
 FROM fl WHERE player_name IS NOT NULL GROUP BY game_date, game_pk, pitcher, player_name)""",
    "gp": """SELECT *, team_batter_strikeouts / nullif(batters_faced, 0) AS team_k_rate FROM (
 SELECT game_date, game_pk, batting AS batting_team, CAST(sum(is_k) AS BIGINT) AS team_batter_strikeouts,
 count(DISTINCT batter) AS batters_faced FROM fl GROUP BY game_date, game_pk, batting)""",
    "gf": f"""SELECT *, {_trailing('team_batter_strikeouts', 'opp_strikeouts_per_game_last10', 10, 3)},
 {_trailing('team_k_rate', 'opp_k_rate_last10', 10, 3)}
 FROM gp WINDOW w AS (PARTITION BY batting_team ORDER BY game_date, game_pk)""",
    "form": f"SELECT *, {_form_columns} FROM per WINDOW w AS (PARTITION BY pitcher ORDER BY game_date, game_pk)",
    "hist": """SELECT form.*, gf.opp_strikeouts_per_game_last10, gf.opp_k_rate_last10,
 strikeouts_last10 / nullif(pitches_last10, 0) AS k_per_pitch_last10,
 strikeouts_last10 / nullif(batters_faced_last10, 0) AS k_rate_last10
 FROM form LEFT JOIN gf ON form.game_date = gf.game_date AND form.game_pk = gf.game_pk
 AND form.opponent_team = gf.batting_team""",
    "model": "SELECT game_date, game_pk, pitcher, player_name, strikeouts, "
    + ", ".join([*FEATURES, *DISPERSION_NAMES])
    + " FROM hist WHERE "
    + " AND ".join(f"{f} IS NOT NULL" for f in FEATURES),
    "res": """SELECT *, abs(error) AS abs_error FROM (SELECT *, predicted_strikeouts - actual_strikeouts AS error
 FROM (SELECT *, CAST(strikeouts AS DOUBLE) AS actual_strikeouts,
 k_per_pitch_last10 * pitches_last10 AS predicted_strikeouts FROM model))""",
    "sl": f"SELECT *, {_entity_name('player_name')} AS player_name_norm FROM ({tables.SLATE.sql()})",
    "hs": f"""SELECT *, {_entity_name('player_name')} AS norm FROM hist WHERE pitches >= 40 OR batters_faced >= 12""",
    "matched": """SELECT s.game_pk AS slate_pk, s.game_date AS slate_date, h.* FROM sl s JOIN hs h
 ON h.pitcher = s.pitcher AND h.game_date < s.game_date
 UNION ALL SELECT s.game_pk, s.game_date, h.* FROM sl s JOIN hs h
 ON h.norm = s.player_name_norm AND h.game_date < s.game_date
 WHERE NOT EXISTS (SELECT 1 FROM hs x WHERE x.pitcher = s.pitcher AND x.game_date < s.game_date)""",
    "aged": """SELECT *, row_number() OVER (PARTITION BY slate_pk ORDER BY game_date DESC, game_pk DESC) AS rn
 FROM matched""",
    "served": f"""SELECT slate_pk, count(*) AS career_starts, avg(strikeouts) AS strikeouts_per_game,
 avg(pitches) AS pitches_per_game, avg(batters_faced) AS batters_faced_per_game, avg(whiffs) AS whiffs_per_game,
 sum(strikeouts) / nullif(sum(pitches), 0) AS k_per_pitch, sum(strikeouts) / nullif(sum(batters_faced), 0) AS k_rate,
 sum(whiffs) / nullif(sum(pitches), 0) AS whiff_per_pitch_season, avg(avg_velo) AS avg_velo_season,
 avg(avg_spin) AS avg_spin_season, max(slate_date) - max(game_date) AS days_rest, {_spans},
 stddev_pop(strikeouts) FILTER (rn <= 10) AS strikeouts_stddev_last10,
 quantile_cont(strikeouts, 0.25) FILTER (rn <= 10) AS strikeouts_p25_last10,
 quantile_cont(strikeouts, 0.75) FILTER (rn <= 10) AS strikeouts_p75_last10
 FROM aged GROUP BY slate_pk HAVING count(*) >= 5""",
    "seeds": tables.QUOTE_SEEDS.sql(),
    "quotes": " UNION ALL ".join(
        [
            _outcome("book_a", "'Over'", "line", "price"),
            _outcome("book_a", "' UNDER'", "line", "-price"),
            _outcome("book_b", "'over'", "line + 0.5", "price - 5"),
            _outcome("book_b", "'Under'", "line - 0.5", "CAST(NULL AS DOUBLE)"),
        ]
    ),
    "fc": f"""SELECT player_name, {_quote_name('player_name')} AS norm, 'T' || (user_id % 30) AS team,
 'T' || ((user_id + 7) % 30) AS opponent, avg(line) AS predicted_strikeouts,
 floor(avg(line) + user_id % 3 - 1) AS actual_strikeouts, min(event_day) AS game_date
 FROM seeds GROUP BY user_id, player_name""",
    "joined": """SELECT q.event_id, q.bookmaker, q.side, q.line, q.price, f.player_name AS player_name_proj,
 q.player_name AS player_name_odds, q.player_name_norm, f.team, f.opponent, f.predicted_strikeouts,
 f.actual_strikeouts, f.game_date, f.predicted_strikeouts - q.line AS edge
 FROM fc f JOIN quotes q ON f.norm = q.player_name_norm""",
    "sides": _ranked_sides("joined", "player_name_proj"),
    "picked": _chosen("sides", "player_name_proj"),
    "picks": _scored("picked", 25.0, 15.0, 12.0, 9.0, 7.0),
    "snap": _normalized(tables.RAW_LINES.sql()),
    "cur": f"""SELECT * EXCLUDE (is_closing_line, rn), {_pregame} AS is_closing_line FROM (SELECT *, row_number() OVER (
 PARTITION BY game_date, player_name_norm, bookmaker, side ORDER BY {_pregame} DESC,
 coalesce(pulled_at, commence_time) DESC NULLS LAST, snapshot_rank DESC NULLS LAST, line DESC NULLS LAST,
 price DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM snap) WHERE rn = 1""",
    "dayfc": f"""SELECT player_name, {_quote_name('player_name')} AS norm,
 strftime(event_day, '%Y-%m-%d') AS game_date, avg(line) AS predicted_strikeouts, floor(max(line)) AS actual_strikeouts
 FROM seeds GROUP BY player_name, event_day""",
    "lj": """SELECT f.game_date, f.norm AS player_name_norm, f.player_name AS player_name_proj,
 c.player_name AS player_name_line, c.bookmaker, c.side, c.line, c.price, f.predicted_strikeouts, f.actual_strikeouts,
 f.predicted_strikeouts - c.line AS edge
 FROM dayfc f JOIN cur c ON f.norm = c.player_name_norm AND f.game_date = c.game_date""",
    "daysides": _ranked_sides("lj", "game_date, player_name_proj"),
    "daypicked": _chosen("daysides", "game_date, player_name_proj"),
    "daypicks": _scored("daypicked", 0.75, 0.40, 0.50, 0.30, 0.15),
    "daygraded": _graded("daypicks"),
    "allsides": _ranked_sides("lj", "player_name_proj"),
    "allpicked": _chosen("allsides", "player_name_proj"),
    "allpicks": _scored("allpicked", 0.75, 0.40, 0.50, 0.30, 0.15),
    "allgraded": _graded("allpicks"),
    "ledger": tables.LEDGER.sql(),
    "official": f"""SELECT *, CASE WHEN result_normalized IN ('W', 'L') THEN odds_numeric IS NOT NULL
 ELSE result_normalized = 'Push' END AS gradeable FROM (
 SELECT *, CASE WHEN lower({_strip('result')}) IN ('w', 'win') THEN 'W' WHEN lower({_strip('result')}) IN ('l', 'loss')
 THEN 'L' WHEN lower({_strip('result')}) = 'push' THEN 'Push' ELSE '' END AS result_normalized,
 coalesce({_parsed_odds('odds')}, {_parsed_odds('price')}) AS odds_numeric FROM ledger WHERE pick_type = 'official')""",
    "graded": """SELECT *, CAST(CASE WHEN gradeable AND result_normalized <> 'Push' THEN 1 ELSE 0 END AS DOUBLE) AS units_risked,
 CASE WHEN NOT gradeable THEN NULL WHEN result_normalized = 'Push' THEN 0.0 WHEN result_normalized = 'L' THEN -1.0
 WHEN odds_numeric > 0 THEN odds_numeric / 100 ELSE 100 / abs(odds_numeric) END AS units_result FROM official""",
    "newrows": """SELECT pick_key, sum(quantity) AS quantity FROM (%s) GROUP BY pick_key"""
    % tables.NEW_LEDGER_KEYS.sql(),
    "rawslate": tables.RAW_SLATE.sql(),
}


def _sql(select: str, *commons: str) -> str:
    """A statement with the common tables it needs, in their order of definition."""
    chosen = [name for name in COMMON if name in commons]
    ctes = ", ".join(f"{name} AS ({COMMON[name]})" for name in chosen)
    return f"WITH {ctes} {select}" if ctes else select


PERIODS = ("ev", "fl", "per")
GROUPS = ("ev", "fl", "gp", "gf")
HISTORY = (*PERIODS, "gp", "gf", "form", "hist")
MODEL = (*HISTORY, "model")
RESULTS = (*MODEL, "res")
QUOTES = ("seeds", "quotes")
JOINED = (*QUOTES, "fc", "joined")
PICKS = (*JOINED, "sides", "picked", "picks")
LINES = ("seeds", "snap", "cur", "dayfc", "lj")

_codes = ", ".join(
    f"coalesce(upper({_strip(c)}), '') AS {c}" for c in ("team", "opponent", "home_team", "away_team")
)
_slate_name = f"replace(replace(replace({_strip('player_name')}, '.', ''), '''', ''), '-', ' ')"
_finalized = f"""SELECT game_date, game_pk, pitcher, {_slate_name} AS player_name, {_codes}, is_home, p_throws
 FROM rawslate"""

_served_doubles = [
    "strikeouts_per_game", "pitches_per_game", "batters_faced_per_game", "whiffs_per_game", "k_per_pitch", "k_rate",
    "whiff_per_pitch_season", "avg_velo_season", "avg_spin_season",
    *[
        f"{m}_last{n}"
        for n in (3, 5, 10)
        for m in ("strikeouts", "pitches", "batters_faced", "whiffs", "avg_velo", "avg_spin", "k_per_pitch", "k_rate",
                  "whiff_per_pitch")
    ],
    *DISPERSION_NAMES,
]

_pick_output = (
    "player_name, team, opponent, book, pick_side, line, price, confidence_tier, pick_type, "
    + _rounded("predicted_strikeouts", "edge", "implied_probability", "value_score")
)


def _context(as_of: str) -> str:
    return f"""SELECT opponent_team, opp_strikeouts_per_game_last10, opp_k_rate_last10 FROM (SELECT *, row_number() OVER (
 PARTITION BY opponent_team ORDER BY game_date DESC, game_pk DESC, pitcher DESC) AS rn FROM hist
 WHERE game_date < {as_of}) WHERE rn = 1"""


_backtest_measures = """count(*) AS picks, count(*) FILTER (is_win) AS wins, count(*) FILTER (is_loss) AS losses,
 count(*) FILTER (is_push) AS pushes, count(*) FILTER (decision) AS decisions, round(avg(edge), 6) AS avg_edge,
 round(avg(value_score), 6) AS avg_value_score, round(sum(profit_units), 6) AS profit_units,
 round(count(*) FILTER (is_win) / nullif(count(*) FILTER (decision), 0), 6) AS win_rate,
 round(sum(profit_units) / count(*), 6) AS roi_per_pick"""


def _backtest_group(grouping: str, column: str | None) -> str:
    value = column or "CAST(NULL AS VARCHAR)"
    tail = f" GROUP BY {column}" if column else ""
    return f"SELECT '{grouping}' AS grouping, {value} AS group_value, {_backtest_measures} FROM daygraded{tail}"


_ledger_totals = """count(*) FILTER (result_normalized = 'W') AS wins,
 count(*) FILTER (result_normalized = 'L') AS losses, count(*) FILTER (result_normalized = 'Push') AS pushes,
 CAST(sum(units_risked) AS BIGINT) AS decisions, CAST(sum(units_risked) AS DOUBLE) AS units_risked,
 round(sum(units_result), 6) AS units_profit,
 round(count(*) FILTER (result_normalized = 'W') / nullif(sum(units_risked), 0), 6) AS win_rate,
 round(sum(units_result) / nullif(sum(units_risked), 0), 6) AS roi"""


def _null_check(column: str) -> str:
    return (
        f"SELECT 'non_null' AS check_name, '{column}' AS column_name, "
        f"count(*) FILTER ({column} IS NULL) AS bad_rows FROM rawslate"
    )


def _upserted(column: str, new: str) -> str:
    return f"coalesce(nullif({new}, ''), nullif(o.{column}, ''), '') AS {column}"


_blank_columns = (
    "game_date", "player_name", "team", "opponent", "book", "odds", "price", "pick_side", "line", "edge",
    "confidence_tier",
)

_interval = FIXED_INTERVAL["interval_multiplier"]
_intervals = f"""SELECT *, raw_std_dev * {_interval} AS std_dev,
 greatest(predicted_strikeouts - raw_std_dev * {_interval}, 0) AS lower_bound,
 predicted_strikeouts + raw_std_dev * {_interval} AS upper_bound
 FROM (SELECT *, greatest(coalesce(strikeouts_stddev_last10, 0), 0) AS raw_std_dev FROM res)"""


_history_columns = (
    "game_date, game_pk, opponent_team, pitcher, player_name, pitches, strikeouts, whiffs, "
    "batters_faced, home_team, away_team, p_throws, pitching_team, "
    + _rounded(
        "avg_velo", "avg_spin", "whiff_per_pitch", "opp_strikeouts_per_game_last10", "opp_k_rate_last10",
        *MEAN_NAMES, *DISPERSION_NAMES, "k_per_pitch_last10", "k_rate_last10",
    )
)


def _reached(source: str, key: str) -> str:
    """Rows of the keys of the corrected day, from it to the tenth row after it."""
    return f"""SELECT game_date, {key} AS key FROM (SELECT *, min(i) FILTER (game_date = DATE '{CORRECTED_DAY}')
 OVER (PARTITION BY {key}) AS a, max(i) FILTER (game_date = DATE '{CORRECTED_DAY}') OVER (PARTITION BY {key}) AS b
 FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY game_date, game_pk) AS i FROM {source}))
 WHERE i BETWEEN a AND b + 10"""


def _bucket(key: str) -> str:
    return f"CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {BUCKETS}"


def _document_names(expression: str) -> str:
    return f"SELECT doc_id, {expression} AS name FROM documents"


def statements() -> dict[str, str]:
    scheduled = " UNION ALL ".join(
        f"""SELECT CAST(o_orderdate AS DATE) AS game_date, o_orderkey * 2 + {game} AS game_pk,
 o_orderkey * 4 + {shift} AS pitcher, 'Starter ' || (o_orderkey * 4 + {shift}) AS player_name,
 '{mine}' || (o_custkey % 30) AS team, '{other}' || (o_custkey % 30) AS opponent, 'h' || (o_custkey % 30) AS home_team,
 'a' || (o_custkey % 30) AS away_team, {home} AS is_home,
 CASE WHEN (o_orderkey + {shift}) % 5 <> 0 THEN 'R' END AS p_throws FROM orders WHERE (o_orderkey + {shift}) % 7 <> 0"""
        for game, shift, mine, other, home in (
            (0, 0, "a", "h", 0), (0, 1, "h", "a", 1), (1, 2, "a", "h", 0), (1, 3, "h", "a", 1)
        )
    )
    alternates = " UNION ALL ".join(
        _outcome(book, "'Over'", "line + 10", "price").replace("'pitcher_strikeouts' AS", "'alternates' AS")
        for book in ("book_a", "book_b")
    )
    upserted = _sql(
        "SELECT l.* FROM ledger l WHERE NOT EXISTS (SELECT 1 FROM newrows n WHERE n.pick_key = l.pick_key) "
        "UNION ALL BY NAME SELECT n.pick_key, "
        + ", ".join(f"'' AS {c}" for c in _blank_columns)
        + ", CAST(n.quantity AS VARCHAR) AS predicted_strikeouts, 'official' AS pick_type, "
        + _upserted("result", "CASE WHEN n.quantity % 5 = 0 THEN 'L' ELSE '' END") + ", "
        + _upserted("actual_strikeouts", "''") + ", "
        + _upserted("record_source", "'run_daily_card'")
        + " FROM newrows n LEFT JOIN ledger o ON o.pick_key = n.pick_key", "ledger", "newrows",
    )
    return {
        "event_flags": _sql(
            "SELECT game_date, description, events, count(*) AS n, CAST(sum(is_k) AS BIGINT) AS k, "
            "CAST(sum(is_whiff) AS BIGINT) AS whiffs FROM fl GROUP BY game_date, description, events", "ev", "fl",
        ),
        "event_range": _sql(
            "SELECT game_date, count(*) AS n, count(release_spin_rate) AS known_spin FROM ev "
            "WHERE game_date BETWEEN DATE '1997-01-01' AND DATE '1999-06-30' GROUP BY game_date", "ev",
        ),
        "entity_rollup": _sql(
            "SELECT game_date, game_pk, pitcher, player_name, pitches, strikeouts, whiffs, batters_faced, home_team, "
            f"away_team, p_throws, {_rounded('avg_velo', 'avg_spin', 'whiff_per_pitch')} FROM per", *PERIODS,
        ),
        "fielding_lookup": _sql(
            "SELECT game_date, game_pk, pitcher, min(fielding) AS pitching_team, min(batting) AS opponent_team "
            "FROM fl GROUP BY game_date, game_pk, pitcher", "ev", "fl",
        ),
        "group_info_join": _sql(
            "SELECT game_date, game_pk, pitcher, pitches, pitching_team, opponent_team FROM per", *PERIODS
        ),
        "group_offense": _sql(
            "SELECT game_date, game_pk, batting_team, team_batter_strikeouts, batters_faced, "
            f"{_rounded('team_k_rate', 'opp_strikeouts_per_game_last10', 'opp_k_rate_last10')} FROM gf", *GROUPS,
        ),
        "trailing_means": _sql(f"SELECT game_pk, pitcher, {_rounded(*MEAN_NAMES)} FROM form", *PERIODS, "form"),
        "trailing_dispersion": _sql(
            f"SELECT game_pk, pitcher, strikeouts, {_rounded(*DISPERSION_NAMES)} FROM form", *PERIODS, "form"
        ),
        "opponent_context_join": _sql(
            "SELECT game_date, game_pk, pitcher, pitching_team, opponent_team, "
            f"{_rounded('opp_strikeouts_per_game_last10', 'opp_k_rate_last10')} FROM hist", *HISTORY,
        ),
        "trailing_blocks": _sql(
            f"SELECT game_pk, pitcher, {_rounded(*MEAN_NAMES, *DISPERSION_NAMES)} FROM form", *PERIODS, "form"
        ),
        "rate_features": _sql(
            f"SELECT game_pk, pitcher, {_rounded('k_per_pitch_last10', 'k_rate_last10')} FROM hist", *HISTORY
        ),
        "starter_filter": _sql(
            "SELECT game_date, game_pk, pitcher, pitches, batters_faced FROM per "
            "WHERE pitches >= 25 OR batters_faced >= 18", *PERIODS,
        ),
        "entity_history": _sql(f"SELECT {_history_columns} FROM hist", *HISTORY),
        "history_read": _sql(f"SELECT {_history_columns} FROM hist", *HISTORY),
        "slate_read": f"SELECT * REPLACE ({', '.join(f'trim({c}) AS {c}' for c in ('player_name', 'team', 'opponent', 'home_team', 'away_team', 'p_throws'))}) "
        f"FROM ({tables.SLATE.sql()})",
        "ledger_read": "SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in tables.LEDGER.columns)
        + f" FROM ({tables.LEDGER.sql()})",
        "history_incremental": _sql(f"SELECT {_history_columns} FROM hist", *HISTORY),
        "history_update_counts": _sql(
            "SELECT 1::INTEGER AS step, (SELECT count(DISTINCT game_date) FROM ev) AS days_delivered, "
            "(SELECT count(DISTINCT pitcher) FROM per) AS entities_touched, "
            "(SELECT count(DISTINCT batting_team) FROM gp) AS groups_touched, "
            "(SELECT count(DISTINCT game_date) FROM per) AS history_days_written UNION ALL "
            f"SELECT 2::INTEGER, (SELECT count(DISTINCT game_date) FROM ev WHERE game_date = DATE '{CORRECTED_DAY}'), (SELECT count(DISTINCT key) FROM ({_reached('per', 'pitcher')})), "
            f"(SELECT count(DISTINCT key) FROM ({_reached('gp', 'batting_team')})), (SELECT count(*) FROM ("
            f"SELECT game_date FROM ({_reached('per', 'pitcher')}) UNION "
            f"SELECT game_date FROM ({_reached('gp', 'batting_team')})))", *PERIODS, "gp",
        ),
        "latest_row": _sql(
            "SELECT pitcher, game_date, game_pk, strikeouts, pitches FROM (SELECT *, row_number() OVER "
            "(PARTITION BY pitcher ORDER BY game_date DESC, game_pk DESC) AS rn FROM per) WHERE rn = 1", *PERIODS,
        ),
        "latest_context_asof": _sql(
            "SELECT opponent_team, " + _rounded("opp_strikeouts_per_game_last10", "opp_k_rate_last10")
            + f" FROM ({_context(f'''DATE '{AS_OF_DAY}' ''')})", *HISTORY,
        ),
        "context_asof_rows": _sql(
            "SELECT game_pk, game_date, opponent, " + _rounded("opp_strikeouts_per_game_last10", "opp_k_rate_last10")
            + " FROM (SELECT s.game_pk, s.game_date, s.opponent, h.opp_strikeouts_per_game_last10, h.opp_k_rate_last10, "
            "row_number() OVER (PARTITION BY s.game_pk ORDER BY h.game_date DESC, h.game_pk DESC, h.pitcher DESC) AS rn "
            "FROM sl s LEFT JOIN hist h ON h.opponent_team = s.opponent AND h.game_date < s.game_date) WHERE rn = 1",
            *HISTORY, "sl",
        ),
        "model_table": _sql(
            "SELECT game_date, game_pk, pitcher, player_name, strikeouts, "
            + _rounded(*FEATURES, *DISPERSION_NAMES) + " FROM model", *MODEL,
        ),
        "time_split": _sql(
            "SELECT part, count(*) AS n, CAST(sum(strikeouts) AS BIGINT) AS strikeouts, "
            "strftime(min(game_date), '%Y-%m-%d') AS first_day, strftime(max(game_date), '%Y-%m-%d') AS last_day FROM "
            f"(SELECT *, CASE WHEN game_date < DATE '{SPLIT_DAY}' THEN 'train' ELSE 'test' END AS part FROM model) "
            "GROUP BY part", *MODEL,
        ),
        "gbt_train_score": _sql(
            "SELECT game_date, game_pk, pitcher, strikeouts, true AS sound FROM model "
            f"WHERE game_date >= DATE '{SPLIT_DAY}'", *MODEL,
        ),
        "gbt_score_latest": _sql(
            "SELECT game_date, pitcher, strikeouts, true AS sound FROM (SELECT *, row_number() OVER "
            "(PARTITION BY pitcher ORDER BY game_date DESC, game_pk DESC) AS rn FROM model) WHERE rn = 1", *MODEL,
        ),
        "gbt_learns": _sql(
            f"SELECT count(*) AS n, true AS below_mean FROM model WHERE game_date < DATE '{SPLIT_DAY}'", *MODEL
        ),
        "set_published": _sql(
            "SELECT game_date, game_pk, pitcher, strikeouts, true AS sound FROM model "
            f"WHERE game_date >= DATE '{SPLIT_DAY}'", *MODEL,
        ),
        "training_metadata": _sql(
            "SELECT unnest(['train_start', 'train_end', 'test_start', 'test_end', 'model_table_rows', 'train_rows', "
            "'test_rows', 'rounds', 'interval_rows', 'bucket_rows', 'backtest']) AS name, unnest(["
            f"strftime(min(game_date) FILTER (game_date < DATE '{SPLIT_DAY}'), '%Y-%m-%d'), "
            f"strftime(max(game_date) FILTER (game_date < DATE '{SPLIT_DAY}'), '%Y-%m-%d'), "
            f"strftime(min(game_date) FILTER (game_date >= DATE '{SPLIT_DAY}'), '%Y-%m-%d'), "
            f"strftime(max(game_date) FILTER (game_date >= DATE '{SPLIT_DAY}'), '%Y-%m-%d'), "
            f"count(*)::VARCHAR, (count(*) FILTER (game_date < DATE '{SPLIT_DAY}'))::VARCHAR, "
            f"(count(*) FILTER (game_date >= DATE '{SPLIT_DAY}'))::VARCHAR, '200', "
            f"(count(*) FILTER (game_date >= DATE '{SPLIT_DAY}'))::VARCHAR, "
            f"(count(*) FILTER (game_date >= DATE '{SPLIT_DAY}'))::VARCHAR, "
            "'historical_market_lines_not_provided']) AS value FROM model", *MODEL,
        ),
        "gbt_train": _sql(
            f"SELECT count(*) AS n, 200::BIGINT AS rounds FROM model WHERE game_date < DATE '{SPLIT_DAY}'", *MODEL
        ),
        "gbt_error_by_round": "SELECT range::INTEGER AS round, true AS known, true AS below_first, "
        "CASE WHEN range = 200 THEN true END AS last_is_rmse FROM range(1, 201)",
        "feature_importance": "SELECT 1.0::DOUBLE AS total_gain, true AS known, true AS \"distinct\"",
        "date_ranges": _sql(
            "SELECT strftime(min(game_date), '%Y-%m-%d') AS start, strftime(max(game_date), '%Y-%m-%d') AS \"end\" "
            "FROM ev", "ev",
        ),
        "serving_features": _sql(
            "SELECT sl.game_date, sl.game_pk, sl.pitcher, sl.player_name, sl.team, sl.opponent, sl.home_team, "
            "sl.away_team, sl.is_home, sl.p_throws, sl.player_name_norm, v.career_starts, "
            "CAST(v.days_rest AS INTEGER) AS days_rest, v.starts_last3_available, v.starts_last5_available, "
            "v.starts_last10_available, " + ", ".join(f"round(v.{c}, 6) AS {c}" for c in _served_doubles)
            + ", round(v.strikeouts_last3 - v.strikeouts_last10, 6) AS k_trend_last3_vs_last10, "
            "round(v.avg_velo_last3 - v.avg_velo_last10, 6) AS velo_trend_last3_vs_last10, "
            "round(v.whiff_per_pitch_last3 - v.whiff_per_pitch_last10, 6) AS whiff_trend_last3_vs_last10, "
            "round(c.opp_strikeouts_per_game_last10, 6) AS opp_strikeouts_per_game_last10, "
            "round(c.opp_k_rate_last10, 6) AS opp_k_rate_last10 FROM sl JOIN served v ON v.slate_pk = sl.game_pk "
            f"LEFT JOIN ({_context(f'''DATE '{AS_OF_DAY}' ''')}) c ON c.opponent_team = sl.opponent",
            *HISTORY, "sl", "hs", "matched", "aged", "served",
        ),
        "slate_serving": _sql(
            "SELECT sl.game_pk, CAST(v.days_rest AS INTEGER) AS days_rest, "
            + ", ".join(f"round({'c' if f.startswith('opp_') else 'v'}.{f}, 6) AS {f}" for f in FEATURES)
            + " FROM sl JOIN served v ON v.slate_pk = sl.game_pk "
            f"LEFT JOIN ({_context('(SELECT min(game_date) FROM sl)')}) c ON c.opponent_team = sl.opponent",
            *HISTORY, "sl", "hs", "matched", "aged", "served",
        ),
        "slate_finalize": _sql(_finalized, "rawslate"),
        "slate_distinct": _sql(
            "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY game_date, game_pk, pitcher ORDER BY "
            "player_name, team, opponent NULLS FIRST, home_team, away_team, is_home, p_throws NULLS FIRST) AS rn "
            "FROM rawslate) WHERE rn = 1", "rawslate",
        ),
        "home_away_check": _sql(
            f"SELECT game_date, count(*) AS bad_rows FROM ({_finalized}) WHERE (is_home = 1 AND team <> home_team) "
            "OR (is_home = 0 AND team <> away_team) GROUP BY game_date", "rawslate",
        ),
        "contract_checks": _sql(
            "SELECT 'non_empty' AS check_name, '*' AS column_name, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS bad_rows "
            "FROM rawslate UNION ALL "
            + " UNION ALL ".join(
                _null_check(c)
                for c in ("game_date", "game_pk", "player_name", "team", "opponent", "home_team", "away_team", "is_home")
            )
            + " UNION ALL SELECT 'zero_one', 'is_home', count(*) FILTER (is_home NOT IN (0, 1)) FROM rawslate "
            "UNION ALL SELECT 'unique', 'game_date,game_pk,player_name', coalesce(CAST(sum(n) AS BIGINT), 0) FROM "
            "(SELECT count(*) AS n FROM rawslate GROUP BY game_date, game_pk, player_name HAVING count(*) > 1)",
            "rawslate",
        ),
        "names_entity": _document_names(_entity_name("text")),
        "names_entity_exact": _document_names(_entity_name("text")),
        "names_quote": _document_names(_quote_name("text")),
        "names_slate": _document_names(_slate_name.replace("player_name", "text")),
        "names_canonical": _document_names(
            _entity_name("replace(replace(replace(text, '.', ''), '''', ''), '-', ' ')")
        ),
        "quotes_flatten": _sql("SELECT * FROM quotes", *QUOTES),
        "quotes_alternates": _sql(alternates, "seeds"),
        "quotes_broken": _sql(
            "SELECT * FROM quotes WHERE CAST(substr(event_id, 5) AS BIGINT) % 19 <> 0 "
            "AND CAST(substr(event_id, 5) AS BIGINT) % 23 <> 0", *QUOTES,
        ),
        "documents_set_aside": _sql(
            "SELECT count(*) AS rows, count(*) FILTER (event_id % 19 <> 0 AND event_id % 23 <> 0) AS good_rows, "
            "count(*) FILTER (event_id % 19 = 0 OR event_id % 23 = 0) AS bad_rows FROM seeds", "seeds",
        ),
        "schedule_flatten": scheduled,
        "slate_build": "SELECT * REPLACE (upper(team) AS team, upper(opponent) AS opponent, "
        f"upper(home_team) AS home_team, upper(away_team) AS away_team) FROM ({scheduled})",
        "lines_normalize": _normalized(tables.DIRTY_LINES.sql()),
        "lines_curate": _sql("SELECT * FROM cur", "snap", "cur"),
        "lines_landed": _sql("SELECT * FROM snap", "snap"),
        "lines_streamed_state": _sql("SELECT * FROM cur", "snap", "cur"),
        "lines_checked": " UNION ALL ".join(
            [
                f"SELECT 'null {c}' AS problem, count(*) AS counted, count(*) AS n FROM ({_normalized(tables.DIRTY_LINES.sql())}) "
                f"WHERE {c} IS NULL HAVING count(*) > 0"
                for c in ("line", "price")
            ]
            + [
                f"SELECT 'good', count(*), count(*) FROM ({_normalized(tables.DIRTY_LINES.sql())}) "
                "WHERE line IS NOT NULL AND price IS NOT NULL"
            ]
        ),
        "lines_published": _sql("SELECT * FROM cur", "snap", "cur"),
        "lines_streamed": _sql("SELECT * FROM cur", "snap", "cur"),
        "forecast_quote_join": _sql(
            "SELECT event_id, bookmaker, side, line, price, player_name_proj, player_name_odds, player_name_norm, "
            f"team, {_rounded('predicted_strikeouts', 'edge')} FROM joined", *JOINED,
        ),
        "forecast_quote_collation": _sql(
            "SELECT event_id, bookmaker, side, line, price, player_name_proj, "
            "translate(upper(player_name_odds), 'ELI', 'ÉĽÎ') AS player_name_odds, "
            f"{_rounded('edge')} FROM joined", *JOINED,
        ),
        "forecast_lines_join": _sql(
            "SELECT game_date, player_name_norm, player_name_proj, player_name_line, bookmaker, side, line, price, "
            f"actual_strikeouts, {_rounded('predicted_strikeouts', 'edge')} FROM lj", *LINES,
        ),
        "best_over": _sql(
            "SELECT player_name_proj, bookmaker, line, price, side, "
            f"{_rounded('predicted_strikeouts', 'edge')} FROM (SELECT *, row_number() OVER (PARTITION BY "
            "player_name_proj ORDER BY edge DESC, bookmaker DESC, line DESC, price DESC, side DESC) AS rn FROM joined "
            "WHERE lower(side) = 'over') WHERE rn = 1", *JOINED,
        ),
        "best_quote_side": _sql(
            "SELECT player_name_proj, side_norm, bookmaker, line, price FROM sides WHERE place = 1", *JOINED, "sides"
        ),
        "daily_picks": _sql(f"SELECT {_pick_output} FROM picks", *PICKS),
        "postable_picks": _sql(
            f"SELECT {_pick_output} FROM (SELECT *, row_number() OVER (PARTITION BY pick_type ORDER BY "
            "value_score DESC NULLS LAST, player_name) AS rn FROM picks) "
            "WHERE (pick_type = 'official' AND rn <= 4) OR (pick_type = 'lean' AND rn <= 2)", *PICKS,
        ),
        "grade_picks": _sql(
            "SELECT player_name, pick_side, line, actual_strikeouts, outcome, is_win, is_loss, is_push, decision, "
            f"round(profit_units, 6) AS profit_units, line_band FROM ({_graded('picks')})", *PICKS,
        ),
        "backtest_summary": _sql(
            " UNION ALL ".join(
                _backtest_group(name, column)
                for name, column in (
                    ("overall", None), ("by_pick_type", "pick_type"), ("by_confidence_tier", "confidence_tier"),
                    ("by_book", "book"), ("by_line_band", "line_band"), ("by_pick_side", "pick_side"),
                )
            ),
            *LINES, "daysides", "daypicked", "daypicks", "daygraded",
        ),
        "backtest_participant": _sql(
            "SELECT player_name, book, pick_side, line, pick_type, outcome, "
            f"{_rounded('edge', 'profit_units')} FROM allgraded",
            *LINES, "allsides", "allpicked", "allpicks", "allgraded",
        ),
        "backtest_status": _sql(
            "SELECT count(actual_strikeouts) > 0 AS available, CASE WHEN count(*) = 0 THEN "
            "'no_matching_historical_lines_for_projections' WHEN count(actual_strikeouts) = 0 THEN "
            "'no_rows_with_realized_outcomes' END AS reason, count(DISTINCT player_name_proj) AS graded_pick_rows "
            "FROM lj", *LINES,
        ),
        "backtest_unavailable": _sql(
            "SELECT false AS available, 'no_matching_historical_lines_for_projections' AS reason, "
            "(SELECT count(*) FROM lj WHERE game_date < '1900-01-01') AS graded_pick_rows UNION ALL "
            "SELECT count(*) < 0, CASE WHEN count(*) = 0 THEN 'no_matching_historical_lines_for_projections' "
            "ELSE 'no_rows_with_realized_outcomes' END, 0 FROM lj", *LINES,
        ),
        "ledger_rows": _sql(
            "SELECT strftime(game_date + 3, '%Y-%m-%d') || '|' || lower(player_name) AS pick_key, "
            "strftime(game_date + 3, '%Y-%m-%d') AS game_date, player_name, team, opponent, book, "
            "coalesce(CASE WHEN price > 0 THEN '+' ELSE '' END || CAST(CAST(price AS BIGINT) AS VARCHAR), '') AS odds, "
            "pick_side, confidence_tier, pick_type, '' AS result, '' AS actual_strikeouts, "
            "'run_daily_card' AS record_source FROM picks WHERE pick_type = 'official'", *PICKS,
        ),
        "ledger_upsert": upserted,
        "ledger_bucketed": upserted,
        "ledger_buckets_written": _sql(
            f"SELECT bucket, count(*) AS n, bool_or(fresh) AS written FROM (SELECT {_bucket('pick_key')} AS bucket, "
            f"{_bucket('pick_key')} IN (SELECT {_bucket('pick_key')} FROM (SELECT pick_key FROM newrows ORDER BY "
            "pick_key LIMIT 10)) AS fresh FROM (SELECT pick_key FROM ledger UNION SELECT pick_key FROM "
            "(SELECT pick_key FROM newrows ORDER BY pick_key LIMIT 10))) GROUP BY bucket", "ledger", "newrows",
        ),
        "ledger_graded": _sql(
            "SELECT pick_key, book, odds, price, result, result_normalized, odds_numeric, gradeable, units_risked, "
            "round(units_result, 6) AS units_result FROM graded", "ledger", "official", "graded",
        ),
        "ledger_by_book": _sql(
            f"SELECT book, count(*) AS picks, {_ledger_totals} FROM graded WHERE gradeable GROUP BY book",
            "ledger", "official", "graded",
        ),
        "ledger_overall": _sql(
            f"SELECT count(DISTINCT book) AS books, count(*) AS picks, {_ledger_totals}, "
            "(SELECT count(*) FROM graded WHERE NOT gradeable) AS skipped_rows FROM graded WHERE gradeable",
            "ledger", "official", "graded",
        ),
        "prediction_results": _sql(
            f"SELECT game_pk, pitcher, actual_strikeouts, {_rounded('predicted_strikeouts', 'error', 'abs_error')} "
            "FROM res", *RESULTS,
        ),
        "regression_metrics": _sql(
            "SELECT round(avg(abs_error), 6) AS mae, round(sqrt(avg(error * error)), 6) AS rmse, "
            "round(quantile_cont(abs_error, 0.5), 6) AS median_absolute_error, round(avg(error), 6) AS bias, "
            "round(quantile_cont(abs_error, 0.75), 6) AS abs_error_p75, "
            "round(quantile_cont(abs_error, 0.9), 6) AS abs_error_p90, round(min(predicted_strikeouts), 6) AS pred_min, "
            "round(max(predicted_strikeouts), 6) AS pred_max, min(actual_strikeouts) AS actual_min, "
            "max(actual_strikeouts) AS actual_max FROM res", *RESULTS,
        ),
        "sketched_quantiles": _sql(
            "SELECT days, probability, n, true AS near FROM (SELECT 'all' AS days, count(abs_error) AS n FROM res UNION ALL "
            f"SELECT 'before split', count(abs_error) FROM res WHERE game_date <= DATE '{SPLIT_DAY}'), "
            "(SELECT unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS probability)", *RESULTS,
        ),
        "interval_fit": _sql(
            "SELECT 'strikeouts_stddev_last10' AS base_stddev_column, CAST(0.8 AS DOUBLE) AS nominal_coverage, "
            "round(quantile_cont(abs_error / strikeouts_stddev_last10, 0.8), 6) AS interval_multiplier, "
            "count(*) AS calibration_rows FROM res WHERE strikeouts_stddev_last10 > 0", *RESULTS,
        ),
        "interval_apply": _sql(
            f"SELECT game_pk, pitcher, {_rounded('raw_std_dev', 'std_dev', 'lower_bound', 'upper_bound')}, "
            f"CAST({FIXED_INTERVAL['nominal_coverage']} AS DOUBLE) AS interval_coverage_target, "
            f"CAST({_interval} AS DOUBLE) AS interval_multiplier FROM ({_intervals})", *RESULTS,
        ),
        "interval_coverage": _sql(
            "SELECT 'fixed' AS interval_method, CAST(0.8 AS DOUBLE) AS nominal_coverage, "
            "round(avg(CAST(actual_strikeouts BETWEEN lower_bound AND upper_bound AS INT)), 6) AS empirical_coverage, "
            "round(avg(upper_bound - lower_bound), 6) AS mean_interval_width, round(avg(std_dev), 6) AS mean_half_width, "
            "round(avg(CAST(actual_strikeouts < lower_bound AS INT)), 6) AS miss_rate_below_lower_bound, "
            "round(avg(CAST(actual_strikeouts > upper_bound AS INT)), 6) AS miss_rate_above_upper_bound, "
            f"count(*) AS rows FROM ({_intervals})", *RESULTS,
        ),
        "error_buckets": _sql(
            f"SELECT {_band('predicted_strikeouts')} AS error_bucket, count(*) AS rows, "
            "round(avg(actual_strikeouts), 6) AS mean_actual, round(avg(predicted_strikeouts), 6) AS mean_prediction, "
            "round(avg(abs_error), 6) AS mae, round(avg(error), 6) AS bias FROM res GROUP BY 1", *RESULTS,
        ),
    }
