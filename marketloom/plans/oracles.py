"""SQL that gives the rows of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from ..schemas import PRICE_COLUMNS
from .views import LATEST_RESULTS_SQL, LISTING_FILE_SQL, LISTINGS_SQL, NEW_PRICES_SQL, PRICES_SQL, RESULTS_SQL, RUN_LOG_SQL, SECURITIES_SQL, SESSIONS_SQL, TRANSITIONS_SQL

W = "OVER (PARTITION BY security_id ORDER BY date)"
RET = ", ".join(f"adj_close / lag(adj_close, {n}) {W} - 1 AS ret_{n}d" for n in (1, 2, 5, 10, 20, 60, 120))
RETURNS = f"{PRICES_SQL}, returns AS (SELECT security_id, ticker, date, adj_close, adj_volume, volume, div_cash, split_factor, {RET} FROM prices)"


def _lagged(f: str, x: str, n: int) -> str:
    return f"{f}({x}) OVER (PARTITION BY security_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


FEATURES = f"""{RETURNS},
base AS (SELECT *, adj_close * adj_volume AS dollar_volume, round(ln(1 + adj_close * adj_volume), 6) AS log_dollar_volume FROM returns),
rolled AS (SELECT *, lag(ret_1d, 1) {W} AS ret_1d_lag1, lag(ret_1d, 2) {W} AS ret_1d_lag2, lag(ret_5d, 1) {W} AS ret_5d_lag1, lag(ret_5d, 2) {W} AS ret_5d_lag2, lag(ret_20d, 1) {W} AS ret_20d_lag1,
    {_lagged("avg", "dollar_volume", 20)} AS avg_dollar_volume_20d_lagged, {_lagged("avg", "dollar_volume", 60)} AS avg_dollar_volume_60d_lagged, {_lagged("avg", "adj_volume", 20)} AS avg_volume_20d_lagged,
    {_lagged("stddev_samp", "dollar_volume", 20)} AS sd_dollars, {_lagged("stddev_samp", "adj_volume", 20)} AS sd_volume,
    round({_lagged("stddev_samp", "ret_1d", 20)}, 6) AS volatility_20d_lagged, round({_lagged("stddev_samp", "ret_1d", 60)}, 6) AS volatility_60d_lagged,
    {_lagged("max", "ret_1d", 20)} AS max_ret_20d_lagged, {_lagged("min", "ret_1d", 20)} AS min_ret_20d_lagged,
    {_lagged("max", "adj_close", 20)} AS high20, {_lagged("min", "adj_close", 20)} AS low20, {_lagged("max", "adj_close", 60)} AS high60, {_lagged("min", "adj_close", 60)} AS low60 FROM base),
features AS (SELECT * EXCLUDE (sd_dollars, sd_volume, high20, low20, high60, low60),
    round((dollar_volume - avg_dollar_volume_20d_lagged) / nullif(sd_dollars, 0), 6) AS dollar_volume_zscore_20d_lagged,
    round((adj_volume - avg_volume_20d_lagged) / nullif(sd_volume, 0), 6) AS volume_zscore_20d_lagged,
    adj_close / nullif(high20, 0) - 1 AS close_to_20d_high_lagged, adj_close / nullif(low20, 0) - 1 AS close_to_20d_low_lagged,
    adj_close / nullif(high60, 0) - 1 AS close_to_60d_high_lagged, adj_close / nullif(low60, 0) - 1 AS close_to_60d_low_lagged,
    CAST(dayofweek(date) AS BIGINT) AS day_of_week, CAST(month(date) AS BIGINT) AS month FROM rolled)"""


def _changes(by: str) -> str:
    return f"""steps AS (SELECT {by}, "at", sum(step) AS step FROM (
            SELECT {by}, started_at AS "at", 1 AS step FROM intervals WHERE outcome IN ('open', 'success', 'failed')
            UNION ALL SELECT {by}, CASE WHEN outcome = 'open' THEN greatest(started_at, TIMESTAMP '2030-01-01 00:00:00') ELSE ended_at END, -1 FROM intervals WHERE outcome IN ('open', 'success', 'failed'))
        GROUP BY 1, 2 HAVING sum(step) <> 0),
        changes AS (SELECT {by}, "at", CAST(sum(step) OVER (PARTITION BY {by} ORDER BY "at") AS BIGINT) AS running FROM steps)"""


LEADS = ", ".join(f"lead(adj_close, {n}) {W} / adj_close - 1 AS fwd_ret_{n}d" for n in (1, 5, 20))
DIRECTIONS = ", ".join(f"CAST(CASE WHEN fwd_ret_{n}d IS NULL THEN NULL WHEN fwd_ret_{n}d > 0 THEN 1 ELSE 0 END AS INTEGER) AS label_direction_{n}d" for n in (5, 20))
LABELS = f"{PRICES_SQL}, ahead AS (SELECT security_id, ticker, date, adj_close, {LEADS} FROM prices), labels AS (SELECT *, {DIRECTIONS} FROM ahead)"
BOTH = f"{PRICES_SQL}, {NEW_PRICES_SQL}, both_loads AS (SELECT * FROM prices UNION ALL SELECT * FROM new_prices)"

MANIFEST = f"""{PRICES_SQL}, {NEW_PRICES_SQL},
months AS (SELECT DISTINCT year(date) AS y, month(date) AS m FROM new_prices),
keyed AS (SELECT year(date) AS y, month(date) AS m, security_id, date, count(*) FILTER (side = 1) AS o, count(*) FILTER (side = 2) AS n
    FROM (SELECT security_id, date, 1 AS side FROM prices UNION ALL SELECT security_id, date, 2 FROM new_prices) GROUP BY ALL),
manifest AS (SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, CAST(sum(o) AS BIGINT) AS existing_row_count, CAST(sum(n) AS BIGINT) AS new_row_count,
    count(*) FILTER (o > 0 AND n > 0) AS overlap_key_count, count(*) FILTER (o = 0) AS inserted_key_count, count(*) AS final_row_count
    FROM keyed JOIN months USING (y, m) GROUP BY y, m)"""

COLLAPSED = f"""{LISTINGS_SQL}, collapsed AS (
    SELECT ticker, exchange, asset_type, price_currency, min(source_ticker) AS source_ticker, min(start_date) AS start_date, max(end_date) AS end_date, count(*) AS raw_listing_row_count
    FROM listings GROUP BY 1, 2, 3, 4)"""
VENUE = "CASE exchange WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 WHEN 'MACHINERY' THEN 4 ELSE 99 END"
RANKED = f"""{COLLAPSED}, ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY ticker ORDER BY CASE asset_type WHEN 'Stock' THEN 1 WHEN 'ETF' THEN 2 ELSE 99 END, coalesce(price_currency = 'USD', false) DESC,
        {VENUE} < 99 DESC, {VENUE}, (start_date IS NOT NULL AND end_date IS NOT NULL) DESC, end_date IS NOT NULL DESC, end_date DESC NULLS LAST,
        coalesce(date_diff('day', start_date, end_date), -1) DESC, start_date ASC NULLS LAST, exchange NULLS LAST, asset_type NULLS LAST, price_currency NULLS LAST) AS INTEGER) AS canonical_rank,
        count(*) OVER (PARTITION BY ticker) AS ticker_duplicate_count FROM collapsed)"""

#: Ticker endings of rights, warrants, units and preferred shares: fixed values.
PATTERN = "|".join(["-R$", "-RT$", "-WS$", "-W$", "-WT$", "-U$", "-UN$", "-P-[A-Z]$", "-P[A-Z]$", "^[A-Z]{4}U$", "^[A-Z]{4}W$", "^[A-Z]{4}R$", "^[A-Z]{3,5}WS$", "^[A-Z]{3,5}WT$", "^[A-Z]{3,5}WW$", "/"])
STEPS = [
    ("required_fields", "security_id IS NOT NULL AND ticker <> '' AND exchange IS NOT NULL AND asset_type IS NOT NULL AND price_currency IS NOT NULL"),
    ("asset_type", "upper(asset_type) = 'STOCK'"),
    ("currency", "upper(price_currency) = 'USD'"),
    ("exchange", "upper(exchange) IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"),
    ("start_date", "start_date <= DATE '2021-06-01'"),
    ("end_date", "end_date >= DATE '2019-01-01'"),
    ("no_hyphen", "NOT contains(ticker, '-')"),
    ("ticker_pattern", f"NOT regexp_matches(ticker, '{PATTERN}')"),
    ("name_words", "NOT regexp_matches(coalesce(company_name, ''), 'ETF|ETN|Fund|Trust|Warrant|Unit|Right|Preferred|Notes|Bond', 'i')"),
]
POOL = f"""{SECURITIES_SQL}, cleaned AS (SELECT security_id, upper(trim(ticker)) AS ticker, exchange, asset_type, CASE WHEN price_currency NOT IN ('', 'nan', 'NaN', 'None') THEN price_currency END AS price_currency,
    start_date, end_date, company_name, is_active FROM securities),
pool AS (SELECT * FROM cleaned WHERE {" AND ".join(f"({c})" for _, c in STEPS)})"""
_SOFAR = [" AND ".join(f"coalesce({c}, false)" for _, c in STEPS[: i + 1]) for i in range(len(STEPS))]
FUNNEL = " UNION ALL ".join(["SELECT 0 AS place, 'all_rows' AS step, count(*) AS survivors FROM cleaned", *[f"SELECT {i + 1}, '{n}', count(*) FILTER ({_SOFAR[i]}) FROM cleaned" for i, (n, _) in enumerate(STEPS)]])
TASKS = f"""{POOL}, tasks AS (SELECT 'bootstrap:vendor:daily:' || ticker || ':2019-01-01:2026-06-11' AS task_id, 'bootstrap' AS task_list_name, 'vendor' AS source, 'daily' AS dataset_name,
    security_id, ticker, DATE '2019-01-01' AS requested_start_date, DATE '2026-06-11' AS requested_end_date, CAST(100 AS INTEGER) AS priority, 'pending' AS status FROM pool)"""

THROUGH = "CASE WHEN status = 'success' THEN greatest(last_price_date, requested_end_date) WHEN status IN ('empty', 'skipped') THEN requested_end_date END"
METADATA = f"""{RESULTS_SQL}, {LATEST_RESULTS_SQL}, metadata AS (SELECT upper(ticker) AS ticker, 'S:' || ticker AS security_id, status, requested_start_date AS own_start, {THROUGH} AS checked, attempt_count FROM latest_results)"""
WINDOW = "source, dataset_name, ticker, requested_start_date, requested_end_date"
ONE_PER_WINDOW = f"{RESULTS_SQL}, windows AS (SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY {WINDOW} ORDER BY seq DESC) = 1)"
FOLDED = f"""{TRANSITIONS_SQL}, folded AS (SELECT ticker, arg_max(status, {{'a': "at", 's': seq}}) AS status, max("at") AS updated_at, count(*) FILTER (status = 'running') AS attempt_count,
    max("at") FILTER (status = 'success') AS last_success_at FROM transitions GROUP BY ticker)"""
FILES = f"{PRICES_SQL}, files AS (SELECT CAST(year(date) AS INTEGER) AS year, month(date) AS month, year(date) || '/' || month(date) AS path, count(*) AS size FROM prices GROUP BY ALL)"


def _rules(source: str, rules: dict[str, str], *, key: str = "", non_empty: bool = True) -> str:
    parts = [f"SELECT '{n}' AS rule, count(*) FILTER ({c}) AS failed_rows FROM {source}" for n, c in rules.items()]
    if non_empty:
        parts.append(f"SELECT 'empty_table', CAST(count(*) = 0 AS BIGINT) FROM {source}")
    if key:
        parts.append(f"SELECT 'duplicate_key', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {source} GROUP BY {key} HAVING count(*) > 1)")
    return "SELECT *, failed_rows = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


NULLS = {f"null_{c}": f"{c} IS NULL" for c in ("security_id", "ticker", "date", "adj_close", "source", "load_id", "loaded_at")}
PRICE_RULES = NULLS | {
    "non_positive_close": "close <= 0",
    "invalid_adj_close": "adj_close IS NULL OR adj_close <= 0",
    "high_below_low": "high < low",
    "negative_volume": "volume < 0",
    "negative_adj_volume": "adj_volume < 0",
    "non_positive_split_factor": "split_factor <= 0",
}
RESULT_RULES = {
    "unknown_status": "action NOT IN ('downloaded', 'existing', 'empty', 'failed', 'skipped')",
    "window_reversed": "requested_start_date > requested_end_date",
    "empty_with_rows": "action IN ('empty', 'existing_empty') AND coalesce(row_count, 0) <> 0",
    "success_without_rows": "action IN ('downloaded', 'existing') AND coalesce(row_count, 0) <= 0",
    "success_without_last_date": "action IN ('downloaded', 'existing') AND last_price_date IS NULL",
}
BLANK = "lower(trim({})) IN ('', 'nan', '<na>', 'none')"
TASK_RULES = {f"null_{c}": f"{c} IS NULL" for c in ("task_id", "ticker", "security_id", "requested_start_date", "requested_end_date", "status")} | {"status_not_allowed": "status <> 'pending'"}
SUMMARY = "count(*) AS n_rows, count(DISTINCT ticker) AS n_tickers, count(DISTINCT security_id) AS n_securities, min(date) AS min_date, max(date) AS max_date"
INSIDE = "(date >= DATE '1999-03-01' AND date < DATE '1999-04-01' OR date >= DATE '2000-01-01' AND date < DATE '2000-03-01')"
STATUS_SUMMARY = "SELECT status, action, count(*) AS windows, count(*) FILTER (api_called) AS api_calls, CAST(sum(coalesce(row_count, 0)) AS BIGINT) AS n_rows FROM {} GROUP BY 1, 2"
DIFFERENCES = """(SELECT count(*) FILTER (p.security_id IS NULL) AS missing, count(*) FILTER (n.security_id IS NULL) AS extra,
    count(*) FILTER (n.security_id IS NOT NULL AND p.security_id IS NOT NULL AND (n.close <> p.close OR n.load_id <> p.load_id)) AS mismatched
    FROM new_prices n FULL JOIN prices p USING (security_id, date))"""
AUDIT = f"""{FOLDED}, {PRICES_SQL}, {SECURITIES_SQL}, audited AS (
    SELECT t.ticker, t.security_id, f.status, f.attempt_count, coalesce(c.n_rows, 0) AS n_rows, c.min_date, c.max_date
    FROM (SELECT replace(security_id, 'vendor:', '') AS ticker, security_id FROM securities) t LEFT JOIN folded f USING (ticker)
    LEFT JOIN (SELECT ticker, count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date FROM prices GROUP BY 1) c USING (ticker))"""

#: Columns of the models that may not be null, by the relation that holds the model's rows: fixed values.
MODEL_COLUMNS = {
    "staging": ("prices", ["security_id", "ticker", "date", "adj_close", "source"]),
    "returns": ("returns", ["security_id", "ticker", "date", "adj_close"]),
    "features": ("returns", ["security_id", "ticker", "date", "adj_close"]),
    "panel": ("returns", ["security_id", "ticker", "date", "adj_close"]),
}

SQL: dict[str, str] = {
    "staging": f"WITH {PRICES_SQL} SELECT * FROM prices",
    "returns": f"WITH {RETURNS} SELECT * FROM returns",
    "rolling_features": f"WITH {FEATURES} SELECT * FROM features",
    "forward_labels": f"WITH {LABELS} SELECT * FROM labels",
    "research_panel": f"""WITH {FEATURES}, ahead AS (SELECT *, {LEADS} FROM features), labels AS (SELECT *, {DIRECTIONS} FROM ahead)
        SELECT *, fwd_ret_20d - max(CASE WHEN ticker = '0' THEN fwd_ret_20d END) OVER (PARTITION BY date) AS fwd_excess_ret_20d FROM labels""",
    "panel_joined": f"""WITH {LABELS} SELECT security_id, date, fwd_ret_5d, label_direction_5d,
        fwd_ret_20d - max(CASE WHEN ticker = '0' THEN fwd_ret_20d END) OVER (PARTITION BY date) AS excess FROM labels""",
    "liquid_universe": f"""WITH {PRICES_SQL}, m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, security_id, avg(adj_close * adj_volume) AS avg_dollar_volume FROM prices GROUP BY 1, 2)
        SELECT *, CAST(row_number() OVER (PARTITION BY month ORDER BY avg_dollar_volume DESC, security_id) AS INTEGER) AS liquidity_rank FROM m QUALIFY liquidity_rank <= 10""",
    "inspection_filters": f"WITH {LABELS} SELECT security_id, date, fwd_ret_20d FROM labels WHERE date >= DATE '2001-01-01' AND fwd_ret_20d IS NOT NULL",
    "price_quality": f"WITH {BOTH} {_rules('both_loads', PRICE_RULES, key='security_id, date')}",
    "price_quality_legacy": f"WITH {PRICES_SQL} {_rules('prices', {k: PRICE_RULES.get(k, 'close IS NULL') for k in ('null_security_id', 'null_date', 'null_close', 'non_positive_close', 'high_below_low', 'negative_volume')}, key='security_id, date')}",
    "quality_examples": f"""WITH {PRICES_SQL}, broken AS (SELECT 'low_volume' AS rule, security_id, date FROM prices WHERE volume < 3 UNION ALL SELECT 'high_close', security_id, date FROM prices WHERE close > 104000)
        SELECT rule, CAST(row_number() OVER (PARTITION BY rule ORDER BY security_id, date) AS INTEGER) AS place, security_id, CAST(date AS VARCHAR) AS date FROM broken QUALIFY place <= 5""",
    "result_quality": f"WITH {RESULTS_SQL} {_rules('results', RESULT_RULES)}",
    "model_not_null": f"WITH {RETURNS} {_rules('returns', {f'null_{c}': f'{c} IS NULL' for c in ('security_id', 'date', 'adj_close', 'ret_1d', 'ret_120d')}, non_empty=False)}",
    "text_and_integer_rules": f"WITH {SECURITIES_SQL} {_rules('securities', {'blank_price_currency': BLANK.format('price_currency'), 'blank_ticker': BLANK.format('ticker'), 'non_integral_half': 'length(company_name) % 2 <> 0'}, non_empty=False)}",
    "manifest_quality": f"WITH {MANIFEST} {_rules('manifest', {'month_out_of_range': 'month NOT BETWEEN 1 AND 12', 'no_rows': 'final_row_count < 1'}, key='year, month')}",
    "task_list_quality": f"WITH {TASKS} {_rules('tasks', TASK_RULES, key='task_id')}",
    "duplicate_keys": f"WITH {BOTH} SELECT security_id, date, count(*) AS n_rows FROM both_loads GROUP BY 1, 2 HAVING count(*) > 1",
    "marked_duplicates": f"WITH {BOTH} SELECT security_id, date, load_id, count(*) OVER (PARTITION BY security_id, date) > 1 AS is_duplicate FROM both_loads",
    "dedup_latest": """SELECT CAST(user_id AS VARCHAR) AS security_id, CAST(ts AS DATE) AS date, event_id AS input_seq, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""",
    "combine_frames": f"WITH {BOTH} SELECT security_id, date, close, load_id FROM both_loads QUALIFY row_number() OVER (PARTITION BY security_id, date ORDER BY loaded_at DESC) = 1",
    "key_sets": f"""WITH {BOTH}, k AS (SELECT security_id, date, bool_or(load_id = 'load-1') AS a, bool_or(load_id = 'load-2') AS b FROM both_loads GROUP BY 1, 2)
        SELECT count(*) FILTER (a AND b) AS in_both, count(*) FILTER (a AND NOT b) AS only_left, count(*) FILTER (b AND NOT a) AS only_right, count(*) AS in_either, count(*) FILTER (a <> b) = 0 AS equal FROM k""",
    "cross_file_uniqueness": f"WITH {BOTH}, k AS (SELECT count(*) AS n FROM both_loads GROUP BY security_id, date) SELECT CAST(sum(n) AS BIGINT) AS input_rows, count(*) AS distinct_keys, sum(n) = count(*) AS disjoint FROM k",
    "merge_windows": f"""WITH {BOTH}, m AS (SELECT DISTINCT year(date) AS y, month(date) AS m FROM new_prices)
        SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, security_id, date, close, load_id FROM both_loads JOIN m ON year(date) = y AND month(date) = m
        QUALIFY row_number() OVER (PARTITION BY security_id, date ORDER BY loaded_at DESC) = 1""",
    "merge_manifest": f"WITH {MANIFEST} SELECT * FROM manifest",
    "manifest_state": f"""WITH {MANIFEST}, t AS (SELECT count(*) AS affected_months, CAST(sum(existing_row_count) AS BIGINT) AS existing_row_count, CAST(sum(new_row_count) AS BIGINT) AS new_row_count,
        CAST(sum(inserted_key_count) AS BIGINT) AS inserted_key_count, CAST(sum(final_row_count) AS BIGINT) AS final_row_count FROM manifest),
        r AS (SELECT count(*) AS n_rows FROM prices JOIN months ON year(date) = y AND month(date) = m)
        SELECT t.*, n_rows, CASE WHEN n_rows = existing_row_count THEN 'pre_update' WHEN n_rows = final_row_count THEN 'already_applied' ELSE 'unexpected' END AS state,
        final_row_count - existing_row_count = inserted_key_count AS delta_matches FROM t, r""",
    "merge_preview": f"""WITH {RESULTS_SQL}, {PRICES_SQL}, {NEW_PRICES_SQL}
        SELECT (SELECT count(*) FROM results) AS tasks, (SELECT count(*) FROM results WHERE action IN ('empty', 'existing_empty')) AS empty_windows, (SELECT count(*) FROM results WHERE action = 'skipped') AS skipped,
        (SELECT CAST(sum(row_count) AS BIGINT) FROM results) AS reported_rows, count(*) AS new_rows, count(DISTINCT date_trunc('month', date)) AS affected_months FROM new_prices""",
    "collapsed_listings": f"WITH {COLLAPSED} SELECT * FROM collapsed",
    "ranked_listings": f"WITH {RANKED} SELECT * FROM ranked",
    "duplicate_listing_report": f"WITH {RANKED} SELECT ticker, count(*) AS n_listings FROM ranked WHERE ticker_duplicate_count > 1 GROUP BY 1",
    "dim_security": f"""WITH {RANKED}, c AS (SELECT * FROM ranked WHERE canonical_rank = 1)
        SELECT 'vendor:' || ticker AS security_id, 'vendor' AS source, source_ticker, ticker, exchange, asset_type, price_currency, start_date, end_date,
        coalesce(end_date >= (SELECT max(end_date) FROM c) - 30, false) AS is_active, CAST(NULL AS VARCHAR) AS company_name, source_ticker AS source_raw_symbol, TIMESTAMP '2026-01-01 00:00:00' AS loaded_at FROM c""",
    "listed_tasks": f"""WITH {LISTINGS_SQL}, l AS (SELECT * REPLACE (map {{'AUTOMOBILE': 'AMEX', 'BUILDING': 'NYSE MKT', 'FURNITURE': 'NYSE', 'MACHINERY': 'PINK', 'HOUSEHOLD': 'NASDAQ'}}[exchange] AS exchange) FROM listings),
        c AS (SELECT ticker, exchange, asset_type, price_currency, min(start_date) AS a, max(end_date) AS b FROM l GROUP BY 1, 2, 3, 4),
        k AS (SELECT *, map {{'NASDAQ': 1, 'NYSE': 2, 'NYSE ARCA': 3, 'NYSE MKT': 4, 'AMEX': 5}}[exchange] AS venue, map {{'Stock': 1, 'ETF': 2, 'Mutual Fund': 3}}[asset_type] AS kind FROM c),
        r AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY kind, coalesce(price_currency = 'USD', false) DESC, venue NULLS LAST, (a IS NOT NULL AND b IS NOT NULL) DESC, b IS NOT NULL DESC,
              b DESC NULLS LAST, coalesce(date_diff('day', a, b), -1) DESC, a NULLS LAST, exchange NULLS LAST, asset_type, price_currency NULLS LAST) = 1)
        SELECT ticker, 'bootstrap:vendor:daily:' || ticker || ':1992-01-01:2026-06-11' AS task_id, 'bootstrap' AS task_list_name, 'vendor' AS source, 'daily' AS dataset_name, 'vendor:' || ticker AS security_id,
        DATE '1992-01-01' AS requested_start_date, DATE '2026-06-11' AS requested_end_date, CAST(100 AS INTEGER) AS priority, 'pending' AS status, exchange
        FROM r WHERE asset_type = 'Stock' AND price_currency = 'USD' AND venue IS NOT NULL AND a <= DATE '2021-06-01' AND b >= DATE '1992-01-01' AND NOT contains(ticker, '-') AND NOT regexp_matches(ticker, '{PATTERN}')""",
    "normalised_listings": f"WITH {LISTING_FILE_SQL} SELECT *, source_ticker AS source_raw_symbol, CAST(NULL AS VARCHAR) AS company_name FROM listing_file",
    "canonical_from_file": f"""WITH {LISTING_FILE_SQL},
        c AS (SELECT ticker, exchange, asset_type, price_currency, min(source_ticker) AS source_ticker, min(start_date) AS start_date, max(end_date) AS end_date FROM listing_file GROUP BY 1, 2, 3, 4),
        k AS (SELECT *, map {{'NASDAQ': 1, 'NYSE': 2, 'NYSE ARCA': 3, 'NYSE MKT': 4, 'AMEX': 5}}[exchange] AS venue, map {{'Stock': 1, 'ETF': 2, 'Mutual Fund': 3}}[asset_type] AS kind, count(*) OVER (PARTITION BY ticker) AS ticker_duplicate_count FROM c)
        SELECT ticker, source_ticker, exchange, asset_type, price_currency, start_date, end_date, ticker_duplicate_count FROM k
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY kind NULLS LAST, coalesce(price_currency = 'USD', false) DESC, venue NULLS LAST, (start_date IS NOT NULL AND end_date IS NOT NULL) DESC, end_date IS NOT NULL DESC,
            end_date DESC NULLS LAST, coalesce(date_diff('day', start_date, end_date), -1) DESC, start_date NULLS LAST, exchange NULLS LAST, asset_type, price_currency NULLS LAST) = 1""",
    "candidate_pool": f"WITH {POOL} SELECT *, 'candidates' AS candidate_pool_name, 'asset_type_in_config;currency_in_config;major_us_exchange;overlaps_requested_backfill_window;hyphen_ticker_excluded;ticker_pattern_not_excluded' AS candidate_reason, TIMESTAMP '2026-01-01 00:00:00' AS loaded_at FROM pool",
    "candidate_funnel": f"WITH {POOL} {FUNNEL}",
    "suspicious_tickers": f"""WITH {SECURITIES_SQL} SELECT security_id, ticker, 'matches_special_security_ticker_pattern' AS suspicious_reason FROM securities
        WHERE regexp_matches(upper(ticker), '-R$|-RT$|-WS$|-W$|-WT$|-U$|-UN$|-P-[A-Z]$|-P[A-Z]$')""",
    "sample_universe": f"""WITH {SECURITIES_SQL} SELECT security_id, ticker FROM securities
        ORDER BY ticker IN ('t2', 't3', 't5') DESC, CASE WHEN ticker NOT IN ('t2', 't3', 't5') THEN md5(ticker) END NULLS FIRST, ticker, security_id LIMIT 100""",
    "task_list": f"WITH {TASKS} SELECT * FROM tasks",
    "selected_tasks": f"WITH {TASKS} SELECT task_id, ticker FROM tasks ORDER BY ticker, security_id LIMIT 20",
    "latest_session": f"""WITH {SESSIONS_SQL} SELECT event_id, CASE WHEN ts >= (SELECT close_at FROM sessions WHERE session_date = CAST(ts AS DATE)) + INTERVAL 90 MINUTE THEN CAST(ts AS DATE)
        ELSE (SELECT max(session_date) FROM sessions WHERE session_date < CAST(ts AS DATE) AND session_date >= CAST(ts AS DATE) - 14) END AS latest_session FROM events""",
    "eligibility": f"""WITH {RESULTS_SQL}, {SECURITIES_SQL}, t AS (SELECT DISTINCT ticker, security_id FROM results UNION ALL SELECT 'X9', 'vendor:none'),
        s AS (SELECT replace(security_id, 'vendor:', '') AS ticker, security_id, end_date, is_active FROM securities)
        SELECT t.ticker, t.security_id, s.end_date, s.ticker IS NOT NULL AND (s.is_active OR s.end_date IS NULL OR s.end_date >= DATE '2021-12-25') AS eligible_for_daily_update,
        CASE WHEN s.ticker IS NULL THEN 'missing_dim_security' WHEN NOT (s.is_active OR s.end_date IS NULL OR s.end_date >= DATE '2021-12-25') THEN 'inactive_or_stale_end_date' END AS daily_update_exclusion_reason
        FROM t LEFT JOIN s ON t.ticker = s.ticker AND t.security_id = s.security_id""",
    "latest_dates": f"WITH {PRICES_SQL} SELECT ticker, security_id, max(date) AS latest_dwd_date FROM prices GROUP BY 1, 2",
    "latest_metadata": f"WITH {RESULTS_SQL}, {LATEST_RESULTS_SQL} SELECT ticker, security_id, status, requested_start_date, requested_end_date FROM latest_results",
    "checked_through": f"WITH {METADATA} SELECT ticker, status AS metadata_status, checked AS metadata_checked_through_date FROM metadata",
    "gap_tasks": f"""WITH {PRICES_SQL}, {METADATA}, latest AS (SELECT ticker, security_id, max(date) AS newest FROM prices GROUP BY 1, 2),
        t AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, 'S:' || c_custkey AS security_id FROM customer),
        j AS (SELECT t.*, newest, status, own_start, checked, attempt_count, coalesce(newest, DATE '2000-06-01') AS base, coalesce(status = 'failed', false) AS failed,
              coalesce(status = 'failed', false) AND coalesce(attempt_count, 0) >= 3 AS spent FROM t LEFT JOIN latest USING (ticker, security_id) LEFT JOIN metadata USING (ticker, security_id)),
        k AS (SELECT *, CASE WHEN spent OR status = 'skipped' THEN NULL WHEN failed THEN CASE WHEN own_start IS NULL THEN base + 1 WHEN newest >= own_start THEN newest + 1 ELSE own_start END
              ELSE greatest(base, coalesce(checked, base)) + 1 END AS s FROM j)
        SELECT 'vendor' AS source, 'daily' AS dataset_name, ticker, security_id, newest AS latest_dwd_date, status AS metadata_status, CAST(s AS DATE) AS request_start_date, DATE '2005-01-03' AS request_end_date,
        CASE WHEN failed THEN 'retry_failed_window' WHEN status = 'empty' AND checked IS NOT NULL THEN 'metadata_empty_checked_through'
             WHEN checked IS NOT NULL AND (newest IS NULL OR checked > newest) THEN 'metadata_checked_through' WHEN newest IS NULL THEN 'no_dwd_rows' ELSE 'dwd_lag' END AS reason
        FROM k WHERE s <= DATE '2005-01-03'""",
    "refresh_window": f"""WITH {RESULTS_SQL} SELECT ticker, max(requested_end_date) AS last_end_date, CAST(greatest(max(requested_end_date) - 5, DATE '1995-01-01') AS DATE) AS refresh_start, DATE '2005-01-03' AS refresh_end
        FROM results WHERE status = 'success' GROUP BY 1""",
    "normalised_results": f"""WITH {RESULTS_SQL} SELECT seq, action AS status, status AS persistent_status, requested_start_date AS request_start_date, CAST(NULL AS DATE) AS request_end_date, row_count, api_called,
        CASE error_message WHEN '404 Not Found' THEN 'skipped' WHEN 'timeout' THEN 'failed' END AS failure_action FROM results""",
    "upsert_window_results": f"""WITH {RESULTS_SQL}, w AS (SELECT run_id, {WINDOW}, status, row_count, seq FROM results QUALIFY row_number() OVER (PARTITION BY run_id, {WINDOW} ORDER BY seq DESC) = 1)
        SELECT * REPLACE (CASE WHEN seq % 2 = 0 OR seq % 3 = 0 OR seq % 5 = 0 THEN 'replayed' ELSE status END AS status) FROM w""",
    "upsert_symbol_status": f"""WITH {ONE_PER_WINDOW},
        c AS (SELECT {WINDOW}, status, attempt_count, run_id, CASE WHEN seq % 7 <> 0 THEN completed_at + INTERVAL 1 HOUR * (seq % 3 - 1) END AS at, seq FROM windows WHERE seq % 5 <> 0),
        n AS (SELECT * REPLACE (CASE WHEN seq % 4 = 0 THEN run_id ELSE 'run-new' END AS run_id) FROM windows WHERE seq % 2 = 0 OR seq % 3 = 0 OR seq % 5 = 0),
        j AS (SELECT n.source AS s1, coalesce(n.source, c.source) AS source, coalesce(n.dataset_name, c.dataset_name) AS dataset_name, coalesce(n.ticker, c.ticker) AS ticker,
              coalesce(n.requested_start_date, c.requested_start_date) AS requested_start_date, coalesce(n.requested_end_date, c.requested_end_date) AS requested_end_date,
              n.seq IS NOT NULL AND (c.seq IS NULL OR c.at IS NULL OR n.completed_at >= c.at) AS put, c.seq IS NOT NULL AS stored, n.status AS ns, c.status AS cs, c.attempt_count AS ca, c.run_id AS cr, n.run_id AS nr,
              n.api_called AS called, n.completed_at AS nat, c.at AS cat, n.last_price_date AS np, n.error_message AS ne
              FROM n FULL JOIN c ON n.ticker = c.ticker AND n.requested_start_date = c.requested_start_date AND n.requested_end_date = c.requested_end_date)
        SELECT {WINDOW}, CASE WHEN put THEN ns ELSE cs END AS status,
        CAST(CASE WHEN NOT put THEN ca WHEN NOT stored THEN CAST(called AS INTEGER) ELSE ca + CASE WHEN called AND cr IS DISTINCT FROM nr THEN 1 ELSE 0 END END AS INTEGER) AS attempt_count,
        CASE WHEN put THEN nr ELSE cr END AS last_run_id, CASE WHEN put THEN nat ELSE cat END AS last_completed_at,
        CASE WHEN put AND ns = 'success' THEN np END AS last_successful_date, CASE WHEN put AND ns = 'failed' THEN ne END AS last_error_message FROM j""",
    "upsert_runs": f"""WITH {RESULTS_SQL}, r AS (SELECT run_id || '-' || year(requested_start_date) AS run_id, min(completed_at) AS started_at, max(status) AS status FROM results GROUP BY 1)
        SELECT run_id, CASE WHEN run_id < 'run-2' THEN started_at ELSE started_at + INTERVAL 1 HOUR END AS started_at, CASE WHEN run_id >= 'run-1' THEN 'success' ELSE status END AS status FROM r""",
    "seed_tasks": f"""WITH {ONE_PER_WINDOW} SELECT {WINDOW.replace("dataset_name", "CASE WHEN seq % 50 <> 0 THEN dataset_name END AS dataset_name")}, security_id, CASE WHEN requested_start_date < DATE '1998-01-01' THEN 'success' ELSE 'pending' END AS status,
        CAST(requested_start_date < DATE '1998-01-01' AS INTEGER) AS attempt_count FROM windows""",
    "folded_transitions": f"WITH {FOLDED} SELECT * FROM folded",
    "reset_stale": f"""WITH {FOLDED}, s AS (SELECT ticker, status, status = 'running' AND updated_at < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 120 MINUTE AS was_stale FROM folded)
        SELECT ticker, CASE WHEN was_stale THEN 'failed' ELSE status END AS status, was_stale FROM s""",
    "streamed_transitions": f"""WITH {FOLDED}, s AS (SELECT *, status = 'running' AND updated_at < (SELECT max(ts) FROM events) - INTERVAL 2 DAY - INTERVAL 600 MINUTE AS was_stale FROM folded)
        SELECT * REPLACE (CASE WHEN was_stale THEN 'failed' ELSE status END AS status) FROM s""",
    "tasks_to_process": f"""WITH {FOLDED} SELECT ticker, c_custkey AS task_order, status AS current_status, attempt_count FROM folded JOIN customer ON ticker = CAST(c_custkey AS VARCHAR)
        WHERE status IN ('pending', 'failed') AND attempt_count < 30 ORDER BY c_custkey LIMIT 50""",
    "tasks_without_status": "SELECT CAST(c_custkey AS VARCHAR) AS ticker FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
    "successful_scope": f"WITH {FOLDED} SELECT ticker FROM folded JOIN customer ON ticker = CAST(c_custkey AS VARCHAR) WHERE status = 'success'",
    "resume_split": f"""WITH {ONE_PER_WINDOW}, d AS (SELECT *, seq % 2 = 0 AND status IN ('success', 'empty', 'skipped') AS done FROM windows)
        SELECT seq, done, CASE WHEN done THEN status END AS prior_status, CASE WHEN done THEN action END AS prior_action, CASE WHEN done THEN row_count END AS prior_row_count, CASE WHEN done THEN completed_at END AS prior_completed_at FROM d""",
    "run_intervals": f"WITH {RUN_LOG_SQL} SELECT * FROM intervals",
    "folded_runs": f"""WITH {RUN_LOG_SQL}, s AS (SELECT *, max(attempt) OVER (PARTITION BY run_id) AS attempts FROM attempts WHERE attempt > 0)
        SELECT run_id, min(pipeline_name) AS pipeline_name, min(dataset) AS dataset, arg_max(event, ("at", seq)) AS status, max("at") FILTER (event = 'started') AS started_at, max("at") FILTER (event <> 'started') AS ended_at,
        arg_max(row_count, ("at", seq)) FILTER (event = 'success') AS row_count, arg_max(notes, ("at", seq)) FILTER (attempt = attempts AND notes IS NOT NULL) AS notes,
        nullif(arg_max(coalesce(error_message, ''), ("at", seq)) FILTER (event <> 'started'), '') AS error_message FROM s GROUP BY 1""",
    "run_concurrency": f"""WITH {RUN_LOG_SQL}, {_changes("pipeline_name")} SELECT pipeline_name, "at", running FROM changes""",
    "busy_periods": f"""WITH {RUN_LOG_SQL}, {_changes("dataset")},
        i AS (SELECT *, coalesce(sum(CAST(running = 0 AS INTEGER)) OVER (PARTITION BY dataset ORDER BY "at" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM changes)
        SELECT dataset, min("at") AS busy_from, max("at") AS busy_to, CAST(max(running) AS BIGINT) AS peak FROM i GROUP BY dataset, island""",
    "dataset_state": f"""WITH {RUN_LOG_SQL}, c AS (
            SELECT 'd' || r_regionkey AS dataset_name, 'dwd' AS layer, '/data/' || r_name || CASE WHEN r_regionkey <> 1 THEN '/v2' ELSE '' END AS storage_path, TIMESTAMP '2026-01-01 00:00:00' AS created_at,
                   CASE WHEN r_regionkey <> 1 THEN TIMESTAMP '2026-02-01 00:00:00' ELSE TIMESTAMP '2026-01-01 00:00:00' END AS updated_at FROM region
            UNION ALL SELECT 'd9', 'ods', '/data/' || min_by(r_name, r_regionkey) || '/v2', TIMESTAMP '2026-02-01 00:00:00', TIMESTAMP '2026-02-01 00:00:00' FROM region WHERE r_regionkey <> 1),
        r AS (SELECT dataset, count(*) AS n, count(*) FILTER (outcome = 'open') AS o, arg_max(outcome, (started_at, run_id, attempt)) AS l, max(started_at) AS a, max(ended_at) FILTER (outcome = 'success') AS b FROM intervals WHERE attempt > 0 GROUP BY 1)
        SELECT dataset_name, layer, storage_path, created_at, updated_at, coalesce(n, 0) AS n_attempts, coalesce(o, 0) AS open_attempts, l AS last_outcome, a AS last_started_at, b AS last_success_at FROM c LEFT JOIN r ON dataset = dataset_name""",
    "status_counts": f"WITH {RESULTS_SQL} SELECT run_id, status, count(*) AS n_rows FROM results GROUP BY 1, 2",
    "batch_complete": f"WITH {RESULTS_SQL} SELECT count(*) FILTER (status IN ('pending', 'running', 'failed')) AS open_tasks, open_tasks = 0 AS complete FROM results",
    "last_successful_end": f"WITH {RESULTS_SQL} SELECT run_id, max(requested_end_date) AS last_end_date FROM results WHERE status = 'success' GROUP BY 1",
    "merged_metrics": f"WITH {RESULTS_SQL} SELECT run_id, count(*) AS a, count(*) FILTER (api_called) AS b FROM results GROUP BY 1",
    "table_summary": f"WITH {PRICES_SQL} SELECT {SUMMARY} FROM prices",
    "range_summary": f"WITH {PRICES_SQL} SELECT {SUMMARY} FROM prices WHERE {INSIDE}",
    "month_ranges": f"WITH {PRICES_SQL}, {NEW_PRICES_SQL} SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS range_start, CAST(date_trunc('month', date) + INTERVAL 1 MONTH AS DATE) AS range_end FROM new_prices",
    "coverage": f"""WITH {PRICES_SQL} SELECT ticker, count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date, count(*) FILTER (volume < 10) AS low_volume_rows, count(*) FILTER (close > 50000) AS dear_rows FROM prices GROUP BY 1""",
    "value_counts": f"WITH {SECURITIES_SQL} SELECT exchange AS value, count(*) AS n_rows FROM securities GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
    "ticker_prices": f"WITH {PRICES_SQL} SELECT ticker, count(*) AS n_rows, round(avg(close), 0) AS avg_close, round(max(close), 0) AS max_close, round(min(close), 0) AS min_close FROM prices GROUP BY 1",
    "panel_summary": f"WITH {LABELS} SELECT ticker, count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date, count(fwd_ret_20d) AS labelled_rows FROM labels GROUP BY 1",
    "audit_join": f"WITH {AUDIT} SELECT * FROM audited",
    "audit_totals": f"""WITH {AUDIT} SELECT count(*) AS tasks, count(*) FILTER (status = 'success') AS successes, count(*) FILTER (status IN ('failed', 'skipped')) AS failed_or_skipped,
        count(*) FILTER (status IS NULL) AS without_status, count(*) FILTER (n_rows < 530) AS low_coverage FROM audited""",
    "expected_missing": "SELECT CAST(c_custkey AS VARCHAR) AS ticker FROM customer WHERE c_custkey NOT IN (SELECT l_suppkey FROM lineitem)",
    "window_audit": f"WITH {PRICES_SQL} SELECT ticker, CAST(year(date) AS INTEGER) AS year, count(*) AS n_rows, min(date) AS first_price_date, max(date) AS last_price_date FROM prices GROUP BY 1, 2",
    "single_window": f"WITH {RESULTS_SQL} SELECT count(DISTINCT source) AS source, count(DISTINCT dataset_name) AS dataset_name, count(DISTINCT requested_start_date) AS requested_start_date, count(DISTINCT requested_start_date) = 1 AS single FROM results",
    "column_profile": f"WITH {RESULTS_SQL} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, avg(CAST({c} IS NULL AS INTEGER)) AS missing_ratio, count(DISTINCT {c}) AS n_distinct FROM results" for c in ("status", "row_count", "last_price_date")),
    "described": f"""WITH {PRICES_SQL}, names AS (SELECT unnest(['security_id', 'ticker', 'date', 'open', 'high', 'low', 'close', 'volume', 'adj_open', 'adj_high', 'adj_low', 'adj_close', 'adj_volume', 'div_cash', 'split_factor', 'source', 'load_id', 'loaded_at']) AS "column", unnest(range(18)) AS i)
        SELECT CAST(i AS INTEGER) AS place, "column", CASE WHEN "column" IN ('volume', 'adj_volume') THEN 'bigint' WHEN "column" = 'date' THEN 'date' WHEN "column" = 'loaded_at' THEN 'timestamp' WHEN "column" IN ('security_id', 'ticker', 'source', 'load_id') THEN 'string' ELSE 'double' END AS type,
        (SELECT count(*) FROM prices) AS n_rows FROM names""",
    "sampled_rows": f"""WITH {RESULTS_SQL} SELECT run_id, ticker, requested_start_date, status, row_count, api_called, seq,
        md5(concat_ws('|', '=' || run_id, '=' || ticker, '=' || requested_start_date, '=' || status, coalesce('=' || row_count, '~'), '=' || api_called, '=' || seq)) AS sample_hash FROM results ORDER BY sample_hash LIMIT 50""",
    "wide_profile": f"WITH {PRICES_SQL}, wide AS (SELECT *, volume / 2 AS half, CASE WHEN volume % 2 = 0 THEN ticker END AS maybe FROM prices) "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, avg(CAST({c} IS NULL AS INTEGER)) AS missing_ratio, count(DISTINCT {c}) AS n_distinct FROM wide" for c in [*PRICE_COLUMNS, "half", "maybe"]),
    "block_frames": f"WITH {PRICES_SQL} SELECT security_id, date, adj_close, adj_volume, "
    + ", ".join(f"{_lagged('max', 'adj_close', n)} AS max_adj_close_{n}, {_lagged('min', 'adj_close', n)} AS min_adj_close_{n}, round({_lagged('avg', 'adj_volume', n)}, 6) AS avg_adj_volume_{n}, {_lagged('count', 'adj_close', n)} AS count_adj_close_{n}, round({_lagged('stddev_samp', 'adj_volume', n)}, 6) AS stddev_samp_adj_volume_{n}" for n in (20, 60, 250))
    + " FROM prices",
    "latest_rows": f"WITH {PRICES_SQL} SELECT date, ticker, close FROM prices ORDER BY date DESC, ticker LIMIT 25",
    "top_tickers": f"WITH {PRICES_SQL} SELECT ticker, count(*) AS n_rows FROM prices GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "missing_keys": f"WITH {PRICES_SQL}, {NEW_PRICES_SQL} SELECT security_id, date FROM new_prices ANTI JOIN prices USING (security_id, date)",
    "extra_keys": f"WITH {PRICES_SQL}, {NEW_PRICES_SQL} SELECT security_id, date FROM prices ANTI JOIN new_prices USING (security_id, date)",
    "mismatched_rows": f"WITH {PRICES_SQL}, {NEW_PRICES_SQL} SELECT security_id, date, concat_ws(',', CASE WHEN n.close IS DISTINCT FROM p.close THEN 'close' END, CASE WHEN n.low IS DISTINCT FROM p.low THEN 'low' END, CASE WHEN n.load_id IS DISTINCT FROM p.load_id THEN 'load_id' END) AS differing FROM new_prices n JOIN prices p USING (security_id, date) WHERE differing <> ''",
    "tree_missing_keys": f"WITH {PRICES_SQL}, {NEW_PRICES_SQL} SELECT security_id, date FROM new_prices ANTI JOIN prices USING (security_id, date)",
    "tree_extra_keys": f"WITH {PRICES_SQL}, {NEW_PRICES_SQL} SELECT security_id, date FROM prices ANTI JOIN new_prices USING (security_id, date)",
    "tree_mismatched_rows": f"WITH {PRICES_SQL}, {NEW_PRICES_SQL} SELECT security_id, date, concat_ws(',', CASE WHEN n.close IS DISTINCT FROM p.close THEN 'close' END, CASE WHEN n.low IS DISTINCT FROM p.low THEN 'low' END, CASE WHEN n.load_id IS DISTINCT FROM p.load_id THEN 'load_id' END) AS differing FROM new_prices n JOIN prices p USING (security_id, date) WHERE differing <> ''",
    "unequal_months": f"WITH {PRICES_SQL} SELECT DISTINCT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM prices WHERE year(date) = 1997 AND month(date) = 5",
    "key_differences": f"WITH {PRICES_SQL}, {NEW_PRICES_SQL} SELECT * FROM {DIFFERENCES}",
    "staging_check": f"WITH {PRICES_SQL}, {NEW_PRICES_SQL} SELECT count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date, count(*) FILTER (NOT {INSIDE}) AS outside FROM new_prices",
    "empty_window_review": f"""WITH {RESULTS_SQL}, {SECURITIES_SQL} SELECT r.seq, r.ticker, r.action AS status, s.exchange, s.asset_type, s.end_date, s.is_active
        FROM results r LEFT JOIN securities s ON s.security_id = 'vendor:' || r.ticker WHERE r.action IN ('empty', 'existing_empty')""",
    "status_summary": f"WITH {RESULTS_SQL} {STATUS_SUMMARY.format('results')}",
    "compared_summaries": f"""WITH {RESULTS_SQL}, a AS ({STATUS_SUMMARY.format("results")}), b AS ({STATUS_SUMMARY.format("(SELECT * FROM results WHERE seq % 6 <> 4)")})
        SELECT status, action, a.windows AS windows_left, a.api_calls AS api_calls_left, b.windows AS windows_right, b.api_calls AS api_calls_right,
        a.windows IS NOT DISTINCT FROM b.windows AND a.api_calls IS NOT DISTINCT FROM b.api_calls AS matches FROM a FULL JOIN b USING (status, action)""",
    "run_summary": f"""WITH {RESULTS_SQL}, c AS (SELECT action, count(*) AS n FROM results GROUP BY 1)
        SELECT count(*) AS symbols_count, count(*) FILTER (api_called) AS api_call_count, count(*) FILTER (uploaded_to_gcs) AS upload_count, count(*) FILTER (status = 'empty') AS empty_window_count,
        CAST(sum(row_count) AS BIGINT) AS ods_records, min(requested_start_date) AS data_start_date, max(requested_end_date) AS data_end_date, CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'failed' ELSE 'success' END AS pipeline_status,
        (SELECT '{{' || string_agg('"' || action || '":' || n, ',' ORDER BY action) || '}}' FROM c) AS action_counts FROM results""",
    "payload_check": f"""WITH {RESULTS_SQL}, {PRICES_SQL}, f AS (SELECT ticker, count(*) AS payload_rows, min(date) AS first_date, max(date) AS last_date FROM prices GROUP BY 1),
        r AS (SELECT seq, ticker, action, CASE WHEN seq % 10 = 0 THEN row_count END AS row_count, requested_start_date AS a, requested_end_date AS b FROM results)
        SELECT seq, coalesce(payload_rows, 0) AS payload_rows, CASE WHEN action IN ('empty', 'existing_empty') AND coalesce(payload_rows, 0) > 0 THEN 'empty_with_rows'
        WHEN action IN ('downloaded', 'existing') AND coalesce(payload_rows, 0) = 0 THEN 'success_without_rows' WHEN row_count <> coalesce(payload_rows, 0) THEN 'row_count_differs'
        WHEN first_date < a OR last_date > b THEN 'outside_window' END AS problem FROM r LEFT JOIN f USING (ticker)""",
    "inventory_diff": f"""WITH {FILES}, a AS (SELECT * FROM files WHERE month <> 9), b AS (SELECT * REPLACE (CASE WHEN month = 7 THEN size + 1 ELSE size END AS size) FROM files WHERE month <> 5),
        j AS (SELECT year, a.size AS sa, b.size AS sb FROM a FULL JOIN b USING (year, path))
        SELECT year, count(*) FILTER (sb IS NULL) AS missing, count(*) FILTER (sa IS NULL) AS extra, count(*) FILTER (sa <> sb) AS size_mismatch, missing = 0 AND extra = 0 AND size_mismatch = 0 AS in_sync FROM j GROUP BY 1""",
    "download_plan": f"""WITH {RESULTS_SQL}, {FILES}, t AS (SELECT seq, year(requested_start_date) || '/' || month(requested_start_date) AS path FROM results)
        SELECT path, seq, CASE WHEN path IN (SELECT path FROM files WHERE month <> 5) THEN 'reuse' ELSE 'fetch' END AS planned_action FROM t""",
    "manifest_check": f"""WITH {MANIFEST}, a AS (SELECT year(date) AS year, month(date) AS month, count(*) AS actual_row_count FROM prices GROUP BY 1, 2)
        SELECT m.year, m.month, final_row_count, actual_row_count, final_row_count IS NOT DISTINCT FROM actual_row_count AS matches FROM manifest m LEFT JOIN a USING (year, month)""",
    "end_to_end_gate": f"""WITH {FILES}, {NEW_PRICES_SQL} SELECT *, groups_out_of_sync + missing + extra + mismatched = 0 AS passed
        FROM (SELECT (SELECT count(DISTINCT year) FROM files WHERE month = 5) AS groups_out_of_sync, missing, extra, mismatched FROM {DIFFERENCES})""",
    "payload_round_trip": f"""WITH {PRICES_SQL} SELECT * REPLACE (open AS adj_open, high AS adj_high, low AS adj_low, volume AS adj_volume) FROM prices""",
    "stored_ranges": f"""WITH {PRICES_SQL} SELECT security_id, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, close FROM prices
        WHERE date >= DATE '1999-03-01' AND date < DATE '1999-04-01' OR date >= DATE '2000-01-01' AND date < DATE '2000-03-01'""",
    "stored_files": f"WITH {PRICES_SQL} SELECT count(DISTINCT date_trunc('month', date)) AS n_months, count(*) AS n_rows FROM prices",
    "csv_round_trip": f"WITH {SECURITIES_SQL} SELECT * FROM securities",
    "stored_state": f"WITH {RESULTS_SQL} SELECT {WINDOW}, status, attempt_count, error_message, seq FROM results WHERE status = 'failed'",
    "rebuilt_table": f"""WITH {BOTH}, kept AS (SELECT DISTINCT security_id, date FROM both_loads), a AS (SELECT year(date) AS y, month(date) AS m, count(*) AS n FROM prices GROUP BY 1, 2)
        SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, n_rows, n AS archived_rows FROM (SELECT year(date) AS y, month(date) AS m, count(*) AS n_rows FROM kept GROUP BY 1, 2) LEFT JOIN a USING (y, m)""",
    "landed_payloads": f"WITH {PRICES_SQL} SELECT security_id, date, source, open, high, low, close, volume FROM prices",
    "model_tests": f"WITH {RETURNS} " + " UNION ALL ".join(f"SELECT '{m}' AS model, * FROM ({_rules(t, {f'null_{c}': f'{c} IS NULL' for c in columns}, non_empty=False)})" for m, (t, columns) in MODEL_COLUMNS.items()),
    "dimension_quality": f"""WITH {SECURITIES_SQL} {_rules('securities', {'null_security_id': 'security_id IS NULL', 'null_ticker': 'ticker IS NULL'}, non_empty=False)}
        UNION ALL SELECT 'duplicate_security_id', n, n = 0 FROM (SELECT CAST(coalesce(sum(k), 0) AS BIGINT) AS n FROM (SELECT count(*) AS k FROM securities GROUP BY security_id HAVING count(*) > 1))
        UNION ALL SELECT 'duplicate_ticker', n, n = 0 FROM (SELECT CAST(coalesce(sum(k), 0) AS BIGINT) AS n FROM (SELECT count(*) AS k FROM securities GROUP BY ticker HAVING count(*) > 1))""",
    "result_windows_quality": f"""WITH {RESULTS_SQL}, one AS (SELECT * REPLACE (CASE WHEN seq % 9 = 0 THEN requested_end_date - 20 ELSE requested_end_date END AS requested_end_date) FROM results),
        reported AS (SELECT * FROM one UNION ALL SELECT * FROM one WHERE seq % 4 = 0)
        {_rules("reported", RESULT_RULES | {"unknown_status": "action NOT IN ('downloaded', 'existing', 'empty', 'failed')"})}
        UNION ALL SELECT 'duplicate_window', n, n = 0 FROM (SELECT CAST(coalesce(sum(k), 0) AS BIGINT) AS n
            FROM (SELECT count(*) AS k FROM reported GROUP BY ticker, security_id, requested_start_date, requested_end_date HAVING count(*) > 1))""",
    "task_list_rules": f"""WITH {TASKS}, both_lists AS (SELECT * FROM tasks UNION ALL SELECT * REPLACE ('other' AS task_list_name, task_id || ':NaN' AS task_id) FROM tasks)
        {_rules("both_lists", TASK_RULES | {"task_id_of_nan": "contains(lower(task_id), 'nan')", "other_list": "task_list_name <> 'bootstrap'"}, key="task_id")}
        UNION ALL SELECT 'too_few_rows', n, n = 0 FROM (SELECT greatest(1 - count(*), 0) AS n FROM both_lists) UNION ALL SELECT 'too_many_rows', n, n = 0 FROM (SELECT greatest(count(*) - 5, 0) AS n FROM both_lists)""",
    "restricted_status": f"WITH {FOLDED} SELECT ticker, status, attempt_count FROM folded WHERE ticker IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')",
    "result_texts": f"WITH {RESULTS_SQL} SELECT seq, left(repeat(error_message, 300), 2000) AS error_message, strftime(completed_at, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS completed_text FROM results",
    "panel_averages": f"""WITH {LABELS}, r AS (SELECT *, adj_close / lag(adj_close, 1) {W} - 1 AS ret_1d FROM labels)
        SELECT ticker, round(avg(ret_1d), 5) AS avg_ret_1d, round(avg(label_direction_20d), 5) AS share_up_20d FROM r GROUP BY 1""",
    "warehouse_months": f"""WITH {BOTH}, kept AS (SELECT * FROM both_loads QUALIFY row_number() OVER (PARTITION BY security_id, date ORDER BY loaded_at DESC) = 1)
        SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n_rows, sum(close) AS sum_close FROM kept GROUP BY 1, 2""",
    "bucketed_returns": f"WITH {RETURNS} SELECT security_id, date, ret_1d, ret_20d, ret_120d FROM returns",
    "bucketed_files": f"WITH {PRICES_SQL} SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n_rows, true AS bounded FROM prices GROUP BY 1, 2",
    "stored_months": f"WITH {PRICES_SQL} SELECT * FROM prices WHERE (year(date) = 1999 AND month(date) = 3) OR (year(date) = 2000 AND month(date) = 1)",
    "file_order": f"WITH {PRICES_SQL} SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n_rows, 0 AS out_of_order FROM prices GROUP BY 1, 2",
    "summary_file": f"""WITH {RESULTS_SQL} SELECT count(*) AS symbols_count, count(*) FILTER (api_called) AS api_call_count, count(*) FILTER (uploaded_to_gcs) AS upload_count, count(*) FILTER (status = 'empty') AS empty_window_count,
        CAST(coalesce(sum(row_count), 0) AS BIGINT) AS ods_records, CAST(min(requested_start_date) AS VARCHAR) AS data_start_date, CAST(max(requested_end_date) AS VARCHAR) AS data_end_date,
        CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'failed' ELSE 'success' END AS pipeline_status FROM results""",
    "described_view": f"""WITH {RESULTS_SQL}, names AS (SELECT unnest(['run_id', 'source', 'dataset_name', 'ticker', 'security_id', 'requested_start_date', 'requested_end_date', 'status', 'action', 'row_count', 'last_price_date', 'api_called', 'uploaded_to_gcs', 'error_message', 'completed_at', 'attempt_count', 'seq']) AS "column",
            unnest(['string', 'string', 'string', 'string', 'string', 'date', 'date', 'string', 'string', 'bigint', 'date', 'boolean', 'boolean', 'string', 'timestamp', 'int', 'bigint']) AS type, unnest(range(17)) AS i)
        SELECT CAST(i AS INTEGER) AS place, "column", type, (SELECT count(*) FROM results) AS n_rows, true AS temporary FROM names""",
    "saved_contract": f"WITH {PRICES_SQL} SELECT unnest(['partition columns', 'bucket columns', 'column set', 'partition columns', 'bucket columns', 'column set']) AS rule, unnest([true, true, true, true, false, true]) AS passed, count(*) AS n_rows FROM prices",
    "market_times": "SELECT event_id, ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS local_time, CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) AS local_date FROM events",
    "complete_rows": f"WITH {PRICES_SQL} SELECT security_id, date, open, high, low, close, volume FROM prices WHERE volume % 7 <> 0 AND volume % 5 <> 0 AND volume % 11 <> 0",
    "materialised_models": f"WITH {RETURNS} SELECT security_id, count(*) AS n_rows, count(ret_120d) AS n_returns FROM returns GROUP BY 1",
    "replayed_batches": f"""WITH {PRICES_SQL}, {NEW_PRICES_SQL}, loads AS (
            SELECT security_id, date, close, load_id, loaded_at FROM prices
            UNION ALL SELECT security_id, date, close, load_id, loaded_at FROM new_prices WHERE month(date) <> 2
            UNION ALL SELECT security_id, date, close + 1, 'load-3', TIMESTAMP '2026-03-01 00:00:00' FROM new_prices WHERE month(date) >= 2),
        kept AS (SELECT * FROM loads QUALIFY row_number() OVER (PARTITION BY security_id, date ORDER BY loaded_at DESC) = 1)
        SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, load_id, count(*) AS n_rows, sum(close) AS sum_close FROM kept GROUP BY 1, 2, 3""",
    "staged_promotion": f"""WITH {BOTH}, kept AS (SELECT * FROM both_loads QUALIFY row_number() OVER (PARTITION BY security_id, date ORDER BY loaded_at DESC) = 1)
        SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n_rows, sum(close) AS sum_close FROM kept GROUP BY 1, 2""",
}
