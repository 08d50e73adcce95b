"""Equivalent SQL for the registered queries, over the same raw tables."""

from __future__ import annotations

from ..settings import FEATURE_COLS, MACRO_SERIES
from .catalog import (BAD_DAY, BAD_SERIES, BAD_TICKER, DAILY, DIGITS, EXISTING_BEFORE, INCOMING_FROM,
                      MISSING_TICKER, SETTINGS, STALE_AFTER, STALE_TICKER)

AS_OF, CUTOFF = f"DATE '{SETTINGS.as_of}'", f"DATE '{SETTINGS.cutoff}'"
OLD_END, NEW_START = f"DATE '{EXISTING_BEFORE}'", f"DATE '{INCOMING_FROM}'"
TICKERS = ", ".join(f"('{t}')" for t in SETTINGS.tickers)

# Named subqueries; each may use the ones before it.
PARTS = {
    "bars": """
        SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date,
               min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
               min(o_totalprice) AS low, max_by(o_totalprice, o_orderkey) AS close,
               max_by(o_totalprice, o_orderkey) AS adj_close,
               CAST(sum(CAST(q AS BIGINT)) AS BIGINT) AS volume
        FROM orders JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) l
          ON l_orderkey = o_orderkey
        GROUP BY 1, 2""",
    "bars_wide": """
        SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
               max(l_extendedprice) AS adj_close,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume
        FROM lineitem GROUP BY 1, 2""",
    "macro": """
        SELECT 'FEDFUNDS' AS series_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
               max(l_extendedprice) AS value FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2
        UNION ALL
        SELECT 'CPIAUCSL', CAST(date_trunc('month', l_shipdate) AS DATE), max(l_extendedprice)
        FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2
        UNION ALL
        SELECT 'VIXCLS', CAST(l_shipdate AS DATE), max(l_extendedprice)
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2
        UNION ALL
        SELECT 'T10Y2Y', CAST(l_shipdate AS DATE), min(l_extendedprice)
        FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2""",
    "dirty": """
        SELECT ticker, date, open, high, low, close,
               CASE WHEN month(date) = 4 AND day(date) = 13 THEN NULL ELSE adj_close END AS adj_close,
               CASE WHEN month(date) = 4 AND day(date) = 14 THEN NULL ELSE volume END AS volume
        FROM bars""",
    "defective": f"""
        SELECT ticker, date, adj_close, volume FROM dirty
        WHERE ticker <> '{STALE_TICKER}' OR date <= DATE '{STALE_AFTER}'""",
    "expected": f"SELECT * FROM (VALUES {TICKERS}, ('{MISSING_TICKER}')) t(ticker)",
    "purchases": "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'",
    "clicks": "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'click'",
}


def _windows(source: str) -> dict[str, str]:
    return {
        "priced": f"""
            SELECT ticker, date, adj_close, volume,
                   (adj_close - lag(adj_close) OVER w) / NULLIF(lag(adj_close) OVER w, 0) AS return_1d
            FROM {source} WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
        "rolled": """
            SELECT ticker, date, adj_close, volume, return_1d,
                   CASE WHEN row_number() OVER w >= 5 THEN avg(adj_close) OVER w5 END AS ma_5,
                   CASE WHEN row_number() OVER w >= 20 THEN avg(adj_close) OVER w20 END AS ma_20,
                   CASE WHEN row_number() OVER w >= 50 THEN avg(adj_close) OVER w50 END AS ma_50,
                   CASE WHEN count(return_1d) OVER w20 = 20
                        THEN stddev_samp(return_1d) OVER w20 END AS volatility_20,
                   CASE WHEN count(volume) OVER w20 = 20 THEN (volume - avg(volume) OVER w20)
                        / NULLIF(stddev_samp(volume) OVER w20, 0) END AS volume_zscore,
                   CASE WHEN lead(adj_close) OVER w IS NULL THEN NULL
                        ELSE CAST(lead(adj_close) OVER w > adj_close AS INTEGER) END AS target
            FROM priced
            WINDOW w AS (PARTITION BY ticker ORDER BY date),
                   w5 AS (PARTITION BY ticker ORDER BY date ROWS 4 PRECEDING),
                   w20 AS (PARTITION BY ticker ORDER BY date ROWS 19 PRECEDING),
                   w50 AS (PARTITION BY ticker ORDER BY date ROWS 49 PRECEDING)""",
    }


def _asof(left: str, series: list[str], macro: str = "macro") -> str:
    names = [MACRO_SERIES[s][0] for s in series]
    joins = "\n".join(
        f"ASOF JOIN (SELECT date, value AS {n} FROM {macro} WHERE series_id = '{s}') m_{n} "
        f"ON l.date > m_{n}.date" for s, n in zip(series, names))
    return f"SELECT l.*, {', '.join(names)} FROM {left} l\n{joins}"


def _rsi(source: str) -> dict[str, str]:
    return {
        "steps": f"""
            SELECT *, return_1d - lag(return_1d) OVER (PARTITION BY ticker ORDER BY date) AS step
            FROM {source}""",
        "strengths": """
            SELECT *, CASE WHEN count(step) OVER w14 = 14 THEN
                   avg(CASE WHEN step IS NOT NULL THEN greatest(step, 0.0) END) OVER w14
                   / NULLIF(avg(CASE WHEN step IS NOT NULL THEN greatest(-step, 0.0) END) OVER w14, 0)
                   END AS strength
            FROM steps
            WINDOW w14 AS (PARTITION BY ticker ORDER BY date ROWS 13 PRECEDING)""",
        "with_rsi": "SELECT *, 100 - 100 / (1 + strength) AS rsi_14 FROM strengths",
    }


def _features(source: str = "bars") -> dict[str, str]:
    cols = ", ".join(FEATURE_COLS)
    return {
        source: PARTS[source], "macro": PARTS["macro"], **_windows(source),
        "joined": _asof("rolled", list(MACRO_SERIES)), **_rsi("joined"),
        "features": f"SELECT ticker, date, {cols}, target, 'v1' AS feature_version FROM with_rsi",
    }


def _training() -> dict[str, str]:
    present = " AND ".join(f"{c} IS NOT NULL" for c in (*FEATURE_COLS, "target"))
    return {**_features(),
            "labelled": f"SELECT ticker, date, {', '.join(FEATURE_COLS)}, target FROM features WHERE {present}",
            "train": f"SELECT * FROM labelled WHERE date < {CUTOFF}",
            "test": f"SELECT * FROM labelled WHERE date >= {CUTOFF}"}


def _named(*names: str) -> dict[str, str]:
    return {n: PARTS[n] for n in names}


def _sql(parts: dict[str, str], body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH {ctes}\n{body}"


def _materialized(parts: dict[str, str], body: str) -> str:
    """As `_sql`, with every part computed once."""
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({text})" for name, text in parts.items())
    return f"WITH {ctes}\n{body}"


def _round(*columns: str) -> str:
    return ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in columns)


_ROUNDED = _round(*FEATURE_COLS)
_BAR_COLS = "ticker, date, open, high, low, close, adj_close, volume"


def _load_sql(table: str, key: str, value: str, columns: str, watermark: bool) -> dict[str, str]:
    """Stored rows, a doubled batch, and the rows of it that the table lacks."""
    changed = columns.replace(value, f"{value} + seq - 0.5 AS {value}")
    newer = ""
    if watermark:
        newer = (f"AND b.date > coalesce((SELECT max(date) FROM stored s WHERE s.{key} = b.{key}), "
                 f"{AS_OF} - {365 * SETTINGS.lookback_years})")
    return {
        "stored": f"SELECT {columns} FROM {table} WHERE date < {OLD_END}",
        "batch": f"SELECT {changed}, seq FROM {table}, (VALUES (1), (2)) c(seq) WHERE date >= {NEW_START}",
        "loaded": f"""
            SELECT * FROM stored
            UNION ALL
            SELECT {columns} FROM batch b
            WHERE seq = 1 {newer}
              AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.{key} = b.{key} AND s.date = b.date)""",
    }


def _audit_sql() -> str:
    spoiled = f"day(date) = {BAD_DAY}"
    series = ", ".join(f"('{s}')" for s in MACRO_SERIES)
    one = """
        SELECT '20010802_000000' AS run_id, '{source}' AS source, e.k AS ticker,
               CAST(CASE WHEN coalesce(bad, 0) > 0 THEN 0 ELSE coalesce(good, 0) END AS INTEGER) AS rows_loaded,
               CASE WHEN coalesce(bad, 0) > 0 THEN 'failed' ELSE 'success' END AS status,
               CASE WHEN bad > 0 THEN bad || ' row(s) could not be parsed' END AS error_msg
        FROM (VALUES {entities}) e(k) LEFT JOIN (
            SELECT {key} AS k, count(*) FILTER (WHERE NOT is_bad AND {value} IS NOT NULL) AS good,
                   count(*) FILTER (WHERE is_bad) AS bad
            FROM (SELECT *, {key} = '{bad_key}' AND {spoiled} AS is_bad FROM {table}
                  WHERE date >= {start}) GROUP BY 1) c ON c.k = e.k"""
    return _sql(_named("bars", "dirty", "macro"), one.format(
        source="yfinance", entities=f"{TICKERS}, ('{MISSING_TICKER}')", key="ticker",
        value="adj_close", bad_key=BAD_TICKER, spoiled=spoiled, table="dirty", start=NEW_START,
    ) + "\nUNION ALL\n" + one.format(
        source="fred", entities=series, key="series_id", value="value", bad_key=BAD_SERIES,
        spoiled=spoiled, table="macro", start=NEW_START))


def _schemas_sql() -> str:
    fixed = {
        "raw_prices": [("ticker", "string", False), ("date", "date", False), ("open", "double", True),
                       ("high", "double", True), ("low", "double", True), ("close", "double", True),
                       ("adj_close", "double", False), ("volume", "bigint", True),
                       ("ingested_at", "timestamp", True)],
        "raw_macro": [("series_id", "string", False), ("date", "date", False),
                      ("value", "double", True), ("ingested_at", "timestamp", True)],
        "ingestion_log": [("run_id", "string", False), ("source", "string", False),
                          ("ticker", "string", True), ("rows_loaded", "int", True),
                          ("status", "string", True), ("error_msg", "string", True),
                          ("started_at", "timestamp", True), ("finished_at", "timestamp", True)],
    }
    sources = {"raw_prices": ("bars", "ticker"), "raw_macro": ("macro", "series_id")}
    selects = []
    for table, columns in fixed.items():
        for name, dtype, nullable in columns:
            head = (f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{dtype}' AS data_type, "
                    f"{str(nullable).lower()} AS nullable, ")
            if table in sources:
                source, key = sources[table]
                nulls = "0" if name == "ingested_at" else f"count(*) - count({name})"
                selects.append(head + f"CAST({nulls} AS BIGINT) AS null_count, count(*) AS row_count, "
                               f"count(*) - count(DISTINCT ({key}, date)) AS repeated_keys FROM {source}")
            else:
                selects.append(head + "CAST(0 AS BIGINT) AS null_count, CAST(0 AS BIGINT) AS row_count, "
                               "CAST(0 AS BIGINT) AS repeated_keys")
    return _sql(_named("bars", "macro"), "\nUNION ALL\n".join(selects))


def _keyed_sql() -> str:
    return _sql(_named("purchases", "clicks"), """
        SELECT p.user_id, p.ts, p.event_id, p.value, c.event_id AS click_id, c.value AS click_value
        FROM purchases p ASOF LEFT JOIN clicks c ON p.user_id = c.user_id AND p.ts > c.ts""")


def _drift_parts() -> dict[str, str]:
    unpivoted = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {c} AS value, is_ref, is_cur FROM windows WHERE {c} IS NOT NULL"
        for c in FEATURE_COLS)
    return {
        **_features(),
        "windows": f"""
            SELECT *, CAST(date < {CUTOFF} AS INTEGER) AS is_ref,
                   CAST(date >= {AS_OF} - {SETTINGS.drift_days} AS INTEGER) AS is_cur
            FROM features WHERE date < {CUTOFF} OR date >= {AS_OF} - {SETTINGS.drift_days}""",
        "long": unpivoted,
        "sizes": """
            SELECT feature, CAST(sum(is_ref) AS BIGINT) AS n, CAST(sum(is_cur) AS BIGINT) AS m,
                   stddev_pop(value) FILTER (WHERE is_ref = 1) AS spread
            FROM long GROUP BY 1""",
        "steps_f": """
            SELECT feature, value, sum(is_ref) AS r, sum(is_cur) AS c FROM long GROUP BY 1, 2""",
        "cdf": """
            SELECT feature, value,
                   abs(sum(r) OVER w / CAST(n AS DOUBLE) - sum(c) OVER w / CAST(m AS DOUBLE)) AS gap,
                   lead(value) OVER w - value AS width
            FROM steps_f JOIN sizes USING (feature)
            WINDOW w AS (PARTITION BY feature ORDER BY value)""",
        "tests": """
            SELECT feature, max(gap) AS d, sum(gap * coalesce(width, 0)) AS area FROM cdf GROUP BY 1""",
        "lambdas": """
            SELECT *, d * sqrt(n * m / CAST(n + m AS DOUBLE)) AS l FROM tests JOIN sizes USING (feature)""",
        "scored": """
            SELECT feature, n AS reference_rows, m AS current_rows,
                   CASE WHEN l < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * (
                       SELECT sum((CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * l * l))
                       FROM (SELECT unnest(range(1, 101)) AS k)))) END AS p,
                   area / greatest(spread, 0.001) AS distance
            FROM lambdas""",
    }


def _scaled() -> dict[str, str]:
    """Labelled rows with the scaled inputs as a list x."""
    moments = ", ".join(
        f"avg({c}) AS mean_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}"
        for c in FEATURE_COLS)
    scaled = ", ".join(f"({c} - mean_{c}) / sd_{c}" for c in FEATURE_COLS)
    return {**_training(), "moments": f"SELECT {moments} FROM train",
            "xs": f"SELECT ticker, date, target, [{scaled}] AS x FROM labelled, moments"}


def _regression(steps: int = 10) -> dict[str, str]:
    """Newton steps on the penalized loss, each with one elimination of a 12 x 13 system."""
    k = len(FEATURE_COLS)
    dot = "list_dot_product(x, w)"
    parts = {"tx": f"SELECT list_append(x, 1.0::DOUBLE) AS x, target AS y FROM xs WHERE date < {CUTOFF}",
             "w_0": f"SELECT [0.0::DOUBLE FOR i IN range({k + 1})] AS w"}
    for t in range(steps):
        rows = []
        for i in range(1, k + 2):
            own = [f"sum(v * x[{min(i, j)}] * x[{max(i, j)}]){' + 1' if i == j <= k else ''}" for j in range(1, k + 2)]
            rows.append(f"[{', '.join(own)}, sum(r * x[{i}]){f' - any_value(w[{i}])' if i <= k else ''}]")
        system = (f"SELECT any_value(w) AS w, [{', '.join(rows)}] AS m FROM ("
                  f"SELECT x, w, y - p AS r, p * (1 - p) AS v FROM ("
                  f"SELECT x, y, w, 1 / (1 + exp(-{dot})) AS p FROM tx, w_{t}))")
        for q in range(1, k + 2):
            system = (f"SELECT w, [CASE WHEN i = {q} THEN [m[{q}][j] / m[{q}][{q}] FOR j IN range(1, {k + 3})] "
                      f"ELSE [m[i][j] - m[i][{q}] * m[{q}][j] / m[{q}][{q}] FOR j IN range(1, {k + 3})] END "
                      f"FOR i IN range(1, {k + 2})] AS m FROM ({system})")
        parts[f"w_{t + 1}"] = f"SELECT [w[i] + m[i][{k + 2}] FOR i IN range(1, {k + 2})] AS w FROM ({system})"
    names = ", ".join(f"'{c}'" for c in (*FEATURE_COLS, "intercept"))
    return {**parts, "weights": f"""
        SELECT CAST(unnest(range({k + 1})) AS INTEGER) AS position, unnest([{names}]) AS feature,
               unnest(w) AS weight FROM w_{steps}""",
            "logit": f"SELECT w FROM w_{steps}"}


def _share_sql(*inputs: str) -> str:
    text = " || ':' || ".join(f"CAST({i} AS VARCHAR)" for i in inputs)
    return f"(CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def _forest(more: str = "") -> dict[str, str]:
    """The trees level by level, from the same draws, and the scores of the labelled rows and
    of what `more` selects."""
    k, trees, size, seed = len(FEATURE_COLS), SETTINGS.trees, SETTINGS.tree_rows, SETTINGS.seed
    key = ("ticker", "date")
    path = ("CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 "
            "ELSE 2.0 * (ln({n} - 1) + 0.5772156649015329) - 2.0 * ({n} - 1) / {n} END")
    parts = {
        "fit": f"SELECT ticker, date, x FROM xs WHERE date < {CUTOFF}",
        "facts": f"""
            SELECT n, least({size}, n) AS size, {trees} * least(1.0, 3.0 * least({size}, n) / n) AS offered
            FROM (SELECT count(*) AS n FROM fit)""",
        "offers": f"""
            SELECT ticker, date, x, size, offered, draws,
                   (CAST(floor({_share_sql(str(seed), "'first'", *key)} * {trees}) AS BIGINT)
                    + unnest(range(draws))) % {trees} AS tree
            FROM (SELECT *, CAST(ceil(offered) AS BIGINT) AS draws FROM facts), fit""",
        "l_0": f"""
            SELECT tree, CAST(0 AS BIGINT) AS node, x FROM offers
            WHERE {_share_sql(str(seed), "'offer'", "tree", *key)} < offered / draws
            QUALIFY row_number() OVER (PARTITION BY tree
                    ORDER BY {_share_sql(str(seed), "'draw'", "tree", *key)}, ticker, date) <= size"""}
    low = ", ".join(f"min(x[{i}])" for i in range(1, k + 1))
    high = ", ".join(f"max(x[{i}])" for i in range(1, k + 1))
    depth = (size - 1).bit_length()
    for d in range(depth + 1):
        can = f"[i FOR i IN range(1, {k + 1}) IF hi[i] > lo[i]]" if d < depth else "CAST([] AS BIGINT[])"
        parts[f"n_{d}"] = f"""
            SELECT *, lo[f] + {_share_sql(str(seed), "tree", "node", "'threshold'")} * (hi[f] - lo[f]) AS cut FROM (
                SELECT *, CASE WHEN n > 1 AND len(can) > 0 THEN can[1 + CAST(floor(
                       {_share_sql(str(seed), "tree", "node", "'feature'")} * len(can)) AS BIGINT)] END AS f
                FROM (SELECT *, {can} AS can FROM (
                    SELECT tree, node, count(*) AS n, [{low}] AS lo, [{high}] AS hi FROM l_{d} GROUP BY 1, 2)))"""
        parts[f"l_{d + 1}"] = f"""
            SELECT tree, 2 * node + CASE WHEN x[f] <= cut THEN 1 ELSE 2 END AS node, x
            FROM l_{d} JOIN n_{d} USING (tree, node) WHERE f IS NOT NULL"""
    parts["nodes"] = "\nUNION ALL\n".join(f"""
        SELECT tree, node, f, cut, CASE WHEN f IS NULL THEN {d} + {path.format(n="n")} ELSE 0.0 END AS len
        FROM n_{d}""" for d in range(depth + 1))
    parts["asked"] = "SELECT ticker, date, x FROM xs" + (f" UNION ALL ({more})" if more else "")
    walk = f"SELECT ticker, date, x, tree, CAST(0 AS BIGINT) AS node FROM asked, range({trees}) t(tree)"
    for d in range(depth):
        parts[f"walk_{d}"] = walk
        walk = f"""
            SELECT ticker, date, x, tree, CASE WHEN f IS NULL THEN node
                   ELSE 2 * node + CASE WHEN x[f] <= cut THEN 1 ELSE 2 END END AS node
            FROM walk_{d} JOIN nodes USING (tree, node)"""
    parts["walked"] = walk
    parts["scores"] = f"""
        SELECT ticker, date, pow(2, -total / {trees} / normal) AS score FROM (
            SELECT ticker, date, list_reduce(list(len ORDER BY tree), lambda a, b: a + b, 0.0::DOUBLE) AS total
            FROM walked JOIN nodes USING (tree, node) GROUP BY 1, 2),
            (SELECT {path.format(n="size")} AS normal FROM facts)"""
    parts["flagged"] = f"""
        SELECT ticker, date, score, score > (
            SELECT quantile_cont(score, {1 - SETTINGS.contamination}) FROM scores SEMI JOIN fit USING (ticker, date)) AS odd
        FROM scores"""
    return parts


def _predicted() -> str:
    return """
        SELECT ticker, date, target, p, CAST(p > 0.5 AS INTEGER) AS prediction FROM (
            SELECT ticker, date, target, 1 / (1 + exp(-list_dot_product(list_append(x, 1.0::DOUBLE), w))) AS p
            FROM xs, logit)"""


def _evaluated() -> dict[str, str]:
    majority = "SELECT target FROM train GROUP BY 1 ORDER BY count(*) DESC, target LIMIT 1"
    return {**_scaled(), **_regression(), **_forest(), "predicted": _predicted(), "evaluated": f"""
        SELECT count(*) AS n_rows, round(avg(CAST(y = p AS INTEGER)), 4) AS lr_accuracy,
               round(coalesce(sum(y * p) / NULLIF(CAST(sum(p) AS DOUBLE), 0), 0), 4) AS lr_precision,
               round(coalesce(sum(y * p) / NULLIF(CAST(sum(y) AS DOUBLE), 0), 0), 4) AS lr_recall,
               round(coalesce(2 * sum(y * p) / NULLIF(CAST(sum(y) + sum(p) AS DOUBLE), 0), 0), 4) AS lr_f1,
               round(avg(CAST(y = ({majority}) AS INTEGER)), 4) AS baseline_accuracy,
               round(avg(CAST(odd AS INTEGER)), 4) AS iso_anomaly_rate
        FROM (SELECT target AS y, prediction AS p, odd FROM predicted JOIN flagged USING (ticker, date)
              WHERE date >= {CUTOFF})"""}


def _model_sql(latest: str) -> dict[str, str]:
    """SQL of the queries that fit models."""
    names = f"'{','.join(FEATURE_COLS)}'"
    regression = {**_scaled(), **_regression()}
    forest = {**_scaled(), **_forest()}
    complete = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLS)
    scaled = ", ".join(f"({c} - mean_{c}) / sd_{c}" for c in FEATURE_COLS)
    recent = {"recent": f"""
        SELECT ticker, date, {complete} AS whole, CASE WHEN {complete} THEN [{scaled}] END AS x
        FROM features, moments
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= {SETTINGS.recent_rows}"""}
    metadata = f"""
        SELECT '{SETTINGS.cutoff}' AS train_cutoff_date, {names} AS feature_cols,
               (SELECT count(*) FROM train) AS n_train_rows, n_rows AS n_test_rows, lr_accuracy, lr_precision,
               lr_recall, lr_f1, baseline_accuracy, iso_anomaly_rate,
               CAST((SELECT avg(target) > 0.5 FROM train) AS INTEGER) AS majority_class
        FROM evaluated"""
    both = _materialized({**_scaled(), **_regression(), **_forest(), "predicted": _predicted()}, f"""
        SELECT ticker, date, {_round("probability_fitted", "score_fitted")},
               round(probability_fitted, {DIGITS}) AS probability_loaded, round(score_fitted, {DIGITS}) AS score_loaded
        FROM (SELECT ticker, date, p AS probability_fitted, score AS score_fitted
              FROM predicted JOIN flagged USING (ticker, date) WHERE date >= {CUTOFF})""")
    return {
        "logistic_fit": _materialized(regression, f"SELECT position, feature, {_round('weight')} FROM weights"),
        "feature_weights": _materialized(
            regression, f"SELECT feature, {_round('weight')} FROM weights WHERE feature <> 'intercept'"),
        "logistic_predictions": _materialized({**regression, "predicted": _predicted()}, f"""
            SELECT ticker, date, target, round(p, {DIGITS}) AS probability_up, prediction
            FROM predicted WHERE date >= {CUTOFF}"""),
        "score_latest": _materialized({**regression, **_named("expected"), "newest": latest, "asked": f"""
            SELECT e.ticker, f.date, n.stale, f.date IS NOT NULL AND {complete} AS whole,
                   CASE WHEN {complete} THEN 1 / (1 + exp(-list_dot_product([{scaled}, 1.0], w))) END AS p
            FROM expected e LEFT JOIN (SELECT ticker, date, stale FROM newest) n ON n.ticker = e.ticker
            LEFT JOIN features f ON f.ticker = n.ticker AND f.date = n.date, moments, logit"""}, f"""
            SELECT ticker, CASE WHEN whole THEN CASE WHEN p >= 0.5 THEN 'up' ELSE 'down' END END AS prediction,
                   CASE WHEN whole THEN round(p, {DIGITS}) END AS probability_up,
                   strftime(date, '%Y-%m-%d') AS last_feature_date,
                   CASE WHEN stale THEN 'stale' WHEN date IS NOT NULL THEN 'ok' END AS feature_freshness,
                   CASE WHEN date IS NULL THEN 'not_found' WHEN NOT whole THEN 'incomplete_features'
                        ELSE 'ok' END AS status
            FROM asked"""),
        "iforest_fit": _materialized(forest, f"""
            SELECT CAST(tree AS INTEGER) AS tree_id, CAST(node AS INTEGER) AS node_id,
                   CAST(coalesce(f - 1, -1) AS INTEGER) AS feature, round(coalesce(cut, 0.0), {DIGITS}) AS threshold,
                   CAST(CASE WHEN f IS NULL THEN -1 ELSE 2 * node + 1 END AS INTEGER) AS left_id,
                   CAST(CASE WHEN f IS NULL THEN -1 ELSE 2 * node + 2 END AS INTEGER) AS right_id,
                   round(len, {DIGITS}) AS path_length FROM nodes"""),
        "anomaly_scores": _materialized(forest, f"""
            SELECT ticker, date, CASE WHEN date < {CUTOFF} THEN 'train' ELSE 'test' END AS split,
                   round(score, {DIGITS}) AS anomaly_score, odd AS is_anomaly FROM flagged"""),
        "anomaly_sample": _materialized(forest, f"""
            SELECT ticker, date FROM flagged WHERE odd AND date >= {CUTOFF} ORDER BY ticker, date LIMIT 10"""),
        "model_evaluation": _materialized(_evaluated(), "SELECT * FROM evaluated"),
        "model_metadata": _materialized(_evaluated(), metadata),
        "model_roundtrip": both,
        "model_status": _materialized(_evaluated(), f"""
            SELECT 'ok' AS status, '{SETTINGS.cutoff}' AS train_cutoff_date, lr_accuracy, lr_f1, baseline_accuracy,
                   iso_anomaly_rate, {names} AS feature_cols,
                   true AS logistic_regression, true AS isolation_forest, true AS scaler
            FROM evaluated"""),
        "recent_anomalies": _materialized({
            **_scaled(), **recent,
            **_forest("SELECT ticker, date, x FROM recent ANTI JOIN xs USING (ticker, date) WHERE whole"),
            **_named("expected"), "listed": """
                SELECT ticker, date, odd, round(avg(CAST(odd AS DOUBLE)) OVER (PARTITION BY ticker), 4) AS rate,
                       bool_and(whole) OVER (PARTITION BY ticker) AS whole
                FROM recent LEFT JOIN flagged USING (ticker, date)"""}, f"""
            SELECT e.ticker, {SETTINGS.recent_rows} AS window_days, rate AS anomaly_rate,
                   strftime(date, '%Y-%m-%d') AS date, odd AS is_anomaly,
                   CASE WHEN date IS NULL THEN 'not_found' WHEN NOT whole THEN 'incomplete_features'
                        ELSE 'ok' END AS status
            FROM expected e LEFT JOIN listed USING (ticker)"""),
    }


def _window_sql(name: str) -> str:
    column = name if name == "target" else _round(name)
    return _sql({**_named("bars"), **_windows("bars")}, f"SELECT ticker, date, {column} FROM rolled")


def _asof_sql(series: list[str]) -> str:
    return _sql({**_named("bars", "macro"), "b": "SELECT ticker, date, adj_close FROM bars"},
                _asof("b", series))


def oracle_sql() -> dict[str, str]:
    feature_rows = f"SELECT ticker, date, {_ROUNDED}, target, feature_version FROM features"
    drift = _drift_parts()
    loads = {
        "bars": {**_named("bars"), **_load_sql("bars", "ticker", "adj_close", _BAR_COLS, False)},
        "incremental": {**_named("bars"), **_load_sql("bars", "ticker", "adj_close", _BAR_COLS, True)},
        "macro": {**_named("macro"),
                  **_load_sql("macro", "series_id", "value", "series_id, date, value", False)},
    }
    per_feature = "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{c}' AS feature, round(avg({c}), {DIGITS}) AS mean, "
        f"round(CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END, {DIGITS}) AS sd FROM train"
        for i, c in enumerate(FEATURE_COLS))
    moments = ", ".join(
        f"avg({c}) AS mean_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}"
        for c in FEATURE_COLS)
    scaled = ", ".join(f"round(({c} - mean_{c}) / sd_{c}, {DIGITS}) AS {c}" for c in FEATURE_COLS)
    majority = "SELECT target FROM train GROUP BY 1 ORDER BY count(*) DESC, target LIMIT 1"
    messages = f"""
        SELECT e.ticker, 'No rows found for ticker ' || e.ticker AS message
        FROM expected e WHERE e.ticker NOT IN (SELECT ticker FROM defective)
        UNION ALL
        SELECT ticker, 'Ticker ' || ticker || ' has ' || count(*) || ' row(s) with NULL adj_close'
        FROM defective WHERE adj_close IS NULL GROUP BY ticker
        UNION ALL
        SELECT ticker, 'Ticker ' || ticker || ' data is stale: latest date is '
               || strftime(max(date), '%Y-%m-%d') || ' (' || date_diff('day', max(date), {AS_OF})
               || ' days ago)'
        FROM defective WHERE ticker IN (SELECT ticker FROM expected)
        GROUP BY ticker HAVING date_diff('day', max(date), {AS_OF}) > {SETTINGS.load_stale_days}"""

    latest = f"""
        SELECT ticker, date, {_ROUNDED},
               date_diff('day', date, {AS_OF}) > {SETTINGS.serving_stale_days} AS stale
        FROM features WHERE return_1d IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1"""
    last_n = "QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= "

    out = {
        "scan_bars": _sql(_named("bars"), f"""
            SELECT {_BAR_COLS} FROM bars
            WHERE ticker IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
              AND date >= DATE '1998-01-01' AND date < {CUTOFF}"""),
        "scan_macro": _sql(_named("macro"), """
            SELECT series_id, date, value, CASE series_id
                   WHEN 'FEDFUNDS' THEN 'Federal Funds Rate' WHEN 'CPIAUCSL' THEN 'CPI - Inflation'
                   WHEN 'VIXCLS' THEN 'CBOE Volatility Index (VIX)'
                   ELSE '10Y-2Y Treasury Yield Spread' END AS description
            FROM macro WHERE date >= DATE '1998-01-01'"""),
        "scan_macro_series": _sql(_named("macro"),
                                  "SELECT date, value AS vix FROM macro WHERE series_id = 'VIXCLS'"),
        "normalize_columns": _sql(_named("bars"), f"SELECT {_BAR_COLS} FROM bars"),
        "drop_null_rows": _sql(_named("bars", "dirty"), """
            SELECT ticker, date, adj_close, volume FROM dirty WHERE adj_close IS NOT NULL"""),
        "union_batches": _sql(_named("bars"), f"""
            SELECT ticker, date, adj_close, volume, 'existing' AS batch FROM bars WHERE date < {OLD_END}
            UNION ALL
            SELECT ticker, date, adj_close, volume, 'incoming' FROM bars WHERE date >= {NEW_START}"""),
        "table_schemas": _schemas_sql(),
        "load_bars": _sql(loads["bars"], "SELECT * FROM loaded"),
        "load_macro": _sql(loads["macro"], "SELECT * FROM loaded"),
        "incremental_load": _sql(loads["incremental"],
                                 "SELECT * FROM loaded"),
        "streaming_load": _sql(_named("bars"), f"SELECT {_BAR_COLS} FROM bars"),
        "load_watermark": _sql(_named("bars", "expected"), f"""
            SELECT ticker, last_date, CAST(last_date + 1 AS DATE) AS next_start FROM (
                SELECT e.ticker, coalesce(max(b.date),
                       CAST({AS_OF} - {365 * SETTINGS.lookback_years} AS DATE)) AS last_date
                FROM expected e LEFT JOIN bars b ON b.ticker = e.ticker AND b.date < {OLD_END}
                GROUP BY e.ticker)"""),
        "ingestion_audit": _audit_sql(),
        "rejected_rows": _sql(_named("bars", "macro"), f"""
            SELECT 'raw_prices' AS table_name, '20010802_000000' AS run_id, ticker AS entity,
                   'volume' AS reason, date
            FROM bars WHERE ticker = '{BAD_TICKER}' AND day(date) = {BAD_DAY} AND date >= {NEW_START}
            UNION ALL
            SELECT 'raw_macro', '20010802_000000', series_id, 'value', date
            FROM macro WHERE series_id = '{BAD_SERIES}' AND day(date) = {BAD_DAY} AND date >= {NEW_START}"""),
        "damaged_files": _sql(_named("bars"), f"""
            SELECT '20010802_000000' AS run_id, 'yfinance' AS source, t.ticker,
                   CAST(count(b.date) AS INTEGER) AS rows_loaded,
                   CASE WHEN t.ticker = '{BAD_TICKER}' THEN 'failed' ELSE 'success' END AS status,
                   CASE WHEN t.ticker = '{BAD_TICKER}' THEN '1 row(s) could not be parsed' END AS error_msg
            FROM (VALUES {TICKERS}) t(ticker) LEFT JOIN bars b
              ON b.ticker = t.ticker AND b.date >= {NEW_START} AND t.ticker <> '{BAD_TICKER}'
            GROUP BY t.ticker"""),
        "daily_run": _sql(_features(), feature_rows),
        "daily_run_stopped": _sql(_named("bars"), f"""
            SELECT '20010802_000000' AS run_id, ticker, CAST(1 AS BIGINT) AS findings,
                   'Ticker ' || ticker || ' data is stale: latest date is ' || strftime(max(date), '%Y-%m-%d')
                   || ' (' || date_diff('day', max(date), {AS_OF}) || ' days ago)' AS message,
                   CAST(0 AS BIGINT) AS feature_rows
            FROM bars WHERE ticker <> '{STALE_TICKER}' OR date <= DATE '{STALE_AFTER}'
            GROUP BY ticker HAVING date_diff('day', max(date), {AS_OF}) > {DAILY.load_stale_days}"""),
        "score_without_model": _sql({**_features(), **_named("expected"), "newest": latest}, """
            SELECT e.ticker, CAST(NULL AS VARCHAR) AS prediction, CAST(NULL AS DOUBLE) AS probability_up,
                   strftime(n.date, '%Y-%m-%d') AS last_feature_date,
                   CAST(NULL AS VARCHAR) AS model_train_date,
                   CASE WHEN n.stale THEN 'stale' WHEN n.date IS NOT NULL THEN 'ok' END AS feature_freshness,
                   CASE WHEN n.date IS NULL THEN 'not_found' ELSE 'model_unavailable' END AS status
            FROM expected e LEFT JOIN newest n USING (ticker)"""),
        "asof_chain": _asof_sql(list(MACRO_SERIES)),
        "asof_far_date": _asof_sql(list(MACRO_SERIES)),
        "asof_nulls": _sql({
            **_named("bars", "macro"), "b": "SELECT ticker, date, adj_close FROM bars",
            "late": """
                SELECT series_id, date, CASE WHEN series_id = 'FEDFUNDS' AND date = DATE '1997-03-01'
                       THEN NULL ELSE value END AS value
                FROM macro WHERE series_id <> 'FEDFUNDS' OR date >= DATE '1995-06-01'""",
        }, _asof("b", list(MACRO_SERIES), "late")),
        "asof_keyed": _keyed_sql(),
        "asof_keyed_sliced": _keyed_sql(),
        "asof_keyed_ties": _sql(_named("purchases", "clicks"), """
            SELECT p.user_id, p.ts, p.event_id, p.value, c.click_id, c.click_value
            FROM (SELECT event_id, user_id, date_trunc('day', ts) AS ts, value FROM purchases) p
            ASOF LEFT JOIN (
                SELECT user_id, date_trunc('day', ts) AS ts, max(event_id) AS click_id,
                       arg_max(value, event_id) AS click_value
                FROM clicks GROUP BY 1, 2) c ON p.user_id = c.user_id AND p.ts > c.ts"""),
        "asof_keyed_nulls": _sql(_named("purchases", "clicks"), """
            SELECT p.user_id, p.ts, p.event_id, p.value, c.event_id AS click_id, c.value AS click_value
            FROM (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id,
                         CASE WHEN event_id % 5 <> 0 THEN ts END AS ts, value FROM purchases) p
            LEFT JOIN LATERAL (
                SELECT event_id, value FROM clicks c
                WHERE c.event_id % 3 <> 0 AND c.event_id % 4 <> 0
                  AND c.user_id = p.user_id AND c.ts < p.ts
                ORDER BY c.ts DESC, c.event_id DESC LIMIT 1) c ON true"""),
        "rsi_14": _sql({**_named("bars"), **_windows("bars"), **_rsi("priced")},
                       f"SELECT ticker, date, {_round('rsi_14')} FROM with_rsi"),
        "features": _sql(_features(), feature_rows),
        "features_stored": _sql(_features(), f"{feature_rows} WHERE date >= {CUTOFF} AND date < {AS_OF}"),
        "features_wide": _sql(_features("bars_wide"), feature_rows),
        "features_wide_chunked": _sql(_features("bars_wide"), feature_rows),
        "feature_summary": _sql(_features(), """
            SELECT ticker, count(*) AS row_count, count(*) - count(rsi_14) AS rsi_nulls,
                   count(*) - count(ma_50) AS ma_50_nulls, min(date) AS min_date, max(date) AS max_date
            FROM features GROUP BY ticker ORDER BY ticker"""),
        "rsi_update_join": _sql(_features(),
                                f"SELECT ticker, date, {_round('return_1d', 'rsi_14')} FROM features"),
        "check_missing_keys": _sql(_named("bars", "expected"), """
            SELECT ticker, CAST(0 AS BIGINT) AS row_count FROM expected
            WHERE ticker NOT IN (SELECT ticker FROM bars)"""),
        "check_null_values": _sql(_named("bars", "dirty", "defective"), """
            SELECT ticker, count(*) AS null_count FROM defective WHERE adj_close IS NULL GROUP BY 1"""),
        "check_staleness": _sql(_named("bars", "dirty", "defective", "expected"), f"""
            SELECT ticker, max(date) AS latest_date,
                   CAST(date_diff('day', max(date), {AS_OF}) AS INTEGER) AS days_old
            FROM defective JOIN expected USING (ticker) GROUP BY ticker
            HAVING date_diff('day', max(date), {AS_OF}) > {SETTINGS.load_stale_days}"""),
        "quality_report": _sql({**_named("bars", "dirty", "defective", "expected"), "messages": messages},
                               """SELECT ticker, count(*) AS findings,
                                         string_agg(message, chr(10) ORDER BY message) AS message
                                  FROM messages GROUP BY ticker"""),
        "latest_features": _sql(_features(), latest),
        "last_30_rows": _sql(_features(), f"{feature_rows} {last_n}{SETTINGS.recent_rows}"),
        "latest_wide": _sql(_named("bars_wide"), f"SELECT * FROM bars_wide {last_n}1"),
        "last_30_wide": _sql(_named("bars_wide"), f"SELECT * FROM bars_wide {last_n}{SETTINGS.recent_rows}"),
        "training_rows": _sql(_training(), f"SELECT ticker, date, {_ROUNDED}, target FROM labelled"),
        "temporal_split": _sql(_training(), f"""
            SELECT CASE WHEN date < {CUTOFF} THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows,
                   CAST(sum(target) AS BIGINT) AS positives, min(date) AS first_date, max(date) AS last_date
            FROM labelled GROUP BY 1"""),
        "scaler_params": _sql(_training(), per_feature),
        "scaled_features": _sql({**_training(), "moments": f"SELECT {moments} FROM train"},
                                f"SELECT ticker, date, {scaled}, target FROM labelled, moments"),
        "majority_class": _sql(_training(), f"""
            SELECT target AS majority_class, count(*) AS n_rows FROM train
            WHERE target = ({majority}) GROUP BY 1"""),
        "baseline_accuracy": _sql(_training(), f"""
            SELECT count(*) AS n_rows,
                   round(avg(CAST(target = ({majority}) AS INTEGER)), 4) AS baseline_accuracy FROM test"""),
        "classification_metrics": _sql({**_training(), "ruled": """
            SELECT target AS y, CAST(return_1d < 0 AS INTEGER) AS p FROM test"""}, """
            SELECT count(*) AS n_rows, round(avg(CAST(y = p AS INTEGER)), 4) AS lr_accuracy,
                   round(coalesce(sum(y * p) / NULLIF(CAST(sum(p) AS DOUBLE), 0), 0), 4) AS lr_precision,
                   round(coalesce(sum(y * p) / NULLIF(CAST(sum(y) AS DOUBLE), 0), 0), 4) AS lr_recall,
                   round(coalesce(2 * sum(y * p) / NULLIF(CAST(sum(y) + sum(p) AS DOUBLE), 0), 0), 4) AS lr_f1
            FROM ruled"""),
        "drift_reference_window": _sql(_features(), f"SELECT {_ROUNDED} FROM features WHERE date < {CUTOFF}"),
        "drift_current_window": _sql(_features(), f"""
            SELECT {_ROUNDED} FROM features WHERE date >= {AS_OF} - {SETTINGS.drift_days}"""),
        "drift_window_counts": _sql(_features(), f"""
            SELECT count(*) FILTER (WHERE date < {CUTOFF}) AS reference_rows,
                   count(*) FILTER (WHERE date >= {AS_OF} - {SETTINGS.drift_days}) AS current_rows
            FROM features"""),
        "drift_report": _sql(drift, f"""
            SELECT feature, reference_rows, current_rows, round(p, {DIGITS}) AS score,
                   p < 0.05 AS drift_detected, {AS_OF} AS run_date FROM scored"""),
        "drift_wasserstein": _sql(drift, f"""
            SELECT feature, reference_rows, current_rows, round(distance, {DIGITS}) AS score,
                   distance >= 0.1 AS drift_detected FROM scored"""),
        "drift_auto": _sql(drift, f"""
            SELECT feature, reference_rows, current_rows,
                   round(CASE WHEN reference_rows <= 1000 THEN p ELSE distance END, {DIGITS}) AS score,
                   CASE WHEN reference_rows <= 1000 THEN p < 0.05 ELSE distance >= 0.1 END AS drift_detected
            FROM scored"""),
        "drift_summary": _sql(drift, """
            SELECT count(*) FILTER (WHERE p < 0.05) AS drifted, count(*) AS tested FROM scored"""),
    }
    for fmt in ("csv", "json", "parquet"):
        out[f"scan_landing_{fmt}"] = out["normalize_columns"]
    for series_id, key in (("FEDFUNDS", "fedfunds"), ("CPIAUCSL", "cpiaucsl"), ("VIXCLS", "vix"),
                           ("T10Y2Y", "t10y2y")):
        out[f"asof_{key}"] = _asof_sql([series_id])
    for name in ("return_1d", "ma_5", "ma_20", "ma_50", "volatility_20", "volume_zscore"):
        out[name] = _window_sql(name)
    out["target_label"] = _window_sql("target")
    return out | _model_sql(latest)
