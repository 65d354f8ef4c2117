"""Registry of the queries, their SQL twins, and the tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlens import schemas as S
from ledgerlens.operators import ledger, model, rules
from ledgerlens.session import configure, materialize_scratch, scratch_path
from ledgerlens.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Thresholds that give alerts at the density of the shared tables.
VELOCITY = {"min_count": 3, "seconds": 3600}
AMOUNT = {"ratio": 5.0}
GEO = {"max_kmh": 800.0}


def plain(df: DataFrame) -> DataFrame:
    """Column types both engines print alike: decimals as doubles, dates as text, zone-less times."""
    def cast(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return c.cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.ShortType):
            return c.cast("int").alias(f.name)
        return c
    return df.select(*[cast(f) for f in df.schema])


def query(name: str, sql: str | None = None):
    """Register a query; `sql` is its DuckDB twin, with `{cte}` names resolved by `with_views`."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return plain(fn(spark, sf_dir))
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn
    return register


# ---------------------------------------------------------------- views in SQL

def rule_views(source: str, group: str, suffix: str = "") -> dict[str, str]:
    """The three rules over a view, users being told apart by the `group` columns."""
    views = {
        "rolled": """
  SELECT *, count(*) OVER (PARTITION BY GROUP_KEYS ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS n FROM {SOURCE}""",
        # The average is kept to six digits, half up, with whole-number arithmetic.
        "baseline": """
  SELECT GROUP_KEYS, count(*) AS n, CAST((CAST(sum(amount) * 100 AS BIGINT) * 20000 + count(*)) // (2 * count(*)) AS BIGINT) AS avg6,
    stddev_samp(CAST(amount AS DOUBLE)) AS stddev_amount
  FROM {SOURCE} WHERE event_ts >= TIMESTAMP '2024-01-01' GROUP BY GROUP_KEYS""",
        "hops": """
  SELECT *, lag(event_ts) OVER w AS prev_ts, lag(sec) OVER w AS prev_sec, lag(latitude) OVER w AS prev_lat,
    lag(longitude) OVER w AS prev_lon, lag(country_code) OVER w AS prev_country
  FROM {SOURCE} WINDOW w AS (PARTITION BY GROUP_KEYS ORDER BY event_ts, transaction_id)""",
        "speeds": """
  SELECT *, km / CASE WHEN hours > 0 THEN hours ELSE 0.001 END AS kmh FROM (
    SELECT *, (sec - prev_sec) / 3600.0::DOUBLE AS hours,
      12742.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin((radians(CAST(latitude AS DOUBLE)) - radians(CAST(prev_lat AS DOUBLE))) / 2), 2)
        + cos(radians(CAST(prev_lat AS DOUBLE))) * cos(radians(CAST(latitude AS DOUBLE)))
        * pow(sin((radians(CAST(longitude AS DOUBLE)) - radians(CAST(prev_lon AS DOUBLE))) / 2), 2)))) AS km
    FROM {hops} WHERE prev_lat IS NOT NULL AND country_code <> prev_country)""",
        "velocity": """
  SELECT transaction_id, event_ts, 'VELOCITY_ATTACK' AS reason_code, n / 6.0::DOUBLE AS raw_severity,
    'User had ' || n || ' transactions in 3600 seconds' AS description FROM {rolled} WHERE n >= 3""",
        "high_amount": """
  SELECT transaction_id, event_ts, 'HIGH_AMOUNT' AS reason_code,
    ((CAST(amount * 100 AS BIGINT) * 10000 - avg6) / 1000000.0::DOUBLE) / ((avg6 / 1000000.0::DOUBLE) * 5.0::DOUBLE) AS raw_severity,
    'Amount $' || amount || ' vs user avg $' || CAST(((avg6 + 5000) // 10000) / 100.0 AS DECIMAL(18,2)) AS description
  FROM {SOURCE} JOIN {baseline} USING (GROUP_KEYS) WHERE avg6 > 0 AND CAST(amount AS DOUBLE) > (avg6 / 1000000.0::DOUBLE) * 5.0::DOUBLE""",
        "geo": """
  SELECT transaction_id, event_ts, 'GEO_IMPOSSIBLE' AS reason_code, kmh / 2000.0::DOUBLE AS raw_severity, '' AS description
  FROM {speeds} WHERE kmh > 800""",
    }

    def adapt(text: str) -> str:
        text = text.replace("{SOURCE}", f"{{{source}}}").replace("GROUP_KEYS", group)
        for name in views:
            text = text.replace(f"{{{name}}}", f"{{{name}{suffix}}}")
        return text
    return {f"{name}{suffix}": adapt(text) for name, text in views.items()}


def forest_views(source: str, trees: int, psi: int = 256, seed: int = 42) -> dict[str, str]:
    """The forest grown and applied level by level with joins: `trees_<source>` has its nodes, `scored_<source>` every row's score."""
    digits = lambda n, *parts: f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, {n}) AS BIGINT)"
    length = "CASE WHEN n <= 1 THEN 0.0::DOUBLE WHEN n = 2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * (ln(n - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * (n - 1.0::DOUBLE) / n END"
    v = lambda name: f"{name}_{source}"
    columns = ("amount", "latitude", "longitude")
    views = {
        v("pool"): f"""
  SELECT DISTINCT CAST(transaction_id AS VARCHAR) AS k, {digits(15, str(seed), "CAST(transaction_id AS VARCHAR)")} AS h,
    {", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(columns))}
  FROM {{{source}}} WHERE amount IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL ORDER BY h, k LIMIT {trees * psi}""",
        v("level0"): f"""
  SELECT tree, 1 AS node, f0, f1, f2 FROM {{{v("pool")}}},
    (SELECT t AS tree, 1 + {digits(7, str(seed), "t", "'factor'")} AS a, {digits(7, str(seed), "t", "'shift'")} AS b FROM range({trees}) g(t))
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY (h % 2147483647 * a + b) % 2147483647, h, k, f0, f1, f2) <= {psi}""",
        v("size"): f"SELECT max(n) AS psi FROM (SELECT count(*) AS n FROM {{{v('level0')}}} GROUP BY tree)",
    }
    depth = 8
    for d in range(depth + 1):
        views[v(f"nodes{d}")] = f"""
  SELECT *, low + {digits(13, str(seed), "tree", "node", "'cut'")} / 4503599627370496.0::DOUBLE * (high - low) AS cut FROM (
    SELECT *, [l0, l1, l2][feature + 1] AS low, [h0, h1, h2][feature + 1] AS high FROM (
      SELECT *, CASE WHEN len(free) > 0 AND {d} < ceil(log2(greatest((SELECT psi FROM {{{v("size")}}}), 2)))
        THEN free[CAST({digits(8, str(seed), "tree", "node", "'feature'")} % len(free) AS INTEGER) + 1] END AS feature FROM (
        SELECT *, list_filter([CASE WHEN h0 > l0 THEN 0 END, CASE WHEN h1 > l1 THEN 1 END, CASE WHEN h2 > l2 THEN 2 END], lambda x: x IS NOT NULL) AS free FROM (
          SELECT tree, node, count(*) AS n, {", ".join(f"min(f{i}) AS l{i}, max(f{i}) AS h{i}" for i in range(3))} FROM {{{v(f"level{d}")}}} GROUP BY tree, node))))"""
        if d < depth:
            views[v(f"level{d + 1}")] = f"""
  SELECT s.tree, 2 * s.node + CASE WHEN [f0, f1, f2][feature + 1] > CASE WHEN cut < high THEN cut ELSE low END THEN 1 ELSE 0 END AS node, f0, f1, f2
  FROM {{{v(f"level{d}")}}} s JOIN {{{v(f"nodes{d}")}}} n USING (tree, node) WHERE feature IS NOT NULL"""
    views[v("trees")] = " UNION ALL ".join(f"""
  SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(feature AS INTEGER) AS feature, CASE WHEN cut < high THEN cut ELSE low END AS threshold,
    CASE WHEN feature IS NULL THEN {d} + {length} END AS path, CAST((SELECT psi FROM {{{v("size")}}}) AS INTEGER) AS sample_size FROM {{{v(f"nodes{d}")}}}""" for d in range(depth + 1))
    views[v("walk0")] = f"""
  SELECT transaction_id AS k, {", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS f{i}" for i, c in enumerate(columns))}, tree, 1 AS node
  FROM {{{source}}}, range({trees}) g(tree)"""
    for d in range(depth):
        views[v(f"walk{d + 1}")] = f"""
  SELECT k, f0, f1, f2, w.tree, CASE WHEN feature IS NULL THEN w.node ELSE 2 * w.node + CASE WHEN [f0, f1, f2][feature + 1] > threshold THEN 1 ELSE 0 END END AS node
  FROM {{{v(f"walk{d}")}}} w JOIN {{{v("trees")}}} n ON n.tree = w.tree AND n.node = w.node"""
    views[v("scored")] = f"""
  SELECT transaction_id, CASE WHEN high > low THEN round((raw - low) / (high - low), 4) ELSE 0.0::DOUBLE END AS ml_score FROM (
    SELECT *, min(raw) OVER () AS low, max(raw) OVER () AS high FROM (
      SELECT k AS transaction_id, pow(2.0::DOUBLE, -avg(path) / (SELECT {length} FROM (SELECT psi AS n FROM {{{v("size")}}}))) AS raw
      FROM {{{v(f"walk{depth}")}}} w JOIN {{{v("trees")}}} n ON n.tree = w.tree AND n.node = w.node GROUP BY k))"""
    return views


VIEWS = {
    "t": """
  SELECT event_id AS transaction_id, user_id, CAST(k AS BIGINT) AS merchant_id, CAST(value AS DECIMAL(18,2)) AS amount,
    CASE user_id % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' WHEN 4 THEN 'CAD' WHEN 5 THEN 'MXN' ELSE 'BRL' END AS currency,
    ts AS event_ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
    CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'transfer' WHEN 'view' THEN 'withdrawal' ELSE 'refund' END AS transaction_type,
    CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 10 = 0 THEN 'pending' WHEN event_id % 10 = 1 THEN 'disputed' ELSE 'completed' END AS status,
    CASE k % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'bank_transfer' WHEN 2 THEN 'wallet' ELSE 'crypto' END AS payment_method,
    'dev-' || lpad(lower(printf('%x', user_id)), 8, '0') AS device_id,
    '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(k AS VARCHAR) AS ip_address,
    CAST(-60 + (k % 25) * 5 AS DECIMAL(9,6)) AS latitude, CAST(-168 + (k % 25) * 14 AS DECIMAL(9,6)) AS longitude,
    CAST(k % 25 AS VARCHAR) AS country_code, '5411' AS mcc_code, CAST(ts AS DATE) AS partition_date,
    CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS time_sk, event_type = 'error' AS is_fraud
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "dirty": """
  SELECT * REPLACE (
    CASE WHEN transaction_id % 90 = 0 THEN NULL ELSE user_id END AS user_id,
    CASE WHEN transaction_id % 50 = 0 THEN -amount ELSE amount END AS amount,
    CASE WHEN transaction_id % 70 = 0 THEN 'XYZ' ELSE currency END AS currency,
    CASE WHEN transaction_id % 110 = 0 THEN CAST(91 AS DECIMAL(9,6)) WHEN transaction_id % 30 = 0 THEN NULL ELSE latitude END AS latitude)
  FROM {t}""",
    "checked": """
  SELECT *, coalesce(transaction_id IS NOT NULL AND user_id IS NOT NULL AND merchant_id IS NOT NULL AND amount > 0
    AND event_ts <= TIMESTAMP '2024-01-31' AND currency IN ('USD','EUR','GBP','JPY','CAD','MXN','BRL')
    AND (latitude IS NULL OR latitude BETWEEN -90 AND 90) AND (longitude IS NULL OR longitude BETWEEN -180 AND 180), FALSE) AS ok
  FROM {dirty}""",
    "users_in": """
  SELECT c_custkey AS user_id, sha256(c_name) AS email_hash,
    CASE WHEN c_acctbal < 0 THEN 'high' WHEN c_acctbal < 3000 THEN 'medium' ELSE 'low' END AS risk_tier,
    CAST(c_nationkey AS VARCHAR) AS country_code
  FROM customer""",
    # What the silver layer holds, and the rules run on each of its days alone.
    "silver": "SELECT * FROM {checked} WHERE ok",
    **rule_views("t", "user_id"),
    **rule_views("silver", "partition_date, user_id", "_by_day"),
    # Bursts and trips go over midnight.
    **{name: view for name, view in rule_views("silver", "user_id", "_by_day").items() if name in ("rolled_by_day", "hops_by_day")},
    # In the jobs a user's usual amount is that of the 30 days up to the row's day.
    "baseline_by_day": """
  SELECT partition_date, user_id, sum(k) AS n, CAST((CAST(sum(s) * 100 AS BIGINT) * 20000 + sum(k)) // (2 * sum(k)) AS BIGINT) AS avg6
  FROM (SELECT d.partition_date, d.user_id, x.s, x.k FROM (SELECT DISTINCT partition_date, user_id FROM {silver}) d
    JOIN (SELECT partition_date AS day, user_id, sum(amount) AS s, count(*) AS k FROM {silver} GROUP BY 1, 2) x
      ON x.user_id = d.user_id AND x.day <= d.partition_date AND x.day > d.partition_date - 30)
  GROUP BY 1, 2""",
    "alerts": """
  SELECT transaction_id, event_ts AS alert_timestamp, CAST(event_ts AS DATE) AS alert_date, reason_code,
    CAST(round(CAST(CAST(least(raw_severity, 1.0) AS FLOAT) AS DOUBLE), 4) AS DECIMAL(5,4)) AS severity_score, description,
    CASE transaction_id % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'investigating' WHEN 2 THEN 'closed_false_positive' ELSE 'confirmed_fraud' END AS status
  FROM (SELECT * FROM {velocity} UNION ALL SELECT * FROM {high_amount} UNION ALL SELECT * FROM {geo})""",
    "fact0": """
  SELECT transaction_id, user_id, merchant_id, md5(CAST(user_id AS VARCHAR)) AS user_sk, md5(CAST(merchant_id AS VARCHAR)) AS merchant_sk, time_sk,
    partition_date, amount, currency, transaction_type, status, payment_method, country_code, event_ts AS created_at
  FROM {t} WHERE user_id IN (SELECT c_custkey FROM customer) AND merchant_id IN (SELECT p_partkey FROM part)""",
    "fact": """
  SELECT f.*, a.severity IS NOT NULL AS is_flagged_fraud, coalesce(a.severity, 0) AS fraud_score
  FROM {fact0} f LEFT JOIN (SELECT transaction_id, max(severity_score) AS severity FROM {alerts} WHERE status = 'open' GROUP BY 1) a
    USING (transaction_id)""",
    "daily": """
  SELECT partition_date AS txn_date, count(*) AS total_transactions, count(*) FILTER (WHERE status = 'completed') AS completed_transactions,
    sum(amount) FILTER (WHERE status = 'completed') AS daily_tpv,
    CAST(sum(amount) FILTER (WHERE status = 'completed') AS DOUBLE) / nullif(count(*) FILTER (WHERE status = 'completed'), 0) AS avg_txn_value,
    count(*) FILTER (WHERE is_flagged_fraud) AS fraud_alerts,
    round(CAST(count(*) FILTER (WHERE is_flagged_fraud) AS DOUBLE) * 100.0::DOUBLE / count(*), 4) AS fraud_rate_pct
  FROM {fact} GROUP BY 1""",
    "kpi_mart": """
  SELECT *, sum(daily_tpv) OVER (ORDER BY txn_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS tpv_30d,
    avg(fraud_rate_pct) OVER (ORDER BY txn_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS fraud_rate_7d_avg FROM {daily}""",
    "bucketed": """
  SELECT *, CASE WHEN severity_score >= 0.8 THEN 'critical' WHEN severity_score >= 0.5 THEN 'high' WHEN severity_score >= 0.2 THEN 'medium'
    ELSE 'low' END AS severity_bucket FROM {alerts}""",
    "risk_mart": """
  SELECT alert_date, reason_code, severity_bucket, status, count(*) AS alert_count, CAST(sum(severity_score) AS DOUBLE) / count(*) AS avg_severity,
    max(severity_score) AS max_severity, count(DISTINCT transaction_id) AS unique_transactions
  FROM {bucketed} GROUP BY ALL""",
    **forest_views("t", 200),
    **forest_views("dirty", 200),
    **forest_views("silver", 200),
    "order_days": """
  SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1""",
}


FOREST_TREES = 200
MATERIALIZED = ("pool_", "level", "nodes", "trees_", "walk", "size_")


def with_views(sql: str) -> str:
    """Replace {view} by its name and put the views it needs in front, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if f"{{{name}}}" in text and name not in needed:
                needed.add(name)
                visit(VIEWS[name])
    visit(sql)

    def named(text: str) -> str:
        for name in VIEWS:
            text = text.replace(f"{{{name}}}", f"v_{name}")
        return text.strip()
    ctes = [f"v_{name} AS {'MATERIALIZED ' if name.startswith(MATERIALIZED) else ''}(\n  {named(VIEWS[name])})" for name in VIEWS if name in needed]
    return (f"WITH {', '.join(ctes)}\n" if ctes else "") + named(sql)


# ---------------------------------------------------------------- views in Spark

def alert_status(column: str = "transaction_id"):
    return tables._pick(F.pmod(column, F.lit(4)), S.ALERT_STATUSES)


def velocity(t: DataFrame, extra=()) -> DataFrame:
    return rules.detect_velocity_attack(t, extra=extra, **VELOCITY)


def high_amount(t: DataFrame, extra=()) -> DataFrame:
    return rules.detect_high_amount(t, as_of=tables.AS_OF, extra=extra, **AMOUNT)


def geo(t: DataFrame, extra=()) -> DataFrame:
    return rules.detect_geo_impossible(t, extra=extra, **GEO)


def alerts(t: DataFrame) -> DataFrame:
    """Alert log rows whose alert time is the event's own time."""
    found = rules.union_alerts(*[rule(t, ("timestamp",)) for rule in (velocity, high_amount, geo)])
    return rules.alert_envelope(found, alert_time=F.col("timestamp"), status=alert_status())


def staged_facts(t: DataFrame) -> DataFrame:
    """Staged rows that count as loaded when they happened."""
    return model.stage_fact(t.withColumn("_silver_processed_at", F.col("timestamp"))).withColumn("loaded_at", F.col("_silver_processed_at"))


def dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    empty = spark.createDataFrame([], T.StructType([
        T.StructField("user_id", T.LongType()) if f.name == "user_id" else f for f in S.USER_HISTORY]))
    history = model.scd2_snapshot(empty, tables.users(spark, sf_dir), as_of="2024-01-01 00:00:00")
    return model.dim_users(history), model.dim_merchants(tables.merchants(spark, sf_dir), "2024-01-01 00:00:00")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.fct_transactions(staged_facts(tables.transactions(spark, sf_dir)), *dims(spark, sf_dir))


def event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.dim_time(model.calendar_of(tables.table(spark, sf_dir, "events"), "ts"))


_STORED: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build):
    """Build a shared table set once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = build()
    return _STORED[key]


def gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The stored gold tables that dashboards, monitors and reports read."""
    def build():
        t = tables.transactions(spark, sf_dir)
        log = materialize_scratch(alerts(t), "alerts_log", ["alert_date"])
        users, merchants = (materialize_scratch(d, "dim") for d in dims(spark, sf_dir))
        flagged = model.apply_fraud_flags(model.fct_transactions(staged_facts(t), users, merchants), log)
        fact = materialize_scratch(flagged, "fact", ["time_sk"])
        days = materialize_scratch(event_calendar(spark, sf_dir), "dim_time")
        return {"alerts": log, "alert_ledger": materialize_scratch(ledger.alert_ledger(log), "alert_ledger"),
                "ledger": materialize_scratch(ledger.fact_ledger(fact), "load_ledger"), "users": users, "merchants": merchants, "fact": fact, "days": days,
                "kpi_mart": materialize_scratch(model.mart_executive_kpis(fact, days), "kpi_mart"),
                "risk_mart": materialize_scratch(model.mart_fraud_summary(log), "risk_mart")}
    return once(spark, sf_dir, "gold", build)


def landed(spark: SparkSession, sf_dir: str) -> str:
    """A lake root whose landing folders hold the transactions as JSON lines, four folders a day."""
    def build():
        root = scratch_path(spark, "lake")
        tables.land_transactions(tables.dirty_transactions(spark, sf_dir), root)
        return root
    return once(spark, sf_dir, "landed", build)
