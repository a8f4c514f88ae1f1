"""The fixtures of ``fixtures.py`` and the expected result of each query, in DuckDB's SQL."""

from __future__ import annotations

from epigauge.spec import BURDEN_METRICS, METRICS, PROFILE_METRICS

FEATURES = [*METRICS, "Region_Index"]
BURDEN = " + ".join(BURDEN_METRICS)
METRIC_LIST = ", ".join(METRICS)
REGION = "CASE Region_Index WHEN 0 THEN 'Rural' WHEN 1 THEN 'Urban' END"
SEVERITY = "CASE Severity_Level WHEN 0 THEN 'Low Risk' WHEN 1 THEN 'Moderate Risk' WHEN 2 THEN 'High Risk' END"


def each(template: str, names=METRICS) -> str:
    """The template once per name, comma separated; ``{m}`` is the name and ``{i}`` its position."""
    return ", ".join(template.format(m=m, i=i) for i, m in enumerate(names))


def rounded(names, digits: int = 6) -> str:
    return each("round({m}, %d) + 0.0 AS {m}" % digits, names)


_KEYS = """CAST(l_shipdate AS DATE) AS day,
       'S' || lpad(CAST(l_suppkey % 36 AS VARCHAR), 2, '0') AS State,
       CASE WHEN l_linestatus = 'F' THEN 'Rural' ELSE 'Urban' END AS Region_Type,
       CASE WHEN l_linestatus = 'F' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS Region_Index"""

DAILY = f"""daily AS (
  SELECT {_KEYS}, strftime(CAST(l_shipdate AS DATE), '%d-%m-%Y') AS "Date",
       {each("sum(CASE WHEN l_partkey % 16 = {i} THEN l_quantity ELSE 0 END) AS {m}")}
  FROM lineitem GROUP BY ALL)"""

HOLED = f"""{DAILY}, holed AS (
  SELECT * REPLACE (
    CASE WHEN dayofmonth(day) % 5 <> 0 THEN C_Section END AS C_Section,
    CASE WHEN dayofmonth(day) % 7 = 0 THEN 'NaN'::DOUBLE ELSE Child_TB END AS Child_TB)
  FROM daily)"""

_RETURNED_SUM = [
    f"sum(CASE WHEN l_returnflag = 'R' AND l_partkey % 16 = {i} THEN l_quantity {'' if i % 2 else 'ELSE 0'} END) AS {m}"
    for i, m in enumerate(METRICS)
]
RETURNED = f"""returned AS (
  SELECT {_KEYS}, {", ".join(_RETURNED_SUM)} FROM lineitem GROUP BY ALL)"""

WINDOWS = f"""{DAILY}, windows AS (
  SELECT CAST(time_bucket(INTERVAL '30 days', day::TIMESTAMP, TIMESTAMP '1970-01-01') AS DATE) AS window_start,
       CAST(time_bucket(INTERVAL '30 days', day::TIMESTAMP, TIMESTAMP '1970-01-01') + INTERVAL 30 DAY AS DATE)
         AS window_end,
       State, Region_Index, {each("sum({m}) AS {m}")},
       count(DISTINCT day) AS days_seen, max(day) AS last_day
  FROM daily GROUP BY ALL)"""

PREDICTIONS = f"""{WINDOWS}, burdens AS (SELECT *, {BURDEN} AS burden FROM windows),
spread AS (SELECT min(burden) AS low, max(burden) AS high, sum(burden) / sum(days_seen)::BIGINT AS daily
  FROM burdens),
graded AS (
  SELECT burdens.*, window_end AS Month_Ending,
       1.0::DOUBLE + 99.0::DOUBLE * (burden - low) / (high - low) AS Vulnerability_Score,
       CASE WHEN burden > daily * 1.05::DOUBLE * days_seen THEN 2
            WHEN burden < daily * 0.95::DOUBLE * days_seen THEN 0 ELSE 1 END
         AS Severity_Level,
       {REGION} AS Region
  FROM burdens, spread),
predictions AS (
  SELECT *, CASE WHEN burden::BIGINT % 7 = 0 THEN (Severity_Level + 1) % 3 ELSE Severity_Level END AS Predicted_Level,
       State || ' (' || Region || ')' AS Location, {SEVERITY} AS Severity
  FROM graded)"""

LATEST = f"""{PREDICTIONS}, latest AS (
  SELECT * FROM predictions
  QUALIFY row_number() OVER (PARTITION BY State, Region_Index ORDER BY Month_Ending DESC) = 1)"""

SCALED = f"""{PREDICTIONS}, moments AS (
  SELECT {each("avg({m}) AS mu_{i}, stddev_samp({m}) AS sd_{i}", FEATURES)} FROM predictions),
scaled AS (
  SELECT window_start, State, p.Region_Index AS region_code, Severity_Level,
       {each("CASE WHEN sd_{i} = 0 THEN 0.0 ELSE (p.{m} - mu_{i}) / sd_{i} END AS z_{i}", FEATURES)}
  FROM predictions p, moments)"""



def _leading(matrix: str, name: str, size: int, steps: int = 16) -> str:
    """CTEs giving ``name.w``, the leading eigenvector of the one-row matrix table ``matrix.m``.

    The matrix is squared again and again, which leaves its leading eigenvector; the row sums are
    that eigenvector times the sum of its elements, so their sum is never negative.
    """
    ids = f"range(1, {size + 1})"
    return f"""{name}_squares(step, m) AS (
  SELECT 0, m FROM {matrix}
  UNION ALL
  SELECT step + 1, [[x / list_sum([p[k][k] for k in {ids}]) for x in r] for r in p]
  FROM (SELECT step, [[list_sum([r[k] * q[k] for k in {ids}]) for q in m] for r in m] AS p
        FROM {name}_squares WHERE step < {steps})),
{name}_sums AS (SELECT [list_sum(r) for r in m] AS v FROM {name}_squares WHERE step = {steps}),
{name} AS (SELECT [x / sqrt(list_sum([y * y for y in v])) for x in v] AS w FROM {name}_sums)"""


def _corr(names) -> str:
    return ", ".join("[" + ", ".join(f"corr({a}, {b})" for b in names) + "]" for a in names)


COMPONENT = f"""{WINDOWS}, matrix AS (SELECT [{_corr(BURDEN_METRICS)}] AS m FROM windows),
{_leading("matrix", "component", len(BURDEN_METRICS))},
burden_moments AS (
  SELECT {each("avg({m}) AS mu_{i}, stddev_samp({m}) AS sd_{i}", BURDEN_METRICS)} FROM windows),
projected AS (
  SELECT window_start, State, Region_Index,
       {" + ".join(f"({m} - mu_{i}) / sd_{i} * w[{i + 1}]" for i, m in enumerate(BURDEN_METRICS))} AS pc1
  FROM windows, burden_moments, component),
pc_range AS (SELECT min(pc1) AS low, max(pc1) AS high FROM projected),
vulnerability AS (
  SELECT window_start, State, Region_Index, pc1, 1 + (pc1 - low) / (high - low) * 99 AS score
  FROM projected, pc_range)"""

_N = len(FEATURES)
_IDS = f"range(1, {_N + 1})"
PLANE = f"""{SCALED}, matrix AS (SELECT [{_corr([f"z_{i}" for i in range(_N)])}] AS m FROM scaled),
{_leading("matrix", "first", _N)},
strength AS (
  SELECT m, w, list_sum([w[i] * list_sum([m[i][j] * w[j] for j in {_IDS}]) for i in {_IDS}]) AS s FROM matrix, first),
rest AS (SELECT [[m[i][j] - s * w[i] * w[j] for j in {_IDS}] for i in {_IDS}] AS m FROM strength),
{_leading("rest", "second", _N)}"""

_CENTRE_AVG = each("avg(z_{i}) AS c_{i}", FEATURES)
ASSIGNED = f"""{SCALED}, centres AS (
  SELECT Severity_Level AS cluster, {_CENTRE_AVG} FROM scaled GROUP BY Severity_Level),
distances AS (
  SELECT window_start, State, region_code, cluster,
       {" + ".join(f"(z_{i} - c_{i}) * (z_{i} - c_{i})" for i in range(_N))} AS squared_distance
  FROM scaled, centres),
assigned AS (
  SELECT * FROM distances
  QUALIFY row_number() OVER (PARTITION BY window_start, State, region_code ORDER BY squared_distance, cluster) = 1)"""

_NORM = " + ".join(f"z_{i} * z_{i}" for i in range(_N))
SILHOUETTE = f"""{SCALED}, points AS (SELECT *, {_NORM} AS q FROM scaled),
clusters AS (
  SELECT Severity_Level AS c, count(*)::DOUBLE AS n, sum(q) AS q, {each("sum(z_{i}) AS s_{i}", FEATURES)}
  FROM points GROUP BY Severity_Level),
pairs AS (
  SELECT p.window_start, p.State, p.region_code, p.Severity_Level AS own, k.c, k.n,
       greatest(0, p.q + k.q / k.n - 2 * ({" + ".join(f"p.z_{i} * k.s_{i}" for i in range(_N))}) / k.n) AS d
  FROM points p, clusters k),
sides AS (
  SELECT window_start, State, region_code,
       max(CASE WHEN c = own AND n > 1 THEN d * n / (n - 1) END) AS a, min(CASE WHEN c <> own THEN d END) AS b
  FROM pairs GROUP BY ALL)"""


# The separated windows and what fitted models must find in them.
SEPARATED = f"""{WINDOWS}, kinds AS (
  SELECT * EXCLUDE ({METRIC_LIST}), {each("{m} AS m_{i}")}, CAST(substr(State, 2) AS INTEGER) % 3 AS truth FROM windows),
separated AS (
  SELECT window_start, window_end, State, Region_Index, truth,
       {", ".join(f"(truth + 1) * {1000 * (1 + i % 3)}.0::DOUBLE + m_{i} % 5 AS {m}" for i, m in enumerate(METRICS))}
  FROM kinds)"""

SEPARATED_SCALED = f"""{SEPARATED}, moments AS (
  SELECT {each("avg({m}) AS mu_{i}, stddev_samp({m}) AS sd_{i}", FEATURES)} FROM separated),
scaled AS (
  SELECT window_start, State, p.Region_Index AS region_code, truth AS Severity_Level,
       {each("CASE WHEN sd_{i} = 0 THEN 0.0 ELSE (p.{m} - mu_{i}) / sd_{i} END AS z_{i}", FEATURES)}
  FROM separated p, moments)"""

SEPARATED_PLANE = SEPARATED_SCALED + PLANE.removeprefix(SCALED)
SEPARATED_ASSIGNED = SEPARATED_SCALED + ASSIGNED.removeprefix(SCALED)
SEPARATED_SILHOUETTE = SEPARATED_SCALED + SILHOUETTE.removeprefix(SCALED)
SEPARATED_COMPONENT = SEPARATED + COMPONENT.removeprefix(WINDOWS).replace("FROM windows", "FROM separated")
_SILHOUETTE_OF = "SELECT count(*) AS points, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM sides"

HOLED_WINDOWS = f"""{DAILY}, told AS (
  SELECT * REPLACE (
    CASE WHEN dayofmonth(day) % 5 <> 0 AND State <> 'S03' THEN C_Section END AS C_Section,
    CASE WHEN State <> 'S03' THEN Child_TB END AS Child_TB)
  FROM daily),
told_windows AS (
  SELECT CAST(time_bucket(INTERVAL '30 days', day::TIMESTAMP, TIMESTAMP '1970-01-01') AS DATE) AS window_start,
       State, Region_Index, sum(C_Section) AS C_Section, sum(Child_TB) AS Child_TB,
       count(*) FILTER (C_Section IS NULL) AS C_Section_missing, count(*) FILTER (Child_TB IS NULL) AS Child_TB_missing,
       count(DISTINCT day) AS days_seen, max(day) AS last_day
  FROM told GROUP BY ALL)"""


def oracles() -> dict[str, str]:
    """Expected result per query name."""
    return {name: sql.strip() for name, sql in _ORACLES.items()}


MONTHS = f"""{DAILY}, months AS (
  SELECT CAST(date_trunc('month', day) AS DATE) AS window_start,
       CAST(date_trunc('month', day) + INTERVAL 1 MONTH AS DATE) AS window_end,
       State, Region_Index, {each("sum({m}) AS {m}")},
       count(DISTINCT day) AS days_seen, max(day) AS last_day
  FROM daily GROUP BY ALL)"""
_SHOWN = ["ANC_Registered", "Child_TB", "Early_Breastfeeding"]

_LOG_COLUMNS = f"""window_start, window_end, State, Region_Index, {METRIC_LIST}, days_seen, last_day"""
_CLOSED = "window_end <= (SELECT max(last_day) - INTERVAL 2 DAY FROM windows)"

_ORACLES = {
    # sources and sinks
    "daily_reports": f"""WITH {DAILY} SELECT day, "Date", State, Region_Type, Region_Index, {METRIC_LIST} FROM daily""",
    "scan_csv_roundtrip": f"""WITH {DAILY} SELECT "Date", State, Region_Index, {METRIC_LIST} FROM daily""",
    "json_encode": f"""WITH {DAILY} SELECT day, State, Region_Index, {METRIC_LIST} FROM daily""",
    "json_decode": """
        SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "json_quarantine": """
        SELECT CASE event_id % 20 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'bad_time' WHEN 2 THEN 'missing_key'
                 WHEN 5 THEN 'future_time' WHEN 6 THEN 'too_old' ELSE 'accepted' END AS outcome,
               count(*) AS records,
               sum(CASE WHEN event_id % 20 > 7 THEN 1 ELSE 0 END)::BIGINT AS values_read
        FROM events GROUP BY 1""",
    "json_extra_fields": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
               user_id::INTEGER AS user_id, NULL::INTEGER AS nothing,
               CASE WHEN event_id % 10 = 3 THEN 'bad_time' ELSE 'accepted' END AS outcome
        FROM events""",
    "replay_by_date": f"""WITH {DAILY}
        SELECT year(day)::INTEGER AS year, count(*) AS records, row_number() OVER (ORDER BY year(day)) - 1 AS batch
        FROM daily GROUP BY year(day)""",
    "replay_daily_batches": f"""WITH {DAILY} SELECT "Date", count(*) AS records FROM daily GROUP BY 1""",
    "replay_files": f"""WITH {DAILY} SELECT year(day)::INTEGER AS tick, count(*) AS records FROM daily GROUP BY 1""",
    "preview": f"""WITH {DAILY}
        SELECT day, State, Region_Index, {METRIC_LIST} FROM daily ORDER BY day, State, Region_Index LIMIT 5""",
    # scalar functions, filters, cleaning
    "parse_event_time": """
        SELECT event_id,
               CASE WHEN event_id % 10 <> 0 THEN CAST(ts AS DATE) END AS day,
               event_id % 10 <> 0 AS parsed
        FROM events""",
    "label_lookup": """
        SELECT event_id,
               CASE event_id % 4 WHEN 0 THEN 'Rural' WHEN 1 THEN 'Urban' END AS Region,
               CASE event_id % 5 WHEN 0 THEN 'Low Risk' WHEN 1 THEN 'Moderate Risk' WHEN 2 THEN 'High Risk' END
                 AS Severity
        FROM events""",
    "location_label": """
        SELECT event_id, event_type || ' (' || CASE event_id % 4 WHEN 0 THEN 'Rural' WHEN 1 THEN 'Urban' END || ')'
                 AS Location
        FROM events""",
    "numeric_columns": f"""WITH {RETURNED}
        {" UNION ALL ".join(f"SELECT '{m}' AS column_name, count(*) FILTER ({m} <> 0) AS nonzero_rows, count(*) FILTER ({m} IS NULL) AS missing_rows FROM returned" for m in METRICS)}""",
    "clean_nonzero": f"""WITH {RETURNED}
        SELECT day, State, Region_Index, {METRIC_LIST} FROM returned
        WHERE {" OR ".join(f"coalesce({m} <> 0, false)" for m in METRICS)}""",
    "clean_report": f"""WITH {RETURNED}, kept AS (
          SELECT {" OR ".join(f"coalesce({m} <> 0, false)" for m in METRICS)} AS keep FROM returned)
        SELECT count(*) AS rows_before, count(*) FILTER (keep) AS rows_after, count(*) FILTER (NOT keep) AS rows_removed
        FROM kept""",
    "skip_invalid": f"""WITH {HOLED}
        SELECT day, State, Region_Index, {METRIC_LIST} FROM holed
        WHERE {" AND ".join(f"{m} IS NOT NULL AND NOT isnan({m})" for m in METRICS)}""",
    "skip_invalid_report": f"""WITH {HOLED}, kept AS (
          SELECT {" AND ".join(f"({m} IS NOT NULL AND NOT isnan({m}))" for m in METRICS)} AS keep FROM holed)
        SELECT count(*) AS rows_seen, count(*) FILTER (keep) AS rows_kept, count(*) FILTER (NOT keep) AS rows_skipped
        FROM kept""",
    "high_risk": f"""WITH {LATEST}
        SELECT Location, Month_Ending, round(Vulnerability_Score, 6) AS Vulnerability_Score
        FROM latest WHERE Severity = 'High Risk'""",
    # windows
    "window_sum": f"""WITH {WINDOWS} SELECT {_LOG_COLUMNS} FROM windows""",
    "window_missing": f"""WITH {HOLED}
        SELECT CAST(time_bucket(INTERVAL '30 days', day::TIMESTAMP, TIMESTAMP '1970-01-01') AS DATE) AS window_start,
               State, Region_Index,
               sum(C_Section) AS C_Section,
               sum(CASE WHEN isnan(Child_TB) THEN NULL ELSE Child_TB END) AS Child_TB,
               count(*) FILTER (C_Section IS NULL) AS C_Section_missing,
               count(*) FILTER (isnan(Child_TB)) AS Child_TB_missing,
               count(DISTINCT day) AS days_seen
        FROM holed GROUP BY ALL""",
    "window_finality": f"""WITH {WINDOWS}
        SELECT window_start, State, Region_Index, days_seen, {_CLOSED} AS is_final,
               round(ANC_Registered * (30.0::DOUBLE / days_seen), 6) AS ANC_Registered
        FROM windows""",
    # aggregations and serving
    "latest_predictions": f"""WITH {LATEST}
        SELECT State, Region_Index, Month_Ending, Severity_Level, round(Vulnerability_Score, 6) AS Vulnerability_Score,
               Region, Location
        FROM latest""",
    "cluster_profile": f"""WITH {PREDICTIONS}
        SELECT Severity_Level AS prediction, {", ".join(f"round(avg({m}), 6) AS {n}" for m, n in PROFILE_METRICS.items())}
        FROM predictions GROUP BY 1""",
    "kpi_summary": f"""WITH {LATEST}
        SELECT count(DISTINCT State) AS states_monitored,
               count(*) FILTER (Severity = 'High Risk') AS high_risk_regions,
               round(max(Vulnerability_Score), 2) AS max_vulnerability_score,
               max(Month_Ending) AS last_updated
        FROM latest""",
    "high_risk_alert": f"""WITH {LATEST}
        SELECT CASE WHEN count(*) FILTER (Severity = 'High Risk') > 0 THEN 'HIGH RISK ALERT' ELSE 'STABLE' END AS level,
               count(*) FILTER (Severity = 'High Risk') AS high_risk_regions,
               coalesce(string_agg(Location, ', ' ORDER BY Location) FILTER (Severity = 'High Risk'), '') AS locations
        FROM latest""",
    "prediction_feed": f"""WITH {LATEST}
        SELECT Location, Severity, round(Vulnerability_Score, 6) AS Vulnerability_Score FROM latest""",
    "severity_display": f"""WITH {LATEST}
        SELECT Location, Severity, CASE Severity WHEN 'High Risk' THEN 'red' WHEN 'Moderate Risk' THEN 'orange'
                 WHEN 'Low Risk' THEN 'green' ELSE 'Unknown' END AS display_class
        FROM latest""",
    "severity_distribution": f"""WITH {LATEST}
        SELECT Severity, count(*) AS n FROM latest WHERE Severity IS NOT NULL GROUP BY 1""",
    "vulnerability_ranking": f"""WITH {LATEST}
        SELECT Location, round(Vulnerability_Score, 6) AS Vulnerability_Score,
               rank() OVER (ORDER BY Vulnerability_Score DESC) AS rank
        FROM latest""",
    "top10_vulnerable": f"""WITH {LATEST}
        SELECT Location, Severity, round(Vulnerability_Score, 6) AS Vulnerability_Score
        FROM latest ORDER BY latest.Vulnerability_Score DESC, Location LIMIT 10""",
    "score_histogram": f"""WITH {PREDICTIONS}, ends AS (
          SELECT min(Vulnerability_Score) AS low, (max(Vulnerability_Score) - min(Vulnerability_Score)) / 30.0 AS width
          FROM predictions),
        counts AS (
          SELECT least(floor((Vulnerability_Score - low) / width), 29)::BIGINT AS bin, count(*) AS n
          FROM predictions, ends GROUP BY 1)
        SELECT b.bin, round(low + b.bin * width, 6) AS lower_bound, round(low + (b.bin + 1) * width, 6) AS upper_bound,
               coalesce(n, 0) AS n
        FROM range(30) AS b(bin) CROSS JOIN ends LEFT JOIN counts USING (bin)""",
    "score_density": f"""WITH {PREDICTIONS}, stats AS (
          SELECT min(Vulnerability_Score) AS low, max(Vulnerability_Score) AS high, count(*)::DOUBLE AS n,
                 stddev_samp(Vulnerability_Score) * pow(count(*)::DOUBLE, -0.2) AS h
          FROM predictions),
        placed AS (
          SELECT floor((Vulnerability_Score - low) / (h / 256)) AS bin, (Vulnerability_Score - low) / (h / 256) - bin AS part
          FROM predictions, stats),
        weights AS (
          SELECT t, sum(weight) AS weight
          FROM (SELECT bin AS t, 1 - part AS weight FROM placed UNION ALL SELECT bin + 1, part FROM placed) GROUP BY t),
        bins AS (SELECT low + t * (h / 256) AS t, weight FROM weights, stats),
        grid AS (SELECT g.point, low + g.point * ((high - low) / 199) AS x FROM range(200) AS g(point), stats)
        SELECT point::INTEGER AS point, round(x, 6) AS "at",
               round(sum(weight * exp(-0.5 * ((x - t) / h) * ((x - t) / h)) / (n * h * sqrt(2 * pi()))), 8) AS density
        FROM bins, stats, grid GROUP BY ALL""",
    # features and models
    "region_index": f"""WITH {DAILY}, counts AS (SELECT Region_Type, count(*) AS n FROM daily GROUP BY 1)
        SELECT Region_Type, (row_number() OVER (ORDER BY n DESC, Region_Type) - 1)::DOUBLE AS region_code, n
        FROM counts""",
    "zscore_features": f"""WITH {SCALED}
        SELECT window_start, State, region_code, {rounded([f"z_{i}" for i in range(_N)])} FROM scaled""",
    "minmax_score": f"""WITH {PREDICTIONS}
        SELECT window_start, State, Region_Index, round(1 + (burden - low) / (high - low) * 99, 6) AS scaled_burden
        FROM predictions, spread""",
    "moments_merged": f"""WITH {WINDOWS}
        {" UNION ALL ".join(f"SELECT '{m}' AS metric, count(*) AS rows, round(avg({m}), 6) AS mean, round(stddev_samp({m}), 6) AS deviation, min({m}) AS least, max({m}) AS most, round(corr({METRICS[0]}, {m}), 6) + 0.0 AS related FROM windows" for m in METRICS)}""",
    "moments_score": f"""WITH RECURSIVE {COMPONENT}
        SELECT window_start, State, Region_Index, round(pc1, 5) + 0.0 AS pc1 FROM projected""",
    "moments_cost": f"""WITH {PREDICTIONS}, centred AS (
          SELECT {" + ".join(f"pow({m} - avg({m}) OVER (PARTITION BY Severity_Level), 2)" for m in METRICS)} AS d FROM predictions)
        SELECT count(*) AS rows, round(sum(d), 4) AS cost FROM centred""",
    "pca_loading": f"""WITH RECURSIVE {COMPONENT}
        SELECT unnest([{", ".join(f"'{m}'" for m in BURDEN_METRICS)}]) AS metric,
               unnest([round(x, 6) for x in w]) AS loading
        FROM component""",
    "pca_score": f"""WITH RECURSIVE {COMPONENT}
        SELECT window_start, State, Region_Index, round(pc1, 5) + 0.0 AS pc1 FROM projected""",
    "pca_2d": f"""WITH RECURSIVE {PLANE}
        SELECT window_start, State, region_code,
               round({" + ".join(f"z_{i} * first.w[{i + 1}]" for i in range(_N))}, 5) + 0.0 AS PCA1,
               round({" + ".join(f"z_{i} * second.w[{i + 1}]" for i in range(_N))}, 5) + 0.0 AS PCA2
        FROM scaled, first, second""",
    "vulnerability_score": f"""WITH RECURSIVE {COMPONENT}
        SELECT window_start, State, Region_Index, round(score, 5) AS Vulnerability_Score FROM vulnerability""",
    "vulnerability_top10": f"""WITH RECURSIVE {COMPONENT}, newest AS (
          SELECT * FROM vulnerability
          QUALIFY row_number() OVER (PARTITION BY State, Region_Index ORDER BY window_start DESC) = 1)
        SELECT State || ' (' || {REGION} || ')' AS Location, round(score, 5) AS Vulnerability_Score
        FROM newest ORDER BY score DESC, Location LIMIT 10""",
    "split_80_20": f"""WITH {WINDOWS}
        SELECT window_start, State, Region_Index,
               ('0x' || substr(md5(strftime(window_start, '%Y-%m-%d') || '|' || State || '|' || Region_Index::INTEGER), 1, 8))
                 ::BIGINT % 100 < 80 AS is_train
        FROM windows""",
    "kmeans_assign": f"""WITH {ASSIGNED}
        SELECT window_start, State, region_code, cluster, round(squared_distance, 5) AS squared_distance FROM assigned""",
    "wssse": f"""WITH {ASSIGNED} SELECT round(sum(squared_distance), 4) AS cost FROM assigned""",
    "silhouette": f"""WITH {SILHOUETTE}
        SELECT count(*) AS points,
               round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
                 AS silhouette
        FROM sides""",
    "severity_relabel": f"""WITH {PREDICTIONS}, ided AS (
          SELECT *, (Severity_Level * 2 + 1) % 3 AS cluster FROM predictions),
        ranks AS (
          SELECT cluster, (row_number() OVER (ORDER BY avg(burden), cluster) - 1)::INTEGER AS severity
          FROM ided GROUP BY cluster)
        SELECT window_start, State, Region_Index, ranks.severity FROM ided JOIN ranks USING (cluster)""",
    "confusion_matrix": f"""WITH {PREDICTIONS}
        SELECT Severity_Level AS label, Predicted_Level AS prediction, count(*) AS n FROM predictions GROUP BY ALL""",
    "classifier_metrics": f"""WITH {PREDICTIONS}, classes AS (SELECT unnest([0, 1, 2]) AS c),
        counts AS (
          SELECT c, count(*) FILTER (Severity_Level = c) AS actual, count(*) FILTER (Predicted_Level = c) AS named,
                 count(*) FILTER (Severity_Level = c AND Predicted_Level = c) AS hits
          FROM predictions, classes GROUP BY c),
        rates AS (SELECT *, coalesce(hits / nullif(named, 0), 0) AS p, coalesce(hits / nullif(actual, 0), 0) AS r FROM counts)
        SELECT sum(actual)::BIGINT AS rows, round(sum(hits) / sum(actual), 6) AS accuracy,
               round(sum(p * actual) / sum(actual), 6) AS weighted_precision,
               round(sum(r * actual) / sum(actual), 6) AS weighted_recall,
               round(sum(coalesce(2 * p * r / nullif(p + r, 0), 0) * actual) / sum(actual), 6) AS weighted_f1
        FROM rates""",
    # streaming
    "stream_source_files": """
        SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS records FROM events GROUP BY ALL""",
    "stream_window_append": """
        WITH buckets AS (
          SELECT CAST(time_bucket(INTERVAL '30 days', ts, TIMESTAMP '1970-01-01') AS DATE) AS window_start, *
          FROM events)
        SELECT window_start, event_type, round(sum(value), 4) AS value, count(DISTINCT CAST(ts AS DATE)) AS days_seen
        FROM buckets
        WHERE window_start + INTERVAL 30 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)
        GROUP BY ALL""",
    "stream_update_log": f"""WITH {WINDOWS} SELECT {_LOG_COLUMNS}, {_CLOSED} AS is_final FROM windows""",
    "stream_latest": f"""WITH {WINDOWS}
        SELECT {_LOG_COLUMNS} FROM windows
        QUALIFY row_number() OVER (PARTITION BY State, Region_Index ORDER BY window_end DESC) = 1""",
    "stream_once_per_report": f"""WITH {WINDOWS} SELECT {_LOG_COLUMNS} FROM windows""",
    "stream_quarantine": """
        SELECT CASE event_id % 20 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'bad_time' WHEN 2 THEN 'missing_key'
                 WHEN 5 THEN 'future_time' ELSE 'too_old' END AS reject_reason,
               count(*) AS records
        FROM events WHERE event_id % 20 IN (0, 1, 2, 5, 6) GROUP BY 1""",
    "stream_scored": f"""WITH RECURSIVE {SEPARATED_COMPONENT}
        SELECT window_start, State, Region_Index, CAST(substr(State, 2) AS INTEGER) % 3 AS Severity_Level,
               round(score, 5) AS Vulnerability_Score
        FROM vulnerability""",
    "stream_holed_reports": f"""WITH {HOLED_WINDOWS}
        SELECT window_start, State, Region_Index, round(C_Section * 30.0::DOUBLE / days_seen, 5) + 0.0 AS C_Section,
               round(Child_TB * 30.0::DOUBLE / days_seen, 5) + 0.0 AS Child_TB, C_Section_missing, Child_TB_missing, days_seen,
               window_start + INTERVAL 30 DAY <= (SELECT max(last_day) - INTERVAL 2 DAY FROM told_windows
                 WHERE C_Section IS NOT NULL AND Child_TB IS NOT NULL) AS is_final
        FROM told_windows WHERE C_Section IS NOT NULL AND Child_TB IS NOT NULL""",
    "stream_skipped": f"""WITH {HOLED_WINDOWS}
        SELECT State, count(*) AS windows FROM told_windows WHERE C_Section IS NULL OR Child_TB IS NULL GROUP BY 1""",
    "stream_late": f"""WITH {DAILY}, sent AS (
          SELECT *, floor(year(day) / 2)::INTEGER
                 + CASE WHEN dayofyear(day) % 9 = 0 AND substr(State, 2)::INTEGER % 4 = 0 THEN 1 ELSE 0 END AS tick
          FROM daily),
        marks AS (
          SELECT tick, max(max(day)) OVER (ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 DAY
                   AS mark
          FROM sent GROUP BY tick),
        judged AS (
          SELECT sent.*, CAST(time_bucket(INTERVAL '30 days', day::TIMESTAMP, TIMESTAMP '1970-01-01') AS DATE) AS window_start,
                 coalesce(window_start + INTERVAL 30 DAY <= mark, false) AS is_late
          FROM sent JOIN marks USING (tick))
        SELECT window_start, State, Region_Index, {each("sum({m}) AS {m}", _SHOWN)},
               {each("sum({m}) FILTER (is_late) AS late_{m}", _SHOWN)},
               count(DISTINCT day) AS days_seen, count(*) AS reports, count(*) FILTER (is_late) AS late_reports
        FROM judged GROUP BY ALL""",
    "stream_months": f"""WITH {MONTHS}
        SELECT {_LOG_COLUMNS}, {_CLOSED.replace("windows", "months")} AS is_closed FROM months""",
    "month_sum": f"""WITH {MONTHS}
        SELECT window_start, State, Region_Index, days_seen,
               {each("round({m} * (window_end - window_start)::DOUBLE / days_seen, 6) + 0.0 AS {m}", _SHOWN)}
        FROM months""",
    "stream_live_latest": f"""WITH {WINDOWS}
        SELECT {_LOG_COLUMNS} FROM windows
        QUALIFY row_number() OVER (PARTITION BY State, Region_Index ORDER BY window_end DESC) = 1""",
    "stream_open_windows": f"""WITH {WINDOWS} SELECT {_LOG_COLUMNS} FROM windows WHERE NOT {_CLOSED}""",
    "stream_sketched_kpi": f"""WITH {WINDOWS}
        SELECT count(DISTINCT State) AS states, count(*) AS rows, min(ANC_Registered) AS least, max(ANC_Registered) AS most
        FROM windows WHERE {_CLOSED}""",
    "stream_sketched_quantiles": """
        SELECT (5 * i)::INTEGER AS percent, true AS within_error FROM range(1, 20) t(i)""",
    # fitted models on windows with one right answer
    "kmeans_clusters": f"""WITH {SEPARATED}
        SELECT window_start, State, Region_Index, truth AS severity FROM separated""",
    "k_sweep": f"""WITH {SEPARATED_ASSIGNED}, {SEPARATED_SILHOUETTE.removeprefix(SEPARATED_SCALED).removeprefix(", ")}
        SELECT k::INTEGER AS k, true AS cost_agrees, true AS silhouette_agrees,
               CASE WHEN k = 3 THEN (SELECT round(sum(squared_distance), 4) FROM assigned) END AS cost,
               CASE WHEN k = 3 THEN silhouette END AS silhouette
        FROM ({_SILHOUETTE_OF}), range(2, 8) t(k)""",
    "cluster_map_2d": f"""WITH RECURSIVE {SEPARATED_PLANE}
        SELECT window_start, State, region_code,
               round({" + ".join(f"z_{i} * first.w[{i + 1}]" for i in range(_N))}, 5) + 0.0 AS PCA1,
               round({" + ".join(f"z_{i} * second.w[{i + 1}]" for i in range(_N))}, 5) + 0.0 AS PCA2,
               Severity_Level AS severity, ['Safe', 'Average', 'Critical'][Severity_Level + 1] AS Health_Status
        FROM scaled, first, second""",
    "severity_train": f"""WITH {SEPARATED_ASSIGNED}, held AS (
          SELECT count(*) AS n FROM separated
          WHERE ('0x' || substr(md5(strftime(window_start, '%Y-%m-%d') || ' 00:00:00|' || State || '|'
                 || Region_Index::INTEGER || '.0'), 1, 8))::BIGINT % 100 >= 80)
        SELECT 50 AS trees, 3 AS classes, (SELECT round(sum(squared_distance), 4) FROM assigned) AS cost, n AS rows,
               1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS weighted_precision, 1.0::DOUBLE AS weighted_recall,
               1.0::DOUBLE AS weighted_f1
        FROM held""",
    "feature_importance": f"""
        SELECT 'metric' AS kind, {len(METRICS)}::BIGINT AS features, 1.0::DOUBLE AS total, true AS falling
        UNION ALL SELECT 'region', 1, 0.0, true""",
    "severity_predict": f"""WITH {SEPARATED}
        SELECT truth AS Severity_Level, ['Low Risk', 'Moderate Risk', 'High Risk'][truth + 1] AS Severity, count(*) AS n
        FROM separated GROUP BY 1, 2""",
    "score_windows": f"""WITH RECURSIVE {SEPARATED_COMPONENT}
        SELECT window_start, CAST(window_start + INTERVAL 30 DAY AS DATE) AS Month_Ending, State, Region_Index,
               CAST(substr(State, 2) AS INTEGER) % 3 AS Severity_Level, round(score, 5) AS Vulnerability_Score,
               round(score, 5) AS Vulnerability_Clipped, {REGION} AS Region, State || ' (' || {REGION} || ')' AS Location
        FROM vulnerability""",
    # models: what can be said without the fitted trees
    "model_roundtrip": f"""WITH {WINDOWS}
        SELECT count(*) AS rows, 0::BIGINT AS differing FROM windows""",
}
