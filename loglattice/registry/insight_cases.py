"""Facts, written insights, explanations, and candidate texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglattice.functions import text as W
from loglattice.operators import insights as I, serving as K
from loglattice.plans import views as V
from loglattice.registry import model_cases as M
from loglattice.registry.case import Cases
from loglattice.registry.fixture import half_up as r, logs, over_logs, over_silver, page_views, silver
from loglattice.registry.gold_cases import HOURLY_TREND, HTTP_STATUS, LATENCY, LEVELS, OVERVIEW, TOPICS
from loglattice.registry.serving_cases import _PATTERNS
from loglattice.session import cut_lineage

CASES = Cases()

# Services split by weekday: some of them fall under the scoring floor.
_WEEKDAY = "weekday AS (SELECT * REPLACE (service || '-' || day_of_week AS service) FROM silver)"
_W_OVERVIEW = OVERVIEW.replace("FROM silver", "FROM weekday")
_W_LATENCY = LATENCY.replace("FROM silver", "FROM weekday")


def weekday(spark, d):
    return silver(spark, d).withColumn("service", F.concat_ws("-", "service", "day_of_week"))


def _facts(events):
    return I.service_facts(V.service_overview(events), V.service_latency(events))


_FACTS = f"""
facts AS (
  SELECT service, log_lines, http_requests, coalesce(request_count, 0) AS latency_samples, error_count, warning_count,
         critical_count, anomaly_count, error_rate AS error_rate_pct, warning_rate AS warning_rate_pct,
         {r('100.0 * critical_count / log_lines', 2)} AS critical_rate_pct, anomaly_rate AS anomaly_rate_pct, risk_score,
         health_status, log_lines >= 100 AS is_scored, latency_coverage, p50_response_time, p95_response_time,
         avg_response_time, {r('100.0 * log_lines / (SELECT sum(log_lines) FROM overview)', 4)} AS share_of_estate_pct
  FROM overview LEFT JOIN latency USING (service))
"""


def n(column: str) -> str:
    return f"format('{{:,}}', CAST({column} AS BIGINT))"


def short(column: str, digits: int = 2) -> str:
    return f"regexp_replace(printf('%.{digits}f', {r(column, digits)}), '\\.?0+$', '')"


def many(column: str, singular: str, plural: str | None = None) -> str:
    return f"{n(column)} || CASE {column} WHEN 1 THEN ' {singular}' ELSE ' {plural or singular + 's'}' END"


def secs(column: str) -> str:
    return f"printf('%.3f', {r(column, 3)}) || 's'"


_TEXTS = f"""
texts AS (
  SELECT *,
    CASE WHEN latency_samples = 0 THEN 'Its response time is not measured, because none of its ' || {n('log_lines')}
              || ' lines completes a request; that does not make it fast or idle.'
         ELSE 'Over ' || {n('latency_samples')} || ' timed requests the median is ' || {secs('p50_response_time')}
              || ' and the 95th percentile ' || {secs('p95_response_time')} || '.'
              || CASE WHEN p50_response_time > 0 AND p95_response_time / p50_response_time >= 2
                      THEN ' The slow tail takes ' || printf('%.1f', {r('p95_response_time / p50_response_time', 1)})
                           || ' times as long as the median.' ELSE '' END END AS latency_text,
    CASE WHEN error_rate_pct >= 50 THEN 'failures'
         WHEN error_count + warning_count + critical_count = 0 THEN 'None of its ' || {n('log_lines')} || ' lines is above INFO.'
         ELSE 'Of its ' || {n('log_lines')} || ' lines it logged '
              || CASE len(kinds) WHEN 1 THEN kinds[1] WHEN 2 THEN kinds[1] || ' and ' || kinds[2]
                      ELSE kinds[1] || ', ' || kinds[2] || ' and ' || kinds[3] END
              || ', an error rate of ' || {short('error_rate_pct')} || '% and a warning rate of '
              || {short('warning_rate_pct')} || '%.' END AS severity_text,
    CASE WHEN anomaly_count = 0 THEN '' ELSE ' ' || {many('anomaly_count', 'line')}
         || ' from labelled instances; a label is known, not predicted.' END AS anomaly_text,
    service || ' wrote ' || {n('log_lines')} || ' lines, ' || {short('share_of_estate_pct')} || '% of all.' AS volume
  FROM (SELECT *, list_filter([CASE WHEN critical_count > 0 THEN {n('critical_count')} || ' critical' END,
                               CASE WHEN error_count > 0 THEN {n('error_count')} || ' error' END,
                               CASE WHEN warning_count > 0 THEN {n('warning_count')} || ' warning' END],
                              lambda x: x IS NOT NULL) AS kinds FROM facts)),
written AS (
  SELECT service,
    CASE WHEN is_scored THEN service || ': ' || health_status || ' at risk ' || {short('risk_score')}
         ELSE service || ': ' || {many('log_lines', 'line')} || ', too few to score' END AS headline,
    CASE WHEN is_scored THEN volume || ' ' || severity_text || anomaly_text || ' ' || latency_text || ' Its risk score is '
              || {short('risk_score')} || ', in the ' || lower(health_status) || ' band.'
         ELSE volume || ' That is under the 100 lines needed for a score, where a single error already shifts the rates, '
              || 'so it is left out of the ranking. ' || latency_text END AS narrative,
    CASE WHEN NOT is_scored THEN 'Keep it out of alerts until it writes enough lines to be scored.'
         WHEN critical_count > 0 THEN 'Read its ' || {many('critical_count', 'critical line')} || ' one by one.'
         WHEN warning_rate_pct >= 5 THEN 'Sample its warnings before alerting: many are often one condition.'
         WHEN latency_samples = 0 THEN 'Nothing to do on latency unless it starts to log completed requests.'
         ELSE 'Nothing to do; keep it as a baseline.' END AS recommended_action,
    CASE health_status WHEN 'Healthy' THEN 'healthy' ELSE CASE health_status WHEN 'Critical' THEN 'critical'
         ELSE 'degraded' END END AS severity, log_lines
  FROM texts)
"""


@CASES.add("service_facts", "I1", over_silver("SELECT * FROM facts", OVERVIEW, LATENCY, _FACTS))
def service_facts(spark, d):
    return _facts(silver(spark, d))


@CASES.add("service_sentences", "I4 I5 I6", over_silver(
    "SELECT service, latency_text, severity_text, anomaly_text FROM texts", _WEEKDAY, _W_OVERVIEW, _W_LATENCY, _FACTS, _TEXTS))
def service_sentences(spark, d):
    return _facts(weekday(spark, d)).select(
        "service", I.latency_text().alias("latency_text"), I.severity_text().alias("severity_text"),
        I.anomaly_text().alias("anomaly_text"))


_WRITTEN = "SELECT service, headline, narrative, recommended_action, severity FROM written"


@CASES.add("service_insights", "I3 I7", over_silver(_WRITTEN, OVERVIEW, LATENCY, _FACTS, _TEXTS))
def service_insights(spark, d):
    return I.service_insight(_facts(silver(spark, d))).select("service", *I.TEXT_FIELDS, "severity")


@CASES.add("service_insights_by_weekday", "I3 I7", over_silver(
    _WRITTEN, _WEEKDAY, _W_OVERVIEW, _W_LATENCY, _FACTS, _TEXTS))
def service_insights_by_weekday(spark, d):
    return I.service_insight(_facts(weekday(spark, d))).select("service", *I.TEXT_FIELDS, "severity")


def _estate(views):
    names = ("service_overview", "service_latency", "log_level", "http_status", "hourly_trend", "topic")
    return I.estate_facts(*[views[f"vw_dash_{name}"] for name in names])


_TOP = ("FROM overview ORDER BY log_lines >= 100 DESC, CASE WHEN log_lines >= 100 THEN risk_score END DESC NULLS LAST, "
        "log_lines DESC, service LIMIT 1")
_ESTATE = f"""
estate AS (
  SELECT CAST(sum(log_lines) AS BIGINT) AS total_log_lines, CAST(sum(http_requests) AS BIGINT) AS total_http_requests,
         count(*) AS services_total, count(*) FILTER (log_lines >= 100) AS services_scored,
         count(*) FILTER (log_lines < 100) AS services_below_volume_floor,
         (SELECT count(*) FROM latency) AS services_with_measured_latency,
         CAST(sum(error_count) AS BIGINT) AS total_errors, CAST(sum(warning_count) AS BIGINT) AS total_warnings,
         CAST(sum(critical_count) AS BIGINT) AS total_criticals, CAST(0 AS BIGINT) AS levels_in_disagreement,
         CAST(sum(anomaly_count) AS BIGINT) AS total_anomaly_labels,
         (SELECT service {_TOP}) AS highest_risk_service, (SELECT risk_score {_TOP}) AS highest_risk_score,
         (SELECT health_status {_TOP}) AS highest_risk_health_status,
         (SELECT count(*) FROM hourly_trend) AS hours_observed,
         (SELECT strftime(event_hour_ts, '%Y-%m-%d %H:%M:%S') FROM hourly_trend ORDER BY log_lines DESC, event_hour_ts LIMIT 1)
           AS peak_hour, (SELECT max(log_lines) FROM hourly_trend) AS peak_lines,
         (SELECT log_lines FROM levels WHERE log_level = 'INFO') AS info_lines
  FROM overview)
"""
_ESTATE_CTES = (OVERVIEW, LATENCY, LEVELS, HOURLY_TREND, _ESTATE)


@CASES.add("estate_facts", "I2 K13 K14", over_silver("SELECT * FROM estate", *_ESTATE_CTES))
def estate_facts(spark, d):
    facts = _estate(page_views(spark, d))
    return facts.withColumns({
        "peak_lines": F.col("peak_hour.log_lines"), "info_lines": F.col("log_level_counts")["INFO"],
        "peak_hour": F.col("peak_hour.hour"),
    }).drop("log_level_counts", "http_status_class_counts", "kafka_topics")


_ESTATE_TEXT = f"""
estate_written AS (
  SELECT {n('total_log_lines')} || ' lines from ' || {many('services_total', 'service')} || ', most at risk: '
         || highest_risk_service AS headline,
    {n('services_total')} || ' services wrote ' || {n('total_log_lines')} || ' lines, ' || {n('total_http_requests')}
    || ' of them requests. ' || {short('100.0 * info_lines / total_log_lines', 1)} || '% are INFO; the rest holds '
    || {many('total_warnings', 'warning')} || ', ' || {many('total_errors', 'error')} || ' and '
    || {many('total_criticals', 'critical line')} || '. The highest risk score is ' || {short('highest_risk_score')} || ' at '
    || highest_risk_service || '.'
    || CASE WHEN services_below_volume_floor > 0
            THEN ' ' || {many('services_below_volume_floor', 'service')} || ' wrote too few lines to be ranked.' ELSE '' END
    || CASE WHEN total_anomaly_labels > 0 THEN ' ' || {many('total_anomaly_labels', 'line')} || ' from labelled instances.'
            ELSE ' No line comes from a labelled instance; check the label list.' END
    || ' Latency is measured for ' || {n('services_with_measured_latency')} || ' of ' || {n('services_total')}
    || ' services only.' AS narrative,
    'Begin with ' || highest_risk_service || ', and read services without a score or a latency as unmeasured, not as well.'
      AS recommended_action,
    CASE WHEN total_criticals > 0 THEN 'critical' WHEN total_errors > 0 THEN 'degraded' ELSE 'healthy' END AS severity,
    total_log_lines AS log_lines
  FROM estate)
"""


@CASES.add("estate_insight", "I8", over_silver(
    "SELECT headline, narrative, recommended_action, severity FROM estate_written", *_ESTATE_CTES, _ESTATE_TEXT))
def estate_insight(spark, d):
    return I.estate_insight(_estate(page_views(spark, d))).select(*I.TEXT_FIELDS, "severity")


# ------------------------------------------------------------------ explanations


def _flat(df, *keys):
    steps = F.array_join("what_to_check_next", " | ").alias("what_to_check_next")
    return df.select(*keys, "headline", "what_happened", "why_did_this_happen", "impact", steps, "generation_mode")


_BOTH = f"'It logged ' || errors || ' (' || {short('error_rate_pct')} || '%) and ' || warnings || ' (' || {short('warning_rate_pct')} || '%).'"


@CASES.add("explain_services", "I9", over_silver(f"""
SELECT service, service || ': ' || CASE band WHEN 'low' THEN 'too few lines to score' WHEN 'Healthy' THEN 'healthy'
         ELSE 'errors put it in the ' || lower(band) || ' band' END AS headline,
       CASE band WHEN 'low' THEN 'It wrote ' || {n('log_lines')} || ' lines with ' || errors || '.'
         WHEN 'Healthy' THEN 'Its error rate is ' || {short('error_rate_pct')} || '% over ' || {n('log_lines')} || ' lines.'
         ELSE {_BOTH} END AS what_happened,
       CASE band WHEN 'low' THEN 'Below 100 lines a rate such as ' || {short('error_rate_pct')}
                                 || '% says more about the sample than the service.'
         WHEN 'Critical' THEN 'Errors make up 5% or more of its ' || {n('log_lines')} || ' lines, for a risk score of ' || risk || '.'
         WHEN 'Degraded' THEN 'Errors make up 1% to 5% of its ' || {n('log_lines')} || ' lines, for a risk score of ' || risk || '.'
         ELSE 'Errors stay under 1%, with ' || warnings || ' and ' || {many('anomaly_count', 'labelled line')}
              || ', for a risk score of ' || risk || '.' END AS why_did_this_happen,
       CASE band WHEN 'low' THEN 'Little, given the volume; single failures can still matter.'
         WHEN 'Critical' THEN 'High: what depends on it may fail with it.'
         WHEN 'Degraded' THEN 'Moderate: it works, but a condition keeps coming back.'
         ELSE 'None to be seen in its logs.' END AS impact,
       CASE band
         WHEN 'low' THEN 'Read its failure lines directly | Leave it out of the ranking for now | Check that it is meant to be quiet'
         WHEN 'Critical' THEN 'Trace its errors to what raised them | Read the critical lines first | '
                              || 'Look for a timeout or schedule behind the failures'
         WHEN 'Degraded' THEN 'Sample its errors and warnings for one repeated cause | Check the resources it depends on | '
                              || 'Set its alert above the normal level'
         ELSE 'Keep watching its risk score | ' || CASE latency_coverage WHEN 'measured'
                THEN 'Compare its latency percentiles over time' ELSE 'Note that its latency is not measured' END
              || ' | Look at labelled lines during maintenance' END AS what_to_check_next,
       'rule_based' AS generation_mode
FROM (SELECT *, CASE WHEN log_lines < 100 THEN 'low' ELSE health_status END AS band, {many('error_count', 'error')} AS errors,
             {many('warning_count', 'warning')} AS warnings, printf('%.2f', risk_score) AS risk FROM facts)""",
    _WEEKDAY, _W_OVERVIEW, _W_LATENCY, _FACTS))
def explain_services(spark, d):
    return _flat(I.explain(_facts(weekday(spark, d))), "service")


@CASES.add("explain_anomalies", "I9", over_silver(f"""
SELECT service, log_level, status_code, service || ': ' || {many('anomaly_occurrences', 'labelled line')} AS headline,
       {many('anomaly_occurrences', 'line')} || ' of ' || service || ' from labelled instances.' AS what_happened,
       'They share level ' || log_level || ', category ' || response_category || ' and status '
         || coalesce(CAST(status_code AS VARCHAR), 'none') || '.'
         || CASE WHEN avg_response_time IS NULL THEN ' Their response time is not measured.'
                 ELSE ' Their mean response time is ' || {secs('avg_response_time')} || '.' END AS why_did_this_happen,
       'The label marks the instance, so not every one of its lines is a fault.' AS impact,
       'Follow the instances through their states | Compare the times with the load of their hosts | '
         || 'Look for other work at the same time' AS what_to_check_next, 'rule_based' AS generation_mode
FROM patterns""", _PATTERNS))
def explain_anomalies(spark, d):
    return _flat(I.explain(K.anomaly_patterns(silver(spark, d)), "anomaly"), "service", "log_level", "status_code")


@CASES.add("explain_estate", "I9", over_silver(f"""
SELECT 'All services together' AS headline, {n('services_total')} || ' services are in the tables.' AS what_happened,
       'The figures cover ' || {n('total_log_lines')} || ' lines and ' || {n('total_http_requests')} || ' requests.'
         AS why_did_this_happen, 'Every chart reads the same tables, so they agree.' AS impact,
       'Watch for a shift between levels | Compare the risk ranking over time | Check services without a latency'
         AS what_to_check_next, 'rule_based' AS generation_mode FROM estate""", *_ESTATE_CTES))
def explain_estate(spark, d):
    return _flat(I.explain(_estate(page_views(spark, d)), "general"))


# ------------------------------------------------------------------ candidate texts


def _candidates(facts):
    """Good and fenced, without a field, with an invented number, or no JSON, by the number of lines."""
    kind = F.col("log_lines") % 4
    stem = F.concat(F.lit('{"headline":"'), "service", F.lit(" wrote "), W.thousands(F.col("log_lines")), F.lit(' lines"'))
    action = F.lit(',"recommended_action":"Look at 3 of them."')
    good = F.concat(stem, action, F.lit(',"narrative":"There are '), F.col("error_count").cast("string"), F.lit(' errors."}'))
    text = (
        F.when(kind == 0, F.concat(F.lit("```json\n"), good, F.lit("\n```")))
        .when(kind == 1, F.concat(stem, action, F.lit(',"narrative":" "}')))
        .when(kind == 2, F.concat(stem, action, F.lit(',"narrative":"There are 987654321 errors."}')))
        .otherwise(F.lit("I cannot say."))
    )
    return facts.select(F.col("service").alias("scope_key"), text.alias("raw_text"))


_W = (_WEEKDAY, _W_OVERVIEW, _W_LATENCY, _FACTS, _TEXTS)


@CASES.add("parsed_candidates", "I10", over_silver(f"""
SELECT service AS scope_key, service || ' wrote ' || {n('log_lines')} || ' lines' AS headline,
       'There are ' || CASE log_lines % 4 WHEN 0 THEN error_count ELSE 987654321 END || ' errors.' AS narrative,
       'Look at 3 of them.' AS recommended_action FROM facts WHERE log_lines % 4 IN (0, 2)""", *_W))
def parsed_candidates(spark, d):
    return I.parse_candidates(_candidates(_facts(weekday(spark, d))))


@CASES.add("number_grounding", "I11", over_logs("""
SELECT event_id, kafka_offset % 5 IN (0, 1, 4) AS grounded FROM logs"""))
def number_grounding(spark, d):
    offset, kind = F.col("kafka_offset"), F.col("kafka_offset") % 5
    text = (
        F.when(kind == 0, F.concat(F.lit("Offset "), W.thousands(offset), F.lit(".")))
        .when(kind == 1, F.concat(F.lit("50 of 100, or "), offset, F.lit(".0 in all")))
        .when(kind == 2, F.concat(offset, F.lit(" and "), offset * 10 + 7))
        .when(kind == 3, F.concat(offset, F.lit(".5")))
        .otherwise(F.concat(F.lit("service "), "service", F.lit(" is quiet")))
    )
    facts = F.array(offset.cast("double"), F.col("status_code").cast("double"))
    return logs(spark, d).select("event_id", W.is_grounded(text, facts, F.col("service")).alias("grounded"))


@CASES.add("chosen_texts", "I12", over_silver(f"""
SELECT service AS scope_key,
       CASE WHEN log_lines % 4 = 0 THEN service || ' wrote ' || {n('log_lines')} || ' lines' ELSE headline END AS headline,
       CASE WHEN log_lines % 4 = 0 THEN 'Look at 3 of them.' ELSE recommended_action END AS recommended_action,
       CASE WHEN log_lines % 4 = 0 THEN 'llm' ELSE 'rule' END AS generation_mode FROM written""", *_W))
def chosen_texts(spark, d):
    facts = _facts(weekday(spark, d))
    rules = I.service_insight(facts).select(
        F.col("service").alias("scope_key"), *I.TEXT_FIELDS, I.numbers_in(facts).alias("facts"))
    return I.choose_text(rules, _candidates(facts)).select("scope_key", "headline", "recommended_action", "generation_mode")


# ------------------------------------------------------------------ the table

_INSIGHTS = """
insights AS (
  SELECT 'estate:all' AS insight_id, 'estate' AS scope, 'all' AS scope_key, headline, narrative, recommended_action, severity,
         'vw_dash_service_overview,vw_dash_log_level,vw_dash_http_status,vw_dash_hourly_trend,vw_dash_topic' AS source_views, log_lines,
         'rule' AS generation_mode
  FROM estate_written
  UNION ALL
  SELECT 'service:' || service, 'service', service, CASE WHEN {good} THEN service || ' wrote ' || {lines} || ' lines' ELSE headline END,
         CASE WHEN {good} THEN 'There are ' || (SELECT f.error_count FROM facts f WHERE f.service = written.service)
                || ' errors.' ELSE narrative END,
         CASE WHEN {good} THEN 'Look at 3 of them.' ELSE recommended_action END, severity,
         'vw_dash_service_overview,vw_dash_service_latency', log_lines, CASE WHEN {good} THEN 'llm' ELSE 'rule' END FROM written
  UNION ALL
  SELECT 'model:' || model_name, 'model', model_name, model_name || ': ' || replace(status, '_', ' '),
         'Predict ' || target || ' from ' || width || ' columns. ' || limitations,
         CASE status WHEN 'production_candidate' THEN 'Take its metrics from the run history.'
                     ELSE 'Do not present its metrics as a result.' END,
         CASE status WHEN 'production_candidate' THEN 'healthy' ELSE 'degraded' END, 'ml_model_cards', NULL, 'rule'
  FROM model_cards JOIN (VALUES {targets}) AS t(name, target, width) ON name = model_name)
""".format(good="log_lines % 4 = 0", lines=n("log_lines"), targets=", ".join(
    f"('{m}', '{label}', {len(f)})" for m, label, f in (
        ("anomaly", "is_anomaly", M._ANOMALY_FEATURES), ("health", "degrading", M._HEALTH_FEATURES),
        ("early_warning", "early_warning_target", M._WARNING_FEATURES))))
_INSIGHT_CTES = (OVERVIEW, LATENCY, _FACTS, _TEXTS, LEVELS, HOURLY_TREND, _ESTATE, _ESTATE_TEXT, *M.CARD_CTES, _INSIGHTS)


# What views, cards and early warning read of Silver.
_READ = ["service", "log_level", "event_timestamp", "event_date", "event_hour", "day_of_week", "status_code", "response_time",
         "response_category", "severity_score", "is_anomaly", "instance_id", "http_method", "log_file", "kafka_topic"]


def insight_table(spark, d):
    """The insight table from one stored projection of Silver; the facts it words are stored as well."""
    events = cut_lineage(silver(spark, d).select(*_READ))
    views = page_views(spark, d, events)
    views["vw_dash_service_overview"] = cut_lineage(views["vw_dash_service_overview"])
    services = cut_lineage(I.service_facts(views["vw_dash_service_overview"], views["vw_dash_service_latency"]))
    estate = cut_lineage(_estate(views))
    return I.build_insights(services, estate, _candidates(services), cut_lineage(M.cards(spark, d, events)))


@CASES.add("insights", "I13", over_silver(
    "SELECT *, log_lines AS evidence_lines, 'none' AS model_endpoint FROM insights".replace(
        "*,", "* EXCLUDE (log_lines),"), *_INSIGHT_CTES))
def insights(spark, d):
    lines = F.coalesce(F.get_json_object("evidence", "$.log_lines"), F.get_json_object("evidence", "$.total_log_lines"))
    return insight_table(spark, d).withColumn("evidence_lines", lines.cast("bigint")).drop("evidence", "generated_at")


@CASES.add("verify_insights", "I14", over_silver("""
SELECT count(*) AS row_count, count(DISTINCT insight_id) AS distinct_ids, CAST(0 AS BIGINT) AS bad_rows,
       count(*) FILTER (generation_mode = 'llm') AS llm_rows, count(*) FILTER (generation_mode = 'rule') AS rule_rows
FROM insights""", *_INSIGHT_CTES))
def verify_insights(spark, d):
    return I.verify_insights(insight_table(spark, d))


@CASES.add("list_insights", "I15 X2", over_silver("""
SELECT scope, scope_key, severity, generation_mode, headline FROM insights
ORDER BY scope = 'model', scope = 'service', CASE severity WHEN 'critical' THEN 0 WHEN 'degraded' THEN 1 ELSE 2 END, scope_key""",
    *_INSIGHT_CTES))
def list_insights(spark, d):
    return I.list_insights(insight_table(spark, d))
