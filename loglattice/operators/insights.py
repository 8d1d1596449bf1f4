"""Written insights: facts as columns, sentences as column expressions over them, and candidate
texts from elsewhere that replace a sentence only when every number in them is in the facts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from loglattice import constants as C
from loglattice.functions import scalars as S, text as W
from loglattice.ml.runs import CARD_SEVERITY
from loglattice.operators import serving as K
from loglattice.operators.joins import attach_latency
from loglattice.operators.shares import share_of_total
from loglattice.schemas import INSIGHT

# values the insight table's readers filter on (fixed values)
TEXT_MODEL, RULE = "llm", "rule"
SEVERITIES = ["healthy", "degraded", "critical"]
SEVERITY_OF_STATUS = {
    "Critical": "critical", "Degraded": "degraded", "Degrading": "degraded", "Healthy": "healthy", "Low volume": "healthy",
}
TEXT_FIELDS = ["headline", "narrative", "recommended_action"]
EXPLANATION_FIELDS = ["headline", "what_happened", "why_did_this_happen", "impact", "what_to_check_next"]

OVERVIEW_VIEWS = "vw_dash_service_overview,vw_dash_service_latency"
ESTATE_VIEWS = "vw_dash_service_overview,vw_dash_log_level,vw_dash_http_status,vw_dash_hourly_trend,vw_dash_topic"


# ------------------------------------------------------------------ facts


def service_facts(overview: DataFrame, latency: DataFrame) -> DataFrame:
    """One row of facts per service, with its share of all lines and whether it is scored."""
    joined = attach_latency(overview, latency)
    lines = F.col("log_lines")
    shared = share_of_total(joined, "log_lines", "share_of_estate_pct", 4)
    return shared.select(
        "service", "log_lines", "http_requests", "latency_samples", "error_count", "warning_count", "critical_count",
        "anomaly_count",
        F.col("error_rate").alias("error_rate_pct"),
        F.col("warning_rate").alias("warning_rate_pct"),
        F.round(S.percent(F.col("critical_count"), lines), 2).alias("critical_rate_pct"),
        F.col("anomaly_rate").alias("anomaly_rate_pct"),
        "risk_score", "health_status",
        K.is_scored(lines).alias("is_scored"),
        "latency_coverage", "p50_response_time", "p95_response_time", "avg_response_time", "share_of_estate_pct",
    )


def estate_facts(
    overview: DataFrame, latency: DataFrame, levels: DataFrame, http_status: DataFrame, trend: DataFrame, topics: DataFrame
) -> DataFrame:
    """One row of facts over all services; level totals come from the level view where it has the level."""
    kpis = K.estate_kpis(overview, levels, http_status, topics)
    level = F.col("log_level_counts")

    def total(name: str, fallback: str) -> Column:
        return F.coalesce(F.try_element_at(level, F.lit(name)), F.col(fallback))

    disagreeing = K.severity_disagreement(overview, levels).agg(F.count(F.lit(1)).alias("n")).scalar()
    return kpis.select(
        "total_log_lines", "total_http_requests", "services_total", "services_scored", "services_below_volume_floor",
        latency.agg(F.count(F.lit(1)).alias("n")).scalar().alias("services_with_measured_latency"),
        total("ERROR", "total_errors").alias("total_errors"),
        total("WARNING", "total_warnings").alias("total_warnings"),
        total("CRITICAL", "total_criticals").alias("total_criticals"),
        disagreeing.alias("levels_in_disagreement"),
        F.col("total_anomalies").alias("total_anomaly_labels"),
        "highest_risk_service", "highest_risk_score", "highest_risk_health_status", "log_level_counts",
        F.col("http_status_counts").alias("http_status_class_counts"),
        trend.agg(F.count(F.lit(1)).alias("n")).scalar().alias("hours_observed"),
        K.peak_hour(trend).select(F.struct(F.col("event_hour_ts").cast("string").alias("hour"), "log_lines")).scalar()
        .alias("peak_hour"),
        "kafka_topics",
    )


def severity_of(status: Column) -> Column:
    out = F
    for name, severity in SEVERITY_OF_STATUS.items():
        out = out.when(status == name, F.lit(severity))
    return out.otherwise(F.lit("healthy"))


# ------------------------------------------------------------------ sentences


def _sentence(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _n(column: str) -> Column:
    return W.thousands(F.col(column))


def latency_text() -> Column:
    p50, p95 = F.col("p50_response_time"), F.col("p95_response_time")
    spread = p95 / F.nullif(p50, F.lit(0.0))
    tail = F.when(
        spread >= 2,
        _sentence(" The slow tail takes ", F.format_string("%.1f", F.round(spread, 1)), " times as long as the median."),
    ).otherwise(F.lit(""))
    return (
        F.when(
            F.coalesce(F.col("latency_samples"), F.lit(0)) == 0,
            _sentence("Its response time is not measured, because none of its ", _n("log_lines"),
                      " lines completes a request; that does not make it fast or idle."),
        )
        .when(
            p50.isNull() | p95.isNull(),
            _sentence("It timed ", _n("http_requests"), " requests, but there are no percentiles of them."),
        )
        .otherwise(
            _sentence("Over ", _n("latency_samples"), " timed requests the median is ", W.seconds(p50),
                      " and the 95th percentile ", W.seconds(p95), ".", tail)
        )
    )


def severity_text() -> Column:
    def part(column: str, word: str) -> Column:
        return F.when(F.col(column) > 0, _sentence(_n(column), f" {word}"))

    parts = F.array_compact(
        F.array(part("critical_count", "critical"), part("error_count", "error"), part("warning_count", "warning"))
    )
    return (
        F.when(
            F.col("error_rate_pct") >= 50,
            _sentence(_n("error_count"), " of its ", _n("log_lines"), " lines are errors, as in a logger that exists to"
                      " report failures: read the count as failures seen, not as the share of its work that fails."),
        )
        .when(F.size(parts) == 0, _sentence("None of its ", _n("log_lines"), " lines is above INFO."))
        .otherwise(
            _sentence("Of its ", _n("log_lines"), " lines it logged ", W.listed(parts), ", an error rate of ",
                      W.short(F.col("error_rate_pct")), "% and a warning rate of ", W.short(F.col("warning_rate_pct")), "%.")
        )
    )


def anomaly_text() -> Column:
    return F.when(
        F.col("anomaly_count") > 0,
        _sentence(" ", W.counted(F.col("anomaly_count"), "line"), " from labelled instances; a label is known, not predicted."),
    ).otherwise(F.lit(""))


def service_insight(facts: DataFrame) -> DataFrame:
    """Headline, narrative and action of each service."""
    scored = F.col("is_scored")
    volume = _sentence(F.col("service"), " wrote ", _n("log_lines"), " lines, ", W.share(F.col("share_of_estate_pct")),
                       " of all.")
    below = _sentence(
        volume, f" That is under the {C.SCORING_FLOOR_LINES} lines needed for a score, where a single error already shifts"
        " the rates, so it is left out of the ranking. ", latency_text())
    ranked = _sentence(
        volume, " ", severity_text(), anomaly_text(), " ", latency_text(), " Its risk score is ",
        W.short(F.col("risk_score")), ", in the ", F.lower("health_status"), " band.")
    action = (
        F.when(~scored, F.lit("Keep it out of alerts until it writes enough lines to be scored."))
        .when(F.col("error_rate_pct") >= 50, F.lit("Follow its errors back to the services that raised them."))
        .when(F.col("critical_count") > 0,
              _sentence("Read its ", W.counted(F.col("critical_count"), "critical line"), " one by one."))
        .when(F.col("warning_rate_pct") >= 5, F.lit("Sample its warnings before alerting: many are often one condition."))
        .when(F.col("latency_samples") == 0, F.lit("Nothing to do on latency unless it starts to log completed requests."))
        .otherwise(F.lit("Nothing to do; keep it as a baseline."))
    )
    headline = F.when(
        scored, _sentence(F.col("service"), ": ", F.col("health_status"), " at risk ", W.short(F.col("risk_score")))
    ).otherwise(_sentence(F.col("service"), ": ", W.counted(F.col("log_lines"), "line"), ", too few to score"))
    return facts.withColumns(
        {
            "headline": headline,
            "narrative": F.when(scored, ranked).otherwise(below),
            "recommended_action": action,
            "severity": severity_of(F.col("health_status")),
        }
    )


def estate_insight(facts: DataFrame) -> DataFrame:
    """Headline, narrative and action over all services."""
    total = F.col("total_log_lines")
    info = F.coalesce(F.try_element_at(F.col("log_level_counts"), F.lit("INFO")), F.lit(0))
    info_share = F.round(S.percent(info, F.nullif(total, F.lit(0))), 1)
    below = F.col("services_below_volume_floor")
    floor = F.when(
        below > 0, _sentence(" ", W.counted(below, "service"), " wrote too few lines to be ranked.")
    ).otherwise(F.lit(""))
    labels = F.when(
        F.col("total_anomaly_labels") > 0,
        _sentence(" ", W.counted(F.col("total_anomaly_labels"), "line"), " from labelled instances."),
    ).otherwise(F.lit(" No line comes from a labelled instance; check the label list."))
    narrative = _sentence(
        _n("services_total"), " services wrote ", W.thousands(total), " lines, ", _n("total_http_requests"),
        " of them requests. ", W.short(info_share, 1), "% are INFO; the rest holds ",
        W.counted(F.col("total_warnings"), "warning"), ", ", W.counted(F.col("total_errors"), "error"), " and ",
        W.counted(F.col("total_criticals"), "critical line"), ". The highest risk score is ",
        W.short(F.col("highest_risk_score")), " at ", F.col("highest_risk_service"), ".", floor, labels,
        " Latency is measured for ", _n("services_with_measured_latency"), " of ", _n("services_total"), " services only.")
    severity = (
        F.when(F.col("total_criticals") > 0, F.lit("critical"))
        .when(F.col("total_errors") > 0, F.lit("degraded"))
        .otherwise(F.lit("healthy"))
    )
    return facts.withColumns(
        {
            "headline": _sentence(W.thousands(total), " lines from ", W.counted(F.col("services_total"), "service"),
                                  ", most at risk: ", F.col("highest_risk_service")),
            "narrative": narrative,
            "recommended_action": _sentence(
                "Begin with ", F.col("highest_risk_service"),
                ", and read services without a score or a latency as unmeasured, not as well."),
            "severity": severity,
        }
    )


def explain(facts: DataFrame, kind: str = "service_health") -> DataFrame:
    """A four-part explanation with three next steps for each row.

    ``service_health`` takes service facts, ``anomaly`` takes anomaly patterns, and any other kind
    takes estate facts.
    """
    if kind == "service_health":
        service, band = F.col("service"), F.col("health_status")
        lines, errors, warnings = _n("log_lines"), W.counted(F.col("error_count"), "error"), W.counted(
            F.col("warning_count"), "warning")
        error_rate, warning_rate = W.short(F.col("error_rate_pct")), W.short(F.col("warning_rate_pct"))
        risk = F.format_string("%.2f", "risk_score")
        small = ~F.col("is_scored")

        def by_band(low: Column | str, critical: Column | str, degraded: Column | str, healthy: Column | str) -> Column:
            low, critical, degraded, healthy = (
                F.lit(x) if isinstance(x, str) else x for x in (low, critical, degraded, healthy))
            return (F.when(small, low).when(band == "Critical", critical).when(band == "Degraded", degraded)
                    .otherwise(healthy))

        parts = {
            "headline": by_band(
                _sentence(service, ": too few lines to score"), _sentence(service, ": errors put it in the critical band"),
                _sentence(service, ": errors put it in the degraded band"), _sentence(service, ": healthy")),
            "what_happened": by_band(
                _sentence("It wrote ", lines, " lines with ", errors, "."),
                _sentence("It logged ", errors, " (", error_rate, "%) and ", warnings, " (", warning_rate, "%)."),
                _sentence("It logged ", errors, " (", error_rate, "%) and ", warnings, " (", warning_rate, "%)."),
                _sentence("Its error rate is ", error_rate, "% over ", lines, " lines.")),
            "why_did_this_happen": by_band(
                _sentence("Below 100 lines a rate such as ", error_rate, "% says more about the sample than the service."),
                _sentence("Errors make up 5% or more of its ", lines, " lines, for a risk score of ", risk, "."),
                _sentence("Errors make up 1% to 5% of its ", lines, " lines, for a risk score of ", risk, "."),
                _sentence("Errors stay under 1%, with ", warnings, " and ", W.counted(F.col("anomaly_count"), "labelled line"),
                          ", for a risk score of ", risk, ".")),
            "impact": by_band(
                "Little, given the volume; single failures can still matter.",
                "High: what depends on it may fail with it.",
                "Moderate: it works, but a condition keeps coming back.",
                "None to be seen in its logs."),
        }
        steps = [
            by_band("Read its failure lines directly", "Trace its errors to what raised them",
                    "Sample its errors and warnings for one repeated cause", "Keep watching its risk score"),
            by_band("Leave it out of the ranking for now", "Read the critical lines first",
                    "Check the resources it depends on",
                    F.when(F.col("latency_coverage") == "measured", F.lit("Compare its latency percentiles over time"))
                    .otherwise(F.lit("Note that its latency is not measured"))),
            by_band("Check that it is meant to be quiet", "Look for a timeout or schedule behind the failures",
                    "Set its alert above the normal level", "Look at labelled lines during maintenance"),
        ]
    elif kind == "anomaly":
        service, n = F.col("service"), F.col("anomaly_occurrences")
        status = F.coalesce(F.col("status_code").cast("string"), F.lit("none"))
        timed = F.when(F.col("avg_response_time").isNull(), F.lit(" Their response time is not measured.")).otherwise(
            _sentence(" Their mean response time is ", W.seconds(F.col("avg_response_time")), "."))
        parts = {
            "headline": _sentence(service, ": ", W.counted(n, "labelled line")),
            "what_happened": _sentence(W.counted(n, "line"), " of ", service, " from labelled instances."),
            "why_did_this_happen": _sentence(
                "They share level ", F.col("log_level"), ", category ", F.col("response_category"), " and status ", status,
                ".", timed),
            "impact": F.lit("The label marks the instance, so not every one of its lines is a fault."),
        }
        steps = [F.lit("Follow the instances through their states"), F.lit("Compare the times with the load of their hosts"),
                 F.lit("Look for other work at the same time")]
    else:
        parts = {
            "headline": F.lit("All services together"),
            "what_happened": _sentence(_n("services_total"), " services are in the tables."),
            "why_did_this_happen": _sentence("The figures cover ", _n("total_log_lines"), " lines and ",
                                             _n("total_http_requests"), " requests."),
            "impact": F.lit("Every chart reads the same tables, so they agree."),
        }
        steps = [F.lit("Watch for a shift between levels"), F.lit("Compare the risk ranking over time"),
                 F.lit("Check services without a latency")]
    return facts.withColumns({**parts, "what_to_check_next": F.array(*steps), "generation_mode": F.lit("rule_based")})


# ------------------------------------------------------------------ candidate texts


def parse_candidates(candidates: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Candidate texts as columns: a code fence is taken off, the rest read as JSON, and texts that
    are no JSON or lack a field are dropped."""
    fields = fields or TEXT_FIELDS
    schema = T.StructType([
        T.StructField(f, T.ArrayType(T.StringType()) if f == "what_to_check_next" else T.StringType()) for f in fields])
    bare = F.regexp_replace("raw_text", r"(?is)^\s*```(?:json)?\s*(.*?)\s*(?:```.*)?$", "$1")
    parsed = candidates.select("scope_key", F.from_json(bare, schema).alias("c")).select("scope_key", "c.*")
    complete = F.lit(True)
    for f in fields:
        value = F.size(f) > 0 if f == "what_to_check_next" else F.trim(f) != ""
        complete = complete & F.coalesce(value, F.lit(False))
    trimmed = [F.col(f) if f == "what_to_check_next" else F.trim(f).alias(f) for f in fields]
    return parsed.where(complete).select("scope_key", *trimmed)


def numbers_in(facts: DataFrame) -> Column:
    """All numeric facts of a row, those inside maps and structs included, as an array of doubles."""
    arrays = []
    for field in facts.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.NumericType):
            arrays.append(F.array(column.cast("double")))
        elif isinstance(field.dataType, T.MapType) and isinstance(field.dataType.valueType, T.NumericType):
            arrays.append(F.coalesce(F.transform(F.map_values(column), lambda v: v.cast("double")), F.array().cast("array<double>")))
        elif isinstance(field.dataType, T.StructType):
            inner = [c.name for c in field.dataType.fields if isinstance(c.dataType, T.NumericType)]
            arrays += [F.array(column[c].cast("double")) for c in inner]
    return F.concat(*arrays)


def choose_text(
    rules: DataFrame, candidates: DataFrame, endpoint: str = "none", key: str = "scope_key", compat: bool = False
) -> DataFrame:
    """Replace the rule text of a row by a complete candidate whose numbers are all among ``facts``.

    ``rules`` holds the text fields, the key and an array ``facts``. Of several valid candidates for
    one key the first in text order is used, so candidates cannot multiply rows.
    """
    parsed = parse_candidates(candidates).withColumnsRenamed({f: f"_{f}" for f in TEXT_FIELDS})
    offered = rules.select(key, "facts").join(parsed, key)
    joined = F.concat_ws(" ", *[f"_{f}" for f in TEXT_FIELDS])
    grounded = offered.where(W.is_grounded(joined, F.col("facts"), None if compat else F.col(key)))
    best = grounded.groupBy(key).agg(F.min(F.struct(*[f"_{f}" for f in TEXT_FIELDS])).alias("_best"))
    merged = rules.join(best, key, "left")
    has_best = F.col("_best").isNotNull()
    chosen = {f: F.coalesce(F.col(f"_best._{f}"), F.col(f)) for f in TEXT_FIELDS}
    chosen["generation_mode"] = F.when(has_best, F.lit(TEXT_MODEL)).otherwise(F.lit(RULE))
    chosen["model_endpoint"] = F.lit(endpoint)
    return merged.withColumns(chosen).drop("_best")


# ------------------------------------------------------------------ the insight table


def _rule_rows(written: DataFrame, facts: DataFrame, scope: str, key: Column, views: str) -> DataFrame:
    return written.select(
        F.lit(scope).alias("scope"),
        key.alias("scope_key"),
        *TEXT_FIELDS,
        "severity",
        F.to_json(F.struct(*facts.columns)).alias("evidence"),
        F.lit(views).alias("source_views"),
        numbers_in(facts).alias("facts"),
    )


def build_insights(
    services: DataFrame,
    estate: DataFrame,
    candidates: DataFrame | None = None,
    cards: DataFrame | None = None,
    endpoint: str = "none",
    generated_at: datetime | None = None,
) -> DataFrame:
    """The insight table: one row for the estate, one per service and one per model card."""
    rules = _rule_rows(estate_insight(estate), estate, "estate", F.lit("all"), ESTATE_VIEWS).unionByName(
        _rule_rows(service_insight(services), services, "service", F.col("service"), OVERVIEW_VIEWS))
    if candidates is None:
        chosen = rules.withColumns({"generation_mode": F.lit(RULE), "model_endpoint": F.lit(endpoint)})
    else:
        chosen = choose_text(rules, candidates, endpoint)
    rows = chosen.drop("facts")
    if cards is not None:
        rows = rows.unionByName(model_insights(cards))
    stamped = rows.withColumns(
        {
            "insight_id": F.concat_ws(":", "scope", "scope_key"),
            "generated_at": F.lit(generated_at).cast("timestamp") if generated_at else F.current_timestamp(),
        }
    )
    return stamped.select(*INSIGHT.names)


def model_insights(cards: DataFrame) -> DataFrame:
    """Model cards as insight rows, without id and time."""
    status = F.col("status")
    severity = F
    for name, value in CARD_SEVERITY.items():
        severity = severity.when(status == name, F.lit(value))
    action = F.when(status == "production_candidate", F.lit("Take its metrics from the run history.")).otherwise(
        F.lit("Do not present its metrics as a result."))
    return cards.select(
        F.lit("model").alias("scope"),
        F.col("model_name").alias("scope_key"),
        _sentence(F.col("model_name"), ": ", F.replace(status, F.lit("_"), F.lit(" "))).alias("headline"),
        F.concat_ws(" ", "objective", "limitations").alias("narrative"),
        action.alias("recommended_action"),
        severity.otherwise(F.lit("degraded")).alias("severity"),
        F.to_json(F.struct("notebook", "algorithm", "status", "metrics_json")).alias("evidence"),
        F.lit("ml_model_cards").alias("source_views"),
        F.lit(RULE).alias("generation_mode"),
        F.lit("none").alias("model_endpoint"),
    )


def verify_insights(insights: DataFrame) -> DataFrame:
    """Row and id counts, rows with a blank text, an unknown severity or evidence that is no JSON."""
    def blank(column: str) -> Column:
        return F.count_if(F.col(column).isNull() | (F.col(column) == ""))

    unknown = ~F.coalesce(F.col("severity").isin(*SEVERITIES), F.lit(False))
    bad = blank("headline") + blank("narrative") + blank("recommended_action") + F.count_if(unknown) + F.count_if(
        F.get_json_object("evidence", "$").isNull())
    return insights.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("insight_id").alias("distinct_ids"),
        bad.alias("bad_rows"),
        F.count_if(F.col("generation_mode") == TEXT_MODEL).alias("llm_rows"),
        F.count_if(F.col("generation_mode") == RULE).alias("rule_rows"),
    )


def list_insights(insights: DataFrame) -> DataFrame:
    """Estate, then services, then models; critical first."""
    scope = F.when(F.col("scope") == "estate", 0).when(F.col("scope") == "service", 1).otherwise(2)
    severity = F.when(F.col("severity") == "critical", 0).when(F.col("severity") == "degraded", 1).otherwise(2)
    return insights.select("scope", "scope_key", "severity", "generation_mode", "headline").orderBy(
        scope, severity, "scope_key")
