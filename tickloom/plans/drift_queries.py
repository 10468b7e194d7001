"""Drift tests over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import drift, predictions
from tickloom.operators.features import feature_slices
from tickloom.plans.catalog import query
from tickloom.plans.fixtures import CALM, REALIZED, TIE, Tables, features_sql, latest_time, q6
from tickloom.schemas import MODEL_FEATURES
from tickloom.sources.scratch import settled

_NAMES = ", ".join(MODEL_FEATURES)

# Older half of each symbol's feature rows = reference, newer half = current; then one row per value.
_HALVES = CALM + "," + features_sql("calm", "event_id") + f""",
halves AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_ts, event_id)
                     <= count(*) OVER (PARTITION BY symbol) // 2 AS is_ref FROM feat),
ref AS (SELECT feature, value FROM (UNPIVOT (SELECT {_NAMES} FROM halves WHERE is_ref) ON {_NAMES} INTO NAME feature VALUE value)),
cur AS (SELECT feature, value FROM (UNPIVOT (SELECT {_NAMES} FROM halves WHERE NOT is_ref) ON {_NAMES} INTO NAME feature VALUE value))"""


def _psi_sql(by: str, keys: str = "") -> str:
    """CTE ``psi`` for tables ``ref(by, value)`` and ``cur(keys, by, value)``."""
    keyed = f"{keys}, {by}" if keys else by
    prefixed = ", ".join(f"c.{k.strip()}" for k in keyed.split(","))
    return f"""
span AS (SELECT {by}, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
                CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM ref GROUP BY {by}),
edges AS (SELECT {by}, i, lo + i * ((hi - lo) / 10) AS from_value, CASE WHEN i = 9 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 10) END AS to_value
          FROM span, range(10) AS r(i)),
ref_share AS (SELECT {by}, i, from_value, to_value, count(*) FILTER (value >= from_value AND (value < to_value OR i = 9 AND value = to_value))
              / count(*) AS share, count(*) AS n_ref FROM edges JOIN ref USING ({by}) GROUP BY ALL),
cur_share AS (SELECT {prefixed}, i, count(*) FILTER (value >= from_value AND (value < to_value OR i = 9 AND value = to_value))
              / count(*) AS share, count(*) AS n_cur FROM edges JOIN cur c USING ({by}) GROUP BY ALL),
psi AS (SELECT {prefixed}, max(n_ref) AS n_ref, max(n_cur) AS n_cur,
          sum((CASE WHEN c.share = 0 THEN 1e-10 ELSE c.share END - CASE WHEN r.share = 0 THEN 1e-10 ELSE r.share END)
              * ln(CASE WHEN c.share = 0 THEN 1e-10 ELSE c.share END / CASE WHEN r.share = 0 THEN 1e-10 ELSE r.share END)) AS psi
        FROM cur_share c JOIN ref_share r USING ({by}, i) GROUP BY {prefixed})"""


def _ks_sql(by: str, keys: str = "") -> str:
    """CTE ``ks`` for the same tables; the reference is copied to every key here."""
    keyed = f"{keys}, {by}" if keys else by
    groups = f"(SELECT DISTINCT {keyed} FROM cur)"
    shown = ", ".join(k.strip() for k in keyed.split(","))
    return f"""
marks AS (SELECT {shown}, value, 1 AS a, 0 AS b FROM {groups} g JOIN ref USING ({by})
          UNION ALL SELECT {shown}, value, 0, 1 FROM cur),
steps AS (SELECT {shown}, value, sum(a) AS a, sum(b) AS b FROM marks GROUP BY {shown}, value),
dist AS (SELECT {shown}, sum(a) OVER w / sum(a) OVER (PARTITION BY {shown}) AS fa, sum(b) OVER w / sum(b) OVER (PARTITION BY {shown}) AS fb,
           sum(a) OVER (PARTITION BY {shown}) AS na, sum(b) OVER (PARTITION BY {shown}) AS nb
         FROM steps WINDOW w AS (PARTITION BY {shown} ORDER BY value ROWS UNBOUNDED PRECEDING)),
ks_d AS (SELECT {shown}, max(abs(fa - fb)) AS ks_statistic, max(na) AS na, max(nb) AS nb FROM dist GROUP BY {shown}),
ks_x AS (SELECT *, ks_statistic * sqrt(na * nb / (na + nb)) AS x FROM ks_d),
ks AS (SELECT * EXCLUDE (x), CASE WHEN ks_statistic <= 0 THEN 1.0
          WHEN x < 0.6 THEN 1 - sqrt(2 * pi()) / x * list_sum(list_transform(range(1, 30), lambda k: exp(-1.0 * (2 * k - 1) * (2 * k - 1) * pi() * pi() / (8 * x * x))))
          ELSE greatest(0, least(1, list_sum(list_transform(range(1, 101), lambda j: CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j * j * x * x)))))
          END AS ks_p_value FROM ks_x)"""


def _halves(t: Tables) -> DataFrame:
    """Value counts of the older half (reference) and the newer half of each symbol's feature rows."""
    features = feature_slices(t.calm_events(), TIE, TIE)
    marked = drift.halves_in_time(features, ["symbol"], ["event_ts", *TIE])
    long = drift.to_long(marked, MODEL_FEATURES, ["is_reference"])
    counts = long.groupBy("feature", "value", F.col("is_reference").alias("is_ref")).agg(F.count(F.lit(1)).alias("n"))
    return settled(counts)


_FLAG = "(ks_p_value < 0.05 OR psi > 0.2)"


@query("psi_by_feature", f"WITH {_HALVES},{_psi_sql('feature')} SELECT feature, n_ref, n_cur, {q6('psi')} AS psi FROM psi")
def psi_by_feature(t: Tables) -> DataFrame:
    return drift.psi(_halves(t))


@query("ks_by_feature", f"WITH {_HALVES},{_ks_sql('feature')} SELECT feature, {q6('ks_statistic')} AS ks_statistic FROM ks")
def ks_by_feature(t: Tables) -> DataFrame:
    return drift.ks(_halves(t)).select("feature", "ks_statistic")


@query(
    "ks_pvalue",
    f"""WITH {_HALVES},{_ks_sql('feature')} SELECT feature, CAST(na AS BIGINT) AS n_ref, CAST(nb AS BIGINT) AS n_cur,
    {q6('ks_p_value')} AS ks_p_value FROM ks""",
)
def ks_pvalue(t: Tables) -> DataFrame:
    return drift.ks(_halves(t)).select("feature", "n_ref", "n_cur", "ks_p_value")


@query(
    "feature_drift",
    f"""WITH {_HALVES},{_psi_sql('feature')},{_ks_sql('feature')}
    SELECT feature, n_ref, n_cur, {q6('psi')} AS psi, {q6('ks_statistic')} AS ks_statistic, {q6('ks_p_value')} AS ks_p_value,
      {_FLAG} AS drifted FROM psi JOIN ks USING (feature)""",
)
def feature_drift(t: Tables) -> DataFrame:
    return drift.compare(_halves(t))


_ERRORS = REALIZED + """,
known AS (SELECT * FROM realized WHERE realized_return_error IS NOT NULL),
{source}
errors AS (SELECT symbol, realized_return_error AS value, count(*) OVER (PARTITION BY symbol) AS n,
             row_number() OVER (PARTITION BY symbol ORDER BY timestamp {order}, id {order}) <= count(*) OVER (PARTITION BY symbol) // 2 AS is_ref
           FROM {table}),
ref AS (SELECT symbol, value FROM errors WHERE is_ref AND n >= 4),
cur AS (SELECT symbol, value FROM errors WHERE NOT is_ref AND n >= 4)"""


def _errors_sql(order: str = "ASC") -> str:
    return _ERRORS.format(source="", order=order, table="known")


def _concept_sql(order: str) -> str:
    return f"""WITH {_errors_sql(order)},{_psi_sql('symbol')},{_ks_sql('symbol')}
    SELECT symbol, n_ref, n_cur, {q6('psi')} AS psi, {q6('ks_statistic')} AS ks_statistic, {q6('ks_p_value')} AS ks_p_value,
      {_FLAG} AS drifted FROM psi JOIN ks USING (symbol)"""


@query("concept_drift", _concept_sql("ASC"))
def concept_drift(t: Tables) -> DataFrame:
    return drift.concept_drift(t.realized())


@query("concept_drift_newest_first", _concept_sql("DESC"))
def concept_drift_newest_first(t: Tables) -> DataFrame:
    return drift.concept_drift(t.realized(), newest_is_reference=True)


# The report: all feature rows are the reference, the newest 500 predictions of a symbol the current side.
_RECENT = "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, id DESC) <= 500"
_REPORT = _ERRORS.format(
    source=f"recent AS (SELECT * FROM known {_RECENT}),", order="ASC", table="recent"
) .replace("ref AS (", "e_ref AS (").replace("cur AS (", "e_cur AS (")
_CONCEPT = (
    (_psi_sql("symbol") + "," + _ks_sql("symbol"))
    .replace("FROM ref", "FROM e_ref").replace("FROM cur", "FROM e_cur").replace("JOIN ref ", "JOIN e_ref ").replace("JOIN cur ", "JOIN e_cur ")
)
for _cte in ("span", "edges", "ref_share", "cur_share", "psi", "marks", "steps", "dist", "ks_d", "ks_x", "ks"):
    _CONCEPT = _CONCEPT.replace(f"\n{_cte} AS (", f"\ne_{_cte} AS (")
    for _word in ("FROM", "JOIN"):
        _CONCEPT = _CONCEPT.replace(f"{_word} {_cte} ", f"{_word} e_{_cte} ").replace(f"{_word} {_cte},", f"{_word} e_{_cte},").replace(
            f"{_word} {_cte})", f"{_word} e_{_cte})"
        )
_CHECKED = f"""{_REPORT},{_CONCEPT},
ref AS (SELECT feature, value FROM (UNPIVOT (SELECT {_NAMES} FROM feat) ON {_NAMES} INTO NAME feature VALUE value)),
cur AS (SELECT symbol, feature, value FROM (UNPIVOT (
  SELECT symbol, {_NAMES} FROM predictions WHERE price_return IS NOT NULL {_RECENT}) ON {_NAMES} INTO NAME feature VALUE value)),
{_psi_sql('feature', 'symbol')},{_ks_sql('feature', 'symbol')},
flags AS (SELECT symbol, bool_or({_FLAG}) AS feature_drift, count(*) FILTER ({_FLAG}) AS n_drifted
          FROM psi JOIN ks USING (symbol, feature) WHERE n_ref >= 2 AND n_cur >= 2 GROUP BY symbol),
c_flags AS (SELECT symbol, {_FLAG} AS concept_drift FROM e_psi JOIN e_ks USING (symbol) WHERE n_ref >= 2 AND n_cur >= 2),
clock AS (SELECT max(event_ts) AS now FROM calm),
state AS (SELECT symbol, now - to_minutes(CAST(10 * k AS INT)) AS last_trigger_time FROM clock, (
  SELECT symbol, row_number() OVER (ORDER BY symbol) AS k FROM (SELECT DISTINCT symbol FROM calm)) WHERE k > 1),
report AS (SELECT f.symbol, feature_drift, n_drifted, coalesce(concept_drift, false) AS concept_drift, now,
             last_trigger_time AS last_before, coalesce(now < last_trigger_time + INTERVAL 30 MINUTE, false) AS cooldown_active
           FROM flags f LEFT JOIN c_flags USING (symbol) LEFT JOIN state USING (symbol), clock),
fired AS (SELECT *, (feature_drift OR concept_drift) AND NOT cooldown_active AS triggered FROM report),
final AS (SELECT *, CASE WHEN triggered THEN now ELSE last_before END AS last_trigger_time FROM fired)"""


def _report(t: Tables) -> DataFrame:
    ticks = t.valid_ticks()
    scored = settled(t.scored(ticks))  # the reference and, but for rows without a prediction, the predictions
    made = t.predictions_from(scored)
    features = predictions.recent_feature_rows(made)
    paired = predictions.realize_fifo(made.drop("model_version", *MODEL_FEATURES), ticks, TIE, "event_id")
    errors = predictions.recent_return_errors(paired)
    return drift.drift_report(scored.select(*MODEL_FEATURES), features, errors, t.drift_state(), latest_time(t.market_events()))


@query(
    "drift_report",
    f"""WITH {_CHECKED} SELECT symbol, feature_drift, n_drifted, concept_drift, cooldown_active, triggered, last_trigger_time FROM final""",
)
def drift_report(t: Tables) -> DataFrame:
    return _report(t).drop("drifted_columns")


@query(
    "drifted_columns",
    f"""WITH {_CHECKED} SELECT symbol, feature, {q6('psi')} AS psi, {q6('ks_statistic')} AS ks_statistic, {q6('ks_p_value')} AS ks_p_value
    FROM psi JOIN ks USING (symbol, feature) WHERE {_FLAG} AND n_ref >= 2 AND n_cur >= 2""",
)
def drifted_columns(t: Tables) -> DataFrame:
    """The features that the report names, one row for each symbol and feature."""
    named = _report(t).select("symbol", F.explode("drifted_columns").alias("c"))
    return named.select("symbol", "c.feature", "c.psi", "c.ks_statistic", "c.ks_p_value")


@query("drift_cooldown", f"WITH {_CHECKED} SELECT symbol, cooldown_active, triggered FROM final")
def drift_cooldown(t: Tables) -> DataFrame:
    return _report(t).select("symbol", "cooldown_active", "triggered")


@query(
    "drift_state_upsert",
    f"""WITH {_CHECKED} SELECT coalesce(f.symbol, s.symbol) AS symbol, coalesce(f.now, s.last_trigger_time) AS last_trigger_time
    FROM state s FULL JOIN (SELECT symbol, now FROM final WHERE triggered) f USING (symbol)""",
)
def drift_state_upsert(t: Tables) -> DataFrame:
    return drift.upsert_state(t.drift_state(), _report(t).where(F.col("triggered")))


@query("drift_retrain", f"WITH {_CHECKED} SELECT coalesce(bool_or(triggered), false) AS retrain FROM final")
def drift_retrain(t: Tables) -> DataFrame:
    return drift.any_triggered(_report(t))
