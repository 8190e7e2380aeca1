"""Questions asked of the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmill.plans.audit import current_state, monitor, watermark_drift
from starmill.registry.context import table
from starmill.registry.runs import run_log


def _on_log(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(run_log(table(spark, sf_dir, "events")))
    return run


QUERIES = {
    "audit_current_state": _on_log(current_state),
    "audit_monitor": _on_log(monitor),
    "audit_watermark_drift": _on_log(watermark_drift),
}

_LOG = """
    WITH runs AS (
        SELECT event_type AS process, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id,
               min(ts) AS started_at, max(ts) AS finished, count(*) AS n,
               event_type = 'error'
                   AND CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events) AS unfinished
        FROM events GROUP BY event_type, CAST(ts AS DATE)),
    log AS (
        SELECT process, batch_id, CASE WHEN unfinished THEN 'EN PROCESO' ELSE 'OK' END AS state,
               started_at, CASE WHEN NOT unfinished THEN finished END AS ended_at,
               CASE WHEN NOT unfinished THEN n END AS rows_affected,
               CAST(NULL AS VARCHAR) AS message
        FROM runs),
    state AS (
        SELECT l.*, (SELECT max(ended_at) FROM log o WHERE o.process = l.process) AS watermark
        FROM log l QUALIFY row_number() OVER (PARTITION BY process ORDER BY started_at DESC) = 1)"""

ORACLE = {
    "audit_current_state": _LOG + " SELECT * FROM state",
    "audit_monitor": _LOG + """
        SELECT process, state, started_at, ended_at,
               date_diff('second', started_at, ended_at) AS seconds, watermark, rows_affected, message
        FROM state""",
    "audit_watermark_drift": _LOG + """
        SELECT process, watermark,
               date_diff('second', watermark, (SELECT max(watermark) FROM state)) AS seconds_behind
        FROM state""",
}
