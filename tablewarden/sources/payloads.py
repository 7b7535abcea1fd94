"""Landed JSON responses, one document per row in the string column ``payload``.

Every schema is explicit. A document that cannot be read gives no rows but a reason, so that what was lost can be counted
and shown: every landed document is either accepted or rejected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablewarden.schemas import JOBS_PAGE, LINEAGE_PAGE, RUNS_PAGE

_BROKEN = "_broken"
REJECTED = "REJECTED"
# The page schema of a landed source and the column that says whose answer a page is.
SOURCES = {"jobs": (JOBS_PAGE, None), "runs": (RUNS_PAGE, "job_id"), "lineage": (LINEAGE_PAGE, "table_name")}


def checked_pages(raw: DataFrame, source: str) -> DataFrame:
    """``raw`` with ``page``, the parsed document, and ``reason``, why it is rejected: null for an accepted one.

    One parse. A document with a field of another type than stated is rejected as a whole, and one without its key too.
    """
    schema, key = SOURCES[source]
    spelled = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    page = F.from_json("payload", spelled, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    is_json = F.try_parse_json("payload").isNotNull()
    reason = F.when(F.col("payload").isNull(), "no document").when(F.trim("payload") == "", "empty document")
    reason = reason.when(F.col("page").isNull() | F.col(f"page.{_BROKEN}").isNotNull(), F.when(is_json, "unexpected shape").otherwise("not JSON"))
    if key is not None:
        reason = F.when(F.col(key).isNull(), "no key").otherwise(reason)
    return raw.withColumn("page", page).withColumn("reason", reason)


def _taken(items: Column) -> Column:
    """The items of an accepted page, none of a rejected one. A filter on the reason would be pushed below the parse and repeat it."""
    return F.when(F.col("reason").isNull(), items)


def rejected_documents(raw: DataFrame, source: str) -> DataFrame:
    """(source, file, key, reason, n_chars) of every document that is not accepted; ``file`` where ``raw`` names it."""
    key = SOURCES[source][1]
    lost = checked_pages(raw, source).filter(F.col("reason").isNotNull())
    return lost.select(
        F.lit(source).alias("source"),
        (F.col("file") if "file" in raw.columns else F.lit(None)).cast("string").alias("file"),
        (F.lit(None) if key is None else F.col(key)).cast("string").alias("key"),
        "reason",
        F.coalesce(F.length("payload"), F.lit(0)).cast("bigint").alias("n_chars"),
    )


def landing_totals(raw: DataFrame, source: str) -> DataFrame:
    """One row: documents landed, accepted and rejected, and those rejected by reason; one pass."""
    reasons = {"no_document": "no document", "empty_document": "empty document", "not_json": "not JSON", "unexpected_shape": "unexpected shape", "no_key": "no key"}
    return checked_pages(raw, source).agg(
        F.lit(source).alias("source"),
        F.count(F.lit(1)).alias("landed"),
        F.count_if(F.col("reason").isNull()).alias("accepted"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        *[F.count_if(F.col("reason") == text).alias(name) for name, text in reasons.items()],
    )


def jobs_from_payload(raw: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Jobs of all pages but the excluded names; a nameless job is labelled by its id."""
    job = checked_pages(raw, "jobs").select(F.explode(_taken(F.col("page.jobs"))).alias("job"))
    name = F.col("job.settings.name")
    return job.filter(~F.coalesce(name, F.lit("")).isin(*excluded)).select(
        F.col("job.job_id").alias("job_id"),
        F.coalesce(name, F.concat(F.lit("Job #"), F.col("job.job_id").cast("string"))).alias("name"),
        F.coalesce("job.settings.schedule.quartz_cron_expression", F.lit("")).alias("schedule"),
    )


def runs_from_payload(raw: DataFrame) -> DataFrame:
    """Runs of all pages. The job id comes with the landed row, since a page is the answer for one job."""
    run = checked_pages(raw, "runs").select("job_id", F.explode(_taken(F.col("page.runs"))).alias("run"))
    return run.select(
        "job_id",
        F.col("run.run_id").alias("run_id"),
        F.coalesce("run.start_time", F.lit(0)).alias("start_time"),
        F.coalesce("run.end_time", F.lit(0)).alias("end_time"),
        F.col("run.state.result_state").alias("result_state"),
        F.col("run.state.state_message").alias("state_message"),
        F.coalesce("run.run_page_url", F.lit("")).alias("run_page_url"),
    )


def lineage_from_payload(raw: DataFrame, mark_rejected: bool = False) -> DataFrame:
    """All assets of every page, with their place among those of their kind, as (fqn, asset_kind, pos, asset).

    With ``mark_rejected`` a rejected document of a table is one row of kind REJECTED, whose asset is the reason: the table's
    lineage may then lack assets.
    """
    page = checked_pages(raw, "lineage")

    def entities(kind: str, field: str) -> Column:
        return F.filter("page.entity_lineage", lambda e: e["entity_type"] == kind)[field]

    def listed(kind: str, names: Column) -> Column:
        return F.struct(F.lit(kind).alias("asset_kind"), names.alias("names"))

    # Lists of names by kind, exploded twice: no list of all assets of a page is built.
    kinds = _taken(
        F.array(
            listed("DOWNSTREAM", F.col("page.downstreams.name")),
            listed("UPSTREAM", F.col("page.upstreams.name")),
            listed("NOTEBOOK", entities("NOTEBOOK", "path")),
            listed("JOB", entities("JOB", "name")),
        )
    )
    if mark_rejected:
        kinds = F.coalesce(kinds, F.array(listed(REJECTED, F.array("reason"))))
    found = page.select(F.col("table_name").alias("fqn"), F.explode(kinds).alias("found"))
    placed = found.select("fqn", "found.asset_kind", F.posexplode("found.names").alias("place", "name"))
    return placed.select("fqn", "asset_kind", (F.col("place") + 1).cast("bigint").alias("pos"), F.coalesce("name", F.lit("")).alias("asset"))
