"""Names of lineage assets, merged lineage and risk-rated impact of changed tables.

Lineage stays in long form, (fqn, asset_kind, asset): no list grows with the number of readers of a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewarden.config import WatchConfig
from tablewarden.functions.labels import last_segment, notebook_label, risk_level
from tablewarden.operators.drift import change_summary
from tablewarden.operators.joins import spread_join
from tablewarden.operators.topk import latest_per_key
from tablewarden.sources.logs import audit_notebook_opens, workspace_paths
from tablewarden.sources.payloads import REJECTED


def latest_audit(audit: DataFrame) -> DataFrame:
    """Newest open event of every notebook id."""
    opens = audit_notebook_opens(audit).filter(F.col("notebook_id").isNotNull())
    order = [F.col("event_time").desc(), F.col("notebook_path").desc_nulls_last()]
    return latest_per_key(opens, ["notebook_id"], order, 1)


def resolve_notebooks(ids: DataFrame, audit: DataFrame, listing: DataFrame) -> DataFrame:
    """(entity_id, notebook_path, notebook_name): path from the audit log, else from the listing, else none."""
    from_audit = (
        latest_audit(audit)
        .filter(F.length("notebook_path") > 0)
        .select(F.col("notebook_id").alias("entity_id"), F.col("notebook_path").alias("audit_path"))
    )
    from_listing = workspace_paths(listing).select(
        F.col("object_id").alias("entity_id"), F.col("path").alias("listed_path")
    )
    path = F.coalesce("audit_path", "listed_path")
    return (
        ids.select("entity_id")
        .distinct()
        .join(from_audit, "entity_id", "left")
        .join(from_listing, "entity_id", "left")
        .select("entity_id", path.alias("notebook_path"), notebook_label(F.col("entity_id"), path).alias("notebook_name"))
    )


def unresolved_ids(ids: DataFrame, resolved: DataFrame) -> DataFrame:
    """Distinct ids without a path."""
    known = resolved.filter(F.col("notebook_path").isNotNull())
    return ids.select("entity_id").distinct().join(known, "entity_id", "left_anti")


def resolve_jobs(ids: DataFrame, jobs: DataFrame) -> DataFrame:
    """(entity_id, job_name), with a label for unknown ids."""
    names = jobs.select(F.col("job_id").cast("string").alias("entity_id"), "name")
    label = F.coalesce("name", F.concat(F.lit("Job #"), F.col("entity_id")))
    return ids.select("entity_id").distinct().join(names, "entity_id", "left").select("entity_id", label.alias("job_name"))


def name_access(access: DataFrame, notebooks: DataFrame, jobs: DataFrame) -> DataFrame:
    """Access edges with display names instead of ids, as (fqn, asset_kind, asset)."""

    def named(kind: str, names: DataFrame, column: str) -> DataFrame:
        edges = access.filter(F.col("entity_type") == kind).select("fqn", "entity_id")
        # One notebook may read a large share of all tables.
        found = spread_join(edges, names, ["entity_id"], ["fqn"], "inner")
        return found.select("fqn", F.lit(kind).alias("asset_kind"), F.col(column).alias("asset"))

    return named("NOTEBOOK", notebooks, "notebook_name").unionByName(named("JOB", jobs, "job_name"))


def merge_lineage(payload: DataFrame, access: DataFrame) -> DataFrame:
    """Union of both lineage sources. Notebooks and jobs are distinct; all other kinds come from the payload, repeats included.

    Notebook paths are cut to the last segment first, so that a notebook known to both sources counts once. One aggregate over
    one reading of the payload: its documents are parsed once.
    """
    is_notebook = F.col("asset_kind") == "NOTEBOOK"
    asset = F.when(is_notebook, last_segment(F.col("asset"))).otherwise(F.col("asset"))
    listed = payload.select("fqn", "asset_kind", asset.alias("asset"))
    counted = listed.unionByName(access).groupBy("fqn", "asset_kind", "asset").agg(F.count(F.lit(1)).alias("_n"))
    times = F.when(F.col("asset_kind").isin("NOTEBOOK", "JOB"), F.lit(1).cast("bigint")).otherwise(F.col("_n"))
    return counted.select("fqn", "asset_kind", "asset", F.explode(F.sequence(F.lit(1).cast("bigint"), times))).drop("col")


def lineage_counts(lineage: DataFrame) -> DataFrame:
    """Number of assets of every kind per table."""
    kinds = {"n_downstream": "DOWNSTREAM", "n_upstream": "UPSTREAM", "n_notebooks": "NOTEBOOK", "n_jobs": "JOB", "n_rejected": REJECTED}
    return lineage.groupBy("fqn").agg(
        *[F.count_if(F.col("asset_kind") == kind).alias(name) for name, kind in kinds.items()]
    )


def rated_impact(summary: DataFrame, lineage: DataFrame) -> DataFrame:
    """A change summary with its asset counts and risk level. Where documents were rejected, the counts and the risk are lower bounds."""
    joined = summary.join(lineage_counts(lineage), "fqn", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_downstream", "n_upstream", "n_notebooks", "n_jobs", "n_rejected")]
    rated = joined.select("fqn", "change_summary", "n_changes", "breaking", *counts)
    return rated.withColumn("risk", risk_level(F.col("breaking"), F.col("n_downstream")))


def impact(changes: DataFrame, lineage: DataFrame) -> DataFrame:
    """One row per changed table: its change kinds, asset counts and risk level. Both sides are aggregated first."""
    return rated_impact(change_summary(changes), lineage)


def affected_assets(lineage: DataFrame) -> DataFrame:
    """One row: downstream tables, notebooks and jobs summed over all tables, repeats included."""
    return lineage.agg(F.count_if(F.col("asset_kind").isin("DOWNSTREAM", "NOTEBOOK", "JOB")).alias("affected_assets"))


def affected_distinct(lineage: DataFrame) -> DataFrame:
    """One row: distinct notebooks and jobs over all tables."""
    assets = lineage.filter(F.col("asset_kind").isin("NOTEBOOK", "JOB")).select("asset_kind", "asset").distinct()
    return assets.agg(
        F.count_if(F.col("asset_kind") == "NOTEBOOK").alias("notebooks"),
        F.count_if(F.col("asset_kind") == "JOB").alias("jobs"),
    )


def rejected_assets(lineage: DataFrame) -> DataFrame:
    """One row: documents of changed tables that could not be read."""
    return lineage.agg(F.count_if(F.col("asset_kind") == REJECTED).alias("rejected_documents"))
