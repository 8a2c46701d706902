"""Moves in the registry: new versions, aliases, promotion and rollback."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import registry
from tidewatch.sources.tables import Workspace


def champion(spark: SparkSession, ws: Workspace, model: str, alias: str = "champion") -> Row | None:
    """(version, run_id) the alias points to, read once; None if it is not set."""
    here = (
        registry.current_aliases(ws.alias_events(spark).where(F.col("model_name") == model))
        .where(F.col("alias") == alias)
        .join(ws.versions(spark), ["model_name", "version"], "left")
        .select("version", "run_id")
    )
    return here.first()


def resolve(spark: SparkSession, ws: Workspace, uri: str) -> Row:
    """Resolve a model URI to an exact version, or raise."""
    uris = spark.createDataFrame([(uri,)], "uri string")
    row = registry.resolve_uris(uris, ws.alias_events(spark), ws.versions(spark)).first()
    if row["resolved_uri"] is None:
        raise registry.UnknownModel(f"nothing is registered as {uri}")
    return row


def register_version(
    spark: SparkSession, ws: Workspace, model: str, run_id: str | None, tags: dict[str, str], at: datetime
) -> int:
    """Append the next version of a model; returns its number."""
    newest = ws.versions(spark).where(F.col("model_name") == model).agg(F.max("version")).first()[0]
    version = (newest or 0) + 1
    row = [(model, version, run_id, "READY", at)]
    ws.append(spark.createDataFrame(row, registry.VERSION_SCHEMA), "model_versions")
    set_tags(spark, ws, model, version, tags, at)
    return version


def set_tags(
    spark: SparkSession, ws: Workspace, model: str, version: int, tags: dict[str, str], at: datetime
) -> None:
    rows = [(model, version, key, str(value), at) for key, value in sorted(tags.items())]
    if rows:
        ws.append(spark.createDataFrame(rows, registry.TAG_SCHEMA), "version_tags")


def move_alias(
    spark: SparkSession, ws: Workspace, model: str, alias: str, version: int, at: datetime
) -> None:
    ws.append(spark.createDataFrame([(model, alias, version, at)], registry.ALIAS_SCHEMA), "alias_events")


def promote_by_hand(
    spark: SparkSession, ws: Workspace, model: str, version: int, at: datetime, alias: str = "champion"
) -> None:
    """Move the champion alias without the gate, and say so in the version's tags."""
    known = ws.versions(spark).where((F.col("model_name") == model) & (F.col("version") == version))
    if known.isEmpty():
        raise registry.UnknownModel(f"{model} has no version {version}")
    move_alias(spark, ws, model, alias, version, at)
    tags = {registry.TAG_DECISION: registry.PROMOTED, registry.TAG_REASON: "promoted manually"}
    set_tags(spark, ws, model, version, tags, at)


def roll_back(
    spark: SparkSession, ws: Workspace, model: str, at: datetime, alias: str = "champion"
) -> int:
    """Point the alias at the previously promoted version; raises if there is none."""

    def of_model(df):
        return df.where(F.col("model_name") == model)

    row = registry.rollback_targets(
        of_model(ws.versions(spark)), of_model(ws.alias_events(spark)), of_model(ws.tags(spark)), alias
    ).first()
    if row is None:
        raise registry.UnknownModel(f"{model}@{alias} is not set")
    if row["target_version"] is None:
        raise registry.UnknownModel(f"no promoted version older than {row['current_version']}")
    move_alias(spark, ws, model, alias, row["target_version"], at)
    replaced = {registry.TAG_REPLACED_BY: str(row["target_version"])}
    set_tags(spark, ws, model, row["current_version"], replaced, at)
    return row["target_version"]
