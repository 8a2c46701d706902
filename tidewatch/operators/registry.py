"""Model registry state derived from append-only event tables.

``versions(model_name, version, run_id, status, created_at)``, ``alias_events(model_name,
alias, version, event_ts)`` and ``tags(model_name, version, key, value, event_ts)``: the
last event wins. Everything is keyed by model, so one run can serve many models.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import model_uri_parts

# Tag keys and decision words stored with a version.
TAG_DECISION = "promotion.decision"
TAG_REASON = "promotion.reason"
TAG_METRIC = "promotion.metric"
TAG_CHALLENGER_SCORE = "promotion.challenger_score"
TAG_CHAMPION_SCORE = "promotion.champion_score"
TAG_COMPARED_TO = "promotion.compared_to_version"
TAG_REPLACED_BY = "rollback.replaced_by"
PROMOTED = "promoted"
REJECTED = "rejected"

VERSION_SCHEMA = "model_name string, version int, run_id string, status string, created_at timestamp"
ALIAS_SCHEMA = "model_name string, alias string, version int, event_ts timestamp"
TAG_SCHEMA = "model_name string, version int, key string, value string, event_ts timestamp"


class UnknownModel(LookupError):
    """An alias or version is not in the registry."""


def current_aliases(alias_events: DataFrame) -> DataFrame:
    """Where each alias points now; two moves at one instant are settled by version."""
    return alias_events.groupBy("model_name", "alias").agg(
        F.max(F.struct("event_ts", "version")).alias("last")
    ).select("model_name", "alias", "last.version", F.col("last.event_ts").alias("moved_at"))


def current_tags(tags: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Latest value of the wanted keys as columns, one row per version."""

    def latest(key: str) -> Column:
        return F.max_by(
            F.when(F.col("key") == key, F.col("value")),
            F.when(F.col("key") == key, F.struct("event_ts", "value")),
        )

    return (
        tags.where(F.col("key").isin(*wanted))
        .groupBy("model_name", "version")
        .agg(*[latest(key).alias(name) for key, name in wanted.items()])
    )


def list_versions(versions: DataFrame, alias_events: DataFrame, tags: DataFrame) -> DataFrame:
    """Every version with its aliases (sorted), decision and reason.

    Alias names per version are few: an alias points at one version at a time.
    """
    names = current_aliases(alias_events).groupBy("model_name", "version").agg(
        F.array_sort(F.collect_set("alias")).alias("aliases")
    )
    notes = current_tags(tags, {TAG_DECISION: "decision", TAG_REASON: "reason"})
    keys = ["model_name", "version"]
    return (
        versions.join(names, keys, "left")
        .join(notes, keys, "left")
        .select(
            *keys,
            F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"),
            "run_id",
            "status",
            F.coalesce("decision", F.lit("")).alias("decision"),
            F.coalesce("reason", F.lit("")).alias("reason"),
        )
    )


def newest_first(listing: DataFrame) -> DataFrame:
    """Versions are numbers: 10 sorts after 9."""
    return listing.orderBy("model_name", F.desc("version"))


def resolve_uris(uris: DataFrame, alias_events: DataFrame, versions: DataFrame) -> DataFrame:
    """Turn a ``uri`` column into (model_name, version, run_id, resolved_uri).

    An alias is read once, here; a URI of another form is passed through with NULLs, and
    an alias or version that does not exist has a NULL ``resolved_uri``.
    """
    parts = uris.withColumn("_p", model_uri_parts("uri")).select(
        *uris.columns,
        F.col("_p.model_name").alias("model_name"),
        F.col("_p.alias").alias("alias"),
        F.col("_p.version").alias("_fixed"),
    )
    here = current_aliases(alias_events).select(
        "model_name", "alias", F.col("version").alias("_moved")
    )
    pointed = parts.join(here, ["model_name", "alias"], "left").withColumn(
        "version", F.coalesce("_fixed", "_moved")
    )
    known = versions.select("model_name", "version", "run_id", F.lit(True).alias("_known"))
    found = pointed.join(known, ["model_name", "version"], "left")
    exact = F.concat(F.lit("models:/"), F.col("model_name"), F.lit("/"), F.col("version").cast("string"))
    return found.select(
        "uri",
        "model_name",
        F.when(F.col("_known"), F.col("version")).alias("version"),
        "run_id",
        F.when(F.col("model_name").isNull(), F.col("uri"))
        .when(F.col("_known"), exact)
        .alias("resolved_uri"),
    )


def rollback_targets(versions: DataFrame, alias_events: DataFrame, tags: DataFrame, alias: str) -> DataFrame:
    """(model_name, current_version, target_version) for each model whose alias is set.

    The target is the highest promoted version below the current one, NULL if none.
    """
    now = (
        current_aliases(alias_events)
        .where(F.col("alias") == alias)
        .select("model_name", F.col("version").alias("current_version"))
    )
    promoted = (
        current_tags(tags, {TAG_DECISION: "decision"})
        .where(F.col("decision") == PROMOTED)
        .select("model_name", "version")
        .join(versions.select("model_name", "version"), ["model_name", "version"], "left_semi")
    )
    below = (
        promoted.join(now, "model_name")
        .where(F.col("version") < F.col("current_version"))
        .groupBy("model_name")
        .agg(F.max("version").alias("target_version"))
    )
    return now.join(below, "model_name", "left")


def minutes_since_newest(versions: DataFrame, now: Column) -> DataFrame:
    """(model_name, newest_at, minutes) since the newest version of each model."""
    return versions.groupBy("model_name").agg(F.max("created_at").alias("newest_at")).select(
        "model_name",
        "newest_at",
        (F.timestamp_diff("SECOND", F.col("newest_at"), now) / 60.0).alias("minutes"),
    )
