"""The master: extract, normalize, and the relational build with its child tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.names import norm_conservative, search_name
from ledgerloom.operators.profile import coverage
from ledgerloom.operators.relate import ID, restrict_to_master
from ledgerloom.roles import MASTER_TYPE, require_tables

# Column order of the extract and of the tables of the build.
MASTER_COLUMNS = [
    ID,
    "status",
    "label",
    "gender",
    "country",
    "corroboration_grade",
    "corroboration_count",
    "source_tier_band",
]
TABLE_COLUMNS = {
    "master": [
        ID,
        "entity_type",
        "status",
        "label",
        "gender",
        "corroboration_grade",
        "corroboration_count",
        "source_tier_band",
    ],
    "aliases": [ID, "alias", "kind", "rank", "language"],
    "external_ids": ["provider", "namespace", "external_id", ID, "rung"],
    "clubs": [
        ID,
        "observed_clubs",
        "first_observed_season",
        "last_observed_season",
        "basis",
    ],
    "metadata": ["key", "value"],
}
QUALITY = ["corroboration_grade", "corroboration_count", "source_tier_band"]


def extract_master(
    master: DataFrame, entities: DataFrame, entity_type: str = MASTER_TYPE
) -> DataFrame:
    """Master records that the entity table knows, with its quality columns."""
    quality = entities.where(F.col("entity_type") == entity_type).select(ID, *QUALITY)
    return master.join(quality, ID).select(*MASTER_COLUMNS)


def build_master(extract: DataFrame) -> DataFrame:
    """The extract in its final shape and order."""
    return extract.select(*MASTER_COLUMNS).orderBy(ID)


def normalize_master(master: DataFrame) -> DataFrame:
    """The master with normalized and search names; labels stay as they are."""
    normalized = master.withColumn("normalized_name", norm_conservative(F.col("label")))
    return normalized.withColumn("search_name", search_name(F.col("normalized_name")))


def project_master(
    master: DataFrame, entities: DataFrame, entity_type: str = MASTER_TYPE
) -> DataFrame:
    """All master records; quality columns are NULL where the entity table lacks the id."""
    quality = entities.where(F.col("entity_type") == entity_type).select(ID, *QUALITY)
    tagged = master.withColumn("entity_type", F.lit(entity_type))
    return tagged.join(quality, ID, "left").select(*TABLE_COLUMNS["master"])


def build_relational_master(
    register: Mapping[str, DataFrame], entity_type: str = MASTER_TYPE
) -> dict[str, DataFrame]:
    """The master with the child rows that belong to it; write it with ``write_tables``."""
    require_tables(register, ["master", "entities", "aliases", "bridges", "clubs"])
    master = register["master"]
    typed_clubs = register["clubs"].where(F.col("entity_type") == entity_type)
    children = {
        "aliases": restrict_to_master(register["aliases"], master),
        "external_ids": restrict_to_master(register["bridges"], master),
        "clubs": restrict_to_master(typed_clubs, master),
    }
    built = {"master": project_master(master, register["entities"], entity_type)}
    for name, df in children.items():
        built[name] = df.select(*TABLE_COLUMNS[name])
    return built


def build_counts(built: Mapping[str, DataFrame], source: DataFrame) -> DataFrame:
    """One row with the counts that the build records about itself."""
    def rows(df: DataFrame):
        return df.agg(F.count("*")).scalar()

    def holders(df: DataFrame):
        return coverage(built["master"], df).select("covered").scalar()

    one = source.agg(F.count("*").alias("source_player_count"))
    return one.select(
        "source_player_count",
        rows(built["master"]).alias("output_player_count"),
        rows(built["aliases"]).alias("alias_count"),
        rows(built["external_ids"]).alias("external_id_count"),
        rows(built["clubs"]).alias("observed_club_count"),
        holders(built["aliases"]).alias("players_with_aliases"),
        holders(built["external_ids"]).alias("players_with_external_ids"),
        holders(built["clubs"]).alias("players_with_observed_clubs"),
    )
