"""Name keys over whole texts and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.collisions import ALIAS_KEY, COMPACT, CONSERVATIVE, LABEL_KEY, WORDS
from catalogue.registers import over, sql
from ledgerloom.functions import names
from ledgerloom.plans.master import extract_master, normalize_master

SPACE = "TRIM(REGEXP_REPLACE(LOWER(COALESCE({}, '')), '\\s+', ' ', 'g'))"
ASCII = "TRIM(REGEXP_REPLACE(LOWER(COALESCE({}, '')), '[^a-z0-9]+', ' ', 'g'))"


def keyed(key, *roles):
    """Id and key of every row of the roles, as (id, digest of the key, its length)."""
    def build(r):
        parts = [getattr(r, role).select("entity_id", "label") for role in roles]
        df = parts[0]
        for part in parts[1:]:
            df = df.unionByName(part)
        named = df.select("entity_id", key(F.col("label")).alias("name"))
        return named.select(
            "entity_id", F.sha2("name", 256).alias("digest"), F.length("name").cast("long").alias("chars")
        )

    return over(build)


def check(form: str) -> str:
    return sql(
        "items texts",
        "SELECT entity_id, SHA256(name) AS digest, LENGTH(name) AS chars FROM (SELECT entity_id, "
        + form.format("label")
        + " AS name FROM (SELECT entity_id, label FROM items UNION ALL SELECT entity_id, label FROM texts))",
    )


QUERIES = {
    "norm_conservative": (keyed(names.norm_conservative, "items", "texts"), check(CONSERVATIVE)),
    "norm_alias": (keyed(names.norm_alias, "items", "texts"), check(ALIAS_KEY)),
    "norm_label": (keyed(names.norm_label, "items", "texts"), check(LABEL_KEY)),
    "norm_compact": (keyed(names.norm_compact, "items", "texts"), check(COMPACT)),
    "norm_words": (keyed(names.norm_words, "items", "texts"), check(WORDS)),
    "norm_ascii": (keyed(names.norm_ascii, "items", "texts"), check(ASCII)),
    "norm_space": (keyed(names.norm_space, "items", "texts"), check(SPACE)),
    "norm_trim": (keyed(names.norm_trim, "items", "texts"), check("LOWER(TRIM({}))")),
    "norm_casefold": (
        keyed(names.norm_casefold, "items", "texts"),
        check("REPLACE(LOWER(REGEXP_REPLACE({}, '^\\s+|\\s+$', '', 'g')), 'ß', 'ss')"),
    ),
    "normalize_master": (
        over(lambda r: normalize_master(extract_master(r.master, r.entities))),
        sql(
            "master entities",
            "SELECT *, " + CONSERVATIVE.format("label") + " AS normalized_name, " + CONSERVATIVE.format("label")
            + " AS search_name FROM (SELECT m.*, corroboration_grade, corroboration_count, source_tier_band FROM master m JOIN "
            "(SELECT entity_id, corroboration_grade, corroboration_count, source_tier_band FROM entities WHERE entity_type = "
            "'player') USING (entity_id))",
        ),
    ),
}
