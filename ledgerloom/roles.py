"""Canonical column names of each register table, and how a user's columns map to them.

Every operator reads the canonical names below. ``project_roles`` renames a user's
columns once, at plan time, and puts typed NULLs where a column is absent.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F, types as T

# The type tag of master rows, and the five known statuses / checks.
MASTER_TYPE = "player"
ACTIVE, RETIRED, REDIRECTED = "active", "retired", "redirected"
AGREES, UNVERIFIED = "dob-agrees", "dob-unverified"

# Columns without a type keep the type of the source column (ids and external ids).
ROLES: dict[str, dict[str, str | None]] = {
    "master": {
        "entity_id": None,
        "status": "string",
        "label": "string",
        "gender": "string",
        "country": "string",
    },
    "entities": {
        "entity_id": None,
        "entity_type": "string",
        "status": "string",
        "label": "string",
        "gender": "string",
        "country": "string",
        "corroboration_grade": "string",
        "corroboration_count": "long",
        "source_tier_band": "string",
    },
    "aliases": {
        "entity_id": None,
        "alias": "string",
        "kind": "string",
        "rank": "int",
        "language": "string",
    },
    "overlay_aliases": {"entity_id": None, "source": "string"},
    "bridges": {
        "provider": "string",
        "namespace": "string",
        "external_id": None,
        "entity_id": None,
        "rung": "string",
    },
    "clubs": {
        "entity_id": None,
        "entity_type": "string",
        "observed_clubs": "long",
        "first_observed_season": "string",
        "last_observed_season": "string",
        "basis": "string",
    },
    "links": {
        "entity_id": None,
        "qid": None,
        "confidence": "double",
        "dob_check": "string",
        "entity_type": "string",
        "inherited_count": "long",
        "inherited": "string",
    },
    "xids": {
        "entity_id": None,
        "provider": "string",
        "property": "string",
        "external_id": None,
        "rank": "int",
        "confidence": "double",
        "dob_check": "string",
        "qid": None,
    },
    "redirects": {"from_id": None, "to_id": None, "reason": "string"},
    "search": {
        "entity_id": None,
        "entity_type": "string",
        "label": "string",
        "search_text": "string",
        "bridge_count": "long",
        "alias_count": "long",
    },
    "relationships": {"from_id": None, "to_id": None, "kind": "string"},
}

# The source column of an alias table goes by one of these names.
SOURCE_CANDIDATES = ("source", "name_source", "provider")


def resolve_column(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """The first candidate that names a column of ``df``, whatever its case."""
    present = {name.lower(): name for name in df.columns}
    return next((present[c.lower()] for c in candidates if c.lower() in present), None)


def require_columns(df: DataFrame, names: Iterable[str], table: str = "table") -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{table} lacks the columns {missing}")
    return df


def require_tables(tables: Mapping[str, DataFrame], names: Iterable[str]) -> None:
    missing = sorted(set(names) - set(tables))
    if missing:
        raise ValueError(f"the register lacks the tables {missing}")


def project_roles(df: DataFrame, role: str, **columns: str) -> DataFrame:
    """Rename ``df``'s columns to the role's names; absent ones become typed NULLs.

    ``columns`` maps canonical names to the user's; a name not given is looked up as is.
    """
    spec = ROLES[role]
    unknown = sorted(set(columns) - set(spec))
    if unknown:
        raise ValueError(f"role {role} has no columns {unknown}")
    require_columns(df, columns.values(), role)
    picked = []
    for name, kind in spec.items():
        source = columns.get(name) or resolve_column(df, [name])
        column = F.col(source) if source else F.lit(None).cast(kind or "string")
        picked.append((column.cast(kind) if kind else column).alias(name))
    return df.select(*picked)


# The catalogue of the final profile, name -> (type, category, required).
PROFILE_FIELDS = {
    "entity_id": ("string", "identity", True),
    "label": ("string", "identity", True),
    "status": ("string", "identity", True),
    "entity_type": ("string", "identity", True),
    "gender": ("string", "identity", False),
    "country": ("string", "identity", False),
    "aliases": ("array<string>", "identity", False),
    "qid": ("string", "external_identity", False),
    "external_ids": ("array<string>", "external_identity", False),
    "observed_clubs": ("bigint", "club_evidence", False),
    "first_observed_season": ("string", "club_evidence", False),
    "last_observed_season": ("string", "club_evidence", False),
    "club_evidence_basis": ("string", "club_evidence", False),
    "corroboration_grade": ("string", "provenance", False),
    "corroboration_count": ("bigint", "provenance", False),
    "source_tier_band": ("string", "provenance", False),
}


def profile_schema() -> T.StructType:
    """The final profile as a Spark schema; category and required flag are field metadata."""
    fields = [
        T.StructField(
            name,
            T.DataType.fromDDL(kind),
            not required,
            {"category": category, "required": required},
        )
        for name, (kind, category, required) in PROFILE_FIELDS.items()
    ]
    return T.StructType(fields)
