"""Master build, gates, and the audit of the search index."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from catalogue.profiles import FIELDS, present
from catalogue.registers import over, pct, sql
from ledgerloom.operators import search
from ledgerloom.operators.slices import ensure_checkpoint_dir
from ledgerloom.plans import gates, master, reconcile
from ledgerloom.sources.register import load_register
from ledgerloom.sources.sinks import BUILD_CONSTANTS, metadata_table, write_tables

QUALITY = "corroboration_grade, corroboration_count, source_tier_band"
ROLES = "master entities aliases bridges clubs"
PROJECTED = (
    f"projected AS (SELECT m.entity_id, 'player' AS entity_type, m.status, m.label, m.gender, {QUALITY} FROM master m LEFT "
    f"JOIN (SELECT entity_id, {QUALITY} FROM entities WHERE entity_type = 'player') USING (entity_id))"
)
IN_MASTER = "entity_id IN (SELECT entity_id FROM master)"
CHILDREN = (
    PROJECTED,
    f"m_aliases AS (SELECT * FROM aliases WHERE {IN_MASTER})",
    f"m_external_ids AS (SELECT * FROM bridges WHERE {IN_MASTER})",
    "m_clubs AS (SELECT entity_id, observed_clubs, first_observed_season, last_observed_season, basis FROM clubs WHERE "
    f"entity_type = 'player' AND {IN_MASTER})",
)


def register(r):
    return {name: getattr(r, name) for name in ROLES.split()}


def built(r):
    tables = master.build_relational_master(register(r))
    counts = master.build_counts(tables, r.master)
    return {**tables, "metadata": metadata_table(counts, FACTS)}


def written(r):
    """The build as it was written, which is what an audit reads."""
    root = f"{ensure_checkpoint_dir(r.spark)}/build-{uuid4().hex}"
    tables = built(r)
    write_tables(tables, root)
    return load_register(r.spark, root, tables)


def orders_before_and_after(r):
    """Orders, and the same with some left out, some changed and some twice."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    before = r.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", cents)
    status = F.when(F.col("o_orderkey") % 97 == 0, "X").otherwise(F.col("o_orderstatus"))
    kept = before.where("o_orderkey % 101 <> 1").withColumn("o_orderstatus", status)
    return before, kept.unionByName(before.where("o_orderkey % 89 = 2"))


# What the caller knows about its build.
FACTS = {"database_name": "given tables", "database_version": "1", "source_database": "customer"}


def expected(r):
    """The counts that the source tables lead one to expect of a build."""
    parts = {"master": ["customer"], "aliases": ["conversations", "part"], "external_ids": ["lineitem"]}
    counts = [
        reduce(DataFrame.unionAll, [r.table(t).select(F.lit(1)) for t in tables]).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("expected")
        )
        for name, tables in parts.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def unrestricted(r):
    """A build whose children were not held to the master, as a check that gates can fail."""
    return {**built(r), "aliases": r.aliases, "external_ids": r.bridges, "clubs": r.clubs}


EXPECTED = (
    "expected AS (SELECT 'master' AS table_name, (SELECT COUNT(*) FROM customer) AS expected UNION ALL SELECT 'aliases', (SELECT "
    "COUNT(*) FROM conversations) + (SELECT COUNT(*) FROM part) UNION ALL SELECT 'external_ids', (SELECT COUNT(*) FROM lineitem))"
)
COUNTED = (
    "counted AS (SELECT 'expected_counts' AS check_name, COUNT(*) FILTER (expected <> n) = 0 AS passed, COUNT(*) FILTER (expected "
    "<> n) AS found FROM expected JOIN (SELECT 'master' AS table_name, (SELECT COUNT(*) FROM projected) AS n UNION ALL SELECT "
    "'aliases', (SELECT COUNT(*) FROM m_aliases) UNION ALL SELECT 'external_ids', (SELECT COUNT(*) FROM m_external_ids)) USING "
    "(table_name))"
)


def zero(name: str, query: str) -> str:
    return f"SELECT '{name}' AS check_name, n = 0 AS passed, n AS found FROM (SELECT ({query}) AS n)"


def duplicates(table: str) -> str:
    return f"SELECT COUNT(*) FROM (SELECT entity_id FROM {table} WHERE entity_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"


def blanks(table: str, column: str) -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE NOT {present(column)}"


def outside(table: str) -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE entity_id NOT IN (SELECT entity_id FROM projected)"


COUNTERS = {
    "null_player_ids": blanks("projected", "entity_id"),
    "non_player_rows": "SELECT COUNT(*) FROM projected WHERE entity_type IS DISTINCT FROM 'player'",
    "null_labels": blanks("projected", "label"),
    "null_status": blanks("projected", "status"),
    "duplicate_players": duplicates("projected"),
    "alias_null_ids": blanks("m_aliases", "entity_id"),
    "alias_null_values": blanks("m_aliases", "alias"),
    "external_null_ids": blanks("m_external_ids", "entity_id"),
    "external_null_values": blanks("m_external_ids", "external_id"),
    "external_null_providers": blanks("m_external_ids", "provider"),
    "external_null_namespaces": blanks("m_external_ids", "namespace"),
    "club_null_ids": blanks("m_clubs", "entity_id"),
    "club_null_evidence": blanks("m_clubs", "observed_clubs"),
    "club_duplicate_ids": duplicates("m_clubs"),
    "aliases_orphans": outside("m_aliases"),
    "external_ids_orphans": outside("m_external_ids"),
    "clubs_orphans": outside("m_clubs"),
}


def checks(names) -> str:
    return " UNION ALL ".join(zero(n, COUNTERS[n]) for n in names)


FINAL = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, BOOL_AND(passed) AS passed, CAST(SUM(found) AS BIGINT) AS found FROM ({checks(parts)})"
    for name, parts in gates.FINAL_CHECKS.items()
) + (
    " UNION ALL SELECT 'required_tables', true, CAST(0 AS BIGINT) UNION ALL SELECT 'schemas', true, CAST(0 AS BIGINT) UNION ALL "
    "SELECT * FROM counted"
)
STRUCTURAL = " UNION ALL ".join(
    f"SELECT '{t}_table_exists' AS check_name, true AS passed, CAST(0 AS BIGINT) AS found" for t in master.TABLE_COLUMNS
) + " UNION ALL " + checks(
    "duplicate_players null_player_ids non_player_rows null_labels null_status aliases_orphans "
    "external_ids_orphans clubs_orphans club_null_ids external_null_values".split()
)
COUNTS = {
    "source_player_count": "SELECT COUNT(*) FROM master",
    "output_player_count": "SELECT COUNT(*) FROM projected",
    "alias_count": "SELECT COUNT(*) FROM m_aliases",
    "external_id_count": "SELECT COUNT(*) FROM m_external_ids",
    "observed_club_count": "SELECT COUNT(*) FROM m_clubs",
    "players_with_aliases": "SELECT COUNT(DISTINCT entity_id) FROM m_aliases",
    "players_with_external_ids": "SELECT COUNT(DISTINCT entity_id) FROM m_external_ids",
    "players_with_observed_clubs": "SELECT COUNT(DISTINCT entity_id) FROM m_clubs",
}
VALUE = "LOWER(TRIM(search_text))"
DOUBLES = (
    f"doubles AS (SELECT entity_id, SHA256({VALUE}) AS digest, LENGTH({VALUE}) AS chars, COUNT(*) AS n FROM found WHERE "
    "search_text IS NOT NULL GROUP BY ALL HAVING COUNT(*) > 1)"
)
FOUND = (
    "found AS (SELECT * FROM search UNION ALL SELECT doc_id, 'coach', source, CONCAT(' ', text), NULL, NULL FROM documents "
    "WHERE lang <> 'en')"
)


def found(r):
    """The search rows, and a second, near-equal row for texts in other languages."""
    again = r.table("documents").where("lang <> 'en'").selectExpr(
        "doc_id AS entity_id",
        "'coach' AS entity_type",
        "source AS label",
        "CONCAT(' ', text) AS search_text",
        "CAST(NULL AS BIGINT) AS bridge_count",
        "CAST(NULL AS BIGINT) AS alias_count",
    )
    return r.search.unionByName(again)


QUERIES = {
    "extract_master": (
        over(lambda r: master.extract_master(r.master, r.entities)),
        sql(
            "master entities",
            f"SELECT m.*, {QUALITY} FROM master m JOIN (SELECT entity_id, {QUALITY} FROM entities WHERE entity_type = "
            "'player') USING (entity_id)",
        ),
    ),
    "build_master": (
        over(lambda r: master.build_master(master.extract_master(r.master, r.entities))),
        sql(
            "master entities",
            f"SELECT m.*, {QUALITY} FROM master m JOIN (SELECT entity_id, {QUALITY} FROM entities WHERE entity_type = "
            "'player') USING (entity_id) ORDER BY entity_id",
        ),
    ),
    "project_master": (
        over(lambda r: master.project_master(r.master, r.entities)),
        sql("master entities", "SELECT * FROM projected", PROJECTED),
    ),
    "master_aliases": (
        over(lambda r: master.build_relational_master(register(r))["aliases"]),
        sql(ROLES, "SELECT * FROM m_aliases", *CHILDREN),
    ),
    "master_external_ids": (
        over(lambda r: master.build_relational_master(register(r))["external_ids"]),
        sql(ROLES, "SELECT * FROM m_external_ids", *CHILDREN),
    ),
    "master_clubs": (
        over(lambda r: master.build_relational_master(register(r))["clubs"]),
        sql(ROLES, "SELECT * FROM m_clubs", *CHILDREN),
    ),
    "metadata_table": (
        over(lambda r: built(r)["metadata"]),
        sql(
            ROLES,
            " UNION ALL ".join(f"SELECT '{k}' AS key, CAST(({q}) AS STRING) AS value" for k, q in COUNTS.items())
            + " UNION ALL "
            + " UNION ALL ".join(
                "SELECT '{}', '{}'".format(k, v.replace("'", "''")) for k, v in {**BUILD_CONSTANTS, **FACTS}.items()
            ),
            *CHILDREN,
        ),
    ),
    "validate_rows": (
        over(lambda r: gates.validate_rows(r.items, ["entity_id", "label", "status"])),
        sql(
            "items",
            " UNION ALL ".join(
                zero(f"{c}_missing", blanks("items", c)) for c in ("entity_id", "label", "status")
            )
            + " UNION ALL "
            + zero("duplicate_ids", duplicates("items")),
        ),
    ),
    "validate_preserved": (
        over(
            lambda r: gates.validate_preserved(
                r.master, r.entities.where("entity_type = 'player'"), ["label", "status"]
            )
        ),
        sql(
            "master entities",
            zero("records_lost", "SELECT COUNT(*) FROM (FROM a EXCEPT ALL FROM b)")
            + " UNION ALL "
            + zero("records_added", "SELECT COUNT(*) FROM (FROM b EXCEPT ALL FROM a)"),
            "a AS (SELECT entity_id, label, status FROM master)",
            "b AS (SELECT entity_id, label, status FROM entities WHERE entity_type = 'player')",
        ),
    ),
    "lost_and_added": (
        over(
            lambda r: reconcile.lost_and_added(
                *(df.select("entity_id", "label", "status") for df in (r.master, r.entities.where("entity_type = 'player'")))
            )
        ),
        sql(
            "master entities",
            "SELECT entity_id, label, status, 'lost' AS change, COUNT(*) AS copies FROM (FROM a EXCEPT ALL FROM b) GROUP BY ALL "
            "UNION ALL SELECT entity_id, label, status, 'added', COUNT(*) FROM (FROM b EXCEPT ALL FROM a) GROUP BY ALL",
            "a AS (SELECT entity_id, label, status FROM master)",
            "b AS (SELECT entity_id, label, status FROM entities WHERE entity_type = 'player')",
        ),
    ),
    "lost_and_added_orders": (
        over(lambda r: reconcile.lost_and_added(*orders_before_and_after(r))),
        "WITH b AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents FROM orders), a AS "
        "(SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END, cents FROM b WHERE o_orderkey % "
        "101 <> 1 UNION ALL SELECT * FROM b WHERE o_orderkey % 89 = 2) SELECT *, 'lost' AS change, COUNT(*) AS copies FROM (FROM b EXCEPT "
        "ALL FROM a) GROUP BY ALL UNION ALL SELECT *, 'added', COUNT(*) FROM (FROM a EXCEPT ALL FROM b) GROUP BY ALL",
    ),
    "validate_entities": (
        over(lambda r: gates.validate_entities(r.master, r.entities)),
        sql(
            "master entities",
            "SELECT COUNT(*) AS total, COUNT(e.entity_id) AS matching, COUNT(*) - COUNT(e.entity_id) AS missing FROM master m "
            "LEFT JOIN entities e ON e.entity_id = m.entity_id AND e.entity_type = 'player'",
        ),
    ),
    "validate_references": (
        over(lambda r: gates.validate_references({**register(r), "metadata": None, "entities": r.xids})),
        sql(
            ROLES + " xids",
            " UNION ALL ".join(
                zero(
                    f"{name}_orphans",
                    f"SELECT COUNT(*) FROM {t} WHERE entity_id NOT IN (SELECT entity_id FROM master)",
                )
                for name, t in (("aliases", "aliases"), ("bridges", "bridges"), ("clubs", "clubs"), ("entities", "xids"))
            ),
        ),
    ),
    "validate_counts": (
        over(lambda r: gates.validate_counts({**register(r), "external_ids": r.order_xids}, expected(r))),
        sql(
            ROLES + " order_xids",
            "SELECT *, expected = actual AS passed FROM expected JOIN (SELECT 'master' AS table_name, (SELECT COUNT(*) FROM master) "
            "AS actual UNION ALL SELECT 'aliases', (SELECT COUNT(*) FROM aliases) UNION ALL SELECT 'external_ids', (SELECT COUNT(*) "
            "FROM order_xids)) USING (table_name)",
            EXPECTED,
        ),
    ),
    "build_checks": (
        over(lambda r: gates.build_checks(built(r))),
        sql(ROLES, checks(COUNTERS), *CHILDREN),
    ),
    "build_checks_failing": (
        over(lambda r: gates.build_checks(unrestricted(r))),
        sql(
            ROLES,
            checks(COUNTERS),
            PROJECTED,
            "m_aliases AS (SELECT * FROM aliases)",
            "m_external_ids AS (SELECT * FROM bridges)",
            "m_clubs AS (SELECT * FROM clubs)",
        ),
    ),
    "build_status": (
        over(lambda r: gates.build_status(written(r), r.master, expected(r))),
        sql(
            ROLES,
            "SELECT COUNT(*) AS checks, COUNT(*) FILTER (NOT passed) AS failed, CASE WHEN BOOL_AND(passed) THEN 'PASS' ELSE "
            "'REVIEW_REQUIRED' END AS status FROM (" + checks(gates.BUILD_CONDITIONS) + " UNION ALL "
            + zero("source_count_difference", "SELECT ABS((SELECT COUNT(*) FROM projected) - (SELECT COUNT(*) FROM master))")
            + " UNION ALL SELECT * FROM counted)",
            *CHILDREN,
            EXPECTED,
            COUNTED,
        ),
    ),
    "structural_checks": (
        over(lambda r: gates.structural_checks(written(r))),
        sql(ROLES, STRUCTURAL, *CHILDREN),
    ),
    "final_audit": (
        over(lambda r: gates.final_audit(written(r), expected(r))),
        sql(ROLES, FINAL, *CHILDREN, EXPECTED, COUNTED),
    ),
    "final_verdict": (
        over(lambda r: gates.final_verdict(written(r), expected(r))),
        sql(
            ROLES,
            "SELECT COUNT(*) AS checks, COUNT(*) FILTER (NOT passed) AS failed, CASE WHEN BOOL_AND(passed) THEN 'PASS' "
            f"ELSE 'FAIL' END AS status FROM ({STRUCTURAL} UNION ALL {FINAL})",
            *CHILDREN,
            EXPECTED,
            COUNTED,
        ),
    ),
    "search_coverage": (
        over(lambda r: search.search_coverage(r.master, found(r))),
        sql(
            "master search",
            "SELECT COUNT(*) AS total, COUNT(*) FILTER (n > 0) AS covered, COUNT(*) FILTER (n = 0) AS uncovered, "
            + pct("COUNT(*) FILTER (n > 0)", "COUNT(*)")
            + " AS covered_pct, COUNT(*) FILTER (n = 0) AS zero_rows, COUNT(*) FILTER (n = 1) AS one_row, COUNT(*) FILTER (n "
            "BETWEEN 2 AND 5) AS two_to_five, COUNT(*) FILTER (n > 5) AS over_five, SUM(n) / COUNT(*) AS average_rows, "
            "MAX(n) AS max_rows FROM (SELECT COUNT(f.entity_id) AS n FROM master m LEFT JOIN found f USING (entity_id) GROUP "
            "BY m.entity_id)",
            FOUND,
        ),
    ),
    "search_duplicates": (
        over(lambda r: search.search_duplicates(found(r))),
        sql("search", "SELECT * FROM doubles", FOUND, DOUBLES),
    ),
    "search_text_quality": (
        over(lambda r: search.search_text_quality(found(r))),
        sql(
            "search",
            "SELECT COUNT(*) AS search_rows, COUNT(*) FILTER (search_text IS NULL OR TRIM(search_text) = '') AS blank_texts, "
            "COUNT(*) FILTER (LENGTH(TRIM(search_text)) BETWEEN 1 AND 2) AS short_texts, (SELECT COUNT(*) FROM doubles) AS "
            "duplicate_groups, (SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM doubles) AS extra_rows FROM found",
            FOUND,
            DOUBLES,
        ),
    ),
    "search_consistency": (
        over(lambda r: search.search_consistency(found(r), r.entities)),
        sql(
            "search entities",
            "SELECT COUNT(*) AS linked_rows, COUNT(*) FILTER (e.entity_type = 'player') AS master_type_rows, COUNT(*) FILTER "
            "(e.entity_type <> 'player') AS other_type_rows, COUNT(*) FILTER (f.entity_type <> e.entity_type) AS "
            "type_mismatches, COUNT(*) FILTER (COALESCE(f.label, '') <> COALESCE(e.label, '')) AS label_mismatches, (SELECT "
            "COUNT(*) FROM found WHERE entity_id NOT IN (SELECT entity_id FROM entities)) AS orphan_rows FROM found f JOIN "
            "entities e USING (entity_id)",
            FOUND,
        ),
    ),
    "search_evidence": (
        over(lambda r: search.search_evidence(r.master, found(r))),
        sql(
            "master search",
            "SELECT COUNT(*) AS joined_rows, COUNT(*) FILTER (COALESCE(bridge_count, 0) > 0) AS with_bridges, COUNT(*) FILTER "
            "(COALESCE(alias_count, 0) > 0) AS with_aliases, COUNT(*) FILTER (COALESCE(bridge_count, 0) = 0 AND "
            "COALESCE(alias_count, 0) = 0) AS without_bridge_or_alias FROM master m LEFT JOIN found f USING (entity_id)",
            FOUND,
        ),
    ),
    "search_cardinality": (
        over(lambda r: search.search_cardinality(found(r))),
        sql(
            "search",
            "SELECT COUNT(search_text) AS total_texts, COUNT(DISTINCT search_text) AS distinct_texts FROM found",
            FOUND,
        ),
    ),
    "sample_without_search": (
        over(lambda r: search.sample_without_search(r.master, found(r))),
        sql(
            "master search",
            "SELECT entity_id, label FROM master WHERE entity_id NOT IN (SELECT entity_id FROM found) ORDER BY entity_id LIMIT 25",
            FOUND,
        ),
    ),
    "sample_orphan_search": (
        over(lambda r: search.sample_orphans(found(r), r.entities)),
        sql(
            "entities search",
            "SELECT entity_id, entity_type, label, search_text FROM found WHERE entity_id NOT IN (SELECT entity_id FROM entities) "
            "ORDER BY entity_id, search_text LIMIT 25",
            FOUND,
        ),
    ),
    "sample_type_mismatches": (
        over(lambda r: search.sample_type_mismatches(found(r), r.entities)),
        sql(
            "entities search",
            "SELECT f.entity_id, e.entity_type AS known_entity_type, f.entity_type, e.label AS known_label FROM found f JOIN "
            "entities e USING (entity_id) WHERE f.entity_type <> e.entity_type ORDER BY 1, 3 LIMIT 25",
            FOUND,
        ),
    ),
    "sample_label_mismatches": (
        over(lambda r: search.sample_label_mismatches(found(r), r.entities)),
        sql(
            "entities search",
            "SELECT f.entity_id, e.label AS known_label, f.label FROM found f JOIN entities e USING (entity_id) WHERE "
            "COALESCE(f.label, '') <> COALESCE(e.label, '') ORDER BY 1, 3 NULLS FIRST LIMIT 25",
            FOUND,
        ),
    ),
    "sample_duplicate_search": (
        over(lambda r: search.sample_duplicates(found(r))),
        sql("search", "SELECT * FROM doubles ORDER BY n DESC, entity_id, digest LIMIT 25", FOUND, DOUBLES),
    ),
}
