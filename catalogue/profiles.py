"""Counts, completeness, distributions, agreement, joins by id."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from catalogue.registers import over, pct, sql
from ledgerloom.functions.exprs import cardinality_class, is_provider_name, json_cell, unique_sorted
from ledgerloom.operators import aliases, profile, ranking, relate
from ledgerloom.operators.collide import collision_members
from ledgerloom.operators.slices import ensure_checkpoint_dir
from ledgerloom.sources import register as reg, sinks

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
FIELDS = ["entity_id", "status", "label", "gender", "country"]
NUMBERED = {"entity_id"}
# Types of the checking engine under the names that Spark gives them.
TYPE = (
    "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'FLOAT[]' THEN 'array<float>' WHEN "
    "'TIMESTAMP' THEN {time} ELSE LOWER(column_type) END"
).format(time="'timestamp_ntz'")


def present(c: str) -> str:
    return f"({c} IS NOT NULL AND TRIM(CAST({c} AS STRING)) <> '')"


def bucket(c: str, label: str = "NULL") -> str:
    return f"COALESCE(NULLIF(TRIM(CAST({c} AS STRING)), ''), '{label}')"


def per_field(template: str, fields=FIELDS) -> str:
    return " UNION ALL ".join(template.format(f=f, p=present(f)) for f in fields)


PAIR = "pairs AS (SELECT m.entity_id, {} FROM master m JOIN entities e USING (entity_id))".format(
    ", ".join(f"m.{f} AS {f}_l, e.{f} AS {f}_r" for f in FIELDS[1:])
)
SAME = " AND ".join(f"{f}_l IS NOT DISTINCT FROM {f}_r" for f in FIELDS[1:])

def cells(r):
    """Per entity the bases of its club evidence, as sorted sets and counters in JSON cells."""
    counted = r.clubs.groupBy("entity_id", "basis").agg(F.count("*").alias("n"))
    # five bases at most
    per = counted.groupBy("entity_id").agg(
        unique_sorted(F.collect_list("basis")).alias("set"),
        F.array_sort(F.collect_list(F.struct("basis", "n"))).alias("counts"),
    )
    return per.select(
        "entity_id",
        json_cell(F.col("set")).alias("bases"),
        cardinality_class(F.col("set")).alias("basis_class"),
        json_cell(F.col("counts")).alias("basis_counts"),
    )


def round_trip(r):
    """Club evidence written as JSON records, and read back from there."""
    path = f"{ensure_checkpoint_dir(r.spark)}/records-{uuid4().hex}"
    sinks.write_records_json(r.clubs, path)
    return r.spark.read.schema(r.clubs.schema).json(path)


QUERIES = {
    "table_counts": (
        over(lambda r: profile.table_counts({t: r.table(t) for t in TABLES})),
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {t}" for t in TABLES),
    ),
    "catalog_profile": (
        over(lambda r: reg.catalog_profile({t: r.table(t) for t in TABLES})),
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, column_name, {TYPE} AS data_type, CAST(ROW_NUMBER() OVER () - 1 AS INT) AS ordinal, "
            f"(SELECT COUNT(*) FROM {t}) AS n_rows FROM (DESCRIBE {t})"
            for t in TABLES
        ),
    ),
    "entity_cells": (
        over(cells),
        sql(
            "clubs",
            "SELECT entity_id, CAST(to_json(list_sort(list(DISTINCT basis))) AS VARCHAR) AS bases, CASE COUNT(DISTINCT basis) "
            "WHEN 1 THEN 'single' ELSE 'multiple' END AS basis_class, (SELECT CAST(to_json(list({'basis': basis, 'n': n} ORDER "
            "BY basis)) AS VARCHAR) FROM (SELECT basis, COUNT(*) AS n FROM clubs d WHERE d.entity_id = c.entity_id GROUP BY "
            "basis)) AS basis_counts FROM clubs c GROUP BY entity_id",
        ),
    ),
    "table_columns": (
        over(lambda r: reg.describe_tables({t: r.table(t) for t in TABLES})),
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, column_name, {TYPE} AS data_type, CAST(ROW_NUMBER() OVER () - 1 AS INT) AS ordinal "
            f"FROM (DESCRIBE {t})"
            for t in TABLES
        ),
    ),
    "written_and_read": (
        over(round_trip),
        sql("clubs", "SELECT * FROM clubs"),
    ),
    "distinct_entities": (
        over(lambda r: profile.distinct_entities(r.links)),
        sql("links", f"SELECT COUNT(DISTINCT entity_id) AS entities FROM links WHERE {present('entity_id')}"),
    ),
    "key_uniqueness": (
        over(lambda r: profile.key_uniqueness(r.table("lineitem"), ["l_orderkey", "l_linenumber"])),
        "WITH k AS (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) "
        "SELECT CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS distinct_keys, "
        "CAST(SUM(n) - COUNT(*) AS BIGINT) AS surplus_rows FROM k",
    ),
    "duplicate_groups": (
        over(lambda r: profile.duplicate_groups(r.table("lineitem"), ["l_orderkey", "l_linenumber"])),
        "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1",
    ),
    "duplicate_extra_rows": (
        over(lambda r: profile.duplicate_extra_rows(r.clubs, ["entity_id"])),
        sql(
            "clubs",
            "SELECT COUNT(*) AS duplicate_groups, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS extra_rows "
            "FROM (SELECT COUNT(*) AS n FROM clubs GROUP BY entity_id HAVING COUNT(*) > 1)",
        ),
    ),
    "exact_duplicates": (
        over(lambda r: profile.exact_duplicates(r.order_xids)),
        sql(
            "order_xids",
            "SELECT COUNT(*) AS duplicate_groups, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS extra_rows "
            "FROM (SELECT COUNT(*) AS n FROM order_xids GROUP BY entity_id, provider, property, "
            "external_id, rank, confidence, dob_check, qid HAVING COUNT(*) > 1)",
        ),
    ),
    "blank_counts": (
        over(lambda r: profile.blank_counts(r.master, FIELDS)),
        sql(
            "master",
            per_field(
                "SELECT '{f}' AS field, COUNT(*) FILTER ({f} IS NULL) AS nulls, "
                "COUNT(*) FILTER (TRIM(CAST({f} AS STRING)) = '') AS blanks FROM master"
            ),
        ),
    ),
    "field_profile": (
        over(lambda r: profile.field_profile(r.master, FIELDS)),
        sql(
            "master",
            per_field(
                "SELECT '{f}' AS field, COUNT(*) AS total, COUNT(*) FILTER ({p}) AS populated, "
                "COUNT(*) FILTER ({f} IS NULL) AS nulls, "
                "COUNT(*) FILTER ({f} IS NOT NULL AND NOT {p}) AS blanks, "
                "COUNT(DISTINCT CASE WHEN {p} THEN {f} END) AS distinct_values, "
                + pct("COUNT(*) FILTER ({p})", "COUNT(*)")
                + " AS populated_pct FROM master"
            ),
        ),
    ),
    "record_completeness": (
        over(lambda r: profile.record_completeness(r.master, FIELDS)),
        sql(
            "master",
            "SELECT *, CONCAT_WS('|', "
            + ", ".join(f"CASE WHEN NOT {present(f)} THEN '{f}' END" for f in FIELDS)
            + ") AS missing_fields, "
            + " AND ".join(present(f) for f in FIELDS)
            + " AS core_complete FROM master",
        ),
    ),
    "missing_field_counts": (
        over(lambda r: profile.missing_field_counts(r.master, FIELDS)),
        sql(
            "master",
            per_field(
                "SELECT '{f}' AS field, COUNT(*) FILTER (NOT {p}) AS missing FROM master"
            ),
        ),
    ),
    "completeness_totals": (
        over(lambda r: profile.completeness_totals(r.master, FIELDS)),
        sql(
            "master",
            "SELECT COUNT(*) AS records, COUNT(*) FILTER (ok) AS complete, "
            "COUNT(*) FILTER (NOT ok) AS incomplete, "
            + pct("COUNT(*) FILTER (ok)", "COUNT(*)")
            + " AS complete_pct FROM (SELECT "
            + " AND ".join(present(f) for f in FIELDS)
            + " AS ok FROM master)",
        ),
    ),
    "value_distribution": (
        over(lambda r: profile.value_distribution(r.master, "status", "NULL/EMPTY")),
        sql(
            "master",
            f"SELECT {bucket('status', 'NULL/EMPTY')} AS status, COUNT(*) AS n, "
            + pct("COUNT(*)", "SELECT COUNT(*) FROM master")
            + " AS pct FROM master GROUP BY 1",
        ),
    ),
    "two_key_distribution": (
        over(lambda r: profile.value_distribution(r.links, ["confidence", "dob_check"], entity="entity_id")),
        sql(
            "links",
            f"SELECT {bucket('confidence')} AS confidence, {bucket('dob_check')} AS dob_check, "
            "COUNT(*) AS n, COUNT(DISTINCT entity_id) AS entities, "
            + pct("COUNT(*)", "SELECT COUNT(*) FROM links")
            + " AS pct FROM links GROUP BY 1, 2",
        ),
    ),
    "most_common_values": (
        over(lambda r: profile.most_common(r.links, "qid", 20)),
        sql(
            "links",
            "SELECT qid, COUNT(*) AS n, " + pct("COUNT(*)", "SELECT COUNT(*) FROM links")
            + " AS pct FROM links GROUP BY qid ORDER BY n DESC, qid LIMIT 20",
        ),
    ),
    "source_distribution": (
        over(lambda r: profile.source_distribution(r.overlay_aliases)),
        sql(
            "overlay_aliases",
            f"SELECT {bucket('source')} AS source, COUNT(*) AS n, "
            + pct("COUNT(*)", "SELECT COUNT(*) FROM overlay_aliases")
            + " AS pct FROM overlay_aliases GROUP BY 1",
        ),
    ),
    "linked_distribution": (
        over(lambda r: profile.linked_distribution(r.links, r.master, "status")),
        sql(
            "links master",
            f"SELECT {bucket('m.status')} AS status, COUNT(*) AS n, COUNT(DISTINCT m.entity_id) AS entities "
            "FROM links l JOIN master m USING (entity_id) GROUP BY 1",
        ),
    ),
    "provider_profile": (
        over(lambda r: profile.provider_profile(r.order_xids)),
        sql(
            "order_xids",
            "SELECT provider, COUNT(*) AS n_rows, COUNT(DISTINCT entity_id) AS entities, "
            "COUNT(DISTINCT external_id) AS external_ids FROM order_xids GROUP BY provider",
        ),
    ),
    "provider_property_profile": (
        over(lambda r: profile.provider_property_profile(r.order_xids)),
        sql(
            "order_xids",
            "SELECT provider, property, COUNT(*) AS n_rows, COUNT(DISTINCT entity_id) AS entities, "
            "COUNT(DISTINCT external_id) AS external_ids FROM order_xids GROUP BY provider, property",
        ),
    ),
    "items_per_entity": (
        over(lambda r: profile.items_per_entity(r.order_xids)),
        sql(
            "order_xids",
            "SELECT items, COUNT(*) AS entities FROM (SELECT COUNT(*) AS items FROM order_xids "
            "GROUP BY entity_id) GROUP BY items",
        ),
    ),
    "items_summary": (
        over(lambda r: profile.items_summary(r.links)),
        sql(
            "links",
            "SELECT COUNT(*) AS entities, MAX(n) AS max_items, COUNT(*) FILTER (n >= 10) AS entities_10_plus, "
            "COUNT(*) FILTER (n >= 20) AS entities_20_plus FROM (SELECT COUNT(*) AS n FROM links GROUP BY entity_id)",
        ),
    ),
    "entities_per_key": (
        over(lambda r: profile.entities_per_key(r.links, "qid")),
        sql(
            "links",
            "SELECT entities, COUNT(*) AS keys FROM (SELECT COUNT(DISTINCT entity_id) AS entities "
            "FROM links GROUP BY qid) GROUP BY entities",
        ),
    ),
    "rows_per_entity_buckets": (
        over(lambda r: profile.rows_per_entity_buckets(r.orders_master, r.order_xids)),
        sql(
            "orders_master order_xids",
            "SELECT COUNT(*) AS entities, COUNT(*) FILTER (n = 0) AS zero_rows, "
            "COUNT(*) FILTER (n = 1) AS one_row, COUNT(*) FILTER (n BETWEEN 2 AND 5) AS two_to_five, "
            "COUNT(*) FILTER (n > 5) AS over_five, SUM(n) / COUNT(*) AS average_rows, MAX(n) AS max_rows "
            "FROM (SELECT COUNT(x.entity_id) AS n FROM orders_master m "
            "LEFT JOIN order_xids x USING (entity_id) GROUP BY m.entity_id)",
        ),
    ),
    "kinds_per_entity": (
        over(lambda r: profile.kinds_per_entity(r.aliases)),
        sql(
            "aliases",
            "SELECT kinds, COUNT(*) AS entities FROM (SELECT COUNT(DISTINCT kind) AS kinds "
            "FROM aliases GROUP BY entity_id) GROUP BY kinds",
        ),
    ),
    "entities_with_kinds": (
        over(lambda r: aliases.entities_with_kinds(r.aliases)),
        sql(
            "aliases",
            "SELECT COUNT(DISTINCT CASE WHEN kind = 'provider-name' THEN entity_id END) AS provider_name, "
            "COUNT(DISTINCT CASE WHEN kind = 'official_name' THEN entity_id END) AS official_name, "
            "COUNT(DISTINCT CASE WHEN kind = 'short' THEN entity_id END) AS short FROM aliases",
        ),
    ),
    "entities_with_tests": (
        over(
            lambda r: profile.entities_with(
                r.aliases,
                {
                    "provider_names": is_provider_name(F.col("kind")),
                    "late_ranks": F.col("rank") > 5,
                },
            )
        ),
        sql(
            "aliases",
            "SELECT COUNT(DISTINCT CASE WHEN kind LIKE '%provider%' THEN entity_id END) AS provider_names, "
            "COUNT(DISTINCT CASE WHEN rank > 5 THEN entity_id END) AS late_ranks FROM aliases",
        ),
    ),
    "coverage": (
        over(lambda r: profile.coverage(r.search, r.overlay_aliases)),
        sql(
            "search overlay_aliases",
            "SELECT COUNT(*) AS total, COUNT(*) FILTER (hit) AS covered, COUNT(*) FILTER (NOT hit) AS uncovered, "
            + pct("COUNT(*) FILTER (hit)", "COUNT(*)")
            + " AS covered_pct FROM (SELECT entity_id IN (SELECT entity_id FROM overlay_aliases) AS hit FROM search)",
        ),
    ),
    "coverage_two": (
        over(lambda r: relate.coverage_two(r.master, r.xids)),
        sql(
            "master xids",
            "SELECT COUNT(*) FILTER (a AND b) AS both_sides, COUNT(*) FILTER (a AND NOT b) AS left_only, "
            "COUNT(*) FILTER (b AND NOT a) AS right_only FROM (SELECT COALESCE(l.k, false) AS a, "
            "COALESCE(r.k, false) AS b FROM (SELECT DISTINCT entity_id, true AS k FROM master) l "
            "FULL JOIN (SELECT DISTINCT entity_id, true AS k FROM xids) r USING (entity_id))",
        ),
    ),
    "orphan_rows": (
        over(lambda r: relate.orphans(r.bridges, r.master)),
        sql(
            "bridges master",
            "SELECT * FROM bridges WHERE entity_id NOT IN (SELECT entity_id FROM master)",
        ),
    ),
    "missing_parents": (
        over(lambda r: relate.missing_parents(r.master, r.xids)),
        sql("master xids", "SELECT * FROM master WHERE entity_id NOT IN (SELECT entity_id FROM xids)"),
    ),
    "restrict_to_master": (
        over(lambda r: relate.restrict_to_master(r.bridges, r.master)),
        sql("bridges master", "SELECT * FROM bridges WHERE entity_id IN (SELECT entity_id FROM master)"),
    ),
    "split_by_master": (
        over(lambda r: relate.split_by_master(r.bridges, r.master)),
        sql(
            "bridges master",
            "SELECT COUNT(*) FILTER (hit) AS rows_in_master, COUNT(*) FILTER (NOT hit) AS rows_outside, "
            "COUNT(DISTINCT CASE WHEN hit THEN entity_id END) AS entities_in_master, "
            "COUNT(DISTINCT CASE WHEN NOT hit THEN entity_id END) AS entities_outside "
            "FROM (SELECT entity_id, entity_id IN (SELECT entity_id FROM master) AS hit FROM bridges)",
        ),
    ),
    "evidence_flags": (
        over(lambda r: relate.evidence_counts(r.master, {"link": r.links, "xid": r.xids, "alias": r.aliases})),
        sql(
            "master links xids aliases",
            "SELECT *, n_link > 0 AS has_link, n_xid > 0 AS has_xid, n_alias > 0 AS has_alias FROM (SELECT m.*, "
            "COALESCE(l.n, 0) AS n_link, COALESCE(x.n, 0) AS n_xid, COALESCE(a.n, 0) AS n_alias FROM master m "
            "LEFT JOIN (SELECT entity_id, COUNT(*) AS n FROM links GROUP BY 1) l USING (entity_id) "
            "LEFT JOIN (SELECT entity_id, COUNT(*) AS n FROM xids GROUP BY 1) x USING (entity_id) "
            "LEFT JOIN (SELECT entity_id, COUNT(*) AS n FROM aliases GROUP BY 1) a USING (entity_id))",
        ),
    ),
    "collision_member_rows": (
        over(lambda r: collision_members(r.links.select("qid", "entity_id"), ["qid"])),
        sql(
            "links",
            "SELECT l.qid, l.entity_id, g.group_size FROM links l JOIN (SELECT qid, "
            "COUNT(DISTINCT entity_id) AS group_size FROM links GROUP BY qid HAVING COUNT(DISTINCT entity_id) > 1) g "
            "USING (qid)",
        ),
    ),
    "agreement": (
        over(lambda r: profile.agreement(r.master, r.entities, FIELDS[1:])),
        sql(
            "master entities",
            "SELECT COUNT(*) AS total, "
            + ", ".join(
                f"COUNT(*) FILTER ({f}_l IS DISTINCT FROM {f}_r) AS {f}_diff" for f in FIELDS[1:]
            )
            + " FROM pairs",
            PAIR,
        ),
    ),
    "field_differences": (
        over(lambda r: profile.field_differences(r.master, r.entities, FIELDS[1:])),
        sql(
            "master entities",
            per_field(
                "SELECT entity_id, '{f}' AS field, {f}_l AS left_value, {f}_r AS right_value FROM pairs "
                "WHERE {f}_l IS DISTINCT FROM {f}_r",
                FIELDS[1:],
            ),
            PAIR,
        ),
    ),
    "record_matches": (
        over(lambda r: profile.record_matches(r.master, r.entities, FIELDS[1:])),
        sql(
            "master entities",
            f"SELECT COUNT(*) FILTER ({SAME}) AS matching, COUNT(*) FILTER (NOT ({SAME})) AS mismatching FROM pairs",
            PAIR,
        ),
    ),
    "match_by_type": (
        over(lambda r: profile.match_by_type(r.entities, r.master)),
        sql(
            "entities master",
            "SELECT entity_type, COUNT(*) AS rows_total, COUNT(*) FILTER (hit) AS rows_matching, "
            "COUNT(*) FILTER (NOT hit) AS rows_unmatched FROM (SELECT entity_type, "
            "entity_id IN (SELECT entity_id FROM master) AS hit FROM entities) GROUP BY entity_type",
        ),
    ),
    "type_contamination": (
        over(lambda r: profile.type_contamination(r.clubs)),
        sql(
            "clubs",
            "SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (entity_type IS NULL) AS null_type, "
            "COUNT(*) FILTER (TRIM(entity_type) = '') AS blank_type, "
            "COUNT(*) FILTER (TRIM(entity_type) <> '' AND entity_type <> 'player') AS other_type FROM clubs",
        ),
    ),
    "audit_summary": (
        over(
            lambda r: profile.audit_summary(
                profile.items_summary(r.links),
                relate.split_by_master(r.bridges, r.master),
                profile.type_contamination(r.clubs),
            )
        ),
        sql(
            "links bridges master clubs",
            "SELECT metric, value FROM (SELECT COUNT(*) AS entities, MAX(n) AS max_items, "
            "COUNT(*) FILTER (n >= 10) AS entities_10_plus, COUNT(*) FILTER (n >= 20) AS entities_20_plus "
            "FROM (SELECT COUNT(*) AS n FROM links GROUP BY entity_id)) "
            "UNPIVOT (value FOR metric IN (entities, max_items, entities_10_plus, entities_20_plus)) "
            "UNION ALL SELECT metric, value FROM (SELECT COUNT(*) FILTER (hit) AS rows_in_master, "
            "COUNT(*) FILTER (NOT hit) AS rows_outside, "
            "COUNT(DISTINCT CASE WHEN hit THEN entity_id END) AS entities_in_master, "
            "COUNT(DISTINCT CASE WHEN NOT hit THEN entity_id END) AS entities_outside "
            "FROM (SELECT entity_id, entity_id IN (SELECT entity_id FROM master) AS hit FROM bridges)) "
            "UNPIVOT (value FOR metric IN (rows_in_master, rows_outside, entities_in_master, entities_outside)) "
            "UNION ALL SELECT metric, value FROM (SELECT COUNT(*) AS total_rows, "
            "COUNT(*) FILTER (entity_type IS NULL) AS null_type, COUNT(*) FILTER (TRIM(entity_type) = '') AS blank_type, "
            "COUNT(*) FILTER (TRIM(entity_type) <> '' AND entity_type <> 'player') AS other_type FROM clubs) "
            "UNPIVOT (value FOR metric IN (total_rows, null_type, blank_type, other_type))",
        ),
    ),
    "top_k_clubs": (
        over(
            lambda r: ranking.top_k(
                r.clubs.select("entity_id", "observed_clubs", "first_observed_season").distinct(),
                [("observed_clubs", "desc"), ("entity_id", "asc"), ("first_observed_season", "asc")],
                100,
            )
        ),
        sql(
            "clubs",
            "SELECT DISTINCT entity_id, observed_clubs, first_observed_season FROM clubs "
            "ORDER BY observed_clubs DESC, entity_id, first_observed_season LIMIT 100",
        ),
    ),
    "sorted_report": (
        over(
            lambda r: ranking.sort_by(
                profile.value_distribution(r.master, "country"), [("n", "desc"), ("country", "asc_nulls_last")]
            )
        ),
        sql(
            "master",
            f"SELECT {bucket('country')} AS country, COUNT(*) AS n, "
            + pct("COUNT(*)", "SELECT COUNT(*) FROM master")
            + " AS pct FROM master GROUP BY 1 ORDER BY n DESC, country",
        ),
    ),
    "sample_of_other_types": (
        over(
            lambda r: ranking.sample_rows(
                r.clubs, F.col("entity_type") != "player", ["entity_id", "first_observed_season", "basis"], 25
            ).select("entity_id", "entity_type", "first_observed_season", "basis")
        ),
        sql(
            "clubs",
            "SELECT entity_id, entity_type, first_observed_season, basis FROM clubs WHERE entity_type <> 'player' "
            "ORDER BY entity_id, first_observed_season, basis LIMIT 25",
        ),
    ),
    "numbered_groups": (
        over(
            lambda r: ranking.number_groups(
                profile.duplicate_groups(r.links, ["qid"]), ["qid"]
            )
        ),
        sql(
            "links",
            "SELECT qid, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY qid) AS group_id FROM links "
            "GROUP BY qid HAVING COUNT(*) > 1",
        ),
    ),
    "id_minus": (
        over(lambda r: relate.id_minus(r.master, r.xids)),
        sql("master xids", "SELECT entity_id FROM master EXCEPT SELECT entity_id FROM xids"),
    ),
    "id_and": (
        over(lambda r: relate.id_and(r.master, r.overlay_aliases)),
        sql("master overlay_aliases", "SELECT entity_id FROM master INTERSECT SELECT entity_id FROM overlay_aliases"),
    ),
    "id_or": (
        over(lambda r: relate.id_or(r.xids, r.aliases, r.overlay_aliases)),
        sql(
            "xids aliases overlay_aliases",
            "SELECT entity_id FROM xids UNION SELECT entity_id FROM aliases UNION SELECT entity_id FROM overlay_aliases",
        ),
    ),
}
