"""Evidence classifiers: country, birth-date checks, gender, identity, clubs, provenance."""

from __future__ import annotations

from catalogue.profiles import FIELDS, bucket, present
from catalogue.registers import over, pct, sql
from ledgerloom.operators import dob, evidence, gender
from ledgerloom.operators.collide import class_counts
from ledgerloom.functions.names import norm_ascii

HAS = "entity_id IN (SELECT entity_id FROM {})"
TYPED = "LOWER(TRIM(entity_type)) = 'player'"
COUNTRY_IN = f"entity_id IN (SELECT entity_id FROM entities WHERE {TYPED} AND {present('country')})"


def has(*tables: str) -> str:
    return ", ".join(f"{HAS.format(t)} AS h_{t}" for t in tables)


def gender_flags(r):
    return gender.gender_flags(r.items, r.links, r.xids, r.aliases, r.overlay_aliases)


GENDER_FLAGS = (
    "flags AS (SELECT entity_id, status, label, NULLIF(LOWER(TRIM(gender)), '') AS gender, country, "
    f"{HAS.format('links')} AS has_qid, {HAS.format('xids')} AS has_xid, {HAS.format('aliases')} AS has_alias, "
    f"{HAS.format('overlay_aliases')} AS has_overlay_alias FROM items)"
)
GENDER_ROLES = "items links xids aliases overlay_aliases entities"
ASCII = "TRIM(REGEXP_REPLACE(LOWER(COALESCE(label, '')), '[^a-z0-9]+', ' ', 'g'))"
GENDER_IDENTITY = (
    "marked AS (SELECT f.*, "
    + ASCII
    + " AS normalized_label, CASE WHEN e.n = 1 THEN e.g END AS entity_gender FROM flags f LEFT JOIN (SELECT entity_id, "
    "COUNT(DISTINCT NULLIF(LOWER(TRIM(gender)), '')) AS n, MIN(NULLIF(LOWER(TRIM(gender)), '')) AS g FROM entities "
    "GROUP BY 1) e USING (entity_id)), "
    "shared AS (SELECT normalized_label FROM marked WHERE normalized_label <> '' GROUP BY 1 HAVING COUNT(*) > 1), "
    "judged AS (SELECT *, normalized_label IN (SELECT normalized_label FROM shared) AS label_collision, "
    "COALESCE(gender <> entity_gender, false) AS entity_gender_conflict FROM marked), "
    "classed AS (SELECT *, CASE WHEN gender IS NULL THEN CASE WHEN has_qid AND has_xid THEN 'missing_gender_qid_xid' "
    "WHEN has_qid THEN 'missing_gender_qid' WHEN has_xid THEN 'missing_gender_xid' WHEN has_alias OR has_overlay_alias "
    "THEN 'missing_gender_alias' ELSE 'missing_gender_no_path' END WHEN entity_gender_conflict THEN "
    "'gender_entity_conflict' WHEN label_collision THEN 'gender_with_label_collision' WHEN has_qid AND has_xid THEN "
    "'gender_qid_xid' WHEN has_qid THEN 'gender_qid' WHEN has_xid THEN 'gender_xid' ELSE 'gender_no_indirect_path' END "
    "AS classification FROM judged)"
)

CONSISTENCY_ROLES = "master entities links xids aliases overlay_aliases redirects"
CONSISTENCY = (
    "base AS (SELECT m.entity_id, m.label, LOWER(m.label) AS normalized_label, m.status, m.gender, g.g AS eg, "
    f"{HAS.format('links')} AS q, {HAS.format('xids')} AS x, {HAS.format('aliases')} AS a, "
    f"{HAS.format('overlay_aliases')} AS o, entity_id IN (SELECT entity_id FROM links WHERE dob_check IS NOT NULL AND "
    "LOWER(dob_check) NOT IN ('', 'unverified')) AS d, entity_id IN (SELECT from_id FROM redirects) AS s, "
    "entity_id IN (SELECT to_id FROM redirects WHERE to_id IS NOT NULL) AS t FROM master m LEFT JOIN (SELECT entity_id, "
    "MIN(gender) AS g FROM entities WHERE gender IS NOT NULL GROUP BY 1) g USING (entity_id)), "
    "judged AS (SELECT *, COALESCE(gender IS NOT NULL AND eg IS NOT NULL AND LOWER(gender) <> LOWER(eg), false) AS gc, "
    "COALESCE(status = 'redirected', false) <> s AS sc, s AND t AS bc, "
    "(gender IS NOT NULL)::INT + q::INT + x::INT + a::INT + o::INT + d::INT + s::INT + t::INT AS n FROM base), "
    "rows_ AS (SELECT entity_id, label, normalized_label, status, gender, "
    + ", ".join(
        f"CASE WHEN {c} THEN 'yes' ELSE 'no' END AS {name}"
        for c, name in (
            ("eg IS NOT NULL", "has_entity_gender"),
            ("q", "has_qid"),
            ("x", "has_external_id"),
            ("a", "has_alias"),
            ("o", "has_overlay_alias"),
            ("d", "has_dob_evidence"),
            ("s", "has_redirect_source"),
            ("t", "has_redirect_target"),
            ("gc", "gender_conflict"),
            ("sc", "redirect_status_conflict"),
            ("bc", "redirect_source_and_target"),
        )
    )
    + ", n AS pathway_count, CONCAT_WS('|', "
    + ", ".join(
        f"CASE WHEN {c} THEN '{name}' END"
        for c, name in (
            ("gender IS NOT NULL", "gender"),
            ("q", "qid"),
            ("x", "external_id"),
            ("a", "alias"),
            ("o", "overlay_alias"),
            ("d", "dob"),
            ("s", "redirect_source"),
            ("t", "redirect_target"),
        )
    )
    + ") AS pathways, CASE WHEN gc OR sc OR bc THEN 'inconsistent' ELSE 'consistent' END AS consistency, CONCAT_WS('|', "
    "CASE WHEN gc THEN 'gender_conflict' END, CASE WHEN sc THEN 'redirect_status_conflict' END, "
    "CASE WHEN bc THEN 'redirect_source_and_target' END) AS contradictions, CASE WHEN n = 0 THEN 'no_identity_evidence' "
    "WHEN gender IS NULL THEN 'identity_evidence_missing_gender' WHEN n >= 5 THEN 'strong_multi_pathway_identity' "
    "WHEN n >= 3 THEN 'multi_pathway_identity' WHEN n = 2 THEN 'two_pathway_identity' ELSE 'single_pathway_identity' END "
    "AS profile FROM judged)"
)


def consistency(r):
    return evidence.identity_consistency(
        r.master, r.entities, r.links, r.xids, r.aliases, r.overlay_aliases, r.redirects
    )




QUERIES = {
    "country_sources": (
        over(lambda r: evidence.country_sources(r.master, r.entities, r.aliases, r.overlay_aliases, r.xids)),
        sql(
            "master entities aliases overlay_aliases xids",
            "SELECT *, has_master_country::INT + has_entity_country::INT AS country_source_count, CASE WHEN "
            "has_master_country AND has_entity_country THEN 'master_and_entity' WHEN has_master_country THEN 'master_only' "
            "WHEN has_entity_country THEN 'entity_only' ELSE 'no_country' END AS country_source_status FROM (SELECT *, "
            f"{present('country')} AS has_master_country, {COUNTRY_IN} AS has_entity_country, "
            f"{HAS.format('aliases')} AS has_alias, {HAS.format('overlay_aliases')} AS has_overlay_alias, "
            f"{HAS.format('xids')} AS has_external_ids FROM master)",
        ),
    ),
    "country_evidence": (
        over(lambda r: evidence.country_evidence(r.master, r.entities, r.links, r.xids, r.aliases, r.overlay_aliases)),
        sql(
            "master entities links xids aliases overlay_aliases",
            "SELECT *, CASE WHEN has_master_country AND has_entity_country THEN 'country_master_and_entity' WHEN "
            "has_master_country THEN 'country_master_only' WHEN has_entity_country THEN 'country_entity_only' WHEN has_qid "
            "THEN 'qid_pathway' WHEN has_external_ids THEN 'external_id_pathway' WHEN has_overlay_aliases THEN "
            "'alias_pathway' WHEN has_aliases THEN 'alias_only' ELSE 'no_country_pathway' END AS country_evidence FROM "
            f"(SELECT *, {present('country')} AS has_master_country, {COUNTRY_IN} AS has_entity_country, "
            f"{HAS.format('links')} AS has_qid, {HAS.format('xids')} AS has_external_ids, {HAS.format('aliases')} AS "
            f"has_aliases, {HAS.format('overlay_aliases')} AS has_overlay_aliases FROM master)",
        ),
    ),
    "dob_evidence": (
        over(lambda r: dob.dob_evidence(r.items, r.links, r.xids)),
        sql(
            "items links xids",
            "SELECT m.entity_id, m.label, m.status, m.gender, COALESCE(q, false) AS has_qid, COALESCE(a, false) AS "
            "dob_agrees, COALESCE(u, false) AS dob_unverified, COALESCE(n, 0) AS dob_evidence_records, COALESCE(ss, '') AS "
            "dob_sources, COALESCE(vs, '') AS dob_status_values, CASE WHEN a THEN 'dob_agrees' WHEN u THEN 'dob_unverified' "
            "WHEN n > 0 THEN 'other_dob_status' WHEN q THEN 'qid_without_dob_status' ELSE 'no_dob_evidence' END AS "
            "dob_evidence_status FROM items m LEFT JOIN (SELECT entity_id, BOOL_OR(qid IS NOT NULL) AS q, "
            "COALESCE(BOOL_OR(dob_check = 'dob-agrees'), false) AS a, COALESCE(BOOL_OR(dob_check = 'dob-unverified'), false) AS u, "
            "COUNT(dob_check) AS n, STRING_AGG(DISTINCT src, '|' ORDER BY src) FILTER (dob_check IS NOT NULL) AS ss, "
            "STRING_AGG(DISTINCT dob_check, '|' ORDER BY dob_check) AS vs FROM (SELECT entity_id, 'overlay_links' AS src, "
            "dob_check, qid FROM links UNION ALL SELECT entity_id, provider, dob_check, NULL FROM xids) GROUP BY 1) USING "
            "(entity_id)",
        ),
    ),
    "dob_sources": (
        over(lambda r: dob.dob_sources(r.items, r.links, r.xids)),
        sql(
            "items links xids",
            "SELECT *, CASE WHEN NOT (bq OR bx) THEN 'no_dob_evidence' WHEN ag AND un THEN 'mixed_dob_status' WHEN ag THEN "
            "'dob_agrees' WHEN un THEN 'dob_unverified_only' ELSE 'other' END AS dob_classification, CASE WHEN bq AND bx "
            "THEN 'qid_and_xid' WHEN bq THEN 'qid_only' WHEN bx THEN 'xid_only' ELSE 'none' END AS dob_evidence_pathway, "
            "CASE WHEN NOT (bq OR bx) THEN 'no_dob_evidence' WHEN provider_count = 0 THEN 'no_provider' WHEN provider_count "
            "= 1 THEN 'single_provider' ELSE 'multiple_providers' END AS provider_support_class FROM (SELECT *, "
            "qid_dob_agrees + qid_dob_unverified > 0 AS bq, xid_dob_agrees + xid_dob_unverified > 0 AS bx, "
            "qid_dob_agrees + xid_dob_agrees > 0 AS ag, qid_dob_unverified + xid_dob_unverified > 0 AS un FROM (SELECT "
            "m.entity_id, m.label, m.status, "
            + ", ".join(
                f"COALESCE({c}, 0) AS {c}"
                for s in ("qid", "xid")
                for c in (f"{s}_rows", f"{s}_dob_agrees", f"{s}_dob_unverified", f"{s}_other_dob_status")
            )
            + ", COALESCE(provider_count, 0) AS provider_count FROM items m "
            + " ".join(
                f"LEFT JOIN (SELECT entity_id, COUNT(*) AS {s}_rows, COUNT(*) FILTER (dob_check = 'dob-agrees') AS "
                f"{s}_dob_agrees, COUNT(*) FILTER (dob_check = 'dob-unverified') AS {s}_dob_unverified, COUNT(*) FILTER "
                f"(COALESCE(dob_check, '') NOT IN ('dob-agrees', 'dob-unverified')) AS {s}_other_dob_status"
                + (", COUNT(DISTINCT provider) AS provider_count" if s == "xid" else "")
                + f" FROM {t} GROUP BY 1) USING (entity_id)"
                for s, t in (("qid", "links"), ("xid", "xids"))
            )
            + "))",
        ).replace("SELECT *, CASE WHEN NOT", "SELECT * EXCLUDE (bq, bx, ag, un), CASE WHEN NOT", 1),
    ),
    "dob_by_provider": (
        over(lambda r: dob.dob_by_provider(r.order_xids, r.orders_master)),
        sql(
            "order_xids orders_master",
            "SELECT provider, COUNT(DISTINCT entity_id) AS entities, "
            "COUNT(DISTINCT CASE WHEN dob_check = 'dob-agrees' THEN entity_id END) AS dob_agrees, "
            "COUNT(DISTINCT CASE WHEN dob_check = 'dob-unverified' THEN entity_id END) AS dob_unverified, "
            "COUNT(DISTINCT CASE WHEN COALESCE(dob_check, '') NOT IN ('dob-agrees', 'dob-unverified') THEN entity_id END) "
            "AS other FROM order_xids WHERE entity_id IN (SELECT entity_id FROM orders_master) GROUP BY provider",
        ),
    ),
    "dob_conflicts": (
        over(lambda r: dob.dob_conflicts(r.items, r.links, r.xids)),
        sql(
            "items links xids",
            "SELECT m.entity_id, m.label, m.status, COALESCE(n, 0) AS evidence_rows, COALESCE(nq, 0) AS qid_evidence, "
            "COALESCE(nx, 0) AS external_id_evidence, COALESCE(na, 0) AS agrees_count, COALESCE(nu, 0) AS unverified_count, "
            "COALESCE(ps, '') AS providers, COALESCE(np, 0) AS provider_count, COALESCE(pa, '') AS agrees_providers, "
            "COALESCE(pu, '') AS unverified_providers, CASE WHEN n IS NULL THEN 'no_dob_evidence' WHEN na > 0 AND nu > 0 "
            "THEN 'mixed_dob_status' WHEN na > 0 THEN 'dob_agrees' WHEN nu > 0 THEN 'dob_unverified_only' ELSE 'other' END "
            "AS classification, COALESCE(na > 0 AND nu > 0, false) AS is_conflict FROM items m LEFT JOIN (SELECT entity_id, "
            "COUNT(*) AS n, COUNT(*) FILTER (side = 'q') AS nq, COUNT(*) FILTER (side = 'x') AS nx, COUNT(*) FILTER "
            "(dob_check = 'dob-agrees') AS na, COUNT(*) FILTER (dob_check = 'dob-unverified') AS nu, STRING_AGG(DISTINCT p, "
            "'|' ORDER BY p) AS ps, COUNT(DISTINCT p) AS np, STRING_AGG(DISTINCT p, '|' ORDER BY p) FILTER (dob_check = "
            "'dob-agrees') AS pa, STRING_AGG(DISTINCT p, '|' ORDER BY p) FILTER (dob_check = 'dob-unverified') AS pu FROM "
            "(SELECT entity_id, 'q' AS side, 'wikidata' AS p, dob_check FROM links UNION ALL SELECT entity_id, 'x', provider, "
            "dob_check FROM xids) GROUP BY 1) USING (entity_id)",
        ),
    ),
    "gender_profile": (
        over(lambda r: gender.gender_profile(gender_flags(r))),
        sql(
            GENDER_ROLES,
            "SELECT *, CASE WHEN gender IS NOT NULL AND has_qid AND has_xid THEN 'gender_qid_xid' WHEN gender IS NOT NULL "
            "AND has_qid THEN 'gender_qid' WHEN gender IS NOT NULL AND has_xid THEN 'gender_xid' WHEN gender IS NOT NULL AND "
            "has_alias THEN 'gender_alias' WHEN gender IS NOT NULL THEN 'gender_only' WHEN has_qid AND has_xid THEN "
            "'qid_xid_no_gender' WHEN has_qid THEN 'qid_no_gender' WHEN has_xid THEN 'xid_no_gender' WHEN has_alias OR "
            "has_overlay_alias THEN 'alias_no_gender' ELSE 'no_gender_evidence' END AS gender_profile FROM flags",
            GENDER_FLAGS,
        ),
    ),
    "gender_identity": (
        over(lambda r: gender.gender_identity(gender_flags(r), r.entities, norm_ascii)),
        sql(GENDER_ROLES, "SELECT * FROM classed", GENDER_FLAGS, GENDER_IDENTITY),
    ),
    "gender_classes": (
        over(lambda r: class_counts(gender.gender_identity(gender_flags(r), r.entities), ["classification"])),
        sql(
            GENDER_ROLES,
            "SELECT 'classification' AS field, classification AS value, COUNT(*) AS n FROM classed GROUP BY ALL",
            GENDER_FLAGS,
            GENDER_IDENTITY,
        ),
    ),
    "missing_gender_paths": (
        over(lambda r: gender.missing_gender_paths(gender_flags(r))),
        sql(
            GENDER_ROLES,
            "SELECT COUNT(*) AS missing_gender, COUNT(*) FILTER (has_qid) AS with_qid, COUNT(*) FILTER (has_xid) AS with_xid, "
            "COUNT(*) FILTER (has_alias OR has_overlay_alias) AS with_alias, COUNT(*) FILTER (has_qid OR has_xid OR has_alias "
            "OR has_overlay_alias) AS with_any_path FROM flags WHERE gender IS NULL",
            GENDER_FLAGS,
        ),
    ),
    "identity_evidence": (
        over(lambda r: evidence.identity_evidence(r.items, r.links, r.xids, r.aliases, r.overlay_aliases)),
        sql(
            "items links xids aliases overlay_aliases",
            "SELECT * EXCLUDE (q, x, a, o), CASE WHEN NOT (q OR x OR a OR o OR has_gender OR has_country) THEN 'none' WHEN q "
            "AND x AND a THEN 'qid_xid_alias' WHEN q AND x THEN 'qid_xid' WHEN q AND a THEN 'qid_alias' WHEN x AND a THEN "
            "'xid_alias' WHEN q THEN 'qid_only' WHEN x THEN 'xid_only' WHEN a THEN 'alias_only' WHEN has_gender THEN "
            "'gender_only' ELSE 'other' END AS evidence_profile, q OR x OR a OR o AS any_indirect FROM (SELECT *, "
            "qid_count > 1 AS qid_conflict, qid_count > 0 AS q, external_id_count > 0 AS x, alias_count > 0 AS a, "
            "overlay_alias_count > 0 AS o FROM (SELECT m.*, COALESCE(l.n, 0) AS qid_count, COALESCE(x.n, 0) AS "
            "external_id_count, COALESCE(x.p, 0) AS provider_count, m.entity_id IN (SELECT entity_id FROM xids WHERE "
            "(provider, property, external_id) IN (SELECT (provider, property, external_id) FROM xids WHERE entity_id IN "
            "(SELECT entity_id FROM items) GROUP BY provider, property, external_id HAVING COUNT(DISTINCT entity_id) > 1)) "
            "AS external_id_collision, COALESCE(a.n, 0) AS alias_count, COALESCE(o.n, 0) AS overlay_alias_count, "
            f"{present('m.gender')} AS has_gender, {present('m.country')} AS has_country FROM items m "
            "LEFT JOIN (SELECT entity_id, COUNT(DISTINCT qid) AS n FROM links GROUP BY 1) l USING (entity_id) "
            "LEFT JOIN (SELECT entity_id, COUNT(*) AS n, COUNT(DISTINCT provider) AS p FROM xids GROUP BY 1) x USING (entity_id) "
            "LEFT JOIN (SELECT entity_id, COUNT(*) AS n FROM aliases GROUP BY 1) a USING (entity_id) "
            "LEFT JOIN (SELECT entity_id, COUNT(*) AS n FROM overlay_aliases GROUP BY 1) o USING (entity_id)))",
        ),
    ),
    "redirect_roles": (
        over(lambda r: evidence.redirect_roles(r.master, r.redirects)),
        sql(
            "master redirects",
            "SELECT *, has_redirect_source AND has_redirect_target AS both_redirect_roles FROM (SELECT *, entity_id IN (SELECT "
            "from_id FROM redirects) AS has_redirect_source, entity_id IN (SELECT to_id FROM redirects WHERE to_id IS NOT "
            "NULL) AS has_redirect_target FROM master)",
        ),
    ),
    "identity_consistency": (
        over(consistency),
        sql(CONSISTENCY_ROLES, "SELECT * FROM rows_", CONSISTENCY),
    ),
    "consistency_classes": (
        over(lambda r: class_counts(consistency(r), ["profile", "consistency", "contradictions"])),
        sql(
            CONSISTENCY_ROLES,
            "SELECT field, value, COUNT(*) AS n FROM (SELECT profile, consistency, contradictions FROM rows_) UNPIVOT (value "
            "FOR field IN (profile, consistency, contradictions)) GROUP BY ALL",
            CONSISTENCY,
        ),
    ),
    "field_sources": (
        over(lambda r: evidence.field_sources(r.master)),
        sql(
            "master",
            "SELECT *, "
            + ", ".join(
                f"CASE WHEN {f} IS NULL THEN 'missing' ELSE 'players' END AS {f}_source" for f in ("gender", "country")
            )
            + " FROM master",
        ),
    ),
    "field_source_summary": (
        over(lambda r: evidence.field_source_summary(r.master, r.entities, FIELDS[1:])),
        sql(
            "master entities",
            " UNION ALL ".join(
                f"SELECT '{f}' AS field, (SELECT COUNT(*) FROM master WHERE {present(f)}) AS present, "
                f"(SELECT COUNT(*) FROM master WHERE NOT {present(f)}) AS missing, "
                + pct(f"(SELECT COUNT(*) FROM master WHERE {present(f)})", "SELECT COUNT(*) FROM master")
                + f" AS coverage_pct, COUNT(*) FILTER ({present('e.' + f)}) AS entity_present, "
                f"COUNT(*) FILTER (m.{f} IS NOT DISTINCT FROM e.{f}) AS matching, "
                f"COUNT(*) FILTER (m.{f} IS DISTINCT FROM e.{f}) AS different FROM master m JOIN entities e USING (entity_id)"
                for f in FIELDS[1:]
            ),
        ),
    ),
    "club_evidence": (
        over(lambda r: evidence.club_evidence(r.clubs, r.master)),
        sql(
            "clubs master",
            "SELECT c.*, m.label, m.status, m.gender, c.first_observed_season IS NOT NULL AND c.last_observed_season IS NOT "
            "NULL AS has_season_span FROM clubs c JOIN master m USING (entity_id)",
        ),
    ),
    "relationship_kinds": (
        over(lambda r: evidence.relationship_kinds(r.relationships, r.master)),
        sql(
            "relationships master",
            f"SELECT {bucket('kind')} AS kind, COUNT(*) AS n, COUNT(*) FILTER (f) AS from_master, COUNT(*) FILTER (t) AS "
            "to_master FROM (SELECT kind, from_id IN (SELECT entity_id FROM master) AS f, to_id IN (SELECT entity_id FROM "
            "master) AS t FROM relationships) WHERE f OR t GROUP BY 1",
        ),
    ),
    "entity_completeness": (
        over(lambda r: evidence.entity_completeness(r.items, r.entities)),
        sql(
            "items entities",
            "SELECT COUNT(*) FILTER (m AND NOT e) AS missing_from_entities, COUNT(*) FILTER (e AND NOT m) AS "
            "missing_from_master, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_entity_rows, COUNT(*) FILTER (m AND e) "
            "AS quality_rows FROM (SELECT i.entity_id IS NOT NULL AS m, t.entity_id IS NOT NULL AS e, t.n FROM (SELECT "
            "DISTINCT entity_id FROM items) i FULL JOIN (SELECT entity_id, COUNT(*) AS n FROM entities WHERE entity_type = "
            "'player' GROUP BY 1) t ON i.entity_id = t.entity_id)",
        ),
    ),
    "identity_quality": (
        over(
            lambda r: evidence.identity_quality(
                r.entities,
                ["corroboration_grade", "corroboration_count", "source_tier_band", "status", "gender"],
            )
        ),
        sql(
            "entities",
            " UNION ALL ".join(
                f"SELECT '{c}' AS field, {bucket(c)} AS value, COUNT(*) AS n FROM entities GROUP BY 2"
                for c in ("corroboration_grade", "corroboration_count", "source_tier_band", "status", "gender")
            ),
        ),
    ),
    "evidence_totals": (
        over(
            lambda r: evidence.evidence_totals(
                {"links": r.links, "xids": r.xids, "aliases": r.aliases, "clubs": r.clubs}, r.master
            )
        ),
        sql(
            "links xids aliases clubs master",
            " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, COUNT(DISTINCT CASE WHEN entity_id IN (SELECT entity_id "
                f"FROM master) THEN entity_id END) AS entities FROM {t}"
                for t in ("links", "xids", "aliases", "clubs")
            ),
        ),
    ),
}
