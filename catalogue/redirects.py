"""Redirects as an edge table, and links that are not published."""

from __future__ import annotations

from catalogue.profiles import bucket
from catalogue.registers import over, sql
from ledgerloom.operators import redirects, relate
from ledgerloom.operators.collide import class_counts
from ledgerloom.operators.listing import member_values

SCOPE = (
    "scoped AS (SELECT *, from_id IN (SELECT entity_id FROM master) AS from_known, COALESCE(to_id IN (SELECT entity_id FROM "
    "master), false) AS to_known FROM redirects)"
)
STEPS = "steps AS (SELECT from_id, MIN(to_id) AS to_id FROM redirects WHERE to_id IS NOT NULL GROUP BY 1)"
DETAIL_ROLES = "items redirects links bridges aliases"


def detail(r):
    xids = r.bridges.selectExpr(
        "entity_id", "provider", "namespace AS property", "external_id"
    )
    return redirects.redirect_detail(r.redirects, r.items, r.links, xids, r.aliases)


def side(what: str, shared: str, apart: str) -> str:
    return (
        f"CASE WHEN from_{what}s > 0 AND to_{what}s > 0 AND shared_{what}s > 0 THEN '{shared}' WHEN from_{what}s > 0 AND "
        f"to_{what}s > 0 THEN '{apart}' WHEN from_{what}s > 0 THEN 'source_only' WHEN to_{what}s > 0 THEN 'target_only' "
        f"ELSE 'neither' END AS {what}_relation"
    )


def held(what: str, pairs: str, end: str) -> str:
    return f"(SELECT COUNT(*) FROM {pairs} p WHERE p.entity_id = e.{end}_id) AS {end}_{what}s"


def shared(what: str, pairs: str) -> str:
    return (
        f"(SELECT COUNT(*) FROM {pairs} a JOIN {pairs} b USING (k) WHERE a.entity_id = e.from_id AND b.entity_id = e.to_id) "
        f"AS shared_{what}s"
    )


DETAIL = (
    "qp AS (SELECT DISTINCT entity_id, qid AS k FROM links)",
    "xp AS (SELECT DISTINCT entity_id, CONCAT(provider, '/', namespace, '/', external_id) AS k FROM bridges)",
    "once AS (SELECT from_id, to_id, reason, COUNT(*) AS copies FROM redirects GROUP BY ALL)",
    "det AS (SELECT *, "
    + side("qid", "same_qid", "different_qid")
    + ", "
    + side("xid", "shared_exact_xid", "both_different_xids")
    + " FROM (SELECT e.*, f.label AS from_label, f.status AS from_status, f.gender AS from_gender, t.label AS to_label, "
    "t.status AS to_status, t.gender AS to_gender, e.to_id IS NOT NULL AS target_published, t.entity_id IS NOT NULL AS "
    "target_in_master, CASE WHEN NULLIF(LOWER(TRIM(f.label)), '') IS NULL OR NULLIF(LOWER(TRIM(t.label)), '') IS NULL THEN "
    "'null_label' WHEN LOWER(TRIM(f.label)) = LOWER(TRIM(t.label)) THEN 'same_label' ELSE 'different_label' END AS "
    "label_relation, "
    + ", ".join(
        [
            held("qid", "qp", "from"),
            held("qid", "qp", "to"),
            held("xid", "xp", "from"),
            held("xid", "xp", "to"),
            "(SELECT COUNT(*) FROM aliases p WHERE p.entity_id = e.from_id) AS from_aliases",
            "(SELECT COUNT(*) FROM aliases p WHERE p.entity_id = e.to_id) AS to_aliases",
            shared("qid", "qp"),
            shared("xid", "xp"),
        ]
    )
    + " FROM once e JOIN items f ON f.entity_id = e.from_id LEFT JOIN items t ON t.entity_id = e.to_id))",
)

STATUS = (
    "counted AS (SELECT m.entity_id, m.label, m.status, (SELECT COUNT(*) FROM redirects WHERE from_id = m.entity_id) AS "
    "redirect_source_count, (SELECT COUNT(*) FROM redirects WHERE to_id = m.entity_id) AS redirect_target_count FROM "
    "master m), profiled AS (SELECT *, CASE WHEN COALESCE(status = 'redirected', false) = (redirect_source_count > 0) THEN "
    "'consistent' ELSE 'inconsistent' END AS consistency, CASE WHEN status = 'redirected' AND redirect_source_count > 0 THEN "
    "'redirected_with_source' WHEN status = 'redirected' THEN 'redirected_without_source' WHEN status = 'active' AND "
    "redirect_source_count > 0 THEN 'active_with_redirect_source' WHEN status = 'retired' AND redirect_source_count > 0 THEN "
    "'retired_with_redirect_source' WHEN status IS NULL AND redirect_source_count > 0 THEN "
    "'null_status_with_redirect_source' WHEN redirect_target_count > 0 THEN 'redirect_target' WHEN status = 'active' THEN "
    "'active_no_redirect_source' WHEN status = 'retired' THEN 'retired_no_redirect_source' WHEN status IS NULL THEN "
    "'null_status_no_redirect_source' ELSE 'other' END AS profile FROM counted)"
)
UNPUBLISHED_ROLES = "links overlay_aliases entities redirects"
UNPUBLISHED = (
    "outside AS (SELECT l.* EXCLUDE (inherited_count, inherited), e.status, e.label, e.gender, e.country, "
    "e.corroboration_grade, e.corroboration_count, e.source_tier_band, CASE WHEN e.entity_id IS NULL THEN 'entity_missing' "
    "ELSE 'entity_present' END AS entity_presence, COALESCE(r.reason, 'no_redirect') AS redirect_reason FROM links l LEFT "
    "JOIN entities e USING (entity_id) LEFT JOIN (SELECT from_id, MIN(reason) AS reason FROM redirects GROUP BY 1) r ON "
    "r.from_id = l.entity_id WHERE l.entity_id NOT IN (SELECT entity_id FROM overlay_aliases))"
)


def unpublished(r):
    """Links of customers that the partial table of published ids lacks."""
    links = r.links.drop("inherited_count", "inherited")
    return relate.unpublished_links(links, r.overlay_aliases, r.entities, r.redirects)


QUERIES = {
    "redirect_scope": (
        over(lambda r: redirects.redirect_scope(r.redirects, r.master)),
        sql("redirects master", "SELECT * FROM scoped WHERE from_known OR to_known", SCOPE),
    ),
    "redirect_missing": (
        over(lambda r: redirects.redirect_missing(redirects.redirect_scope(r.redirects, r.master, "all"))),
        sql(
            "redirects master",
            "SELECT COUNT(*) AS edges, COUNT(*) FILTER (from_known AND to_known) AS both_known, COUNT(DISTINCT from_id) AS "
            "sources, COUNT(DISTINCT to_id) AS targets, COUNT(*) FILTER (NOT from_known) AS edges_from_outside, COUNT(*) "
            "FILTER (NOT to_known AND to_id IS NOT NULL) AS edges_to_outside, COUNT(*) FILTER (to_id IS NULL) AS "
            "edges_unpublished, COUNT(DISTINCT CASE WHEN NOT from_known THEN from_id END) AS sources_outside, COUNT(DISTINCT "
            "CASE WHEN NOT to_known THEN to_id END) AS targets_outside FROM scoped",
            SCOPE,
        ),
    ),
    "self_redirects": (
        over(lambda r: redirects.self_redirects(r.redirects)),
        sql("redirects", "SELECT * FROM redirects WHERE from_id = to_id"),
    ),
    "redirect_chains": (
        over(lambda r: redirects.redirect_chains(r.redirects)),
        sql(
            "redirects",
            "SELECT a.from_id, a.to_id, b.to_id AS target_redirects_to FROM steps a JOIN steps b ON a.to_id = b.from_id "
            "WHERE a.from_id <> a.to_id",
            STEPS,
        ),
    ),
    "redirect_cycles2": (
        over(lambda r: redirects.redirect_cycles2(r.redirects, include_self=True)),
        sql(
            "redirects",
            "SELECT a.from_id, a.to_id FROM steps a JOIN steps b ON a.to_id = b.from_id AND b.to_id = a.from_id",
            STEPS,
        ),
    ),
    "redirect_walk": (
        over(lambda r: redirects.redirect_walk(r.redirects)),
        # targets are part sizes, 1 to 50, so a walk of more than 51 steps goes round in a cycle
        "WITH RECURSIVE "
        + sql(
            "redirects",
            "SELECT from_id, MAX(CASE WHEN s.f IS NULL THEN place END) AS terminal, MAX(CASE WHEN s.f IS NULL THEN hops END) AS "
            "hops, BOOL_AND(s.f IS NOT NULL) AS enters_cycle FROM walk LEFT JOIN (SELECT from_id AS f FROM steps) s ON place = "
            "s.f GROUP BY from_id",
            STEPS,
            "walk AS (SELECT from_id, to_id AS place, CAST(1 AS BIGINT) AS hops FROM steps UNION ALL SELECT w.from_id, s.to_id, "
            "w.hops + 1 FROM walk w JOIN steps s ON w.place = s.from_id WHERE w.hops < 55)",
        )[len("WITH "):],
    ),
    "redirect_fan_in": (
        over(lambda r: redirects.redirect_fan_in(r.redirects)),
        sql(
            "redirects",
            "SELECT to_id, COUNT(DISTINCT from_id) AS sources, COUNT(*) AS n_rows FROM redirects WHERE to_id IS NOT NULL "
            "GROUP BY 1 HAVING COUNT(DISTINCT from_id) > 1",
        ),
    ),
    "fan_in_summary": (
        over(lambda r: redirects.fan_in_summary(r.redirects)),
        sql(
            "redirects",
            "SELECT COUNT(*) AS targets, COUNT(*) FILTER (n > 1) AS multi_source_targets, MAX(n) AS max_sources FROM (SELECT "
            "COUNT(DISTINCT from_id) AS n FROM redirects WHERE to_id IS NOT NULL GROUP BY to_id)",
        ),
    ),
    "fan_in_sources": (
        over(lambda r: member_values(r.redirects.where("to_id IS NOT NULL"), ["to_id"], "from_id")),
        sql(
            "redirects",
            "SELECT DISTINCT to_id, CAST(from_id AS STRING) AS value FROM redirects WHERE to_id IS NOT NULL AND from_id "
            "IS NOT NULL",
        ),
    ),
    "redirect_detail": (
        over(detail),
        sql(DETAIL_ROLES, "SELECT * FROM det", *DETAIL),
    ),
    "endpoint_relations": (
        over(lambda r: redirects.endpoint_relations(detail(r))),
        sql(
            DETAIL_ROLES,
            "SELECT field, value, CAST(SUM(copies) AS BIGINT) AS n FROM (SELECT copies, label_relation, qid_relation, "
            "xid_relation FROM det WHERE target_in_master) UNPIVOT (value FOR field IN (label_relation, qid_relation, "
            "xid_relation)) GROUP BY ALL",
            *DETAIL,
        ),
    ),
    "redirects_without_evidence": (
        over(lambda r: redirects.redirects_without_evidence(detail(r))),
        sql(
            DETAIL_ROLES,
            "SELECT CAST(SUM(copies) AS BIGINT) AS edges, CAST(COALESCE(SUM(copies) FILTER (from_qids = 0 AND to_qids = 0), 0) AS "
            "BIGINT) AS no_qid_either_side, CAST(COALESCE(SUM(copies) FILTER (from_xids = 0 AND to_xids = 0), 0) AS BIGINT) AS "
            "no_xid_either_side FROM det",
            *DETAIL,
        ),
    ),
    "shared_keys": (
        over(
            lambda r: redirects.shared_keys(
                r.redirects,
                r.bridges.selectExpr("entity_id", "provider", "namespace AS property", "external_id"),
            )
            .groupBy("from_id", "to_id")
            .count()
            .withColumnRenamed("count", "n_keys")
        ),
        sql(
            "redirects bridges",
            "SELECT e.from_id, e.to_id, COUNT(*) AS n_keys FROM (SELECT DISTINCT from_id, to_id FROM redirects) e JOIN xp a ON "
            "a.entity_id = e.from_id JOIN xp b ON b.entity_id = e.to_id AND a.k = b.k GROUP BY ALL",
            DETAIL[1],
        ),
    ),
    "status_transitions": (
        over(lambda r: redirects.status_transitions(r.redirects, r.master)),
        sql(
            "redirects master",
            "SELECT COALESCE(f.status, 'NULL') AS from_status, COALESCE(t.status, 'NULL') AS to_status, COUNT(*) AS n FROM "
            "redirects r JOIN master f ON f.entity_id = r.from_id JOIN master t ON t.entity_id = r.to_id GROUP BY ALL",
        ),
    ),
    "redirect_distributions": (
        over(lambda r: redirects.redirect_distributions(r.redirects, r.master)),
        sql(
            "redirects master",
            "SELECT 'reason' AS field, COALESCE(reason, 'NULL') AS value, COUNT(*) AS n FROM redirects GROUP BY ALL "
            + " ".join(
                f"UNION ALL SELECT '{name}', CASE WHEN m.entity_id IS NULL THEN 'missing_from_master' ELSE COALESCE(m.status, "
                f"'NULL') END, COUNT(*) FROM (SELECT DISTINCT {end} AS entity_id FROM redirects WHERE {end} IS NOT NULL) e "
                "LEFT JOIN master m ON m.entity_id = e.entity_id GROUP BY ALL"
                for name, end in (("source_status", "from_id"), ("target_status", "to_id"))
            ),
        ),
    ),
    "status_consistency": (
        over(lambda r: redirects.status_consistency(r.master, r.redirects)),
        sql("master redirects", "SELECT * FROM profiled", STATUS),
    ),
    "status_profiles": (
        over(lambda r: class_counts(redirects.status_consistency(r.master, r.redirects), ["profile", "consistency"])),
        sql(
            "master redirects",
            "SELECT field, value, COUNT(*) AS n FROM (SELECT profile, consistency FROM profiled) UNPIVOT (value FOR field IN "
            "(profile, consistency)) GROUP BY ALL",
            STATUS,
        ),
    ),
    "unpublished_links": (
        over(unpublished),
        sql(UNPUBLISHED_ROLES, "SELECT * FROM outside", UNPUBLISHED),
    ),
    "unpublished_summary": (
        over(
            lambda r: relate.unpublished_summary(
                unpublished(r), ["entity_type", "status", "gender", "redirect_reason", "entity_presence"]
            )
        ),
        sql(
            UNPUBLISHED_ROLES,
            " UNION ALL ".join(
                f"SELECT '{c}' AS field, {bucket(c)} AS value, COUNT(*) AS n FROM outside GROUP BY ALL"
                for c in ("entity_type", "status", "gender", "redirect_reason", "entity_presence")
            ),
            UNPUBLISHED,
        ),
    ),
}
