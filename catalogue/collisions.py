"""Names, labels, aliases, QIDs and external ids that several entities share."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registers import over, sql
from ledgerloom.functions import names
from ledgerloom.operators import aliases, collide, listing, qids, xids
from ledgerloom.operators.profile import value_distribution
from ledgerloom.operators.slices import cut

# SQL forms of the name keys, right for text in Latin letters.
CONSERVATIVE = "TRIM(REGEXP_REPLACE(LOWER(STRIP_ACCENTS(COALESCE({}, ''))), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"
LABEL_KEY = "TRIM(REGEXP_REPLACE(LOWER(STRIP_ACCENTS(COALESCE({}, ''))), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
ALIAS_KEY = "TRIM(REGEXP_REPLACE(LOWER(STRIP_ACCENTS(COALESCE({}, ''))), '[^a-z0-9]+', ' ', 'g'))"
COMPACT = "REGEXP_REPLACE(STRIP_ACCENTS(LOWER(COALESCE({}, ''))), '[^a-z0-9]+', '', 'g')"
WORDS = "TRIM(REGEXP_REPLACE(LOWER(COALESCE({}, '')), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"

NAMED = f"named AS (SELECT *, {CONSERVATIVE.format('label')} AS normalized_name FROM items)"
KEYED = f"keyed AS (SELECT *, {LABEL_KEY.format('label')} AS normalized_label FROM items)"
GROUPS = (
    "names AS (SELECT normalized_name, COUNT(*) AS record_count FROM named GROUP BY 1 HAVING COUNT(*) > 1)"
)
ALIASES = (
    f"keyed AS (SELECT * FROM (SELECT entity_id, TRIM(alias) AS alias, {ALIAS_KEY.format('alias')} AS "
    "normalized_alias, kind, rank, language FROM aliases WHERE entity_id IN (SELECT entity_id FROM master)) "
    "WHERE alias <> '' AND normalized_alias <> '')"
)


def named(r):
    return collide.with_key(r.items, names.norm_conservative, "normalized_name")


def keyed_aliases(r):
    return aliases.keyed_aliases(r.aliases, r.master, names.norm_alias)


def order_rows(r, label_key=None):
    """Lines as external ids of orders, written once because the queries read them often."""
    return cut(xids.master_xids(r.order_xids, r.orders_master, label_key))


def conflicts_over(build):
    """A query over the external ids with word keys, and their conflicts."""
    def query(r):
        rows = order_rows(r, names.norm_words)
        return build(rows, xids.xid_conflicts(rows))

    return over(query)


def identity_over(build):
    """A query over the external ids with compact keys, their identity groups, the master."""
    def query(r):
        rows = order_rows(r, names.norm_compact)
        return build(rows, xids.xid_identity_groups(rows), r.orders_master)

    return over(query)


ROWS = (
    "held AS (SELECT x.entity_id, x.provider, x.property, x.external_id, x.rank, x.confidence, x.dob_check, "
    "x.qid, m.label, m.status, m.gender FROM order_xids x JOIN orders_master m USING (entity_id) "
    "WHERE TRIM(x.external_id) <> '')"
)


def one_or(low_high: str, none: str, one: str, many: str) -> str:
    return (
        f"CASE WHEN MIN({low_high}) IS NULL THEN '{none}' WHEN MIN({low_high}) = MAX({low_high}) "
        f"THEN '{one}' ELSE '{many}' END"
    )


def totals(source: str, keys: str, prefix: str) -> str:
    """Distinct keys, groups, memberships and entities of a collision, as one row."""
    return (
        f"(SELECT COUNT(*) AS {prefix}distinct_keys, COUNT(*) FILTER (n > 1) AS {prefix}groups, "
        f"CAST(COALESCE(SUM(n) FILTER (n > 1), 0) AS BIGINT) AS {prefix}memberships, "
        f"(SELECT COUNT(DISTINCT entity_id) FROM {source} WHERE ({keys}) IN (SELECT ({keys}) FROM {source} "
        f"GROUP BY {keys} HAVING COUNT(DISTINCT entity_id) > 1)) AS {prefix}entities "
        f"FROM (SELECT COUNT(DISTINCT entity_id) AS n FROM {source} GROUP BY {keys}))"
    )


CONFLICTS = (
    "exact AS (SELECT provider, property, external_id, COUNT(DISTINCT entity_id) AS n FROM held GROUP BY ALL), "
    "per AS (SELECT provider, external_id, COUNT(*) AS exact_keys, COUNT(*) FILTER (property <> '') AS properties, "
    "COUNT(*) FILTER (n > 1) AS exact_collision_keys FROM exact GROUP BY ALL), "
    "conflicts AS (SELECT provider, external_id, COUNT(DISTINCT entity_id) AS n_entities, properties, exact_keys, "
    "exact_collision_keys, CASE WHEN exact_collision_keys > 0 THEN 'exact_id_collision' WHEN properties > 1 THEN "
    "'cross_property_collision' ELSE 'provider_id_collision' END AS conflict_type, "
    + one_or(
        f"NULLIF({WORDS.format('label')}, '')",
        "different_normalized_labels",
        "same_normalized_label",
        "different_normalized_labels",
    )
    + " AS label_relation, "
    + one_or("gender", "same_or_missing_gender", "same_or_missing_gender", "different_gender")
    + " AS gender_relation, "
    + one_or("qid", "no_qid", "shared_qid", "different_qids")
    + " AS qid_relation, "
    + one_or("dob_check", "no_dob_status", "same_dob_status", "mixed_dob_status")
    + " AS dob_relation FROM held JOIN per USING (provider, external_id) GROUP BY ALL "
    "HAVING COUNT(DISTINCT entity_id) > 1)"
)
IDENTITY = (
    "ident AS (SELECT provider, external_id, COUNT(DISTINCT entity_id) AS n_entities, "
    "COUNT(DISTINCT NULLIF(property, '')) AS properties, "
    + one_or(
        COMPACT.format("label"),
        "different_normalized_label",
        "same_normalized_label",
        "different_normalized_label",
    )
    + " AS name_relation, "
    + one_or("LOWER(gender)", "same_or_missing_gender", "same_or_missing_gender", "different_gender")
    + " AS gender_relation, "
    + one_or("qid", "no_qid", "shared_qid", "different_qids")
    + " AS qid_relation, "
    + one_or("LOWER(dob_check)", "same_dob_status", "same_dob_status", "mixed_dob_status")
    + " AS dob_relation FROM held WHERE provider <> '' GROUP BY provider, external_id "
    "HAVING COUNT(DISTINCT entity_id) > 1)"
)


def counts_text(column: str, keys: str, source: str, null: str) -> str:
    """Per key: the distribution of a column as ``v=n; v=n``."""
    return (
        f"(SELECT {keys}, STRING_AGG(CONCAT(v, '=', n), '; ' ORDER BY v) AS {column}_counts FROM (SELECT {keys}, "
        f"COALESCE(CAST({column} AS STRING), '{null}') AS v, COUNT(*) AS n FROM {source} GROUP BY ALL) GROUP BY ALL)"
    )


EXACT = "provider, property, external_id"

QUERIES = {
    "name_collision_groups": (
        over(lambda r: collide.name_collision_groups(named(r))),
        sql("items", "SELECT * FROM names", NAMED, GROUPS),
    ),
    "name_collisions": (
        over(lambda r: collide.name_collisions(named(r))),
        sql("items", "SELECT * FROM named JOIN names USING (normalized_name)", NAMED, GROUPS),
    ),
    "collision_summary": (
        over(lambda r: collide.collision_summary(named(r))),
        sql(
            "items",
            "SELECT CAST(SUM(n) AS BIGINT) AS total_records, COUNT(*) AS distinct_names, "
            "COUNT(*) FILTER (n = 1) AS unique_names, COUNT(*) FILTER (n > 1) AS collision_groups, "
            "CAST(COALESCE(SUM(n) FILTER (n > 1), 0) AS BIGINT) AS records_in_groups, "
            "COALESCE(MAX(n) FILTER (n > 1), 0) AS largest_group "
            "FROM (SELECT COUNT(*) AS n FROM named GROUP BY normalized_name)",
            NAMED,
        ),
    ),
    "flatten_collisions": (
        over(lambda r: collide.flatten_collisions(named(r))),
        sql(
            "items",
            "SELECT normalized_name, record_count, CAST(entity_id AS STRING) AS entity_id, "
            + ", ".join(f"COALESCE({c}, 'NULL') AS {c}" for c in ("label", "status", "gender"))
            + ", COUNT(*) AS copies FROM named JOIN names USING (normalized_name) GROUP BY ALL",
            NAMED,
            GROUPS,
        ),
    ),
    "label_collisions": (
        over(lambda r: collide.label_collisions(r.items, names.norm_label)),
        sql(
            "items",
            f"SELECT * FROM {totals('lab', 'label', 'exact_')} CROSS JOIN {totals('nor', 'normalized_label', 'normalized_')}",
            KEYED,
            "lab AS (SELECT entity_id, label FROM items WHERE label <> '')",
            "nor AS (SELECT entity_id, normalized_label FROM keyed WHERE normalized_label <> '')",
        ),
    ),
    "label_collision_profile": (
        over(lambda r: collide.label_collision_profile(r.items, r.links, names.norm_label)),
        sql(
            "items links",
            "SELECT normalized_label, COUNT(DISTINCT entity_id) AS n_entities, "
            + one_or("NULLIF(label, '')", "different_label", "same_label", "different_label")
            + " AS label_relation, "
            + one_or("NULLIF(gender, '')", "no_gender", "same_gender", "different_gender")
            + " AS gender_relation, "
            + one_or("qid", "no_qid", "shared_qid", "different_qid")
            + " AS qid_relation FROM keyed LEFT JOIN links USING (entity_id) WHERE normalized_label <> '' "
            "GROUP BY normalized_label HAVING COUNT(DISTINCT entity_id) > 1",
            KEYED.replace("SELECT *", "SELECT entity_id, label, gender"),
        ),
    ),
    "label_collision_values": (
        over(
            lambda r: listing.member_values(
                collide.with_key(r.items, names.norm_label, "normalized_label").where("normalized_label <> ''"),
                ["normalized_label"],
                "label",
            )
        ),
        sql(
            "items",
            "SELECT DISTINCT normalized_label, label AS value FROM keyed WHERE normalized_label <> '' "
            "AND label IS NOT NULL",
            KEYED,
        ),
    ),
    "entity_label_profile": (
        over(lambda r: collide.entity_label_profile(r.items, r.links, names.norm_label)),
        sql(
            "items links",
            "SELECT k.*, CASE WHEN COALESCE(label, '') = '' THEN 'no_label' WHEN g.n IS NULL THEN 'unique_label' "
            "ELSE 'label_collision' END AS label_profile, CASE WHEN g.n IS NULL THEN 0 ELSE 1 END AS "
            "collision_group_count, COALESCE(q.n, 0) AS qid_count FROM keyed k LEFT JOIN (SELECT normalized_label, "
            "COUNT(*) AS n FROM keyed WHERE normalized_label <> '' GROUP BY 1 HAVING COUNT(*) > 1) g USING "
            "(normalized_label) LEFT JOIN (SELECT entity_id, COUNT(DISTINCT qid) AS n FROM links GROUP BY 1) q "
            "USING (entity_id)",
            KEYED,
        ),
    ),
    "label_gender_collisions": (
        over(lambda r: collide.label_gender_collisions(r.items, names.norm_ascii)),
        sql(
            "items",
            "SELECT normalized_label, COUNT(DISTINCT entity_id) AS n_entities, "
            + one_or("gender", "no_gender", "same_gender", "different_gender")
            + " AS gender_relation FROM keyed WHERE normalized_label <> '' GROUP BY 1 HAVING COUNT(DISTINCT entity_id) > 1",
            KEYED,
        ),
    ),
    "alias_collisions": (
        over(lambda r: aliases.alias_collisions(keyed_aliases(r))),
        sql(
            "aliases master",
            f"SELECT * FROM {totals('keyed', 'alias', 'exact_')} CROSS JOIN "
            f"{totals('keyed', 'normalized_alias', 'normalized_')}",
            ALIASES,
        ),
    ),
    "alias_collision_members": (
        over(lambda r: collide.pair_members(keyed_aliases(r), ["normalized_alias"])),
        sql(
            "aliases master",
            "SELECT normalized_alias, entity_id, COUNT(*) OVER (PARTITION BY normalized_alias) AS group_size FROM (SELECT "
            "DISTINCT normalized_alias, entity_id FROM keyed) QUALIFY group_size > 1",
            ALIASES,
        ),
    ),
    "alias_label_relations": (
        over(lambda r: aliases.alias_label_relations(keyed_aliases(r), r.master)),
        sql(
            "aliases master",
            "SELECT normalized_alias, COUNT(DISTINCT entity_id) AS n_entities, "
            + one_or("label", "same_label", "same_label", "different_label")
            + " AS label_relation FROM keyed JOIN master USING (entity_id) GROUP BY 1 "
            "HAVING COUNT(DISTINCT entity_id) > 1",
            ALIASES,
        ),
    ),
    "alias_collision_profile": (
        over(lambda r: aliases.alias_collision_profile(keyed_aliases(r), r.master, r.links, r.xids)),
        sql(
            "aliases master links xids",
            "SELECT normalized_alias, COUNT(DISTINCT g.entity_id) AS n_entities, "
            + one_or("COALESCE(m.label, '')", "different_label", "same_label", "different_label")
            + " AS label_relation, "
            + one_or("m.gender", "no_gender", "same_gender", "different_gender")
            + " AS gender_relation, "
            + one_or("l.qid", "no_qid", "shared_qid", "different_qids")
            + " AS qid_relation, CASE WHEN MIN(x.n) IS NULL THEN 'no_shared_external_id' WHEN normalized_alias IN "
            "(SELECT normalized_alias FROM mem JOIN xk USING (entity_id) GROUP BY normalized_alias, provider, "
            "external_id HAVING COUNT(DISTINCT entity_id) > 1) THEN 'shared_external_id' ELSE "
            "'different_external_ids' END AS xid_relation, "
            + one_or("m.status", "same_status", "same_status", "mixed_status")
            + " AS status_relation FROM mem g JOIN master m USING (entity_id) "
            "LEFT JOIN (SELECT DISTINCT entity_id, qid FROM links) l USING (entity_id) LEFT JOIN (SELECT entity_id, "
            "COUNT(*) AS n FROM xids GROUP BY 1) x USING (entity_id) GROUP BY normalized_alias",
            ALIASES,
            "mem AS (SELECT DISTINCT normalized_alias, entity_id FROM keyed WHERE normalized_alias IN (SELECT "
            "normalized_alias FROM keyed GROUP BY 1 HAVING COUNT(DISTINCT entity_id) > 1))",
            "xk AS (SELECT DISTINCT entity_id, provider, external_id FROM xids)",
        ),
    ),
    "entity_alias_profile": (
        over(lambda r: aliases.entity_alias_profile(keyed_aliases(r), r.master, r.links, r.xids)),
        sql(
            "aliases master links xids",
            "SELECT m.entity_id, m.label, m.status, m.gender, COALESCE(a.n, 0) AS alias_count, "
            "COALESCE(e.n, 0) AS exact_collisions, COALESCE(c.n, 0) AS normalized_collisions, "
            "COALESCE(q.n, 0) AS qid_count, COALESCE(x.n, 0) AS xid_count, "
            "CASE WHEN c.n > 0 THEN 'alias_identity_conflict' WHEN a.n > 0 THEN 'alias_only_no_collision' "
            "ELSE 'no_alias' END AS alias_profile, CASE WHEN a.p THEN 'yes' ELSE 'no' END AS provider_name_alias, "
            "CASE WHEN a.s THEN 'yes' ELSE 'no' END AS short_alias FROM master m "
            "LEFT JOIN (SELECT entity_id, COUNT(*) AS n, BOOL_OR(LOWER(kind) LIKE '%provider%') AS p, "
            "BOOL_OR(LEN(REGEXP_EXTRACT_ALL(alias, '[^\\s]+')) <= 2) AS s FROM keyed GROUP BY 1) a USING (entity_id) "
            "LEFT JOIN (SELECT entity_id, COUNT(DISTINCT alias) AS n FROM keyed WHERE alias IN (SELECT alias FROM "
            "keyed GROUP BY 1 HAVING COUNT(DISTINCT entity_id) > 1) GROUP BY 1) e USING (entity_id) "
            "LEFT JOIN (SELECT entity_id, COUNT(DISTINCT normalized_alias) AS n FROM keyed WHERE normalized_alias IN "
            "(SELECT normalized_alias FROM keyed GROUP BY 1 HAVING COUNT(DISTINCT entity_id) > 1) GROUP BY 1) c "
            "USING (entity_id) LEFT JOIN (SELECT entity_id, COUNT(DISTINCT qid) AS n FROM links GROUP BY 1) q "
            "USING (entity_id) LEFT JOIN (SELECT entity_id, COUNT(DISTINCT (provider, external_id)) AS n FROM xids "
            "GROUP BY 1) x USING (entity_id)",
            ALIASES,
        ),
    ),
    "alias_quality": (
        over(lambda r: aliases.alias_quality(r.aliases, r.master)),
        sql(
            "aliases master",
            "SELECT m.*, COALESCE(a.n, 0) AS alias_rows, COALESCE(a.u, 0) AS unique_aliases, COALESCE(a.k, 0) AS kinds, "
            "COALESCE(kind_counts, '') AS kind_counts, COALESCE(language_counts, '') AS language_counts FROM master m "
            "LEFT JOIN (SELECT entity_id, COUNT(*) AS n, COUNT(DISTINCT NULLIF(REGEXP_REPLACE(alias, '^\\s+|\\s+$', '', "
            "'g'), '')) AS u, COUNT(DISTINCT kind) AS k FROM aliases GROUP BY 1) a USING (entity_id) "
            f"LEFT JOIN {counts_text('kind', 'entity_id', 'aliases', '<NULL>')} USING (entity_id) "
            f"LEFT JOIN {counts_text('language', 'entity_id', 'aliases', '<NULL>')} USING (entity_id)",
        ),
    ),
    "qid_collisions": (
        over(lambda r: qids.qid_collisions(r.links)),
        sql(
            "links",
            "SELECT qid, COUNT(*) AS n_rows, COUNT(DISTINCT entity_id) AS n_entities FROM links GROUP BY qid "
            "HAVING COUNT(DISTINCT entity_id) > 1",
        ),
    ),
    "qid_collision_members": (
        over(
            lambda r: qids.qid_collision_rows(qids.master_links(r.links, r.master)).select(
                "qid", "entity_id", "confidence", "dob_check", "group_size"
            )
        ),
        sql(
            "links master",
            "SELECT l.qid, l.entity_id, l.confidence, l.dob_check, g.n AS group_size FROM typed l JOIN (SELECT qid, "
            "COUNT(DISTINCT entity_id) AS n FROM typed GROUP BY qid HAVING COUNT(DISTINCT entity_id) > 1) g USING (qid)",
            "typed AS (SELECT * FROM links WHERE entity_type = 'player' AND entity_id IN (SELECT entity_id FROM master))",
        ),
    ),
    "qid_collision_detail": (
        over(lambda r: qids.qid_collision_detail(r.links, r.items)),
        sql(
            "links items",
            "SELECT o.qid, o.entity_id, g.n AS group_size, o.link.confidence AS confidence, o.link.dob_check AS dob_check, "
            "i.label, i.status, i.gender, CASE WHEN g2.few THEN 'same_label' ELSE 'different_label' END AS label_relation "
            "FROM one o JOIN (SELECT qid, COUNT(*) AS n FROM one GROUP BY 1 HAVING COUNT(*) > 1) g USING (qid) "
            "JOIN items i USING (entity_id) JOIN (SELECT qid, COUNT(DISTINCT NULLIF(LOWER(TRIM(label)), '')) <= 1 AS few "
            "FROM one JOIN items USING (entity_id) GROUP BY 1) g2 USING (qid)",
            "one AS (SELECT qid, entity_id, ARG_MIN({'confidence': confidence, 'dob_check': dob_check}, (confidence, "
            "COALESCE(dob_check, ''))) AS link FROM links GROUP BY qid, entity_id)",
        ),
    ),
    "multi_qid_entities": (
        over(lambda r: qids.multi_qid_entities(r.links)),
        sql(
            "links",
            "SELECT entity_id, MIN(qid) AS qid_low, MAX(qid) AS qid_high, COUNT(DISTINCT qid) AS qid_count FROM links "
            "GROUP BY 1 HAVING COUNT(DISTINCT qid) > 1",
        ),
    ),
    "qid_disagreements": (
        over(lambda r: qids.qid_disagreements(r.links, r.xids)),
        sql(
            "links xids",
            "SELECT entity_id, COUNT(*) AS xid_qids, ANY_VALUE(k.n) AS link_qids, COUNT(*) FILTER (l.qid IS NULL) AS "
            "unlinked_qids FROM (SELECT DISTINCT entity_id, qid FROM xids) x JOIN (SELECT entity_id, COUNT(DISTINCT qid) "
            "AS n FROM links GROUP BY 1) k USING (entity_id) LEFT JOIN (SELECT DISTINCT entity_id, qid FROM links) l "
            "USING (entity_id, qid) GROUP BY entity_id HAVING COUNT(*) FILTER (l.qid IS NULL) > 0",
        ),
    ),
    "qid_profile": (
        over(lambda r: qids.qid_profile(r.links, r.xids, r.master)),
        sql(
            "links xids master",
            "SELECT m.entity_id, m.label, m.status, m.gender, l.* EXCLUDE (entity_id), COALESCE(x.n, 0) AS xid_qid_count "
            "FROM master m JOIN (SELECT entity_id, COUNT(*) AS link_rows, COUNT(DISTINCT qid) AS qid_count, "
            "COALESCE(STRING_AGG(DISTINCT dob_check, '|' ORDER BY dob_check), '') AS check_values FROM links GROUP BY 1) l "
            "USING (entity_id) LEFT JOIN (SELECT entity_id, COUNT(DISTINCT qid) AS n FROM xids GROUP BY 1) x USING (entity_id)",
        ),
    ),
    "link_confidences": (
        over(lambda r: listing.value_counts(r.links, ["entity_id"], "confidence")),
        sql("links", "SELECT entity_id, confidence AS value, COUNT(*) AS n FROM links GROUP BY ALL"),
    ),
    "entity_confidences": (
        over(lambda r: listing.value_counts(r.order_xids, ["entity_id"], "confidence")),
        sql("order_xids", "SELECT entity_id, confidence AS value, COUNT(*) AS n FROM order_xids GROUP BY ALL"),
    ),
    "qids_of_entities": (
        over(lambda r: listing.member_values(r.links, ["entity_id"], "qid")),
        sql(
            "links",
            "SELECT DISTINCT entity_id, qid AS value FROM links WHERE qid IS NOT NULL",
        ),
    ),
    "linked_items_per_entity": (
        over(lambda r: qids.linked_items_per_entity(r.xids, r.links, r.master)),
        sql(
            "xids links master",
            "SELECT items, COUNT(*) AS entities FROM (SELECT COUNT(*) AS items FROM xids WHERE entity_id IN (SELECT "
            "entity_id FROM links) AND entity_id IN (SELECT entity_id FROM master) GROUP BY entity_id) GROUP BY items",
        ),
    ),
    "linked_provider_coverage": (
        over(lambda r: qids.linked_provider_coverage(r.xids, r.links)),
        sql(
            "xids links",
            "SELECT provider, COUNT(DISTINCT entity_id) AS entities FROM xids WHERE entity_id IN (SELECT entity_id FROM "
            "links) GROUP BY provider",
        ),
    ),
    "xid_collisions": (
        over(lambda r: xids.xid_collisions(order_rows(r))),
        sql(
            "order_xids orders_master",
            "SELECT * FROM (SELECT provider, property, external_id, COUNT(*) AS n_rows, COUNT(DISTINCT entity_id) AS "
            "n_entities, COUNT(DISTINCT qid) AS qid_count, CASE WHEN COUNT(DISTINCT label) <= 1 THEN 'same_label' ELSE "
            "'different_label' END AS label_relation, CASE WHEN COUNT(DISTINCT qid) > 1 THEN 'qid_conflict' ELSE "
            "'qid_consistent' END AS qid_consistency FROM held GROUP BY ALL HAVING COUNT(DISTINCT entity_id) > 1) "
            + " ".join(
                f"JOIN {counts_text(c, EXACT, 'held', 'NULL')} USING ({EXACT})"
                for c in ("dob_check", "status", "gender")
            ),
            ROWS,
        ),
    ),
    "xid_collision_members": (
        over(lambda r: xids.collision_members(order_rows(r))),
        sql(
            "order_xids orders_master",
            f"SELECT {EXACT}, entity_id, COUNT(*) OVER (PARTITION BY {EXACT}) AS group_size FROM (SELECT DISTINCT {EXACT}, "
            "entity_id FROM held) QUALIFY group_size > 1",
            ROWS,
        ),
    ),
    "xid_collision_confidences": (
        over(lambda r: xids.collision_confidences(order_rows(r))),
        sql(
            "order_xids orders_master",
            f"SELECT {EXACT}, confidence AS value, COUNT(*) AS n FROM held WHERE ({EXACT}) IN (SELECT ({EXACT}) FROM held GROUP "
            f"BY {EXACT} HAVING COUNT(DISTINCT entity_id) > 1) GROUP BY ALL",
            ROWS,
        ),
    ),
    "xid_collision_totals": (
        over(lambda r: xids.xid_collision_totals(order_rows(r))),
        sql(
            "order_xids orders_master",
            f"SELECT * FROM {totals('held', EXACT, 'exact_')} CROSS JOIN "
            f"{totals('held', 'provider, external_id', 'provider_')}",
            ROWS,
        ),
    ),
    "xid_provider_collisions": (
        over(lambda r: xids.xid_provider_collisions(order_rows(r))),
        sql(
            "order_xids orders_master",
            "SELECT provider, external_id, COUNT(DISTINCT entity_id) AS n_entities, COUNT(DISTINCT property) AS properties, "
            "CASE WHEN COUNT(DISTINCT property) > 1 THEN 'property_split' ELSE 'same_property' END AS split_class "
            "FROM held GROUP BY ALL HAVING COUNT(DISTINCT entity_id) > 1",
            ROWS,
        ),
    ),
    "xid_collision_by_provider": (
        over(lambda r: xids.xid_collision_by_provider(order_rows(r))),
        sql(
            "order_xids orders_master",
            "SELECT h.provider, COUNT(*) AS n_rows, COUNT(DISTINCT h.entity_id) AS entities, "
            "COUNT(DISTINCT h.external_id) AS external_ids, COUNT(DISTINCT (h.property, h.external_id)) FILTER (g.n > 1) "
            "AS exact_collision_groups, COUNT(DISTINCT (h.property, h.external_id, h.entity_id)) FILTER (g.n > 1) AS "
            "collision_rows, COUNT(DISTINCT h.entity_id) FILTER (g.n > 1) AS collision_entities FROM held h JOIN "
            f"(SELECT {EXACT}, COUNT(DISTINCT entity_id) AS n FROM held GROUP BY ALL) g USING ({EXACT}) GROUP BY h.provider",
            ROWS,
        ),
    ),
    "xid_conflicts": (
        conflicts_over(lambda rows, conflicts: conflicts),
        sql("order_xids orders_master", "SELECT * FROM conflicts", ROWS, CONFLICTS),
    ),
    "xid_conflict_types": (
        conflicts_over(
            lambda rows, conflicts: value_distribution(conflicts.select("conflict_type"), "conflict_type").drop("pct")
        ),
        sql(
            "order_xids orders_master",
            "SELECT conflict_type, COUNT(*) AS n FROM conflicts GROUP BY 1",
            ROWS,
            CONFLICTS,
        ),
    ),
    "conflict_members": (
        conflicts_over(
            lambda rows, conflicts: xids.conflict_members(rows, conflicts).select(
                "provider", "external_id", "entity_id", "n_entities", "conflict_type"
            )
        ),
        sql(
            "order_xids orders_master",
            "SELECT DISTINCT provider, external_id, entity_id, n_entities, conflict_type FROM held JOIN conflicts "
            "USING (provider, external_id)",
            ROWS,
            CONFLICTS,
        ),
    ),
    "entity_conflicts": (
        conflicts_over(xids.entity_conflicts),
        sql(
            "order_xids orders_master",
            "SELECT entity_id, COUNT(*) AS provider_collision_groups, CAST(SUM(exact_collision_keys) AS BIGINT) AS "
            "exact_collision_groups, COUNT(*) FILTER (properties > 1) AS cross_property_groups, "
            "STRING_AGG(DISTINCT conflict_type, '|' ORDER BY conflict_type) AS conflict_types, "
            "STRING_AGG(DISTINCT provider, '|' ORDER BY provider) AS providers, COUNT(DISTINCT external_id) AS external_ids, "
            "CAST(SUM(n_entities - 1) AS BIGINT) AS other_memberships, MAX(n_entities) AS largest_group "
            "FROM (SELECT DISTINCT provider, external_id, entity_id FROM held) JOIN conflicts USING (provider, external_id) "
            "GROUP BY entity_id",
            ROWS,
            CONFLICTS,
        ),
    ),
    "exact_collision_entities": (
        conflicts_over(xids.exact_collision_entities),
        sql(
            "order_xids orders_master",
            f"SELECT (SELECT COUNT(DISTINCT entity_id) FROM held JOIN exact USING ({EXACT}) WHERE n > 1) AS exact_members, "
            "(SELECT COUNT(DISTINCT entity_id) FROM held JOIN conflicts USING (provider, external_id) "
            "WHERE exact_collision_keys > 0) AS group_members",
            ROWS,
            CONFLICTS,
        ),
    ),
    "xid_identity_groups": (
        identity_over(lambda rows, groups, master: groups),
        sql("order_xids orders_master", "SELECT * FROM ident", ROWS, IDENTITY),
    ),
    "entity_xid_identity": (
        identity_over(xids.entity_xid_identity),
        sql(
            "order_xids orders_master",
            "SELECT m.entity_id, m.label, m.status, m.gender, COALESCE(n, 0) AS conflict_group_count, "
            "COALESCE(ps, '') AS conflict_providers, COALESCE(es, 0) AS conflict_external_ids, COALESCE(nc, false) AS "
            "name_conflict, COALESCE(gc, false) AS gender_conflict, COALESCE(qc, false) AS qid_conflict, COALESCE(dc, false) "
            "AS dob_conflict, CASE WHEN n IS NULL THEN 'no_external_id_conflict' WHEN nc OR gc OR qc OR dc THEN "
            "'identity_conflict' ELSE 'shared_external_id' END AS identity_status FROM orders_master m LEFT JOIN (SELECT "
            "entity_id, COUNT(*) AS n, STRING_AGG(DISTINCT provider, ',' ORDER BY provider) AS ps, COUNT(DISTINCT "
            "external_id) AS es, BOOL_OR(name_relation = 'different_normalized_label') AS nc, BOOL_OR(gender_relation = "
            "'different_gender') AS gc, BOOL_OR(qid_relation = 'different_qids') AS qc, BOOL_OR(dob_relation = "
            "'mixed_dob_status') AS dc FROM (SELECT DISTINCT provider, external_id, entity_id FROM held) JOIN ident USING "
            "(provider, external_id) GROUP BY 1) USING (entity_id)",
            ROWS,
            IDENTITY,
        ),
    ),
    "xid_quality": (
        over(lambda r: xids.xid_quality(r.order_xids, r.orders_master)),
        sql(
            "order_xids orders_master",
            "SELECT m.*, COALESCE(n, 0) AS xid_rows, COALESCE(k, 0) AS xid_keys, COALESCE(p, 0) AS providers, "
            "COALESCE(q, 0) AS qid_count, "
            + ", ".join(
                f"COALESCE({c}_counts, '') AS {c}_counts"
                for c in ("provider", "provider_property", "dob_check")
            )
            + " FROM orders_master m LEFT JOIN (SELECT entity_id, COUNT(*) AS n, COUNT(DISTINCT (provider, property, "
            "external_id)) AS k, COUNT(DISTINCT provider) AS p, COUNT(DISTINCT qid) AS q FROM order_xids GROUP BY 1) "
            "USING (entity_id) "
            + " ".join(
                f"LEFT JOIN {counts_text(c, 'entity_id', 'pp', '<NULL>')} USING (entity_id)"
                for c in ("provider", "provider_property", "dob_check")
            ),
            "pp AS (SELECT *, CONCAT(provider, '|', property) AS provider_property FROM order_xids)",
        ),
    ),
    "collision_class_counts": (
        identity_over(
            lambda rows, groups, master: collide.class_counts(
                groups,
                ["name_relation", "gender_relation", "qid_relation", "dob_relation"],
            )
        ),
        sql(
            "order_xids orders_master",
            "SELECT field, value, COUNT(*) AS n FROM (SELECT name_relation, gender_relation, qid_relation, dob_relation "
            "FROM ident) UNPIVOT (value FOR field IN (name_relation, gender_relation, qid_relation, dob_relation)) GROUP BY ALL",
            ROWS,
            IDENTITY,
        ),
    ),
    "distinct_alias_words": (
        over(
            lambda r: keyed_aliases(r)
            .groupBy("kind")
            .agg(F.count_distinct("normalized_alias").alias("aliases"))
        ),
        sql(
            "aliases master",
            "SELECT kind, COUNT(DISTINCT normalized_alias) AS aliases FROM keyed GROUP BY kind",
            ALIASES,
        ),
    ),
}
