import pytest
from pyspark.sql import functions as F

from ledgerloom import roles
from ledgerloom.functions import exprs, names
from ledgerloom.operators import aliases, collide, dob, evidence, gender, profile, qids, redirects, relate, xids
from ledgerloom.plans import gates, master as build
from tests.conftest import by, rows

MASTER = "entity_id long, status string, label string, gender string, country string"
LINKS = "entity_id long, qid string, confidence double, dob_check string, entity_type string"
XIDS = (
    "entity_id long, provider string, property string, external_id string, rank int, confidence double, "
    "dob_check string, qid string"
)


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            (1, "active", "Ann Lee", "F", "DE"),
            (2, "active", "Ánn  LEE", None, " "),
            (3, "retired", "Bo", "M", None),
            (4, "redirected", "", None, "FR"),
            (5, None, None, "m", None),
            (6, "merged", "Cy", "M", None),
        ],
        MASTER,
    )


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "entity_id long")


def test_roles_fill_absent_columns(spark):
    df = spark.createDataFrame([(1, "x")], "PID long, Name string")
    got = roles.project_roles(df, "master", entity_id="PID", label="Name")
    assert got.columns == list(roles.ROLES["master"]) and got.first().gender is None
    assert roles.resolve_column(df, ["nothing", "name"]) == "Name"
    with pytest.raises(ValueError):
        roles.project_roles(df, "master", entity_id="missing")
    assert roles.profile_schema()["entity_id"].metadata == {"category": "identity", "required": True}


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(" a b\t", 1, 8), (None, 0, 0)], "t string, p long, n long")
    got = df.select(
        exprs.clean(F.col("t")).alias("c"),
        exprs.null_bucket(F.col("t"), "NONE").alias("b"),
        exprs.pct(F.col("p"), F.col("n")).alias("pct"),
        exprs.is_short_alias(F.col("t")).alias("s"),
        exprs.cardinality_class(F.array(F.col("t"))).alias("k"),
        exprs.unique_sorted(F.array(F.lit("b"), F.lit("A"), F.lit(" b "), F.lit(""))).alias("u"),
    ).collect()
    assert (got[0].c, got[1].c, got[1].b, got[0].pct, got[1].pct) == ("a b", "", "NONE", 12.5, 0.0)
    assert got[0].s and got[0].k == "single" and got[0].u == ["A", "b"]


def test_name_and_label_groups(spark, people, all_hot):
    links = spark.createDataFrame([(1, "Q1", None, None, "player"), (2, "Q1", None, None, "player")], LINKS)
    got = collide.label_collision_profile(people, links, names.norm_label).collect()
    assert [tuple(r) for r in got] == [("ann lee", 2, "different_label", "same_gender", "shared_qid")]
    profiles = by(collide.entity_label_profile(people, links, names.norm_label), "entity_id", "label_profile")
    assert profiles == {
        1: "label_collision", 2: "label_collision", 3: "unique_label", 4: "no_label", 5: "no_label", 6: "unique_label",
    }
    summary = collide.collision_summary(collide.with_key(people, names.norm_conservative, "normalized_name")).first()
    assert summary.unique_names + summary.records_in_groups == summary.total_records == 6


def test_alias_groups(spark, people, all_hot):
    table = spark.createDataFrame(
        [(1, "The Wall", "short"), (2, "the  wall!", "provider-name"), (3, "Solo one two", "short"), (9, "The Wall", "short")],
        "entity_id long, alias string, kind string",
    ).selectExpr("*", "1 AS rank", "CAST(NULL AS STRING) AS language")
    held = spark.createDataFrame(
        [(1, "p", "a", "X", 1, None, None, None), (2, "p", "b", "X", 1, None, None, None)], XIDS
    )
    links = spark.createDataFrame([(1, "Q1", None, None, "player")], LINKS)
    keyed = aliases.keyed_aliases(table, people, names.norm_alias)
    group = aliases.alias_collision_profile(keyed, people, links, held).first()
    assert (group.n_entities, group.xid_relation, group.qid_relation) == (2, "shared_external_id", "shared_qid")
    profile_of = by(aliases.entity_alias_profile(keyed, people, links, held), "entity_id", "alias_profile")
    assert (profile_of[1], profile_of[3], profile_of[4]) == (
        "alias_identity_conflict", "alias_only_no_collision", "no_alias",
    )


def test_xid_conflict_types(spark, people, all_hot):
    table = spark.createDataFrame(
        [
            (1, "p", "a", "same", 1, 0.5, "dob-agrees", "Q1"),
            (2, "p", "a", "same", 1, 0.5, "dob-unverified", "Q1"),
            (1, "p", "a", "split", 1, None, None, None),
            (3, "p", "b", "split", 1, None, None, "Q2"),
            (1, "p", "", "bare", 1, None, None, None),
            (3, "p", "b", "bare", 1, None, None, None),
            (6, "p", "a", "alone", 1, None, None, None),
            (99, "p", "a", "alone", 1, None, None, None),
        ],
        XIDS,
    )
    held = xids.master_xids(table, people, names.norm_words)
    conflicts = xids.xid_conflicts(held)
    assert by(conflicts, "external_id", "conflict_type") == {
        "same": "exact_id_collision", "split": "cross_property_collision", "bare": "provider_id_collision",
    }
    assert by(conflicts, "external_id", "dob_relation")["same"] == "mixed_dob_status"
    assert by(conflicts, "external_id", "qid_relation") == {
        "same": "shared_qid", "split": "shared_qid", "bare": "no_qid",
    }
    per = {r.entity_id: r for r in xids.entity_conflicts(held, conflicts).collect()}
    assert per[1].provider_collision_groups == 3 and per[1].other_memberships == 3
    compact = xids.master_xids(table, people, names.norm_compact)
    status = by(
        xids.entity_xid_identity(compact, xids.xid_identity_groups(compact), people), "entity_id", "identity_status"
    )
    assert status[6] == "no_external_id_conflict" and status[1] == "identity_conflict"


def test_qid_disagreement_needs_both_sides(spark):
    links = spark.createDataFrame([(1, "Q1"), (2, "Q2"), (3, "Q3")], "entity_id long, qid string")
    held = spark.createDataFrame([(1, "Q1"), (1, "Q9"), (2, "Q2"), (4, "Q4")], "entity_id long, qid string")
    assert rows(qids.qid_disagreements(links, held)) == [(1, 2, 1, 1)]


def test_country_ladder(spark, people):
    entities = spark.createDataFrame(
        [(1, "player", "DE"), (2, "Player ", "DE"), (3, "coach", "DE")], "entity_id long, entity_type string, country string"
    )
    got = evidence.country_evidence(
        people, entities, ids(spark).withColumn("qid", F.lit("Q")), ids(spark, 3), ids(spark, 6), ids(spark, 5)
    )
    assert by(got, "entity_id", "country_evidence") == {
        1: "country_master_and_entity", 2: "country_entity_only", 3: "external_id_pathway", 4: "country_master_only",
        5: "alias_pathway", 6: "alias_only",
    }


def test_dob_precedence(spark, people):
    links = spark.createDataFrame(
        [(1, "Q1", None, "DOB-AGREES", "player"), (2, "Q2", None, "odd", "player"), (3, "Q3", None, None, "player")], LINKS
    )
    held = spark.createDataFrame(
        [(1, "p", None, "x", 1, None, "dob-unverified", None), (6, "p", None, "x", 1, None, "dob-agrees", None)], XIDS
    )
    assert by(dob.dob_evidence(people, links, held), "entity_id", "dob_evidence_status") == {
        1: "dob_agrees", 2: "other_dob_status", 3: "qid_without_dob_status", 4: "no_dob_evidence",
        5: "no_dob_evidence", 6: "dob_agrees",
    }
    conflicts = by(dob.dob_conflicts(people, links, held), "entity_id", "classification")
    assert conflicts[1] == "mixed_dob_status" and conflicts[2] == "other" and conflicts[6] == "dob_agrees"
    # the source audit compares statuses as written, so the upper-case one is another value
    assert by(dob.dob_sources(people, links, held), "entity_id", "dob_classification")[1] == "dob_unverified_only"


def test_gender_classes_cover_everyone(spark, people):
    none = ids(spark)
    flags = gender.gender_flags(people, none.withColumn("qid", F.lit("Q")), ids(spark, 2), none, ids(spark, 4))
    entities = spark.createDataFrame([(3, "F"), (6, "m"), (6, "f")], "entity_id long, gender string")
    got = by(gender.gender_identity(flags, entities), "entity_id", "classification")
    assert got == {
        1: "gender_no_indirect_path", 2: "missing_gender_xid", 3: "gender_entity_conflict", 4: "missing_gender_alias",
        5: "gender_no_indirect_path", 6: "gender_no_indirect_path",
    }


EDGES = [(10, 11), (11, 12), (12, 13), (20, 21), (21, 20), (22, 20), (30, 30), (40, 13), (41, 13), (50, None), (10, 99)]


@pytest.fixture
def edges(spark):
    return spark.createDataFrame([(a, b, "r") for a, b in EDGES], "from_id long, to_id long, reason string")


def test_walk_ends_or_enters_a_cycle(spark, edges, all_hot):
    got = {r.from_id: (r.terminal, r.hops, r.enters_cycle) for r in redirects.redirect_walk(edges).collect()}
    assert got == {
        10: (13, 3, False), 11: (13, 2, False), 12: (13, 1, False), 40: (13, 1, False), 41: (13, 1, False),
        20: (None, None, True), 21: (None, None, True), 22: (None, None, True), 30: (None, None, True),
    }


def test_long_chain_and_hot_target(spark, all_hot):
    chain = [(i, i + 1) for i in range(70)] + [(1000 + i, 70) for i in range(200)]
    df = spark.createDataFrame([(a, b, "r") for a, b in chain], "from_id long, to_id long, reason string")
    got = {r.from_id: r.hops for r in redirects.redirect_walk(df).collect()}
    assert got[0] == 70 and got[1005] == 1 and len(got) == 270


def test_chains_cycles_and_fan_in(edges):
    assert (30, 30) not in [(r.from_id, r.to_id) for r in redirects.redirect_chains(edges).collect()]
    assert rows(redirects.redirect_cycles2(edges)) == [(20, 21), (21, 20)]
    assert rows(redirects.redirect_cycles2(edges, include_self=True)) == [(20, 21), (21, 20), (30, 30)]
    assert by(redirects.redirect_fan_in(edges), "to_id", "sources") == {13: 3, 20: 2}


def test_status_profiles(spark):
    statuses = {1: "redirected", 2: "redirected", 3: "active", 4: "retired", 5: None, 6: "active", 7: "active", 8: "retired", 9: None, 10: "merged"}
    people = spark.createDataFrame([(k, v, "n") for k, v in statuses.items()], "entity_id long, status string, label string")
    edges = spark.createDataFrame([(i, 6, "r") for i in (1, 3, 4, 5)], "from_id long, to_id long, reason string")
    assert list(by(redirects.status_consistency(people, edges).orderBy("entity_id"), "entity_id", "profile").values()) == [
        "redirected_with_source", "redirected_without_source", "active_with_redirect_source", "retired_with_redirect_source",
        "null_status_with_redirect_source", "redirect_target", "active_no_redirect_source", "retired_no_redirect_source",
        "null_status_no_redirect_source", "other",
    ]


def test_coverage_flags_add_up(spark, people):
    got = relate.coverage_two(people, ids(spark, 1, 2, 9)).first()
    assert (got.both_sides, got.left_only, got.right_only) == (2, 4, 1)
    cover = profile.coverage(people, ids(spark, 1, 2, 9)).first()
    assert cover.covered + cover.uncovered == cover.total == 6


def test_gates_fail_and_pass(spark, people):
    with pytest.raises(ValueError, match="label_missing"):
        gates.require_passed(gates.validate_rows(people))
    good = people.where("label <> ''")
    gates.require_passed(gates.validate_rows(good))
    gates.require_passed(gates.validate_preserved(good, good.repartition(2)))
    with pytest.raises(ValueError, match="records_lost"):
        gates.require_passed(gates.validate_preserved(people, good))
    assert gates.verdict(gates.validate_rows(people)).first().status == "FAIL"
    entities = good.selectExpr("*", "'player' AS entity_type", "'A' AS corroboration_grade", "1L AS corroboration_count", "'B' AS source_tier_band")
    extract = build.extract_master(good, entities)
    assert extract.columns == build.MASTER_COLUMNS and extract.count() == good.count()


def test_hot_entity_on_both_sides(spark):
    """One entity has 40 percent of the aliases and of the external ids."""
    names = [("hot", f"name {i}") for i in range(40)] + [(f"e{i}", f"name {i}") for i in range(60)]
    held = [("hot", "p", f"x{i}") for i in range(40)] + [(f"e{i}", "p", f"x{i if i % 2 else i + 100}") for i in range(60)]
    keyed = spark.createDataFrame(names, "entity_id string, normalized_alias string").withColumn("alias", F.col("normalized_alias"))
    ids = spark.createDataFrame(held, "entity_id string, provider string, external_id string")
    members = aliases.pair_members(keyed, ["normalized_alias"])
    got = {r.normalized_alias for r in aliases._held_in_common(members, ids).collect()}
    assert got == {f"name {i}" for i in range(40) if i % 2}
    labels = [("hot", "A")] + [(f"e{i}", "A" if i % 2 else "B") for i in range(60)]
    master = spark.createDataFrame(labels, "entity_id string, label string")
    told = {r.normalized_alias: r.label_relation for r in aliases.alias_label_relations(keyed, master).collect()}
    assert told == {f"name {i}": "same_label" if i % 2 else "different_label" for i in range(40)}
