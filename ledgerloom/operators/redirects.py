"""Redirects as an edge table: scope, chains, cycles, walks, and what both ends share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import as_text, clean_or_null, count_if, is_present, ladder
from ledgerloom.functions.names import norm_space
from ledgerloom.operators.collide import colliding, key_stats
from ledgerloom.operators.relate import ID, evidence_counts, ids_of, with_endpoints
from ledgerloom.operators.skew import key_counts, lookup_flag, lookup_join
from ledgerloom.operators.slices import cut
from ledgerloom.roles import ACTIVE, REDIRECTED, RETIRED


def redirect_scope(redirects: DataFrame, master: DataFrame, side: str = "either") -> DataFrame:
    """Edges with ``from_known`` and ``to_known``; keep those in scope.

    ``side``: ``from``, ``either`` or ``both`` ends in the master, or ``all``.
    """
    ids = ids_of(master)
    flagged = lookup_flag(redirects, ids, "from_id", "from_known")
    flagged = lookup_flag(flagged, ids, "to_id", "to_known", key_counts(redirects, ["to_id"]))
    source, target = F.col("from_known"), F.col("to_known")
    scope = {"from": source, "either": source | target, "both": source & target, "all": F.lit(True)}
    return flagged.where(scope[side])


def redirect_missing(scoped: DataFrame) -> DataFrame:
    """One row: edges, distinct ends, and edges and ends outside the master.

    A target that is not published at all (NULL) is counted apart from an unknown one.
    """
    source, target = F.col("from_known"), F.col("to_known")
    return scoped.agg(
        F.count("*").alias("edges"),
        count_if(source & target).alias("both_known"),
        F.count_distinct(F.col("from_id")).alias("sources"),
        F.count_distinct(F.col("to_id")).alias("targets"),
        count_if(~source).alias("edges_from_outside"),
        count_if(~target & F.col("to_id").isNotNull()).alias("edges_to_outside"),
        count_if(F.col("to_id").isNull()).alias("edges_unpublished"),
        F.count_distinct(F.when(~source, F.col("from_id"))).alias("sources_outside"),
        F.count_distinct(F.when(~target, F.col("to_id"))).alias("targets_outside"),
    )


def self_redirects(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("from_id") == F.col("to_id"))


def first_targets(edges: DataFrame) -> DataFrame:
    """The target that a walk follows: the least one of each source."""
    return edges.where(F.col("to_id").isNotNull()).groupBy("from_id").agg(
        F.min("to_id").alias("to_id")
    )


def redirect_chains(edges: DataFrame, include_self: bool = False) -> DataFrame:
    """Edges whose target is itself a source, with the target's own target."""
    steps = first_targets(edges)
    onward = steps.select(
        F.col("from_id").alias("to_id"), F.col("to_id").alias("target_redirects_to")
    )
    chained = lookup_join(steps, onward, "to_id", "inner", distinct=True)
    kept = chained if include_self else chained.where(F.col("from_id") != F.col("to_id"))
    return kept.select("from_id", "to_id", "target_redirects_to")


def redirect_cycles2(edges: DataFrame, include_self: bool = False) -> DataFrame:
    """Steps that lead straight back to where they came from."""
    chains = redirect_chains(edges, include_self)
    return chains.where(F.col("target_redirects_to") == F.col("from_id")).select(
        "from_id", "to_id"
    )


def redirect_walk(edges: DataFrame) -> DataFrame:
    """Where the walk from each source ends: ``from_id, terminal, hops, enters_cycle``.

    Pointer doubling: every round doubles the distance all walks have covered, so the
    number of rounds grows with the logarithm of the longest chain. A round in which no
    walk ends proves that the rest never will, for a finite walk of length L passes nodes
    whose own walks have every length below L. Each round is cut by a checkpoint.
    """
    steps = first_targets(edges)
    sources = steps.select(F.col("from_id").alias("to_id"), F.lit(False).alias("done"))
    state = cut(
        lookup_join(steps, sources, "to_id", "left", distinct=True).select(
            "from_id",
            F.col("to_id").alias("at"),
            F.lit(1).cast("long").alias("hops"),
            F.coalesce("done", F.lit(True)).alias("done"),
        )
    )
    open_walks = state.where(~F.col("done")).count()
    while open_walks:
        ahead = state.select(
            F.col("from_id").alias("at"),
            F.col("at").alias("next_at"),
            F.col("hops").alias("next_hops"),
            F.col("done").alias("next_done"),
        )
        walking = state.where(~F.col("done"))
        moved = lookup_join(walking, ahead, "at", "inner", distinct=True).select(
            "from_id",
            F.col("next_at").alias("at"),
            (F.col("hops") + F.col("next_hops")).alias("hops"),
            F.col("next_done").alias("done"),
        )
        state = cut(state.where(F.col("done")).unionByName(moved))
        still_open = state.where(~F.col("done")).count()
        if still_open == open_walks:
            break
        open_walks = still_open
    return state.select(
        "from_id",
        F.when(F.col("done"), F.col("at")).alias("terminal"),
        F.when(F.col("done"), F.col("hops")).alias("hops"),
        (~F.col("done")).alias("enters_cycle"),
    )


def redirect_fan_in(edges: DataFrame) -> DataFrame:
    """Targets with several sources."""
    stats = key_stats(edges.where(F.col("to_id").isNotNull()), ["to_id"], entity="from_id")
    return colliding(stats).select("to_id", F.col("n_entities").alias("sources"), "n_rows")


def fan_in_summary(edges: DataFrame) -> DataFrame:
    """One row: targets, targets with several sources, and the largest number of sources."""
    stats = key_stats(edges.where(F.col("to_id").isNotNull()), ["to_id"], entity="from_id")
    return stats.agg(
        F.count("*").alias("targets"),
        count_if(F.col("n_entities") > 1).alias("multi_source_targets"),
        F.coalesce(F.max("n_entities"), F.lit(0)).alias("max_sources"),
    )


# --- what both ends hold --------------------------------------------------------------------


def _xid_key(xids: DataFrame) -> DataFrame:
    parts = ["provider", "property", "external_id"]
    rows = xids.where(F.col("provider").isNotNull() & F.col("property").isNotNull())
    rows = rows.where(clean_or_null(F.col("external_id")).isNotNull())
    return rows.select(ID, F.concat_ws("\u001f", *[as_text(F.col(p)) for p in parts]).alias("key"))


def _ends(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("to_id").isNotNull()).select("from_id", "to_id").distinct()


def _met(edges: DataFrame, held: DataFrame) -> DataFrame:
    """Keys that both ends of a distinct edge hold, one row each.

    The source's keys are carried along its edges and looked up at the target, so no set
    of keys is ever held in memory, however many keys a node has.
    """
    carried = lookup_join(
        _ends(edges), held.withColumnRenamed(ID, "from_id"), "from_id", distinct=True
    )
    at_target = held.withColumnRenamed(ID, "to_id")
    on = ["to_id", *[c for c in held.columns if c != ID]]
    return lookup_join(carried, at_target, on, "left_semi", distinct=True)


def shared_keys(edges: DataFrame, xids: DataFrame) -> DataFrame:
    """The external keys that both ends of an edge hold, one row each."""
    return _met(edges, _xid_key(xids).distinct())


def redirect_detail(
    edges: DataFrame,
    master: DataFrame,
    links: DataFrame,
    xids: DataFrame,
    aliases: DataFrame,
    label_key: Callable[[Column], Column] = lambda c: norm_space(c, None),
) -> DataFrame:
    """Edges that start in the master, with both records and what the two ends share.

    One row per distinct edge; ``copies`` says how often the table has it.
    ``label_key`` is how labels are compared: as written, trimmed, folded, and so on.
    """
    qids = links.where(is_present(F.col("qid"))).select(ID, as_text(F.col("qid")).alias("key"))
    keys = _xid_key(xids)
    # keys of ids that lie on an edge: all else plays no part, and the rest reads them four times
    on_edge = edges.select(F.explode(F.array("from_id", "to_id")).alias(ID)).distinct()
    held = cut(
        qids.withColumn("what", F.lit("qid"))
        .unionByName(keys.withColumn("what", F.lit("xid")))
        .join(on_edge, ID, "left_semi")
        .distinct()
    )
    facts = evidence_counts(
        master.select(ID, "label", "status", "gender", label_key(F.col("label")).alias("label_key"))
        .withColumn("present", F.lit(True)),
        {
            "qid": held.where(F.col("what") == "qid"),
            "xid": held.where(F.col("what") == "xid"),
            "alias": aliases,
        },
    )
    columns = ["label", "status", "gender", "label_key", "present", "n_qid", "n_xid", "n_alias"]
    once = edges.groupBy("from_id", "to_id", "reason").agg(F.count("*").alias("copies"))
    ended = with_endpoints(once, facts, columns)
    for count in ("n_qid", "n_xid", "n_alias"):
        ended = ended.withColumn(f"to_{count}", F.coalesce(f"to_{count}", F.lit(0)))
    shared = _met(once, held).groupBy("from_id", "to_id").agg(
        count_if(F.col("what") == "qid").alias("shared_qids"),
        count_if(F.col("what") == "xid").alias("shared_xids"),
    )
    joined = ended.join(shared, ["from_id", "to_id"], "left").fillna(
        0, ["shared_qids", "shared_xids"]
    )
    return joined.select(
        "from_id",
        "to_id",
        "reason",
        "copies",
        "from_label",
        "from_status",
        "from_gender",
        "to_label",
        "to_status",
        "to_gender",
        F.col("to_id").isNotNull().alias("target_published"),
        F.coalesce("to_present", F.lit(False)).alias("target_in_master"),
        F.col("from_n_qid").alias("from_qids"),
        F.col("to_n_qid").alias("to_qids"),
        "shared_qids",
        F.col("from_n_xid").alias("from_xids"),
        F.col("to_n_xid").alias("to_xids"),
        "shared_xids",
        F.col("from_n_alias").alias("from_aliases"),
        F.col("to_n_alias").alias("to_aliases"),
        endpoint_relation(F.col("from_label_key"), F.col("to_label_key")).alias("label_relation"),
        _side_relation("qid", "same_qid", "different_qid").alias("qid_relation"),
        _side_relation("xid", "shared_exact_xid", "both_different_xids").alias("xid_relation"),
    )


def endpoint_relation(source: Column, target: Column) -> Column:
    return ladder(
        [(source.isNull() | target.isNull(), "null_label"), (source == target, "same_label")],
        "different_label",
    )


def _side_relation(what: str, shared: str, apart: str) -> Column:
    source, target = F.col(f"from_n_{what}") > 0, F.col(f"to_n_{what}") > 0
    return ladder(
        [
            (source & target & (F.col(f"shared_{what}s") > 0), shared),
            (source & target, apart),
            (source, "source_only"),
            (target, "target_only"),
        ],
        "neither",
    )


def endpoint_relations(detail: DataFrame, inside_only: bool = True) -> DataFrame:
    """Edges by the relation of labels, QIDs and external ids: ``field, value, n``.

    ``inside_only`` keeps the edges whose target is in the master as well.
    """
    kept = detail.where(F.col("target_in_master")) if inside_only else detail
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("field"), F.col(c).alias("value"))
            for c in ("label_relation", "qid_relation", "xid_relation")
        ]
    )
    return kept.select("copies", F.inline(entries)).groupBy("field", "value").agg(
        F.sum("copies").alias("n")
    )


def redirects_without_evidence(detail: DataFrame) -> DataFrame:
    """One row: edges of which neither end has a QID, or an external id."""
    def edges_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("copies"))), F.lit(0))

    return detail.agg(
        edges_where(F.lit(True)).alias("edges"),
        edges_where((F.col("from_qids") == 0) & (F.col("to_qids") == 0)).alias(
            "no_qid_either_side"
        ),
        edges_where((F.col("from_xids") == 0) & (F.col("to_xids") == 0)).alias(
            "no_xid_either_side"
        ),
    )


def status_transitions(edges: DataFrame, master: DataFrame) -> DataFrame:
    """Edges inside the master by the statuses of their two ends."""
    once = edges.groupBy("from_id", "to_id").agg(F.count("*").alias("n"))
    nodes = master.select(ID, "status", F.lit(True).alias("present"))
    inside = with_endpoints(once, nodes, ["status", "present"]).where(F.col("to_present"))
    return inside.groupBy(
        F.coalesce("from_status", F.lit("NULL")).alias("from_status"),
        F.coalesce("to_status", F.lit("NULL")).alias("to_status"),
    ).agg(F.sum("n").alias("n"))


def redirect_distributions(edges: DataFrame, master: DataFrame) -> DataFrame:
    """Reasons, statuses of distinct sources, statuses of distinct targets: ``field, value, n``."""
    reasons = edges.groupBy(F.coalesce("reason", F.lit("NULL")).alias("value")).agg(
        F.count("*").alias("n")
    )

    def statuses(end: str) -> DataFrame:
        nodes = ids_of(edges.select(end), end)
        known = master.select(
            ID, F.coalesce("status", F.lit("NULL")).alias("value")
        )
        joined = nodes.join(known, ID, "left")
        return joined.groupBy(
            F.coalesce("value", F.lit("missing_from_master")).alias("value")
        ).agg(F.count("*").alias("n"))

    def tagged(df: DataFrame, field: str) -> DataFrame:
        return df.select(F.lit(field).alias("field"), "value", "n")

    return (
        tagged(reasons, "reason")
        .unionByName(tagged(statuses("from_id"), "source_status"))
        .unionByName(tagged(statuses("to_id"), "target_status"))
    )


def status_consistency(master: DataFrame, edges: DataFrame) -> DataFrame:
    """Ten profiles of an entity's status against its part in redirects."""
    counted = evidence_counts(
        master,
        {
            "source": edges.select(F.col("from_id").alias(ID)),
            "target": edges.where(F.col("from_id").isNotNull()).select(F.col("to_id").alias(ID)),
        },
    )
    status, source = F.col("status"), F.col("has_source")
    redirected = F.coalesce(status == REDIRECTED, F.lit(False))
    return counted.select(
        ID,
        "label",
        "status",
        F.col("n_source").alias("redirect_source_count"),
        F.col("n_target").alias("redirect_target_count"),
        F.when(redirected == source, "consistent").otherwise("inconsistent").alias("consistency"),
        ladder(
            [
                (redirected & source, "redirected_with_source"),
                (redirected, "redirected_without_source"),
                ((status == ACTIVE) & source, "active_with_redirect_source"),
                ((status == RETIRED) & source, "retired_with_redirect_source"),
                (status.isNull() & source, "null_status_with_redirect_source"),
                (F.col("has_target"), "redirect_target"),
                (status == ACTIVE, "active_no_redirect_source"),
                (status == RETIRED, "retired_no_redirect_source"),
                (status.isNull(), "null_status_no_redirect_source"),
            ],
            "other",
        ).alias("profile"),
    )


