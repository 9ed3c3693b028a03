"""Aliases shared by several entities, and the alias quality of each entity."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.exprs import (
    clean,
    clean_or_null,
    ends,
    is_provider_name,
    is_short_alias,
    ladder,
    merged_ends,
    relation,
    yes_no,
)
from ledgerloom.operators.collide import (
    colliding,
    collision_totals,
    key_stats,
    pair_members,
    relation_of,
)
from ledgerloom.operators.listing import value_counts_text
from ledgerloom.operators.profile import entities_with
from ledgerloom.operators.relate import ID, restrict_to_master, value_count, value_marks
from ledgerloom.operators.slices import cut
from ledgerloom.operators.skew import beside, key_counts, lookup_join

Key = Callable[[Column], Column]


def keyed_aliases(aliases: DataFrame, master: DataFrame, key: Key) -> DataFrame:
    """Aliases of master entities that are not blank, as written and normalized."""
    rows = restrict_to_master(aliases, master).withColumn("alias", clean(F.col("alias")))
    rows = rows.where(F.col("alias") != "")
    return rows.withColumn("normalized_alias", key(F.col("alias"))).where(
        F.col("normalized_alias") != ""
    )


def alias_collisions(keyed: DataFrame) -> DataFrame:
    """One row: groups, memberships and entities for aliases as written and normalized."""
    exact = collision_totals(keyed.select(ID, "alias").distinct(), ["alias"], "exact_")
    normal = collision_totals(
        keyed.select(ID, "normalized_alias").distinct(), ["normalized_alias"], "normalized_"
    )
    return beside(exact, normal)


def alias_label_relations(keyed: DataFrame, master: DataFrame) -> DataFrame:
    """Colliding aliases by whether their entities all carry one label."""
    members = keyed.select(ID, "normalized_alias").distinct()
    named = lookup_join(members, master.select(ID, "label"), ID, distinct=True)
    groups = colliding(key_stats(named, ["normalized_alias"], ["label"]))
    return groups.select(
        "normalized_alias",
        "n_entities",
        relation_of("label", "same_label", "same_label", "different_label").alias("label_relation"),
    )


#: An entity is heavy if its aliases times its shared ids are more than this; so many of the
#: heaviest get a bit each.
LIGHT, HEAVY = 1024, 1024


def _held_in_common(members: DataFrame, xids: DataFrame) -> DataFrame:
    """Alias groups of which two entities hold one (provider, external id).

    Only ids and aliases that several entities hold can make the link, so both sides are cut
    down to colliding keys before they meet. Light entities meet their ids row by row. A heavy
    one is a bit instead, in the bitmap of each of its aliases and of each of its ids, so that
    nothing grows with the product of the two: a pair (alias, id) of a light entity has a heavy
    holder if the bitmaps of both share a bit, and two heavy holders of one alias hold an id
    together if the one is among those that share any id with the other.
    """
    pairs = xids.select(
        ID,
        clean(F.col("provider")).alias("_p"),
        clean_or_null(F.col("external_id")).alias("_x"),
    ).where(F.col("_x").isNotNull() & F.col(ID).isNotNull())
    shared = cut(pair_members(pairs, ["_p", "_x"]).select(ID, "_p", "_x"))
    named = cut(members.select(ID, "normalized_alias"))
    by_name = named.groupBy(ID).agg(F.count("*").alias("a"))
    weighed = by_name.join(shared.groupBy(ID).agg(F.count("*").alias("x")), ID)
    weight = F.col("a").cast("double") * F.col("x")
    heavy = weighed.where(weight > LIGHT).orderBy(F.desc(weight), ID).limit(HEAVY).select(ID).collect()
    if not heavy:
        return _flagged(_light_pairs(named, shared).where(F.col("_n") > 1))
    listed = named.sparkSession.createDataFrame(
        [(row[0], bit) for bit, row in enumerate(heavy)], f"{ID} {named.schema[ID].dataType.simpleString()}, _bit int"
    )
    few = F.broadcast(listed)  # at most HEAVY rows
    words = range(-(-len(heavy) // 64))
    own = [
        F.bit_or(F.when(F.floor(F.col("_bit") / 64) == w, _mask()).otherwise(F.lit(0).cast("bigint")))
        for w in words
    ]
    names, ids = named.join(few, ID), shared.join(few, ID)
    name_bits = cut(names.groupBy("normalized_alias").agg(*[c.alias(f"_a{w}") for w, c in zip(words, own)]))
    id_bits = cut(ids.groupBy("_p", "_x").agg(*[c.alias(f"_x{w}") for w, c in zip(words, own)]))

    def meet(left: str, right: str) -> Column:
        return reduce(or_, [F.col(f"{left}{w}").bitwiseAND(F.col(f"{right}{w}")) != 0 for w in words])

    light = cut(_light_pairs(named.join(few, ID, "left_anti"), shared.join(few, ID, "left_anti")))
    beside_heavy = light.join(name_bits, "normalized_alias").join(id_bits, ["_p", "_x"]).where(meet("_a", "_x"))
    # per heavy entity the others that share an id with it
    partners = ids.join(id_bits, ["_p", "_x"]).groupBy("_bit").agg(*[F.bit_or(f"_x{w}").alias(f"_m{w}") for w in words])
    others = [
        F.when(F.floor(F.col("_bit") / 64) == w, F.col(f"_m{w}").bitwiseAND(F.bitwise_not(_mask())))
        .otherwise(F.col(f"_m{w}"))
        .alias(f"_m{w}")
        for w in words
    ]
    partners = F.broadcast(partners.select("_bit", *others))  # at most HEAVY rows
    both_heavy = names.join(partners, "_bit").join(name_bits, "normalized_alias").where(meet("_m", "_a"))
    parts = [light.where(F.col("_n") > 1), beside_heavy, both_heavy]
    return _flagged(reduce(DataFrame.union, [p.select("normalized_alias") for p in parts]))


def _mask() -> Column:
    """The bit of ``_bit`` in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit") % 64)


def _light_pairs(named: DataFrame, shared: DataFrame) -> DataFrame:
    """normalized_alias, _p, _x, _n: how many of these entities hold both."""
    meets = lookup_join(named, shared, ID, distinct=True)
    return meets.groupBy("normalized_alias", "_p", "_x").agg(F.count("*").alias("_n"))


def _flagged(groups: DataFrame) -> DataFrame:
    return groups.select("normalized_alias").distinct().withColumn("_shared", F.lit(True))


def alias_collision_profile(
    keyed: DataFrame, master: DataFrame, links: DataFrame, xids: DataFrame
) -> DataFrame:
    """Colliding aliases with the relation of labels, genders, QIDs, external ids, statuses."""
    pairs = cut(keyed.select(ID, "normalized_alias").distinct())
    members = pair_members(pairs, ["normalized_alias"])
    attributes = master.select(
        ID,
        F.coalesce("label", F.lit("")).alias("label"),
        F.nullif(F.col("gender"), F.lit("")).alias("gender"),
        F.nullif(F.col("status"), F.lit("")).alias("status"),
    )
    holders = xids.where(clean_or_null(F.col("external_id")).isNotNull())
    facts = (
        attributes.join(value_marks(links, "qid"), ID, "left")
        .join(holders.select(ID).distinct().withColumn("has_xid", F.lit(True)), ID, "left")
    )
    per_entity = key_counts(pairs, [ID])
    described = lookup_join(members, facts, ID, "left", per_entity, distinct=True)
    groups = described.groupBy("normalized_alias").agg(
        F.count("*").alias("n_entities"),
        *ends(label=F.col("label"), gender=F.col("gender"), status=F.col("status")),
        *merged_ends("qid"),
        F.coalesce(F.bool_or("has_xid"), F.lit(False)).alias("any_xid"),
    )
    joined = groups.join(_held_in_common(members, xids), "normalized_alias", "left")
    return joined.select(
        "normalized_alias",
        "n_entities",
        relation_of("label", "different_label", "same_label", "different_label").alias(
            "label_relation"
        ),
        relation_of("gender", "no_gender", "same_gender", "different_gender").alias(
            "gender_relation"
        ),
        relation_of("qid", "no_qid", "shared_qid", "different_qids").alias("qid_relation"),
        ladder(
            [
                (~F.col("any_xid"), "no_shared_external_id"),
                (F.col("_shared").isNotNull(), "shared_external_id"),
            ],
            "different_external_ids",
        ).alias("xid_relation"),
        relation(
            F.col("status_low"), F.col("status_high"), "same_status", "same_status", "mixed_status"
        ).alias("status_relation"),
    )


def _collisions_per_entity(keyed: DataFrame, key: str, name: str) -> DataFrame:
    members = pair_members(keyed, [key])
    return members.groupBy(ID).agg(F.count("*").alias(name))


def entity_alias_profile(
    keyed: DataFrame, master: DataFrame, links: DataFrame, xids: DataFrame
) -> DataFrame:
    """Each entity: conflict, aliases of its own, or none; with counts and alias flags."""
    keyed = cut(keyed)
    held = keyed.groupBy(ID).agg(
        F.count("*").alias("alias_count"),
        F.bool_or(is_provider_name(F.coalesce("kind", F.lit("")))).alias("_provider"),
        F.bool_or(is_short_alias(F.col("alias"))).alias("_short"),
    )
    pairs = xids.select(
        ID, clean(F.col("provider")).alias("p"), clean_or_null(F.col("external_id")).alias("x")
    ).where(F.col("x").isNotNull())
    xid_counts = pairs.distinct().groupBy(ID).agg(F.count("*").alias("xid_count"))
    joined = (
        master.select(ID, "label", "status", "gender")
        .join(held, ID, "left")
        .join(_collisions_per_entity(keyed, "alias", "exact_collisions"), ID, "left")
        .join(
            _collisions_per_entity(keyed, "normalized_alias", "normalized_collisions"), ID, "left"
        )
        .join(value_count(links, "qid", "qid_count"), ID, "left")
        .join(xid_counts, ID, "left")
    )
    counts = ["alias_count", "exact_collisions", "normalized_collisions", "qid_count", "xid_count"]
    filled = joined.fillna(0, counts).fillna(False, ["_provider", "_short"])
    return filled.select(
        ID,
        "label",
        "status",
        "gender",
        *counts,
        ladder(
            [
                (F.col("normalized_collisions") > 0, "alias_identity_conflict"),
                (F.col("alias_count") > 0, "alias_only_no_collision"),
            ],
            "no_alias",
        ).alias("alias_profile"),
        yes_no(F.col("_provider")).alias("provider_name_alias"),
        yes_no(F.col("_short")).alias("short_alias"),
    )


def alias_quality(aliases: DataFrame, master: DataFrame) -> DataFrame:
    """Each entity: alias rows, different aliases, kinds, and both distributions as text."""
    rows = aliases.select(
        ID, clean_or_null(F.col("alias")).alias("alias"), "kind", "language"
    )
    totals = rows.groupBy(ID).agg(
        F.count("*").alias("alias_rows"),
        F.count_distinct(F.col("alias")).alias("unique_aliases"),
        F.count_distinct(F.coalesce("kind", F.lit("<NULL>"))).alias("kinds"),
    )
    texts = value_counts_text(rows, [ID], ["kind", "language"])
    joined = master.join(totals, ID, "left").join(texts, ID, "left")
    return joined.fillna(0, ["alias_rows", "unique_aliases", "kinds"]).fillna(
        "", ["kind_counts", "language_counts"]
    )


# Alias kinds reported on their own.
ALIAS_KINDS = ("provider-name", "official_name", "short")


def entities_with_kinds(aliases: DataFrame, kinds: tuple[str, ...] = ALIAS_KINDS) -> DataFrame:
    """One row: entities that have an alias of each kind."""
    return entities_with(
        aliases, {k.replace("-", "_"): F.col("kind").eqNullSafe(F.lit(k)) for k in kinds}
    )
