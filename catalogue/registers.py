"""The given tables in the roles of a register.

A role is a projection of one given table (or a union of two). Its expressions are plain
SQL that Spark and the checking engine both read, so that both sides see the same rows.
Every role takes all rows of its tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Role:
    table: str
    columns: dict[str, str]

    def frame(self, spark: SparkSession, folder: str) -> DataFrame:
        df = spark.read.parquet(f"{folder}/{self.table}.parquet")
        return df.selectExpr(*[f"{e} AS {name}" for name, e in self.columns.items()])

    def sql(self) -> str:
        picked = ", ".join(f"{e} AS {name}" for name, e in self.columns.items())
        return f"SELECT {picked} FROM {self.table}"


YEAR = "CAST(EXTRACT(YEAR FROM o_orderdate) AS STRING)"
STATUS = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'redirected' WHEN 'FURNITURE' THEN 'retired' "
    "WHEN 'HOUSEHOLD' THEN NULL ELSE 'active' END"
)
GENDER = "CASE WHEN c_acctbal < 500 THEN NULL WHEN c_nationkey < 12 THEN 'M' ELSE 'f' END"

ROLES: dict[str, list[Role]] = {
    # customers as master records; names are unique
    "master": [
        Role(
            "customer",
            {
                "entity_id": "c_custkey",
                "status": STATUS,
                "label": "c_name",
                "gender": GENDER,
                "country": "CASE WHEN c_acctbal > 7000 THEN NULL "
                "WHEN c_acctbal > 6500 THEN ' ' ELSE CAST(c_nationkey AS STRING) END",
            },
        )
    ],
    # the entity table: customers with some other values (those of MACHINERY under ids that the
    # master does not have), and suppliers of another type
    "entities": [
        Role(
            "customer",
            {
                "entity_id": "CASE WHEN c_mktsegment = 'MACHINERY' THEN -1000000000 - c_custkey ELSE c_custkey END",
                "entity_type": "'player'",
                "status": f"CASE WHEN c_acctbal BETWEEN 5000 AND 5500 THEN 'retired' ELSE {STATUS} END",
                "label": "CASE WHEN c_nationkey = 7 THEN NULL ELSE c_name END",
                "gender": "CASE WHEN c_nationkey < 10 THEN 'm' WHEN c_nationkey < 20 THEN 'F' END",
                "country": "CASE WHEN c_acctbal < 3000 THEN CAST(c_nationkey AS STRING) END",
                "corroboration_grade": "c_mktsegment",
                "corroboration_count": "CAST(c_nationkey AS BIGINT)",
                "source_tier_band": "CASE WHEN c_acctbal > 0 THEN 'A' END",
            },
        ),
        Role(
            "supplier",
            {
                "entity_id": "-1 - s_suppkey",
                "entity_type": "'coach'",
                "status": "'active'",
                "label": "s_name",
                "gender": "'m'",
                "country": "CAST(s_nationkey AS STRING)",
                "corroboration_grade": "CAST(NULL AS STRING)",
                "corroboration_count": "CAST(s_nationkey AS BIGINT)",
                "source_tier_band": "'B'",
            },
        ),
    ],
    # orders as links of customers to QIDs (the day of the order)
    "links": [
        Role(
            "orders",
            {
                "entity_id": "o_custkey",
                "qid": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
                "confidence": "CAST(CASE WHEN o_totalprice > 250000 THEN 0.9 ELSE 0.5 END AS DOUBLE)",
                "dob_check": "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' "
                "THEN 'dob-agrees' WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' "
                "THEN 'dob-unverified' WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' "
                "THEN 'unverified' END",
                "entity_type": "CASE WHEN o_orderpriority = '5-LOW' THEN 'coach' ELSE 'player' END",
                "inherited_count": "CAST(NULL AS BIGINT)",
                "inherited": "CAST(NULL AS STRING)",
            },
        )
    ],
    # events as external ids of users, who are customers
    "xids": [
        Role(
            "events",
            {
                "entity_id": "user_id",
                "provider": "event_type",
                "property": "CASE WHEN value < 20 THEN 'P1' ELSE 'P2' END",
                "external_id": "props",
                "rank": "CAST(NULL AS INT)",
                "confidence": "CAST(NULL AS DOUBLE)",
                "dob_check": "CASE WHEN value < 0.3 THEN 'dob-agrees' "
                "WHEN value < 0.6 THEN 'dob-unverified' END",
                "qid": "CAST(CAST(ts AS DATE) AS STRING)",
            },
        )
    ],
    "aliases": [
        Role(
            "conversations",
            {
                "entity_id": "conv_id",
                "alias": "text",
                "kind": "CASE role WHEN 'system' THEN 'provider-name' "
                "WHEN 'assistant' THEN 'official_name' ELSE 'short' END",
                "rank": "CAST(turn AS INT)",
                "language": "CASE WHEN turn < 2 THEN 'en' END",
            },
        ),
        Role(
            "part",
            {
                "entity_id": "p_partkey",
                "alias": "CASE WHEN p_size = 49 THEN UPPER(p_name) ELSE CONCAT(p_name, ' ', p_type, ' ', p_brand) END",
                "kind": "'provider-name'",
                "rank": "p_size",
                "language": "CAST(NULL AS STRING)",
            },
        ),
    ],
    "overlay_aliases": [
        Role(
            "labels",
            {
                "entity_id": "doc_id",
                "source": "CASE WHEN quality = 1 THEN 'first' WHEN toxic = 1 THEN 'second' END",
            },
        )
    ],
    "bridges": [
        Role(
            "lineitem",
            {
                "provider": "l_returnflag",
                "namespace": "l_linestatus",
                "external_id": "l_suppkey",
                "entity_id": "l_partkey",
                "rung": "CAST(l_linenumber AS STRING)",
            },
        )
    ],
    "clubs": [
        Role(
            "orders",
            {
                "entity_id": "o_custkey",
                "entity_type": "CASE WHEN o_orderstatus = 'P' THEN 'coach' ELSE 'player' END",
                "observed_clubs": "CAST(FLOOR(o_totalprice / 100000) AS BIGINT)",
                "first_observed_season": YEAR,
                "last_observed_season": f"CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {YEAR} END",
                "basis": "o_orderpriority",
            },
        )
    ],
    "relationships": [
        Role(
            "lineitem", {"from_id": "l_partkey", "to_id": "l_orderkey", "kind": "l_returnflag"}
        )
    ],
    # parts that were replaced by others, those of PROMO by the next one
    "redirects": [
        Role(
            "part",
            {
                "from_id": "p_partkey",
                "to_id": "CASE WHEN p_type = 'ECONOMY' THEN NULL WHEN p_type = 'PROMO' THEN p_partkey + 1 "
                "ELSE CAST(p_size AS BIGINT) END",
                "reason": "p_type",
            },
        )
    ],
    "search": [
        Role(
            "documents",
            {
                "entity_id": "doc_id",
                "entity_type": "CASE WHEN lang = 'en' THEN 'player' ELSE 'coach' END",
                "label": "CASE WHEN lang = 'fr' THEN NULL ELSE source END",
                "search_text": "text",
                "bridge_count": "CASE WHEN n_chars > 1000 THEN CAST(2 AS BIGINT) END",
                "alias_count": "CASE WHEN n_chars < 300 THEN CAST(1 AS BIGINT) ELSE 0 END",
            },
        )
    ],
    # parts, whose 64 names collide, and customers, whose names do not
    "items": [
        Role(
            "part",
            {
                "entity_id": "p_partkey",
                "status": "p_type",
                "label": "CASE WHEN p_size = 50 THEN NULL WHEN p_size = 49 THEN UPPER(p_name) ELSE p_name END",
                "gender": "CASE WHEN p_brand = 'Brand#1' THEN 'M' WHEN p_brand = 'Brand#2' THEN 'F' END",
                "country": "p_brand",
            },
        ),
        Role(
            "customer",
            {
                "entity_id": "-1 - c_custkey",
                "status": STATUS,
                "label": "c_name",
                "gender": GENDER,
                "country": "CAST(c_nationkey AS STRING)",
            },
        ),
    ],
    # orders as master records, their lines as external ids
    "orders_master": [
        Role(
            "orders",
            {
                "entity_id": "o_orderkey",
                "status": "o_orderstatus",
                "label": "o_orderpriority",
                "gender": "CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'P' THEN 'm' END",
                "country": "CAST(NULL AS STRING)",
            },
        )
    ],
    "order_xids": [
        Role(
            "lineitem",
            {
                "entity_id": "l_orderkey",
                "provider": "l_returnflag",
                "property": "l_linestatus",
                "external_id": "CONCAT(CAST(l_partkey AS STRING), '-', CAST(l_linenumber AS STRING))",
                "rank": "l_linenumber",
                "confidence": "l_discount",
                "dob_check": "CASE WHEN l_tax < 0.03 THEN 'dob-agrees' WHEN l_tax < 0.05 "
                "THEN 'dob-unverified' END",
                "qid": "CAST(l_suppkey AS STRING)",
            },
        )
    ],
    "texts": [Role("documents", {"entity_id": "doc_id", "label": "text"})],
}


class Register:
    """The role frames over one folder of the given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, role: str) -> DataFrame:
        if role not in ROLES:
            raise AttributeError(role)
        frames = [r.frame(self.spark, self.folder) for r in ROLES[role]]
        return reduce(DataFrame.unionByName, frames)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def sql(roles: str, body: str, *ctes: str) -> str:
    """A statement over roles: ``WITH <roles>, <further ctes> <body>``."""
    parts = [f"{r} AS ({' UNION ALL '.join(p.sql() for p in ROLES[r])})" for r in roles.split()]
    return f"WITH {', '.join([*parts, *ctes])} {body}"


def over(build):
    """A registered query: ``build(register)`` over the tables in a folder."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return build(Register(spark, folder))

    return query


PCT = "CASE WHEN {t} = 0 THEN 0.0 ELSE ((20000 * {p} + {t}) // (2 * {t})) / 100.0 END"


def pct(part: str, total: str) -> str:
    return PCT.format(p=part, t=f"({total})")
