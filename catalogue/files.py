"""Sources and sinks: what was written by many tasks is read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from catalogue.registers import over
from ledgerloom import roles
from ledgerloom.operators.slices import ensure_checkpoint_dir
from ledgerloom.sources import documents, register, sinks


def folder(r, name: str) -> str:
    return f"{ensure_checkpoint_dir(r.spark)}/{name}-{uuid4().hex}"


# Signs that end or hide strings and records in JSON, put around texts.
NASTY = '"}],[{\\'


def turns(r) -> DataFrame:
    """Turns of conversations with such signs in their texts."""
    text = F.concat(F.lit(NASTY), F.coalesce("text", F.lit("")), F.lit(NASTY))
    tags = F.array(F.col("role"), F.lit("]"), F.lit('\\"'))
    return r.table("conversations").select("conv_id", "turn", text.alias("text"), tags.alias("tags"))


def json_array(r) -> DataFrame:
    path, rows = folder(r, "array"), turns(r)
    documents.write_json_array(rows, path, ["conv_id", "turn", "text"])
    conf = r.spark.conf
    before = conf.get("spark.sql.files.maxPartitionBytes")
    conf.set("spark.sql.files.maxPartitionBytes", "64k")  # so that the file is read in many splits
    try:
        read = register.read_records_json(r.spark, path, rows.schema)
    finally:
        conf.set("spark.sql.files.maxPartitionBytes", before)
    return read.select("conv_id", "turn", "text", F.array_join("tags", "|").alias("tags"))


def csv_document(r) -> DataFrame:
    path = folder(r, "csv")
    rows = r.table("customer").select("c_custkey", F.concat(F.lit('a "b", '), "c_name").alias("name"), "c_mktsegment")
    documents.write_csv_document(rows, path, ["name", "c_custkey", "c_mktsegment"], ["c_custkey"])
    read = r.spark.read.options(quote='"', escape='"').schema("name string, c_custkey string, c_mktsegment string").csv(path)
    # Spark's readers take the mark away, so the bytes of the first part are looked at
    head = r.spark.read.format("binaryFile").load(f"{path}/part-000-00000")
    mark = head.select((F.hex(F.substring("content", 1, 3)) == "EFBBBF").alias("mark")).scalar()
    return read.withColumn("mark", (F.col("name") == "name") & mark)


def report_document(r) -> DataFrame:
    path = folder(r, "report")
    rows = r.table("supplier").select("s_suppkey", "s_name")
    one = rows.agg(F.count("*").alias("suppliers"))
    documents.write_report_document(r.spark, path, one, {"suppliers": (rows, ["s_suppkey"])})
    lines = r.spark.read.text(path).where("value LIKE '%s_suppkey%'")
    record = F.from_json(F.ltrim(F.col("value"), F.lit(",")), "s_suppkey bigint, s_name string", {"mode": "FAILFAST"})
    return lines.select(record.alias("r")).select("r.*")


def overwritten(r) -> DataFrame:
    """Two tables replaced together, and a second try that breaks off before its commit."""
    root = folder(r, "tables")
    nation, region = r.table("nation").select("n_nationkey", "n_name"), r.table("region").select("r_regionkey", "r_name")
    sinks.write_tables({"nation": nation, "region": region}, root)
    half = nation.where("n_nationkey % 2 = 0")
    documents.overwrite_tables({"nation": half, "region": region}, root)
    broken = region.withColumn("r_name", F.raise_error(F.lit("broken off")).cast("string"))
    try:
        documents.overwrite_tables({"nation": nation, "region": broken}, root)
    except Exception as error:
        if "broken off" not in str(error):
            raise
    tables = register.load_register(r.spark, root, ["nation", "region"])
    return (
        tables["nation"]
        .select(F.lit("nation").alias("kept"), "n_name")
        .unionByName(tables["region"].select(F.lit("region").alias("kept"), F.col("r_name").alias("n_name")))
    )


def two_catalogues(r) -> DataFrame:
    """A table of a source database beside what was written to another one."""
    names = []
    for table, df in (("customer", r.table("customer").select("c_custkey", "c_nationkey")), ("counts", None)):
        names.append(f"db_{uuid4().hex}")
        r.spark.sql(f"CREATE DATABASE {names[-1]} LOCATION '{folder(r, 'database')}'")
        if df is None:
            source = register.load_catalog(r.spark, names[0], ["customer"])["customer"]
            df = source.groupBy("c_nationkey").agg(F.count("*").alias("n"))
        df.write.saveAsTable(f"{names[-1]}.{table}")
    source = register.load_catalog(r.spark, names[0], ["customer"])["customer"]
    counts = register.load_catalog(r.spark, names[1], ["counts"])["counts"]
    return source.join(counts, "c_nationkey").select("c_custkey", "n")


def appended(r) -> DataFrame:
    path = folder(r, "events")
    events = r.table("events").select("event_id", "user_id", "event_type")
    for kind in ("error", "click"):
        sinks.append_events(events.where(F.col("event_type") == kind), path)
    read = r.spark.read.schema("event_id bigint, user_id bigint, event_type string, logged_at timestamp").json(path)
    return read.select("event_id", "user_id", "event_type", F.col("logged_at").isNotNull().alias("logged"))


def projected(r) -> DataFrame:
    """A role whose optional columns the table does not have."""
    links = roles.project_roles(r.table("customer"), "links", entity_id="c_custkey", qid="c_nationkey")
    return roles.require_columns(links, ["entity_id", "qid", "confidence"])


def profile_fields(r) -> DataFrame:
    fields = [(f.name, f.dataType.simpleString(), f.metadata["category"], f.metadata["required"]) for f in roles.profile_schema()]
    listed = r.spark.createDataFrame(fields, "name string, type string, category string, required boolean")
    held = roles.project_roles(r.table("customer"), "master", entity_id="c_custkey", label="c_name")
    shown = [F.struct(F.lit(c).alias("name"), F.count(c).alias("filled")) for c in ("entity_id", "label", "gender")]
    counts = held.agg(F.array(*shown).alias("x")).select(F.inline("x"))
    return listed.join(counts, "name")


STRATA = {"nation": ["n_name"], "orders": ["o_orderkey"], "customer": ["c_nationkey", "c_name"], "region": ["r_regionkey"]}


def samples(r) -> DataFrame:
    strata = {name: (r.table(name).select(*order), order) for name, order in STRATA.items()}
    told = register.stable_samples(strata, 5)
    text = F.regexp_replace("row", r'[{}"]', "")
    return told.select("stratum", "place", text.alias("row"))


def provenance(r) -> DataFrame:
    orders = r.table("orders")
    report = register.with_provenance(orders.agg(F.count("*").alias("n")), orders)
    return report.select("n", (F.col("input_files") > 0).alias("files"), (F.col("input_bytes") > 0).alias("bytes"), F.col("generated_at").isNotNull().alias("dated"))


def _sample_sql(name: str) -> str:
    order = STRATA[name]
    row = " || ',' || ".join(f"'{c}:' || {c}" for c in order)
    keys = ", ".join(order)
    return f"SELECT '{name}' AS stratum, CAST(ROW_NUMBER() OVER (ORDER BY {keys}) AS INT) AS place, {row} AS row FROM {name} QUALIFY place <= 5"


QUERIES = {
    "json_array": (
        over(json_array),
        "SELECT conv_id, turn, '\"}],[{\\' || COALESCE(text, '') || '\"}],[{\\' AS text, role || '|]|\\\"' AS tags FROM conversations",
    ),
    "csv_document": (
        over(csv_document),
        "SELECT 'a \"b\", ' || c_name AS name, CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, false AS mark FROM customer "
        "UNION ALL SELECT 'name', 'c_custkey', 'c_mktsegment', true",
    ),
    "report_document": (over(report_document), "SELECT s_suppkey, s_name FROM supplier"),
    "overwritten_tables": (
        over(overwritten),
        "SELECT 'nation' AS kept, n_name FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'region', r_name FROM region",
    ),
    "two_catalogues": (
        over(two_catalogues),
        "SELECT c_custkey, COUNT(*) OVER (PARTITION BY c_nationkey) AS n FROM customer",
    ),
    "appended_events": (
        over(appended),
        "SELECT event_id, user_id, event_type, true AS logged FROM events WHERE event_type IN ('error', 'click')",
    ),
    "projected_role": (
        over(projected),
        "SELECT c_custkey AS entity_id, c_nationkey AS qid, CAST(NULL AS DOUBLE) AS confidence, CAST(NULL AS VARCHAR) AS dob_check, "
        "CAST(NULL AS VARCHAR) AS entity_type, CAST(NULL AS BIGINT) AS inherited_count, CAST(NULL AS VARCHAR) AS inherited FROM "
        "customer",
    ),
    "profile_fields": (
        over(profile_fields),
        "SELECT name, 'string' AS type, 'identity' AS category, name <> 'gender' AS required, filled FROM (SELECT 'entity_id' AS name, "
        "COUNT(c_custkey) AS filled FROM customer UNION ALL SELECT 'label', COUNT(c_name) FROM customer UNION ALL SELECT 'gender', 0)",
    ),
    "catalogue_samples": (over(samples), " UNION ALL ".join(f"({_sample_sql(n)})" for n in STRATA)),
    "report_with_provenance": (
        over(provenance),
        "SELECT COUNT(*) AS n, true AS files, true AS bytes, true AS dated FROM orders",
    ),
}
