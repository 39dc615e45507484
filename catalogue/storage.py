"""Sources and sinks: each query writes one of the given tables to the shared scratch folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogue.registry import ENC, encounters, query, table
from cohortry.session import scratch_path
from cohortry.sources import files, numbering, schema, tables
from cohortry.sources.harmonise import align_vintages, harmonise, union_all

SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"


def unique_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:10]}"


@query("csv_typed_load", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_typed_load(spark, d):
    path = scratch_path(spark, "supplier-csv")
    files.write_csv(table(spark, d, "supplier"), path)
    return files.read_typed_csv(spark, path, SUPPLIER)


@query("csv_lookup_load", "SELECT n_nationkey AS id, n_name, TRY_CAST(substr(n_name, 8) AS INT) AS n_number, n_regionkey FROM nation")
def csv_lookup_load(spark, d):
    path = scratch_path(spark, "nation-csv")
    raw = table(spark, d, "nation").selectExpr(
        "n_nationkey AS `n.nationkey`", "n_name AS `n name`", "substr(n_name, 8) AS `n.number`", "n_regionkey"
    )
    files.write_csv(raw, path, single_file=True)
    types = {"id": "int", "n_number": "int", "n_regionkey": "int"}
    return files.read_lookup_csv(spark, path, types, {"n_nationkey": "id"})


@query("csv_export", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def csv_export(spark, d):
    path = scratch_path(spark, "export-csv")
    result = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    files.write_csv(result, path, single_file=True)
    return files.read_typed_csv(spark, path, "l_returnflag string, l_linestatus string, n bigint")


@query("columnar_io", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def columnar_io(spark, d):
    path = scratch_path(spark, "orders")
    files.write_columnar(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), path, ["o_orderstatus"])
    return files.read_columnar(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus")


SPEC = [
    "row_id BIGINT",
    "s_suppkey BIGINT",
    "s_name TEXT",
    "s_nationkey INT",
    "s_acctbal FLOAT",
]


def spec(spark, d):
    """A column specification as a table: which entries exist follows from the supplier table's own columns."""
    own = set(table(spark, d, "supplier").columns) | {"row_id"}
    rows = [(i, e.split()[0], e) for i, e in enumerate(SPEC) if e.split()[0] in own]
    return spark.createDataFrame(rows, "position int, names string, types string")


@query("schema_from_spec", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def schema_from_spec(spark, d):
    path = scratch_path(spark, "spec-csv")
    entries = spec(spark, d)
    order = schema.column_order(entries, "names", exclude=["row_id"])
    files.write_csv(table(spark, d, "supplier").select(*order), path)
    return files.read_typed_csv(spark, path, schema.schema_from_spec(entries, "types", exclude=["row_id"]))


def orders_table(spark, d, stem: str) -> str:
    """An empty table with the order columns."""
    name = unique_name(stem)
    shape = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").schema
    tables.create_table(spark, name, shape, scratch_path(spark, stem))
    return name


@query("create_table", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def create_table(spark, d):
    name = orders_table(spark, d, "created")
    tables.append_subset(table(spark, d, "orders"), name, ["o_orderkey", "o_totalprice", "o_orderstatus"], F.lit(True))
    return spark.table(name)


@query("append_subset", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice < 200000")
def append_subset(spark, d):
    name = orders_table(spark, d, "subset")
    columns = ["o_orderstatus", "o_totalprice", "o_orderkey"]
    tables.append_subset(table(spark, d, "orders"), name, columns, "o_totalprice < 200000")
    return spark.table(name)


@query(
    "load_audit",
    """SELECT count(*) AS stage_rows, count(*) FILTER (WHERE o_totalprice < 200000) AS appended_rows, CAST(0 AS BIGINT) AS target_before,
  count(*) FILTER (WHERE o_totalprice < 200000) AS target_after FROM orders""",
)
def load_audit(spark, d):
    name = orders_table(spark, d, "audited")
    said = tables.audited_append(
        table(spark, d, "orders"), name, ["o_orderkey", "o_totalprice", "o_orderstatus"], "o_totalprice < 200000"
    )
    return spark.createDataFrame([tuple(said.values())], ", ".join(f"{k} bigint" for k in said))


@query("write_local_table", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def write_local_table(spark, d):
    """A small result, held by the driver, written as a table."""
    counted = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    name = unique_name("local")
    tables.write_table(spark.createDataFrame(counted.collect(), counted.schema), name, scratch_path(spark, "local"))
    return spark.table(name)


@query("snapshot_table", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def snapshot_table(spark, d):
    source, name = orders_table(spark, d, "source"), unique_name("snapshot")
    tables.append_subset(table(spark, d, "orders"), source, ["o_orderkey", "o_totalprice", "o_orderstatus"], F.lit(True))
    tables.snapshot_table(spark, source, name, "o_orderstatus = 'F'", scratch_path(spark, "snapshot"))
    return spark.table(name)


@query("drop_rename_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def drop_rename_table(spark, d):
    first, second, gone = unique_name("first"), unique_name("second"), unique_name("gone")
    tables.write_table(table(spark, d, "nation"), first, scratch_path(spark, "first"))
    tables.write_table(table(spark, d, "region"), gone, scratch_path(spark, "gone"))
    tables.drop_table(spark, gone)
    tables.rename_table(spark, first, second)
    if spark.catalog.tableExists(gone) or spark.catalog.tableExists(first):
        raise RuntimeError("drop or rename left the old table")
    return spark.table(second)


@query("list_tables", "SELECT 'listed_a' AS table_name, count(*) AS n_rows FROM nation UNION ALL SELECT 'listed_b', count(*) FROM region")
def list_tables(spark, d):
    tag = uuid.uuid4().hex[:10]
    for stem, name in (("listed_a", "nation"), ("listed_b", "region")):
        tables.write_table(table(spark, d, name), f"{stem}_{tag}", scratch_path(spark, stem))
    found = [r.table_name for r in tables.list_tables(spark, f"listed_*_{tag}").collect()]
    frames = [
        spark.table(n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n.removesuffix(f"_{tag}")).alias("table_name"), "n_rows")
        for n in found
    ]
    return union_all(frames)


@query(
    "table_scan",
    """SELECT o_orderkey AS sql_id, o_custkey AS rln, o_orderstatus AS database, o_totalprice, o_orderpriority FROM orders
WHERE year(o_orderdate) = 1997 AND o_totalprice < 300000""",
)
def table_scan(spark, d):
    where = F.col("o_orderdate").between(F.lit("1997-01-01"), F.lit("1997-12-31 23:59:59")) & (F.col("o_totalprice") < 300000)
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return tables.table_scan(
        table(spark, d, "orders"), where, columns, {"o_orderkey": "sql_id", "o_custkey": "rln", "o_orderstatus": "database"}
    )


@query("sql_query", "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'F'")
def sql_query(spark, d):
    return tables.run_sql(
        spark,
        "SELECT o_orderkey, o_custkey FROM {o} WHERE year(o_orderdate) = :yr AND o_orderstatus = :status",
        frames={"o": table(spark, d, "orders")},
        yr=1997,
        status="F",
    )



@query(
    "align_vintages",
    """SELECT o_orderkey, o_custkey AS source, NULL AS source_ns FROM orders WHERE year(o_orderdate) < 1998
UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE year(o_orderdate) >= 1998""",
)
def align_vintages_query(spark, d):
    orders = table(spark, d, "orders")
    old = orders.filter(F.year("o_orderdate") < 1998).select("o_orderkey", F.col("o_custkey").alias("source"))
    new = orders.filter(F.year("o_orderdate") >= 1998).select("o_orderkey", F.col("o_orderpriority").alias("source_ns"))
    both = {"source": "bigint", "source_ns": "string"}
    return union_all([align_vintages(old, both), align_vintages(new, both)])


COMMON = [
    ("database", "string"), ("sex", "string"), ("age", "int"), ("payer", "string"), ("insurance", "string"),
    ("oshpd_id", "string"), ("start_date", "date"), ("los", "int"), ("ip_charge", "double"), ("ed_disp", "int"),
]


@query(
    "harmonise_append",
    """SELECT 'pdd' AS database, NULL AS sex, CAST(o_custkey % 22 AS INT) AS age, o_orderpriority AS payer, o_orderpriority AS insurance,
  CAST(o_custkey AS VARCHAR) AS oshpd_id, strftime(o_orderdate, '%Y-%m-%d') AS start_date, 3 AS los, o_totalprice AS ip_charge,
  NULL AS ed_disp FROM orders
UNION ALL SELECT 'edd', l_linestatus, CAST(l_partkey % 22 AS INT), l_returnflag, l_returnflag, CAST(l_suppkey AS VARCHAR),
  strftime(l_shipdate, '%Y-%m-%d'), 0, NULL, l_linenumber FROM lineitem""",
)
def harmonise_append(spark, d):
    inpatient = table(spark, d, "orders").selectExpr(
        "CAST(o_custkey % 22 AS INT) AS agyradm", "o_orderpriority AS pay_cat", "o_custkey AS fac", "3 AS stay",
        "date_format(o_orderdate, 'MM/dd/yyyy') AS admtdate", "o_totalprice AS charge",
    )
    emergency = table(spark, d, "lineitem").selectExpr(
        "l_linestatus AS sex", "CAST(l_partkey % 22 AS INT) AS agyrserv", "l_returnflag AS payer", "l_suppkey AS fac_id",
        "date_format(l_shipdate, 'M/d/yyyy') AS serv_dt", "l_linenumber AS dispn",
    )
    pdd = {
        "age": "agyradm", "payer": "pay_cat", "insurance": "pay_cat", "oshpd_id": "fac", "los": "stay",
        "start_date": "admtdate", "ip_charge": "charge",
    }
    edd = {
        "sex": "sex", "age": "agyrserv", "payer": "payer", "insurance": "payer", "oshpd_id": "fac_id",
        "start_date": "serv_dt", "ed_disp": "dispn",
    }
    path = scratch_path(spark, "combined")
    rows = union_all(
        [harmonise(inpatient, pdd, COMMON, {"database": "pdd"}), harmonise(emergency, edd, COMMON, {"database": "edd", "los": 0})]
    )
    files.write_columnar(rows, path, ["database"])
    back = files.read_columnar(spark, path).withColumn("start_date", F.col("start_date").cast("string"))
    return back.select(*[n for n, _ in COMMON])


@query(
    "row_number_global",
    """SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS db_row_n FROM orders""",
)
def row_number_global(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return numbering.number_rows(orders, ["o_orderdate", "o_orderkey"], batch=["o_orderstatus"], from_files=True).drop("o_orderdate")


@query(
    "surrogate_id",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_orderdate, o_orderkey) AS id FROM orders",
)
def surrogate_id(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    done = numbering.number_rows(orders, ["o_orderdate", "o_orderkey"], batch=["o_orderstatus"], running_id="id", from_files=True)
    return done.select("o_orderkey", "id")


DESCRIBED = {
    "s_suppkey": "CASE WHEN s_suppkey = 0 THEN 'Supplier key' WHEN s_suppkey = 1 THEN 'No.' ELSE CAST(s_suppkey AS STRING) END",
    "s_name": "CASE WHEN s_suppkey = 0 THEN 'Name of supplier' ELSE s_name END",
}


@query("drop_leading_rows", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier WHERE s_suppkey > 1")
def drop_leading_rows(spark, d):
    raw = table(spark, d, "supplier").selectExpr(*[f"{e} AS {c}" for c, e in DESCRIBED.items()])
    return files.drop_leading_rows(raw, "s_suppkey")


@query(
    "label_columns",
    "SELECT s_name, 'Supplier key' AS key_label, 'Name of supplier' AS name_label FROM supplier WHERE s_suppkey > 0",
)
def label_columns(spark, d):
    text = {**DESCRIBED, "s_suppkey": DESCRIBED["s_suppkey"].replace("WHEN s_suppkey = 1 THEN 'No.' ", "")}
    raw = table(spark, d, "supplier").selectExpr(*[f"{e} AS {c}" for c, e in text.items()])
    labelled = files.label_columns(raw, "s_suppkey")
    labels = {f.name: f.metadata["label"] for f in labelled.schema}
    return labelled.select("s_name", F.lit(labels["s_suppkey"]).alias("key_label"), F.lit(labels["s_name"]).alias("name_label"))


@query(
    "encounter_scan",
    f"""WITH {ENC} SELECT database, CAST(year(start_date) AS INT) AS start_year, count(*) AS n, count(payer) AS n_payer FROM enc
WHERE age < 18 GROUP BY ALL""",
)
def encounter_scan(spark, d):
    """Counts by source and year after a load: the check that follows the append."""
    path = scratch_path(spark, "encounters")
    enc = encounters(spark, d).select("database", F.year("start_date").alias("start_year"), "age", "payer")
    files.write_columnar(enc, path, ["database", "start_year"])
    kept = tables.table_scan(files.read_columnar(spark, path), F.col("age") < 18, ["database", "start_year", "payer"])
    return kept.groupBy("database", "start_year").agg(F.count(F.lit(1)).alias("n"), F.count("payer").alias("n_payer"))
