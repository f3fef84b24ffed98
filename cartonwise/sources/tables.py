"""Order-line star schema -> lines.

Each dimension is a left join on its primary key, so a line never disappears and a dimension that no
requested column needs is not read at all: most metrics touch neither orders nor part. No join is
hinted; Spark broadcasts a dimension only when its size is below the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartonwise.schema import LINE_COLUMNS
from cartonwise.sources.derive import derive

# What a derived column is computed from.
_INPUTS = {
    "carton_type": {"carton_matrix_code"},
    "cbm": {"carton_length_mm", "carton_width_mm", "carton_height_mm"},
    "density": {"carton_length_mm", "carton_width_mm", "carton_height_mm", "units_per_carton"},
    "compliance_status": {"packaging_status", "handover_date", "_updated_day"},
}
_FROM_SUPPLIER = {"supplier"}
_FROM_HOME = {"sub_area"}
_FROM_ORIGIN = {"origin_country", "area"}
_FROM_PART = {"factory", "description", "size", "carton_matrix_code", "units_per_carton", "carton_length_mm",
              "packaging_supplier"}
_FROM_ORDERS = {"updated_by", "approved_by"}


# Column types of the tables read so far: they do not change, so a table's footer is looked at once per session.
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


_DAY = "cast(l_shipdate AS date)"
_UPDATED = f"date_add({_DAY}, cast(l_partkey % 10 - 8 AS int))"
# How each column of a line is made from the joined tables.
_COLUMNS = {
    "area": "r_name",
    "sub_area": "home_name",
    "origin_country": "CASE WHEN l_partkey % 211 <> 0 THEN origin_name END",
    "origin_port": "'PORT_' || origin_key",
    "supplier": "s_name",
    "factory": "CASE WHEN l_partkey % 199 <> 0 THEN p_brand END",
    "destination_po": "cast(l_orderkey AS string)",
    "kimball": "cast(l_partkey AS string)",
    "colour_code": "l_returnflag",
    "description": "p_name",
    "size": "cast(p_size AS string)",
    "po_qty": "cast(l_quantity AS int)",
    "handover_date": _DAY,
    "carton_matrix_code": "CASE WHEN p_size <= 25 THEN p_type END",
    "units_per_carton": "p_size",
    "carton_length_mm": "CASE WHEN p_size % 17 <> 0 THEN 200 + 10 * p_size END",
    "carton_width_mm": "cast(150 + 10 * (l_partkey % 30) AS int)",
    "carton_height_mm": "100 + 25 * l_linenumber",
    "packaging_supplier": "p_brand",
    "updated_date": f"cast({_UPDATED} AS timestamp)",
    "updated_by": "o_orderpriority",
    "approved_date": f"CASE WHEN l_returnflag <> 'R' THEN cast({_UPDATED} AS timestamp) END",
    "approved_by": "CASE WHEN l_returnflag <> 'R' THEN o_orderpriority END",
    "packaging_status": """CASE WHEN l_returnflag <> 'R' THEN 'Approved' WHEN l_linestatus = 'F' THEN 'Approval Rejected'
                           WHEN l_linenumber % 2 = 0 THEN 'Pending' ELSE 'Escalated' END""",
    "_updated_day": _UPDATED,
    "source_file": f"date_format({_DAY}, 'yyyy_MM') || if(day({_DAY}) <= 15, '_1-15', '_16-31')",
}


def read_lines(spark: SparkSession, folder: str, *columns: str, dealt_by: str | None = None) -> DataFrame:
    """Lines with the given columns (all by default). Filters on handover_date reach the Parquet scan. dealt_by: a column of the order
    lines alone (source_file) by which rows are rebalanced while they are narrow, for a write that is partitioned by it."""
    wanted = list(columns or LINE_COLUMNS)
    needed = set(wanted).union(*(_INPUTS.get(c, ()) for c in wanted))
    rows = table(spark, folder, "lineitem")
    # The large tables come first: what these joins shuffle is narrow then, without the names of the small ones.
    if needed & _FROM_ORDERS:
        orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if needed & _FROM_PART:
        part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if dealt_by:
        rows = rows.withColumn("_dealt", F.expr(_COLUMNS[dealt_by])).hint("rebalance", "_dealt")
    if needed & (_FROM_SUPPLIER | _FROM_HOME | _FROM_ORIGIN | {"origin_port"}):
        supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
        rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        rows = rows.withColumn("origin_key", F.when(F.col("l_linenumber") < 6, F.col("s_nationkey"))
                               .otherwise((F.col("s_nationkey") + 1) % 25))
    nation = table(spark, folder, "nation")
    if needed & _FROM_HOME:
        home = nation.select(F.col("n_nationkey").alias("home_key"), F.col("n_name").alias("home_name"))
        rows = rows.join(home, F.col("s_nationkey") == F.col("home_key"), "left")
    if needed & _FROM_ORIGIN:
        origin = nation.select(F.col("n_nationkey").alias("origin_nation"), F.col("n_name").alias("origin_name"),
                               "n_regionkey")
        rows = rows.join(origin, F.col("origin_key") == F.col("origin_nation"), "left")
    if "area" in needed:
        rows = rows.join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    lines = rows.select(*(F.expr(value).alias(name) for name, value in _COLUMNS.items() if name in needed))
    return derive(lines, F.col("_updated_day") if "_updated_day" in needed else None).select(*wanted)


def bd_countries(spark: SparkSession, folder: str) -> tuple[str, ...]:
    """Names of the nations standing in for region BD: at most the rows of the fixed nation table."""
    nation = table(spark, folder, "nation")
    return tuple(sorted(r.n_name for r in nation.where("n_regionkey in (0, 1)").select("n_name").collect()))


def read_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Raw -> canonical names for every tenth supplier."""
    return table(spark, folder, "supplier").where(F.col("s_suppkey") % 10 == 0).select(
        F.col("s_name").alias("raw_name"), F.concat("s_name", F.lit(" (ID)")).alias("canonical_name"))


def read_contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Stored addresses: two suppliers in three have one, those with an even key two; one name, kept in the place of the
    first supplier, has no lines."""
    key = F.col("s_suppkey")

    def address(name, prefix):
        return F.struct(name.alias("supplier_name"), F.concat(
            F.lit(prefix), key.cast("string"), F.lit("@example.com")).alias("email"))

    name = F.lower("s_name")
    addresses = F.array_compact(F.array(
        F.when(key % 3 != 0, address(name, "s")), F.when((key % 3 != 0) & (key % 2 == 0), address(name, "ops")),
        F.when(key == 0, F.struct(F.lit("zz retired").alias("supplier_name"),
                                  F.lit("zz@example.com").alias("email")))))
    return table(spark, folder, "supplier").select(F.inline(addresses))
