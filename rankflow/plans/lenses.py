"""Graphs and text derived from the star-schema tables, and their SQL twins.

Each lens has a DataFrame form and the same definition as SQL text, so that a
query and its SQL check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankflow.operators.measure import summarize


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _tagged(tag: str, column: str) -> Column:
    return F.concat(F.lit(tag), F.col(column).cast("string"))


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def supply(spark: SparkSession, folder: str) -> DataFrame:
    """Customer → part → supplier → customer for every order line.

    Unweighted, cyclic, with parallel edges and no dangling node.
    """
    customer, part, supplier = (
        _tagged("c", "o_custkey"),
        _tagged("p", "l_partkey"),
        _tagged("s", "l_suppkey"),
    )

    def edge(src: Column, dst: Column) -> Column:
        return F.struct(src.alias("src"), dst.alias("dst"))

    steps = F.array(edge(customer, part), edge(part, supplier), edge(supplier, customer))
    return _order_lines(spark, folder).select(F.inline(steps))


SUPPLY_SQL = """
supply AS (
  SELECT unnest([
    struct_pack(src := 'c' || o_custkey, dst := 'p' || l_partkey),
    struct_pack(src := 'p' || l_partkey, dst := 's' || l_suppkey),
    struct_pack(src := 's' || l_suppkey, dst := 'c' || o_custkey)], recursive := true)
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def trade(spark: SparkSession, folder: str) -> DataFrame:
    """Customer → supplier, weighted by revenue; every supplier is dangling."""
    return (
        _order_lines(spark, folder)
        .groupBy(_tagged("c", "o_custkey").alias("src"), _tagged("s", "l_suppkey").alias("dst"))
        .agg(F.sum("l_extendedprice").alias("w"))
    )


TRADE_SQL = """
trade AS (
  SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, sum(l_extendedprice) AS w
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def nation_trade(spark: SparkSession, folder: str) -> DataFrame:
    """Buying nation → selling nation, weighted by revenue, with self-loops."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    pairs = (
        _order_lines(spark, folder)
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.sum("l_extendedprice").alias("w"))
    )
    buyers = nations.toDF("c_nationkey", "src")
    sellers = nations.toDF("s_nationkey", "dst")
    return pairs.join(buyers, "c_nationkey").join(sellers, "s_nationkey").select("src", "dst", "w")


NATION_TRADE_SQL = """
nation_trade AS (
  SELECT b.n_name AS src, s.n_name AS dst, sum(l_extendedprice) AS w
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation b ON c_nationkey = b.n_nationkey JOIN nation s ON s_nationkey = s.n_nationkey
  GROUP BY 1, 2)"""


def _next_line(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line with the part of the next line of its order.

    Line numbers repeat, so the order of lines goes on to part, supplier and quantity.
    """
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    in_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return lines.withColumn("next_part", F.lead("l_partkey").over(in_order))


def copurchase(spark: SparkSession, folder: str) -> DataFrame:
    """Part → part of the order's next line, weighted by quantity; long cycles, parallel edges, self-loops."""
    lines = _next_line(spark, folder).where("next_part IS NOT NULL")
    weight = F.col("l_quantity").cast("double").alias("w")
    return lines.select(_tagged("p", "l_partkey").alias("src"), _tagged("p", "next_part").alias("dst"), weight)


def basket(spark: SparkSession, folder: str) -> DataFrame:
    """Co-purchases, and part → supplier for every line: cycles that leak into dangling suppliers."""
    lines = table(spark, folder, "lineitem")
    weight = F.col("l_quantity").cast("double").alias("w")
    sourced = lines.select(_tagged("p", "l_partkey").alias("src"), _tagged("s", "l_suppkey").alias("dst"), weight)
    return copurchase(spark, folder).unionByName(sourced)


COPURCHASE_SQL = """
copurchase AS (
  SELECT 'p' || l_partkey AS src, 'p' || next_part AS dst, l_quantity::DOUBLE AS w FROM (
    SELECT *, lead(l_partkey) OVER (
      PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS next_part FROM lineitem)
  WHERE next_part IS NOT NULL)"""

BASKET_SQL = (
    COPURCHASE_SQL
    + """,
basket AS (
  SELECT * FROM copurchase
  UNION ALL SELECT 'p' || l_partkey, 's' || l_suppkey, l_quantity::DOUBLE FROM lineitem)"""
)


def customer_universe(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer and every supplier nation as nodes, traded or not."""
    customers = table(spark, folder, "customer").select(_tagged("c", "c_custkey").alias("node"))
    nations = table(spark, folder, "nation").select(F.col("n_name").alias("node"))
    return customers.union(nations)


UNIVERSE_SQL = """
universe AS (SELECT 'c' || c_custkey AS node FROM customer UNION ALL SELECT n_name FROM nation)"""


def edge_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One text line per order, shaped by its priority and status.

    Plain edges, comments, padded lines, lines with an empty middle field, too
    few or too many columns, and blank lines all occur.
    """
    src, dst = _tagged("c", "o_custkey"), _tagged("o", "o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    tab = F.lit("\t")
    closed = F.col("o_orderstatus") == "F"
    weighted = F.concat(src, tab, dst, tab, price)
    plain = F.concat(src, tab, dst)
    line = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.when(closed, F.lit("  ")).otherwise(weighted))
        .when(F.col("o_orderpriority") == "2-HIGH", F.when(closed, F.concat(F.lit("# "), plain)).otherwise(plain))
        .when(
            F.col("o_orderpriority") == "3-MEDIUM",
            F.when(closed, F.concat(src, tab, tab, dst)).otherwise(
                F.concat(F.lit(" \t"), src, F.lit(" \t "), dst, F.lit("\t"))
            ),
        )
        .when(F.col("o_orderpriority") == "5-LOW", F.when(closed, src).otherwise(F.concat(weighted, tab, dst)))
        .otherwise(F.when(closed, F.concat(tab, plain)).otherwise(plain))
    )
    return table(spark, folder, "orders").select(line.alias("value"))


EDGE_LINES_SQL = """
edge_lines AS (
  SELECT CASE o_orderpriority
    WHEN '1-URGENT' THEN CASE WHEN closed THEN '  ' ELSE weighted END
    WHEN '2-HIGH' THEN CASE WHEN closed THEN '# ' || plain ELSE plain END
    WHEN '3-MEDIUM' THEN CASE WHEN closed THEN src || chr(9) || chr(9) || dst
      ELSE ' ' || chr(9) || src || ' ' || chr(9) || ' ' || dst || chr(9) END
    WHEN '5-LOW' THEN CASE WHEN closed THEN src ELSE weighted || chr(9) || dst END
    ELSE CASE WHEN closed THEN chr(9) || plain ELSE plain END END AS value
  FROM (
    SELECT *, src || chr(9) || dst AS plain,
      src || chr(9) || dst || chr(9) || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS weighted
    FROM (SELECT o_orderpriority, o_totalprice, o_orderstatus = 'F' AS closed,
      'c' || o_custkey AS src, 'o' || o_orderkey AS dst FROM orders)))"""


def quoted_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One text line per order whose ids hold quotes, comment signs and outer spaces.

    Fields may be empty or missing, and there may be more than two.
    """
    src, dst, tab = _tagged("c", "o_custkey"), _tagged("o", "o_orderkey"), F.lit("\t")
    quote = F.lit('"')
    line = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(quote, src, tab, dst, quote))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("# "), src, tab, F.lit("'"), dst, F.lit("' ")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(src, quote, quote, tab, quote, dst, quote, tab, src))
        .when(F.col("o_orderpriority") == "5-LOW", F.when(F.col("o_orderstatus") == "F", src).otherwise(F.concat(tab, dst)))
        .otherwise(F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.concat(src, tab)))
    )
    return table(spark, folder, "orders").select(line.alias("value"))


QUOTED_SQL = """
quoted AS (
  SELECT * FROM (
    SELECT CASE o_orderpriority WHEN '1-URGENT' THEN '"' || src WHEN '2-HIGH' THEN '# ' || src
        WHEN '3-MEDIUM' THEN src || '""' END AS src,
      CASE o_orderpriority WHEN '1-URGENT' THEN dst || '"' WHEN '2-HIGH' THEN chr(39) || dst || chr(39) || ' '
        WHEN '3-MEDIUM' THEN '"' || dst || '"' END AS dst
    FROM (SELECT o_orderpriority, 'c' || o_custkey AS src, 'o' || o_orderkey AS dst FROM orders))
  WHERE src IS NOT NULL)"""


def measured_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One measured run per event: type = framework, user = size, value = time.

    The number in ``props`` serves as memory sample; 0 means not sampled.
    """
    sample = F.nullif(F.regexp_extract("props", '"k": ([0-9]+)', 1), F.lit("")).cast("double")
    return table(spark, folder, "events").select(
        F.col("event_type").alias("framework"),
        F.upper("event_type").alias("label"),
        (F.col("user_id") + 1).cast("bigint").alias("n_nodes"),
        ((F.col("user_id") + 1) * 3).cast("bigint").alias("n_edges"),
        F.col("value").alias("time_s"),
        F.when(sample > 0, sample).alias("peak_mem_mb"),
        F.lit(30).alias("iterations"),
        (F.col("value") * F.lit(1e-9)).alias("max_diff_vs_core"),
    )


def measured_results(spark: SparkSession, folder: str) -> DataFrame:
    """Summarised runs; the ``error`` framework is marked as failed."""
    failed = F.col("framework") == "error"
    status = F.when(failed, F.lit("error")).otherwise(F.lit("ok"))
    return summarize(measured_runs(spark, folder)).withColumn("status", status)


MEASURED_RESULTS_SQL = """
measured_runs AS (
  SELECT event_type AS framework, upper(event_type) AS label, CAST(user_id + 1 AS BIGINT) AS n_nodes,
    CAST((user_id + 1) * 3 AS BIGINT) AS n_edges, value AS time_s,
    nullif(CAST(nullif(regexp_extract(props, '"k": ([0-9]+)', 1), '') AS DOUBLE), 0) AS peak_mem_mb,
    30 AS iterations, value * 1e-9::DOUBLE AS max_diff_vs_core
  FROM events),
measured_results AS (
  SELECT framework, label, n_nodes, max(n_edges) AS n_edges,
    CAST(round(CAST(avg(time_s) AS DECIMAL(38,12)), 4) AS DOUBLE) AS time_s,
    CAST(round(CAST(coalesce(stddev_samp(time_s), 0) AS DECIMAL(38,12)), 4) AS DOUBLE) AS time_s_std,
    CAST(round(CAST(avg(peak_mem_mb) AS DECIMAL(38,12)), 1) AS DOUBLE) AS peak_mem_mb,
    CASE WHEN count(peak_mem_mb) > 0 THEN CAST(round(CAST(coalesce(stddev_samp(peak_mem_mb), 0)
      AS DECIMAL(38,12)), 1) AS DOUBLE) END AS peak_mem_mb_std,
    count(*) AS n_runs, max(iterations) AS iterations, max(max_diff_vs_core) AS max_diff_vs_core,
    CASE WHEN framework = 'error' THEN 'error' ELSE 'ok' END AS status
  FROM measured_runs GROUP BY 1, 2, 3)"""
