"""Output lines, columnar output and record shapes."""

from pyspark.sql import Window, functions as F

from ..operators.checks import misshapen
from ..session import scratch_dir
from ..sinks.columnar import write_parquet
from ..sinks.lines import lines
from ..sources.delimited import misshapen_records, parsed_records
from .base import money, registered, table


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.replace(F.nullif(F.col("c_name"), F.lit("Customer#000000007")), F.lit("#"), F.lit('"')).alias("name"),
        F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation"),
        money("c_acctbal").alias("balance"),
        F.when(F.col("c_mktsegment") == "BUILDING", None)
        .when(F.col("c_mktsegment") == "MACHINERY", "")
        .otherwise(F.col("c_mktsegment"))
        .alias("segment"),
    )


SQL_CUSTOMERS = """
c AS (SELECT CAST(c_custkey AS VARCHAR) AS k, replace(replace(nullif(c_name, 'Customer#000000007'), '#', '"'), '"', '""') AS name,
             CAST(nullif(c_nationkey, 3) AS VARCHAR) AS nation, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance,
             CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN '' ELSE c_mktsegment END AS segment FROM customer)"""


@registered(f"""
WITH {SQL_CUSTOMERS}
SELECT k || ',"' || coalesce(name, '') || '",' || coalesce(nation, '') || ',' || coalesce(balance, '')
       || ',"' || coalesce(segment, '') || '"' AS line FROM c
""")
def lines_selective(spark, sf_dir):
    return lines(customers(spark, sf_dir), "selective")


@registered(f"""
WITH {SQL_CUSTOMERS}
SELECT '"' || k || '","' || coalesce(name, '') || '","' || coalesce(nation, '') || '","' || coalesce(balance, '')
       || '","' || coalesce(segment, '') || '"' AS line FROM c
""")
def lines_quoted(spark, sf_dir):
    return lines(customers(spark, sf_dir), "quoted")


@registered(f"""
WITH {SQL_CUSTOMERS}
SELECT coalesce('"' || k || '"', '') || ',' || coalesce('"' || name || '"', '') || ',' || coalesce('"' || nation || '"', '')
       || ',' || coalesce('"' || balance || '"', '') || ',' || coalesce('"' || segment || '"', '') AS line FROM c
""")
def lines_null_aware(spark, sf_dir):
    return lines(customers(spark, sf_dir), "null_aware")


@registered("""
SELECT l_orderkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price, l_shipdate, l_returnflag FROM lineitem
""")
def sink_parquet(spark, sf_dir):
    path = scratch_dir(spark, "sink-parquet")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", money("l_extendedprice").alias("price"), "l_shipdate", "l_returnflag"
    )
    write_parquet(rows, path, ["l_returnflag"])
    return spark.read.parquet(path).withColumn("price", F.col("price").cast("string"))


def shaped_documents(spark, sf_dir):
    """Documents as lines; those of one source have a field too many."""
    documents = table(spark, sf_dir, "documents")
    shown = lines(documents.where("source <> 'src2'").select("doc_id", "text", "lang"), "quoted")
    return shown.unionByName(
        lines(documents.where("source = 'src2'").select("doc_id", "text", "lang", "source"), "quoted")
    )


SQL_BAD_ROWS = """
SELECT '"' || doc_id || '","' || replace(text, '"', '""') || '","' || lang || '","' || source || '"' AS {} FROM documents
WHERE source = 'src2'
"""


@registered(SQL_BAD_ROWS.format("line"))
def bad_rows(spark, sf_dir):
    return misshapen(shaped_documents(spark, sf_dir), 3)


@registered(SQL_BAD_ROWS.format("record"))
def bad_records_in_files(spark, sf_dir):
    path = scratch_dir(spark, "bad-records")
    shaped_documents(spark, sf_dir).write.text(path)
    return misshapen_records(spark, path, 3).select("record")


@registered("""
SELECT CAST(doc_id AS VARCHAR) AS c1, text AS c2, lang AS c3, source IS NOT DISTINCT FROM 'src2' AS misshapen, true AS in_order
FROM documents
""")
def split_records(spark, sf_dir):
    """Records that span lines, read back by byte ranges: their fields, their shape, and whether they are numbered in order."""
    path = scratch_dir(spark, "split-records")
    shaped_documents(spark, sf_dir).write.text(path)
    found = parsed_records(spark, path, 3).select("c1", "c2", "c3", "misshapen", "file", "number")
    place = F.row_number().over(Window.partitionBy("file").orderBy("number"))
    return found.withColumn("in_order", F.col("number") == place).drop("file", "number")
