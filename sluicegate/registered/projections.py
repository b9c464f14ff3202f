"""Projections and scalar functions over whole tables."""

from pyspark.sql import functions as F

from ..functions import text, types
from ..operators.project import clean_nul_fields, project_plain, project_selective, select_columns
from .base import money, registered, table


@registered("SELECT o_orderdate, o_orderkey, o_orderstatus FROM orders")
def select_ordered(spark, sf_dir):
    return select_columns(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey", "o_orderstatus"])


@registered("SELECT event_id, '0x' || lpad(upper(hex(event_id)), 16, '0') AS row_version FROM events")
def rowversion_hex(spark, sf_dir):
    version = text.rowversion_bytes(F.col("event_id"))
    return table(spark, sf_dir, "events").select("event_id", text.rowversion_hex(version).alias("row_version"))


@registered("SELECT page_id, html FROM pages")
def large_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return project_plain(types.with_source_types(pages, {"html": "xml"}))


@registered("""SELECT doc_id, '"' || replace(text, '"', '""') || '"' AS enclosed FROM documents""")
def enclose_string(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.enclose(F.col("text")).alias("enclosed"))


@registered("SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS segment FROM customer")
def null_to_empty(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.null_to_empty(segment).alias("segment"))


@registered("SELECT event_id, strftime(ts + INTERVAL 500 MICROSECONDS, '%Y-%m-%d %H:%M:%S.%g') AS shown FROM events")
def timestamp_ms(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.timestamp_ms(F.col("ts")).alias("shown"))


@registered("""
SELECT event_id, strftime(date_trunc('minute', ts + INTERVAL 30 SECONDS), '%Y-%m-%d %H:%M:%S') AS shown FROM events
""")
def timestamp_minute(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.timestamp_minute(F.col("ts")).alias("shown"))


def typed_events(spark, sf_dir):
    """Events with a column of every kind that exports treat differently."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        text.rowversion_bytes(F.col("event_id")).alias("version"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("kind"),
        "props",
        "ts",
        text.minute_start(F.col("ts")).alias("minute"),
        money("value").alias("amount"),
        (F.col("event_type") == "error").alias("failed"),
    )
    return types.with_source_types(events, {"version": "timestamp", "props": "text", "minute": "smalldatetime"})


@registered("""
SELECT event_id, '0x' || lpad(upper(hex(event_id)), 16, '0') AS version,
       '"' || coalesce(nullif(event_type, 'view'), '') || '"' AS kind,
       '"' || replace(coalesce(props, ''), '"', '""') || '"' AS props,
       strftime(ts + INTERVAL 500 MICROSECONDS, '%Y-%m-%d %H:%M:%S.%g') AS ts,
       strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute,
       CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
       CAST(event_type = 'error' AS INTEGER) AS failed
FROM events
""")
def project_selective_(spark, sf_dir):
    return project_selective(typed_events(spark, sf_dir)).withColumn("amount", F.col("amount").cast("string"))


@registered("""
SELECT event_id, '0x' || lpad(upper(hex(event_id)), 16, '0') AS version, nullif(event_type, 'view') AS kind, props,
       ts, date_trunc('minute', ts) AS minute, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
       event_type = 'error' AS failed
FROM events
""")
def project_plain_(spark, sf_dir):
    return project_plain(typed_events(spark, sf_dir)).withColumn("amount", F.col("amount").cast("string"))


@registered("""
SELECT p_partkey, regexp_replace(regexp_replace('_' || p_type || '%d ' || p_name || ' I-D!', '[^A-Za-z0-9]+', '_', 'g'),
       '^_|_$', '', 'g') AS safe_name
FROM part
""")
def sanitize_names(spark, sf_dir):
    odd = F.concat(F.lit("_"), "p_type", F.lit("%d "), "p_name", F.lit(" I-D!"))
    return table(spark, sf_dir, "part").select("p_partkey", text.sanitize(odd).alias("safe_name"))


@registered("""SELECT p_name AS "Weir%d Na-me", p_partkey AS "_Weir%d I-D", p_size AS "sel`ect" FROM part""")
def odd_names(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("_Weir%d I-D"), F.col("p_name").alias("Weir%d Na-me"), F.col("p_size").alias("sel`ect")
    )
    return select_columns(part, ["Weir%d Na-me", "_Weir%d I-D", "sel`ect"])


@registered("""
SELECT doc_id, CASE WHEN source = 'src1' THEN '' WHEN source = 'src2' THEN chr(0) || text ELSE text END AS text, lang
FROM documents
""")
def nul_cleanup(spark, sf_dir):
    nul = F.char(F.lit(0))
    injected = F.when(F.col("source") == "src1", nul).when(F.col("source") == "src2", F.concat(nul, "text"))
    documents = table(spark, sf_dir, "documents").select("doc_id", injected.otherwise(F.col("text")).alias("text"), "lang")
    return clean_nul_fields(documents)


# Type names handed out to rows to put the type rules to the test.
TYPE_NAMES = (
    "int", "BIGINT", "smallint", "tinyint", "integer", "numeric", "Decimal", "money", "smallmoney", "real", "float",
    "bit", "date", "datetime", "datetime2", "smalldatetime", "datetimeoffset", "timestamp", "char", "varchar",
    "nvarchar", "text", "ntext", "xml", "time", "uniqueidentifier", "varbinary",
)


def type_name(number):
    """One of the type names by a number."""
    return F.element_at(F.array(*(F.lit(n) for n in TYPE_NAMES)), (number % len(TYPE_NAMES) + 1).cast("int"))


SQL_TYPE_NAMES = "[" + ", ".join(f"'{n}'" for n in TYPE_NAMES) + "]"


def sql_type_name(number: str) -> str:
    return f"{SQL_TYPE_NAMES}[({number}) % {len(TYPE_NAMES)} + 1]"


@registered(f"""
SELECT p_partkey, t AS type,
       CASE lower(t)
         WHEN 'date' THEN 'DATE' WHEN 'datetime' THEN 'TIMESTAMP' WHEN 'datetime2' THEN 'TIMESTAMP'
         WHEN 'smalldatetime' THEN 'TIMESTAMP' WHEN 'datetimeoffset' THEN 'TIMESTAMP' WHEN 'integer' THEN 'INTEGER'
         WHEN 'int' THEN 'INTEGER' WHEN 'smallint' THEN 'INTEGER' WHEN 'tinyint' THEN 'INTEGER' WHEN 'bigint' THEN 'INTEGER'
         WHEN 'numeric' THEN 'NUMERIC' WHEN 'decimal' THEN 'NUMERIC' WHEN 'money' THEN 'NUMERIC'
         WHEN 'smallmoney' THEN 'NUMERIC' WHEN 'real' THEN 'FLOAT' WHEN 'float' THEN 'FLOAT' WHEN 'bit' THEN 'BOOLEAN'
         ELSE 'STRING' END AS base_type
FROM (SELECT p_partkey, {sql_type_name('p_partkey')} AS t FROM part) named
""")
def base_type(spark, sf_dir):
    named = table(spark, sf_dir, "part").select("p_partkey", type_name(F.col("p_partkey")).alias("type"))
    return named.withColumn("base_type", types.base_type_col(F.col("type")))


@registered(f"""
SELECT p_partkey, t AS type,
       CASE WHEN lower(t) IN ('integer', 'int', 'smallint', 'tinyint', 'bigint', 'real', 'float', 'numeric', 'decimal',
                              'money', 'smallmoney') THEN 'numeric'
            WHEN lower(t) IN ('datetime', 'datetime2', 'datetimeoffset', 'date') THEN 'datetime'
            WHEN lower(t) = 'smalldatetime' THEN 'minute'
            WHEN lower(t) = 'timestamp' THEN 'binary' END AS family
FROM (SELECT p_partkey, {sql_type_name('p_partkey')} AS t FROM part) named
""")
def watermark_family(spark, sf_dir):
    named = table(spark, sf_dir, "part").select("p_partkey", type_name(F.col("p_partkey")).alias("type"))
    return named.withColumn("family", types.watermark_family_col(F.col("type")))


@registered(f"""
SELECT l_orderkey, l_linenumber, t AS type,
  CASE WHEN t IN ('datetimeoffset', 'datetime2', 'datetime', 'time', 'smalldatetime', 'date') THEN NULL
       WHEN p > 0 AND s > 0 THEN p || ',' || s
       WHEN p > 0 THEN CAST(p AS VARCHAR)
       WHEN n = -1 OR (n = 16 AND t = 'text') THEN NULL
       ELSE CAST(n AS VARCHAR) END AS length
FROM (SELECT l_orderkey, l_linenumber, {sql_type_name('l_partkey')} AS t,
             CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS p,
             CASE WHEN l_linestatus = 'F' THEN l_linenumber ELSE 0 END AS s,
             CASE WHEN l_quantity < 10 THEN -1 WHEN l_quantity < 30 THEN 16 ELSE CAST(l_quantity AS INTEGER) END AS n
      FROM lineitem) described
""")
def field_length(spark, sf_dir):
    quantity = F.col("l_quantity").cast("int")
    described = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        type_name(F.col("l_partkey")).alias("type"),
        F.when(F.col("l_returnflag") == "R", quantity).otherwise(0).alias("p"),
        F.when(F.col("l_linestatus") == "F", F.col("l_linenumber")).otherwise(0).alias("s"),
        F.when(F.col("l_quantity") < 10, -1).when(F.col("l_quantity") < 30, 16).otherwise(quantity).alias("n"),
    )
    length = types.field_length_col(F.col("type"), F.col("p"), F.col("s"), F.col("n"))
    return described.select("l_orderkey", "l_linenumber", "type", length.alias("length"))


@registered(f"""
SELECT p_partkey, t AS type,
       CASE WHEN lower(t) IN ('int', 'bigint', 'smallint', 'tinyint', 'decimal', 'numeric', 'float')
             AND regexp_extract(d, '\\(\\((.+)\\)\\)', 1) <> ''
            THEN regexp_extract(d, '\\(\\((.+)\\)\\)', 1) ELSE d END AS "default"
FROM (SELECT p_partkey, {sql_type_name('p_partkey')} AS t,
             CASE WHEN p_size > 25 THEN '((' || p_size || '))' WHEN p_size > 10 THEN '(''' || p_name || ''')'
                  ELSE CAST(p_size AS VARCHAR) END AS d
      FROM part) described
""")
def default_unwrap(spark, sf_dir):
    size = F.col("p_size").cast("string")
    default = (
        F.when(F.col("p_size") > 25, F.concat(F.lit("(("), size, F.lit("))")))
        .when(F.col("p_size") > 10, F.concat(F.lit("('"), "p_name", F.lit("')")))
        .otherwise(size)
    )
    described = table(spark, sf_dir, "part").select(
        "p_partkey", type_name(F.col("p_partkey")).alias("type"), default.alias("d")
    )
    unwrapped = types.default_unwrap_col(F.col("type"), F.col("d"))
    return described.select("p_partkey", "type", unwrapped.alias("default"))
