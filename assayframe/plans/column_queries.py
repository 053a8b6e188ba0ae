"""Queries: scalar functions and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric, text
from ..operators import relational
from ..sources import readers, staging, writers
from . import roles
from .catalog import query, rounded
from .roles import with_roles


@query("to_number", "SELECT doc_id, try_cast(substr(source, 4) AS DOUBLE) AS a, try_cast(source AS DOUBLE) AS b FROM documents")
def to_number(spark, sf):
    tail = F.substring(F.col("source"), F.lit(4), F.length("source"))
    return roles.table(spark, sf, "documents").select("doc_id", numeric.to_number(tail).alias("a"), numeric.to_number("source").alias("b"))


@query("rt_seconds", "SELECT event_id, round(value * 60, 6) AS seconds FROM events")
def rt_seconds(spark, sf):
    return rounded(roles.table(spark, sf, "events").select("event_id", numeric.rt_seconds("value", "minutes").alias("seconds")))


@query("trim", "SELECT doc_id, md5(trim(text)) AS t FROM documents")
def trim(spark, sf):
    return roles.table(spark, sf, "documents").select("doc_id", F.md5(text.trimmed("text")).alias("t"))


@query("strip_prefix", "SELECT doc_id, replace(source, 'src', '') AS id FROM documents")
def strip_prefix(spark, sf):
    return roles.table(spark, sf, "documents").select("doc_id", text.strip_prefix("source", "src").alias("id"))


@query("file_stem", "SELECT page_id, regexp_replace(regexp_replace(url, '^.*/', ''), 'ml$', '') AS stem FROM pages")
def file_stem(spark, sf):
    return roles.table(spark, sf, "pages").select("page_id", text.file_stem("url", "ml").alias("stem"))


@query("ratio_text", "SELECT p_brand, concat(count(*) FILTER (p_size > 25), '/', count(*)) AS ratio FROM part GROUP BY 1")
def ratio_text(spark, sf):
    sizes = roles.table(spark, sf, "part").groupBy("p_brand").agg(F.count(F.when(F.col("p_size") > 25, 1)).alias("k"), F.count(F.lit(1)).alias("n"))
    return sizes.select("p_brand", text.ratio_text("k", "n").alias("ratio"))


@query("first_of", "SELECT p_partkey, string_split(p_name, ' ')[1] AS first FROM part")
def first_of(spark, sf):
    return roles.table(spark, sf, "part").select("p_partkey", text.first_of(F.split("p_name", " ")).alias("first"))


@query("abs", "SELECT c_custkey, abs(c_acctbal) AS v FROM customer")
def absolute(spark, sf):
    return roles.table(spark, sf, "customer").select("c_custkey", F.abs("c_acctbal").alias("v"))


@query("pct", "SELECT event_type, round_even(count(*) / (SELECT count(*) FROM events) * 100, 2) AS percent FROM events GROUP BY 1")
def pct(spark, sf):
    events = roles.table(spark, sf, "events")
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / events.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("s", share).select("event_type", numeric.pct("s").alias("percent"))


@query("drop_unnamed", "SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE l_tax <> 0")
def drop_unnamed(spark, sf):
    rows = roles.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"))
    return relational.drop_unnamed(rows, "l_tax")


@query(
    "write_matrix",
    with_roles("cells", "SELECT feature, " + ", ".join(f'max(value) FILTER (sample = {i}) AS "{i}"' for i in range(8)) + " FROM cells GROUP BY 1"),
)
def write_matrix(spark, sf):
    """The wide form that the matrix sink writes."""
    return writers.to_wide(roles.cells(spark, sf))


@query("stage", with_roles("cells", "SELECT feature, sample, value FROM cells"))
def stage(spark, sf):
    return staging.stage(roles.cells(spark, sf))


@query("write_by_class", "SELECT lang AS sample, source AS class, CAST(doc_id % 2 + 1 AS INTEGER) AS mate, doc_id, md5(text) AS seq FROM documents")
def write_by_class(spark, sf):
    path = staging.new_path(spark)
    reads = roles.table(spark, sf, "documents").select(
        "doc_id",
        F.md5("text").alias("seq"),
        F.col("lang").alias("sample"),
        F.col("source").alias("class"),
        (F.col("doc_id") % 2 + 1).cast("int").alias("mate"),
    )
    writers.write_by_class(reads, path)
    return spark.read.schema(reads.schema).parquet(path).select("sample", "class", "mate", "doc_id", "seq")


@query("read_dimension", "SELECT p_partkey AS compound_id, p_name AS name FROM part")
def read_dimension(spark, sf):
    return readers.read_dimension(spark, f"{sf}/part.parquet", {"p_partkey": "compound_id", "p_name": "name"})
