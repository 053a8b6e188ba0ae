"""The driver tables in the roles of study tables (mapping: FIXTURES.md section 3).

A query reads its whole tables: where a table plays two roles, even and odd row numbers are the two. ``ORACLE`` holds the same roles as SQL common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.staging import stage

LEVELS = ("bm", "cns")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- matrix and samples --------------------------------------------------------------------------


def cells(spark, sf) -> DataFrame:
    """feature = part, sample = supplier modulo 8, value = summed quantity."""
    from ..operators.matrix import sum_cells

    rows = table(spark, sf, "lineitem").select("l_partkey", (F.col("l_suppkey") % 8).alias("s"), "l_quantity")
    return sum_cells(rows, "l_partkey", "s", "l_quantity")


def samples(spark, sf) -> DataFrame:
    sample = F.col("s_suppkey") % 8
    return (
        table(spark, sf, "supplier")
        .select(sample.alias("sample"), F.when(sample < 4, LEVELS[0]).otherwise(LEVELS[1]).alias("condition"))
        .distinct()
    )


def grid(spark, sf) -> DataFrame:
    from ..operators.matrix import complete_grid

    return complete_grid(cells(spark, sf), samples(spark, sf))


def filled(spark, sf) -> DataFrame:
    from ..operators.matrix import replace_min

    # read by several aggregates of a study, so written once
    return stage(replace_min(grid(spark, sf)))


def normed(spark, sf) -> DataFrame:
    from ..operators.matrix import log_norm

    return log_norm(filled(spark, sf))


# --- positive and negative mode results ----------------------------------------------------------


def mode_results(spark, sf, parity: int, mark: str) -> DataFrame:
    name = F.concat(F.lit("u"), F.col("user_id"), F.lit(mark), F.col("event_id") % 3)
    return (
        table(spark, sf, "events")
        .filter(F.col("event_id") % 2 == parity)
        .select(name.alias("x"), (F.col("value") / 400).alias("p"), F.col("event_id").alias("ord"))
    )


def positive(spark, sf) -> DataFrame:
    return mode_results(spark, sf, 0, ".")


def negative(spark, sf) -> DataFrame:
    return mode_results(spark, sf, 1, ";")


# --- genes, compounds, pathways ------------------------------------------------------------------


def genes(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_name").alias("gene"), F.col("c_nationkey").alias("pathway_id"), (F.col("c_acctbal") / 1000).alias("gene_lfc")
    )


def compounds(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_name").alias("compound"), F.col("s_nationkey").alias("pathway_id"), (F.col("s_acctbal") / 1000).alias("compound_lfc")
    )


def pathways(spark, sf) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("pathway_id"), F.col("n_name").alias("pathway_name"))


def named_genes(spark, sf) -> DataFrame:
    return genes(spark, sf).join(pathways(spark, sf), "pathway_id").select("pathway_name", "gene", "gene_lfc")


def named_compounds(spark, sf) -> DataFrame:
    return compounds(spark, sf).join(pathways(spark, sf), "pathway_id").select("pathway_name", "compound", "compound_lfc")


def links(spark, sf) -> DataFrame:
    """compound → pathway: the nations of a supplier's customers would be many; its own nation is one."""
    return table(spark, sf, "supplier").select(F.col("s_name").alias("compound_id"), F.col("s_nationkey").alias("pathway_id"))


def brand_xref(spark, sf) -> DataFrame:
    """A dictionary with many values per key: brand → part, ordered by part."""
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("symbol"), F.col("p_partkey").alias("entrez"), F.col("p_partkey").alias("ord")
    )


def gene_sets(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_brand").alias("pathway_id"), F.col("p_type").alias("category"), F.col("p_partkey").alias("member"))


# --- sequencing reads ----------------------------------------------------------------------------


def reads(spark, sf) -> DataFrame:
    """Whole documents as reads; the same characters are the quality string. Two neighbouring documents are mates."""
    seq = F.translate(F.col("text"), "acgtn", "ACGTN")
    return table(spark, sf, "documents").select(
        F.col("source").alias("sample"),
        (F.col("doc_id") % 2 + 1).cast("int").alias("mate"),
        F.floor(F.col("doc_id") / 2).cast("long").alias("read_id"),
        seq.alias("seq"),
        F.col("text").alias("qual"),
    )


def paired_reads(spark, sf) -> DataFrame:
    """As :func:`reads`, one sample per pair."""
    return reads(spark, sf).withColumn("sample", F.concat(F.lit("s"), F.col("read_id") % 4))


def intervals(spark, sf) -> DataFrame:
    """Two hours from each event of odd number on; chromosome = user modulo 5, gene = event type."""
    return (
        table(spark, sf, "events")
        .filter(F.col("event_id") % 2 == 1)
        .select(
            F.col("event_type").alias("gene_id"),
            (F.col("user_id") % 5).alias("chrom"),
            event_seconds().alias("start"),
            (event_seconds() + 7200).alias("end"),
        )
    )


def event_seconds():
    """Whole seconds since 1970 of a zone-less timestamp, whatever the session's time zone is."""
    return F.expr(
        "date_diff(cast(ts as date), date'1970-01-01') * 86400L + hour(ts) * 3600L + minute(ts) * 60L + second(ts)"
    )


ORACLE = {
    "cells": "SELECT l_partkey AS feature, l_suppkey % 8 AS sample, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2",
    "samples": "SELECT DISTINCT s_suppkey % 8 AS sample, CASE WHEN s_suppkey % 8 < 4 THEN 'bm' ELSE 'cns' END AS condition FROM supplier",
    "grid": "SELECT f.feature, s.sample, c.value FROM (SELECT DISTINCT feature FROM cells) f CROSS JOIN samples s LEFT JOIN cells c ON c.feature = f.feature AND c.sample = s.sample",
    "filled": "SELECT feature, sample, coalesce(nullif(value, 0), min(CASE WHEN value > 0 THEN value END) OVER (PARTITION BY feature) / 5) AS value FROM grid",
    "offset_a": "SELECT min(abs(value)) / 10 AS a FROM filled WHERE value <> 0",
    "normed": "SELECT feature, sample, log10((value + sqrt(value * value + a * a)) / 2) AS value FROM filled, offset_a",
    "factors": """SELECT sample, exp(median(ln(value) - m)) AS size_factor FROM cells JOIN (
        SELECT feature, avg(ln(value)) AS m FROM cells WHERE value > 0 GROUP BY 1
        HAVING count(*) = (SELECT count(*) FROM samples)) USING (feature) GROUP BY 1""",
    "counts": "SELECT feature, sample, value / size_factor AS value FROM cells JOIN factors USING (sample)",
    "stats": """SELECT feature, count(value) FILTER (condition = 'bm') AS n1, count(value) FILTER (condition = 'cns') AS n2,
        avg(value) FILTER (condition = 'bm') AS m1, avg(value) FILTER (condition = 'cns') AS m2,
        var_samp(value) FILTER (condition = 'bm') AS v1, var_samp(value) FILTER (condition = 'cns') AS v2
        FROM normed JOIN samples USING (sample) GROUP BY 1""",
    "tt": """SELECT feature, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) AS t,
        n1 + n2 - 2 AS df FROM stats WHERE (n1 - 1) * v1 + (n2 - 1) * v2 > 0""",
    # six degrees of freedom: every grid row has eight samples
    "pv": """SELECT feature, t, df, 1 - abs(t) / sqrt(6 + t * t) * (1 + 0.5 * (6 / (6 + t * t)) + 0.375 * (6 / (6 + t * t)) * (6 / (6 + t * t))) AS p FROM tt""",
    "padj": """SELECT *, least(1, min(p * m / r) OVER (ORDER BY r DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS padj
        FROM (SELECT *, count(*) OVER () AS m, row_number() OVER (ORDER BY p, feature DESC) AS r FROM pv)""",
    "fc": """SELECT feature, m1, m2, m1 / m2 AS fc, log2(m1 / m2) AS log2fc FROM (
        SELECT feature, avg(value) FILTER (condition = 'bm') AS m1, avg(value) FILTER (condition = 'cns') AS m2
        FROM filled JOIN samples USING (sample) GROUP BY 1)""",
    "pos": "SELECT concat('u', user_id, '.', event_id % 3) AS x, value / 400 AS p, event_id AS ord FROM events WHERE event_id % 2 = 0",
    "neg": "SELECT concat('u', user_id, ';', event_id % 3) AS x, value / 400 AS p, event_id AS ord FROM events WHERE event_id % 2 = 1",
    "stacked": """SELECT regexp_replace(x, '[.;].*', '') AS x, p, ord, 'positive' AS mode, 0 AS source FROM pos WHERE p < 0.05
        UNION ALL SELECT regexp_replace(x, '[.;].*', '') AS x, p, ord, 'negative' AS mode, 1 AS source FROM neg WHERE p < 0.05""",
    "genes": "SELECT n_name AS pathway_name, c_name AS gene, c_acctbal / 1000 AS gene_lfc FROM customer JOIN nation ON n_nationkey = c_nationkey",
    "compounds": "SELECT n_name AS pathway_name, s_name AS compound, s_acctbal / 1000 AS compound_lfc FROM supplier JOIN nation ON n_nationkey = s_nationkey",
    "reads": "SELECT source AS sample, CAST(doc_id % 2 + 1 AS INTEGER) AS mate, doc_id // 2 AS read_id, translate(text, 'acgtn', 'ACGTN') AS seq, text AS qual FROM documents",
    "paired": "SELECT * REPLACE (concat('s', read_id % 4) AS sample) FROM reads",
    "spans": "SELECT event_type AS gene_id, user_id % 5 AS chrom, CAST(floor(epoch(ts)) AS BIGINT) AS start_s, CAST(floor(epoch(ts)) AS BIGINT) + 7200 AS end_s FROM events WHERE event_id % 2 = 1",
}


def with_roles(roles: str, body: str) -> str:
    """SQL text with the named roles as common table expressions, in the given order."""
    return "WITH " + ",\n".join(f"{r} AS ({ORACLE[r]})" for r in roles.split()) + "\n" + body
