"""Queries: combining results, look-ups, pathways, enrichment, mass features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric, text
from ..operators import enrichment, integration, rangejoin, relational, spectra
from ..operators.matrix import lfc_matrix
from ..sources import staging
from . import matrix_queries, roles
from .catalog import query, rounded
from .roles import with_roles

# --- combining the two ionisation modes ----------------------------------------------------------


def _stacked(spark, sf):
    parts = {
        mode: relational.filter_p(rows, "p", 0.05).withColumn("x", text.strip_name("x"))
        for mode, rows in (("positive", roles.positive(spark, sf)), ("negative", roles.negative(spark, sf)))
    }
    return relational.stack_modes(parts)


@query("filter_p", with_roles("pos", "SELECT x, round(p, 6) AS p, ord FROM pos WHERE p < 0.05"))
def filter_p(spark, sf):
    return rounded(relational.filter_p(roles.positive(spark, sf), "p", 0.05))


@query("strip_name", with_roles("neg", "SELECT x, regexp_replace(x, '[.;].*', '') AS stripped, ord FROM neg"))
def strip_name(spark, sf):
    return roles.negative(spark, sf).select("x", text.strip_name("x").alias("stripped"), "ord")


@query("stack_modes", with_roles("pos neg stacked", "SELECT x, round(p, 6) AS p, ord, mode, source FROM stacked"))
def stack_modes(spark, sf):
    return rounded(_stacked(spark, sf))


@query(
    "max_per_group_ties",
    with_roles("pos neg stacked", "SELECT x, round(p, 6) AS p, ord, mode, source FROM stacked QUALIFY p = max(p) OVER (PARTITION BY x)"),
)
def max_per_group_ties(spark, sf):
    return rounded(relational.max_per_group_ties(_stacked(spark, sf), "x", "p"))


@query(
    "max_per_group_first",
    with_roles(
        "pos neg stacked",
        "SELECT x, round(p, 6) AS p, ord, mode, source FROM stacked QUALIFY row_number() OVER (PARTITION BY x ORDER BY p DESC, source, ord) = 1",
    ),
)
def max_per_group_first(spark, sf):
    return rounded(relational.max_per_group_first(_stacked(spark, sf), "x", "p", ["source", "ord"]))


@query(
    "min_per_group_first",
    with_roles(
        "pos neg stacked",
        "SELECT x, round(p, 6) AS p, ord, mode, source FROM stacked QUALIFY row_number() OVER (PARTITION BY x ORDER BY stacked.p, source, ord) = 1",
    ),
)
def min_per_group_first(spark, sf):
    return rounded(relational.max_per_group_first(_stacked(spark, sf), "x", "p", ["source", "ord"], pick="min"))


@query("group_max", with_roles("pos neg stacked", "SELECT x, ord, mode, round(max(p) OVER (PARTITION BY x), 6) AS top FROM stacked"))
def group_max(spark, sf):
    return rounded(relational.group_max(_stacked(spark, sf), "x", "p", "top").select("x", "ord", "mode", "top"))


@query("select_polarity", with_roles("pos neg stacked", "SELECT x, round(p, 6) AS p, ord FROM stacked WHERE mode = 'negative'"))
def select_polarity(spark, sf):
    return rounded(relational.select_polarity(_stacked(spark, sf), "negative", "mode").select("x", "p", "ord"))


@query("select_positions", "SELECT event_id, event_type, value FROM events")
def select_positions(spark, sf):
    return relational.select_positions(roles.table(spark, sf, "events"), [1, 4, 5])


@query("columns_except", "SELECT * EXCLUDE (p_partkey) FROM part")
def columns_except(spark, sf):
    part = roles.table(spark, sf, "part")
    return part.select(relational.columns_except(part, "p_partkey"))


@query("rename", "SELECT n_nationkey AS pathway_id, n_name AS pathway_name, n_regionkey FROM nation")
def rename(spark, sf):
    return relational.rename(roles.table(spark, sf, "nation"), {"n_nationkey": "pathway_id", "n_name": "pathway_name"})


@query("neg_log10", with_roles("pos", "SELECT ord, CASE WHEN p = 0 THEN 'inf'::DOUBLE ELSE round(-log10(p), 6) END AS y FROM pos"))
def neg_log10(spark, sf):
    return rounded(roles.positive(spark, sf).select("ord", numeric.neg_log10("p").alias("y")))


@query(
    "split_peak_key",
    """SELECT l_orderkey, l_linenumber, try_cast(split_part(k, '__', 1) AS DOUBLE) AS mz, try_cast(split_part(k, '__', 2) AS DOUBLE) AS rt
    FROM (SELECT l_orderkey, l_linenumber, concat(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), '__', l_returnflag) AS k FROM lineitem)""",
)
def split_peak_key(spark, sf):
    key = F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit("__"), F.col("l_returnflag"))
    mz, rt = text.split_peak_key(key)
    return roles.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", mz.alias("mz"), rt.alias("rt"))


@query(
    "split_label_row",
    """WITH w AS (SELECT CAST(n_nationkey AS VARCHAR) AS k, CAST(n_regionkey AS VARCHAR) AS s1, n_name AS s2 FROM nation)
    SELECT 'value' AS part, k AS feature, 's1' AS sample, try_cast(s1 AS DOUBLE) AS value, NULL AS condition FROM w WHERE k <> '0'
    UNION ALL SELECT 'value', k, 's2', try_cast(s2 AS DOUBLE), NULL FROM w WHERE k <> '0'
    UNION ALL SELECT 'label', NULL, 's1', NULL, s1 FROM w WHERE k = '0' UNION ALL SELECT 'label', NULL, 's2', NULL, s2 FROM w WHERE k = '0'""",
)
def split_label_row(spark, sf):
    wide = roles.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("Sample"), F.col("n_regionkey").cast("string").alias("s1"), F.col("n_name").alias("s2")
    )
    values, samples = relational.split_label_row(wide, "Sample", "0")
    return (
        values.withColumn("part", F.lit("value"))
        .unionByName(samples.withColumn("part", F.lit("label")), allowMissingColumns=True)
        .select("part", "feature", "sample", "value", "condition")
    )


# --- look-ups ------------------------------------------------------------------------------------


@query(
    "lookup_first",
    """SELECT l_orderkey, l_linenumber, b AS symbol, v AS entrez FROM (SELECT l_orderkey, l_linenumber, concat('Brand#', CAST(l_quantity AS BIGINT)) AS b FROM lineitem)
    LEFT JOIN (SELECT p_brand, min(p_partkey) AS v FROM part GROUP BY 1) ON p_brand = b""",
)
def lookup_first(spark, sf):
    rows = roles.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("Brand#"), F.col("l_quantity").cast("long")).alias("symbol")
    )
    return relational.lookup_first(rows, roles.brand_xref(spark, sf), "symbol", "entrez")


@query(
    "translate_ids",
    "SELECT DISTINCT b AS symbol, p_partkey AS entrez FROM (SELECT DISTINCT concat('Brand#', CAST(l_quantity AS BIGINT)) AS b FROM lineitem) JOIN part ON p_brand = b",
)
def translate_ids(spark, sf):
    rows = roles.table(spark, sf, "lineitem").select(F.concat(F.lit("Brand#"), F.col("l_quantity").cast("long")).alias("symbol"))
    return relational.translate_ids(rows, roles.brand_xref(spark, sf), "symbol", "entrez")


@query("align_metadata", with_roles("cells samples", "SELECT feature, sample, value, condition FROM cells LEFT JOIN samples USING (sample)"))
def align_metadata(spark, sf):
    return relational.align_metadata(roles.cells(spark, sf), roles.samples(spark, sf))


@query(
    "attach_peaks",
    """SELECT l_orderkey, l_linenumber, l_quantity AS rt, nullif(l_tax, 0) AS mz, round(price, 4) AS price FROM lineitem
    LEFT JOIN (SELECT CAST(p_size AS DOUBLE) AS q, nullif(round(p_partkey % 9 / 100, 2), 0) AS x, avg(p_retailprice) AS price FROM part GROUP BY 1, 2)
    ON q = l_quantity AND x IS NOT DISTINCT FROM nullif(l_tax, 0)""",
)
def attach_peaks(spark, sf):
    matches = roles.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("rt"), F.nullif(F.col("l_tax"), F.lit(0.0)).alias("mz")
    )
    peaks = (
        roles.table(spark, sf, "part")
        .select(
            F.col("p_size").cast("double").alias("rt"),
            F.nullif(F.round(F.col("p_partkey") % 9 / 100, 2), F.lit(0.0)).alias("mz"),
            "p_retailprice",
        )
        .groupBy("rt", "mz")
        .agg(F.avg("p_retailprice").alias("price"))
    )
    return rounded(relational.attach_peaks(matches, peaks), 4)


@query(
    "name_compounds",
    "SELECT l_orderkey, l_linenumber, CAST(p_partkey AS VARCHAR) AS compound_id, p_name AS name FROM lineitem JOIN part ON p_partkey = l_partkey",
)
def name_compounds(spark, sf):
    matches = roles.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit(" "), F.col("l_partkey"), F.lit(" ")).alias("compound_id")
    )
    dim = roles.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("compound_id"), F.col("p_name").alias("name"), F.lit(1).alias("name_ord")
    )
    return relational.name_compounds(matches, dim)


@query(
    "find_compound",
    """SELECT w AS name, min(p_partkey) AS compound_id FROM (SELECT DISTINCT split_part(p_name, ' ', 2) AS w FROM part)
    JOIN part ON list_contains(string_split(lower(p_name), ' '), lower(w)) GROUP BY 1""",
)
def find_compound(spark, sf):
    part = roles.table(spark, sf, "part")
    names = part.select(F.get(F.split("p_name", " "), 1).alias("name"))
    dim = part.select(F.col("p_partkey").alias("compound_id"), F.col("p_partkey").alias("name_ord"), F.col("p_name").alias("name"))
    return relational.find_compound(names, dim)


@query(
    "find_compound_parts",
    """SELECT w AS name, min(p_partkey) AS compound_id FROM (SELECT DISTINCT substr(p_name, 3, 7) AS w FROM part)
    JOIN part ON contains(lower(p_name), lower(w)) WHERE w <> '' GROUP BY 1""",
)
def find_compound_parts(spark, sf):
    part = roles.table(spark, sf, "part")
    dim = part.select(F.col("p_partkey").alias("compound_id"), F.col("p_partkey").alias("name_ord"), F.col("p_name").alias("name"))
    return relational.find_compound_parts(part.select(F.substring("p_name", 3, 7).alias("name")), dim)


@query(
    "compound_pathways",
    "SELECT s_name AS compound_id, l_orderkey, l_linenumber, s_nationkey AS pathway_id FROM lineitem JOIN supplier ON s_suppkey = l_suppkey",
)
def compound_pathways(spark, sf):
    rows = roles.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("compound_id"), "l_orderkey", "l_linenumber")
    named = roles.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("compound_id"), F.col("s_nationkey").alias("pathway_id"), "s_name")
    out = relational.compound_pathways(rows, named)
    return out.join(named.select("compound_id", "s_name"), "compound_id").select(
        F.col("s_name").alias("compound_id"), "l_orderkey", "l_linenumber", "pathway_id"
    )


@query(
    "name_pathways",
    "SELECT c_nationkey - 1 AS pathway_id, c_name AS gene, n_name AS pathway_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey - 1",
)
def name_pathways(spark, sf):
    rows = roles.table(spark, sf, "customer").select((F.col("c_nationkey") - 1).alias("pathway_id"), F.col("c_name").alias("gene"))
    return relational.name_pathways(rows, roles.pathways(spark, sf))


# --- gene and compound integration ---------------------------------------------------------------


def _sides(spark, sf):
    return roles.named_genes(spark, sf), roles.named_compounds(spark, sf)


@query(
    "genes_to_pathways",
    "SELECT p_brand AS pathway_id, l_partkey AS entrez, round(avg(l_discount), 6) AS gene_lfc FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2",
)
def genes_to_pathways(spark, sf):
    genes = roles.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("entrez")).agg(F.avg("l_discount").alias("gene_lfc"))
    sets = roles.gene_sets(spark, sf).select("pathway_id", F.col("member").alias("entrez"))
    return rounded(integration.genes_to_pathways(genes, sets))


@query(
    "pair_by_pathway",
    with_roles("genes compounds", "SELECT pathway_name, gene, round(gene_lfc, 6) AS gene_lfc, compound, round(compound_lfc, 6) AS compound_lfc FROM genes JOIN compounds USING (pathway_name)"),
)
def pair_by_pathway(spark, sf):
    # a row is rounded once, not in each of its pairs
    return integration.pair_by_pathway(*[rounded(side) for side in _sides(spark, sf)])


_INTEGRATE = """SELECT pathway_name, string_agg(gene, ', ' ORDER BY gene, compound) AS genes, string_agg(compound, ', ' ORDER BY gene, compound) AS compounds,
    round(avg(gene_lfc), 9) AS avg_gene_lfc, round(avg(compound_lfc), 9) AS avg_compound_lfc"""


@query("integrate_pathways", with_roles("genes compounds", _INTEGRATE + " FROM genes JOIN compounds USING (pathway_name) GROUP BY 1"))
def integrate_pathways(spark, sf):
    return rounded(integration.integrate_pathways(*_sides(spark, sf)), 9)


@query(
    "pathway_members",
    with_roles(
        "genes compounds",
        """SELECT pathway_name, 'gene' AS side, gene AS name, count(*) AS copies FROM genes JOIN compounds USING (pathway_name) GROUP BY 1, 3
        UNION ALL SELECT pathway_name, 'compound', compound, count(*) FROM genes JOIN compounds USING (pathway_name) GROUP BY 1, 3""",
    ),
)
def pathway_members(spark, sf):
    return integration.pathway_members(*_sides(spark, sf))


@query(
    "compare_lists",
    with_roles(
        "genes compounds",
        _INTEGRATE
        + ", 'up' AS direction FROM genes JOIN compounds USING (pathway_name) WHERE gene_lfc > 0 AND compound_lfc > 0 GROUP BY 1 UNION ALL "
        + _INTEGRATE
        + ", 'down' AS direction FROM genes JOIN compounds USING (pathway_name) WHERE gene_lfc < 0 AND compound_lfc < 0 GROUP BY 1",
    ),
)
def compare_lists(spark, sf):
    return rounded(integration.compare_lists(*_sides(spark, sf), cut=0.0), 9)


@query(
    "split_direction",
    with_roles("genes", "SELECT pathway_name, gene, round(gene_lfc, 6) AS gene_lfc, CASE WHEN gene_lfc > 1 THEN 'up' ELSE 'down' END AS side FROM genes WHERE abs(gene_lfc) > 1"),
)
def split_direction(spark, sf):
    up, down = relational.split_direction(roles.named_genes(spark, sf), "gene_lfc", 1.0)
    return rounded(relational.union_all(up.withColumn("side", F.lit("up")), down.withColumn("side", F.lit("down"))))


_MEANS = "SELECT pathway_name, avg(gene_lfc) AS g, avg(compound_lfc) AS c FROM genes JOIN compounds USING (pathway_name) GROUP BY 1"


@query(
    "melt_lfc",
    with_roles(
        "genes compounds",
        f"SELECT pathway_name, 'avg_gene_lfc' AS type, round(g, 9) AS log_fold_change FROM ({_MEANS}) UNION ALL SELECT pathway_name, 'avg_compound_lfc', round(c, 9) FROM ({_MEANS})",
    ),
)
def melt_lfc(spark, sf):
    return rounded(integration.melt_lfc(integration.pathway_means(*_sides(spark, sf))), 9)


@query("lfc_matrix", with_roles("genes compounds", f"SELECT pathway_name, round(g, 9) AS avg_gene_lfc, round(c, 9) AS avg_compound_lfc FROM ({_MEANS})"))
def lfc_matrix_query(spark, sf):
    return rounded(lfc_matrix(integration.pathway_means(*_sides(spark, sf))), 9)


_NAMED = "SELECT nullif(n_name, 'NATION_0') AS pathway_name, s_acctbal / 1000 - 5 AS lfc FROM supplier JOIN nation ON n_nationkey = s_nationkey"


def _named_rows(spark, sf):
    rows = roles.compounds(spark, sf).join(roles.pathways(spark, sf), "pathway_id")
    return rows.select(F.nullif(F.col("pathway_name"), F.lit("NATION_0")).alias("pathway_name"), (F.col("compound_lfc") - 5).alias("lfc"))


_PATH_MEANS = f"SELECT pathway_name, round(avg(lfc), 9) AS avg_lfc, CASE WHEN avg(lfc) > 0 THEN 'Upregulated' ELSE 'Downregulated' END AS direction FROM ({_NAMED}) GROUP BY 1"


@query("pathway_mean_lfc", _PATH_MEANS)
def pathway_mean_lfc(spark, sf):
    return rounded(integration.pathway_mean_lfc(_named_rows(spark, sf)), 9)


@query("label_direction", f"SELECT direction, count(*) AS n FROM ({_PATH_MEANS}) GROUP BY 1")
def label_direction(spark, sf):
    means = integration.pathway_mean_lfc(_named_rows(spark, sf))
    return means.groupBy("direction").agg(F.count(F.lit(1)).alias("n"))


@query("pathway_counts", f"SELECT pathway_name, count(*) AS n FROM ({_NAMED}) GROUP BY 1")
def pathway_counts(spark, sf):
    return integration.pathway_counts(_named_rows(spark, sf))


@query(
    "top_pathways_up_down",
    f"""WITH m AS ({_PATH_MEANS}) (SELECT * FROM m WHERE direction = 'Upregulated' ORDER BY avg_lfc DESC, pathway_name LIMIT 10)
    UNION ALL (SELECT * FROM m WHERE direction = 'Downregulated' ORDER BY avg_lfc, pathway_name LIMIT 10)""",
)
def top_pathways_up_down(spark, sf):
    means = rounded(integration.pathway_mean_lfc(_named_rows(spark, sf)), 9)
    return relational.top_pathways_up_down(means, 10)


@query(
    "top_pathways_by_count",
    f"""SELECT *, row_number() OVER (ORDER BY n, pathway_name DESC NULLS FIRST) AS display_order FROM
    (SELECT pathway_name, count(*) AS n FROM ({_NAMED}) GROUP BY 1 ORDER BY n DESC, pathway_name NULLS LAST LIMIT 20)""",
)
def top_pathways_by_count(spark, sf):
    return relational.top_pathways_by_count(integration.pathway_counts(_named_rows(spark, sf)))


@query(
    "order_by_group_mean",
    f"SELECT pathway_name, round(mean, 9) AS mean, dense_rank() OVER (ORDER BY mean) AS display_order FROM (SELECT pathway_name, avg(lfc) AS mean FROM ({_NAMED}) GROUP BY 1)",
)
def order_by_group_mean(spark, sf):
    return rounded(relational.order_by_group_mean(_named_rows(spark, sf), "pathway_name", "lfc"), 9)


_BOTH = "pathway_name IN (SELECT pathway_name FROM genes) AND pathway_name IN (SELECT pathway_name FROM compounds)"


@query(
    "network_nodes",
    with_roles(
        "genes compounds",
        f"""SELECT DISTINCT pathway_name AS name, 'Pathway' AS type FROM genes WHERE {_BOTH} UNION SELECT gene, 'Gene' FROM genes WHERE {_BOTH}
        UNION SELECT compound, 'Compound' FROM compounds WHERE {_BOTH}""",
    ),
)
def network_nodes(spark, sf):
    return integration.network_nodes(*_sides(spark, sf))


_EDGES = """SELECT pathway_name AS src, gene AS dst, 'gene' AS kind, count(*) AS weight FROM genes JOIN compounds USING (pathway_name) GROUP BY 1, 2
    UNION ALL SELECT pathway_name, compound, 'compound', count(*) FROM genes JOIN compounds USING (pathway_name) GROUP BY 1, 2"""


@query("network_edges", with_roles("genes compounds", _EDGES))
def network_edges(spark, sf):
    return integration.network_edges(*_sides(spark, sf), compound_edges=True)


@query(
    "network_edge_table",
    with_roles("genes compounds", "SELECT pathway_name AS src, gene AS dst, compound FROM genes JOIN compounds USING (pathway_name)"),
)
def network_edge_table(spark, sf):
    return integration.network_edge_table(*_sides(spark, sf))


@query(
    "node_degree",
    with_roles(
        "genes compounds",
        f"""SELECT name, type, CAST(sum(weight) AS BIGINT) AS degree FROM (SELECT src AS name, 'Pathway' AS type, weight FROM ({_EDGES})
        UNION ALL SELECT dst, CASE kind WHEN 'gene' THEN 'Gene' ELSE 'Compound' END, weight FROM ({_EDGES})) GROUP BY 1, 2""",
    ),
)
def node_degree(spark, sf):
    return integration.node_degree(integration.network_edges(*_sides(spark, sf), compound_edges=True))


@query("distinct_values", "SELECT DISTINCT n_name AS name, 'Pathway' AS type FROM nation UNION SELECT CAST(n_regionkey AS VARCHAR), 'Region' FROM nation")
def distinct_values(spark, sf):
    return relational.distinct_values(roles.table(spark, sf, "nation"), {"n_name": "Pathway", "n_regionkey": "Region"})


@query("union_all", "SELECT c_name AS name, c_acctbal AS v FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def union_all(spark, sf):
    return relational.union_all(
        roles.table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("v")),
        roles.table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("v")),
    )


@query("drop_na", "SELECT l_orderkey, l_linenumber, t FROM (SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS t FROM lineitem) WHERE t IS NOT NULL")
def drop_na(spark, sf):
    rows = roles.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("t"))
    return relational.drop_na(rows)


@query("transpose", with_roles("cells", "SELECT sample AS feature, feature AS sample, value FROM cells"))
def transpose(spark, sf):
    return relational.transpose(roles.cells(spark, sf))


@query("split_rows", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def split_rows(spark, sf):
    return relational.split_rows(roles.table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", " ", "word")


@query("list_to_rows", "SELECT vec_id, round(CAST(unnest(embedding) AS DOUBLE), 5) AS v FROM embeddings")
def list_to_rows(spark, sf):
    rows = relational.list_to_rows(roles.table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding", "v")
    return rounded(rows.withColumn("v", F.col("v").cast("double")), 5)


# --- enrichment ----------------------------------------------------------------------------------


def _hits(spark, sf):
    tests = matrix_queries._tests(spark, sf)
    return relational.filter_p(tests, "p", 0.05).select(F.col("feature").alias("member"))


def _ora(spark, sf):
    return enrichment.ora(_hits(spark, sf), roles.gene_sets(spark, sf), min_size=1)


_LC = "(lgamma({0} + 1) - lgamma({1} + 1) - lgamma({0} - {1} + 1))"
_ORA_TABLES = (
    """, h AS (SELECT feature AS member FROM pv WHERE p < 0.05),
    s AS (SELECT p_brand AS pathway_id, count(*) AS set_size FROM part GROUP BY 1),
    c AS (SELECT (SELECT count(*) FROM part) AS nn, (SELECT count(*) FROM h JOIN part ON p_partkey = member) AS n),
    f AS (SELECT p_brand AS pathway_id, count(*) AS hit_count, string_agg(CAST(p_partkey AS VARCHAR), '/' ORDER BY p_partkey) AS gene_ids FROM part JOIN h ON member = p_partkey GROUP BY 1),
    o AS (SELECT pathway_id, hit_count, set_size, n, nn, gene_ids, (SELECT sum(exp("""
    + _LC.format("set_size", "x")
    + " + "
    + _LC.format("(nn - set_size)", "(n - x)")
    + " - "
    + _LC.format("nn", "n")
    + """)) FROM range(hit_count, least(set_size, n) + 1) r(x)) AS p FROM f JOIN s USING (pathway_id), c WHERE set_size BETWEEN 1 AND 500),
    a AS (SELECT *, least(1, min(p * m / r) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS padj,
      least(1, avg(CASE WHEN p >= 0.05 THEN 1.0 ELSE 0.0 END) OVER () / 0.95) AS pi0
      FROM (SELECT *, count(*) OVER () AS m, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS r FROM o))"""
)
_ORA_SELECT = """ SELECT pathway_id, concat(hit_count, '/', n) AS gene_ratio, concat(set_size, '/', nn) AS bg_ratio, round(p, 6) AS p, gene_ids, hit_count,
    round(padj, 6) AS padj, round(padj * pi0, 6) AS qvalue FROM a"""


def _ora_sql(select: str) -> str:
    return with_roles(matrix_queries.TT, _ORA_TABLES + select).replace("\n, h AS", ",\nh AS")


@query("ora", _ora_sql(_ORA_SELECT))
def ora(spark, sf):
    return rounded(_ora(spark, sf))


@query("top_pathways", _ora_sql(" SELECT pathway_id, round(padj, 6) AS padj FROM a ORDER BY round(a.padj, 9), pathway_id LIMIT 10"))
def top_pathways(spark, sf):
    shown = _ora(spark, sf).select("pathway_id", F.round("padj", 9).alias("padj"))
    return rounded(relational.top_pathways(shown, 10))


@query("filter_category", "SELECT p_partkey, p_type FROM part WHERE regexp_matches(p_type, '(?i)econ|small')")
def filter_category(spark, sf):
    return relational.filter_category(roles.table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "econ|small", ignore_case=True)


@query(
    "top_metabolism",
    _ora_sql(" SELECT pathway_id, round(padj, 6) AS padj FROM a WHERE regexp_matches(pathway_id, '#1') ORDER BY round(a.padj, 9), pathway_id LIMIT 20"),
)
def top_metabolism(spark, sf):
    shown = _ora(spark, sf).select("pathway_id", F.round("padj", 9).alias("padj"))
    shown = relational.top_pathways(relational.filter_category(shown, "pathway_id", "#1"), 20)
    return rounded(shown)


# --- mass features -------------------------------------------------------------------------------


def _peaks(spark, sf):
    """m/z = unit price of a line, rt = its day; p from the discount."""
    return roles.table(spark, sf, "lineitem").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber").alias("peak_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("mz"),
        F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double").alias("rt"),
        F.lit("positive").alias("polarity"),
        F.col("l_discount").alias("p"),
    )


def _masses(spark, sf):
    return roles.table(spark, sf, "part").select(F.col("p_partkey").alias("compound_id"), F.col("p_retailprice").alias("mass"))


def _adducts(spark, sf):
    """One form per region, shifted by its key: region 0 is the mass itself."""
    return roles.table(spark, sf, "region").select(
        F.col("r_name").alias("adduct"), F.col("r_regionkey").cast("double").alias("shift"), F.lit(1).alias("charge"), F.lit("positive").alias("polarity")
    )


_MATCH = """WITH pk AS (SELECT concat(l_orderkey, '_', l_linenumber) AS peak_id, l_extendedprice / l_quantity AS mz,
      CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS rt FROM lineitem),
    th AS (SELECT p_partkey AS compound_id, r_name AS adduct, p_retailprice + CAST(r_regionkey AS DOUBLE) AS theory FROM part, region),
    mt AS (SELECT peak_id, compound_id, adduct, mz, rt, theory FROM pk JOIN th ON mz BETWEEN theory - theory * 10 / 1e6 AND theory + theory * 10 / 1e6 WHERE abs(mz - theory) <= theory * 10 / 1e6)
    """


def _match(spark, sf):
    return spectra.match_mass(_peaks(spark, sf), _masses(spark, sf), _adducts(spark, sf), ppm=10)


@query("match_mass", _MATCH + "SELECT peak_id, compound_id, adduct, mz, round(theory, 4) AS theory FROM mt")
def match_mass(spark, sf):
    return _match(spark, sf).select("peak_id", "compound_id", "adduct", "mz", F.round("theory", 4).alias("theory"))


_COMPOUNDS = """, d AS (SELECT DISTINCT compound_id, rt, CAST(floor(rt / 40) AS BIGINT) AS c FROM mt), w AS (SELECT compound_id, c, count(*) AS w FROM d GROUP BY 1, 2),
    s AS (SELECT o.compound_id, o.c, o.w FROM w o LEFT JOIN w l ON l.compound_id = o.compound_id AND l.c = o.c - 1
      LEFT JOIN w r ON r.compound_id = o.compound_id AND r.c = o.c + 1 WHERE o.w > coalesce(l.w, 0) AND o.w >= coalesce(r.w, 0)),
    n AS (SELECT o.compound_id, o.c, CASE WHEN m.w IS NOT NULL THEN o.c WHEN l.w IS NOT NULL AND l.w >= coalesce(r.w, 0) THEN o.c - 1 WHEN r.w IS NOT NULL THEN o.c + 1 ELSE o.c END AS g
      FROM w o LEFT JOIN s m ON m.compound_id = o.compound_id AND m.c = o.c LEFT JOIN s l ON l.compound_id = o.compound_id AND l.c = o.c - 1
      LEFT JOIN s r ON r.compound_id = o.compound_id AND r.c = o.c + 1),
    e AS (SELECT compound_id, rt, concat(compound_id, '_', g) AS ec_id FROM d JOIN n USING (compound_id, c))"""


@query(
    "empirical_compounds",
    _MATCH
    + _COMPOUNDS
    + " SELECT peak_id, compound_id, adduct, rt, ec_id FROM mt JOIN e USING (compound_id, rt)",
)
def empirical_compounds(spark, sf):
    forms, members = spectra.mass_classes(_masses(spark, sf))
    matches = spectra.match_mass(_peaks(spark, sf), forms, _adducts(spark, sf), ppm=10).select("peak_id", "compound_id", "adduct", "rt")
    return spectra.empirical_compounds(staging.stage(matches), 60.0, members).select("peak_id", "compound_id", "adduct", "rt", "ec_id")


def _mass_links(spark, sf):
    return roles.table(spark, sf, "part").select(F.col("p_partkey").alias("compound_id"), F.col("p_brand").alias("pathway_id"))


def _mummichog(spark, sf):
    return enrichment.mummichog(
        _peaks(spark, sf), _masses(spark, sf), _adducts(spark, sf), _mass_links(spark, sf), ppm=10, rt_window=60.0, n_perm=100
    )


@query("mummichog")
def mummichog(spark, sf):
    return rounded(_mummichog(spark, sf))


@query(
    "mummichog_hits",
    _MATCH
    + _COMPOUNDS
    + """, k AS (SELECT concat(l_orderkey, '_', l_linenumber) AS peak_id FROM lineitem WHERE l_discount < 0.05),
    h AS (SELECT DISTINCT compound_id, ec_id FROM mt JOIN e USING (compound_id, rt) JOIN k USING (peak_id)),
    z AS (SELECT p_brand AS pathway_id, count(DISTINCT ec_id) AS set_size FROM e JOIN part ON p_partkey = compound_id GROUP BY 1),
    f AS (SELECT p_brand AS pathway_id, count(*) AS hit_count FROM h JOIN part ON p_partkey = compound_id GROUP BY 1),
    c AS (SELECT (SELECT count(DISTINCT ec_id) FROM e) AS nn, (SELECT count(*) FROM h) AS n)
    SELECT pathway_id, set_size, hit_count, n AS n_drawn, round((SELECT sum(exp("""
    + _LC.format("set_size", "x")
    + " + "
    + _LC.format("(nn - set_size)", "(n - x)")
    + " - "
    + _LC.format("nn", "n")
    + ")) FROM range(hit_count, least(set_size, n) + 1) r(x)), 6) AS p FROM f JOIN z USING (pathway_id), c WHERE set_size >= 3",
)
def mummichog_hits(spark, sf):
    return rounded(_mummichog(spark, sf).drop("p_perm"))


@query("peaks_to_paths")
def peaks_to_paths(spark, sf):
    names = roles.table(spark, sf, "part").select(F.col("p_brand").alias("pathway_id"), F.col("p_brand").alias("pathway_name")).distinct()
    return rounded(enrichment.peaks_to_paths(_mummichog(spark, sf), names))


@query(
    "annotate_peaks",
    """WITH f AS (SELECT concat(l_orderkey, '_', l_linenumber) AS feature, l_extendedprice / l_quantity AS mz,
      CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS rt FROM lineitem),
    r AS (SELECT r_name AS rule, CAST(r_regionkey + 1 AS DOUBLE) AS delta FROM region)
    SELECT a.feature AS base, b.feature, rule, round(b.mz - a.mz, 6) AS mz_difference FROM f a JOIN f b ON a.rt = b.rt JOIN r ON abs(b.mz - (a.mz + delta)) <= 0.015
    WHERE a.feature <> b.feature""",
)
def annotate_peaks(spark, sf):
    features = _peaks(spark, sf).select(F.col("peak_id").alias("feature"), "mz", "rt", "polarity")
    rules = roles.table(spark, sf, "region").select(
        F.col("r_name").alias("rule"), (F.col("r_regionkey") + 1).cast("double").alias("delta"), F.lit("positive").alias("polarity")
    )
    return rounded(spectra.annotate_peaks(features, rules, 0.015, 0.5).drop("polarity"))


def _centroids(spark, sf):
    """Events as centroids: run = user modulo 4, scan = hour, m/z = 100 + event type's place, intensity = value."""
    place = F.array_position(F.array(*[F.lit(x) for x in ("click", "error", "purchase", "signup", "view")]), F.col("event_type"))
    return roles.table(spark, sf, "events").select(
        F.concat(F.lit("run"), F.col("user_id") % 4).alias("run"),
        F.floor(roles.event_seconds() / 3600).cast("int").alias("scan"),
        (roles.event_seconds() % 10_000_000).cast("double").alias("rt"),
        (F.lit(100.0) + place.cast("double") * 10 + (F.col("user_id") % 10).cast("double") / 2).alias("mz"),
        F.col("value").alias("intensity"),
    )


@query(
    "roi_filter",
    """WITH c AS (SELECT event_id, concat('run', user_id % 4) AS run, CAST(floor(floor(epoch(ts)) / 3600) AS INTEGER) AS scan, CAST(CAST(floor(epoch(ts)) AS BIGINT) % 10000000 AS DOUBLE) AS rt,
      100.0 + list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) * 10 + user_id % 10 / 2 AS mz, value AS intensity FROM events),
    t AS (SELECT *, floor(rt / 3600) AS sl, floor(mz / 0.01) AS mb FROM c),
    s AS (SELECT run, sl, sum(intensity) AS s FROM t GROUP BY 1, 2),
    k AS (SELECT run, sl FROM (SELECT run, sl, sum(s) OVER (PARTITION BY run ORDER BY s.s DESC, sl) - s AS b, sum(s) OVER (PARTITION BY run) AS a FROM s) WHERE b < 0.9 * a),
    n AS (SELECT run, count(DISTINCT scan) AS n FROM c GROUP BY 1),
    x AS (SELECT run, mb FROM (SELECT run, mb, count(DISTINCT scan) AS m FROM t GROUP BY 1, 2) JOIN n USING (run) WHERE m > 0.9 * n)
    SELECT run, scan, rt, CAST(mz AS DOUBLE) AS mz, intensity FROM t JOIN k USING (run, sl) WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.run = t.run AND x.mb = t.mb)""",
)
def roi_filter(spark, sf):
    return spectra.roi_filter(_centroids(spark, sf), 0.9, True, 3600.0, 0.01, 0.9)


@query("peak_profile")
def peak_profile(spark, sf):
    return rounded(spectra.peak_profile(_centroids(spark, sf), ppm=10.0, max_gap=24, min_scans=3, rt_tol=7200.0), 4)


@query(
    "overlap_join",
    with_roles(
        "spans",
        """, pts AS (SELECT event_id, user_id % 5 AS chrom, CAST(floor(epoch(ts)) AS BIGINT) AS pos FROM events WHERE event_id % 2 = 0)
        SELECT event_id, pos, gene_id, start_s AS "start", end_s AS "end", pts.chrom FROM pts JOIN spans ON pts.chrom = spans.chrom AND pos BETWEEN start_s AND end_s""",
    ).replace("\n, pts AS", ",\npts AS"),
)
def overlap_join(spark, sf):
    points = (
        roles.table(spark, sf, "events")
        .filter(F.col("event_id") % 2 == 0)
        .select("event_id", (F.col("user_id") % 5).alias("chrom"), roles.event_seconds().alias("pos"))
    )
    return rangejoin.point_in_interval(points, roles.intervals(spark, sf), ["chrom"], "pos", "start", "end", 7200.0, crowded=True)
