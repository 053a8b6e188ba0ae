"""Genes and compounds joined per pathway.

Only :func:`pair_by_pathway` forms gene × compound rows, because that table is its result. Everything
derived from it is computed from one aggregate per side, so a pathway costs genes + compounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import avg_if_complete, avg_skip_nan, label_sign
from .relational import distinct_values, split_direction
from .skew import pair_join, spread_join


def genes_to_pathways(genes: DataFrame, gene_sets: DataFrame) -> DataFrame:
    """Inner join of genes (entrez, …) with pathway members (entrez, pathway_name)."""
    return spread_join(gene_sets, genes, ["entrez"])


def pair_by_pathway(genes: DataFrame, compounds: DataFrame) -> DataFrame:
    """Every gene row with every compound row of its pathway."""
    return pair_join(genes, compounds, ["pathway_name"])


def _sides(genes: DataFrame, compounds: DataFrame) -> DataFrame:
    g = genes.groupBy("pathway_name").agg(F.count(F.lit(1)).alias("n_genes"), avg_if_complete("gene_lfc").alias("avg_gene_lfc"))
    c = compounds.groupBy("pathway_name").agg(
        F.count(F.lit(1)).alias("n_compounds"), avg_if_complete("compound_lfc").alias("avg_compound_lfc")
    )
    return g.join(c, "pathway_name")


def pathway_means(genes: DataFrame, compounds: DataFrame) -> DataFrame:
    """Per pathway with genes and compounds: mean changes and row counts of both sides; one aggregate per side."""
    return _sides(genes, compounds).select("pathway_name", "avg_gene_lfc", "avg_compound_lfc", "n_genes", "n_compounds")


def integrate_pathways(genes: DataFrame, compounds: DataFrame, distinct_names: bool = False) -> DataFrame:
    """Per pathway with genes and compounds: mean changes of both sides and the two name lists as text.

    Equal to aggregating the pair table: each gene is listed once per compound row of the pathway and the
    other way round (``distinct_names`` lists each once), in name order. The texts are for a report: they are as long
    as the pair table. :func:`pathway_means` and :func:`pathway_members` hold the same as numbers and rows.
    """
    sides = _sides(genes, compounds)

    def text(rows: DataFrame, column: str, other: str, blockwise: bool) -> DataFrame:
        """The joined names: each one repeated in place, or the whole list repeated; text is only built once, by repeating it."""
        if distinct_names:
            return rows.groupBy("pathway_name").agg(F.array_join(F.array_sort(F.collect_set(column)), ", ").alias(f"{column}s"))
        counted = rows.filter(F.col(column).isNotNull()).groupBy("pathway_name", column).agg(F.count(F.lit(1)).alias("_n"))
        times = F.col("_n") * F.col(other) if blockwise else F.col("_n")
        repeated = counted.join(sides.select("pathway_name", other), "pathway_name").withColumn("_part", _repeated(F.col(column), times))
        joined = repeated.groupBy("pathway_name", other).agg(F.array_sort(F.collect_list(F.struct(column, "_part"))).alias("_l"))
        once = F.array_join(F.transform("_l", lambda x: x["_part"]), ", ")
        return joined.select("pathway_name", (once if blockwise else _repeated(once, F.col(other))).alias(f"{column}s"))

    texts = text(genes, "gene", "n_compounds", True).join(text(compounds, "compound", "n_genes", False), "pathway_name", "full")
    return sides.join(texts, "pathway_name", "left").select(
        "pathway_name", F.coalesce("genes", F.lit("")).alias("genes"), F.coalesce("compounds", F.lit("")).alias("compounds"), "avg_gene_lfc", "avg_compound_lfc"
    )


def _repeated(text: Column, times: Column) -> Column:
    """The text ``times`` times, joined by commas."""
    return F.concat(F.repeat(F.concat(text, F.lit(", ")), (times - 1).cast("int")), text)


def pathway_members(genes: DataFrame, compounds: DataFrame) -> DataFrame:
    """The name lists as rows: pathway, side, name and how often the pair table repeats the name."""
    sides = _sides(genes, compounds)
    g = genes.groupBy("pathway_name", F.col("gene").alias("name")).agg(F.count(F.lit(1)).alias("_n"))
    c = compounds.groupBy("pathway_name", F.col("compound").alias("name")).agg(F.count(F.lit(1)).alias("_n"))
    parts = [
        rows.join(sides, "pathway_name").select("pathway_name", F.lit(side).alias("side"), "name", (F.col("_n") * F.col(other)).alias("copies"))
        for rows, side, other in ((g, "gene", "n_compounds"), (c, "compound", "n_genes"))
    ]
    return parts[0].unionByName(parts[1])


def compare_lists(genes: DataFrame, compounds: DataFrame, cut: float = 1.0, **options) -> DataFrame:
    """:func:`integrate_pathways` on the raised and on the lowered rows of both sides."""
    out = None
    for direction, g, c in zip(("up", "down"), split_direction(genes, "gene_lfc", cut), split_direction(compounds, "compound_lfc", cut)):
        part = integrate_pathways(g, c, **options).withColumn("direction", F.lit(direction))
        out = part if out is None else out.unionByName(part)
    return out


def melt_lfc(means: DataFrame) -> DataFrame:
    """The two mean columns as rows (type, log_fold_change)."""
    beside = ("avg_gene_lfc", "avg_compound_lfc", "genes", "compounds", "n_genes", "n_compounds")
    keys = [c for c in means.columns if c not in beside]
    return means.unpivot(keys, ["avg_gene_lfc", "avg_compound_lfc"], "type", "log_fold_change")


def pathway_mean_lfc(rows: DataFrame, name: str = "pathway_name", lfc: str = "lfc") -> DataFrame:
    """Mean change per pathway name and its direction; rows without a name form one group."""
    means = rows.groupBy(name).agg(avg_skip_nan(lfc).alias("avg_lfc"))
    return means.withColumn("direction", label_sign("avg_lfc"))


def pathway_counts(rows: DataFrame, name: str = "pathway_name") -> DataFrame:
    return rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def _in_both(genes: DataFrame, compounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    g_paths, c_paths = genes.select("pathway_name").distinct(), compounds.select("pathway_name").distinct()
    return genes.join(c_paths, "pathway_name", "left_semi"), compounds.join(g_paths, "pathway_name", "left_semi")


def network_nodes(genes: DataFrame, compounds: DataFrame) -> DataFrame:
    """Vertices (name, type); a name used in two roles gives two vertices."""
    g, c = _in_both(genes, compounds)
    return distinct_values(g, {"pathway_name": "Pathway", "gene": "Gene"}).unionByName(
        distinct_values(c, {"compound": "Compound"})
    )


def network_edges(genes: DataFrame, compounds: DataFrame, compound_edges: bool = False) -> DataFrame:
    """Pathway-gene edges with the number of parallel edges (one per compound row of the pathway).

    ``compound_edges`` adds the pathway-compound edges, so that compounds are not isolated vertices.
    """
    members = pathway_members(genes, compounds)
    if not compound_edges:
        members = members.filter(F.col("side") == "gene")
    return members.select(F.col("pathway_name").alias("src"), F.col("name").alias("dst"), F.col("side").alias("kind"), F.col("copies").alias("weight"))


def network_edge_table(genes: DataFrame, compounds: DataFrame) -> DataFrame:
    """Every parallel edge by itself with its attribute: pathway (src), gene (dst) and the compound it runs over."""
    pairs = pair_by_pathway(genes.select("pathway_name", "gene"), compounds.select("pathway_name", "compound"))
    return pairs.select(F.col("pathway_name").alias("src"), F.col("gene").alias("dst"), "compound")


def node_degree(edges: DataFrame) -> DataFrame:
    """Degree of every vertex, parallel edges counted."""
    ends = F.array(
        F.struct(F.col("src").alias("name"), F.lit("Pathway").alias("type")),
        F.struct(F.col("dst").alias("name"), F.initcap("kind").alias("type")),
    )
    return edges.select("weight", F.inline(ends)).groupBy("name", "type").agg(F.sum("weight").alias("degree"))
