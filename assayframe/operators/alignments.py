"""Aligned reads: order, blocks, and counts per gene."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .rangejoin import interval_overlap, merged_intervals

# fixed values: bits of the alignment flag
UNMAPPED, MATE_UNMAPPED, REVERSE, SECOND_MATE = 4, 8, 16, 128


def sort_alignments(alignments: DataFrame, partitions: int | None = None) -> DataFrame:
    """Order by chromosome and position: range partitions, sorted inside."""
    keys = [F.col("chrom"), F.col("pos"), F.col("read_id")]
    ranged = alignments.repartitionByRange(partitions, *keys) if partitions else alignments.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def flag_bits(alignments: DataFrame) -> DataFrame:
    """Add the decoded flag: unmapped, mate_unmapped, reverse, mate."""
    flag = F.col("flag")
    return alignments.withColumns(
        {
            "unmapped": flag.bitwiseAND(UNMAPPED) != 0,
            "mate_unmapped": flag.bitwiseAND(MATE_UNMAPPED) != 0,
            "reverse": flag.bitwiseAND(REVERSE) != 0,
            "mate": F.when(flag.bitwiseAND(SECOND_MATE) != 0, 2).otherwise(1),
        }
    )


def aligned_blocks(alignments: DataFrame) -> DataFrame:
    """One row per stretch aligned without an intron: block_start and block_end, 1-based and inclusive."""
    lengths = F.regexp_extract_all("cigar", F.lit(r"(\d+)([MIDNSHP=X])"), 1)
    kinds = F.regexp_extract_all("cigar", F.lit(r"(\d+)([MIDNSHP=X])"), 2)
    steps = F.zip_with(lengths, kinds, lambda n, op: F.struct(n.cast("int").alias("n"), op.alias("op")))
    empty = F.array().cast("array<struct<s:int,e:int>>")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("from"), empty.alias("done"))

    def step(acc, x):
        on_reference = x["op"].isin("M", "D", "=", "X")
        intron = x["op"] == "N"
        closed = F.concat(acc["done"], F.array(F.struct(acc["from"].alias("s"), (acc["at"] - 1).alias("e"))))
        moved = F.when(on_reference | intron, acc["at"] + x["n"]).otherwise(acc["at"])
        return F.struct(
            moved.alias("at"),
            F.when(intron, moved).otherwise(acc["from"]).alias("from"),
            F.when(intron & (acc["at"] > acc["from"]), closed).otherwise(acc["done"]).alias("done"),
        )

    def finish(acc):
        last = F.array(F.struct(acc["from"].alias("s"), (acc["at"] - 1).alias("e")))
        return F.when(acc["at"] > acc["from"], F.concat(acc["done"], last)).otherwise(acc["done"])

    blocks = F.aggregate(steps, start, step, finish)
    placed = alignments.select("*", F.inline(blocks))
    return placed.withColumns(
        {"block_start": F.col("pos") + F.col("s"), "block_end": F.col("pos") + F.col("e")}
    ).drop("s", "e")


def count_features(
    alignments: DataFrame,
    exons: DataFrame,
    strand: int = 2,
    paired: bool = True,
    both_mapped: bool = True,
    unit: str = "read",
    width: float = 16_384.0,
) -> DataFrame:
    """Reads (or fragments) per gene and sample, zero counts included.

    ``strand``: 0 ignored, 1 same strand as the first mate, 2 opposite. Multi-mapped reads and reads that
    touch exons of more than one gene are not counted.
    """
    if strand not in (0, 1, 2) or unit not in ("read", "fragment"):
        raise ValueError("strand is 0, 1 or 2; unit is read or fragment")
    reads = flag_bits(alignments).filter(~F.col("unmapped") & (F.col("nh") <= 1))
    if paired and both_mapped:
        reads = reads.filter(~F.col("mate_unmapped"))
    keys = ["sample", "read_id"] + (["mate"] if unit == "read" else [])
    forward = ~F.col("reverse")
    if paired:
        forward = forward == (F.col("mate") == 1)
    if strand == 2:
        forward = ~forward
    reads = reads.withColumn("strand", F.when(forward, "+").otherwise("-"))
    on = ["chrom"] + (["strand"] if strand else [])
    blocks = aligned_blocks(reads.select(*keys, "chrom", "pos", "cigar", "strand"))
    blocks = blocks.select(*keys, *on, "block_start", "block_end")
    genes = exons.select(*on, "gene_id", F.col("start").alias("exon_start"), F.col("end").alias("exon_end"))
    # a read touches a gene's exons where it touches what they cover: overlapping exons would only repeat the hit
    genes = merged_intervals(genes, [*on, "gene_id"], "exon_start", "exon_end")
    hits = interval_overlap(blocks, genes, on, ("block_start", "block_end"), ("exon_start", "exon_end"), width)
    one_gene = (
        hits.groupBy(*keys)
        .agg(F.min("gene_id").alias("gene_id"), F.max("gene_id").alias("_other"))
        .filter(F.col("gene_id") == F.col("_other"))
    )
    counts = one_gene.groupBy("gene_id", "sample").agg(F.count(F.lit(1)).alias("count"))
    samples = alignments.agg(F.array_sort(F.collect_set("sample"))).scalar()
    every = exons.select("gene_id").distinct().withColumn("_s", samples).select("gene_id", F.explode("_s").alias("sample"))
    return every.join(counts, ["gene_id", "sample"], "left").na.fill(0, ["count"])
