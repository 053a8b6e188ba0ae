"""Over-representation of sets, for gene lists and for mass features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import safe_lt
from ..functions.tails import hypergeom_upper, once
from ..functions.text import ratio_text
from ..sources.staging import stage
from .adjust import adjust_bh, q_value
from .ordered import distinct_counts, running
from .spectra import empirical_compounds, mass_classes, match_mass


def _set_members(sets: DataFrame, universe: DataFrame | None) -> DataFrame:
    members = sets.select("pathway_id", "member").dropna().distinct()
    return members if universe is None else members.join(universe.select("member").distinct(), "member", "left_semi")


def ora(
    hits: DataFrame, sets: DataFrame, universe: DataFrame | None = None, min_size: int = 10, max_size: int = 500
) -> DataFrame:
    """Hypergeometric over-representation of ``hits`` (member) in every set of allowed size with a hit.

    Background and hits are the members of any set (inside ``universe`` if given). All tested sets are
    returned; a cut-off is a filter on the result. The size limit is part of the test and also
    bounds the joined id list of a set.
    """
    members = _set_members(sets, universe)
    drawn = hits.select("member").distinct().withColumn("hit", F.lit(True))
    # every figure below is read off this one table
    marked = stage(members.join(drawn, "member", "left").withColumn("hit", F.coalesce("hit", F.lit(False))))
    totals = marked.select("member", "hit").distinct().agg(F.struct(F.count_if("hit").alias("drawn"), F.count(F.lit(1)).alias("all"))).scalar()
    counts = marked.groupBy("pathway_id").agg(F.count(F.lit(1)).alias("set_size"), F.count_if("hit").alias("hit_count"))
    allowed = counts.filter(F.col("set_size").between(min_size, max_size) & (F.col("hit_count") > 0))
    ids = marked.filter("hit").join(allowed.select("pathway_id"), "pathway_id", "left_semi").groupBy("pathway_id")
    found = allowed.join(ids.agg(F.array_sort(F.collect_list("member")).alias("_ids")), "pathway_id")
    tested = found.withColumn("_t", totals).withColumns({"n_drawn": F.col("_t.drawn"), "n_background": F.col("_t.all")})
    tested = stage(
        tested.withColumn("p", once(hypergeom_upper("hit_count", "n_drawn", "set_size", "n_background"))).select(
            "pathway_id",
            ratio_text("hit_count", "n_drawn").alias("gene_ratio"),
            ratio_text("set_size", "n_background").alias("bg_ratio"),
            "p",
            F.array_join(F.transform("_ids", lambda x: x.cast("string")), "/").alias("gene_ids"),
            "hit_count",
        )
    )
    return q_value(adjust_bh(tested, "p"), "p")


def mummichog(
    peaks: DataFrame,
    compounds: DataFrame,
    adducts: DataFrame,
    links: DataFrame,
    ppm: float = 4.3,
    rt_window: float = 0.02,
    p_cut: float = 0.05,
    min_size: int = 3,
    n_perm: int = 100,
    seed: int = 1,
) -> DataFrame:
    """Pathway activity straight from mass features (peak_id, mz, rt, polarity, p).

    Significant peaks are matched to candidate compounds, co-eluting forms of a compound are one
    empirical compound, and pathways are tested for the empirical compounds hit. The null draws the same
    number of peaks ``n_perm`` times: draw d takes the peaks with the smallest hashes of peak and d, so the result does not
    depend on partitioning. A peak holds its part in all draws as bits of a few words (bit 0: the real list), an empirical
    compound the OR of its peaks', and a pathway's hits in every draw are counted from the words; no row stands for a peak
    and a draw. Compounds of the same masses (isomers) are matched and grouped once and counted as often as there are. ``p_perm`` is the share of permuted pathway p-values that are at least as small.
    """
    linked = links.select("compound_id", "pathway_id").dropna().distinct()
    # compounds of the same masses match the same peaks: the first one of each such class stands for all of it
    forms, members = mass_classes(compounds.join(linked.select("compound_id").distinct(), "compound_id", "left_semi"))
    matches = stage(match_mass(peaks, forms, adducts, ppm).select("peak_id", "compound_id", "rt"))
    empirical = stage(empirical_compounds(matches, rt_window).select("peak_id", "compound_id", "ec_id").distinct())
    in_class = members.groupBy(F.col("first").alias("compound_id")).agg(F.count(F.lit(1)).alias("n"))
    in_path = members.join(linked, "compound_id").groupBy(F.col("first").alias("compound_id"), "pathway_id").agg(F.count(F.lit(1)).alias("n"))
    listed = stage(peaks.groupBy("peak_id").agg(F.min("p").alias("p")).select("peak_id", "p", F.xxhash64("peak_id", F.lit(seed)).alias("h")))
    drawn = draw_words(listed.select("peak_id", "h", F.coalesce(safe_lt("p", p_cut), F.lit(False)).alias("real")), n_perm)
    words = [c for c in drawn.columns if c != "peak_id"]
    found = stage(empirical.join(drawn, "peak_id").groupBy("compound_id", "ec_id").agg(*[F.bit_or(c).alias(c) for c in words]))
    sizes = found.groupBy("compound_id").agg(F.count(F.lit(1)).alias("forms")).join(in_path, "compound_id")
    sizes = sizes.groupBy("pathway_id").agg(F.sum(F.col("forms") * F.col("n")).alias("set_size")).filter(F.col("set_size") >= min_size)
    weighed = found.join(in_class, "compound_id")
    n_hit = bit_counts(weighed.select(F.lit("").alias("all"), *words, "n"), "all", n_perm + 1, weight="n").select("bit", F.col("n").alias("n_drawn"))
    tested = (
        bit_counts(found.join(in_path, "compound_id").select("pathway_id", *words, "n"), "pathway_id", n_perm + 1, weight="n")
        .select("pathway_id", F.col("bit").alias("perm"), F.col("n").alias("hit_count"))
        .join(sizes, "pathway_id")
        .join(n_hit.withColumnRenamed("bit", "perm"), "perm")
        .withColumn("n_background", weighed.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar())
        .withColumn("p", once(hypergeom_upper("hit_count", "n_drawn", "set_size", "n_background")))
    )
    tested = stage(tested)
    # permuted p-values below or at each real one: the permuted rows weigh one, the real ones nothing
    weight = F.when(F.col("perm") > 0, 1).otherwise(0)
    below = running(distinct_counts(tested, [], "p", weight), [], "p").select(
        F.col("p").alias("_p"), F.try_divide("upto", "total").alias("p_perm")
    )
    shown = tested.filter(F.col("perm") == 0)
    return shown.join(below, shown["p"] == below["_p"]).select("pathway_id", "set_size", "hit_count", "n_drawn", "p", "p_perm")


_STEP = np.uint64(0x9E3779B97F4A7C15)
_ROWS = 4096  # peaks whose hashes of all draws are held at a time
_FEW = 4096  # hashes of a draw that may reach the driver


def draw_hashes(h: np.ndarray, n_perm: int) -> np.ndarray:
    """(peaks, draws): a 64-bit hash for each draw, made of the peaks' own ones (the finaliser of splitmix64)."""
    x = h.view(np.uint64)[:, None] + np.arange(1, n_perm + 1, dtype=np.uint64)[None, :] * _STEP
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _draw_limits(peaks: DataFrame, k: int, n_perm: int) -> np.ndarray:
    """For each draw the k-th smallest hash of all peaks (h).

    A pass counts by byte the hashes that share the bytes found so far, in 256 bins a draw and task; the bin of the k-th
    one gives the next byte. Once that holds a few thousand, its hashes are sorted out on the driver.
    """
    prefix, need = np.zeros(n_perm, np.uint64), np.full(n_perm, k, np.int64)

    def inside(x: np.ndarray, known: int, prefix: np.ndarray) -> np.ndarray:
        return x >> np.uint64(64 - 8 * known) == prefix[None, :] if known else np.ones(x.shape, bool)

    for known in range(8):

        def count(batches: Iterator[pa.RecordBatch], known=known, prefix=prefix) -> Iterator[pa.RecordBatch]:
            total = np.zeros(n_perm * 256, np.int64)
            for batch in batches:
                h = batch.column(0).to_numpy()
                for first in range(0, len(h), _ROWS):
                    x = draw_hashes(h[first : first + _ROWS], n_perm)
                    cell = (x >> np.uint64(56 - 8 * known) & np.uint64(255)).astype(np.int64) + 256 * np.arange(n_perm)
                    total += np.bincount(cell[inside(x, known, prefix)], minlength=len(total))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

        found = peaks.select("h").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        bins = np.zeros(n_perm * 256, np.int64)
        bins[found["cell"]] = found["n"]
        upto = bins.reshape(n_perm, 256).cumsum(axis=1)
        at = (upto < need[:, None]).sum(axis=1)
        rows = np.arange(n_perm)
        held = bins.reshape(n_perm, 256)[rows, at]
        need = need - (upto[rows, at] - held)
        prefix = prefix << np.uint64(8) | at.astype(np.uint64)
        if known == 7:
            return prefix
        if held.max() <= _FEW:
            break
    last, seen = prefix, known + 1

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy()
            for first in range(0, len(h), _ROWS):
                x = draw_hashes(h[first : first + _ROWS], n_perm)
                row, draw = np.nonzero(inside(x, seen, last))
                yield pa.RecordBatch.from_arrays([pa.array(draw), pa.array(x[row, draw].view(np.int64))], names=["draw", "x"])

    # at most _FEW rows a draw
    edge = peaks.select("h").mapInArrow(edges, "draw long, x long").toPandas()
    x, draw = edge["x"].to_numpy().view(np.uint64), edge["draw"].to_numpy()
    return np.array([np.sort(x[draw == d])[need[d] - 1] for d in range(n_perm)], np.uint64)


def draw_words(peaks: DataFrame, n_perm: int) -> DataFrame:
    """(peak_id, w0, w1 …) of peaks (peak_id, h, real): bit 0 of the words is ``real``, bit d the part in draw d.

    Every draw takes as many peaks as there are real ones (one more only if two 64-bit hashes are equal at its end).
    """
    n_words = n_perm // 64 + 1
    k = peaks.agg(F.count_if("real")).first()[0]
    limits = _draw_limits(peaks, k, n_perm) if k else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, real = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            bits = np.zeros((len(h), 64 * n_words), bool)
            bits[:, 0] = real
            for first in range(0, len(h) if limits is not None else 0, _ROWS):
                bits[first : first + _ROWS, 1 : n_perm + 1] = draw_hashes(h[first : first + _ROWS], n_perm) <= limits
            words = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(words[:, i].copy()) for i in range(n_words)]], names=names)

    names = ["peak_id", *[f"w{i}" for i in range(n_words)]]
    kind = peaks.schema["peak_id"].dataType.simpleString()
    return peaks.select("peak_id", "h", "real").mapInArrow(run, ", ".join([f"peak_id {kind}", *[f"{c} long" for c in names[1:]]]))


def bit_counts(rows: DataFrame, key: str, n_bits: int, most: int = 20_000, weight: str | None = None) -> DataFrame:
    """(key, bit, n) with n > 0: in how many rows of a key each bit of the words is set; a row counts ``weight`` times.

    Tasks add up the bits of their rows for each key, for at most ``most`` keys at a time, before anything is shuffled.
    """
    words = [c for c in rows.columns if c not in (key, weight)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[object, np.ndarray] = {}

        def told() -> pa.RecordBatch:
            lists = pa.array([v.tolist() for v in held.values()], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(list(held), kind), lists], names=[key, "n"])

        kind = pa.null()
        for batch in batches:
            kind = batch.column(0).type
            if not batch.num_rows:
                continue
            coded = batch.column(0).dictionary_encode()
            of = coded.indices.to_numpy()
            order = np.argsort(of, kind="stable")
            packed = np.stack([batch.column(1 + i).to_numpy() for i in range(len(words))], axis=1)[order]
            starts = np.flatnonzero(np.append(True, np.diff(of[order]) != 0))
            bits = np.unpackbits(packed.view(np.uint8), axis=1, bitorder="little", count=n_bits)
            if weight:
                bits = bits * batch.column(1 + len(words)).to_numpy()[order][:, None]
            sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
            for name, total in zip(coded.dictionary.take(pa.array(of[order][starts])).to_pylist(), sums, strict=True):
                held[name] = held[name] + total if name in held else total
            if len(held) >= most:
                yield told()
                held = {}
        if held:
            yield told()

    kind = rows.schema[key].dataType.simpleString()
    parts = rows.select(key, *words, *([weight] if weight else [])).mapInArrow(run, f"{key} {kind}, n array<long>")
    cells = parts.select(key, F.posexplode("n").alias("bit", "n")).filter("n > 0")
    return cells.groupBy(key, "bit").agg(F.sum("n").alias("n"))


def peaks_to_paths(result: DataFrame, pathways: DataFrame) -> DataFrame:
    """The table behind the pathway plot: name, hits, size, enrichment factor and both p-values."""
    factor = F.try_divide(F.col("hit_count"), F.col("set_size"))
    named = result.join(pathways.select("pathway_id", "pathway_name"), "pathway_id", "left")
    return named.select("pathway_id", "pathway_name", "hit_count", "set_size", factor.alias("hit_share"), "p", "p_perm")
