"""Projections, filters, look-ups, group picks and reshapes.

The source tables are ordered and several results depend on it ("first row", "first hit"). Spark tables
are not, so these operators take the order as an explicit column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import avg_skip_nan, label_direction, safe_gt, safe_lt
from ..functions.text import search_key
from ..sources.staging import stage
from .ordered import distinct_counts, running
from .skew import spread_join

POLARITIES = ("positive", "negative")


# --- projections and filters ---------------------------------------------------------------------


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Columns by 1-based position."""
    return df.select([df.columns[i - 1] for i in positions])


def columns_except(df: DataFrame, key: str) -> list[str]:
    return [c for c in df.columns if c != key]


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def filter_p(df: DataFrame, p: str, cut: float = 0.05) -> DataFrame:
    """Rows with p below the cut; a missing p is dropped."""
    return df.filter(safe_lt(p, cut))


def significant(df: DataFrame, padj: str = "padj", lfc: str = "log2fc", p_cut: float = 0.05, lfc_cut: float = 1.0) -> DataFrame:
    return df.filter(safe_lt(padj, p_cut) & safe_gt(F.abs(F.col(lfc)), lfc_cut))


def split_direction(df: DataFrame, lfc: str, cut: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """The rows above ``cut`` and the rows below ``-cut``."""
    return df.filter(safe_gt(lfc, cut)), df.filter(safe_lt(lfc, -cut))


def drop_unnamed(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNotNull())


def drop_na(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns."""
    return df.na.drop(subset=list(columns) if columns else None)


def filter_category(df: DataFrame, column: str, pattern: str = "Metabolism", ignore_case: bool = False) -> DataFrame:
    return df.filter(F.col(column).rlike(("(?i)" if ignore_case else "") + pattern))


def select_polarity(df: DataFrame, mode: str, column: str = "polarity") -> DataFrame:
    """Rows of one ionisation mode; any other mode, asked for or found, is an error."""
    if mode not in POLARITIES:
        raise ValueError(f"unknown ionisation mode {mode!r}")
    known = F.col(column).isin(*POLARITIES)
    checked = F.when(known, F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit("unknown ionisation mode "), F.coalesce(F.col(column), F.lit("null"))))
    )
    return df.filter(checked == mode)


def split_label_row(
    wide: DataFrame, key: str = "Sample", label: str = "Label", feature: str = "feature", value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """A peak table whose row ``label`` holds the class of each sample → (long values, samples)."""
    columns = columns_except(wide, key)
    keyed = wide.select(F.col(key).alias("_key"), *columns)
    is_label = F.col("_key") == label
    samples = keyed.filter(is_label).unpivot(["_key"], columns, "sample", "condition").select("sample", "condition")
    values = (
        keyed.filter(~F.coalesce(is_label, F.lit(False)))
        .unpivot(["_key"], columns, "sample", value)
        .select(F.col("_key").alias(feature), "sample", F.col(value).try_cast("double").alias(value))
    )
    return values, samples


# --- look-ups ------------------------------------------------------------------------------------


def first_hits(dim: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value per key: the one with the lowest order, then the lowest value."""
    return dim.filter(F.col(value).isNotNull()).groupBy(key).agg(
        F.min_by(value, F.struct(F.col(order), F.col(value))).alias(value)
    )


def lookup_first(df: DataFrame, dim: DataFrame, key: str, value: str, order: str = "ord") -> DataFrame:
    """Dictionary look-up, first hit per key; a key without an entry gets null."""
    return spread_join(df, first_hits(dim, key, value, order), [key], "left")


def translate_ids(df: DataFrame, dim: DataFrame, key: str, value: str) -> DataFrame:
    """All translations of every distinct key; keys without one are dropped."""
    return df.select(key).distinct().join(dim.select(key, value).dropna().distinct(), key)


def align_metadata(df: DataFrame, samples: DataFrame, sample: str = "sample") -> DataFrame:
    """Attach the sample table; a sample missing on either side is an error, raised inside the job."""
    seen = df.select(sample).distinct().withColumn("_in_data", F.lit(True))
    message = F.concat(F.lit("sample on one side only: "), F.col(sample).cast("string"))
    checked = (
        samples.withColumn("_in_meta", F.lit(True))
        .join(seen, sample, "full")
        .withColumn(
            "_ok",
            F.when(F.col("_in_data") & F.col("_in_meta"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")),
        )
        .filter("_ok")
        .drop("_in_data", "_in_meta", "_ok")
    )
    return df.join(checked, sample, "left")


def attach_peaks(matches: DataFrame, peaks: DataFrame, keys: Sequence[str] = ("rt", "mz")) -> DataFrame:
    """Left join on two doubles where a missing key matches a missing key."""

    def null_safe(df: DataFrame) -> DataFrame:
        # a flag and a filled value per key, so that the join is a plain equality that can be split
        return df.withColumns({f"_{k}_missing": F.col(k).isNull() for k in keys}).withColumns(
            {f"_{k}": F.coalesce(F.col(k), F.lit(0.0)) for k in keys}
        )

    joined = [c for k in keys for c in (f"_{k}_missing", f"_{k}")]
    return spread_join(null_safe(matches), null_safe(peaks).drop(*keys), joined, "left").drop(*joined)


def name_compounds(matches: DataFrame, compounds: DataFrame, key: str = "compound_id", name: str = "name") -> DataFrame:
    """Attach the first name of each compound id (outer blanks ignored); rows without a name are dropped."""
    cleaned = matches.withColumn(key, F.trim(F.col(key)))
    return drop_unnamed(lookup_first(cleaned, compounds, key, name, "name_ord"), name)


def find_compound(names: DataFrame, compounds: DataFrame, column: str = "name") -> DataFrame:
    """First compound whose name contains the searched text as whole words, case-insensitively; misses are dropped.
    (:func:`find_compound_parts` also looks inside words.)

    An equal name is a hit found by a plain join. Only names without one are searched as parts: a
    compound name is cut into its suffixes at word starts, and the searched text is joined to the
    suffix prefixes of the same number of words, so the search is an equi join too.
    """
    wanted = names.select(F.col(column).alias("searched")).distinct().withColumn("_key", search_key("searched"))
    words = F.split(F.col("_name"), " ")
    spans = compounds.select("compound_id", "name_ord", search_key(column).alias("_name")).withColumn("_words", words)
    spans = (
        spans.select("compound_id", "name_ord", "_words", F.posexplode("_words").alias("_at", "_w"))
        .select(
            "compound_id",
            "name_ord",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.size("_words") - F.col("_at")),
                    lambda n: F.array_join(F.slice("_words", F.col("_at") + 1, n), " "),
                )
            ).alias("_key"),
        )
        .groupBy("_key")
        .agg(F.min(F.struct("name_ord", "compound_id")).alias("_hit"))
    )
    return wanted.join(spans, "_key").select(F.col("searched").alias(column), F.col("_hit.compound_id").alias("compound_id"))


def _grams(key: str) -> Column:
    """The distinct runs of one, two and three characters of a text."""
    c = F.col(key)

    def runs(n: int) -> Column:
        starts = F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: c.substr(at, F.lit(n)))

    return F.array_distinct(F.concat(runs(1), runs(2), runs(3)))


def find_compound_parts(names: DataFrame, compounds: DataFrame, column: str = "name") -> DataFrame:
    """First compound whose name contains the searched text anywhere, case-insensitively; misses are dropped.

    The names are indexed by their runs of three characters (and of one and two, for shorter searches). A search is looked
    up by the run of its text that the fewest names hold, not at all if one is in no name, and confirmed on the names.
    Null and empty searches find nothing.
    """
    wanted = names.select(F.col(column).alias("searched")).distinct().withColumn("_key", search_key("searched")).filter(F.length("_key") > 0)
    known = compounds.select("compound_id", "name_ord", search_key(column).alias("_name")).groupBy("_name").agg(F.min(F.struct("name_ord", "compound_id")).alias("_hit"))
    index = stage(known.select("_name", F.explode(_grams("_name")).alias("_gram")))
    held = index.groupBy("_gram").agg(F.count(F.lit(1)).alias("_held"))
    asked = wanted.select("_key", F.explode(_grams("_key")).alias("_gram")).filter(F.length("_gram") == F.least(F.length("_key"), F.lit(3))).distinct()
    rarest = (
        asked.join(held, "_gram", "left")
        .groupBy("_key")
        .agg(F.min_by("_gram", F.struct("_held", "_gram")).alias("_gram"), F.count_if(F.col("_held").isNull()).alias("_none"))
        .filter("_none = 0")
        .select("_key", "_gram")
    )
    found = rarest.join(index, "_gram").filter(F.col("_name").contains(F.col("_key"))).join(known, "_name")
    best = found.groupBy("_key").agg(F.min("_hit").alias("_hit"))
    return wanted.join(best, "_key").select(F.col("searched").alias(column), F.col("_hit.compound_id").alias("compound_id"))


def compound_pathways(compounds: DataFrame, links: DataFrame) -> DataFrame:
    """One row per compound and pathway; compounds linked to none give no row."""
    return spread_join(compounds, links.select("compound_id", "pathway_id").distinct(), ["compound_id"])


def name_pathways(df: DataFrame, pathways: DataFrame) -> DataFrame:
    """Attach the pathway name by id (of several the first in name order); unknown ids keep a null name."""
    return spread_join(df, pathways.groupBy("pathway_id").agg(F.min("pathway_name").alias("pathway_name")), ["pathway_id"], "left")


# --- group picks ---------------------------------------------------------------------------------


def max_per_group_ties(df: DataFrame, group: str, value: str, pick: str = "max") -> DataFrame:
    """All rows holding their group's largest (or smallest) value.

    The group maxima are aggregated on the map side and joined on (group, value), so a large group is
    spread over its values and only true ties meet.
    """
    best = {"max": F.max, "min": F.min}[pick](F.col(value))
    tops = df.groupBy(group).agg(best.alias("_v")).withColumnRenamed(group, "_g")
    same = df[group].eqNullSafe(tops["_g"]) & (df[value] == tops["_v"])
    return df.join(tops, same, "left_semi")


def max_per_group_first(df: DataFrame, group: str, value: str, order: Sequence[str], pick: str = "max") -> DataFrame:
    """One row per group: the largest (or smallest) value, ties by the order columns. No window, no sort of a group."""
    best = -F.col(value) if pick == "max" else F.col(value)
    row = F.struct(*[F.col(c) for c in df.columns])
    picked = df.filter(F.col(value).isNotNull()).groupBy(F.col(group).alias("_g")).agg(
        F.min_by(row, F.struct(best, *[F.col(c) for c in order])).alias("_row")
    )
    return picked.select("_row.*")


def group_max(df: DataFrame, group: str, value: str, out: str = "group_max") -> DataFrame:
    """Every row with the maximum of its group."""
    return spread_join(df, df.groupBy(group).agg(F.max(value).alias(out)), [group])


# --- stacks and reshapes -------------------------------------------------------------------------


def stack_modes(parts: dict[str, DataFrame], mode: str = "mode", ordinal: str = "source") -> DataFrame:
    """Bag union by column name, gaps filled with null, with the name and position of each part."""
    stacked = None
    for position, (name, part) in enumerate(parts.items()):
        tagged = part.withColumns({mode: F.lit(name), ordinal: F.lit(position)})
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    return stacked


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def distinct_values(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct (name, type) over several columns; ``columns`` maps a column to the type of its values."""
    pairs = F.array(*[F.struct(F.col(c).cast("string").alias("name"), F.lit(t).alias("type")) for c, t in columns.items()])
    return df.select(F.inline(pairs)).filter(F.col("name").isNotNull()).distinct()


def split_rows(df: DataFrame, column: str, sep: str = "/", out: str | None = None) -> DataFrame:
    """One row per part of a joined text."""
    out = out or column
    parts = F.explode(F.split(F.col(column), "\\Q" + sep + "\\E")).alias(out)
    return df.select(*[c for c in df.columns if c != column], parts)


def list_to_rows(df: DataFrame, column: str, out: str) -> DataFrame:
    """One row per list element; empty and missing lists give no row."""
    return df.select(*[c for c in df.columns if c != column], F.explode(column).alias(out))


def transpose(long: DataFrame, row: str = "feature", column: str = "sample") -> DataFrame:
    """Swap the two roles of a long matrix."""
    swap = {row: column, column: row}
    return long.select(*[F.col(c).alias(swap.get(c, c)) for c in long.columns])


# --- top-k and order -----------------------------------------------------------------------------


def top_features(results: DataFrame, k: int = 25, by: str = "padj", feature: str = "feature") -> DataFrame:
    """The k rows with the smallest value, ties by feature; missing values never rank."""
    return results.filter(F.col(by).isNotNull() & ~F.isnan(by)).orderBy(by, feature).limit(k)


def top_up_down(
    results: DataFrame, k: int = 5, by: str = "padj", lfc: str = "log2fc", cut: float = 1.0, feature: str = "feature"
) -> DataFrame:
    """The k best rows of each direction, stacked and labelled."""
    up, down = split_direction(results, lfc, cut)
    stacked = top_features(up, k, by, feature).unionByName(top_features(down, k, by, feature))
    return stacked.withColumn("direction", label_direction(lfc, cut, -cut))


def top_pathways(enriched: DataFrame, k: int = 10, by: str = "padj", name: str = "pathway_id") -> DataFrame:
    return enriched.orderBy(F.asc_nulls_last(by), name).limit(k)


def top_metabolism(enriched: DataFrame, k: int = 20, column: str = "description", by: str = "padj", name: str = "pathway_id") -> DataFrame:
    return top_pathways(filter_category(enriched, column), k, by, name)


def top_pathways_up_down(means: DataFrame, k: int = 10, value: str = "avg_lfc", name: str = "pathway_name") -> DataFrame:
    """The k highest of the Upregulated and the k lowest of the Downregulated pathways."""
    up = means.filter(F.col("direction") == "Upregulated").orderBy(F.desc(value), name).limit(k)
    down = means.filter(F.col("direction") == "Downregulated").orderBy(F.asc(value), name).limit(k)
    return up.unionByName(down)


def top_pathways_by_count(counts: DataFrame, k: int = 20, name: str = "pathway_name") -> DataFrame:
    """The k largest pathways; ``display_order`` 1 is the smallest of them."""
    from pyspark.sql import Window

    top = counts.orderBy(F.desc("n"), F.asc_nulls_last(name)).limit(k)
    # at most k rows reach this window
    return top.withColumn("display_order", F.row_number().over(Window.orderBy(F.asc("n"), F.desc_nulls_first(name))))


def order_by_group_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    """Groups with their mean and its dense rank, the order of a plot axis."""
    means = df.groupBy(group).agg(avg_skip_nan(value).alias("mean"))
    steps = distinct_counts(means, [], "mean").withColumn("n", F.lit(1))
    ranks = running(steps, [], "mean").select("mean", F.col("upto").alias("display_order"))
    return means.join(ranks, "mean", "left").select(group, "mean", "display_order")
