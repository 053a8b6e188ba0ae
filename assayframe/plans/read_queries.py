"""Queries: sequencing reads, k-mers, alignments, count models, forests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequences
from ..operators import alignments, counts_nb, forest, kmers, matrix, read_quality, read_trimming
from ..sources.staging import stage
from . import roles
from .catalog import query, rounded
from .roles import LEVELS, with_roles

_Q = "list_transform(range(1, length(qual) + 1), lambda i: greatest(least(ascii(substr(qual, i, 1)) - 33, 93), 0))"


def _reads_sql(body: str, tables: str = "reads") -> str:
    return with_roles(tables, body)


# the characters of a read with their position, one row each
_CHARS = "SELECT sample, mate, read_id, pos, substr(seq, pos, 1) AS base, greatest(least(ascii(substr(qual, pos, 1)) - 33, 93), 0) AS q FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS pos FROM reads)"


@query("phred", _reads_sql(f"SELECT sample, mate, read_id, list_sum({_Q}) AS total, len({_Q}) AS n FROM reads"))
def phred(spark, sf):
    q = sequences.phred("qual")
    return roles.reads(spark, sf).select(
        "sample", "mate", "read_id", F.aggregate(q, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), F.size(q).alias("n")
    )


@query(
    "qc_basic_stats",
    _reads_sql(
        """SELECT sample, mate, count(*) AS reads, CAST(sum(length(seq)) AS BIGINT) AS bases, min(length(seq)) AS min_length, max(length(seq)) AS max_length,
        round(sum(length(seq) - length(translate(seq, 'GC', ''))) * 100.0 / sum(length(seq)), 6) AS gc_percent FROM reads GROUP BY 1, 2"""
    ),
)
def qc_basic_stats(spark, sf):
    return rounded(read_quality.qc_basic_stats(roles.reads(spark, sf)))


_CUTS = ", ".join(f"round(quantile_cont(q, {p}), 6) AS {c}" for c, p in (("p10", 0.1), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("p90", 0.9)))


@query("qc_base_quality", _reads_sql(f"SELECT sample, mate, pos, count(*) AS reads, round(avg(q), 6) AS mean, {_CUTS} FROM ({_CHARS}) GROUP BY 1, 2, 3"))
def qc_base_quality(spark, sf):
    return rounded(read_quality.qc_base_quality(roles.reads(spark, sf)))


@query(
    "qc_sequence_quality",
    _reads_sql(
        f"SELECT sample, mate, CAST(floor(total / n) AS BIGINT) AS mean_quality, count(*) AS reads FROM (SELECT sample, mate, list_sum({_Q}) AS total, length(qual) AS n FROM reads WHERE length(qual) > 0) GROUP BY 1, 2, 3"
    ),
)
def qc_sequence_quality(spark, sf):
    return read_quality.qc_sequence_quality(roles.reads(spark, sf))


@query(
    "qc_tile_quality",
    _reads_sql(
        f"""SELECT 'all' AS sample, mate, tile, pos, reads, round(m, 6) AS mean, round(m - sum(m * reads) OVER w / sum(reads) OVER w, 6) AS deviation
        FROM (SELECT mate, CAST(read_id % 6 AS VARCHAR) AS tile, pos, count(*) AS reads, avg(q) AS m FROM ({_CHARS}) GROUP BY 1, 2, 3) WINDOW w AS (PARTITION BY mate, pos)"""
    ),
)
def qc_tile_quality(spark, sf):
    named = F.concat_ws(":", F.lit("m"), F.lit("1"), F.lit("f"), F.lit("1"), F.col("read_id") % 6, F.col("read_id"))
    rows = roles.reads(spark, sf).withColumn("read_id", named).withColumn("sample", F.lit("all"))
    return rounded(read_quality.qc_tile_quality(rows))


_SHARE = "round(try_cast(count(*) FILTER (base = '{0}') AS DOUBLE) / nullif(count(*) FILTER (base IN ('A', 'C', 'G', 'T')), 0), 6) AS {1}"


@query(
    "qc_base_content",
    _reads_sql("SELECT sample, mate, pos, " + ", ".join(_SHARE.format(b, b.lower()) for b in "ACGT") + f" FROM ({_CHARS}) GROUP BY 1, 2, 3"),
)
def qc_base_content(spark, sf):
    return rounded(read_quality.qc_base_content(roles.reads(spark, sf)))


@query("qc_n_content", _reads_sql(f"SELECT sample, mate, pos, round(count(*) FILTER (base = 'N') / count(*), 6) AS n FROM ({_CHARS}) GROUP BY 1, 2, 3"))
def qc_n_content(spark, sf):
    return rounded(read_quality.qc_n_content(roles.reads(spark, sf)))


@query(
    "qc_gc_content",
    _reads_sql(
        "SELECT sample, mate, CAST(floor((length(seq) - length(translate(seq, 'GC', ''))) * 100 / length(seq)) AS BIGINT) AS gc_percent, count(*) AS reads FROM reads WHERE length(seq) > 0 GROUP BY 1, 2, 3"
    ),
)
def qc_gc_content(spark, sf):
    return read_quality.qc_gc_content(roles.reads(spark, sf))


@query("qc_length_distribution", _reads_sql("SELECT sample, mate, length(seq) AS length, count(*) AS reads FROM reads GROUP BY 1, 2, 3"))
def qc_length_distribution(spark, sf):
    return read_quality.qc_length_distribution(roles.reads(spark, sf))


def _all_as_one(spark, sf):
    """Every document in one sample, so that copies across sources meet."""
    return roles.reads(spark, sf).withColumns({"sample": F.lit("all"), "mate": F.lit(1)})


@query(
    "qc_duplication",
    _reads_sql(
        """SELECT 'all' AS sample, 1 AS mate, CASE WHEN n >= 10000 THEN 10000 WHEN n >= 5000 THEN 5000 WHEN n >= 1000 THEN 1000 WHEN n >= 500 THEN 500 WHEN n >= 100 THEN 100
        WHEN n >= 50 THEN 50 WHEN n >= 10 THEN 10 ELSE n END AS level, count(*) AS sequences, CAST(sum(n) AS BIGINT) AS reads FROM (SELECT seq, count(*) AS n FROM reads GROUP BY 1) GROUP BY 3"""
    ),
)
def qc_duplication(spark, sf):
    return read_quality.qc_duplication(_all_as_one(spark, sf))


@query(
    "qc_overrepresented",
    _reads_sql("SELECT 'all' AS sample, 1 AS mate, seq, n, round(n / (SELECT count(*) FROM reads), 6) AS share FROM (SELECT seq, count(*) AS n FROM reads GROUP BY 1) WHERE n > 0.001 * (SELECT count(*) FROM reads)"),
)
def qc_overrepresented(spark, sf):
    return rounded(read_quality.qc_overrepresented(_all_as_one(spark, sf)))


@query(
    "qc_adapter_content",
    _reads_sql(
        """, ad AS (SELECT DISTINCT lang AS name, lang AS a FROM documents),
        st AS (SELECT sample, mate, name AS adapter, strpos(seq, a) AS pos, count(*) AS n FROM reads, ad WHERE strpos(seq, a) > 0 GROUP BY 1, 2, 3, 4)
        SELECT sample, mate, adapter, pos, round(sum(n) OVER (PARTITION BY sample, mate, adapter ORDER BY pos) / (SELECT count(*) FROM reads r WHERE r.sample = st.sample AND r.mate = st.mate), 6) AS share FROM st"""
    ).replace("\n, ad AS", ",\nad AS"),
)
def qc_adapter_content(spark, sf):
    adapters = roles.table(spark, sf, "documents").select(F.col("lang").alias("name"), F.col("lang").alias("seq")).distinct()
    return rounded(read_quality.qc_adapter_content(roles.reads(spark, sf), adapters))


@query(
    "qc_adapter_passages",
    _reads_sql(
        """, ad AS (SELECT item_id AS name, translate(substr(text, 1, 24), 'acgtn', 'ACGTN') AS a FROM benchmark),
        st AS (SELECT sample, mate, name AS adapter, strpos(seq, a) AS pos, count(*) AS n FROM reads, ad WHERE strpos(seq, a) > 0 GROUP BY 1, 2, 3, 4)
        SELECT sample, mate, adapter, pos, round(sum(n) OVER (PARTITION BY sample, mate, adapter ORDER BY pos) / (SELECT count(*) FROM reads r WHERE r.sample = st.sample AND r.mate = st.mate), 6) AS share FROM st"""
    ).replace("\n, ad AS", ",\nad AS"),
)
def qc_adapter_passages(spark, sf):
    """The openings of all benchmark passages as adapters."""
    adapters = _adapters(spark, sf).withColumn("seq", F.substring("seq", 1, 24))
    return rounded(read_quality.qc_adapter_content(roles.reads(spark, sf), adapters))


@query("qc_merge")
def qc_merge(spark, sf):
    """The report of the reads as they came and of the pairs left by the whole trimming step, every row of every module."""
    reads = roles.reads(spark, sf)
    adapters = _adapters(spark, sf)
    # mates are of one sample for trimming; the report names the source of each
    pairs = reads.withColumns({"source": F.col("sample"), "sample": F.concat(F.lit("s"), F.col("read_id") % 4)})
    trimmed = read_trimming.route_pairs(stage(read_trimming.trim_reads(pairs, adapters)))
    paired = trimmed.filter("route = 'paired'").withColumn("sample", F.col("source")).drop("source", "route")
    report = read_quality.qc_merge({"raw": reads, "trimmed": stage(paired)}, adapters.withColumn("seq", F.substring("seq", 1, 24)))
    return rounded(report, 4)


# --- trimming ------------------------------------------------------------------------------------


def _trimmed(df):
    return df.select("sample", "mate", "read_id", F.length("seq").alias("n"), F.md5("seq").alias("seq"), F.md5("qual").alias("qual"))


def _cut_sql(first: str, count: str) -> str:
    return _reads_sql(
        f"""SELECT sample, mate, read_id, length(s) AS n, md5(s) AS seq, md5(u) AS qual FROM (SELECT sample, mate, read_id,
        substr(seq, CAST({first} AS BIGINT), CAST({count} AS BIGINT)) AS s, substr(qual, CAST({first} AS BIGINT), CAST({count} AS BIGINT)) AS u FROM (SELECT *, {_Q} AS ql FROM reads))"""
    )


@query("trim_leading", _cut_sql("coalesce(list_position(list_transform(ql, lambda x: x >= 3), true), length(seq) + 1)", "length(seq)"))
def trim_leading(spark, sf):
    return _trimmed(read_trimming.trim_leading(roles.reads(spark, sf)))


@query(
    "trim_trailing",
    _cut_sql("1", "coalesce(length(seq) - list_position(list_transform(list_reverse(ql), lambda x: x >= 3), true) + 1, 0)"),
)
def trim_trailing(spark, sf):
    return _trimmed(read_trimming.trim_trailing(roles.reads(spark, sf)))


@query(
    "trim_sliding_window",
    _cut_sql(
        "1",
        "coalesce(list_position(list_transform(range(1, length(seq) - 2), lambda i: ql[i] + ql[i + 1] + ql[i + 2] + ql[i + 3] < 60), true) - 1, length(seq))",
    ),
)
def trim_sliding_window(spark, sf):
    return _trimmed(read_trimming.trim_sliding_window(roles.reads(spark, sf)))


@query("drop_short", _reads_sql("SELECT sample, mate, read_id, length(seq) AS n, md5(seq) AS seq, md5(qual) AS qual FROM reads WHERE length(seq) >= 36"))
def drop_short(spark, sf):
    return _trimmed(read_trimming.drop_short(roles.reads(spark, sf)))


@query(
    "route_pairs",
    _reads_sql(
        """SELECT sample, mate, read_id, CASE WHEN count(*) OVER (PARTITION BY sample, read_id) = 2 THEN 'paired' ELSE 'unpaired' END AS route
        FROM paired WHERE length(seq) >= 500""",
        "reads paired",
    ),
)
def route_pairs(spark, sf):
    kept = read_trimming.drop_short(roles.paired_reads(spark, sf), 500)
    return read_trimming.route_pairs(kept).select("sample", "mate", "read_id", "route")


def _adapters(spark, sf):
    """Whole benchmark passages as adapters: documents that quote one are cut there."""
    return roles.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("name"), F.translate(F.col("text"), "acgtn", "ACGTN").alias("seq")
    )


@query("clip_adapters")
def clip_adapters(spark, sf):
    return _trimmed(read_trimming.clip_adapters(roles.reads(spark, sf), _adapters(spark, sf)))


@query("clip_pairs")
def clip_pairs(spark, sf):
    return _trimmed(read_trimming.clip_pairs(roles.paired_reads(spark, sf)))


@query("trim_reads")
def trim_reads(spark, sf):
    return _trimmed(read_trimming.trim_reads(roles.paired_reads(spark, sf), _adapters(spark, sf)))


@query("select_reads", _reads_sql("SELECT sample, mate, read_id, length(seq) AS n, md5(seq) AS seq, md5(qual) AS qual FROM reads WHERE length(seq) >= 36"))
def select_reads(spark, sf):
    raw = roles.reads(spark, sf)
    return _trimmed(read_trimming.select_reads(raw, read_trimming.drop_short(raw), None, trim=True, xeno_filter=False))


# --- k-mers --------------------------------------------------------------------------------------

K = 25


def _genomes(spark, sf):
    """Whole documents; sources with an even number are the host, the others the graft."""
    number = F.substring(F.col("source"), F.lit(4), F.length("source")).cast("int")
    return roles.table(spark, sf, "documents").select(F.when(number % 2 == 0, "host").otherwise("graft").alias("origin"), F.col("text").alias("seq"))


def _probes(spark, sf):
    """Whole benchmark passages as reads; two neighbours are a pair."""
    return roles.table(spark, sf, "benchmark").select(
        F.lit("s").alias("sample"), F.floor(F.col("item_id") / 2).cast("long").alias("read_id"), F.col("text").alias("seq")
    )


_KMERS = f"""SELECT {{keys}}, least(m, reverse(translate(m, 'ACGT', 'TGCA'))) AS kmer FROM (SELECT {{keys}}, substr(text, i, {K}) AS m FROM
    (SELECT *, unnest(range(1, length(text) - {K} + 2)) AS i FROM {{table}})) WHERE NOT contains(m, 'N')"""
_INDEX = "SELECT kmer, bit_or(bit) AS mask FROM (" + _KMERS.format(
    keys="bit", table="(SELECT text, CASE WHEN CAST(substr(source, 4) AS INTEGER) % 2 = 0 THEN 1 ELSE 2 END AS bit FROM documents)"
) + ") GROUP BY 1"


@query("kmer_index", f"SELECT kmer, mask FROM ({_INDEX})")
def kmer_index(spark, sf):
    return kmers.kmer_index(_genomes(spark, sf), K)


@query(
    "classify_reads",
    f"""WITH ix AS ({_INDEX}), rk AS ({_KMERS.format(keys="read_id", table="(SELECT text, item_id // 2 AS read_id FROM benchmark)")}),
    c AS (SELECT read_id, count(*) FILTER (mask = 1) AS host, count(*) FILTER (mask = 2) AS graft, count(*) FILTER (mask = 3) AS shared FROM rk JOIN ix USING (kmer) GROUP BY 1),
    p AS (SELECT DISTINCT item_id // 2 AS read_id FROM benchmark),
    a AS (SELECT 's' AS sample, read_id, coalesce(host, 0) AS host, coalesce(graft, 0) AS graft, coalesce(shared, 0) AS shared FROM p LEFT JOIN c USING (read_id))
    SELECT *, CASE WHEN host + graft + shared = 0 THEN 'neither' WHEN host + graft = 0 THEN 'both' WHEN graft >= 0.9 * (host + graft) THEN 'graft'
    WHEN host >= 0.9 * (host + graft) THEN 'host' ELSE 'ambiguous' END AS class FROM a""",
)
def classify_reads(spark, sf):
    return kmers.classify_reads(_probes(spark, sf), kmers.kmer_index(_genomes(spark, sf), K), K)


# --- alignments ----------------------------------------------------------------------------------


def _alignments(spark, sf):
    """Events as aligned reads, their type as sample: a stretch of 60 to 159 seconds, an intron in some."""
    e = roles.table(spark, sf, "events")
    head = F.col("event_id") % 100 + 30
    cigar = F.when(F.col("event_id") % 3 == 0, F.concat(head, F.lit("M4000N30M"))).otherwise(F.concat(head, F.lit("M2I30M5S")))
    return e.select(
        F.col("event_type").alias("sample"),
        F.col("event_id").alias("read_id"),
        (F.when(F.col("event_id") % 2 == 0, 16).otherwise(0) + F.when(F.col("event_id") % 11 == 0, 8).otherwise(0)).alias("flag"),
        (F.col("user_id") % 5).alias("chrom"),
        roles.event_seconds().alias("pos"),
        cigar.alias("cigar"),
        F.lit(60).alias("mapq"),
        F.when(F.col("event_id") % 7 == 0, 2).otherwise(1).alias("nh"),
    )


def _exons(spark, sf):
    gene = F.concat_ws("_", F.col("gene_id"), F.col("chrom"))
    return roles.intervals(spark, sf).select(
        "chrom", "start", "end", F.when(F.col("gene_id") == "error", "+").otherwise("-").alias("strand"), gene.alias("gene_id")
    )


@query(
    "count_features",
    with_roles(
        "spans",
        """, al AS (SELECT event_type AS sample, event_id, user_id % 5 AS chrom, CAST(floor(epoch(ts)) AS BIGINT) AS pos, event_id % 100 + 30 AS head,
          CASE WHEN event_id % 2 = 0 THEN '+' ELSE '-' END AS strand FROM events
          WHERE event_id % 11 <> 0 AND event_id % 7 <> 0),
        bl AS (SELECT sample, event_id, chrom, strand, pos AS s, pos + head - 1 AS e FROM al WHERE event_id % 3 = 0
          UNION ALL SELECT sample, event_id, chrom, strand, pos + head + 4000, pos + head + 4029 FROM al WHERE event_id % 3 = 0
          UNION ALL SELECT sample, event_id, chrom, strand, pos, pos + head + 29 FROM al WHERE event_id % 3 <> 0),
        ex AS (SELECT concat(gene_id, '_', chrom) AS gene, chrom, start_s, end_s, CASE WHEN gene_id = 'error' THEN '+' ELSE '-' END AS strand FROM spans),
        hi AS (SELECT sample, event_id, min(gene) AS gene FROM bl JOIN ex ON bl.chrom = ex.chrom AND bl.strand = ex.strand AND s <= end_s AND e >= start_s GROUP BY 1, 2 HAVING count(DISTINCT gene) = 1),
        ct AS (SELECT gene, sample, count(*) AS n FROM hi GROUP BY 1, 2)
        SELECT g.gene AS gene_id, s.sample, coalesce(n, 0) AS count FROM (SELECT DISTINCT gene FROM ex) g
        CROSS JOIN (SELECT DISTINCT event_type AS sample FROM events) s LEFT JOIN ct ON ct.gene = g.gene AND ct.sample = s.sample""",
    ).replace("\n, al AS", ",\nal AS"),
)
def count_features(spark, sf):
    return alignments.count_features(_alignments(spark, sf), _exons(spark, sf))


@query(
    "sort_alignments",
    """SELECT event_id AS read_id, user_id % 5 AS chrom, CAST(floor(epoch(ts)) AS BIGINT) AS pos FROM events""",
)
def sort_alignments(spark, sf):
    return alignments.sort_alignments(_alignments(spark, sf)).select("read_id", "chrom", "pos")


# --- count model and forests ---------------------------------------------------------------------


def _nb(spark, sf):
    # the counts are read about ten times, the factors twice
    long, samples = stage(roles.cells(spark, sf)), roles.samples(spark, sf)
    return long, samples, stage(matrix.size_factors(long, samples))


@query("nb_dispersion")
def nb_dispersion(spark, sf):
    return rounded(counts_nb.nb_dispersion(*_nb(spark, sf), LEVELS))


@query(
    "nb_base_mean",
    with_roles("cells samples factors counts", "SELECT feature, round(sum(value) / (SELECT count(*) FROM samples), 6) AS base_mean FROM counts GROUP BY 1"),
)
def nb_base_mean(spark, sf):
    return rounded(counts_nb.nb_dispersion(*_nb(spark, sf), LEVELS).select("feature", "base_mean"))


@query("nb_trend", "SELECT coefficient, score FROM (VALUES ('a0', 0.0), ('a1', 0.0)) t(coefficient, score)")
def nb_trend(spark, sf):
    """The score equations of the dispersion trend, which hold at its fit."""
    return rounded(counts_nb.trend_scores(counts_nb.nb_dispersion(*_nb(spark, sf), LEVELS)))


@query("nb_wald_test")
def nb_wald_test(spark, sf):
    return rounded(counts_nb.nb_wald_test(*_nb(spark, sf), LEVELS))


@query("de_results")
def de_results(spark, sf):
    return rounded(counts_nb.de_results(counts_nb.nb_wald_test(*_nb(spark, sf), LEVELS)))


def _vectors(spark, sf):
    return roles.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("features"))


@query("random_forest")
def random_forest(spark, sf):
    return forest.random_forest(_vectors(spark, sf))


@query("rf_importance")
def rf_importance(spark, sf):
    return rounded(forest.rf_importance(_vectors(spark, sf)))


@query("rf_outlier")
def rf_outlier(spark, sf):
    return rounded(forest.rf_outlier(_vectors(spark, sf)))
