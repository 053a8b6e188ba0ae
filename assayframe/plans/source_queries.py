"""Queries: sources and sinks as round trips. A whole given table is written as files of the source's format, then read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources import readers, staging, writers
from . import roles
from .catalog import query
from .roles import with_roles


def _lines_by_file(lines: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys…, value) with the lines of every file in order, ready for a text sink with one file a folder and task."""
    return lines.repartition(*keys).sortWithinPartitions(*keys, *order)


_OPEN_FILES = 64  # files that a writing task keeps open before it sorts its rows by file


def _flat_files(df: DataFrame, name: str, lines: str, order: list[str] | None, ending: str, compression: str = "none") -> str:
    """One text file per ``name``, named after it: Spark names its own files, so each is moved to its flat name.

    Without ``order`` a file's rows come as they are read, and nothing of a file is sorted or held by its task. The driver
    moves as many files as there are samples; their contents stay where they are.
    """
    spark = df.sparkSession
    parted, flat = staging.new_path(spark), staging.new_path(spark)
    dealt = df.repartition(name) if order is None else _lines_by_file(df, [name], order)
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    if order is None:
        spark.conf.set(key, str(_OPEN_FILES))
    try:
        dealt.select(F.col(name).alias("_file"), F.col(lines).alias("value")).write.partitionBy("_file").option("compression", compression).text(parted)
    finally:
        if order is None:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    system = path(parted).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(flat))
    for folder in system.listStatus(path(parted)):
        stem = folder.getPath().getName().removeprefix("_file=")
        for file in system.listStatus(folder.getPath()) if folder.isDirectory() else []:
            if file.getPath().getName().startswith("part-"):
                system.rename(file.getPath(), path(f"{flat}/{stem}{ending}"))
    return flat


@query("read_matrix_csv", with_roles("cells", "SELECT CAST(feature AS VARCHAR) AS feature, CAST(s.sample AS VARCHAR) AS sample, CAST(value AS DOUBLE) AS value FROM (SELECT DISTINCT feature FROM cells) CROSS JOIN range(8) s(sample) LEFT JOIN cells USING (feature, sample)"))
def read_matrix_csv(spark, sf):
    path = staging.new_path(spark)
    writers.write_matrix(roles.cells(spark, sf), path)
    return readers.read_matrix_csv(spark, path)


@query("read_table_csv", "SELECT p_partkey AS id, p_name AS name, p_retailprice AS price FROM part")
def read_table_csv(spark, sf):
    path = staging.new_path(spark)
    writers.write_table(roles.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"), path, "csv")
    return readers.read_table_csv(spark, path, "key long, name string, price double", {"key": "id"})


@query("write_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def write_table(spark, sf):
    path = staging.new_path(spark)
    writers.write_table(roles.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), path, "orc")
    return spark.read.orc(path)


@query("write_annotations", "SELECT event_id, value, CASE WHEN event_id % 2 = 0 THEN 'positive' ELSE 'negative' END AS polarity FROM events")
def write_annotations(spark, sf):
    path = staging.new_path(spark)
    polarity = F.when(F.col("event_id") % 2 == 0, "positive").otherwise("negative")
    writers.write_annotations(roles.table(spark, sf, "events").select("event_id", "value", polarity.alias("polarity")), path)
    return spark.read.parquet(path).select("event_id", "value", "polarity")


@query("read_feature_counts", with_roles("cells", "SELECT concat('E', feature) AS feature, concat('s', sample) AS sample, CAST(value AS BIGINT) AS value FROM cells"))
def read_feature_counts(spark, sf):
    rows = roles.cells(spark, sf).select(
        F.concat(F.lit("s"), F.col("sample")).alias("sample"),
        F.lit(2).alias("at"),
        F.col("feature"),
        F.concat_ws("\t", F.concat(F.lit("E"), F.col("feature")), F.lit("1"), F.lit("1"), F.lit("9"), F.lit("+"), F.lit("9"), F.col("value").cast("long")).alias("line"),
    )
    heads = rows.select("sample").distinct()
    top = heads.select("sample", F.lit(0).alias("at"), F.lit(0).cast("long").alias("feature"), F.lit("# written for a round trip").alias("line"))
    names = heads.select("sample", F.lit(1).alias("at"), F.lit(0).cast("long").alias("feature"), F.lit("\t".join((*readers.COUNT_COLUMNS, "counts.bam"))).alias("line"))
    folder = _flat_files(top.unionByName(names).unionByName(rows.withColumn("feature", F.col("feature").cast("long"))), "sample", "line", ["at", "feature"], "_counts.txt")
    return readers.read_feature_counts(spark, folder)


_LETTERS = "translate(text, ' \n\r\t', '____')"


def _fastq_folder(spark, sf, packed: bool = True) -> str:
    """Documents as read files: sample = language, mate = odd or even number; white space becomes an underscore."""
    text = F.translate("text", " \n\r\t", "____")
    mate = F.col("doc_id") % 2 + 1
    # a record is one row of four lines, so records need no order
    record = F.concat_ws("\n", F.concat(F.lit("@d"), F.col("doc_id"), F.lit(" x")), F.translate(text, "@+", "__"), F.lit("+"), F.repeat(F.lit("I"), F.length("text")))
    reads = roles.table(spark, sf, "documents").filter("length(text) > 0").select(F.concat("lang", F.lit("_R"), mate).alias("file"), record.alias("record"))
    return _flat_files(reads, "file", "record", None, *(("_001.fastq.gz", "gzip") if packed else ("_001.fastq",)))


@query(
    "read_fastq",
    f"""SELECT lang AS sample, CAST(doc_id % 2 + 1 AS INTEGER) AS mate, concat('d', doc_id) AS read_id, md5(translate({_LETTERS}, '@+', '__')) AS seq, length(text) AS n
    FROM documents WHERE length(text) > 0""".replace("'____'", "'____'"),
)
def read_fastq(spark, sf):
    found = readers.read_fastq(spark, _fastq_folder(spark, sf))
    return found.select("sample", "mate", "read_id", F.md5("seq").alias("seq"), F.length("qual").alias("n"))


@query(
    "read_fastq_plain",
    f"""SELECT lang AS sample, CAST(doc_id % 2 + 1 AS INTEGER) AS mate, concat('d', doc_id) AS read_id, md5(translate({_LETTERS}, '@+', '__')) AS seq, length(text) AS n
    FROM documents WHERE length(text) > 0""".replace("'____'", "'____'"),
)
def read_fastq_plain(spark, sf):
    """The same from plain files, which many tasks read."""
    found = readers.read_fastq(spark, _fastq_folder(spark, sf, packed=False), "_R1_001.fastq", "_R2_001.fastq")
    return found.select("sample", "mate", "read_id", F.md5("seq").alias("seq"), F.length("qual").alias("n"))


@query("sample_manifest", "SELECT DISTINCT lang AS sample FROM documents WHERE length(text) > 0 AND doc_id % 2 = 0")
def sample_manifest(spark, sf):
    return readers.sample_manifest(spark, _fastq_folder(spark, sf)).select("sample")


@query(
    "run_manifest",
    """SELECT concat('r', user_id % 4) AS run, CASE WHEN event_id % 2 = 0 THEN 'bm' ELSE 'qc' END AS "group", 'positive' AS polarity, event_id % 2 = 1 AS is_qc FROM events GROUP BY ALL""",
)
def run_manifest(spark, sf):
    rows = roles.table(spark, sf, "events").select(F.concat(F.lit("r"), F.col("user_id") % 4).alias("run"), "event_id", F.col("value").cast("string").alias("line"))
    folders = {(group, "positive"): _flat_files(rows.filter(F.col("event_id") % 2 == odd), "run", "line", ["event_id"], ".mzML") for odd, group in enumerate(("bm", "qc"))}
    return readers.run_manifest(spark, folders).select("run", "group", "polarity", "is_qc")


@query("read_fasta", r"SELECT concat('item', item_id) AS name, upper(regexp_replace(replace(text, 'ß', 's'), '\s', '', 'g')) AS seq FROM benchmark")
def read_fasta(spark, sf):
    path = staging.new_path(spark)
    record = F.concat(F.lit(">item"), F.col("item_id"), F.lit(" len>5\n"), F.replace("text", F.lit("ß"), F.lit("s")))
    roles.table(spark, sf, "benchmark").select(record.alias("value")).write.text(path)
    return readers.read_fasta(spark, path)


@query(
    "read_gtf",
    """SELECT concat('c', l_suppkey % 5) AS chrom, CAST(l_orderkey AS INTEGER) AS start, CAST(l_orderkey + l_quantity AS INTEGER) AS "end",
    CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand, concat('G', l_partkey) AS gene_id FROM lineitem WHERE l_linenumber <> 3""",
)
def read_gtf(spark, sf):
    path = staging.new_path(spark)
    kind = F.when(F.col("l_linenumber") == 3, "gene").otherwise("exon")
    line = F.concat_ws(
        "\t", F.concat(F.lit("c"), F.col("l_suppkey") % 5), F.lit("x"), kind, F.col("l_orderkey"), (F.col("l_orderkey") + F.col("l_quantity")).cast("long"), F.lit("."),
        F.when(F.col("l_linenumber") % 2 == 0, "+").otherwise("-"), F.lit("."), F.concat(F.lit('gene_id "G'), F.col("l_partkey"), F.lit('"; exon_number "1";')),
    )
    roles.table(spark, sf, "lineitem").select(line.alias("value")).write.text(path)
    return readers.read_gtf(spark, path)


@query(
    "read_alignments",
    """SELECT concat('s', user_id % 4) AS sample, concat('r', event_id) AS read_id, CAST(event_id % 2 * 16 AS INTEGER) AS flag, event_type AS chrom, CAST(event_id + 1 AS INTEGER) AS pos,
    concat(event_id % 90 + 10, 'M') AS cigar, 60 AS mapq, CAST(event_id % 3 + 1 AS INTEGER) AS nh FROM events""",
)
def read_alignments(spark, sf):
    line = F.concat_ws(
        "\t", F.concat(F.lit("r"), F.col("event_id")), F.col("event_id") % 2 * 16, F.col("event_type"), F.col("event_id") + 1, F.lit(60), F.concat(F.col("event_id") % 90 + 10, F.lit("M")),
        F.lit("*"), F.lit(0), F.lit(0), F.lit("ACGT"), F.lit("IIII"), F.concat(F.lit("NH:i:"), F.col("event_id") % 3 + 1),
    )
    rows = roles.table(spark, sf, "events").select(F.concat(F.lit("s"), F.col("user_id") % 4).alias("sample"), "event_id", line.alias("line"))
    return readers.read_alignments(spark, _flat_files(rows, "sample", "line", ["event_id"], ".sam"))
