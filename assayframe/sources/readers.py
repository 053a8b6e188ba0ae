"""Readers. Schemas are explicit, so no file is read twice to guess types, and a bad number is null."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.text import file_stem
from .staging import stage

COUNT_COLUMNS = ("Geneid", "Chr", "Start", "End", "Strand", "Length")


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType | str, names: dict[str, str] | None = None) -> DataFrame:
    """A CSV with a header. The schema's types and names go by position; ``names`` renames further.

    All files have the header of the first one: a file with other columns, or in another order, stops the job.
    """
    fields = (spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema).fields
    header = csv_header(spark, path)
    if len(header) != len(fields):
        raise ValueError(f"{len(header)} columns in {path}, {len(fields)} in the schema")
    found = T.StructType([T.StructField(h, f.dataType) for h, f in zip(header, fields)])
    df = spark.read.schema(found).csv(path, header=True, enforceSchema=False).toDF(*[f.name for f in fields])
    return df.withColumnsRenamed(names) if names else df


def csv_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The header of a CSV (first file of a folder); only the first line is read."""
    first = spark.read.csv(path, header=False, sep=sep, comment="#").limit(1).collect()
    if not first:
        raise ValueError(f"no header in {path}")
    return [c if c is not None else "" for c in first[0]]


def read_matrix_csv(
    spark: SparkSession, path: str, orientation: str = "features", labels: bool = False
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """A wide matrix CSV to (feature, sample, value). All files have the same header; one that differs stops the job.

    ``features``: a row per feature, a column per sample. ``samples``: a row per sample. With ``labels``
    the first data row (or the second column) holds the class of each sample, and the result is the
    pair (matrix, samples).
    """
    header = csv_header(spark, path)
    columns = [h if h else "_key" for h in header]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    wide = spark.read.schema(T.StructType([T.StructField(h, T.StringType()) for h in header])).csv(path, header=True, enforceSchema=False)
    wide = wide.toDF(*schema.names)
    key = columns[0]
    if orientation == "features":
        if labels:
            from ..operators.relational import split_label_row

            return split_label_row(wide, key)
        long = wide.unpivot([key], columns[1:], "sample", "value")
        return long.select(F.col(key).alias("feature"), "sample", F.col("value").try_cast("double").alias("value"))
    if orientation != "samples":
        raise ValueError(f"unknown orientation {orientation!r}")
    start = 2 if labels else 1
    long = wide.unpivot([key], columns[start:], "feature", "value")
    long = long.select("feature", F.col(key).alias("sample"), F.col("value").try_cast("double").alias("value"))
    return (long, wide.select(F.col(key).alias("sample"), F.col(columns[1]).alias("condition"))) if labels else long


def read_feature_counts(spark: SparkSession, folder: str, suffix: str = "_counts.txt") -> DataFrame:
    """Count files (``#`` comments, ``Geneid`` first, counts last) to (feature, sample, value).

    All files are one scan; the sample is the file name without the suffix. A file without a ``Geneid``
    column stops the job.
    """
    lines = spark.read.text(folder, pathGlobFilter=f"*{suffix}").select("value", F.col("_metadata.file_name").alias("_file"))
    cells = F.split("value", "\t")
    rows = lines.filter(~F.startswith("value", F.lit("#")) & (F.length("value") > 0)).select(
        F.get(cells, 0).alias("feature"), F.element_at(cells, -1).alias("_count"), "_file"
    )
    # one row per file with its number of headers; the files without one are named in the error
    has_header = rows.groupBy("_file").agg(F.count(F.when(F.col("feature") == COUNT_COLUMNS[0], 1)).alias("_n"))
    missing = has_header.filter("_n = 0").agg(F.min("_file"))
    complain = F.raise_error(F.concat(F.lit("Geneid column not found in "), missing.scalar())).cast("boolean")
    checked = rows.filter(F.when(missing.scalar().isNull(), F.lit(True)).otherwise(complain))
    return checked.filter(F.col("feature") != COUNT_COLUMNS[0]).select(
        "feature", file_stem("_file", suffix).alias("sample"), F.col("_count").try_cast("long").alias("value")
    )


def _ordered_lines(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, line) of whole files, the lines of a file in order inside one task.

    Spark never splits a gzip file and streams it line by line, whatever its size. Other files could
    be split in the middle of a record, so they are read as whole files (at most 2 GB each).
    """
    if pattern.endswith(".gz"):
        return spark.read.text(folder, pathGlobFilter=pattern).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                found = content.decode("ascii", "replace").splitlines()
                for at in range(0, len(found), 100_000):
                    yield pd.DataFrame({"path": path, "line": found[at : at + 100_000]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")
    return files.mapInPandas(lines, "path string, line string")


_RECORD = 4  # lines of a read record
_READ_SCHEMA = "path string, read_id string, seq string, qual string"


def _checked(path: str, lines: list[str]) -> dict[str, list[str]]:
    """The columns of whole records, four lines each; a broken one is an error."""
    names, seqs, marks, quals = (lines[i::_RECORD] for i in range(_RECORD))
    for name, seq, mark, qual in zip(names, seqs, marks, quals, strict=True):
        if not name.startswith("@") or not mark.startswith("+") or len(seq) != len(qual):
            raise ValueError(f"broken read record {name!r} in {path}")
    return {"path": [path] * len(names), "read_id": [n[1:].split()[0] for n in names], "seq": seqs, "qual": quals}


def _streamed_records(lines: DataFrame) -> DataFrame:
    """Records of files whose lines come in order in one task each (gzip)."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[str] = []
        current = None
        for batch in batches:
            for path, part in batch.groupby("path", sort=False):
                if path != current:
                    if held:
                        raise ValueError(f"read file ends inside a record: {current}")
                    current = path
                held += [x for x in part["line"].str.rstrip("\r") if x]
                whole = len(held) - len(held) % _RECORD
                yield pd.DataFrame(_checked(path, held[:whole]))
                held = held[whole:]
        if held:
            raise ValueError(f"read file ends inside a record: {current}")

    return lines.mapInPandas(records, _READ_SCHEMA)


def _split_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """((path, start of the split), its lines that are not empty) for stretches of rows (path, start, line) in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column(0).dictionary_encode()
        path, start = coded.indices.to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((np.diff(path) != 0) | (np.diff(start) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            lines = pc.utf8_rtrim(batch.column(2).slice(a, b - a), "\r")
            yield (coded.dictionary[path[a]].as_py(), int(start[a])), lines.filter(pc.greater(pc.utf8_length(lines), 0))


def _split_records(lines: DataFrame) -> DataFrame:
    """Records of files that Spark cuts into byte ranges (path, start, line), which may begin inside a record.

    A first scan counts the lines of each split and keeps its first and last three. The running sum of the counts says at
    which line of a record a split begins. A second scan takes the records inside the splits; those over a border come
    from the few lines kept. The driver holds one number for each split.
    """
    edge = _RECORD - 1

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: dict[tuple[str, int], tuple[int, list[str], list[str]]] = {}
        for key, found in _split_runs(batches):
            n, head, tail = done.get(key, (0, [], []))
            head = [*head, *found.slice(0, edge - len(head)).to_pylist()]
            tail = [*tail, *found.slice(max(0, len(found) - edge)).to_pylist()][-edge:]
            done[key] = (n + len(found), head, tail)
        keys, rows = list(done), list(done.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[i] for r in rows], pa.list_(pa.string())) for i in (1, 2)]],
            names=["path", "start", "n", "head", "tail"],
        )

    counted = lines.mapInArrow(ends, "path string, start long, n long, head array<string>, tail array<string>")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = stage(counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    first = {(r["path"], r["start"]): -r["before"] % _RECORD for r in splits.select("path", "start", "before").toLocalIterator()}
    sent = lines.sparkSession.sparkContext.broadcast(first)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, skip, held = None, 0, []
        for key, found in _split_runs(batches):
            if key != current:
                current, skip, held = key, sent.value[key], []
            skipped = min(skip, len(found))
            skip -= skipped
            held = [*held, *found.slice(skipped).to_pylist()]
            whole = len(held) - len(held) % _RECORD
            columns, held = _checked(key[0], held[:whole]), held[whole:]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in columns.values()], names=list(columns))

    # lines by their number in the file: those before a split's first record and behind its last one
    number = F.transform("head", lambda x, i: F.struct((F.col("before") + i).alias("at"), x.alias("line")))
    number = F.concat(number, F.transform("tail", lambda x, i: F.struct((F.col("before") + F.col("n") - F.size("tail") + i).alias("at"), x.alias("line"))))
    opening = F.col("before") + F.least(F.pmod(-F.col("before"), F.lit(_RECORD)), F.col("n"))
    closing = F.col("before") + F.col("n") - F.when(opening < F.col("before") + F.col("n"), F.pmod(F.col("before") + F.col("n"), F.lit(_RECORD))).otherwise(0)
    loose = splits.select("path", opening.alias("opening"), closing.alias("closing"), F.inline(F.array_distinct(number))).filter("at < opening or at >= closing")
    over = loose.groupBy("path", F.floor(F.col("at") / _RECORD).alias("record")).agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("own"))

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, own in zip(batch["path"], batch["own"], strict=True):
                if len(own) != _RECORD:
                    raise ValueError(f"read file ends inside a record: {path}")
                yield pd.DataFrame(_checked(path, list(own)))

    borders = over.select("path", F.transform("own", lambda x: x["line"]).alias("own")).mapInPandas(joined, _READ_SCHEMA)
    return lines.mapInArrow(inside, _READ_SCHEMA).unionByName(borders)


def read_fastq(spark: SparkSession, folder: str, suffix_1: str = "_R1_001.fastq.gz", suffix_2: str = "_R2_001.fastq.gz") -> DataFrame:
    """Paired read files to (sample, mate, read_id, seq, qual).

    A plain file is read in byte ranges by many tasks (two scans), whatever its size. A gzip file cannot be split, so one
    file is one task; write the result as parquet once and read that afterwards. A broken record stops the job.
    """
    out = None
    for mate, suffix in ((1, suffix_1), (2, suffix_2)):
        if suffix.endswith(".gz"):
            found = _streamed_records(_ordered_lines(spark, folder, f"*{suffix}"))
        else:
            split = spark.read.text(folder, pathGlobFilter=f"*{suffix}")
            found = _split_records(split.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line")))
        part = found.select(file_stem("path", suffix).alias("sample"), F.lit(mate).alias("mate"), "read_id", "seq", "qual")
        out = part if out is None else out.unionByName(part)
    return out


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Short sequences (adapters): one row per record, (name, seq). Records start with ``>`` at the start of a line."""
    # the file's first record keeps its mark, the others lose it with the line break before it
    records = spark.read.text(path, lineSep="\n>").filter(F.length(F.trim("value")) > 0)
    value = F.regexp_replace("value", r"^\s*>", "")
    head = F.regexp_extract(value, r"^(\S+)", 1)
    body = F.regexp_replace(F.regexp_replace(value, r"^[^\n]*\n?", ""), r"\s", "")
    return records.select(head.alias("name"), F.upper(body).alias("seq"))


def read_genome(spark: SparkSession, folder: str, pattern: str = "*.fa.gz", k: int = 25, chunk: int = 65_536) -> DataFrame:
    """Long sequences as chunks (name, start, seq) that overlap by k - 1 letters, so no chromosome is one row."""
    columns = ["name", "start", "seq"]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, name, start, text = None, None, 1, ""

        def last() -> list[tuple]:
            return [(name, start, text)] if name is not None and text and (start == 1 or len(text) >= k) else []

        for batch in batches:
            rows: list[tuple] = []
            parts = [text]
            size = len(text)
            for path, line in zip(batch["path"], batch["line"]):
                if path != current or line.startswith(">"):
                    text = "".join(parts)
                    rows += last()
                    current, start, text, parts, size = path, 1, "", [], 0
                    name = (line[1:].split() or [""])[0] if line.startswith(">") else None
                    continue
                parts.append(line.strip().upper())
                size += len(parts[-1])
                if size >= chunk:
                    text = "".join(parts)
                    rows.append((name, start, text))
                    kept = text[len(text) - k + 1 :] if k > 1 else ""
                    start, text = start + len(text) - len(kept), kept
                    parts, size = [kept], len(kept)
            text = "".join(parts)
            yield pd.DataFrame(rows, columns=columns)
        yield pd.DataFrame(last(), columns=columns)

    return _ordered_lines(spark, folder, pattern).mapInPandas(pieces, "name string, start long, seq string")


def read_gtf(spark: SparkSession, path: str, feature: str = "exon", attribute: str = "gene_id") -> DataFrame:
    """Exons of a gene model: (chrom, start, end, strand, gene_id)."""
    names = "chrom string, source string, kind string, start int, end int, score string, strand string, frame string, attributes string"
    rows = spark.read.schema(names).csv(path, sep="\t", comment="#", quote="")
    gene = F.regexp_extract("attributes", rf'{attribute} "?([^";]+)"?', 1)
    return rows.filter(F.col("kind") == feature).select("chrom", "start", "end", "strand", gene.alias("gene_id")).filter(F.col("gene_id") != "")


def read_alignments(spark: SparkSession, path: str, suffix: str = ".sam") -> DataFrame:
    """Alignment text to (sample, read_id, flag, chrom, pos, cigar, mapq, nh); the sample is the file name."""
    lines = spark.read.text(path, pathGlobFilter=f"*{suffix}").select("value", F.col("_metadata.file_name").alias("_file"))
    cells = F.split("value", "\t")
    nh = F.regexp_extract("value", r"\tNH:i:(\d+)", 1)
    return lines.filter(~F.startswith("value", F.lit("@")) & (F.length("value") > 0)).select(
        file_stem("_file", suffix).alias("sample"),
        F.get(cells, 0).alias("read_id"),
        F.get(cells, 1).try_cast("int").alias("flag"),
        F.get(cells, 2).alias("chrom"),
        F.get(cells, 3).try_cast("int").alias("pos"),
        F.get(cells, 5).alias("cigar"),
        F.get(cells, 4).try_cast("int").alias("mapq"),
        F.coalesce(nh.try_cast("int"), F.lit(1)).alias("nh"),
    )


def read_dimension(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """An annotation table kept as parquet; Spark broadcasts it in joins when its files are small enough."""
    df = spark.read.parquet(path)
    return df.select([F.col(old).alias(new) for old, new in columns.items()]) if columns else df


# --- file lists ----------------------------------------------------------------------------------


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Paths and sizes of the files that match; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length")


def sample_manifest(spark: SparkSession, folder: str, suffix: str = "_R1_001.fastq.gz") -> DataFrame:
    """Sample names: file names ending in the suffix, without it."""
    return list_files(spark, folder, f"*{suffix}").select(file_stem("path", suffix).alias("sample"), "path")


def run_manifest(spark: SparkSession, groups: dict[tuple[str, str], str], pattern: str = "*.mzML") -> DataFrame:
    """Run files of all groups: {(group, polarity): folder} → (path, run, group, polarity, is_qc)."""
    out = None
    for (group, polarity), folder in groups.items():
        part = list_files(spark, folder, pattern).select(
            "path",
            file_stem("path", pattern.lstrip("*")).alias("run"),
            F.lit(group).alias("group"),
            F.lit(polarity).alias("polarity"),
            F.lit(group == "qc").alias("is_qc"),
        )
        out = part if out is None else out.unionByName(part)
    return out
