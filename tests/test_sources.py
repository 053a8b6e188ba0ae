import gzip

import pytest
from pyspark.errors import PySparkException

from assayframe.operators.kmers import HOST
from assayframe.sources import readers, staging, writers


def test_count_files(spark, tmp_path):
    head = "# program\nGeneid\tChr\tStart\tEnd\tStrand\tLength\t/bam/x.bam\n"
    (tmp_path / "x_counts.txt").write_text(head + "E1\t1\t1\t9\t+\t9\t5\n")
    (tmp_path / "y_counts.txt").write_text(head + "E1\t1\t1\t9\t+\t9\t7\nE2\t1\t1\t9\t+\t9\t1\n")
    (tmp_path / "ignored.txt").write_text("nothing")
    got = {(r["feature"], r["sample"]): r["value"] for r in readers.read_feature_counts(spark, str(tmp_path)).collect()}
    assert got == {("E1", "x"): 5, ("E1", "y"): 7, ("E2", "y"): 1}
    (tmp_path / "z_counts.txt").write_text("Gene\tcount\nE1\t3\n")
    with pytest.raises(PySparkException):
        readers.read_feature_counts(spark, str(tmp_path)).collect()


def test_matrix_csv(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('"","s1","s2"\n"g1",1,NA\n"g2",3,4.5\n')
    got = {(r["feature"], r["sample"]): r["value"] for r in readers.read_matrix_csv(spark, str(path)).collect()}
    assert got == {("g1", "s1"): 1.0, ("g1", "s2"): None, ("g2", "s1"): 3.0, ("g2", "s2"): 4.5}
    path = tmp_path / "r.csv"
    path.write_text("Sample,Label,f1,f2\na,bm,1,2\nb,cns,3,4\n")
    long, samples = readers.read_matrix_csv(spark, str(path), "samples", labels=True)
    assert long.count() == 4 and {tuple(r) for r in samples.collect()} == {("a", "bm"), ("b", "cns")}


def test_table_csv_renames_headers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('"","raw.pval","log2(FC)"\n"a",0.5,1.5\n')
    got = readers.read_table_csv(spark, str(path), "x string, raw_pval double, log2fc double").first()
    assert (got["x"], got["raw_pval"], got["log2fc"]) == ("a", 0.5, 1.5)


def test_files_with_another_header_stop_the_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,s1,s2\ng1,1,2\n")
    (tmp_path / "b.csv").write_text("id,s2,s1\ng2,1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_matrix_csv(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_table_csv(spark, str(tmp_path), "id string, a int, b int").collect()
    with pytest.raises(ValueError):
        readers.read_table_csv(spark, str(tmp_path), "id string")


def test_a_mark_inside_a_fasta_header_is_no_record(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">a len>5\nACG\nT\n>b\nTT\n")
    assert {tuple(r) for r in readers.read_fasta(spark, str(tmp_path / "a.fa")).collect()} == {("a", "ACGT"), ("b", "TT")}


def test_reads_and_manifest(spark, tmp_path):
    for mate, n in ((1, 3), (2, 2)):
        text = "".join(f"@r{i} extra\nACGT\n+\nIII@\n" for i in range(n))
        (tmp_path / f"s_R{mate}_001.fastq.gz").write_bytes(gzip.compress(text.encode()))
    got = readers.read_fastq(spark, str(tmp_path)).collect()
    assert len(got) == 5 and {(r["sample"], r["mate"], r["seq"], r["qual"]) for r in got} == {("s", 1, "ACGT", "III@"), ("s", 2, "ACGT", "III@")}
    assert [r["sample"] for r in readers.sample_manifest(spark, str(tmp_path)).collect()] == ["s"]
    (tmp_path / "b_R1_001.fastq.gz").write_bytes(gzip.compress(b"@r\nACGT\n+\n"))
    with pytest.raises(PySparkException):
        readers.read_fastq(spark, str(tmp_path)).collect()


def test_plain_reads_in_splits_equal_whole_files(spark, tmp_path):
    import random

    rng = random.Random(6)
    want = set()
    for sample in "ab":
        for mate in (1, 2):
            text = ""
            for i in range(rng.randint(5, 12)):
                n = rng.randint(1, 60)
                seq, qual = "".join(rng.choices("ACGTN", k=n)), rng.choice(["@", "+", "I"]) + "".join(rng.choices("I@+#", k=n - 1))
                text += f"@{sample}{i} x\n{seq}\n+{rng.choice(['', sample])}\n{qual}\n" + ("\n" if rng.random() < 0.05 else "")
                want.add((sample, mate, f"{sample}{i}", seq, qual))
            (tmp_path / f"{sample}_R{mate}_001.fastq").write_text(text if mate == 1 else text.replace("\n", "\r\n"))
    (tmp_path / "c_R1_001.fastq").write_text("")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (64, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 0)
            got = readers.read_fastq(spark, str(tmp_path), "_R1_001.fastq", "_R2_001.fastq")
            rows = [tuple(r) for r in got.collect()]
            assert len(rows) == len(want) and set(rows) == want
        (tmp_path / "cut").mkdir()
        (tmp_path / "cut" / "d_R1_001.fastq").write_text("@r\nACGT\n+\nIIII\n@q\nACGT\n+\n")
        for size in (9, 1000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            with pytest.raises(PySparkException, match="ends inside a record"):
                readers.read_fastq(spark, str(tmp_path / "cut"), "_R1_001.fastq", "_R2_001.fastq").collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_sequences_in_chunks(spark, tmp_path):
    chrom = "ACGTTGCA" * 40
    lines = "\n".join(chrom[i : i + 60] for i in range(0, len(chrom), 60))
    (tmp_path / "g.fa.gz").write_bytes(gzip.compress(f">chr1 info\n{lines}\n>chr2\nACGT\n".encode()))
    rows = readers.read_genome(spark, str(tmp_path), k=5, chunk=100).collect()
    kmers = [(r["name"], r["start"] + i) for r in rows for i in range(len(r["seq"]) - 4)]
    assert len(kmers) == len(set(kmers)) == len(chrom) - 4
    assert all(r["seq"] == chrom[r["start"] - 1 : r["start"] - 1 + len(r["seq"])] for r in rows if r["name"] == "chr1")
    (tmp_path / "a.fa").write_text(">ad1 x\nacgt\nACG\n>ad2\nTT\n")
    assert {tuple(r) for r in readers.read_fasta(spark, str(tmp_path / "a.fa")).collect()} == {("ad1", "ACGTACG"), ("ad2", "TT")}


def test_gene_model_and_alignments(spark, tmp_path):
    (tmp_path / "g.gtf").write_text('#!x\n1\th\tgene\t1\t9\t.\t+\t.\tgene_id "E1";\n1\th\texon\t1\t5\t.\t+\t.\tgene_id "E1"; exon_number "1";\n')
    assert [tuple(r) for r in readers.read_gtf(spark, str(tmp_path / "g.gtf")).collect()] == [("1", 1, 5, "+", "E1")]
    (tmp_path / "s.sam").write_text("@HD\tVN:1\nr1\t16\t1\t100\t60\t50M\t*\t0\t0\tACGT\tIIII\tNH:i:2\n")
    got = readers.read_alignments(spark, str(tmp_path)).first()
    assert (got["sample"], got["flag"], got["pos"], got["cigar"], got["nh"]) == ("s", 16, 100, "50M", 2)


def test_run_manifest(spark, tmp_path):
    groups = {}
    for group, polarity in (("bm", "positive"), ("qc", "negative")):
        folder = tmp_path / f"{group}_{polarity}"
        folder.mkdir()
        (folder / "a.mzML").write_text("x")
        groups[(group, polarity)] = str(folder)
    got = {(r["run"], r["group"], r["polarity"], r["is_qc"]) for r in readers.run_manifest(spark, groups).collect()}
    assert got == {("a", "bm", "positive", False), ("a", "qc", "negative", True)}


def test_writers(spark, tmp_path):
    long = spark.createDataFrame([("g1", "s1", 1.0), ("g1", "s2", 2.0), ("g2", "s1", 3.0)], "feature string, sample string, value double")
    assert {tuple(r) for r in writers.to_wide(long).collect()} == {("g1", 1.0, 2.0), ("g2", 3.0, None)}
    writers.write_matrix(long, str(tmp_path / "wide"))
    assert readers.read_matrix_csv(spark, str(tmp_path / "wide")).count() == 4
    reads = spark.createDataFrame([("s", "graft", 1, "A"), ("s", "host", 2, "C")], "sample string, class string, mate int, seq string")
    writers.write_by_class(reads, str(tmp_path / "cls"))
    assert (tmp_path / "cls" / "sample=s" / "class=graft" / "mate=1").is_dir() and HOST == 1
    writers.write_annotations(spark.createDataFrame([("positive", 1)], "polarity string, v int"), str(tmp_path / "ann"))
    writers.write_table(long, str(tmp_path / "csv"), "csv")
    assert readers.read_dimension(spark, str(tmp_path / "ann"), {"v": "w"}).columns == ["w"]
    staged = staging.stage(long, str(tmp_path / "staged"))
    assert staged.count() == 3 and staged.schema == long.schema


def test_read_files_are_built_without_sorting(spark, tmp_path):
    from assayframe.plans import source_queries

    docs = [(i, None if i == 7 else f"text {i}\nAC@+ G\t{'x' * i}", "l" + "ab"[i // 2 % 2]) for i in range(1, 40)]
    # a document that comes twice makes two records
    spark.createDataFrame([*docs, docs[4]], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    keep = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    for read, packed in ((source_queries.read_fastq, True), (source_queries.read_fastq_plain, False)):
        rows = sorted((r["read_id"], r["sample"], r["mate"], r["n"]) for r in read(spark, str(tmp_path)).collect())
        assert rows == sorted((f"d{i}", lang, i % 2 + 1, len(text)) for i, text, lang in [*docs, docs[4]] if text)
    assert [r[0] for r in source_queries.sample_manifest(spark, str(tmp_path)).orderBy("sample").collect()] == ["la", "lb"]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == keep
