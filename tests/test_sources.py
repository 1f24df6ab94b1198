"""Text formats written by hand."""

import gzip

import pytest

from biomesheaf.session import scratch_path
from biomesheaf.sources import sinks
from biomesheaf.sources import text as tt
from biomesheaf.sources.fastq import read_fastq

FASTQ = "".join(f"@r{i}\n{'ACGT' * (1 + i % 3)}\n+\n{'@+II' * (1 + i % 3)}\n" * 2 for i in range(40))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


def test_fastq_ranges_and_gzip_agree(spark, tmp_path):
    (tmp_path / "s1.reads.fq").write_text(FASTQ)
    with gzip.open(tmp_path / "s2.reads.fq.gz", "wt") as f:
        f.write(FASTQ)
    want = sorted((f"r{i}", m, "ACGT" * (1 + i % 3)) for i in range(40) for m in (1, 2))
    for split in (7, 100, 10**6):
        got = read_fastq(spark, str(tmp_path / "s1.reads.fq"), split_bytes=split)
        assert rows(got, "pair_id", "mate", "seq") == want
    both = read_fastq(spark, str(tmp_path / "*.fq*"), sample_pattern=r"([^/.]+)\.reads")
    assert rows(both.groupBy("sample").count()) == [("s1", 80), ("s2", 80)]


def test_fastq_tasks_do_not_grow_with_the_ranges(spark, tmp_path):
    many = "".join(f"@r{i}@x\n{'ACGT' * (1 + i % 40)}\n+\n{'@+II' * (1 + i % 40)}\n" * 2 for i in range(2000))
    (tmp_path / "s.fq").write_text(many)
    got = read_fastq(spark, str(tmp_path / "s.fq"), split_bytes=500)
    assert len(many) // 500 > 800
    assert got.rdd.getNumPartitions() <= 5 * spark.sparkContext.defaultParallelism
    assert rows(got, "pair_id", "mate", "seq") == sorted((f"r{i}@x", m, "ACGT" * (1 + i % 40)) for i in range(2000) for m in (1, 2))


def test_fastq_mate_marks_orphans_and_damage(spark, tmp_path):
    path = tmp_path / "a.fq"
    path.write_text("@x/2\nA\n+\nI\n@y 1:N:0:AC\nC\n+\nI\n@z\nG\n+\nI\n@w\nT\n+\nI\n@w\nTT\n+\nII\n\n")
    assert rows(read_fastq(spark, str(path)), "pair_id", "mate") == [("w", 1), ("w", 2), ("x", 2), ("y", 1), ("z", 1)]
    path.write_text("@x\nACG\n+\nII\n")
    with pytest.raises(Exception, match="broken FASTQ"):
        read_fastq(spark, str(path)).collect()


def test_fastq_split_layout_round_trip(spark, tmp_path):
    reads = read_fastq(spark, str(_write(tmp_path / "s.fq", FASTQ)))
    sinks.write_fastq(reads, str(tmp_path / "out"), layout="split")
    back = read_fastq(
        spark, (str(tmp_path / "out/R1"), str(tmp_path / "out/R2")), "split", sample_pattern="sample=([^/]+)/"
    )
    assert rows(back) == rows(reads)


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


def test_fasta_records(spark, tmp_path):
    path = _write(tmp_path / "x.fa", ">a first one\nACG\nTT\n>b\nGG>G\n\n>c  x\nA\n")
    got = rows(tt.read_fasta(spark, str(path)), "ref_id", "description", "seq", "length")
    assert got == [("a", "first one", "ACGTT", 5), ("b", "", "GG>G", 4), ("c", "x", "A", 1)]


def test_sam_fields_and_header(spark, tmp_path):
    path = _write(
        tmp_path / "s1.sam",
        "@HD\tVN:1.6\n@SQ\tSN:c1\tLN:40\nr1\t99\tc1\t5\t60\t4M\t=\t9\t8\tACGT\tIIII\tNM:i:1\tRG:Z:a:b\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n",
    )
    aln, lengths = tt.read_sam(spark, str(path))
    assert rows(aln, "sample", "qname", "flag", "pos", "cigar") == [("s1", "r1", 99, 5, "4M"), ("s1", "r2", 4, 0, "*")]
    assert aln.filter("qname = 'r1'").first()["tags"] == {"NM": "1", "RG": "a:b"}
    assert rows(lengths) == [("s1", "c1", 40)]


def test_report_order_and_empty_file(spark, tmp_path):
    lines = "".join(f"1.0\t{i}\t{i}\tS\t{i}\t   name {i}\n" for i in range(50))
    _write(tmp_path / "full.krakenReport", lines)
    _write(tmp_path / "empty.krakenReport", "")
    report = tt.read_tax_report(spark, str(tmp_path / "*.krakenReport"))
    assert [r["tax_id"] for r in report.orderBy("line_no").collect()] == list(range(50))
    assert rows(report.select("sample").distinct()) == [("full",)]
    assert report.filter("name = 'name 7'").count() == 1


def test_annotations_comments_and_gff(spark, tmp_path):
    line = "\t".join(["c1", "o1", "1e-5", "50.5", "Bac", 'gen"A', "GO"] + ["x"] * 15)
    path = _write(tmp_path / "ann.tsv", f"# head\n{line}\n#tail\n")
    assert rows(tt.read_annotations(spark, str(path)), "cds", "evalue", "protein_name") == [("c1", 1e-5, 'gen"A')]
    gff = _write(tmp_path / "p.gff", "##gff\ngnl|1\tp\tCDS\t11\t40\t.\t+\t0\tID=g1;x=y\nctg\tp\tCDS\t1\t9\t.\t+\t0\tID=g2\n")
    assert rows(tt.read_gff_gene_lengths(spark, str(gff))) == [("g1", 30)]


def test_combined_files_skip_empty_ones(spark, tmp_path):
    _write(tmp_path / "a.gene.tsv", "gene\thits\n")
    _write(tmp_path / "b.gene.tsv", "gene\thits\ng1\t4\n")
    got = tt.combine_resistome(spark, str(tmp_path), {"gene": "gene string, hits bigint"})["gene"]
    assert rows(got) == [("g1", 4, "b.gene")]


def test_manifest_and_targets(spark, tmp_path):
    path = _write(tmp_path / "m.csv", ",R1,R2,sname\n0,a_1.fq,a_2.fq,a\n")
    assert rows(tt.read_manifest(spark, str(path))) == [("a", "a_1.fq", "a_2.fq")]
    with pytest.raises(ValueError):
        tt.read_manifest(spark, str(_write(tmp_path / "bad.csv", ",R1,sname\n0,a,b\n")))
    csv = _write(tmp_path / "t.csv", 'ButyratePwy,EC,ShortName,pwy\nAll,1.1.1.1,a,ec1\nP,"1.1.1.1,2.2.2.2",,ec1\n')
    assert rows(tt.read_targets(spark, str(csv), "ButyratePwy", True)) == [("P", "1.1.1.1,2.2.2.2", None, None, "ec1")]


def test_track_table(spark, tmp_path):
    path = _write(tmp_path / "track.out", "#sample  #input  #noAdpt  #filtered  #decontaminated  #qtrimmed\ns1   10  10   8  7    6\n")
    assert rows(tt.read_track_reads(spark, str(path))) == [("s1", 10, 6)]


def test_half_written_stage_is_built_again(spark, tmp_path):
    _write(tmp_path / "stage" / "part-0.parquet", "junk")
    first = sinks.materialize_if_absent(spark, lambda: spark.range(3), str(tmp_path / "stage"))
    again = sinks.materialize_if_absent(spark, lambda: spark.range(9), str(tmp_path / "stage"))
    assert first.count() == again.count() == 3


def test_scratch_folder_is_taken_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first = scratch_path(spark, "x")
    assert first.startswith(base or spark.conf.get("spark.checkpoint.dir"))
    assert first != scratch_path(spark, "x")


def test_tables_are_combined_by_name(spark, tmp_path):
    (tmp_path / "a.gene.tsv").write_text("hits\tgene\n7\tg1\n")
    (tmp_path / "b.gene.tsv").write_text("gene\thits\textra\ng2\t8\tz\n")
    (tmp_path / "c.gene.tsv").write_text("gene\ng3\n")
    (tmp_path / "x_L001.tsv").write_text("Gene\tHaplotype Pattern\tOccurrence\ng\t1:A>C\t4\n")
    got = tt.combine_resistome(spark, str(tmp_path), {"gene": "gene string, hits bigint", "snp": "Gene string, `Haplotype Pattern` string, Occurrence bigint"})
    assert rows(got["gene"], "gene", "hits", "Sample") == [("g1", 7, "a.gene"), ("g2", 8, "b.gene"), ("g3", None, "c.gene")]
    assert rows(got["snp"], "Gene", "`Haplotype Pattern`", "Occurrence", "Sample") == [("g", "1:A>C", 4, "x_L001")]


def test_tracking_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t1").write_text("#sample #input #qtrimmed\ns1 10 6\n")
    (tmp_path / "t2").write_text("#sample  #qtrimmed #noAdpt #input\ns2 5 8 9\n")
    assert rows(tt.read_track_reads(spark, str(tmp_path / "t*"))) == [("s1", 10, 6), ("s2", 9, 5)]
    (tmp_path / "u").write_text("#sample #input\ns1 10\n")
    with pytest.raises(Exception, match="#qtrimmed"):
        tt.read_track_reads(spark, str(tmp_path / "u")).collect()


def test_split_files_stay_in_step(spark, tmp_path):
    reads = spark.createDataFrame(
        [("s", "p1", 1, "AC", "II"), ("s", "p1", 2, "GT", "##"), ("s", "p2", 1, "A", "I"), ("s", "p3", 1, "C", "I"), ("s", "p3", 2, "G", "I")],
        "sample string, pair_id string, mate int, seq string, qual string",
    )
    sinks.write_fastq(reads, str(tmp_path / "o"), layout="split")
    names = [[r.value for r in spark.read.text(str(tmp_path / "o" / f"R{m}")).collect() if r.value.startswith("@")] for m in (1, 2)]
    assert sorted(names[0]) == ["@p1/1", "@p3/1"] and [n[:-1] for n in names[0]] == [n[:-1] for n in names[1]]


def test_missing_bases_are_null(spark, tmp_path):
    (tmp_path / "s.sam").write_text("@SQ\tSN:c\tLN:9\nq\t256\tc\t1\t0\t3M\t*\t0\t0\t*\t*\n")
    assert rows(tt.read_sam(spark, str(tmp_path / "s.sam"))[0], "qname", "seq", "qual") == [("q", None, None)]


def test_only_files_of_the_samples_are_opened(spark, tmp_path):
    for name in ("a", "b", "c"):
        _write(tmp_path / "in" / f"{name}.fastq", f"@{name}1\nACGT\n+\nIIII\n@{name}1\nTTTT\n+\n####\n")
    # Opening this file raises.
    _write(tmp_path / "in" / "broken.fastq", "@x\nAC\n+\n")
    where = str(tmp_path / "in")
    assert rows(read_fastq(spark, where, samples=["b"]), "sample", "pair_id", "mate", "seq") == [("b", "b1", 1, "ACGT"), ("b", "b1", 2, "TTTT")]
    some = read_fastq(spark, where, samples=["a", "c", "none"])
    assert rows(some.filter("mate = 2 and sample = 'c'"), "sample", "seq") == [("c", "TTTT")]
    assert rows(some, "sample", "mate") == [("a", 1), ("a", 2), ("c", 1), ("c", 2)]
    assert read_fastq(spark, where, samples=[]).count() == 0
    with pytest.raises(Exception, match="FASTQ"):
        read_fastq(spark, where).collect()
    narrow = read_fastq(spark, f"file://{tmp_path}/in/[ab].fastq", columns=("mate", "sample"))
    assert narrow.columns == ["mate", "sample"] and rows(narrow, "mate", "sample") == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]


def test_stage_is_built_again_when_what_it_was_made_of_changes(spark, tmp_path):
    source, stage, built = str(tmp_path / "source"), str(tmp_path / "stage"), []
    spark.range(5).write.parquet(source)

    def made(least, **more):
        def build():
            built.append(least)
            return spark.read.parquet(source).filter(f"id >= {least}")

        return sinks.materialize_if_absent(spark, build, stage, inputs=[source], parameters={"least": least, **more}).count()

    assert [made(1), made(1), made(2), made(2)] == [4, 4, 3, 3] and built == [1, 2]
    spark.range(9).write.mode("overwrite").parquet(source)
    assert [made(2), made(2)] == [7, 7] and built == [1, 2, 2]
    # A finished stage that does not say what it was made of is outdated, but for callers that don't ask.
    (tmp_path / "stage" / "_made_from.json").unlink()
    assert sinks.materialize_if_absent(spark, lambda: spark.range(1), stage).count() == 7
    assert made(2) == 7 and built == [1, 2, 2, 2]
