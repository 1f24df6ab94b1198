"""Edge cases and properties of the operators."""

import random
import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from biomesheaf import plans
from biomesheaf.functions import packed as pk
from biomesheaf.functions import sequences as sq
from biomesheaf.operators import alignments as al
from biomesheaf.operators import annotation as an
from biomesheaf.operators import reads as rd
from biomesheaf.operators import resistome as rs
from biomesheaf.operators import taxonomy as tx
from checks import views

SAM = "sample string, qname string, flag int, rname string, pos bigint, cigar string, seq string, qual string"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


def revcomp(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_kmers_of_long_sequences(spark):
    rng = random.Random(1)
    seqs = ["".join(rng.choice("ACGTN" if i % 2 else "ACGT") for _ in range(n)) for i, n in enumerate((5, 20, 21, 276, 277, 1500))]
    df = spark.createDataFrame(list(enumerate(seqs)), "id int, seq string")
    for canonical in (False, True):
        want = []
        for i, s in enumerate(seqs):
            for p in range(len(s) - 20):
                word = s[p : p + 21]
                if "N" not in word:
                    want.append((i, p, min(word, revcomp(word)) if canonical else word))
        assert rows(sq.explode_kmers(df, 21, "id", canonical=canonical)) == sorted(want)


def test_coverage_with_gaps_clips_and_bins(spark):
    aln = spark.createDataFrame(
        [
            ("s", "a", 0, "c1", 1, "5S10M2D3M", None, None),
            ("s", "b", 16, "c1", 4, "4M3I4M", None, None),
            ("s", "c", 4, "c1", 1, "10M", None, None),
        ],
        SAM,
    )
    lengths = spark.createDataFrame([("s", "c1", 20), ("s", "c2", 7)], "sample string, rname string, length bigint")
    depth = Counter()
    for lo, hi in ((0, 15), (3, 11)):
        depth.update(range(lo, hi))
    hist = Counter(depth[p] for p in range(20))
    for width in (4, 1 << 14):
        got = al.coverage_histogram(aln, lengths, bin_width=width)
        assert rows(got.filter("cds = 'c1'"), "depth", "num_bases") == sorted(hist.items())
        assert rows(got.filter("cds = 'c2'"), "depth", "num_bases", "cds_size") == [(0, 7, 7)]
        assert rows(got.filter("cds = 'genome'").groupBy().agg(F.sum("num_bases"), F.max("cds_size"))) == [(27, 27)]
        total = rows(got.groupBy("cds").agg(F.round(F.sum("frac"), 9)))
        assert {f for _, f in total} == {1.0}


def test_duplicates_by_unclipped_start(spark):
    aln = spark.createDataFrame(
        [
            ("s", "b", 0, "c", 10, "10M", "A" * 10, "I" * 10),
            ("s", "a", 0, "c", 13, "3S7M", "A" * 10, "I" * 10),  # same unclipped start, tie: smaller name
            ("s", "r1", 16, "c", 5, "6M", "A" * 6, "I" * 6),
            ("s", "r2", 16, "c", 3, "6M2S", "A" * 8, "#" * 8),  # same 5' end on the reverse strand
            ("s", "u", 4, "c", 10, "*", "A", "I"),
            ("s", "sec", 256, "c", 10, "10M", "A", "I"),
        ],
        SAM,
    )
    assert rows(al.remove_duplicates(aln), "qname") == [("a",), ("r1",), ("sec",), ("u",)]
    assert rows(al.duplicate_metrics(aln), "examined", "duplicates") == [(4, 2)]


def test_tpm_sums_to_a_million(spark):
    counts = spark.createDataFrame([("s", f"g{i}", i) for i in range(1, 9)] + [("s", "x", 5), ("z", "g1", 0)], "sample string, gene_id string, count bigint")
    lengths = spark.createDataFrame([(f"g{i}", 100 * i) for i in range(1, 20)], "gene_id string, gene_length bigint")
    tpm = al.tpm(counts, lengths)
    assert rows(tpm.filter("sample = 's'").groupBy().agg(F.round(F.sum("tpm"), 3), F.count("*"))) == [(1e6, 8)]
    assert rows(tpm.filter("sample = 'z'"), "tpm") == [(None,)]


def test_screen_finds_variants_on_both_strands_either_way(spark):
    ref = "ACGTTGCATCGATCGGATCTTACGGCATGCATTAGCCATG"
    variant = ref[:20] + ("A" if ref[20] != "A" else "C") + ref[21:]
    other = "".join(random.Random(7).choice("ACGT") for _ in range(40))
    reads = spark.createDataFrame(
        [("s", p, m, q, "I" * 40) for p, (a, b) in enumerate([(ref, other), (other, revcomp(variant)), (other, other)]) for m, q in ((1, a), (2, b))],
        "sample string, pair_id int, mate int, seq string, qual string",
    )
    refs = spark.createDataFrame([("r", ref)], "ref_id string, seq string")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (usual, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        kept, removed = rd.kmer_screen(reads, refs, hdist=1)
        assert rows(kept, "pair_id") == [(2,), (2,)]
        assert rows(removed, "pair_id") == [(0,), (0,), (1,), (1,)]
        assert rows(rd.kmer_screen(reads, refs, hdist=0)[1], "pair_id") == [(0,), (0,)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_subsamples_are_nested(spark):
    ids = spark.range(3000).withColumnRenamed("id", "pair_id")
    small, large = rd.subsample(ids, 0.05), rd.subsample(ids, 0.3)
    assert small.join(large, "pair_id", "left_anti").count() == 0
    assert 80 < small.count() < 220 and 750 < large.count() < 1050


def test_interleave_round_trip_and_pairs(spark):
    reads = spark.createDataFrame(
        [("s", "p1", 1, "AC", "II"), ("s", "p1", 2, "GT", "##"), ("s", "p2", 1, "A", "I"), ("s", "p3", 1, "A", "I"), ("s", "p3", 1, "C", "I")],
        "sample string, pair_id string, mate int, seq string, qual string",
    )
    assert rows(rd.verify_pairs(reads), "pair_id") == [("p2",), ("p3",)]
    with pytest.raises(ValueError):
        rd.require_pairs(reads)
    whole = rd.require_pairs(reads.filter("pair_id = 'p1'"))
    assert rows(rd.deinterleave(whole)) == [("s", "p1", "AC", "II", "GT", "##")]


def test_arguments_are_checked(spark):
    seqs = spark.createDataFrame([("chrM", "A"), ("chrEBV", "C"), ("chr1", "G")], "ref_id string, seq string")
    assert rows(rd.drop_sequences_by_id(seqs, "MT"), "ref_id") == [("chr1",), ("chrEBV",)]
    with pytest.raises(ValueError):
        rd.drop_sequences_by_id(seqs, "other")
    with pytest.raises(ValueError):
        an.percent_threshold(1)


COVERAGE = "sample string, cds string, depth bigint, num_bases bigint, cds_size bigint, frac double, seed_orth string, ec string, kegg_ko string, kegg_pwy string, protein_name string"


def test_threshold_is_strict_and_nulls_are_skipped(spark):
    cov = spark.createDataFrame(
        [
            ("s", "at", 1, 30, 40, 0.75, "o1", "1.1.1.1", None, None, None),
            ("s", "over", 1, 20, 40, 0.5, "o2", "1.1.1.1,9.9.9.9", None, None, None),
            ("s", "over", 3, 11, 40, 0.275, "o2", "1.1.1.1,9.9.9.9", None, None, None),
            ("s", "gene", 2, 40, 40, 1.0, "o3", None, None, None, "ABC"),
            ("s", "none", 2, 40, 40, 1.0, "o4", None, None, None, None),
            ("s", "genome", 2, 40, 40, 1.0, None, None, None, None, None),
            ("s", "over", 0, 9, 40, 0.225, "o2", "1.1.1.1,9.9.9.9", None, None, None),
        ],
        COVERAGE,
    )
    targets = spark.createDataFrame(
        [("P", "1.1.1.1", None, "Abc", "ec001"), ("Q", None, None, None, None), ("R", "1.1.1.1,2.2.2.2", None, "abc", None)],
        "pathway string, ec string, ko string, short_name string, pwy string",
    )
    got = rows(an.pathway_feature_table(cov, targets), "ec", "pathway", "depth")
    # 'over' has depths 1 + 3; 'gene' (depth 2) is translated to both enzymes of its name.
    assert got == [("1.1.1.1", "P", 2.5), ("1.1.1.1", "R", 2.5), ("2.2.2.2", "R", 1.0)]
    words = rows(an.keyword_feature_table(cov, targets))
    assert words == [("s", "1.1.1.1", 4.0, "o2"), ("s", "abc", 2.0, "o3")]
    an.assert_depth_conserved(cov, cov.withColumn("split_depth", F.col("depth").cast("double")))
    with pytest.raises(AssertionError):
        an.assert_depth_conserved(cov, cov.withColumn("split_depth", F.col("depth") * 2.0))


def test_several_annotation_rows_of_a_cds(spark):
    hist = spark.createDataFrame([("s", "c", 1, 10, 40, 0.25), ("s", "c", 2, 20, 40, 0.5)], ", ".join(COVERAGE.split(", ")[:6]))
    ann = spark.createDataFrame([("c", "x"), ("c", "y"), ("c", "y")], "cds string, ec string")
    late = an.collapse_covered(an.annotate_coverage(hist, ann))
    early = an.annotate_collapsed(an.collapse_coverage(hist), ann)
    columns = ("cds", "ec", "depth", "num_bases", "frac")
    assert rows(late, *columns) == rows(early, *columns) == [("c", "x", 9, 90, 2.25), ("c", "y", 9, 90, 2.25)]


def test_max_depth_row(spark):
    cov = spark.createDataFrame([("s", "c", d, 1, 4, 0.25) for d in (0, 7, 3)], ", ".join(COVERAGE.split(", ")[:6]))
    assert rows(an.max_depth_row(cov), "cds", "depth") == [("c", 7)]


REPORT = "sample string, line_no bigint, clade_reads bigint, rank string, tax_id int, name string"


def test_richness_when_bacteria_is_last_or_missing(spark):
    report = spark.createDataFrame(
        [
            ("last", 1, 5, "D", 3, "Archaea"), ("last", 2, 5, "S", 30, "a"), ("last", 3, 9, "D", 2, "Bacteria"),
            ("last", 4, 9, "S", 20, "b"), ("last", 5, 9, "S", 21, "c"), ("last", 6, 9, "S1", 22, "d"),
            ("first", 1, 9, "D", 2, "Bacteria"), ("first", 2, 9, "S", 20, "b"), ("first", 3, 5, "D", 3, "Archaea"), ("first", 4, 5, "S", 30, "a"),
            ("none", 1, 5, "D", 3, "Archaea"), ("none", 2, 5, "S", 30, "a"),
        ],
        REPORT,
    )
    assert rows(tx.bacterial_species_richness(report)) == [("first", 1), ("last", 2), ("none", 0)]
    counts = tx.domain_read_counts(report)
    assert rows(counts, "sample", "bacteria_reads", "archaea_reads")[0] == ("first", 9, 5)
    assert counts.filter("sample = 'none' and bacteria_reads is null").count() == 1


def test_classification_against_a_loop(spark):
    parents = {1: 0, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3}
    tax = spark.createDataFrame([(t, p, "S", str(t)) for t, p in parents.items()], "tax_id int, parent_id int, rank string, name string")
    rng = random.Random(3)
    k, words = 5, {}
    while len(words) < 200:
        w = "".join(rng.choice("ACGT") for _ in range(k))
        words[min(w, revcomp(w))] = rng.choice(list(parents))
    reads = [("s", p, m, "".join(rng.choice("ACGTN") for _ in range(14)), "") for p in range(150) for m in (1, 2)]

    def path(t):
        return [] if t == 0 else path(parents[t]) + [t]

    hits = defaultdict(Counter)
    for _, p, _, s, _ in reads:
        for i in range(len(s) - k + 1):
            w = s[i : i + k]
            t = words.get(min(w, revcomp(w))) if "N" not in w else None
            if t:
                hits[p][t] += 1
    want = []
    for p in range(150):
        score = {t: sum(hits[p][a] for a in path(t)) for t in hits[p]}
        tied = [path(t) for t in score if score[t] == max(score.values())]
        shared = [a for a in tied[0] if all(a in x for x in tied)] if tied else [0]
        want.append((p, shared[-1]))
    db = spark.createDataFrame(list(words.items()), "kmer string, tax_id int")
    df = spark.createDataFrame(reads, "sample string, pair_id int, mate int, seq string, qual string")
    called = tx.classify_reads(df, db, tax, k)
    assert rows(called, "read_id", "tax_id") == want
    report = tx.taxonomy_report(called, tax)
    root = report.filter("tax_id = 1").select("clade_reads").first()[0]
    assert root == called.filter("status = 'C'").count()


def test_haplotypes_of_gapped_alignments(spark):
    gene = "ACGTACGTACGTACGT"
    genes = spark.createDataFrame([("g", 16, gene)], "gene string, gene_length int, gene_seq string")
    hits = spark.createDataFrame(
        [
            ("s", "a", 0, "g", 3, "2S4M1I3M2D2M", "TT" + "GTAC" + "G" + "GTA" + "TT", None),
            ("s", "b", 0, "g", 1, "4M", "ACGT", None),
            ("s", "c", 0, "g", 1, "4M", "ACTT", None),
            ("s", "d", 16, "g", 1, "4M", "ACTT", None),
        ],
        SAM,
    )
    got = rows(rs.snp_haplotypes(hits, genes))
    # 4M covers 3-6, the insertion nothing, 3M 7-9, the deletion 10-11, 2M 12-13 (T, A read as T, T).
    assert got == [("s", "g", "13:A>T", 1), ("s", "g", "3:G>T", 2)]


def test_duplicate_pairs_lose_both_mates(spark):
    aln = spark.createDataFrame(
        [
            ("s", "A", 99, "c", 10, "10M", "A" * 10, "I" * 10),
            ("s", "A", 147, "c", 50, "10M", "A" * 10, "#" * 10),
            ("s", "B", 99, "c", 10, "10M", "A" * 10, "#" * 10),
            ("s", "B", 147, "c", 50, "8M2S", "A" * 10, "I" * 10),  # its mate is clipped otherwise
            ("s", "C", 99, "c", 10, "10M", "A" * 10, "!" * 10),
            ("s", "C", 147, "c", 52, "8M", "A" * 8, "!" * 8),
        ],
        SAM,
    )
    assert rows(al.remove_duplicates(aln), "qname", "flag") == [("A", 99), ("A", 147)]
    assert rows(al.duplicate_metrics(aln), "examined", "duplicates") == [(6, 4)]


def test_soft_masked_bases_count(spark):
    ref = "ACGTTGCATCGATCGGATCTTACGGCATGCATTAGCCATG"
    reads = spark.createDataFrame([("s", 1, m, ref, "I" * 40) for m in (1, 2)], "sample string, pair_id int, mate int, seq string, qual string")
    for text in (ref, ref.lower()):
        refs = spark.createDataFrame([("r", text)], "ref_id string, seq string")
        assert rd.kmer_screen(reads, refs)[1].count() == 2
        assert rd.kmer_screen(reads.withColumn("seq", F.lower("seq")), refs)[0].count() == 0
    contigs = spark.createDataFrame([("s", "a", "acgtNNgg"), ("s", "b", "NNNN")], "sample string, assembler string, seq string")
    got = rows(al.assembly_stats(contigs, (0,)), "assembler", "gc_percent", "n_per_100kbp")
    assert got == [("a", 100.0 * 4 / 6, 25000.0), ("b", None, 100000.0)]


def test_reads_of_unknown_taxa_are_reported(spark):
    tree = spark.createDataFrame([(1, 0, "R", "root"), (2, 1, "S", "x")], "tax_id long, parent_id long, rank string, name string")
    calls = spark.createDataFrame([("s", "C", "a", 2), ("s", "C", "b", 77), ("s", "U", "c", 0)], "sample string, status string, read_id string, tax_id long")
    guard = spark.conf.get(tx.ROW_GUARD)
    got = rows(tx.taxonomy_report(calls, tree), "name", "clade_reads")
    assert sorted(got) == [("root", 1), ("unclassified", 1), ("unplaced", 1), ("x", 1)]
    assert rows(tx.translate_lineage(calls, tree), "read_id", "taxonomy") == [("a", "root|x"), ("b", "unplaced")]
    assert spark.conf.get(tx.ROW_GUARD) == guard


def test_target_tables_of_any_size(spark):
    table = spark.createDataFrame([("s", "c1", ["e7", "e150001", "x"]), ("s", "c2", ["y"]), ("s", "c3", None)], "sample string, cds string, ec array<string>")
    wanted = spark.range(150_000).select(F.lit("p").alias("pathway"), F.lit("ec").alias("kind"), F.concat(F.lit("e"), F.col("id").cast("string")).alias("id"))
    assert rows(an.intersect_targets(table, wanted, ("ec",)), "cds", "ec_hit") == [("c1", ["e7"]), ("c2", None), ("c3", None)]


def test_split_that_loses_depth_raises(spark):
    before = spark.createDataFrame([("s", 3.0, ["a", "b"]), ("s", 2.0, ["c"])], "sample string, depth double, ids array<string>")
    an.assert_depth_conserved(before, an.split_depth(before, "ids"))
    with pytest.raises(AssertionError):
        an.assert_depth_conserved(before, an.split_depth(before.limit(1), "ids"))


def test_split_is_checked_while_it_is_stored(spark):
    schema = "sample string, depth double, ids array<string>"
    before = spark.createDataFrame([("s", 3.0, ["a", "b"]), ("s", 2.0, ["c"]), ("t", 1.0, ["c"])], schema)
    kept = an._checked(before, "ids", "id", True)
    assert rows(kept, "sample", "id", "split_depth") == [("s", "a", 1.5), ("s", "b", 1.5), ("s", "c", 2.0), ("t", "c", 1.0)]
    with pytest.raises(AssertionError, match="depth differs"):
        an._checked(before.union(spark.createDataFrame([("s", 1.0, [])], schema)), "ids", "id", True)
    assert an._checked(before.filter("depth > 9"), "ids", "id", True).count() == 0
    assert an._checked(spark.createDataFrame([], schema), "ids", "id", True).count() == 0


def test_frequent_sequences_are_counted_exactly(spark):
    # Two thirds of a sample are distinct sequences; frequent ones stand just above and below the share.
    rare = spark.range(60_000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("seq"))
    often = spark.range(60).select(F.explode(F.expr("array_repeat(concat('f', id), cast(470 + id as int))")).alias("seq"))
    one = rare.union(often).select(F.lit("s").alias("sample"), "seq")
    both = one.union(spark.createDataFrame([("t", "x"), ("t", None)], "sample string, seq string"))
    total = one.count()
    expected = sorted((f"f{i}", 470 + i) for i in range(60) if 470 + i > total * 0.00555)
    for share in (0.00555,):
        got = rd.qc_overrepresented(both, share).filter("sample = 's'")
        assert 0 < len(expected) < 60 and rows(got, "seq", "reads") == expected
    assert rows(rd.qc_overrepresented(one, 0.00009), "seq", "reads") == rows(
        one.groupBy("seq").agg(F.count("*").alias("reads")).filter(F.col("reads") > total * 0.00009), "seq", "reads"
    )
    plan = rd.qc_summary(both)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(sample" in plan and "hashpartitioning(sample#" in plan and ", seq#" not in plan.split("hashpartitioning", 1)[1].split("\n")[0]


def test_a_reference_is_no_adapter_panel(spark, monkeypatch):
    monkeypatch.setattr(rd, "PANEL_BASES", 100)
    panel = spark.createDataFrame([("ACGT" * 30,)], "seq string")
    with pytest.raises(ValueError, match="adapter panel"):
        rd.trim_adapters(spark.createDataFrame([("s", "p", 1, "ACGT", "IIII")], "sample string, pair_id string, mate int, seq string, qual string"), panel)


def test_kmers_as_numbers_are_the_packed_texts(spark):
    df = spark.createDataFrame([("a", "ACGTNACGGTTACA"), ("a", "acgTT"), ("b", None), (None, "CCATG")], "sample string, seq string")
    for k, canonical in ((5, True), (4, False), (33, True)):
        texts = sq.explode_kmers(df, k, "sample", canonical=canonical).withColumn("kmer", pk.packed("kmer", k))
        numbers = sq.explode_kmers(df, k, "sample", canonical=canonical, as_numbers=True)
        assert numbers.columns == texts.columns
        assert Counter(map(tuple, numbers.collect())) == Counter(map(tuple, texts.collect()))


def test_rows_of_a_target_search_are_made_once(spark, tmp_path):
    """They are asked for their distinct lists and for themselves."""

    def counted(batches):
        for batch in batches:
            for _ in range(batch.num_rows):
                tempfile.mkstemp(dir=tmp_path)
            yield batch

    base = spark.createDataFrame(
        [("s", "c1", ["1.1", "2.2"], None), ("s", "c2", None, None), ("t", "c1", ["2.2"], ["map1"])],
        "sample string, cds string, ec array<string>, kegg_pwy array<string>",
    )
    targets = spark.createDataFrame([("p", "ec", "1.1"), ("p", "pwy", "map1")], "pathway string, kind string, id string")
    got = an.intersect_targets(base.mapInArrow(counted, base.schema), targets, ("ec", "pwy"))
    want = [("s", "c1", ["1.1"], None), ("s", "c2", None, None), ("t", "c1", None, ["map1"])]
    assert rows(got, "sample", "cds", "ec_hit", "pwy_hit") == want
    assert len(list(tmp_path.iterdir())) == 3


def test_levels_collapse_like_runs_of_each(spark, capsys):
    rng = random.Random(3)
    spans = [("s", rng.choice("ab"), a, a + rng.randrange(40), rng.randrange(3)) for a in (rng.randrange(100) for _ in range(60))]
    df = spark.createDataFrame([*spans, ("s", None, 1, 9, 0)], "sample string, rname string, start0 bigint, end0 bigint, entry int")
    sizes = spark.createDataFrame([("a", 140), ("b", 140)], "rname string, length bigint")
    runs = al.coverage_runs(df, bin_width=32, levels=3)
    runs.explain()
    # A position is one row of each level that has an end there; no column per level is shuffled.
    assert "partial_sum(CASE" not in capsys.readouterr().out
    got = an.collapse_levels(runs, sizes, F.array(*map(F.lit, (10, 20, 30))), 3)
    want = []
    for i, percent in enumerate((10, 20, 30)):
        each = an.collapse_runs(al.coverage_runs(df.filter(F.col("entry") <= i)), sizes)
        want += [(*r, percent) for r in rows(each, "sample", "cds", "depth", "num_bases", "cds_size")]
    assert rows(got, "sample", "cds", "depth", "num_bases", "cds_size", "percent") == sorted(want)


def test_histogram_takes_what_is_covered_from_depth_0(spark, capsys):
    spans = [("s", "a", 0, 10), ("s", "a", 5, 10), ("s", "x", 0, 4), ("s", "full", 0, 6)]
    aln = spark.createDataFrame(spans, "sample string, rname string, start0 bigint, end0 bigint")
    sizes = spark.createDataFrame([("s", "a", 20), ("s", "full", 6), ("s", "none", 7)], "sample string, rname string, length bigint")
    got = al.coverage_histogram(aln, sizes)
    got.explain()
    # A covered run is two rows, its reference's and the genome's, and none that takes away.
    assert "-bases" not in capsys.readouterr().out.replace(" ", "")
    genome = [("genome", 0, 13, 33), ("genome", 1, 15, 33), ("genome", 2, 5, 33)]
    assert rows(got, "cds", "depth", "num_bases", "cds_size") == sorted(
        [("a", 0, 10, 20), ("a", 1, 5, 20), ("a", 2, 5, 20), ("full", 1, 6, 6), ("none", 0, 7, 7), *genome]
    )


def test_test_tables_are_dealt_by_their_bytes(spark, tmp_path, monkeypatch):
    spark.range(5000).selectExpr("id as c_custkey", "uuid() as c_name").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    least = spark.sparkContext.defaultParallelism
    assert views.Views(spark, str(tmp_path)).customer.rdd.getNumPartitions() == max(least, 1)
    monkeypatch.setitem(views.DEALT, "customer", 4096)
    assert views.Views(spark, str(tmp_path)).customer.rdd.getNumPartitions() > 3 * least


def test_candidates_and_features_share_one_coverage(spark, tmp_path):
    """A cohort's placeholders ask for the candidates again, not for their coverage."""

    def counted(batches):
        for batch in batches:
            for _ in range(batch.num_rows):
                tempfile.mkstemp(dir=tmp_path)
            yield batch

    base = spark.createDataFrame([("s", "c1", 0, 90)], "sample string, rname string, start0 bigint, end0 bigint")
    annotations = spark.createDataFrame([("c1", "o", "1.1", None, None, None)], "cds string, seed_orth string, ec string, kegg_ko string, kegg_pwy string, protein_name string")
    targets = spark.createDataFrame([("p", "1.1", None, None, None)], "pathway string, ec string, ko string, short_name string, pwy string")
    samples = spark.createDataFrame([("s",), ("t",)], "sample string")
    sizes = spark.createDataFrame([("c1", 100)], "rname string, length bigint")
    got = plans.keyword_features(base.mapInArrow(counted, base.schema), sizes, annotations, targets, samples=samples)
    assert sorted((r.sample, r.kwd) for r in got.collect()) == [("s", "1.1"), ("t", None)]
    assert len(list(tmp_path.iterdir())) == 1
