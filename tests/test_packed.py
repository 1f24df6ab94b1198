"""Packed k-mers, minimizer runs, the numbered tree and what is built on them, against plain text versions."""

import random
import time
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from biomesheaf.functions import packed as pk
from biomesheaf.operators import alignments as al
from biomesheaf.operators import reads as rd
from biomesheaf.operators import taxonomy as tx

READS = "sample string, pair_id int, mate int, seq string"


def revcomp(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def number(word):
    n = 0
    for base in word:
        n = 4 * n + "ACGT".index(base)
    return n


def signed(n):
    return n - 2**64 if n >= 2**63 else n


def plain_words(seq, k, canonical):
    for i in range(len(seq) - k + 1):
        word = seq[i : i + k].upper()
        yield None if set(word) - set("ACGT") else min(word, revcomp(word)) if canonical else word


def some_reads(rng, n, length=80):
    genome = "".join(rng.choice("ACGT") for _ in range(400))
    out = []
    for p in range(n):
        for m in (1, 2):
            at = rng.randrange(len(genome) - length)
            s = genome[at : at + rng.randrange(0, length)]
            s = "".join(rng.choice("ACGTN") if rng.random() < 0.01 else c for c in (s if rng.random() < 0.5 else revcomp(s)))
            out.append((rng.choice("xy"), p, m, s.lower() if p % 9 == 0 else s))
    return out


@pytest.mark.parametrize("k", [1, 5, 21, 31, 32, 33, 35, 64])
def test_words_of_a_batch(k):
    rng = random.Random(k)
    seqs = ["".join(rng.choice("ACGTNacgt") if rng.random() < 0.05 else rng.choice("ACGT") for _ in range(n)) for n in (0, 3, 21, 40, 64, 100, 300)]
    for canonical in (False, True):
        got = pk.word_lists(pa.array([*seqs, None]), k, canonical).to_pylist()
        for seq, words in zip([*seqs, ""], got, strict=True):
            want = [None if w is None else number(w) for w in plain_words(seq, k, canonical)]
            if k > 32:
                assert words == [None if n is None else {"hi": signed(n >> 64), "lo": signed(n % 2**64)} for n in want]
            else:
                assert words == [None if n is None else signed(n) for n in want]


def test_words_of_pieces_and_their_text(spark):
    rng = random.Random(2)
    seqs = ["".join(rng.choice("ACGTN" if i % 2 else "ACGT") for _ in range(n)) for i, n in enumerate((5, 21, 1044, 1045, 5000))]
    df = spark.createDataFrame(list(enumerate(seqs)), "id int, seq string")
    for k in (21, 32):
        want = sorted((i, p, w) for i, s in enumerate(seqs) for p, w in enumerate(plain_words(s, k, True)) if w)
        got = pk.explode_words(df, k, "id", canonical=True).select("id", "pos", pk.unpacked("word", k).alias("kmer"))
        assert sorted(tuple(r) for r in got.collect()) == want


def test_packing_text_words(spark):
    df = spark.createDataFrame([("ACGT",), ("acgt",), ("ACG",), ("ACGN",), (None,), ("TTTT",)], "kmer string")
    assert [r[0] for r in df.select(pk.packed("kmer", 4)).collect()] == [27, 27, None, None, None, 255]
    with pytest.raises(ValueError):
        pk.packed("kmer", 65)


def test_differing_bases(spark):
    rng = random.Random(3)
    pairs = [["".join(rng.choice("ACGT") for _ in range(32)) for _ in range(2)] for _ in range(50)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", pk.differing_bases(pk.packed("a", 32), pk.packed("b", 32)).alias("n"))
    assert all(r.n == sum(x != y for x, y in zip(r.a, r.b, strict=True)) for r in df.collect())


@pytest.mark.parametrize("k", [15, 32, 40])
def test_screen_allows_one_base(spark, k):
    rng = random.Random(k)
    ref = "".join(rng.choice("ACGT") for _ in range(120))
    reads = []
    for p in range(120):
        at = rng.randrange(120 - k)
        s = list(ref[at : at + k])
        for _ in range(p % 4):
            s[rng.randrange(k)] = rng.choice("ACGTN")
        reads.append(("s", p, 1, revcomp("".join(s)) if p % 2 else "".join(s)))
    both = set(plain_words(ref, k, False)) | set(plain_words(revcomp(ref), k, False))
    near = lambda w, most: w is not None and any(sum(a != b for a, b in zip(w, r, strict=True)) <= most for r in both)
    df = spark.createDataFrame(reads, READS)
    refs = spark.createDataFrame([("r", ref), ("t", ref[:60])], "ref_id string, seq string")
    for most in (0, 1):
        want = {p for _, p, _, s in reads if any(near(w, most) for w in plain_words(s, k, False))}
        assert {r.pair_id for r in rd.screened_pairs(df, refs, k, most).collect()} == want
        stats = {r.ref_id: r.reads for r in rd.kmer_screen_stats(df, refs, k, most).collect()}
        assert stats["r"] == len(want) >= stats.get("t", 0)
    with pytest.raises(ValueError):
        rd.screened_pairs(df, refs, k, 2)


@pytest.mark.parametrize(("k", "depth"), [(9, 4), (32, 2), (40, 1)])
def test_depth_filter_equals_counting_all_words(spark, k, depth):
    rng = random.Random(k)
    rows = some_reads(rng, 150) + [("x", 1000 + p, 1, "ACGTTGCATT" * 7) for p in range(300)] + [("y", 2000, 1, "A" * 70), ("y", 2001, 1, None)]
    count = Counter((s, w) for s, _, _, q in rows for w in plain_words(q or "", k, True) if w)
    low = {(s, p) for s, p, _, q in rows for w in plain_words(q or "", k, True) if w and count[s, w] <= depth}
    want = sorted((s, p, m) for s, p, m, _ in rows if (s, p) not in low)
    for parts in (1, 5):
        got = rd.toss_low_depth_reads(spark.createDataFrame(rows, READS).repartition(parts), k, depth)
        assert sorted(tuple(r) for r in got.select("sample", "pair_id", "mate").collect()) == want


def test_runs_of_a_group_that_fills_many_batches():
    """One sample, one minimizer: rows are held, folded and still counted right."""
    seqs = ["ACGTTGCATTACGGATCCATG"] * 50 + ["ACGTTGCATTACGGATCCATC"] * 3
    batch = pa.RecordBatch.from_pydict({"sample": ["s"] * 53, "owner": list(range(53)), "seq": seqs})
    runs = pa.Table.from_batches(list(pk.run_batches(20, 5, 4)(iter([batch]))))
    runs = runs.sort_by([("sample", "ascending"), ("minimizer", "ascending")])
    assert runs.num_rows < 53
    for size in (1, 7, 100):
        found = [x for b in pk.rare_owners(20, 4)(iter(runs.to_batches(max_chunksize=size))) for x in b.column("owner").to_pylist()]
        assert set(found) == {50, 51, 52}


def tree_rows():
    return [(1, 0, "R", "root"), (10, 1, "D", "a"), (2, 1, "D", "b"), (20, 10, "S", "c"), (21, 10, "S", "d"), (22, 2, "S", "e"), (30, 20, "S", "f")]


def tree(spark):
    return tx.lineages(spark.createDataFrame(tree_rows(), "tax_id int, parent_id int, rank string, name string"))


def test_numbers_of_the_tree(spark):
    found = {r.tax_id: r for r in tree(spark).collect()}
    by_number = sorted(found.values(), key=lambda r: r.enter)
    assert [r.path for r in by_number] == sorted(r.path for r in by_number)
    assert [r.enter for r in by_number] == list(range(1, 8))
    for u in found.values():
        below = [t for t in found.values() if u.tax_id in t.path]
        assert u.leave - u.enter + 1 == len(below)
        assert all((u.enter <= t.enter <= u.leave) == (u.tax_id in t.path) for t in found.values())
        assert u.enters == [found[t].enter for t in u.path] and u.leaves == [found[t].leave for t in u.path]


def test_words_of_several_taxa_get_their_lca(spark):
    rows = [("AAC", 30), ("GTT", 21), ("CCA", 30), ("CCA", 22), ("ACG", 20), ("ACG", 30), ("GAA", 77), ("CAC", 77), ("GTG", 20), ("CTA", 78), ("CTA", 79)]
    db = spark.createDataFrame(rows, "kmer string, tax_id int")
    want = {"AAC": 10, "CCA": 1, "ACG": 20, "CGT": 20, "GAA": 77, "CAC": 0, "CTA": 0}
    got = {r.kmer: r.tax_id for r in tx.canonical_kmer_db(db, tree(spark)).collect()}
    assert got == {min(w, revcomp(w)): t for w, t in want.items()}
    packed = tx.packed_kmer_db(db, tree(spark), 3).select(pk.unpacked("word", 3).alias("kmer"), "tax_id", "enter", "leave")
    place = {r.tax_id: (r.enter, r.leave) for r in tree(spark).collect()}
    for r in packed.collect():
        assert r.tax_id == got[r.kmer] and (r.enter, r.leave) == place.get(r.tax_id, (r.enter, r.leave))
        assert (r.enter > 0) == (r.tax_id in place)


@pytest.mark.parametrize("k", [5, 35])
def test_calls_and_hit_strings_equal_plain_versions(spark, k):
    rng = random.Random(k)
    rows = some_reads(rng, 60) + [("x", 500, 1, "ACG"), ("x", 500, 2, None), ("y", 501, 1, "N" * 60)]
    path = {t: [] for t in (0,)}
    for t, parent, _, _ in tree_rows():
        path[t] = [*path[parent], t]
    known = {}
    for _, _, _, s in rows:
        for w in plain_words(s or "", k, True):
            if w and rng.random() < 0.4:
                known.setdefault(w, rng.choice([1, 2, 10, 20, 21, 22, 30, 99]))
    db = spark.createDataFrame(list(known.items()), "kmer string, tax_id int")
    df = spark.createDataFrame(rows, READS)
    hits, length = defaultdict(Counter), Counter()
    for s, p, _, q in rows:
        length[s, p] += len(q or "")
        for w in plain_words(q or "", k, True):
            if w in known and known[w] in path:
                hits[s, p][known[w]] += 1
    want = []
    for pair, n in length.items():
        score = {t: sum(hits[pair][a] for a in path[t]) for t in hits[pair]}
        best = [path[t] for t in score if score[t] == max(score.values())]
        shared = [a for a in best[0] if all(a in b for b in best)] if best else [0]
        want.append((pair[0], "C" if best else "U", pair[1], shared[-1], n))
    got = [tuple(r) for r in tx.classify_reads(df, db, tree(spark), k).collect()]
    assert sorted(got) == sorted(want)
    runs = {}
    for s, p, m, q in rows:
        labels = [("A" if w is None else str(known.get(w, 0))) for w in plain_words(q or "", k, True)]
        out = []
        for x in labels:
            if out and out[-1][0] == x:
                out[-1][1] += 1
            else:
                out.append([x, 1])
        if labels:
            runs[s, p, m] = " ".join(f"{a}:{b}" for a, b in out)
    assert {(r.sample, r.pair_id, r.mate): r.kmer_hits for r in tx.kmer_hit_string(df, db, k).collect()} == runs


def test_words_of_reads_are_never_broadcast(spark, tmp_path, capsys):
    """The files of the reads are smaller than the k-mer table, their words are not."""
    rng = random.Random(4)
    seq = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    spark.createDataFrame([("x", 1, 1, seq(300)), ("x", 1, 2, seq(20))], READS).write.parquet(str(tmp_path / "reads"))
    reads = spark.read.parquet(str(tmp_path / "reads"))
    kmers = [(seq(21), 5) for _ in range(3000)] + [(reads.filter("mate = 1").first().seq[7:28], 7)]
    found = tx.kmer_hit_string(reads, spark.createDataFrame(kmers, "kmer string, tax_id int"), 21)
    found.explain()
    assert "BuildLeft" not in capsys.readouterr().out
    assert [tuple(r) for r in found.collect()] == [("x", 1, 1, "0:7 7:1 0:272")]


def test_hit_strings_take_time_in_proportion_to_the_read():
    rng = random.Random(9)

    def seconds(length):
        seqs = pa.array(["".join(rng.choice("ACGT") for _ in range(length))] * 20)
        places = pa.array([list(range(0, length - 21, 2))] * 20, pa.list_(pa.int32()))
        taxa = pa.array([[5] * len(range(0, length - 21, 2))] * 20, pa.list_(pa.int64()))
        begin = time.perf_counter()
        pk.hit_runs(seqs, places, taxa, 21)
        return time.perf_counter() - begin

    seconds(1000)
    assert min(seconds(40_000) for _ in range(3)) < 8 * min(seconds(10_000) for _ in range(3))


def test_no_text_of_a_kmer_is_shuffled(spark):
    df = spark.createDataFrame([("s", 1, 1, "ACGTTGCATTACGGATCCATGACGTTGCATTACG")], READS)
    plan = rd.toss_low_depth_reads(df)._jdf.queryExecution().executedPlan().toString()
    assert "minimizer" in plan and "kmer" not in plan
    refs = spark.createDataFrame([("r", "ACGTTGCATTACGGATCCATGACGTTGCATTACG")], "ref_id string, seq string")
    words = rd._by_halves(rd.contaminant_words(refs), 31, "ref_id")
    assert words.count() == 2 * rd.contaminant_words(refs).count() and dict(words.dtypes)["key"] == "bigint"


def test_sketches_are_kept_merged_and_compared(spark, tmp_path):
    rng = random.Random(11)
    base = "".join(rng.choice("ACGT") for _ in range(600))
    seqs = [("a", base), ("b", base[:400]), ("c", base[300:]), ("d", "".join(rng.choice("ACGT") for _ in range(500))), ("e", "ACGT")]
    df = spark.createDataFrame(seqs, "ref_id string, seq string")
    words = {n: {w for w in plain_words(s, 21, True) if w} for n, s in seqs}
    for size in (50, 5000):
        made = al.sketches(df, "ref_id", 21, size)
        path = str(tmp_path / str(size))
        al.keep_sketches(df.limit(2), path, "ref_id", 21, size)
        before = {f.name for f in (tmp_path / str(size)).iterdir()}
        kept = al.keep_sketches(df, path, "ref_id", 21, size)
        assert before <= {f.name for f in (tmp_path / str(size)).iterdir()}
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, made.collect()))
        assert al.keep_sketches(df, path, "ref_id", 21, size).count() == made.count()
        groups = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "x")], "ref_id string, part string")
        merged = al.merge_sketches(made.join(groups, "ref_id"), "part", size)
        whole = al.sketches(df.join(groups, "ref_id"), "part", 21, size)
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    left, right = made.withColumnRenamed("ref_id", "l"), made.withColumnRenamed("ref_id", "r")
    got = {(x.l, x.r): (x.shared, x.similarity) for x in al.sketch_similarity(left, right, "l", "r", 5000).collect()}
    want = {(a, b): (len(words[a] & words[b]), len(words[a] & words[b]) / len(words[a] | words[b])) for a in words for b in words if words[a] & words[b]}
    assert got == want
    low = al.sketches(df, "ref_id", 21, 50)
    near = {(x.l, x.r): x.similarity for x in al.sketch_similarity(low.withColumnRenamed("ref_id", "l"), low.withColumnRenamed("ref_id", "r"), "l", "r", 50).collect()}
    assert near["a", "a"] == 1.0 and abs(near["a", "b"] - want["a", "b"][1]) < 0.25


def test_cohorts_from_stored_sketches(spark):
    rng = random.Random(12)
    shared = "".join(rng.choice("ACGT") for _ in range(3000))
    rows = [(f"s{i}", 0, 1, shared + "".join(rng.choice("ACGT") for _ in range(2000))) for i in range(4)]
    for k in (31, 40):
        kept = rd.cardinality_sketches(spark.createDataFrame(rows, READS), k)
        got = rd.cohort_cardinality(kept).first()
        exact = len({w for _, _, _, s in rows for w in plain_words(s, k, True)})
        assert got.samples == 4 and abs(got.kmers - exact) < 3 * 0.8 / 64 * exact


def test_counts_of_nested_intervals_are_differences_of_ranks(spark):
    rng = random.Random(13)
    spans = [("s", "c", a, a + rng.randrange(0, 60)) for a in (rng.randrange(0, 1000) for _ in range(300))] + [("s", None, 1, 9), ("t", "c", 5, 6)]
    gaps = [("c", f"g{i % 90}", a, a + rng.randrange(-2, 500)) for i, a in enumerate(rng.randrange(0, 1000) for _ in range(100))] + [("d", "other", 0, 10), (None, "none", 0, 10)]
    aln = spark.createDataFrame(spans, "sample string, rname string, start0 bigint, end0 bigint")
    intervals = spark.createDataFrame(gaps, "rname string, gene_id string, start int, end int")
    want = Counter({(s, g): 0 for s in "st" for _, g, _, _ in gaps})
    for s, c, a, b in spans:
        for d, g, x, y in gaps:
            if c == d and c is not None and a < b and x < y and a < y and b > x:
                want[s, g] += 1
    for width in (7, 64, 1 << 14):
        got = {(r.sample, r.gene_id): r["count"] for r in al.count_reads_per_interval(aln, intervals, width).collect()}
        assert got == dict(want)


def test_many_nested_intervals_in_one_bin_make_no_pairs(spark):
    n = 100_000
    intervals = spark.range(n).select(F.lit("c").alias("rname"), F.col("id").alias("gene_id"), F.lit(0).alias("start"), (F.col("id") % 16_000 + 1).alias("end"))
    aln = spark.range(20_000).select(F.lit("s").alias("sample"), F.lit("c").alias("rname"), (F.col("id") % 16_000).alias("start0"), (F.col("id") % 16_000 + 100).alias("end0"))
    counted = al.count_reads_per_interval(aln, intervals)
    total, rows = counted.agg(F.sum("count"), F.count("*")).first()
    begun = Counter(i % 16_000 for i in range(20_000))
    up_to, so_far = [], 0
    for p in range(16_000):
        so_far += begun[p]
        up_to.append(so_far)
    assert rows == n and total == sum(up_to[i % 16_000] for i in range(n))


@pytest.mark.parametrize("k", [3, 21, 32, 35])
def test_runs_meet_words_as_each_word_would(monkeypatch, k):
    """Hits per pair and taxon equal those of looking every word up; lengths come out once; dealt and looked up a few at a time."""
    monkeypatch.setattr(pk, "DEAL", 300)
    monkeypatch.setattr(pk, "MEET", 40)
    monkeypatch.setattr(pk, "BINS", 8)
    rng = random.Random(k)
    text = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    genome = text(400) + "A" * 80
    reads = [(rng.choice(["s1", "s2", None]), rng.choice([None, *range(30)]), genome[i : i + 60]) for i in rng.sample(range(420), 90)]
    reads += [("s1", 1, "acgt" * 9), ("s1", 2, "N" * 50), ("s2", 3, "AC"), ("s2", 3, ""), ("s1", 4, genome[:30] + "N" + genome[31:70])]
    reads += [("s2", 5, None)] + [("s1", i, "A" * 70) for i in range(20)]
    known = [genome[i : i + k] for i in rng.sample(range(len(genome) - k), 150)]
    known += known[:9] + ["A" * k]
    taxa = [rng.randrange(1, 6) for _ in known]
    values = pk.word_values(pa.array(known), k, True)
    words = pa.RecordBatch.from_arrays([values, pa.array(taxa), pa.array(taxa), pa.array(taxa, pa.int32())], ["word", "enter", "leave", "tax_id"])
    rows = pa.table({"sample": pa.array([r[0] for r in reads]), "owner": pa.array([r[1] for r in reads], pa.int64()), "length": pa.array([len(r[2] or "") for r in reads]), "bases": pa.array([r[2] for r in reads])})
    left = pa.Table.from_batches(list(pk.word_bins(k, min(9, k))(iter([words.slice(0, 70), words.slice(70)]))))
    right = pa.Table.from_batches(list(pk.run_bins(k, min(9, k))(iter(rows.to_batches(max_chunksize=50)))))
    dealt = pa.concat_tables([left.append_column("side", pa.array([0] * left.num_rows)), right.append_column("side", pa.array([1] * right.num_rows))], promote_options="default")
    dealt = dealt.sort_by([("bin", "ascending"), ("side", "ascending")]).combine_chunks()
    met = pa.Table.from_batches(list(pk.meet_words(k, ["enter", "leave", "tax_id"])(iter(dealt.to_batches(max_chunksize=7))))).to_pylist()
    by_word: dict = {}
    for word, taxon in zip(values.to_pylist(), taxa, strict=True):
        by_word.setdefault(str(word), []).append(taxon)
    want, got, lengths, told = {}, {}, {}, {}
    for sample, owner, seq in reads:
        lengths[sample, owner] = lengths.get((sample, owner), 0) + len(seq or "")
        for word in pk.word_lists(pa.array([seq]), k, True).values.to_pylist():
            for taxon in by_word.get(str(word), []) if word is not None else []:
                want[sample, owner, taxon] = want.get((sample, owner, taxon), 0) + 1
    for r in met:
        if r["length"] is None:
            assert r["enter"] == r["leave"] == r["tax_id"] and r["hits"] > 0
            got[r["sample"], r["owner"], r["tax_id"]] = got.get((r["sample"], r["owner"], r["tax_id"]), 0) + r["hits"]
        else:
            assert r["enter"] is None and r["hits"] is None
            told[r["sample"], r["owner"]] = told.get((r["sample"], r["owner"]), 0) + r["length"]
    assert got == want and len(want) > 50 and told == lengths and sum(r["length"] is not None for r in met) == len(reads)
    assert all(max(b) <= 300 + 50 * 60 for b in [right.column("size").combine_chunks().value_lengths().to_pylist()])


def test_reads_are_classified_without_a_row_per_word(spark):
    """No k-mer is a row of the shuffle, and k-mers of the table are packed once, after what made them."""
    db = spark.createDataFrame([("ACGTACGTA", 1)], "kmer string, tax_id int").groupBy("kmer").agg(F.min("tax_id").alias("tax_id"))
    plan = tx.packed_kmer_db(db, tree(spark), 9)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("PythonUDF") == 0 and plan.count("MapInArrow") == 1
    reads = spark.createDataFrame([("a", 1, 1, "ACGTACGTAC")], "sample string, pair_id long, mate int, seq string")
    called = tx.classify_reads(reads, db, tree(spark), 9)
    assert "bases" in (plan := called._jdf.queryExecution().optimizedPlan().toString()) and "posexplode(words" not in plan
    assert [(r.status, r.length) for r in called.collect()] == [("C", 10)]


def test_hit_strings_shuffle_runs_and_not_words(spark):
    rng = random.Random(12)
    seq = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    k, long = 21, [seq(5000) for _ in range(40)]
    # Found over a piece's border; twice as two strands, of which the smaller taxon counts; ambiguous, short and missing sequences.
    long[0] = long[0][:2000] + "n" + long[0][2001:]
    back = long[1][70:91].translate(str.maketrans("ACGT", "TGCA"))[::-1]
    kmers = [(long[0][i : i + k], 7) for i in range(1015, 1035)] + [(long[1][70:91], 9), (back, 8), (long[1][71:92].lower(), 8), (long[2][:k], None)]
    kmers += [(seq(k), 5) for _ in range(500)]
    rows = [("x", i, 1, s) for i, s in enumerate(long)] + [(None, None, 2, long[1][60:100]), ("x", 1, 1, long[1]), ("y", 1, 1, seq(20)), ("y", 2, 1, None)]
    reads = spark.createDataFrame(rows, READS)
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = tx.kmer_hit_string(reads, spark.createDataFrame(kmers, "kmer string, tax_id int"), k)
        got = [tuple(r) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    want = [("x", 0, 1, "0:1015 7:20 0:945 A:21 0:2979"), ("x", 1, 1, "0:70 8:2 0:4908"), (None, None, 2, "0:10 8:2 0:8")]
    want += [("x", i, 1, "0:4980") for i in range(2, 40)]
    assert sorted(got, key=str) == sorted(want, key=str)

    def rows_shuffled(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return rows_shuffled(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return rows_shuffled(node.plan())
        children = node.children()
        own = node.metrics().apply("shuffleRecordsWritten").value() if node.nodeName() == "Exchange" else 0
        return own + sum(rows_shuffled(children.apply(i)) for i in range(children.size()))

    words = sum(len(s) - k + 1 for s in long)
    assert 0 < rows_shuffled(found._jdf.queryExecution().executedPlan()) < words / 4


def test_lists_of_runs_in_one_bin_are_cut():
    reads = ["A" * 1100] * 700 + ["ACGTTGCATGCCATAGCATTACGGATA", None, "NNN"]
    whole = {"sample": ["x"] * len(reads), "pair_id": list(range(len(reads))), "mate": [1] * len(reads), "piece": [2] * len(reads), "bases": [s and s.encode() for s in reads]}
    out = pa.Table.from_batches(list(pk.run_places(21, 9)([pa.RecordBatch.from_pydict(whole)]))).to_pylist()
    assert all(sum(r["size"]) < pk.LIST + 1100 and len(set(map(len, (r[c] for c in ("pair_id", "mate", "start", "size"))))) == 1 for r in out)
    assert sum(len(r["pair_id"]) for r in out if set(r["size"]) == {1100}) == 700 and len(out) > 2
    found = {(i, at + n) for r in out for i, s, z in zip(r["pair_id"], r["start"], r["size"], strict=True) for at in [s - 2 * pk.PIECE] for n in range(z - 20)}
    assert found == {(i, n) for i, s in enumerate(reads) if s and "N" not in s for n in range(len(s) - 20)}
