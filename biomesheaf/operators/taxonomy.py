"""Taxonomy: k-mer classification, reports and per-sample summaries.

A taxonomy row is (tax_id, parent_id, rank, name); the root's parent is 0.
"""

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import packed as pk
from ..functions import sequences as sq
from ..functions.joins import settled

UNCLASSIFIED = 0
# Reads whose taxon is not in the tree are counted on a line of this id and name.
UNPLACED, UNPLACED_NAME = -1, "unplaced"
ROW_GUARD = "spark.sql.cteRecursionRowLimit"
#: Bases of the minimizers by which reads meet the k-mer table.
MINIMIZER = 9


def lineages(taxonomy):
    """The tree, each taxon with its path from the root and its numbers on a walk around the tree.

    Columns tax_id, rank, name, path and names (from the root down), enter and leave: the walk numbers
    taxa from 1 as it enters them, siblings by tax_id, and ``leave`` is the last number below the taxon.
    So u is an ancestor of t, or t itself, if u.enter <= t.enter <= u.leave, and taxa in order of enter
    are in pre-order. ``enters`` and ``leaves`` are these numbers along the path.

    Paths come from a recursive query, numbers from the sizes of subtrees: a taxon is entered after
    its ancestors and the whole subtrees of their and its earlier siblings. The work grows with the
    taxonomy, not with the reads. The result is stored, so plans that use it read a table; a table that
    has paths already is returned as it is. Spark's guard on the rows of a recursion is lifted for this
    query only: published taxonomies have over a million nodes.
    """
    if "leaves" in taxonomy.columns:
        return taxonomy
    spark = taxonomy.sparkSession
    guard = spark.conf.get(ROW_GUARD)
    spark.conf.set(ROW_GUARD, "-1")
    try:
        walked = settled(
            spark.sql(
                """
                with recursive walk(tax_id, rank, name, path, names) max recursion level 2147483647 as (
                  select tax_id, rank, name, array(tax_id), array(name) from {tax} where parent_id = 0
                  union all
                  select t.tax_id, t.rank, t.name, concat(w.path, array(t.tax_id)), concat(w.names, array(t.name))
                  from walk w join {tax} t on t.parent_id = w.tax_id)
                select * from walk
                """,
                tax=taxonomy.select("tax_id", "parent_id", "rank", "name"),
            ),
            "walk",
        )
    finally:
        spark.conf.set(ROW_GUARD, guard)
    above = walked.select("tax_id", F.posexplode("path").alias("at", "over"))
    sizes = above.groupBy(F.col("over").alias("tax_id")).agg(F.count(F.lit(1)).alias("size"))
    siblings = Window.partitionBy("parent").orderBy("tax_id").rowsBetween(Window.unboundedPreceding, -1)
    steps = (
        walked.select("tax_id", F.get("path", F.size("path") - 2).alias("parent"))
        .join(sizes, "tax_id")
        .select(F.col("tax_id").alias("over"), "size", (F.coalesce(F.sum("size").over(siblings), F.lit(0)) + 1).alias("step"))
    )
    numbers = (
        above.join(steps, "over")
        .groupBy("tax_id")
        .agg(F.array_sort(F.collect_list(F.struct("at", "step", "size"))).alias("way"))
        # Numbers of each taxon on the path, from the root down.
        .select("tax_id", "way", F.transform(F.sequence(F.lit(1), F.size("way")), lambda i: F.aggregate(F.slice("way", F.lit(1), i), F.lit(0).cast("bigint"), lambda acc, w: acc + w["step"])).alias("enters"))
        .select("tax_id", "enters", F.zip_with("enters", "way", lambda e, w: e + w["size"] - 1).alias("leaves"))
        .select("tax_id", F.element_at("enters", -1).alias("enter"), F.element_at("leaves", -1).alias("leave"), "enters", "leaves")
    )
    return settled(walked.join(numbers, "tax_id"), "lineages")


def _in_tree(df, tree):
    """Adds enter and leave by tax_id. A taxon outside the tree is its own root: it gets a number below 0 of its own."""
    own = -F.col("tax_id").cast("bigint") - 1
    known = df.join(tree.select("tax_id", "enter", "leave"), "tax_id", "left")
    return known.withColumns({"enter": F.coalesce("enter", own), "leave": F.coalesce("leave", own)})


def _common(df, tree, keys):
    """Puts the LCA of some taxa in place of ``low`` and ``high``, the first and last of their numbers.

    The LCA is the deepest taxon on the first one's path that is left only after the last one is
    entered. Rows with one taxon bring its tax_id and leave. Only the others meet the tree; the rest look
    for a key of their own that no taxon has, so that they are not brought together.
    """
    one, apart = F.col("low") == F.col("high"), (F.col("low") != F.col("high")) & (F.col("low") > 0)
    none = -F.abs(F.xxhash64(*keys) % (1 << 40)) - 1
    way = tree.select(F.col("enter").alias("_first"), F.col("path").alias("_path"), F.col("enters").alias("_enters"), F.col("leaves").alias("_leaves"))
    met = df.withColumn("_first", F.when(apart, F.col("low")).otherwise(none)).join(way, "_first", "left")
    depth = F.size(F.filter("_leaves", lambda x: x >= F.col("high")))
    of = lambda path: F.get(path, depth - 1)
    return met.select(
        *keys,
        *[c for c in df.columns if c not in (*keys, "low", "high", "tax_id", "leave")],
        F.coalesce(F.when(one, F.col("tax_id")).otherwise(of("_path")), F.lit(UNCLASSIFIED)).alias("tax_id"),
        F.coalesce(F.when(one, F.col("low")).otherwise(of("_enters")), F.lit(-1)).alias("enter"),
        F.coalesce(F.when(one, F.col("leave")).otherwise(of("_leaves")), F.lit(-1)).alias("leave"),
    )


def _words_by_lca(placed, tree, key):
    """One row per ``key`` with the LCA of its taxa, from rows with enter and leave."""
    ends = placed.groupBy(key).agg(F.min("enter").alias("low"), F.max("enter").alias("high"), F.max("tax_id").alias("tax_id"), F.max("leave").alias("leave"))
    return _common(ends, tree, [key])


def canonical_kmer_db(kmer_db, taxonomy):
    """(kmer -> tax_id) with canonical k-mers; strands naming different taxa get their LCA.

    A taxon outside the tree is its own root; k-mers of taxa without a common root get taxon 0.
    """
    tree = lineages(taxonomy)
    words = kmer_db.select(sq.canonical(F.upper("kmer")).alias("kmer"), "tax_id")
    return _words_by_lca(_in_tree(words, tree), tree, "kmer").select("kmer", "tax_id")


def packed_kmer_db(kmer_db, taxonomy, k):
    """(word, tax_id, enter, leave): the k-mer table as reads are looked up in it.

    Words are packed and canonical, of taxa that share one the LCA counts, and every word knows its
    taxon's place in the tree, so that no read has to ask the tree for it. Takes (kmer, tax_id) with text.
    """
    tree = lineages(taxonomy)
    # Not an expression: Spark would move a filter on it below whatever made the table, and pack all k-mers twice.
    kind = kmer_db.schema["tax_id"].dataType.simpleString()
    words = kmer_db.select("kmer", "tax_id").mapInArrow(pk.packed_rows(k, "kmer"), f"word {pk.word_type(k)}, tax_id {kind}")
    return _words_by_lca(_in_tree(words, tree), tree, "word")


def _ends(numbers):
    return F.coalesce(F.array_min(numbers), F.lit(0)).alias("low"), F.coalesce(F.array_max(numbers), F.lit(0)).alias("high")


def _as_packed(kmer_db, tree, k):
    """A table of text k-mers packed for this query; a packed one is used as it is."""
    if "enter" in kmer_db.columns:
        return kmer_db
    return settled(packed_kmer_db(kmer_db, tree, k), "kmer-db")


def _dealt(runs, words):
    """Runs and words dealt by bin and sorted, the words of a bin first."""
    dealt = runs.withColumn("side", F.lit(1)).unionByName(words.withColumn("side", F.lit(0)), allowMissingColumns=True)
    return dealt.repartition("bin").sortWithinPartitions("bin", "side")


def classify_reads(reads, kmer_db, taxonomy, k):
    """Classify each pair by the k-mers of both mates; ``kmer_db`` is a ``packed_kmer_db`` or maps text k-mers.

    A taxon scores the hits on its root path; the best taxon wins, equal ones give way to
    their lowest common ancestor, pairs without a hit get taxon 0 and status ``U``.

    Reads are read once. Their runs of k-mers with one minimizer travel as packed bases, in lists by bin of
    minimizers and sample, to where the table's words of the bin are, which are dealt alike; only hits, and the
    length of each mate, go on. Hits are counted per pair and taxon, then a pair is decided on a handful of rows
    by the numbers of their taxa.
    """
    tree = lineages(taxonomy)
    db = _as_packed(kmer_db, tree, k)
    pair = ["sample", "pair_id"]
    sample, owner = (reads.schema[c].dataType.simpleString() for c in pair)
    place = ["enter", "leave", "tax_id"]
    kinds = {c: db.schema[c].dataType.simpleString() for c in place}
    length = F.coalesce(F.length("seq"), F.lit(0)).cast("bigint").alias("length")
    cut = pk.pieces(reads, k, "sample", F.col("pair_id").alias("owner"), length).withColumn("length", F.when(F.col("piece") == 0, F.col("length"))).drop("piece")
    m = min(MINIMIZER, k)
    runs = cut.mapInArrow(pk.run_bins(k, m), f"bin int, sample {sample}, owner array<{owner}>, length array<bigint>, size array<int>, bases binary")
    known = db.filter((F.col("enter") > 0) & F.col("word").isNotNull()).select("word", *place)
    words = known.mapInArrow(pk.word_bins(k, m), ", ".join(["bin int", f"word array<{pk.word_type(k)}>", *[f"{c} array<{t}>" for c, t in kinds.items()]]))
    met = _dealt(runs, words).mapInArrow(
        pk.meet_words(k, place), ", ".join([f"sample {sample}", f"owner {owner}", *[f"{c} {t}" for c, t in kinds.items()], "hits bigint", "length bigint"])
    )
    # Dealt by pair once, for both aggregations.
    counted = met.withColumnRenamed("owner", "pair_id").repartition(*pair).groupBy(*pair, *place).agg(F.sum("hits").alias("hits"), F.sum("length").alias("length"))
    entry = F.struct("enter", "leave", "tax_id", "hits")
    pairs = counted.groupBy(*pair).agg(F.collect_list(F.when(F.col("enter").isNotNull(), entry)).alias("taxa"), F.sum("length").alias("length"))

    def score(t):
        above = F.filter("taxa", lambda u: (u["enter"] <= t["enter"]) & (t["enter"] <= u["leave"]))
        return F.aggregate(above, F.lit(0).cast("bigint"), lambda acc, u: acc + u["hits"])

    scored = pairs.withColumn("scored", F.transform("taxa", lambda t: F.struct(score(t).alias("score"), t["enter"].alias("enter"), t["tax_id"].alias("tax_id"))))
    best = scored.withColumn("top", F.array_max(F.transform("scored", lambda s: s["score"])))
    winners = F.filter("scored", lambda s: s["score"] == F.col("top"))
    status = F.when(F.size("taxa") > 0, "C").otherwise("U").alias("status")
    ends = best.withColumn("winners", winners).select(*pair, "length", status, *_ends(F.col("winners.enter")), F.get("winners.tax_id", 0).alias("tax_id"), F.lit(0).alias("leave"))
    return _common(ends, tree, pair).select("sample", "status", F.col("pair_id").alias("read_id"), "tax_id", "length")


def kmer_hit_string(reads, kmer_db, k):
    """Run-length list ``taxon:count`` of a read's k-mers in order.

    ``A`` stands for k-mers with an ambiguous base, ``0`` for k-mers not in the table. Reads go to the table's words as
    in ``classify_reads``, as runs of packed bases that know their place; only stretches of k-mers found travel on.
    They meet the read's length, and its bases if some are ambiguous, so the rest takes time in proportion to the read.
    """
    read = ["sample", "pair_id", "mate"]
    db = kmer_db if "word" in kmer_db.columns else settled(kmer_db.select(pk.packed("kmer", k, canonical=True).alias("word"), "tax_id").filter("word is not null"), "kmer-db")
    sample, pair, mate = (reads.schema[c].dataType.simpleString() for c in read)
    m = min(MINIMIZER, k)
    runs = pk.pieces(reads, k, *read).mapInArrow(
        pk.run_places(k, m), f"bin int, sample {sample}, pair_id array<{pair}>, mate array<{mate}>, start array<int>, size array<smallint>, bases binary"
    )
    known = db.select("word", F.col("tax_id").cast("bigint").alias("taxon")).filter("word is not null and taxon is not null")
    words = known.mapInArrow(pk.word_bins(k, m), f"bin int, word array<{pk.word_type(k)}>, taxon array<bigint>")
    found = _dealt(runs, words).mapInArrow(pk.meet_places(k), f"sample {sample}, pair_id {pair}, mate {mate}, pos int, taxon bigint, n int")
    # A read is a row without a place, its length in ``n``.
    whole = reads.filter(F.col("seq").isNotNull()).select(*read, F.length("seq").alias("n"), F.when(F.col("seq").rlike("[^ACGTacgt]"), F.col("seq")).alias("seq"))
    hit = F.col("pos").isNotNull()
    gathered = (
        found.unionByName(whole, allowMissingColumns=True)
        .repartition(*read)
        .groupBy(*read)
        .agg(F.collect_list(F.when(hit, F.struct("pos", "taxon", "n"))).alias("hits"), F.max(F.when(~hit, F.col("n"))).alias("length"), F.max("seq").alias("seq"))
        .filter(F.col("length") >= k)
    )

    @F.arrow_udf("string")
    def labels(seq: pa.Array, places: pa.Array, taxa: pa.Array, many: pa.Array, length: pa.Array) -> pa.Array:
        return pk.hit_runs(seq, places, taxa, k, many, length)

    return gathered.select(*read, labels("seq", F.col("hits.pos"), F.col("hits.taxon"), F.col("hits.n"), "length").alias("kmer_hits"))


# ---------------------------------------------------------------- reports and labels


def taxonomy_report(read_class, taxonomy):
    """Clade and direct read counts per taxon in pre-order, with the unclassified row.

    Reads of a taxon that is not in the tree are counted in the row ``unplaced``, so the rows of rank
    U and the root add up to all reads.
    Reads are counted per sample and taxon before the tree is looked at, and the lines of a report
    are put in order by the number at which the walk enters their taxa.
    """
    # Stored: several branches go on from these counts, and each would classify the reads again.
    direct = settled(read_class.groupBy("sample", "tax_id").agg(F.count(F.lit(1)).alias("n")), "direct")
    tree = lineages(taxonomy)
    known = direct.join(tree.select("tax_id", "path"), "tax_id", "left")
    placed = known.filter(F.col("path").isNotNull())
    outside = known.filter(F.col("path").isNull() & (F.col("tax_id") != UNCLASSIFIED)).groupBy("sample").agg(F.sum("n").alias("n"))
    clades = (
        placed.select("sample", "n", F.col("tax_id").alias("own"), F.explode("path").alias("tax_id"))
        .groupBy("sample", "tax_id")
        .agg(
            F.sum("n").alias("clade_reads"),
            F.sum(F.when(F.col("own") == F.col("tax_id"), F.col("n")).otherwise(0)).alias("direct_reads"),
        )
        .join(tree.select("tax_id", "rank", "name", "enter"), "tax_id")
    )
    unknown = direct.filter(F.col("tax_id") == UNCLASSIFIED).select(
        "tax_id",
        "sample",
        F.col("n").alias("clade_reads"),
        F.col("n").alias("direct_reads"),
        F.lit("U").alias("rank"),
        F.lit("unclassified").alias("name"),
        F.lit(-1).cast("bigint").alias("enter"),
    )
    unplaced = outside.select(
        F.lit(UNPLACED).cast("bigint").alias("tax_id"),
        "sample",
        F.col("n").alias("clade_reads"),
        F.col("n").alias("direct_reads"),
        F.lit("U").alias("rank"),
        F.lit(UNPLACED_NAME).alias("name"),
        F.lit(0).cast("bigint").alias("enter"),
    )
    totals = direct.groupBy("sample").agg(F.sum("n").alias("total"))
    in_order = Window.partitionBy("sample").orderBy("enter")
    return (
        clades.unionByName(unknown)
        .unionByName(unplaced)
        .join(totals, "sample")
        .select(
            "sample",
            # At most one row per taxon and sample, whatever the number of reads.
            F.row_number().over(in_order).cast("bigint").alias("line_no"),
            (F.lit(100.0) * F.col("clade_reads") / F.col("total")).alias("pct"),
            "clade_reads",
            "direct_reads",
            "rank",
            "tax_id",
            "name",
        )
    )


def classified_labels(read_class):
    return read_class.filter(F.col("status") == "C").drop("status")


def translate_lineage(read_class, taxonomy, sep="|"):
    """Full taxonomic name of each classified read: (sample, read_id, taxonomy)."""
    names = lineages(taxonomy).select("tax_id", F.concat_ws(sep, "names").alias("taxonomy"))
    labels = classified_labels(read_class).join(names, "tax_id", "left")
    return labels.select("sample", "read_id", F.coalesce("taxonomy", F.lit(UNPLACED_NAME)).alias("taxonomy"))


# ---------------------------------------------------------------- summaries

# The domains counted and their output columns.
DOMAINS = {
    "bacteria_reads": "Bacteria",
    "eukaryota_reads": "Eukaryota",
    "archaea_reads": "Archaea",
    "virus_reads": "Viruses",
}


def domain_read_counts(tax_report):
    """Clade reads of each domain per sample; null when the domain is absent."""
    def reads_of(name):
        wanted = (F.col("rank") == "D") & (F.col("name") == name)
        return F.min(F.when(wanted, F.struct("line_no", "clade_reads")))["clade_reads"]

    return tax_report.groupBy("sample").agg(
        *[reads_of(name).alias(column) for column, name in DOMAINS.items()]
    )


def bacterial_species_richness(tax_report):
    """Distinct species from the Bacteria row up to the next domain row of the report."""
    domain_lines = tax_report.filter(F.col("rank") == "D")
    # A report has a handful of domain rows; their lines are gathered per sample.
    bounds = (
        domain_lines.groupBy("sample")
        .agg(
            F.min(F.when(F.col("name") == "Bacteria", F.col("line_no"))).alias("first_line"),
            F.collect_list("line_no").alias("lines"),
        )
        .select(
            "sample",
            "first_line",
            F.array_min(F.filter("lines", lambda n: n > F.col("first_line"))).alias("next_line"),
        )
    )
    inside = (
        (F.col("rank") == "S")
        & (F.col("line_no") > F.col("first_line"))
        & (F.col("next_line").isNull() | (F.col("line_no") < F.col("next_line")))
    )
    return (
        tax_report.join(bounds, "sample", "left")
        .groupBy("sample")
        .agg(F.count_distinct(F.when(inside, F.col("tax_id"))).alias("bacterial_species"))
    )


def classification_summary(tax_report, track_reads):
    """Domain counts and richness joined to the read pairs of each sample."""
    pairs = track_reads.select(
        "sample",
        (F.col("input") / 2).alias("input_pairs"),
        (F.col("qtrimmed") / 2).alias("qtrimmed_pairs"),
    )
    return (
        domain_read_counts(tax_report)
        .join(bacterial_species_richness(tax_report), "sample")
        .join(pairs, "sample", "left")
        .withColumn(
            "percent_bacteria",
            F.try_divide(F.col("bacteria_reads"), F.col("qtrimmed_pairs")) * 100,
        )
    )


def label_richness(labels, track_reads):
    """Labelled reads and distinct taxonomies per tracked sample; percent of all input reads.

    Samples without trimmed reads, or without labels, count zero.
    """
    counted = labels.groupBy("sample").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("taxonomy").alias("kinds")
    )
    usable = (F.col("qtrimmed") > 0) & F.col("n").isNotNull()
    return (
        track_reads.select("sample", "input", "qtrimmed")
        .join(counted, "sample", "left")
        .select(
            "sample",
            F.when(usable, F.col("n")).otherwise(0).alias("labelled_reads"),
            F.when(usable, F.col("kinds")).otherwise(0).alias("richness"),
            F.col("input").alias("input_reads"),
            F.col("qtrimmed").alias("qtrimmed_reads"),
        )
        .withColumn(
            "percent_labelled",
            F.try_divide(F.col("labelled_reads"), F.col("input_reads")) * 100,
        )
    )


def classified_read_counts(labels):
    return labels.groupBy("sample").agg(F.count(F.lit(1)).alias("reads_classified"))
