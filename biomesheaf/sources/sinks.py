"""Writers and stage materialisation."""

import json

from pyspark.sql import functions as F


def write_table(df, path, fmt="parquet", mode="errorifexists", by=("sample",)):
    """Write a table partitioned by sample (``by=()`` for none).

    Rows are rebalanced by sample first: a file is as large as Spark's advisory partition size, a
    large sample has several files and no task writes to all samples.
    """
    if by:
        df = df.hint("rebalance", *by)
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def _record(mark):
    return F.concat_ws("\n", F.concat(F.lit("@"), F.col("pair_id"), mark), "seq", F.lit("+"), "qual")


def write_fastq(reads, path, layout="interleaved", compression="none", mode="errorifexists", pairs_per_file=5_000_000):
    """Write FASTQ text, one ``sample=...`` folder per sample.

    ``interleaved`` keeps mates adjacent: a pair becomes one text value of two records, so no
    file border can part it. ``split`` writes the pairs that have both mates below ``<path>/R1`` and
    ``<path>/R2``, in the same order and files of about ``pairs_per_file`` pairs.
    """
    mark = F.concat(F.lit("/"), F.col("mate").cast("string"))
    if layout == "interleaved":
        pairs = (
            reads.groupBy("sample", "pair_id")
            .agg(F.array_sort(F.collect_list(F.struct("mate", _record(mark).alias("text")))).alias("mates"))
            .select("sample", F.array_join(F.transform("mates", lambda m: m["text"]), "\n").alias("value"))
        )
        pairs.write.mode(mode).option("compression", compression).partitionBy("sample").text(path)
        return
    if layout != "split":
        raise ValueError(f"unknown layout: {layout}")
    # One row per whole pair gives both files, so they stay in step; orphans are left out.
    pairs = reads.groupBy("sample", "pair_id").agg(F.array_sort(F.collect_list(F.struct("mate", "seq", "qual"))).alias("mates"))
    whole = pairs.filter(F.transform("mates", lambda m: m["mate"]) == F.array(F.lit(1), F.lit(2)))
    sizes = whole.groupBy("sample").agg(F.ceil(F.count(F.lit(1)) / pairs_per_file).cast("int").alias("files"))
    dealt = whole.join(sizes, "sample").withColumn("_part", F.pmod(F.xxhash64("pair_id"), F.col("files")))
    dealt = dealt.repartition("sample", "_part").sortWithinPartitions("sample", "_part", "pair_id")
    for mate in (1, 2):
        one = dealt.select("sample", "pair_id", F.lit(mate).alias("mate"), F.get("mates", F.lit(mate - 1)).alias("m"))
        one = one.select("sample", "pair_id", "mate", "m.seq", "m.qual").select("sample", _record(mark).alias("value"))
        one.write.mode(mode).option("compression", compression).partitionBy("sample").text(f"{path}/R{mate}")


def input_state(spark, paths):
    """What tells one state of some input files or folders from another: their number, bytes and a digest
    of names, lengths and times. Spark lists the files; nothing is read of their content.
    """
    state = {}
    for path in sorted(paths):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        row = listed.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.sum(mark).alias("digest")).first()
        state[path] = [row.files, row.bytes or 0, str(row.digest)]
    return state


def stage_fingerprint(spark, inputs=(), parameters=None):
    """Canonical JSON of the state of a stage's inputs and of its parameters."""
    return json.dumps({"inputs": input_state(spark, inputs), "parameters": parameters or {}}, sort_keys=True)


def materialize_if_absent(spark, build, path, inputs=(), parameters=None):
    """Write ``build()`` to the path unless a finished, current table is there, then read it back.

    A stage counts as finished by its ``_SUCCESS`` file; a half-written folder is rebuilt. With
    ``inputs`` (paths of files, folders or globs) or ``parameters`` (values JSON can hold) a stage is also
    rebuilt when any of them differs from what it was made of, which is stored beside ``_SUCCESS`` as
    ``_made_from.json``; a stage without that file counts as outdated then. A stage that reads another
    one's path as input is outdated as soon as that one is rebuilt. Without both, any finished table is kept.
    """
    jvm = spark.sparkContext._jvm
    names = jvm.org.apache.hadoop.fs.Path
    system = names(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    record = names(path, "_made_from.json")
    made_from = stage_fingerprint(spark, inputs, parameters) if inputs or parameters else None
    current = system.exists(names(path, "_SUCCESS"))
    if current and made_from is not None:
        current = system.exists(record)
        if current:
            stream = system.open(record)
            try:
                current = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") == made_from
            finally:
                stream.close()
    if not current:
        build().write.mode("overwrite").parquet(path)
        if made_from is not None:
            # Written last: a run that ends before it leaves a stage that is built again.
            stream = system.create(record, True)
            try:
                stream.write(bytearray(made_from.encode("utf-8")))
            finally:
                stream.close()
    return spark.read.parquet(path)
