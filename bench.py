"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. Every query is run to its full
result by a no-op write.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from biomesheaf.session import cohort_session  # noqa: E402
from checks import catalog  # noqa: E402

HEADLINE = (
    "pathway_features_from_alignments",
    "pathway_feature_table",
    "keyword_feature_table",
    "missing_enzymes",
    "feature_rarefaction",
    "coverage_histogram",
    "count_reads_per_interval",
    "remove_duplicates",
    "gene_abundance",
    "assembly_stats",
    "sketch_top_hits",
    "trim_and_filter",
    "kmer_screen",
    "toss_low_depth_reads",
    "merge_overlapping_pairs",
    "read_qc_summary",
    "read_qc_position_quality",
    "classify_reads",
    "kmer_hit_string",
    "taxonomy_report",
    "classification_summary",
    "taxonomy_summary",
    "track_reads",
    "resistome_levels",
    "resistome_rarefaction",
    "snp_haplotypes",
)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = cohort_session("bench", f"local[{cpus}]", shuffle_partitions=max(int(cpus), 1), driver_memory="16g", scratch=tempfile.mkdtemp(prefix="scratch-"))
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run = lambda name: catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    run(names[0])
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
