"""A cross-section of the registered queries against DuckDB; ``checks.compare`` runs them all."""

import pytest

from checks import catalog
from checks.compare import DATA, compare, duck

FOLDER = f"{DATA}/sf0.001"
NAMES = (
    "coverage_histogram", "remove_duplicates", "count_reads_in_windows", "assembly_stats", "sketch_top_hits",
    "intersect_targets_join", "missing_enzymes", "found_ids", "keyword_feature_table", "pathway_feature_table",
    "pathway_features_from_alignments", "feature_rarefaction", "trim_and_filter", "kmer_screen",
    "toss_low_depth_reads", "merge_overlapping_pairs", "classify_reads", "kmer_hit_string", "taxonomy_report",
    "classification_summary", "resistome_rarefaction", "snp_haplotypes", "read_fastq_interleaved", "read_tax_report",
)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, name):
    status, rows, _, note = compare(spark, duck(FOLDER), FOLDER, name)
    assert status == "ok", note
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
