"""Explicit schemas of the text formats and of the tables built from them."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

READS = _struct(
    ("sample", _S), ("pair_id", _S), ("mate", _I), ("seq", _S), ("qual", _S)
)

SEQUENCES = _struct(("ref_id", _S), ("description", _S), ("seq", _S), ("length", _L))

COVERAGE_HIST = _struct(
    ("cds", _S), ("depth", _L), ("num_bases", _L), ("cds_size", _L), ("frac", _D)
)

# The column order of the orthology annotation file.
ANNOTATIONS = _struct(
    ("cds", _S),
    ("seed_orth", _S),
    ("evalue", _D),
    ("score", _D),
    ("tax_group", _S),
    ("protein_name", _S),
    ("gene_ontology", _S),
    ("ec", _S),
    ("kegg_ko", _S),
    ("kegg_pwy", _S),
    ("kegg_module", _S),
    ("kegg_rxn", _S),
    ("kegg_rclass", _S),
    ("brite", _S),
    ("kegg_tc", _S),
    ("cazy", _S),
    ("bigg_rxn", _S),
    ("tax_scope", _S),
    ("ogs", _S),
    ("best_og", _S),
    ("cog_category", _S),
    ("description", _S),
)

TAX_REPORT = _struct(
    ("pct", _D), ("clade_reads", _L), ("direct_reads", _L), ("rank", _S), ("tax_id", _L), ("name", _S)
)

READ_CLASS = _struct(
    ("status", _S), ("read_id", _S), ("taxon", _S), ("length", _S), ("kmer_hits", _S)
)
