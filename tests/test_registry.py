"""Driver contract: every inventory key is registered, has an oracle unless
it is a rows-only operator, and the entry smoke query has a stable schema."""

import re

import __spark_entry__ as E

INVENTORY = """
allele_frequency carrier_frequency_top carrier_frequency_all carrier_lookup carrier_lookup_plain
gene_burden gene_burden_plain gene_burden_brca1 omop_phenotype_join omop_join_plain site_depth
locus_calls sample_call_counts calls_with_demographics browse_variants browse_person
browse_conditions browse_search ingest_summary validate_cohort site_alt_frequency layout_parity
vcf_to_calls vcf_gz_to_calls vcf_samples parquet_roundtrip jsonl_roundtrip person_scan condition_scan
partition_counts scan_contig feed_append vds_variant_data vds_reference_data vds_counts
vds_to_calls partition_stats researcher_view steward_view researcher_masked
published_frequencies scan_cost bench_summary bench_ranking bench_scaling n1_counts
n1_incremental synthetic_calls synthetic_person synthetic_conditions calls_to_vcf
compacted_equal feed_stream replay_equal append_after_compact
allele_frequency_vds gene_burden_vds omop_join_vds
gwas_linear gwas_logistic ld_pairs ld_pruned genotype_pca polygenic_scores polygenic_scores_vds
carrier_frequency_states trial_matches allele_fraction_track allele_fraction_stream tier_lookup packed_equal clustered_equal
validate_expected synthetic_pinned browse_refilter result_bundle file_stats lookup_by_stats n1_files
""".split()
# Newton steps, a greedy walk and a decomposition: tested against plain numpy instead.
ROWS_ONLY: set = {"gwas_logistic", "ld_pruned", "genotype_pca"}


def _library(entries):
    """Without the queries of the optional training-data subpackage."""
    return {k: v for k, v in entries.items() if k != "pipeline" and not re.match(r"op\d+_", k)}


def test_inventory_registered():
    q, o = _library(E.queries()), _library(E.oracle_sql())
    assert set(INVENTORY) <= set(q)
    assert set(q) - set(o) == ROWS_ONLY
    assert set(o) <= set(q)


def test_oracle_sql_is_self_contained():
    for name, sql in _library(E.oracle_sql()).items():
        assert sql.lstrip().upper().startswith(("WITH", "SELECT")), name
        assert "LIMIT" not in sql.upper() or name in {
            "carrier_frequency_top", "site_depth_preview", "sample_call_counts",
            "browse_variants", "browse_variants_sample", "browse_person", "browse_conditions",
            "browse_search", "browse_refilter"}, name
