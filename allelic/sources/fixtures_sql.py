"""The fixture derivation as SQL text (DuckDB dialect, ANSI where possible).

``with_views(body, ...)`` prefixes a query body with the CTEs it needs, so an
oracle string is self-contained over the raw driver tables.
"""

from __future__ import annotations

_CTES: dict[str, str] = {}

_CTES["sites"] = """
sites AS (
  SELECT p_partkey AS site_key,
         'chr' || CAST(p_partkey % 22 + 1 AS VARCHAR) AS reference_name,
         CAST(1000000 + p_partkey * 137 AS BIGINT) AS start,
         CASE WHEN p_size % 7 = 0 THEN 'ATG' WHEN p_size % 2 = 0 THEN 'A' ELSE 'C' END
           AS reference_bases,
         CASE WHEN p_size % 3 = 0 THEN 'G' ELSE 'T' END AS alternate_bases,
         CASE WHEN p_partkey % 10 = 3 THEN 'LowQual' ELSE 'PASS' END AS filter,
         CASE WHEN p_partkey % 22 + 1 = 21
                THEN (CASE WHEN p_partkey % 4 = 0 THEN 'APP' ELSE 'SOD1' END)
              WHEN p_partkey % 22 + 1 = 17 THEN 'BRCA1'
              ELSE 'GENE' || CAST(p_partkey % 22 + 1 AS VARCHAR) END AS gene,
         CASE WHEN p_size % 5 = 0 THEN 'PATHOGENIC' WHEN p_size % 5 = 1 THEN 'VUS'
              ELSE 'BENIGN' END AS clnsig,
         CAST(30 + p_size AS DOUBLE) AS qual
  FROM part)"""

_CTES["pairs"] = """
pairs AS (
  SELECT o_custkey, l_partkey, max(l_quantity) AS max_qty
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""

_CTES["calls_base"] = """
calls_base AS (
  SELECT s.reference_name, s.start,
         CAST(s.start + length(s.reference_bases) - 1 AS BIGINT) AS end_pos,
         s.reference_bases, s.alternate_bases,
         'sample_' || lpad(CAST(p.o_custkey AS VARCHAR), greatest(6, length(CAST(p.o_custkey AS VARCHAR)))::INTEGER, '0') AS sample_id,
         CASE WHEN (p.o_custkey + s.site_key) % 8 = 0 THEN '1/1'
              WHEN (p.o_custkey + s.site_key) % 8 IN (1, 2) THEN '0/1'
              WHEN (p.o_custkey + s.site_key) % 8 = 3 THEN './.'
              ELSE '0/0' END AS genotype,
         s.qual, s.filter,
         CAST(p.max_qty AS INTEGER) AS dp,
         CAST(60 + (p.o_custkey * 7 + s.site_key) % 40 AS INTEGER) AS gq,
         '{"gene":"' || s.gene || '","clnsig":"' || s.clnsig || '"}' AS attributes,
         'synthetic_v1' AS cohort_id,
         's3_tables' AS engine,
         CASE WHEN p.o_custkey % 2 = 1 THEN '001' ELSE '002' END AS batch_id
  FROM pairs p JOIN sites s ON p.l_partkey = s.site_key)"""

_CTES["variants"] = """
variants AS (
  SELECT reference_name, start, end_pos, reference_bases, alternate_bases, sample_id,
         genotype, qual, filter, dp, gq,
         CASE WHEN genotype = '0/1'
                THEN CAST(dp - CAST(floor(dp / 2) AS INTEGER) AS VARCHAR) || ','
                     || CAST(CAST(floor(dp / 2) AS INTEGER) AS VARCHAR)
              WHEN genotype = '1/1' THEN '0,' || CAST(dp AS VARCHAR)
              ELSE CAST(dp AS VARCHAR) || ',0' END AS allele_depth,
         attributes, cohort_id, engine, batch_id
  FROM calls_base)"""

_CTES["person"] = """
person AS (
  SELECT CAST(10000 + c_custkey AS BIGINT) AS person_id,
         CAST(CASE WHEN c_custkey % 7 = 0 THEN 0 WHEN c_custkey % 2 = 0 THEN 8507
                   ELSE 8532 END AS INTEGER) AS gender_concept_id,
         CAST(1960 + (c_custkey * 3) % 40 AS INTEGER) AS year_of_birth,
         CAST(6 AS INTEGER) AS month_of_birth,
         CAST(15 AS INTEGER) AS day_of_birth,
         CAST(8527 AS INTEGER) AS race_concept_id,
         CAST(38003564 AS INTEGER) AS ethnicity_concept_id,
         'sample_' || lpad(CAST(c_custkey AS VARCHAR), greatest(6, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS sample_id
  FROM customer)"""

_CTES["condition_occurrence"] = """
condition_occurrence AS (
  SELECT CAST(o_orderkey AS BIGINT) AS condition_occurrence_id,
         CAST(10000 + o_custkey AS BIGINT) AS person_id,
         CAST(CASE WHEN o_orderkey % 3 = 0 THEN 43530807 WHEN o_orderkey % 3 = 1 THEN 374919
                   ELSE 4216183 END AS INTEGER) AS condition_concept_id,
         substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS condition_start_date,
         CAST(32817 AS INTEGER) AS condition_type_concept_id
  FROM orders WHERE o_orderpriority = '1-URGENT')"""

_CTES["query_log"] = """
query_log AS (
  SELECT CASE user_id % 4 WHEN 0 THEN 's3_tables' WHEN 1 THEN 'custom_iceberg'
              WHEN 2 THEN 'delta_lake' ELSE 'hail_vds' END AS strategy,
         CASE event_id % 4 WHEN 0 THEN 'allele_frequency' WHEN 1 THEN 'carrier_lookup'
              WHEN 2 THEN 'gene_burden' ELSE 'omop_join' END AS query_type,
         CAST(CASE user_id % 7 WHEN 0 THEN 10 WHEN 1 THEN 50 WHEN 2 THEN 100 WHEN 3 THEN 250
              WHEN 4 THEN 500 WHEN 5 THEN 1000 ELSE 2500 END AS INTEGER) AS cohort_size,
         CAST(abs(value) AS DOUBLE) AS execution_time_ms,
         CAST(event_id * 100000 AS BIGINT) AS bytes_scanned
  FROM events)"""

_CTES["traits"] = """
traits AS (
  SELECT p.sample_id, COUNT(c.person_id) AS n_conditions,
         CAST(coalesce(max(CASE WHEN c.condition_concept_id = 43530807 THEN 1 ELSE 0 END), 0) AS INTEGER) AS is_case,
         p.year_of_birth - 1980 AS age, CASE WHEN p.gender_concept_id = 8507 THEN 1 ELSE 0 END AS male
  FROM person p LEFT JOIN condition_occurrence c ON c.person_id = p.person_id
  GROUP BY p.person_id, p.sample_id, p.year_of_birth, p.gender_concept_id)"""

_CTES["score_weights"] = """
score_weights AS (
  SELECT reference_name, start,
         CASE site_key % 5 WHEN 0 THEN alternate_bases WHEN 1 THEN reference_bases
              WHEN 2 THEN translate(alternate_bases, 'ACGT', 'TGCA') ELSE 'N' END AS effect_allele,
         CASE site_key % 5 WHEN 1 THEN alternate_bases WHEN 2 THEN translate(reference_bases, 'ACGT', 'TGCA')
              ELSE reference_bases END AS other_allele,
         (qual - 55) / 100 AS weight
  FROM sites WHERE site_key % 5 < 4)"""

_CTES["trials"] = """
trials AS (
  SELECT s_suppkey AS trial_id, 1960 + s_suppkey % 10 AS min_year, 1985 + s_suppkey % 15 AS max_year FROM supplier)"""

_CTES["trial_criteria"] = """
trial_criteria AS (
  SELECT s_suppkey AS trial_id, 1 AS criterion_id, 'all' AS mode, 'variant' AS kind,
         CASE s_suppkey % 22 + 1 WHEN 21 THEN 'APP' WHEN 17 THEN 'BRCA1' ELSE 'GENE' || CAST(s_suppkey % 22 + 1 AS VARCHAR) END AS code,
         NULL::VARCHAR AS from_day, NULL::VARCHAR AS to_day
  FROM supplier WHERE s_suppkey % 7 <> 0
  UNION ALL
  SELECT s_suppkey, 2, 'any', 'condition', (['43530807', '374919', '4216183'])[(s_suppkey % 3 + 1)::INTEGER],
         CAST(1992 + s_suppkey % 4 AS VARCHAR) || '-01-01', CAST(1995 + s_suppkey % 4 AS VARCHAR) || '-12-31'
  FROM supplier WHERE s_suppkey % 7 <> 0
  UNION ALL
  SELECT s_suppkey, 3, 'any', 'condition', (['43530807', '374919', '4216183'])[((s_suppkey + 1) % 3 + 1)::INTEGER], NULL, NULL
  FROM supplier WHERE s_suppkey % 7 <> 0 AND s_suppkey % 2 = 0
  UNION ALL
  SELECT s_suppkey, 4, 'none', 'variant:PATHOGENIC', 'BRCA1', NULL, NULL FROM supplier WHERE s_suppkey % 4 <> 2)"""

_CTES["biopsies"] = """
biopsies AS (
  SELECT 'sample_' || lpad(CAST(o_custkey AS VARCHAR), greatest(6, length(CAST(o_custkey AS VARCHAR)))::INTEGER, '0') AS sample_id,
         'chr' || CAST(l_partkey % 22 + 1 AS VARCHAR) AS marker, substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS day,
         CAST(l_quantity AS BIGINT) AS dp,
         CAST(floor(CAST(l_quantity AS BIGINT) * ((o_custkey + l_partkey + l_linenumber) % 10) / 10) AS BIGINT) AS alt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_DEPS = {
    "sites": [],
    "pairs": [],
    "calls_base": ["sites", "pairs"],
    "variants": ["calls_base"],
    "person": [],
    "condition_occurrence": [],
    "query_log": [],
    "traits": ["person", "condition_occurrence"],
    "score_weights": ["sites"],
    "trials": [],
    "trial_criteria": [],
    "biopsies": [],
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def add(n):
        for d in _DEPS[n]:
            add(d)
        if n not in out:
            out.append(n)
    for n in names:
        add(n)
    return out


def with_views(body: str, *names: str, extra: list[str] | None = None) -> str:
    """``WITH <needed ctes>[, extra ctes] <body>``."""
    ctes = [_CTES[n].strip() for n in _closure(names)] + [e.strip() for e in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
