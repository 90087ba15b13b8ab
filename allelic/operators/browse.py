"""Table browser (C14-C18): optional filters, a total order, a bounded page.

The page size is the feature here (an interactive browser): 1 to 1000, and
a size outside is an error.  ``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: each
task keeps its own top n and only n rows per task reach the final merge, so
no full sort or shuffle of the table happens.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import optional_eq

VARIANT_BROWSE_COLUMNS = ["sample_id", "reference_name", "start", "end_pos", "reference_bases",
                          "alternate_bases", "genotype", "dp", "gq", "allele_depth", "engine",
                          "attributes"]
PERSON_BROWSE_COLUMNS = ["person_id", "sample_id", "gender_concept_id", "year_of_birth",
                         "month_of_birth", "day_of_birth", "race_concept_id",
                         "ethnicity_concept_id"]
CONDITION_BROWSE_COLUMNS = ["condition_occurrence_id", "person_id", "condition_concept_id",
                            "condition_start_date", "condition_type_concept_id"]
MIN_PAGE, MAX_PAGE, DEFAULT_PAGE = 1, 1000, 100


def page_size(limit: int | None) -> int:
    if limit is None:
        return DEFAULT_PAGE
    if not MIN_PAGE <= int(limit) <= MAX_PAGE:
        raise ValueError(f"page size {limit}: {MIN_PAGE} to {MAX_PAGE} expected")
    return int(limit)


def browse_variants(calls: DataFrame, contig: str | None = "All", sample_id: str | None = "All",
                    limit: int | None = DEFAULT_PAGE, store_id: str | None = None) -> DataFrame:
    """Calls of one store, optionally one contig / sample, ordered by start."""
    cond = optional_eq("reference_name", contig) & optional_eq("sample_id", sample_id)
    if store_id is not None:
        cond = cond & (F.col("engine") == F.lit(store_id))
    return (calls.where(cond).select(*VARIANT_BROWSE_COLUMNS)
                 .orderBy("start", "sample_id", "reference_name", "reference_bases",
                          "alternate_bases")
                 .limit(page_size(limit)))


def browse_person(person: DataFrame, sample_id: str | None = "All",
                  limit: int | None = DEFAULT_PAGE) -> DataFrame:
    return (person.where(optional_eq("sample_id", sample_id))
                  .select(*PERSON_BROWSE_COLUMNS).orderBy("person_id")
                  .limit(page_size(limit)))


def browse_conditions(conditions: DataFrame, limit: int | None = DEFAULT_PAGE) -> DataFrame:
    return (conditions.select(*CONDITION_BROWSE_COLUMNS)
                      .orderBy("condition_occurrence_id").limit(page_size(limit)))


def browse_search(df: DataFrame, column: str, needle: str, sort_by: list[str],
                  descending: bool = False, limit: int | None = DEFAULT_PAGE) -> DataFrame:
    """In-table search (substring match on one column) and column sort.
    ``sort_by`` must end in a unique key so the page is deterministic."""
    first = F.col(sort_by[0]).desc() if descending else F.col(sort_by[0]).asc()
    return (df.where(F.col(column).contains(F.lit(needle)))
              .orderBy(first, *sort_by[1:]).limit(page_size(limit)))


def keep_result(result: DataFrame) -> DataFrame:
    """A result that is asked again: computed once and kept on the executors
    (spilled to their disks; lost blocks are computed again)."""
    return result.persist(StorageLevel.MEMORY_AND_DISK)


def refilter(kept: DataFrame, contig: str | None = "All", sample_id: str | None = "All") -> DataFrame:
    """Rows of a kept result of one contig and / or sample, in its order; the
    table is not read again."""
    return kept.where(optional_eq("reference_name", contig) & optional_eq("sample_id", sample_id))
