"""Role-based column views.

A projection is a convention, not enforcement: anyone who can read the
files reads every column.  Enforcement belongs to the catalog / storage
permissions; these views give each role the frame it is allowed to see and
make any reference to a withheld column fail at analysis time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The researcher allow-list (11 columns) of the policy matrix.
RESEARCHER_COLUMNS = ["reference_name", "start", "end_pos", "reference_bases", "alternate_bases",
                      "qual", "filter", "dp", "gq", "attributes", "cohort_id"]
# Columns withheld from researchers.  ``engine`` is in neither the policy
# matrix nor the warehouse DDL: denied by default.
PHI_COLUMNS = ["sample_id", "genotype", "allele_depth", "engine"]

# Site columns and the aggregates over samples that may leave.
PUBLISHED_COLUMNS = [*RESEARCHER_COLUMNS, "gene_symbol", "clinical_significance",
                     "carrier_sample_count", "allele_count", "allele_number",
                     "cohort_allele_frequency", "total_cohort_samples", "alt_carrier_count",
                     "carrier_frequency", "alt_allele_count", "sample_count",
                     "alt_allele_frequency", "call_count", "mean_depth"]


def researcher_view(calls: DataFrame) -> DataFrame:
    return calls.select(*RESEARCHER_COLUMNS)


def steward_view(calls: DataFrame) -> DataFrame:
    return calls


def researcher_masked(calls: DataFrame) -> DataFrame:
    """PHI columns kept in place (same schema) but nulled."""
    types = dict(calls.dtypes)
    return calls.select(*[
        (F.lit(None).cast(types[c]).alias(c) if c in PHI_COLUMNS else F.col(c))
        for c in calls.columns
    ])


# Aggregates that keep nothing of a single value, and those that may only add
# up what was decided from one (a dosage), not the value itself.
COUNTS = ["Count", "CountIf", "HyperLogLogPlusPlus"]
TOTALS = ["Sum", "Average"]


def _seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


class _Lineage:
    """Which columns of an analysed plan carry withheld ones: ``direct`` by
    value or anything computed from it, ``kept`` by the value itself."""

    def __init__(self):
        self.direct: dict[int, bool] = {}
        self.kept: dict[int, bool] = {}

    def _name(self, e) -> str:
        return e.getClass().getSimpleName()

    def _carries(self, e, known: dict[int, bool], loose: bool) -> bool:
        name = self._name(e)
        if name in ("AttributeReference", "OuterReference"):
            return known.get(e.exprId().id(), e.name().lower() in PHI_COLUMNS) if name == "AttributeReference" else True
        if name == "Alias":
            return self._carries(e.child(), known, loose)
        if name in COUNTS:
            return False
        if name in TOTALS:
            return any(self._carries(c, self.kept, True) for c in _seq(e.children()))
        if name == "AggregateExpression":
            return self._carries(e.aggregateFunction(), known, loose)
        if name == "WindowExpression":
            return self._carries(e.windowFunction(), known, loose)
        if hasattr(e, "plan") and "Subquery" in name:
            inner = _Lineage()
            inner.walk(e.plan())
            return any(inner.direct[a.exprId().id()] for a in _seq(e.plan().output()))
        if loose and e.dataType().typeName() == "boolean":
            return False  # a decision, of which a total keeps no more than a count
        children = _seq(e.children())
        if loose and name == "If":
            children = children[1:]
        if loose and name == "CaseWhen":  # conditions and values in turn, the default last
            children = [c for k, c in enumerate(children) if k % 2 == 1 or k == len(children) - 1 and len(children) % 2 == 1]
        return any(self._carries(c, known, loose) for c in children)

    def _aliases(self, e):
        if self._name(e) == "Alias":
            i = e.exprId().id()
            self.direct[i], self.kept[i] = self._carries(e.child(), self.direct, False), self._carries(e.child(), self.kept, True)
        for c in _seq(e.children()):
            self._aliases(c)

    def walk(self, node) -> None:
        children = _seq(node.children())
        for c in children:
            self.walk(c)
        below = [[a.exprId().id() for a in _seq(c.output())] for c in children]
        for e in _seq(node.expressions()):
            self._aliases(e)
        name = node.getClass().getSimpleName()
        for at, a in enumerate(_seq(node.output())):
            i = a.exprId().id()
            if name in ("Union", "Intersect", "Except"):  # columns by place
                for known in (self.direct, self.kept):
                    known[i] = any(known[ids[at]] for ids in below)
            elif i not in self.direct:
                own = a.name().lower() in PHI_COLUMNS
                # a leaf's column is known by its name; what a node makes in other ways may hold all it reads
                new = any(self.direct[x] for ids in below for x in ids)
                self.direct[i] = self.kept[i] = own or new


def published(result: DataFrame) -> DataFrame:
    """Release an aggregate computed by a steward.

    Every output column must be on the allow-list, and none may carry a
    withheld column: the analysed plan is followed from its sources, through
    names, expressions, grouping keys, unions and subqueries.  Counts of
    withheld columns may leave, and totals and means of what was decided by
    them; the values themselves, anything computed from them, and aggregates
    that keep a value (first, max, collections) may not.
    """
    unknown = [c for c in result.columns if c not in PUBLISHED_COLUMNS]
    if unknown:
        raise ValueError(f"result exposes columns that are not released: {unknown}")
    plan, lineage = result._jdf.queryExecution().analyzed(), _Lineage()
    lineage.walk(plan)
    carried = [a.name() for a in _seq(plan.output()) if lineage.direct[a.exprId().id()]]
    if carried:
        raise ValueError(f"result exposes withheld columns: {sorted(carried)}")
    return result
