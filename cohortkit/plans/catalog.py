"""Registered queries: one per operator (or natural group) of the inventory, each a function of
(spark, sf_dir) returning a lazy DataFrame over the fixture's clinical view of the given tables.

"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortkit.operators.bag import expand_bag
from cohortkit.operators import cohort as C
from cohortkit.operators import concepts as K
from cohortkit.operators import deid as D
from cohortkit.operators import extract as X
from cohortkit.operators import generalise as G
from cohortkit.operators import profile as PR
from cohortkit.operators import quality as Q
from cohortkit.operators import summary as S
from cohortkit.schemas import violations
from cohortkit.params import FIXTURE_PARAMS, Params
from cohortkit.plans.materialize import StageStore
from cohortkit.sources.fixtures import DOMAIN_TABLES, ClinicalTables, clinical_view, domain_tables, event_stream


class _Tables:
    """Source tables of the clinical view, each materialised on first use."""

    def __init__(self, ctx: "Ctx"):
        self._ctx = ctx

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in DOMAIN_TABLES.values():
            # the six event tables are cut from one materialised stream (one join, one write)
            events = self._ctx.memo("src_events", lambda: self._ctx.raw.events, materialize=True)
            return self._ctx.memo(f"src_{name}", lambda: domain_tables(events)[name])
        # visits are columns of one table: nothing is saved by writing them again
        return self._ctx.memo(f"src_{name}", lambda: getattr(self._ctx.raw, name), materialize=name != "visit_occurrence")


class Ctx:
    """Stages of the registry pipeline over one input folder.

    Stages read by several branches (source view, cohort, extracts, maps, de-identified tables)
    are written once to the checkpoint folder and read back (``plans.materialize``), as the
    reference's scripts hand tables to each other; everything else stays lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.p = params
        self.raw: ClinicalTables = clinical_view(spark, sf_dir)
        self.store = StageStore(spark) if materialize else None
        self.v = _Tables(self) if materialize else self.raw
        self._memo: dict[str, DataFrame] = {}

    def memo(self, key: str, fn: Callable[[], DataFrame], materialize: bool = False) -> DataFrame:
        if key not in self._memo:
            df = fn()
            if materialize and self.store is not None:
                df = self.store.put(key, df)
            self._memo[key] = df
        return self._memo[key]

    def stage(self, key: str, fn: Callable[[], DataFrame]) -> DataFrame:
        return self.memo(key, fn, materialize=True)

    # -- cohort
    def dx_concepts(self) -> DataFrame:
        return self.memo("dx", lambda: K.descendants(self.p.diagnosis_roots, self.v.concept, self.v.concept_ancestor))

    def diagnoses(self) -> DataFrame:
        """The conditions of the registry's diagnoses: what the cohort is built from."""
        return self.memo("diagnoses", lambda: domain_tables(event_stream(self.spark, self.sf_dir, concepts=self.dx_concepts()))["condition_occurrence"])

    def cohort_table(self, table: str) -> DataFrame:
        """A source table to extract from; of an event table, the events of cohort persons, which are written once."""
        if table not in DOMAIN_TABLES.values():
            return getattr(self.v, table)
        events = self.stage("cohort_events", lambda: event_stream(self.spark, self.sf_dir, persons=self.cohort().select("person_id")))
        return domain_tables(events)[table]

    def events(self) -> DataFrame:
        return self.memo("events", lambda: C.qualifying_events(self.diagnoses(), self.dx_concepts(), self.p.study_start))

    def index(self) -> DataFrame:
        return self.memo(
            "index",
            lambda: C.index_visits(
                self.v.visit_occurrence, self.events(), self.p.visit_types, self.p.study_start, self.p.window_lo, self.p.window_hi
            ),
        )

    def cohort(self) -> DataFrame:
        return self.stage(
            "cohort",
            lambda: C.build_cohort(
                self.diagnoses(), self.v.visit_occurrence, self.v.person, self.v.death,
                self.v.concept, self.v.concept_ancestor, self.p,
            ),
        )

    # -- extract
    def extract(self, table: str, multiplicity: str = "weighted") -> DataFrame:
        return self.stage(
            f"x_{table}_{multiplicity}",
            lambda: X.extract(
                self.cohort_table(table), self.cohort(), X.SPECS[table], self.p,
                concept_set=self.v.concept_set, concept_ancestor=self.v.concept_ancestor, concept=self.v.concept,
                multiplicity=multiplicity,
            ),
        )

    # -- generalisation
    def rare_map(self, min_count: int) -> DataFrame:
        return self.stage(
            f"rare_map_{min_count}",
            lambda: G.rare_concept_map(self.extract("condition_occurrence"), self.v.concept_ancestor, self.v.concept, min_count),
        )

    def rare_removed(self, min_count: int | None = None) -> DataFrame:
        m = self.p.min_count if min_count is None else min_count
        return self.stage(f"rare_removed_{m}", lambda: G.generalise(self.extract("condition_occurrence"), self.rare_map(m)))

    # -- de-identification
    def person_map(self) -> DataFrame:
        return self.stage(
            "pmap", lambda: D.person_map(self.extract("person"), self.p.salt, self.p.as_of, self.p.max_shift, self.p.over_age)
        )

    def visit_map(self) -> DataFrame:
        return self.stage(
            "vmap", lambda: D.visit_map(self.extract("visit_occurrence"), self.person_map(), self.p.deid_start, self.p.deid_end)
        )

    def deid(self, table: str) -> DataFrame:
        def build() -> DataFrame:
            if table == "person":
                return D.deid_person(self.extract("person"), self.person_map(), self.p.as_of, self.p.over_age)
            src = self.rare_removed() if table == "condition_occurrence" else self.extract(table)
            return D.deidentify(src, self.person_map(), self.visit_map(), D.DEID_SPECS[table], self.p.deid_start, self.p.deid_end)

        return self.stage(f"deid_{table}", build)


QueryFn = Callable[[Ctx], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- concepts
query("concept_descendants")(lambda c: c.dx_concepts())
for _dom in ["Measurement", "Procedure", "Device", "Condition", "Observation", "Drug"]:
    query(f"concept_expand_{_dom.lower()}")(
        lambda c, d=_dom: K.expand_concepts(c.v.concept_set, c.v.concept_ancestor, d)
    )

# ---------------------------------------------------------------- cohort
query("cohort_events")(lambda c: c.events())
query("cohort_index_visits")(lambda c: c.index())
query("cohort_build")(lambda c: c.cohort())
query("cohort_attrition")(lambda c: C.cohort_attrition(c.events(), c.index(), c.cohort()))
query("cohort_preview")(lambda c: C.preview(c.cohort(), 100))

# ---------------------------------------------------------------- extract
for _t in X.SPECS:
    query(f"extract_{_t}")(lambda c, t=_t: expand_bag(c.extract(t)))
for _t in ["drug_exposure", "death", "procedure_occurrence", "condition_occurrence", "device_exposure"]:
    query(f"extract_{_t}_distinct")(lambda c, t=_t: c.extract(t, "distinct"))
query("extract_condition_occurrence_interval")(
    lambda c: X.extract(c.cohort_table("condition_occurrence"), c.cohort(), X.SPECS["condition_occurrence"], c.p, c.v.concept_set,
                        c.v.concept_ancestor, c.v.concept, overlap="interval")
)

# ---------------------------------------------------------------- generalisation
for _m in (10, 25):
    query(f"rare_ancestor_counts_m{_m}")(
        lambda c: G.ancestor_counts(G.person_concepts(c.extract("condition_occurrence")), c.v.concept_ancestor, c.v.concept)
    )
    query(f"rare_map_m{_m}")(lambda c, m=_m: c.rare_map(m))
    query(f"rare_rewrite_m{_m}")(lambda c, m=_m: expand_bag(c.rare_removed(m)))
query("rare_dropped_m10")(lambda c: G.dropped_facts(c.extract("condition_occurrence"), c.rare_map(10)))
query("rare_concept_counts")(lambda c: G.concept_person_counts(G.person_concepts(c.extract("condition_occurrence")), c.v.concept))

# ---------------------------------------------------------------- de-identification
query("deid_person_map")(lambda c: c.person_map())
query("deid_visit_map")(lambda c: c.visit_map())
for _t in ["person", "visit_occurrence", "condition_occurrence", "procedure_occurrence", "drug_exposure",
           "observation", "death", "device_exposure", "measurement"]:
    query(f"deid_{_t}")(lambda c, t=_t: expand_bag(c.deid(t)))

# ---------------------------------------------------------------- contract
def _contract(c: Ctx) -> DataFrame:
    out = None
    for t in X.SPECS:
        v = violations(c.extract(t), t)
        out = v if out is None else out.unionByName(v)
    return out


query("contract_violations")(_contract)

# ---------------------------------------------------------------- quality checks
query("qc_persons")(lambda c: Q.qc_persons(c.deid("person")))
query("qc_deaths")(lambda c: Q.qc_deaths(c.deid("death")))
for _t, _col in Q.CONCEPT_COLUMNS.items():
    query(f"qc_concepts_{_t}")(lambda c, t=_t, col=_col: Q.qc_concepts(c.deid(t), col))
query("qc_ranges")(lambda c: Q.qc_ranges({t: c.deid(t) for t in Q.RANGE_COLUMNS}))
query("qc_report")(
    lambda c: Q.quality_report({t: c.deid(t) for t in ["person", "death", *Q.RANGE_COLUMNS]}, c.p.deid_start, c.p.deid_end, c.p.as_of)
)

# ---------------------------------------------------------------- profiles
def _closure(c: Ctx, domain: str) -> DataFrame:
    return K.expand_concepts(c.v.concept_set, c.v.concept_ancestor, domain)


query("profile_condition_observed")(
    lambda c: PR.prevalence_observed(c.deid("condition_occurrence"), c.v.concept_ancestor, c.v.concept, c.deid("person"))
)
query("profile_condition_registry")(
    lambda c: PR.prevalence_registry(c.deid("condition_occurrence"), _closure(c, "Condition"), c.deid("person"))
)
query("profile_measurement_grid")(
    lambda c: PR.count_grid(c.deid("measurement"), _closure(c, "Measurement"), c.deid("person"), "measurement_concept_id")
)
query("profile_measurement_rank")(
    lambda c: PR.rank_counts(c.deid("measurement"), _closure(c, "Measurement"), c.deid("person"), "measurement_concept_id")
)
query("profile_measurement_percentiles")(
    lambda c: PR.rank_percentiles(c.deid("measurement"), _closure(c, "Measurement"), c.deid("person"), "measurement_concept_id")
)
query("profile_measurement_report")(
    lambda c: PR.percentile_report(c.deid("measurement"), _closure(c, "Measurement"), c.deid("person"), "measurement_concept_id")
)
query("profile_drugs_given")(lambda c: PR.drugs_given(c.deid("drug_exposure"), c.v.concept))
query("profile_ingredient_map")(lambda c: PR.ingredient_map(c.deid("drug_exposure"), c.v.concept_ancestor, c.v.concept))


def _exposure(c: Ctx) -> DataFrame:
    d = c.deid("drug_exposure")
    return PR.exposure_by_ingredient(d, PR.ingredient_map(d, c.v.concept_ancestor, c.v.concept))


query("profile_ingredient_use")(lambda c: PR.ingredient_use(_exposure(c)))
query("profile_ingredient_intensity")(lambda c: PR.ingredient_intensity(_exposure(c)))
query("profile_ingredient")(lambda c: PR.ingredient_profile(c.deid("drug_exposure"), c.v.concept_ancestor, c.v.concept))
query("profile_unmapped_drugs")(
    lambda c: PR.unmapped_review(c.v.drug_exposure, c.extract("visit_occurrence"), c.p.unmapped_min_count)
)
query("profile_device_grid")(
    lambda c: PR.count_grid(c.deid("device_exposure"), _closure(c, "Device"), c.deid("person"), "device_concept_id", "descendant")
)
query("profile_device_use")(lambda c: PR.device_use(c.deid("device_exposure"), _closure(c, "Device"), c.deid("person")))
query("profile_device_intensity")(lambda c: PR.device_intensity(c.deid("device_exposure"), _closure(c, "Device"), c.deid("person")))
query("profile_device")(lambda c: PR.device_profile(c.deid("device_exposure"), _closure(c, "Device"), c.deid("person")))

# ---------------------------------------------------------------- summary statistics
FIXTURE_INGREDIENTS = tuple(range(20101, 20111)) + tuple(range(30101, 30106))
query("summary_ingredient_route")(
    lambda c: S.ingredient_route_profile(c.v.drug_exposure, c.v.concept_ancestor, c.v.concept, FIXTURE_INGREDIENTS)
)
query("summary_mapped_drug_profile")(lambda c: PR.ingredient_profile(c.extract("drug_exposure"), c.v.concept_ancestor, c.v.concept))
query("summary_measurement_source")(lambda c: S.source_profile(c.v.measurement))
query("summary_condition_ancestor")(
    lambda c: S.ancestor_profile(c.v.condition_occurrence, c.v.concept_ancestor, c.v.concept, "condition_concept_id",
                                 "condition_source_value", "mean_conditions_per_patient")
)
query("summary_device_ancestor")(
    lambda c: S.ancestor_profile(c.v.device_exposure, c.v.concept_ancestor, c.v.concept, "device_concept_id",
                                 "device_source_value", "mean_devices_per_patient")
)


def _first(c: Ctx) -> DataFrame:
    return S.first_visit(c.cohort())


def _age(c: Ctx) -> DataFrame:
    return S.age_at_first_visit(c.extract("person"), _first(c))


query("summary_first_visit")(_first)
query("summary_age_rows")(_age)
query("summary_demographics")(lambda c: S.demographics(c.extract("person"), _age(c)))
query("summary_death_info")(lambda c: expand_bag(S.death_info(c.extract("death"), c.v.concept)))
query("summary_stay_rows")(lambda c: S.stay(c.cohort(), _first(c)))
query("summary_age")(lambda c: S.age_summary(_age(c)))
query("summary_race")(lambda c: S.share(S.demographics(c.extract("person"), _age(c)), c.v.concept, "race_concept_id", "race"))
query("summary_ethnicity")(
    lambda c: S.share(S.demographics(c.extract("person"), _age(c)), c.v.concept, "ethnicity_concept_id", "ethnicity")
)
query("summary_deaths")(lambda c: S.death_summary(S.death_info(c.extract("death"), c.v.concept)))
query("summary_stay")(lambda c: S.stay_summary(S.stay(c.cohort(), _first(c))))
query("summary_report")(lambda c: S.summary_report(c.cohort(), c.extract("person"), c.extract("death"), c.v.concept))


_CONTEXTS: dict[tuple, Ctx] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input files: another state is another input."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def context(spark: SparkSession, sf_dir: str) -> Ctx:
    """One context per (application, input folder as it is now): queries of one run share materialised
    stages."""
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir))
    ctx = _CONTEXTS.get(key)
    if ctx is None or ctx.spark is not spark:
        ctx = _CONTEXTS[key] = Ctx(spark, sf_dir)
    return ctx


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return REGISTRY[name](context(spark, sf_dir))
