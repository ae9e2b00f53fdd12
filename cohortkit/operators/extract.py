"""Windowed extraction of clinical tables around cohort visits.

One function, ``extract``, with a spec per table replaces nine scripts. Window kinds:

* ``band``    fact date in [visit_start - n days, visit_end + n days]   (measurement, drug,
              procedure, device)
* ``years``   fact date in [visit_start - n years, visit_end + n years]  (observation)
* ``overlap`` start < visit_end OR end > visit_start OR end IS NULL      (condition, Q6)
* ``visit``   same (person_id, visit_occurrence_id) and start >= a date  (visit)
* ``person``  any cohort row of the person                               (person, death)

Multiplicity (§2.3). The reference's joins produce a bag: a record repeats once per matching cohort row and
once per matching registry ancestor, for the tables the reference does not DISTINCT. ``"weighted"`` returns each
record once with that number (``bag.TIMES``), ``"reference"`` the bag itself, ``"distinct"`` each matching
record once. DISTINCT tables (person, measurement, observation, visit) have no weight, as record ids are primary keys.

No mode pairs a fact with cohort rows. For bands and year windows the number ``k`` of matching cohort rows is a running
sum of the windows' boundaries (``intervals.count_covering``); for the OR overlap ``k`` is ``person's cohort rows -
rows failing the test``, which few kinds of records can fail (see ``_overlap_failures``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.concepts import concept_multiplicity, expand_concepts
from cohortkit.operators.bag import TIMES, expand_bag
from cohortkit.operators.intervals import BIN_DAYS, count_covering, points, running_count
from cohortkit.params import Params
from cohortkit.plans.broadcast import broadcast_checked, join_lookup


@dataclass(frozen=True)
class ExtractSpec:
    table: str
    person_col: str = "person_id"
    concept_col: str | None = None
    date_col: str | None = None
    end_col: str | None = None
    window: str = "person"          # band | years | overlap | visit | person
    domain: str | None = None        # registry domain used as concept filter
    join_concept: bool = False       # inner join with the concept table (drug)
    distinct: bool = False           # the reference SELECTs DISTINCT
    suppress: tuple[str, ...] = ()   # free-text columns replaced by typed NULL (O20)


# Fixed per-table specs, as the reference's extract script defines them.
SPECS: dict[str, ExtractSpec] = {
    "person": ExtractSpec(
        "person", window="person", distinct=True,
        suppress=("person_source_value", "gender_source_value", "race_source_value", "ethnicity_source_value"),
    ),
    "measurement": ExtractSpec(
        "measurement", concept_col="measurement_concept_id", date_col="measurement_date", window="band",
        domain="Measurement", distinct=True,
        suppress=("measurement_source_value", "unit_source_value", "value_source_value"),
    ),
    "drug_exposure": ExtractSpec(
        "drug_exposure", concept_col="drug_concept_id", date_col="drug_exposure_start_date", window="band",
        join_concept=True,
        suppress=("drug_source_value", "route_source_value", "dose_unit_source_value"),
    ),
    "death": ExtractSpec("death", window="person", suppress=("cause_source_value",)),
    "observation": ExtractSpec(
        "observation", concept_col="observation_concept_id", date_col="observation_date", window="years",
        domain="Observation", distinct=True,
        suppress=("observation_source_value", "unit_source_value", "qualifier_source_value", "value_source_value"),
    ),
    "procedure_occurrence": ExtractSpec(
        "procedure_occurrence", concept_col="procedure_concept_id", date_col="procedure_date", window="band",
        domain="Procedure", suppress=("procedure_source_value", "modifier_source_value"),
    ),
    "condition_occurrence": ExtractSpec(
        "condition_occurrence", concept_col="condition_concept_id", date_col="condition_start_date",
        end_col="condition_end_date", window="overlap", domain="Condition",
        suppress=("condition_source_value", "condition_status_source_value"),
    ),
    "visit_occurrence": ExtractSpec(
        "visit_occurrence", date_col="visit_start_date", window="visit", distinct=True,
        suppress=("visit_source_value", "admitted_from_source_value", "discharged_to_source_value"),
    ),
    "device_exposure": ExtractSpec(
        "device_exposure", concept_col="device_concept_id", date_col="device_exposure_start_date", window="band",
        domain="Device", suppress=("device_source_value", "unit_source_value"),
    ),
}


def suppress_source_values(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Free-text source columns become typed NULLs, order kept."""
    return df.select(*[F.lit(None).cast("string").alias(c) if c in columns else F.col(c) for c in df.columns])


def _window_bounds(spec: ExtractSpec, params: Params) -> tuple[Column, Column]:
    if spec.window == "band":
        n = params.band_days
        return F.date_sub("visit_start_date", n), F.date_add("visit_end_date", n)
    if spec.window == "years":
        m = params.observation_months
        return F.add_months("visit_start_date", -m), F.add_months("visit_end_date", m)
    raise ValueError(spec.window)


def _overlap_failures(facts: DataFrame, cohort: DataFrame, s: str, e: str) -> DataFrame:
    """(person_id, _s, _e, c): number of closed cohort rows failing ``s < ve OR e > vs OR e IS NULL``.

    A row fails when ve <= s and vs >= e. For a well-formed visit (vs <= ve) that needs
    e <= vs <= ve <= s, so only facts with e <= s (zero-length or reversed) can fail, and only
    against visits starting inside [e, s]: those facts are joined by the bins of that span, with the exact
    test as residual. Malformed visits (vs > ve) are rare; only facts of persons who have one are paired
    with them. The result is keyed by (person, s, e).
    """
    day_bin = lambda c: F.floor(F.unix_date(c) / BIN_DAYS).cast("int")
    wf = cohort.where(F.col("visit_start_date") <= F.col("visit_end_date")).groupBy(
        "person_id", "visit_start_date", "visit_end_date"
    ).agg(F.count(F.lit(1)).alias("_n")).withColumn("_bin", day_bin("visit_start_date"))
    cand = (
        facts.where(F.col(e).isNotNull() & (F.col(e) <= F.col(s)))
        .select("person_id", F.col(s).alias("_s"), F.col(e).alias("_e"))
        .distinct()
        .select("person_id", "_s", "_e", F.explode(F.sequence(day_bin("_e"), day_bin("_s"))).alias("_bin"))
    )
    fail_wf = (
        cand.join(wf, ["person_id", "_bin"])
        .where((F.col("visit_start_date") >= F.col("_e")) & (F.col("visit_end_date") <= F.col("_s")))
        .groupBy("person_id", "_s", "_e")
        .agg(F.sum("_n").alias("c"))
    )
    bad = cohort.where(F.col("visit_start_date") > F.col("visit_end_date")).select(
        "person_id", "visit_start_date", "visit_end_date"
    )
    bad_keys = (
        facts.where(F.col(e).isNotNull())
        .join(broadcast_checked(bad.select("person_id").distinct(), beside=facts), "person_id", "left_semi")
        .select("person_id", F.col(s).alias("_s"), F.col(e).alias("_e"))
        .distinct()
    )
    fail_bad = (
        bad_keys.join(bad, "person_id")
        .where((F.col("visit_end_date") <= F.col("_s")) & (F.col("visit_start_date") >= F.col("_e")))
        .groupBy("person_id", "_s", "_e")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    return fail_wf.unionByName(fail_bad).groupBy("person_id", "_s", "_e").agg(F.sum("c").alias("c"))


def _overlap_counts(facts: DataFrame, cohort: DataFrame, s: str, e: str, per_person: DataFrame, overlap: str) -> DataFrame:
    """facts with ``_k`` = cohort rows that pass the overlap test.

    ``"any"``: N - failures, where an open visit (no end) can only match by its start, so it fails when vs >= e;
    those are the person's open visits without the ones that start before e.
    ``"interval"``: ``s < visit_end AND (e IS NULL OR e > visit_start)`` by inclusion-exclusion over the two
    failing tests: k = N - #(visit_end <= s) - #(visit_start >= e) + #(both), #(both) being the failures."""
    cols = facts.columns
    fails = broadcast_checked(_overlap_failures(facts, cohort, s, e).withColumnRenamed("person_id", "_fpid"), beside=facts)
    j = join_lookup(facts, per_person, "person_id", "_pid").withColumn("_before", F.date_sub(e, 1))
    if overlap == "interval":
        j = running_count(j, "person_id", F.col(s), points(cohort, "person_id", F.col("visit_end_date")), "_ended")
        j = running_count(j, "person_id", F.col("_before"), points(cohort, "person_id", F.col("visit_start_date")), "_started")
    else:
        open_visits = cohort.where(F.col("visit_end_date").isNull())
        j = running_count(j, "person_id", F.col("_before"), points(open_visits, "person_id", F.col("visit_start_date")), "_started")
    j = j.join(fails, (F.col("person_id") == F.col("_fpid")) & (F.col(s) == F.col("_s")) & (F.col(e) == F.col("_e")), "left")
    failed = F.coalesce(F.col("c"), F.lit(0))
    if overlap == "interval":
        late = F.when(F.col(e).isNull(), F.lit(0)).otherwise(F.col("_n") - F.col("_started"))
        k = F.col("_n") - F.col("_ended") - late + failed
    else:
        k = F.when(F.col(e).isNull(), F.col("_n")).otherwise(F.col("_n") - failed - (F.col("_open") - F.col("_started")))
    return j.select(*cols, k.alias("_k")).where(F.col("_k") > 0)


def _matches(facts: DataFrame, cohort: DataFrame, spec: ExtractSpec, params: Params, overlap: str = "any") -> DataFrame:
    """facts with a column ``_k``: number of cohort rows each fact matches (rows with 0 dropped)."""
    if spec.window in ("band", "years"):
        lo, hi = _window_bounds(spec, params)
        return count_covering(facts, spec.person_col, F.col(spec.date_col), cohort, "person_id", lo, hi, "_k")
    if overlap == "interval":  # an open visit has no end that a record could start before
        cohort = cohort.where(F.col("visit_end_date").isNotNull())
    is_open = F.col("visit_end_date").isNull() & F.col("visit_start_date").isNotNull()
    per_person = cohort.groupBy(F.col("person_id").alias("_pid")).agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(is_open, 1)).alias("_open"))
    if spec.window == "person":
        return join_lookup(facts, per_person, spec.person_col, "_pid").select(*facts.columns, F.col("_n").alias("_k"))
    if spec.window == "overlap":
        return _overlap_counts(facts, cohort, spec.date_col, spec.end_col, per_person, overlap)
    raise ValueError(spec.window)


def extract(
    fact: DataFrame,
    cohort: DataFrame,
    spec: ExtractSpec,
    params: Params,
    concept_set: DataFrame | None = None,
    concept_ancestor: DataFrame | None = None,
    concept: DataFrame | None = None,
    multiplicity: str = "reference",
    overlap: str = "any",
) -> DataFrame:
    """Rows of ``fact`` for the cohort, per ``spec``; columns and order of ``fact``, source
    values suppressed, and the weight ``bag.TIMES`` with ``multiplicity="weighted"``. ``overlap`` applies to the
    condition table: ``"any"`` is the reference's OR test (Q6), ``"interval"`` the interval overlap
    start < visit_end AND (end > visit_start or open)."""
    cols = fact.columns
    if spec.window == "visit":
        keys = cohort.select("person_id", "visit_occurrence_id").distinct()
        out = fact.where(F.col(spec.date_col) >= F.lit(params.extract_visit_start)).join(
            keys, ["person_id", "visit_occurrence_id"], "left_semi"
        )
        return suppress_source_values(out.select(*cols), spec.suppress)

    bag = multiplicity != "distinct" and not spec.distinct
    # only cohort persons can match: drop everyone else map-side, before any shuffle of the facts
    persons = cohort.select(F.col("person_id").alias("_pid")).distinct()
    facts = join_lookup(fact, persons, spec.person_col, "_pid", "left_semi")
    n_anc = None
    if spec.domain is not None:
        expansion = expand_concepts(concept_set, concept_ancestor, spec.domain)
        if bag:
            n_anc = concept_multiplicity(expansion).withColumnRenamed("concept_id", "_cid")
            facts = join_lookup(facts, n_anc, spec.concept_col, "_cid")
        else:
            ids = expansion.select(F.col("concept_id").alias("_cid")).distinct()
            facts = join_lookup(facts, ids, spec.concept_col, "_cid", "left_semi")
    if spec.join_concept:
        # inner join with the vocabulary on its key = keep facts whose concept exists; only the
        # concepts the facts use are looked up, so the side joined back is small and measured
        used = facts.select(spec.concept_col).distinct()
        known = used.join(concept.select(F.col("concept_id").alias(spec.concept_col)), spec.concept_col, "left_semi")
        facts = join_lookup(facts, known.withColumnRenamed(spec.concept_col, "_cid"), spec.concept_col, "_cid", "left_semi")

    if spec.window == "person" and not bag:
        return suppress_source_values(facts.select(*cols), spec.suppress)
    out = _matches(facts, cohort, spec, params, overlap)
    if not bag:
        return suppress_source_values(out.select(*cols), spec.suppress)
    weight = F.col("_k") * (F.col("n_anc") if n_anc is not None else F.lit(1))
    out = suppress_source_values(out.select(*cols, weight.cast("long").alias(TIMES)), spec.suppress)
    return out if multiplicity == "weighted" else expand_bag(out)
