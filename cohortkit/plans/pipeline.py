"""End-to-end registry run: the reference's scripts 00 -> 07 as one chain of Spark jobs.

    concept set -> cohort -> nine extracts -> rare-concept map and rewrite -> key maps ->
    nine de-identified tables -> quality report -> profiles -> summary report

Every stage is written as parquet under the run's folder and read back before the next stage uses
it (the reference's ``[Results]`` tables): a stage read by several jobs is computed once, and
a lost executor costs a re-read, not a recomputation of the chain. Stages hold a record once, with its weight; bags are
expanded only in the tables that are published, and those are seen only once the run's manifest is
(``plans.publish``). Fact stages are sorted by person within each file so readers can skip row groups by person.

Command line (OMOP tables as parquet folders ``<input>/<table>``, concept set as CSV):

    python -m cohortkit.plans.pipeline --input /data/omop --concept-set concepts.csv \
        --output /shared/registry --salt SECRET [--start 2016-01-01 --end 2029-12-31 ...]

or on the test fixture: ``--fixture /root/testdata/sf0.01``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cohortkit.operators import cohort as C
from cohortkit.operators import concepts as K
from cohortkit.operators import deid as D
from cohortkit.operators import extract as X
from cohortkit.operators import generalise as G
from cohortkit.operators import profile as PR
from cohortkit.operators import quality as Q
from cohortkit.operators import summary as S
from cohortkit.operators.key_map import high_watermark
from cohortkit.params import FIXTURE_PARAMS, Params
from cohortkit.plans.publish import Manifest, Run, input_state, last_published, remove_unpublished, salt_check
from cohortkit.schemas import violations

FACT_DATE = {
    "measurement": "measurement_date", "drug_exposure": "drug_exposure_start_date", "observation": "observation_date",
    "procedure_occurrence": "procedure_date", "condition_occurrence": "condition_start_date",
    "visit_occurrence": "visit_start_date", "device_exposure": "device_exposure_start_date", "death": "death_date",
}


def run_registry(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    params: Params,
    output: str,
    multiplicity: str = "reference",
    ingredients: tuple[int, ...] = (),
    previous: Manifest | None = None,
) -> Manifest:
    """Run the whole registry build under ``output`` and publish it; returns the manifest.

    ``tables`` holds the OMOP sources (person, visit_occurrence, condition_occurrence,
    procedure_occurrence, drug_exposure, device_exposure, measurement, observation, death,
    concept, concept_ancestor) and the registry ``concept_set``. ``previous`` is the published run before: its
    persons and visits keep their ids, shifts and birth years, and it must have had the same salt.

    ``multiplicity="reference"`` publishes bags as the reference's tables hold them; ``"weighted"`` each record
    once with the number ``bag.TIMES``; ``"distinct"`` each record once. Rows of the cohort, the key maps and the
    de-identified tables that break the contract are quarantined; the extracts, which the reference leaves without
    constraints, only have theirs counted (contract_violations)."""
    if not params.salt or params.as_of is None:
        raise ValueError("a run needs a secret salt and an as-of date")
    if previous is not None and previous.salt_check != salt_check(params.salt):
        raise ValueError("the previous run had another salt: persons would be shifted anew")
    old = {name: spark.read.parquet(previous.tables[name]) for name in ("person_map", "visit_map")} if previous else {}
    marks = previous.watermarks if previous else {}
    t = tables
    inputs = {name: input_state(spark, df) for name, df in t.items()}
    expand = multiplicity == "reference"
    with Run(spark, output) as run:
        # 01: cohort
        cohort = run.accepted("registry_cohort", C.build_cohort(
            t["condition_occurrence"], t["visit_occurrence"], t["person"], t["death"], t["concept"], t["concept_ancestor"], params
        ), "cohort", sort=["person_id"])
        # 02: extracts, each record once
        reg = {}
        held = "distinct" if multiplicity == "distinct" else "weighted"
        for name, spec in X.SPECS.items():
            df = X.extract(t[name], cohort, spec, params, t["concept_set"], t["concept_ancestor"], t["concept"], held)
            sort = ["person_id"] + ([FACT_DATE[name]] if name in FACT_DATE else [])
            reg[name] = run.both(f"registry_{name}", df, expand, sort)
        run.table("contract_violations", reduce(DataFrame.unionByName, [violations(reg[name], name) for name in X.SPECS]))
        # 03: rare-concept generalisation
        rmap = run.table("rare_concept_map", G.rare_concept_map(reg["condition_occurrence"], t["concept_ancestor"], t["concept"], params.min_count))
        run.table("rare_concept_dropped", G.dropped_facts(reg["condition_occurrence"], rmap))
        cond = run.both("registry_condition_occurrence_generalised", G.generalise(reg["condition_occurrence"], rmap), expand,
                        ["person_id", "condition_start_date"])
        # 04/05: key maps (written before any table uses them) and de-identified tables
        pmap = run.accepted("person_map", D.person_map(
            reg["person"], params.salt, params.as_of, params.max_shift, params.over_age, old.get("person_map"), marks.get("person_map")), "person_map")
        vmap = run.accepted("visit_map", D.visit_map(
            reg["visit_occurrence"], pmap, params.deid_start, params.deid_end, old.get("visit_map"), marks.get("visit_map")), "visit_map")
        deid = {"person": run.accepted("deid_person", D.deid_person(reg["person"], pmap, params.as_of, params.over_age), "person", sort=["person_id"])}
        for name, spec in D.DEID_SPECS.items():
            src = cond if name == "condition_occurrence" else reg[name]
            out = D.deidentify(src, pmap, vmap, spec, params.deid_start, params.deid_end)
            deid[name] = run.accepted(f"deid_{name}", out, name, expand, ["person_id"])
        # 06: quality report
        run.table("quality_report", Q.quality_report(deid, params.deid_start, params.deid_end, params.as_of))
        for name, col in Q.CONCEPT_COLUMNS.items():
            run.table(f"qc_concepts_{name}", Q.qc_concepts(deid[name], col))
        # 07: profiles
        cs, ca, c = t["concept_set"], t["concept_ancestor"], t["concept"]
        cond_cl = K.expand_concepts(cs, ca, "Condition")
        meas_cl = K.expand_concepts(cs, ca, "Measurement")
        dev_cl = K.expand_concepts(cs, ca, "Device")
        run.table("profile_condition_observed", PR.prevalence_observed(deid["condition_occurrence"], ca, c, deid["person"]))
        run.table("profile_condition_registry", PR.prevalence_registry(deid["condition_occurrence"], cond_cl, deid["person"]))
        run.table("profile_measurement", PR.percentile_report(deid["measurement"], meas_cl, deid["person"], "measurement_concept_id"))
        run.table("profile_ingredient", PR.ingredient_profile(deid["drug_exposure"], ca, c))
        run.table("profile_unmapped_drugs", PR.unmapped_review(t["drug_exposure"], reg["visit_occurrence"], params.unmapped_min_count))
        run.table("profile_device", PR.device_profile(deid["device_exposure"], dev_cl, deid["person"]))
        # summary statistics (deprecated folder of the reference)
        run.table("summary_report", S.summary_report(cohort, reg["person"], reg["death"], c))
        run.table("summary_condition_ancestor", S.ancestor_profile(
            reg["condition_occurrence"], ca, c, "condition_concept_id", "condition_source_value", "mean_conditions_per_patient"))
        run.table("summary_device_ancestor", S.ancestor_profile(
            reg["device_exposure"], ca, c, "device_concept_id", "device_source_value", "mean_devices_per_patient"))
        run.table("summary_measurement_source", S.source_profile(reg["measurement"]))
        if ingredients:
            run.table("summary_ingredient_route", S.ingredient_route_profile(t["drug_exposure"], ca, c, ingredients))
        marks = {"person_map": high_watermark(pmap, "id", marks.get("person_map")), "visit_map": high_watermark(vmap, "new_id", marks.get("visit_map"))}
        return run.publish(inputs, marks, params.salt)


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> None:
    from cohortkit.session import local_session

    ap = argparse.ArgumentParser(description="Build the de-identified registry from OMOP parquet tables.")
    ap.add_argument("--input", help="folder with one parquet folder per OMOP table")
    ap.add_argument("--concept-set", help="registry concept-set CSV")
    ap.add_argument("--fixture", help="use the clinical view of a star-schema test folder instead")
    ap.add_argument("--output", required=True)
    ap.add_argument("--salt", help="secret of the date shifts (required, but for --fixture)")
    ap.add_argument("--ingredients", default="", help="comma-separated ingredient concept ids of the route profile")
    ap.add_argument("--previous", help="output folder whose last published run's ids are kept (default: --output)")
    ap.add_argument("--multiplicity", choices=("reference", "weighted", "distinct"), default="reference")
    ap.add_argument("--clean-hours", type=float, help="first remove unpublished runs in which nothing was written for so long")
    ap.add_argument("--start", type=_date)
    ap.add_argument("--end", type=_date)
    ap.add_argument("--as-of", type=_date)
    ap.add_argument("--min-count", type=int)
    ap.add_argument("--master", default=None, help="local[N] for a local run; omit under spark-submit")
    a = ap.parse_args(argv)

    cores = re.fullmatch(r"local\[(\d+)\]", a.master or "")
    if a.master and not cores:
        ap.error("--master must be local[N]; on a cluster leave it to spark-submit")
    if not a.fixture and not (a.salt and a.as_of):
        ap.error("--salt and --as-of are required")
    spark = local_session(cores=int(cores[1])) if cores else SparkSession.builder.appName("cohortkit-registry").getOrCreate()
    if a.fixture:
        from cohortkit.sources.fixtures import clinical_view

        tables = clinical_view(spark, a.fixture).as_dict()
        params = FIXTURE_PARAMS
    else:
        from cohortkit.sources.concept_csv import read_concept_set
        from cohortkit.sources.omop import read_tables

        tables = read_tables(spark, a.input)
        tables["concept_set"] = read_concept_set(spark, a.concept_set)
        params = Params()
    over = {k: v for k, v in {
        "salt": a.salt, "deid_start": a.start, "deid_end": a.end, "as_of": a.as_of, "min_count": a.min_count,
    }.items() if v is not None}
    params = params.with_(**over)
    previous = last_published(spark, a.previous or a.output)
    if a.previous and previous is None:
        ap.error(f"no run is published under {a.previous}")
    if a.clean_hours is not None:
        for name in remove_unpublished(spark, a.output, a.clean_hours * 3600):
            print(f"removed\t{name}")
    ingredients = tuple(int(x) for x in a.ingredients.split(",") if x.strip())
    manifest = run_registry(spark, tables, params, a.output, a.multiplicity, ingredients, previous)
    for name, path in manifest.tables.items():
        print(f"{name}\t{manifest.rows[name]}\t{path}")
    for name, rows in manifest.quarantined.items():
        print(f"quarantined\t{rows}\t{name}")


if __name__ == "__main__":
    main()
