"""DuckDB oracle text for every registered query.

every cohort row and filtered, the revised concept is the least of its candidates, percentiles are
places in a sorted list of all persons' counts. The Spark operators compute the same by rewrites
(coverage counts, per-concept maps, histograms). Parameters are the fixture's (FIXTURES.md §2).
"""

from __future__ import annotations

from cohortkit.functions.keyed import sql_keyed_uint
from cohortkit.oracle.views import with_views
from cohortkit.params import FIXTURE_PARAMS, Params
from cohortkit.schemas import COLUMNS
from cohortkit.sources.omop import SOURCE_COLUMNS


def _d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def _ints(xs) -> str:
    return ", ".join(str(int(x)) for x in xs)


SUPPRESS = {
    "person": ("person_source_value", "gender_source_value", "race_source_value", "ethnicity_source_value"),
    "measurement": ("measurement_source_value", "unit_source_value", "value_source_value"),
    "drug_exposure": ("drug_source_value", "route_source_value", "dose_unit_source_value"),
    "death": ("cause_source_value",),
    "observation": ("observation_source_value", "unit_source_value", "qualifier_source_value", "value_source_value"),
    "procedure_occurrence": ("procedure_source_value", "modifier_source_value"),
    "condition_occurrence": ("condition_source_value", "condition_status_source_value"),
    "visit_occurrence": ("visit_source_value", "admitted_from_source_value", "discharged_to_source_value"),
    "device_exposure": ("device_source_value", "unit_source_value"),
}


def _cols(table: str, alias: str) -> str:
    sup = SUPPRESS[table]
    return ", ".join(
        f"CAST(NULL AS VARCHAR) AS {c}" if c in sup else f"{alias}.{c}" for c in SOURCE_COLUMNS[table]
    )


def _entries(domain: str) -> str:
    """A row for each registry entry of the domain and concept that it stands for."""
    return f"""SELECT a.descendant_concept_id AS concept_id, s.concept_id AS ancestor_concept_id, s.concept_name
        FROM ck_concept_ancestor a JOIN ck_concept_set s ON s.domain = '{domain}' AND s.concept_id = a.ancestor_concept_id
        WHERE CASE WHEN s.include_descendants THEN TRUE ELSE a.descendant_concept_id = s.concept_id END"""


def _valid_descendants(p: Params) -> str:
    """Valid concepts that have one of the roots above them."""
    return f"""SELECT concept_id FROM ck_concept WHERE invalid_reason IS NULL AND concept_id IN (
        SELECT unnest(list(descendant_concept_id)) FROM ck_concept_ancestor WHERE list_contains([{_ints(p.diagnosis_roots)}], ancestor_concept_id))"""


def cohort_ctes(p: Params = FIXTURE_PARAMS) -> list[tuple[str, str]]:
    """O05-O08. A person's diagnosis days are a list; a visit is taken once for each of them that it follows closely
    enough."""
    first, last = p.window_lo + 1, p.window_hi - 1
    return [
        ("o_dx", f"""SELECT person_id, unnest(list_distinct(list(condition_start_date))) AS diagnosis_date
            FROM ck_condition_occurrence SEMI JOIN ({_valid_descendants(p)}) n ON n.concept_id = condition_concept_id
            WHERE condition_start_date >= {_d(p.study_start)} GROUP BY person_id"""),
        ("o_index", f"""SELECT person_id, visit_occurrence_id, visit_start_date, visit_end_date,
                unnest(list_filter(days, lambda day: visit_start_date - day BETWEEN {first} AND {last})) AS diagnosis_date
            FROM ck_visit_occurrence JOIN (SELECT person_id, list(diagnosis_date) AS days FROM o_dx GROUP BY ALL) USING (person_id)
            WHERE list_contains([{_ints(p.visit_types)}], visit_concept_id) AND visit_start_date >= {_d(p.study_start)}"""),
        ("o_cohort", """SELECT person_id, visit_occurrence_id, visit_start_date, visit_end_date, birth_date, death_date FROM o_index
            JOIN (SELECT person_id, birth_datetime::DATE AS birth_date FROM ck_person) USING (person_id)
            LEFT JOIN (SELECT person_id, death_datetime::DATE AS death_date FROM ck_death) USING (person_id)"""),
    ]


# Concept domain that a table is restricted to, and its concept column.
_DOMAIN = {
    "measurement": ("Measurement", "measurement_concept_id"), "observation": ("Observation", "observation_concept_id"),
    "procedure_occurrence": ("Procedure", "procedure_concept_id"), "condition_occurrence": ("Condition", "condition_concept_id"),
    "device_exposure": ("Device", "device_concept_id"),
}
_ONCE = ("person", "measurement", "observation", "visit_occurrence")  # O11, O12, O15, O18 give sets, the others bags


def extract_ctes(p: Params = FIXTURE_PARAMS, distinct_all: bool = False) -> list[tuple[str, str]]:
    """Each record as often as (cohort row, concept entry) pairs hold for it, or once."""
    near = lambda day: f"datediff('day', k.visit_start_date, {day}) >= -{p.band_days} AND datediff('day', k.visit_end_date, {day}) <= {p.band_days}"
    months = p.observation_months
    holds = {
        "person": "TRUE",
        "death": "TRUE",
        "measurement": near("f.measurement_date"),
        "drug_exposure": near("f.drug_exposure_start_date") + " AND f.drug_concept_id IN (SELECT concept_id FROM ck_concept)",
        "observation": f"f.observation_date >= CAST(k.visit_start_date - to_months({months}) AS DATE) "
                       f"AND f.observation_date <= CAST(k.visit_end_date + to_months({months}) AS DATE)",
        "procedure_occurrence": near("f.procedure_date"),
        "condition_occurrence": "(f.condition_end_date IS NULL OR k.visit_start_date < f.condition_end_date "
                                "OR k.visit_end_date > f.condition_start_date)",
        "visit_occurrence": f"f.visit_occurrence_id = k.visit_occurrence_id AND f.visit_start_date >= {_d(p.extract_visit_start)}",
        "device_exposure": near("f.device_exposure_start_date"),
    }
    out = []
    for table, condition in holds.items():
        domain, concept = _DOMAIN.get(table, (None, None))
        entries = f" JOIN ({_entries(domain)}) e ON e.concept_id = f.{concept}" if domain else ""
        once = "DISTINCT " if distinct_all or table in _ONCE else ""
        out.append((f"o_x_{table}", f"SELECT {once}{_cols(table, 'f')} FROM ck_{table} f JOIN o_cohort k ON k.person_id = f.person_id{entries} "
                                    f"WHERE {condition}"))
    return out


EXTRACT_TABLES = [
    "person", "measurement", "drug_exposure", "death", "observation",
    "procedure_occurrence", "condition_occurrence", "visit_occurrence", "device_exposure",
]


def oracle_queries(p: Params = FIXTURE_PARAMS) -> dict[str, str]:
    base = cohort_ctes(p)
    x = extract_ctes(p)
    xd = [(n.replace("o_x_", "o_xd_"), b) for n, b in extract_ctes(p, distinct_all=True)]
    q: dict[str, str] = {}
    q["concept_descendants"] = with_views(_valid_descendants(p))
    for dom in ["Measurement", "Procedure", "Device", "Condition", "Observation", "Drug"]:
        q[f"concept_expand_{dom.lower()}"] = with_views(_entries(dom))
    q["cohort_events"] = with_views("SELECT * FROM o_dx", *base)
    q["cohort_index_visits"] = with_views(
        "FROM o_index", *base
    )
    order = ("person_id", "visit_occurrence_id", "visit_start_date", "visit_end_date", "birth_date", "death_date")
    q["cohort_preview"] = with_views(
        "SELECT * FROM o_cohort ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in order) + " LIMIT 100", *base)
    q["cohort_build"] = with_views("SELECT * FROM o_cohort", *base)
    q["cohort_attrition"] = with_views(
        " UNION ALL ".join(f"SELECT '{step}' AS step, len(list_distinct(list(person_id))) AS persons, {visits} AS visits, count(*) AS records FROM {table}"
                           for step, table, visits in (
                               ("qualifying_events", "o_dx", "CAST(NULL AS BIGINT)"),
                               ("index_visits", "o_index", "len(list_distinct(list(visit_occurrence_id)))"),
                               ("cohort", "o_cohort", "len(list_distinct(list(visit_occurrence_id)))"))),
        *base,
    )
    for t in EXTRACT_TABLES:
        q[f"extract_{t}"] = with_views(f"SELECT * FROM o_x_{t}", *base, *x)
    for t in ["drug_exposure", "death", "procedure_occurrence", "condition_occurrence", "device_exposure"]:
        q[f"extract_{t}_distinct"] = with_views(f"SELECT * FROM o_xd_{t}", *base, *xd)
    q["extract_condition_occurrence_interval"] = with_views(f"""SELECT {_cols('condition_occurrence', 'f')}
        FROM ck_condition_occurrence f JOIN o_cohort k ON k.person_id = f.person_id JOIN ({_entries('Condition')}) e ON e.concept_id = f.condition_concept_id
        WHERE k.visit_end_date > f.condition_start_date AND coalesce(f.condition_end_date, DATE '9999-12-31') > k.visit_start_date""", *base)
    q.update(generalise_and_deid_queries(p))
    q.update(late_queries(p))
    return q


# ---------------------------------------------------------------- generalisation
def rare_ctes(min_count: int, tag: str) -> list[tuple[str, str]]:
    """Of a concept's ancestors above the limit, the one with the fewest records, then the
    nearest, then the largest id."""
    return [
        (f"o_rollup_counts_{tag}", """SELECT a.ancestor_concept_id, n.concept_name AS ancestor_concept_name,
                count(DISTINCT (x.person_id, x.condition_concept_id, a.min_levels_of_separation))
                    FILTER (a.ancestor_concept_id IS NOT NULL) AS ancestor_concept_count
            FROM o_x_condition_occurrence x
            LEFT JOIN ck_concept_ancestor a ON x.condition_concept_id = a.descendant_concept_id
            LEFT JOIN ck_concept n ON n.concept_id = a.ancestor_concept_id GROUP BY ALL"""),
        (f"o_orig_counts_{tag}", """SELECT x.condition_concept_id AS original_concept_id, n.concept_name AS original_concept_name,
                count(DISTINCT x.person_id) FILTER (x.condition_concept_id IS NOT NULL) AS original_concept_count
            FROM o_x_condition_occurrence x LEFT JOIN ck_concept n ON n.concept_id = x.condition_concept_id GROUP BY ALL"""),
        (f"o_choice_{tag}", f"""SELECT o.*, -b.least.id AS revised_concept_id, n.concept_name AS revised_concept_name,
                b.least.levels AS min_levels_of_separation, b.least.records AS ancestor_concept_count
            FROM o_orig_counts_{tag} o JOIN (
                SELECT a.descendant_concept_id, min({{'records': c.ancestor_concept_count,
                    'levels': a.min_levels_of_separation, 'id': -a.ancestor_concept_id}}) AS least
                FROM ck_concept_ancestor a JOIN o_rollup_counts_{tag} c USING (ancestor_concept_id)
                WHERE c.ancestor_concept_count > {int(min_count)} GROUP BY 1) b ON b.descendant_concept_id = o.original_concept_id
            LEFT JOIN ck_concept n ON n.concept_id = -b.least.id"""),
        (f"o_rare_removed_{tag}", f"""SELECT x.* REPLACE (k.revised_concept_id AS condition_concept_id)
            FROM o_x_condition_occurrence x JOIN o_choice_{tag} k ON k.original_concept_id = x.condition_concept_id"""),
    ]


# ---------------------------------------------------------------- de-identification
# Dates of each table: the columns moved by the person's shift, and the datetimes made from a moved date.
_MOVED = {
    "procedure_occurrence": (["procedure_date"], {"procedure_datetime": "procedure_date"}),
    "drug_exposure": (["drug_exposure_start_date", "drug_exposure_end_date", "verbatim_end_date"],
                      {"drug_exposure_start_datetime": "drug_exposure_start_date", "drug_exposure_end_datetime": "drug_exposure_end_date"}),
    "observation": (["observation_date"], {"observation_datetime": "observation_date"}),
    "death": (["death_date"], {"death_datetime": "death_date"}),
    "device_exposure": (["device_exposure_start_date", "device_exposure_end_date"],
                        {"device_exposure_start_datetime": "device_exposure_start_date", "device_exposure_end_datetime": "device_exposure_end_date"}),
    "measurement": (["measurement_date"], {"measurement_datetime": "measurement_date"}),
}
# First and last day of a record, which must touch the window.
_SPAN = {
    "condition_occurrence": ("condition_start_date", "coalesce(f.condition_end_date, f.condition_start_date)"),
    "device_exposure": ("device_exposure_start_date", "coalesce(f.device_exposure_end_date, f.device_exposure_start_date)"),
    "drug_exposure": ("drug_exposure_start_date", "f.drug_exposure_end_date"),
    "procedure_occurrence": ("procedure_date", "f.procedure_date"),
    "observation": ("observation_date", "f.observation_date"),
    "measurement": ("measurement_date", "f.measurement_date"),
}


def _moved(c: str) -> str:
    return f"(f.{c} + m.date_shift)"


def deid_ctes(p: Params = FIXTURE_PARAMS) -> list[tuple[str, str]]:
    """Key maps, then every table with its rules written as replacements."""
    begin, end = _d(p.deid_start), _d(p.deid_end)
    shift = f"CAST(({sql_keyed_uint(p.salt, 'person_id')}) % {2 * p.max_shift + 1} - {p.max_shift} AS INTEGER)"
    year = f"CAST({p.as_of.year - p.over_age - 1} - ({sql_keyed_uint(p.salt, 'person_id', 'birth_year')}) % 10 AS INTEGER)"
    inside = f"{_moved('visit_start_date')} >= {begin} AND {_moved('visit_end_date')} <= {end}"
    out = [
        ("o_pmap", f"""SELECT person_id AS source_key, {shift} AS date_shift, {year} AS over_89_birth_year,
                row_number() OVER (ORDER BY gender_concept_id DESC, person_id DESC) AS id FROM o_x_person"""),
        ("o_vmap", f"""SELECT f.visit_occurrence_id AS source_key, row_number() OVER (ORDER BY f.visit_occurrence_id) AS new_id
            FROM o_x_visit_occurrence f JOIN o_pmap m ON m.source_key = f.person_id WHERE {inside}"""),
        ("o_born", f"""SELECT f.person_id, m.id, CAST(f.birth_datetime AS DATE) + m.date_shift AS born,
                CASE WHEN datediff('day', f.birth_datetime, {_d(p.as_of)}) > 365.25 * {p.over_age} THEN m.over_89_birth_year
                     ELSE year(CAST(f.birth_datetime AS DATE) + m.date_shift) END AS birth_year
            FROM o_x_person f JOIN o_pmap m ON m.source_key = f.person_id"""),
        ("o_d_person", """SELECT f.* REPLACE (b.id AS person_id, b.birth_year AS year_of_birth, month(b.born) AS month_of_birth, 1 AS day_of_birth,
                CAST(make_date(CAST(b.birth_year AS BIGINT), CAST(month(b.born) AS BIGINT), 1) AS TIMESTAMP) AS birth_datetime,
                1 AS location_id, 1 AS provider_id, 1 AS care_site_id, '0' AS person_source_value, '0' AS gender_source_value,
                0 AS gender_source_concept_id, '0' AS race_source_value, 0 AS race_source_concept_id,
                '0' AS ethnicity_source_value, 0 AS ethnicity_source_concept_id)
            FROM o_x_person f JOIN o_born b USING (person_id)"""),
        ("o_d_visit_occurrence", f"""SELECT f.* REPLACE (v.new_id AS visit_occurrence_id, m.id AS person_id, 1 AS provider_id, 1 AS care_site_id,
                {_moved('visit_start_date')} AS visit_start_date, {_moved('visit_end_date')} AS visit_end_date,
                f.visit_start_datetime + to_days(CAST(m.date_shift AS BIGINT)) AS visit_start_datetime,
                f.visit_end_datetime + to_days(CAST(m.date_shift AS BIGINT)) AS visit_end_datetime,
                CAST(NULL AS VARCHAR) AS visit_source_value, CAST(NULL AS VARCHAR) AS admitted_from_source_value,
                CAST(NULL AS VARCHAR) AS discharged_to_source_value)
            FROM o_x_visit_occurrence f JOIN o_pmap m ON m.source_key = f.person_id
            LEFT JOIN o_vmap v ON v.source_key = f.visit_occurrence_id WHERE {inside}"""),
    ]
    for table, (days, rebuilt) in {**_MOVED, "condition_occurrence": (["condition_start_date", "condition_end_date"], {})}.items():
        new = ["m.id AS person_id", *(f"{_moved(c)} AS {c}" for c in days), *(f"CAST({_moved(d)} AS TIMESTAMP) AS {c}" for c, d in rebuilt.items())]
        source, visits = f"o_x_{table}", ""
        if table == "condition_occurrence":
            source = f"o_rare_removed_m{p.min_count}"
            new += [f"f.{c} + to_days(CAST(m.date_shift AS BIGINT)) AS {c}" for c in ("condition_start_datetime", "condition_end_datetime")]
        if table != "death":
            new += ["1 AS provider_id", "v.new_id AS visit_occurrence_id"]
            visits = "LEFT JOIN o_vmap v ON v.source_key = f.visit_occurrence_id"
        first, last = _SPAN.get(table, (None, None))
        touches = f"WHERE {_moved(first)} < {end} AND {last} + m.date_shift > {begin}" if first else ""
        contract = {name for name, *_ in COLUMNS[table]}
        outside = [c for c in SOURCE_COLUMNS[table] if c not in contract]
        star = f"f.* EXCLUDE ({', '.join(outside)})" if outside else "f.*"
        out.append((f"o_d_{table}", f"SELECT {star} REPLACE ({', '.join(new)}) FROM {source} f JOIN o_pmap m ON m.source_key = f.person_id {visits} {touches}"))
    return out


DEID_TABLES = ["person", "visit_occurrence", "condition_occurrence", "procedure_occurrence", "drug_exposure",
               "observation", "death", "device_exposure", "measurement"]


def pipeline_ctes(p: Params = FIXTURE_PARAMS) -> list[tuple[str, str]]:
    """Cohort -> extracts -> generalisation (min_count 10 and 25) -> key maps -> deid tables."""
    return [*cohort_ctes(p), *extract_ctes(p), *rare_ctes(10, "m10"), *rare_ctes(25, "m25"), *deid_ctes(p)]


def generalise_and_deid_queries(p: Params = FIXTURE_PARAMS) -> dict[str, str]:
    ctes = pipeline_ctes(p)
    q: dict[str, str] = {}
    for m in (10, 25):
        tag = f"m{m}"
        q[f"rare_ancestor_counts_{tag}"] = with_views(f"SELECT * FROM o_rollup_counts_{tag}", *ctes)
        q[f"rare_map_{tag}"] = with_views(
            f"""SELECT DISTINCT original_concept_id, original_concept_name, original_concept_count, revised_concept_id,
                   revised_concept_name, min_levels_of_separation, ancestor_concept_count FROM o_choice_{tag}""",
            *ctes,
        )
        q[f"rare_rewrite_{tag}"] = with_views(f"SELECT * FROM o_rare_removed_{tag}", *ctes)
    q["rare_dropped_m10"] = with_views("""SELECT x.condition_concept_id, count(*) AS dropped_records FROM o_x_condition_occurrence x
        WHERE NOT EXISTS (FROM o_choice_m10 k WHERE k.original_concept_id = x.condition_concept_id) GROUP BY ALL""", *ctes)
    q["rare_concept_counts"] = with_views("SELECT * FROM o_orig_counts_m10", *ctes)
    q["deid_person_map"] = with_views("SELECT * FROM o_pmap", *ctes)
    q["deid_visit_map"] = with_views("SELECT * FROM o_vmap", *ctes)
    for t in DEID_TABLES:
        q[f"deid_{t}"] = with_views(f"SELECT * FROM o_d_{t}", *ctes)
    return q


# ---------------------------------------------------------------- quality checks
QC_CONCEPT = {
    "observation": "observation_concept_id", "procedure_occurrence": "procedure_concept_id",
    "condition_occurrence": "condition_concept_id", "measurement": "measurement_concept_id",
    "device_exposure": "device_concept_id", "drug_exposure": "drug_concept_id",
}
QC_RANGE = {
    "observation": ("observation_date", "observation_date"),
    "procedure_occurrence": ("procedure_date", "procedure_date"),
    "condition_occurrence": ("COALESCE(condition_end_date, condition_start_date)", "condition_start_date"),
    "measurement": ("measurement_date", "measurement_date"),
    "device_exposure": ("COALESCE(device_exposure_end_date, device_exposure_start_date)", "device_exposure_start_date"),
    "drug_exposure": ("drug_exposure_end_date", "drug_exposure_start_date"),
}


def qc_queries(ctes, p: Params = FIXTURE_PARAMS) -> dict[str, str]:
    q = {
        "qc_persons": with_views("""SELECT COUNT(DISTINCT person_id) AS num_people, MAX(birth_datetime) AS max_birthday,
            MIN(birth_datetime) AS min_birthday FROM o_d_person""", *ctes),
        "qc_deaths": with_views("SELECT COUNT(DISTINCT person_id) AS num_people FROM o_d_death", *ctes),
        "qc_ranges": with_views(" UNION ALL ".join(
            f"SELECT '{t}' AS table_name, MAX({mx}) AS max_date, MIN({mn}) AS min_date FROM o_d_{t}"
            for t, (mx, mn) in QC_RANGE.items()), *ctes),
    }
    rows = [
        "SELECT 'person' AS table_name, 'persons' AS check, CAST(COUNT(DISTINCT person_id) AS VARCHAR) AS value, "
        "COUNT(DISTINCT person_id) > 0 AS passed FROM o_d_person",
        f"SELECT 'person', 'min_birth_within_{99}_years', CAST(MIN(birth_datetime) AS VARCHAR), "
        f"MIN(birth_datetime) >= TIMESTAMP '{p.as_of.year - 100}-01-01 00:00:00' FROM o_d_person",
        "SELECT 'death', 'persons', CAST(COUNT(DISTINCT person_id) AS VARCHAR), TRUE FROM o_d_death",
    ]
    for t, (mx, mn) in QC_RANGE.items():
        rows.append(f"SELECT '{t}', 'max_date_in_window', CAST(MAX({mx}) AS VARCHAR), "
                    f"COALESCE(MAX({mx}) <= {_d(p.deid_end)}, TRUE) FROM o_d_{t}")
        rows.append(f"SELECT '{t}', 'min_date_in_window', CAST(MIN({mn}) AS VARCHAR), "
                    f"COALESCE(MIN({mn}) >= {_d(p.deid_start)}, TRUE) FROM o_d_{t}")
    q["qc_report"] = with_views(" UNION ALL ".join(rows), *ctes)
    for t, c in QC_CONCEPT.items():
        q[f"qc_concepts_{t}"] = with_views(
            f"SELECT {c}, COUNT(DISTINCT person_id) AS num_people, COUNT(*) AS num_records FROM o_d_{t} GROUP BY {c}", *ctes
        )
    return q


# ---------------------------------------------------------------- profiles
# The persons of each concept that was diagnosed.
_PATIENTS = "SELECT condition_concept_id AS own, list(DISTINCT person_id) AS people FROM o_d_condition_occurrence GROUP BY ALL"
_ALL_PERSONS = "(SELECT len(list_distinct(list(person_id))) FROM o_d_person)"


def _people(lists: str) -> str:
    """How many persons some lists hold together."""
    return f"len(list_distinct(flatten(list({lists}))))"


def _sentence_sql() -> str:
    v = lambda c: f"CAST({c} AS VARCHAR)"
    return f"""CASE WHEN median = 0
            THEN concat('At least half of the patients have no record of this measurement; 5% have ', {v('percentile_95')}, ' or more records.')
            ELSE concat('Half of the patients have ', {v('median')}, ' or more records; the middle half have ', {v('percentile_25')},
                        ' to ', {v('percentile_75')}, '; 5% have ', {v('percentile_95')}, ' or more.') END"""


def drug_profile_ctes(src: str, tag: str) -> list[tuple[str, str]]:
    """O52-O57 over the drug table ``src``."""
    return [
        (f"o_given{tag}", f"SELECT DISTINCT n.concept_id, n.concept_name FROM (SELECT DISTINCT drug_concept_id FROM {src}) d "
                          "LEFT JOIN ck_concept n ON n.concept_id = d.drug_concept_id"),
        (f"o_ingredient{tag}", f"""SELECT g.concept_id AS drug_concept_id, g.concept_name AS drug_concept_name,
                i.concept_id AS ingredient_concept_id, i.concept_name AS ingredient_name
            FROM o_given{tag} g, ck_concept i
            WHERE i.concept_class_id = 'Ingredient' AND EXISTS (FROM ck_concept_ancestor a
                WHERE a.descendant_concept_id = g.concept_id AND a.ancestor_concept_id = i.concept_id)"""),
        (f"o_doses{tag}", f"""SELECT d.person_id, i.ingredient_concept_id, i.ingredient_name, count(i.ingredient_concept_id) AS n
            FROM {src} d LEFT JOIN o_ingredient{tag} i USING (drug_concept_id) GROUP BY ALL"""),
        (f"o_used{tag}", f"""SELECT ingredient_name, ingredient_concept_id, count(person_id) AS person_count,
                100 * count(person_id) // (SELECT count(DISTINCT person_id) FROM {src}) AS person_perc,
                sum(n) // count(*) AS average_admin_per_person, max(n) AS max_admin_per_person
            FROM o_doses{tag} GROUP BY ALL"""),
    ]


def profile_ctes() -> list[tuple[str, str]]:
    out = [*drug_profile_ctes("o_d_drug_exposure", ""), *drug_profile_ctes("o_x_drug_exposure", "_x")]
    for tag, domain, table, concept, grain in (
            ("m", "Measurement", "o_d_measurement", "measurement_concept_id", "ancestor_concept_id"),
            ("d", "Device", "o_d_device_exposure", "device_concept_id", "concept_id")):
        out += [
            (f"o_{tag}entry", _entries(domain)),
            (f"o_{tag}cell", f"""SELECT e.{grain} AS concept_id, e.concept_name, f.person_id, count(*) AS concept_count
                FROM o_{tag}entry e JOIN {table} f ON f.{concept} = e.concept_id
                WHERE f.person_id IN (SELECT person_id FROM o_d_person) GROUP BY ALL"""),
            # every person's count, in order: the k-th of the list is the value of rank k
            (f"o_{tag}list", f"""SELECT e.concept_id, e.concept_name, list_sort(list(coalesce(c.concept_count, 0))) AS counts
                FROM (SELECT DISTINCT {grain} AS concept_id, concept_name FROM o_{tag}entry) e
                CROSS JOIN (SELECT DISTINCT person_id FROM o_d_person) p
                LEFT JOIN o_{tag}cell c ON c.person_id = p.person_id AND c.concept_id = e.concept_id AND c.concept_name IS NOT DISTINCT FROM e.concept_name
                GROUP BY ALL"""),
        ]
    return out


def _grid_sql(tag: str) -> str:
    return f"""SELECT person_id, concept_id, concept_name, concept_count, 1 AS persons FROM o_{tag}cell
        UNION ALL SELECT NULL, concept_id, concept_name, 0, len(list_filter(counts, lambda n: n = 0)) FROM o_{tag}list WHERE list_contains(counts, 0)"""


def _percentiles_sql(names: dict[int, str]) -> str:
    n = "(SELECT count(person_id) FROM o_d_person)"
    cols = ", ".join(f"counts[{q} * {n} // 100] AS {name}" for q, name in names.items())
    return f"SELECT concept_id, concept_name, {cols} FROM o_mlist"


def profile_queries(ctes, p: Params = FIXTURE_PARAMS) -> dict[str, str]:
    q = {}
    q["profile_condition_observed"] = with_views(f"""SELECT (SELECT concept_name FROM ck_concept n WHERE n.concept_id = id) AS condition_name,
            id AS ancestor_concept_id, persons AS persons_with_condition_or_descendant, 100 * persons // {_ALL_PERSONS} AS percent_persons_with_condition
        FROM (SELECT up.own AS id, {_people('o.people')} AS persons
              FROM ({_PATIENTS}) up JOIN ck_concept_ancestor a ON a.ancestor_concept_id = up.own JOIN ({_PATIENTS}) o ON o.own = a.descendant_concept_id
              GROUP BY ALL)""", *ctes)
    q["profile_condition_registry"] = with_views(f"""SELECT concept_name AS condition_name, ancestor_concept_id, persons AS persons_with_condition,
            100 * persons // {_ALL_PERSONS} AS percent_persons_with_condition
        FROM (SELECT e.concept_name, e.ancestor_concept_id, {_people('o.people')} AS persons
              FROM ({_entries('Condition')}) e JOIN ({_PATIENTS}) o ON o.own = e.concept_id GROUP BY ALL)""", *ctes)
    q["profile_measurement_grid"] = with_views(_grid_sql("m"), *ctes)
    q["profile_measurement_rank"] = with_views("""SELECT concept_name, concept_id, concept_count, min(place) AS lo, max(place) AS hi
        FROM (SELECT concept_name, concept_id, unnest(counts) AS concept_count, generate_subscripts(counts, 1) AS place FROM o_mlist)
        GROUP BY ALL""", *ctes)
    q["profile_measurement_percentiles"] = with_views(
        f"SELECT DISTINCT * EXCLUDE (concept_name) FROM ({_percentiles_sql({25: 'p25', 50: 'p50', 75: 'p75', 95: 'p95'})})", *ctes)
    q["profile_measurement_report"] = with_views(
        f"SELECT *, {_sentence_sql()} AS interpretation FROM "
        f"({_percentiles_sql({25: 'percentile_25', 50: 'median', 75: 'percentile_75', 95: 'percentile_95'})})", *ctes)
    q["profile_drugs_given"] = with_views("FROM o_given", *ctes)
    q["profile_ingredient_map"] = with_views("FROM o_ingredient", *ctes)
    q["profile_ingredient_use"] = with_views("SELECT ingredient_name, ingredient_concept_id, person_count, person_perc FROM o_used", *ctes)
    q["profile_ingredient_intensity"] = with_views(
        "SELECT ingredient_name, ingredient_concept_id, average_admin_per_person, max_admin_per_person FROM o_used", *ctes)
    by_id = """SELECT u.ingredient_name, u.ingredient_concept_id, u.person_count, u.person_perc,
            CASE WHEN u.ingredient_concept_id IS NOT NULL THEN u.average_admin_per_person END AS average_admin_per_person,
            CASE WHEN u.ingredient_concept_id IS NOT NULL THEN u.max_admin_per_person END AS max_admin_per_person FROM o_used{} u"""
    q["profile_ingredient"] = with_views(by_id.format(""), *ctes)
    q["summary_mapped_drug_profile"] = with_views(by_id.format("_x"), *ctes)
    q["profile_unmapped_drugs"] = with_views(f"""SELECT drug_source_value, sum(times)::BIGINT AS unmapped_drug_count
        FROM (SELECT d.drug_source_value, greatest(1, len(list_filter(coalesce(stays, []),
                     lambda s: s.a <= d.drug_exposure_start_date AND d.drug_exposure_start_date <= s.b))) AS times
              FROM ck_drug_exposure d LEFT JOIN (
                  SELECT person_id, list({{'a': visit_start_date, 'b': visit_end_date}}) AS stays FROM o_x_visit_occurrence GROUP BY ALL) USING (person_id)
              WHERE d.drug_concept_id = 0 AND d.drug_source_value IS NOT NULL)
        GROUP BY ALL HAVING sum(times) > {p.unmapped_min_count}""", *ctes)
    per_device = """SELECT e.concept_name, e.concept_id, count(DISTINCT f.person_id) AS person_count,
            100 * count(DISTINCT f.person_id) // (SELECT count(DISTINCT person_id) FROM o_d_person) AS person_perc
        FROM o_dentry e LEFT JOIN o_d_device_exposure f ON f.device_concept_id = e.concept_id GROUP BY ALL"""
    per_user = """SELECT concept_name, concept_id, sum(concept_count) // count(*) AS average_entries_per_person,
            max(concept_count) AS max_entries_per_person FROM o_dcell GROUP BY ALL"""
    q["profile_device_grid"] = with_views(_grid_sql("d"), *ctes)
    q["profile_device_use"] = with_views(per_device, *ctes)
    q["profile_device_intensity"] = with_views(per_user, *ctes)
    q["profile_device"] = with_views(f"""SELECT u.*, i.average_entries_per_person, i.max_entries_per_person
        FROM ({per_device}) u LEFT JOIN ({per_user}) i USING (concept_id)""", *ctes)
    return q


# ---------------------------------------------------------------- summary statistics
def _share_sql(n: str, of: str) -> str:
    """n / of in percent, rounded half-up to two decimals on the exact ratio."""
    return f"((20000 * {n} + {of}) // (2 * {of})) / 100.0"


def _ancestor_profile_sql(table: str, concept_col: str, source_col: str, mean_name: str) -> str:
    """A record counts for each ancestor of its concept, or for the concept if it has none."""
    people = f"(SELECT count(DISTINCT person_id) FROM {table})"
    return f"""SELECT concept_id, concept_name, {source_col}, count(DISTINCT person_id) AS unique_person_count,
               {_share_sql('count(DISTINCT person_id)', people)} AS percent_of_persons, count(*) / count(DISTINCT person_id) AS {mean_name}
        FROM (SELECT f.person_id, f.{source_col}, a.id AS concept_id,
                     coalesce((SELECT concept_name FROM ck_concept WHERE concept_id = a.id), (SELECT concept_name FROM ck_concept WHERE concept_id = f.{concept_col}),
                              f.{source_col}) AS concept_name
              FROM {table} f JOIN (
                  SELECT descendant_concept_id AS own, ancestor_concept_id AS id FROM ck_concept_ancestor
                  UNION ALL SELECT DISTINCT {concept_col}, {concept_col} FROM {table}
                  WHERE NOT EXISTS (FROM ck_concept_ancestor WHERE descendant_concept_id = {concept_col})) a
                ON a.own IS NOT DISTINCT FROM f.{concept_col})
        GROUP BY ALL"""


def summary_ctes() -> list[tuple[str, str]]:
    middle = "quantile_cont({}, {})".format
    share = """SELECT n.concept_name AS {0}, count(*) AS count, 100.0 * count(*) / sum(count(*)) OVER () AS percent
        FROM o_demo JOIN ck_concept n ON n.concept_id = {0}_concept_id GROUP BY 1""".format
    return [
        ("o_first", "SELECT person_id, arg_min(visit_start_date, visit_start_date) AS first_visit_date FROM o_cohort GROUP BY ALL"),
        ("o_demo", """SELECT person_id, gender_concept_id, race_concept_id, ethnicity_concept_id, year_of_birth,
                year(first_visit_date) - year_of_birth AS age_at_first_visit FROM o_x_person JOIN o_first USING (person_id)"""),
        ("o_cause", """SELECT person_id, death_date, cause_source_value,
                (SELECT concept_name FROM ck_concept WHERE concept_id = cause_concept_id) AS cause_of_death FROM o_x_death"""),
        ("o_stay", """SELECT person_id, visit_end_date - visit_start_date AS length_of_stay
            FROM o_cohort WHERE (person_id, visit_start_date) IN (SELECT person_id, first_visit_date FROM o_first)"""),
        ("o_age_sum", f"""SELECT avg(age_at_first_visit) AS mean_age, {middle('age_at_first_visit', .5)} AS median_age,
                min(age_at_first_visit) AS min_age, max(age_at_first_visit) AS max_age, stddev_samp(age_at_first_visit) AS age_sd FROM o_demo"""),
        ("o_race", share("race")),
        ("o_eth", share("ethnicity")),
        ("o_death_sum", """SELECT count(*) AS total_deaths, count(DISTINCT cause_of_death) AS causes_of_death,
                count(DISTINCT cause_source_value) AS causes_source_value FROM o_cause"""),
        ("o_stay_sum", f"SELECT {middle('length_of_stay', .5)} AS median_los, {middle('length_of_stay', .25)} AS iqr_los_25, "
                       f"{middle('length_of_stay', .75)} AS iqr_los_75 FROM o_stay"),
    ]


FIXTURE_INGREDIENTS = tuple(range(20101, 20111)) + tuple(range(30101, 30106))


def summary_queries(ctes) -> dict[str, str]:
    r = lambda x: f"printf('%.4f', CAST({x} AS DOUBLE))"
    i = lambda x: f"CAST(CAST({x} AS BIGINT) AS VARCHAR)"
    n = "CAST(NULL AS VARCHAR)"
    q = {}
    q["summary_ingredient_route"] = with_views(f"""SELECT n.concept_id AS ingredient_concept_id, n.concept_name AS ingredient_name,
            d.route_source_value, d.drug_source_value, {_people('d.people')} AS patient_count
        FROM (SELECT drug_concept_id, route_source_value, drug_source_value, list(DISTINCT person_id) AS people FROM ck_drug_exposure GROUP BY ALL) d
        JOIN ck_concept_ancestor a ON a.descendant_concept_id = d.drug_concept_id
        JOIN (FROM ck_concept WHERE concept_class_id = 'Ingredient' AND list_contains([{_ints(FIXTURE_INGREDIENTS)}], concept_id)) n
          ON n.concept_id = a.ancestor_concept_id
        GROUP BY ALL""", *ctes)
    people = "(SELECT count(DISTINCT person_id) FROM ck_measurement)"
    q["summary_measurement_source"] = with_views(f"""SELECT measurement_concept_id, measurement_source_value,
            count(DISTINCT person_id) AS unique_person_count, {_share_sql('count(DISTINCT person_id)', people)} AS percent_of_persons,
            count(*) / count(DISTINCT person_id) AS mean_measurements_per_patient
        FROM ck_measurement GROUP BY ALL""", *ctes)
    q["summary_condition_ancestor"] = with_views(
        "SELECT * FROM (" + _ancestor_profile_sql("ck_condition_occurrence", "condition_concept_id", "condition_source_value",
                                                  "mean_conditions_per_patient") + ") s", *ctes)
    q["summary_device_ancestor"] = with_views(
        "SELECT * FROM (" + _ancestor_profile_sql("ck_device_exposure", "device_concept_id", "device_source_value",
                                                  "mean_devices_per_patient") + ") s", *ctes)
    q["summary_first_visit"] = with_views("SELECT * FROM o_first", *ctes)
    q["summary_age_rows"] = with_views("SELECT person_id, age_at_first_visit FROM o_demo", *ctes)
    q["summary_demographics"] = with_views("SELECT * FROM o_demo", *ctes)
    q["summary_death_info"] = with_views("FROM o_cause", *ctes)
    q["summary_stay_rows"] = with_views("FROM o_stay", *ctes)
    q["summary_age"] = with_views("SELECT * FROM o_age_sum", *ctes)
    q["summary_race"] = with_views("SELECT * FROM o_race", *ctes)
    q["summary_ethnicity"] = with_views("SELECT * FROM o_eth", *ctes)
    q["summary_deaths"] = with_views("SELECT * FROM o_death_sum", *ctes)
    q["summary_stay"] = with_views("FROM o_stay_sum", *ctes)
    four = lambda part, of, scale: r(f"(({20000 * scale} * {part} + {of}) // (2 * {of})) / 10000.0")
    age = "(SELECT {} FROM o_demo)".format
    lines = [(["Age Summary", None], {"mean": four(age("sum(age_at_first_visit)"), age("count(age_at_first_visit)"), 1), "median": r("median_age"),
                                      "min": i("min_age"), "max": i("max_age"), "standard_deviation": r("age_sd")}, "o_age_sum")]
    for section, column, table in (("Race Summary", "race", "o_race"), ("Ethnicity Summary", "ethnicity", "o_eth")):
        lines.append(([section, column], {"count": i("count"), "percent": four("count", f"(SELECT sum(count) FROM {table})", 100)}, table))
    for label, column in (("Total Deaths", "total_deaths"), ("Causes of Death", "causes_of_death"), ("Cause Source Values", "causes_source_value")):
        lines.append((["Death Summary", f"'{label}'"], {"count": i(column)}, "o_death_sum"))
    lines.append((["Length of Stay Summary", "'Median Length of Stay (days)'"],
                  {"median": r("median_los"), "min": r("iqr_los_25"), "max": r("iqr_los_75")}, "o_stay_sum"))
    fields = ["mean", "median", "min", "max", "standard_deviation", "count", "percent"]
    q["summary_report"] = with_views(" UNION ALL ".join(
        f"SELECT '{section}' AS section, {category or n} AS category, " + ", ".join(f"{values.get(c, n)} AS {c}" for c in fields) + f" FROM {table}"
        for (section, category), values, table in lines), *ctes)
    return q


# ---------------------------------------------------------------- contract
def contract_query(ctes) -> str:
    parts = []
    for t in EXTRACT_TABLES:
        have = set(SOURCE_COLUMNS[t])
        checks = []
        for name, _typ, not_null, max_len in COLUMNS[t]:
            if name not in have:
                continue
            if not_null:
                checks.append((name, "not_null", f"SUM(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END)"))
            if max_len is not None:
                checks.append((name, f"max_length_{max_len}", f"SUM(CASE WHEN length({name}) > {max_len} THEN 1 ELSE 0 END)"))
        for name, rule, expr in checks:
            parts.append(f"SELECT '{t}' AS table_name, '{name}' AS column_name, '{rule}' AS rule, "
                         f"CAST(COALESCE({expr}, 0) AS BIGINT) AS violations FROM o_x_{t}")
    return with_views(" UNION ALL ".join(parts), *ctes)


def late_queries(p: Params = FIXTURE_PARAMS) -> dict[str, str]:
    ctes = [*pipeline_ctes(p), *profile_ctes(), *summary_ctes()]
    q = {}
    q.update(qc_queries(ctes, p))
    q.update(profile_queries(ctes, p))
    q.update(summary_queries(ctes))
    q["contract_violations"] = contract_query(ctes)
    return q
