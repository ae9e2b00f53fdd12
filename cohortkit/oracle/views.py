"""DuckDB text of the clinical fixture view (FIXTURES.md §2), written independently of the
Spark builders in ``cohortkit.sources.fixtures``. Each oracle query is ``WITH <views> <query>``
over the driver's pre-registered tables (part, orders, lineitem, customer, nation, region)."""

from __future__ import annotations

import re

# Views in dependency order. Names are prefixed ``ck_`` so they never shadow a driver table.
VIEWS: list[tuple[str, str]] = [
    (
        "ck_part",
        """
        SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_type, p_brand,
               CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                           WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END AS t,
               CAST(substr(p_brand, 7) AS INTEGER) AS b,
               CAST(p_size AS INTEGER) AS s,
               CASE p_type WHEN 'ECONOMY' THEN 'Drug' WHEN 'LARGE' THEN 'Procedure' WHEN 'MEDIUM' THEN 'Measurement'
                           WHEN 'PROMO' THEN 'Observation' WHEN 'SMALL' THEN 'Device' WHEN 'STANDARD' THEN 'Condition' END AS domain
        FROM part""",
    ),
    (
        "ck_concept",
        """
        SELECT 1000000 + p_partkey AS concept_id, p_name AS concept_name, domain AS domain_id,
               CASE WHEN t = 1 THEN 'Clinical Drug' ELSE 'Leaf' END AS concept_class_id,
               CASE WHEN s = 50 THEN 'D' END AS invalid_reason
        FROM ck_part
        UNION ALL
        SELECT DISTINCT CAST(20000 + 100 * t + b AS BIGINT), p_type || ' ' || p_brand, domain,
               CASE WHEN t = 1 THEN 'Ingredient' ELSE 'Group' END, CAST(NULL AS VARCHAR)
        FROM ck_part
        UNION ALL
        SELECT DISTINCT CAST(30000 + 100 * t + s AS BIGINT), p_type || ' size ' || CAST(s AS VARCHAR), domain,
               CASE WHEN t = 1 AND s <= 5 THEN 'Ingredient' ELSE 'Group' END, CAST(NULL AS VARCHAR)
        FROM ck_part
        UNION ALL
        SELECT DISTINCT CAST(10000 + t AS BIGINT), p_type, domain, 'Root', CAST(NULL AS VARCHAR) FROM ck_part
        UNION ALL
        SELECT CAST(8000 + r_regionkey AS BIGINT), r_name, 'Race', 'Race', CAST(NULL AS VARCHAR) FROM region
        UNION ALL
        SELECT CAST(0 AS BIGINT), 'No matching concept', 'Metadata', 'Undefined', CAST(NULL AS VARCHAR)
        UNION ALL
        SELECT CAST(38003564 AS BIGINT), 'Not Hispanic or Latino', 'Ethnicity', 'Ethnicity', CAST(NULL AS VARCHAR)""",
    ),
    (
        "ck_concept_ancestor",
        """
        SELECT DISTINCT ancestor_concept_id, descendant_concept_id, min_levels_of_separation FROM (
            SELECT 1000000 + p_partkey AS ancestor_concept_id, 1000000 + p_partkey AS descendant_concept_id, 0 AS min_levels_of_separation FROM ck_part
            UNION ALL SELECT 20000 + 100 * t + b, 20000 + 100 * t + b, 0 FROM ck_part
            UNION ALL SELECT 30000 + 100 * t + s, 30000 + 100 * t + s, 0 FROM ck_part
            UNION ALL SELECT 10000 + t, 10000 + t, 0 FROM ck_part
            UNION ALL SELECT 20000 + 100 * t + b, 1000000 + p_partkey, 1 FROM ck_part
            UNION ALL SELECT 30000 + 100 * t + s, 1000000 + p_partkey, 1 FROM ck_part
            UNION ALL SELECT 10000 + t, 1000000 + p_partkey, 2 FROM ck_part
            UNION ALL SELECT 10000 + t, 20000 + 100 * t + b, 1 FROM ck_part
            UNION ALL SELECT 10000 + t, 30000 + 100 * t + s, 1 FROM ck_part
        ) e""",
    ),
    (
        "ck_concept_set",
        """
        SELECT concept_id, CAST(concept_id AS VARCHAR) AS concept_code, concept_name, domain_id AS domain,
               'Fixture' AS vocabulary, 'S' AS is_standard,
               concept_class_id NOT IN ('Leaf', 'Clinical Drug') AS include_descendants
        FROM ck_concept
        WHERE (concept_id BETWEEN 20100 AND 20699 AND concept_id % 100 <= 8)
           OR (concept_id BETWEEN 30100 AND 30699 AND concept_id % 100 <= 5)
           OR concept_id IN (10003, 10005)
           OR (concept_class_id IN ('Leaf', 'Clinical Drug') AND (concept_id - 1000000) % 7 = 0)""",
    ),
    (
        "ck_person",
        """
        SELECT person_id, CASE WHEN person_id % 2 = 0 THEN 8507 ELSE 8532 END AS gender_concept_id,
               year(birth) AS year_of_birth, month(birth) AS month_of_birth, day(birth) AS day_of_birth,
               CAST(birth AS TIMESTAMP) AS birth_datetime,
               CAST(8000 + n_regionkey AS INTEGER) AS race_concept_id,
               CASE WHEN person_id % 4 = 0 THEN 38003563 ELSE 38003564 END AS ethnicity_concept_id,
               CAST(c_nationkey AS BIGINT) AS location_id, CAST(NULL AS BIGINT) AS provider_id,
               CAST(NULL AS BIGINT) AS care_site_id, c_name AS person_source_value,
               CASE WHEN person_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender_source_value,
               0 AS gender_source_concept_id, n_name AS race_source_value, 0 AS race_source_concept_id,
               c_mktsegment AS ethnicity_source_value, 0 AS ethnicity_source_concept_id
        FROM (
            SELECT c.*, n.*, CAST(c_custkey AS BIGINT) AS person_id,
                   make_date(CAST(1900 + (7 * c_custkey) % 100 AS BIGINT), CAST(1 + c_custkey % 12 AS BIGINT), CAST(1 + c_custkey % 28 AS BIGINT)) AS birth
            FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        ) x""",
    ),
    (
        "ck_visit_occurrence",
        """
        SELECT CAST(o_orderkey AS BIGINT) AS visit_occurrence_id, CAST(o_custkey AS BIGINT) AS person_id,
               CASE o_orderstatus WHEN 'F' THEN 9201 WHEN 'P' THEN 262 ELSE 9202 END AS visit_concept_id,
               vs AS visit_start_date, CAST(vs AS TIMESTAMP) AS visit_start_datetime,
               ve AS visit_end_date, CAST(ve AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS visit_end_datetime,
               32817 AS visit_type_concept_id, CAST(NULL AS BIGINT) AS provider_id, CAST(NULL AS BIGINT) AS care_site_id,
               o_orderpriority AS visit_source_value, 0 AS visit_source_concept_id, 0 AS admitted_from_concept_id,
               'home' AS admitted_from_source_value, 0 AS discharged_to_concept_id, 'home' AS discharged_to_source_value,
               CAST(NULL AS BIGINT) AS preceding_visit_occurrence_id
        FROM (SELECT *, CAST(o_orderdate AS DATE) AS vs, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 AS INTEGER) AS ve FROM orders) o""",
    ),
    (
        "ck_events",
        """
        SELECT rid, pid, vid, cid, src, sd, ed, val, t, qty, ln, route,
               CAST(sd AS TIMESTAMP) + to_hours(hrs) AS sdt,
               CAST(ed AS TIMESTAMP) + to_hours(hrs) AS edt
        FROM (
            SELECT CAST((((l_orderkey * 10 + l_linenumber) * 20000 + l_partkey) * 1000 + l_suppkey) AS BIGINT) AS rid,
                   CAST(o_custkey AS BIGINT) AS pid, CAST(o_orderkey AS BIGINT) AS vid,
                   CASE WHEN l_returnflag = 'R' AND l_linenumber <= 3 THEN CAST(0 AS BIGINT) ELSE 1000000 + p.p_partkey END AS cid,
                   p.p_name AS src,
                   CAST(o_orderdate AS DATE) + CAST(3 * l_linenumber - 4 AS INTEGER) AS sd,
                   CASE WHEN l_linestatus = 'O' THEN CAST(NULL AS DATE)
                        ELSE CAST(o_orderdate AS DATE) + CAST(3 * l_linenumber - 4 AS INTEGER)
                             + CAST(CAST(trunc(l_quantity) AS BIGINT) % 10 AS INTEGER) END AS ed,
                   l_extendedprice AS val, p.t, l_quantity AS qty, l_linenumber AS ln,
                   'R' || CAST(l_suppkey % 4 AS VARCHAR) AS route,
                   CAST(l_partkey % 24 AS BIGINT) AS hrs
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN ck_part p ON l_partkey = p.p_partkey
        ) e""",
    ),
    (
        "ck_drug_exposure",
        """
        SELECT rid AS drug_exposure_id, pid AS person_id, cid AS drug_concept_id,
               sd AS drug_exposure_start_date, sdt AS drug_exposure_start_datetime,
               ed AS drug_exposure_end_date, edt AS drug_exposure_end_datetime, ed AS verbatim_end_date,
               32817 AS drug_type_concept_id, CAST(NULL AS VARCHAR) AS stop_reason, 0 AS refills, qty AS quantity,
               1 AS days_supply, 'as directed' AS sig, 0 AS route_concept_id, 'LOT' || CAST(ln AS VARCHAR) AS lot_number,
               CAST(NULL AS BIGINT) AS provider_id, vid AS visit_occurrence_id, CAST(NULL AS BIGINT) AS visit_detail_id,
               src AS drug_source_value, 0 AS drug_source_concept_id, route AS route_source_value, 'mg' AS dose_unit_source_value
        FROM ck_events WHERE t = 1""",
    ),
    (
        "ck_procedure_occurrence",
        """
        SELECT rid AS procedure_occurrence_id, pid AS person_id, cid AS procedure_concept_id,
               sd AS procedure_date, sdt AS procedure_datetime, ed AS procedure_end_date, edt AS procedure_end_datetime,
               32817 AS procedure_type_concept_id, 0 AS modifier_concept_id, CAST(trunc(qty) AS INTEGER) AS quantity,
               CAST(NULL AS BIGINT) AS provider_id, vid AS visit_occurrence_id, CAST(NULL AS BIGINT) AS visit_detail_id,
               src AS procedure_source_value, 0 AS procedure_source_concept_id, CAST(NULL AS VARCHAR) AS modifier_source_value
        FROM ck_events WHERE t = 2""",
    ),
    (
        "ck_measurement",
        """
        SELECT rid AS measurement_id, pid AS person_id, cid AS measurement_concept_id,
               sd AS measurement_date, sdt AS measurement_datetime, strftime(sdt, '%H:%M') AS measurement_time,
               32817 AS measurement_type_concept_id, 0 AS operator_concept_id, val AS value_as_number,
               0 AS value_as_concept_id, 0 AS unit_concept_id, 0.0::DOUBLE AS range_low, 100000.0::DOUBLE AS range_high,
               CAST(NULL AS BIGINT) AS provider_id, vid AS visit_occurrence_id, CAST(NULL AS BIGINT) AS visit_detail_id,
               src AS measurement_source_value, 0 AS measurement_source_concept_id, 'unit' AS unit_source_value,
               0 AS unit_source_concept_id, src AS value_source_value, CAST(NULL AS BIGINT) AS measurement_event_id,
               CAST(NULL AS INTEGER) AS meas_event_field_concept_id
        FROM ck_events WHERE t = 3""",
    ),
    (
        "ck_observation",
        """
        SELECT rid AS observation_id, pid AS person_id, cid AS observation_concept_id,
               sd AS observation_date, sdt AS observation_datetime, 32817 AS observation_type_concept_id,
               val AS value_as_number, src AS value_as_string, 0 AS value_as_concept_id, 0 AS qualifier_concept_id,
               0 AS unit_concept_id, CAST(NULL AS BIGINT) AS provider_id, vid AS visit_occurrence_id,
               CAST(NULL AS BIGINT) AS visit_detail_id, src AS observation_source_value, 0 AS observation_source_concept_id,
               'unit' AS unit_source_value, CAST(NULL AS VARCHAR) AS qualifier_source_value, src AS value_source_value,
               CAST(NULL AS BIGINT) AS observation_event_id, CAST(NULL AS INTEGER) AS obs_event_field_concept_id
        FROM ck_events WHERE t = 4""",
    ),
    (
        "ck_device_exposure",
        """
        SELECT rid AS device_exposure_id, pid AS person_id, cid AS device_concept_id,
               sd AS device_exposure_start_date, sdt AS device_exposure_start_datetime,
               ed AS device_exposure_end_date, edt AS device_exposure_end_datetime, 32817 AS device_type_concept_id,
               'UDI' || CAST(rid AS VARCHAR) AS unique_device_id, CAST(NULL AS VARCHAR) AS production_id,
               CAST(trunc(qty) AS INTEGER) AS quantity, CAST(NULL AS BIGINT) AS provider_id, vid AS visit_occurrence_id,
               CAST(NULL AS BIGINT) AS visit_detail_id, src AS device_source_value, 0 AS device_source_concept_id,
               0 AS unit_concept_id, CAST(NULL AS VARCHAR) AS unit_source_value, CAST(NULL AS INTEGER) AS unit_source_concept_id
        FROM ck_events WHERE t = 5""",
    ),
    (
        "ck_condition_occurrence",
        """
        SELECT rid AS condition_occurrence_id, pid AS person_id, cid AS condition_concept_id,
               sd AS condition_start_date, sdt AS condition_start_datetime, ed AS condition_end_date,
               edt AS condition_end_datetime, 32817 AS condition_type_concept_id, 0 AS condition_status_concept_id,
               CAST(NULL AS VARCHAR) AS stop_reason, CAST(NULL AS BIGINT) AS provider_id, vid AS visit_occurrence_id,
               CAST(NULL AS BIGINT) AS visit_detail_id, src AS condition_source_value, 0 AS condition_source_concept_id,
               CAST(NULL AS VARCHAR) AS condition_status_source_value
        FROM ck_events WHERE t = 6""",
    ),
    (
        "ck_death",
        """
        SELECT p.person_id, lv.last_start + 30 AS death_date,
               CASE WHEN p.person_id % 10 = 0 THEN CAST(NULL AS TIMESTAMP) ELSE CAST(lv.last_start + 30 AS TIMESTAMP) END AS death_datetime,
               32817 AS death_type_concept_id, 1000000 + p.person_id AS cause_concept_id,
               'cause' || CAST(p.person_id % 7 AS VARCHAR) AS cause_source_value, 0 AS cause_source_concept_id
        FROM ck_person p
        JOIN (SELECT person_id, max(visit_start_date) AS last_start FROM ck_visit_occurrence GROUP BY person_id) lv
          ON lv.person_id = p.person_id
        WHERE p.person_id % 5 = 0""",
    ),
]


def with_views(query: str, *extra: tuple[str, str]) -> str:
    """Prefix a query with those fixture views and CTEs of ``extra`` that it reaches, in their order."""
    bodies = dict([*VIEWS, *extra])
    reached: set[str] = set()
    todo = [query]
    while todo:
        new = set(re.findall(r"\w+", todo.pop())) & bodies.keys() - reached
        reached |= new
        todo += [bodies[name] for name in new]
    ctes = ",\n".join(f"{name} AS ({body}\n)" for name, body in bodies.items() if name in reached)
    return f"WITH {ctes}\n{query}" if ctes else query
