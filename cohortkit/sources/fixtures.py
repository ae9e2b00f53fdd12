"""Clinical view of the driver's star-schema tables (FIXTURES.md §2).

The reference reads OMOP tables that ship with no test data. This module derives OMOP-shaped
DataFrames (person, visit_occurrence, six event tables, death, concept, concept_ancestor and a
registry concept set) from part / orders / lineitem / customer / nation / region with
deterministic built-in expressions only, so the same view can be written in DuckDB SQL
(``cohortkit.oracle.views``) and every operator compared with an independent oracle.

Everything is lazy: each table is a projection of parquet scans, so column pruning and filter
pushdown reach the files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.plans.broadcast import join_lookup

# Fixed values of the fixture (FIXTURES.md §2): part type index t and its clinical domain.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
DOMAINS = ["Drug", "Procedure", "Measurement", "Observation", "Device", "Condition"]
# Fixed concept ids used by the view.
GENDER_EVEN, GENDER_ODD = 8507, 8532
ETHNICITY_IN_VOCAB, ETHNICITY_NOT_IN_VOCAB = 38003564, 38003563
RACE_BASE = 8000
VISIT_TYPE = {"F": 9201, "P": 262, "O": 9202}
RECORD_TYPE = 32817
LEAF_BASE, BRAND_BASE, SIZE_BASE, ROOT_BASE = 1_000_000, 20_000, 30_000, 10_000
CONCEPT_SET_ROOTS = (10003, 10005)


@dataclass
class ClinicalTables:
    person: DataFrame
    visit_occurrence: DataFrame
    condition_occurrence: DataFrame
    procedure_occurrence: DataFrame
    drug_exposure: DataFrame
    device_exposure: DataFrame
    measurement: DataFrame
    observation: DataFrame
    death: DataFrame
    concept: DataFrame
    concept_ancestor: DataFrame
    concept_set: DataFrame
    events: DataFrame | None = None   # the joined stream the six event tables are cut from

    def as_dict(self) -> dict[str, DataFrame]:
        return {k: v for k, v in self.__dict__.items() if k != "events"}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _type_index(col: Column) -> Column:
    expr = None
    for i, t in enumerate(PART_TYPES, start=1):
        expr = F.when(col == t, F.lit(i)) if expr is None else expr.when(col == t, F.lit(i))
    return expr


def _domain(t: Column) -> Column:
    expr = None
    for i, d in enumerate(DOMAINS, start=1):
        expr = F.when(t == i, F.lit(d)) if expr is None else expr.when(t == i, F.lit(d))
    return expr


def _hours(ts_date: Column, hours: Column) -> Column:
    """Timestamp (no time zone) of a date plus whole hours."""
    return ts_date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours.cast("int"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    t = _type_index(F.col("p_type"))
    return p.select(
        F.col("p_partkey").cast("long").alias("p_partkey"),
        "p_name",
        "p_type",
        "p_brand",
        t.alias("t"),
        F.substring("p_brand", 7, 10).cast("int").alias("b"),
        F.col("p_size").cast("int").alias("s"),
        _domain(t).alias("domain"),
    )


def vocabulary(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(concept, concept_ancestor, concept_set) of the fixture."""
    parts = _parts(spark, sf_dir)
    leaf = parts.select(
        (F.lit(LEAF_BASE) + F.col("p_partkey")).alias("concept_id"),
        F.col("p_name").alias("concept_name"),
        F.col("domain").alias("domain_id"),
        F.when(F.col("t") == 1, "Clinical Drug").otherwise("Leaf").alias("concept_class_id"),
        F.when(F.col("s") == 50, "D").alias("invalid_reason"),
    )
    brand = parts.select(
        (F.lit(BRAND_BASE) + 100 * F.col("t") + F.col("b")).cast("long").alias("concept_id"),
        F.concat_ws(" ", "p_type", "p_brand").alias("concept_name"),
        F.col("domain").alias("domain_id"),
        F.when(F.col("t") == 1, "Ingredient").otherwise("Group").alias("concept_class_id"),
        F.lit(None).cast("string").alias("invalid_reason"),
    ).distinct()
    size = parts.select(
        (F.lit(SIZE_BASE) + 100 * F.col("t") + F.col("s")).cast("long").alias("concept_id"),
        F.concat(F.col("p_type"), F.lit(" size "), F.col("s").cast("string")).alias("concept_name"),
        F.col("domain").alias("domain_id"),
        F.when((F.col("t") == 1) & (F.col("s") <= 5), "Ingredient").otherwise("Group").alias("concept_class_id"),
        F.lit(None).cast("string").alias("invalid_reason"),
    ).distinct()
    root = parts.select(
        (F.lit(ROOT_BASE) + F.col("t")).cast("long").alias("concept_id"),
        F.col("p_type").alias("concept_name"),
        F.col("domain").alias("domain_id"),
        F.lit("Root").alias("concept_class_id"),
        F.lit(None).cast("string").alias("invalid_reason"),
    ).distinct()
    region = _read(spark, sf_dir, "region")
    extra_fixed = spark.createDataFrame(
        [
            (0, "No matching concept", "Metadata", "Undefined", None),
            (ETHNICITY_IN_VOCAB, "Not Hispanic or Latino", "Ethnicity", "Ethnicity", None),
        ],
        "concept_id long, concept_name string, domain_id string, concept_class_id string, invalid_reason string",
    )
    races = region.select(
        (F.lit(RACE_BASE) + F.col("r_regionkey")).cast("long").alias("concept_id"),
        F.col("r_name").alias("concept_name"),
        F.lit("Race").alias("domain_id"),
        F.lit("Race").alias("concept_class_id"),
        F.lit(None).cast("string").alias("invalid_reason"),
    )
    concept = leaf.unionByName(brand).unionByName(size).unionByName(root).unionByName(races).unionByName(extra_fixed)

    leaf_id = F.lit(LEAF_BASE) + F.col("p_partkey")
    brand_id = (F.lit(BRAND_BASE) + 100 * F.col("t") + F.col("b")).cast("long")
    size_id = (F.lit(SIZE_BASE) + 100 * F.col("t") + F.col("s")).cast("long")
    root_id = (F.lit(ROOT_BASE) + F.col("t")).cast("long")

    def edge(a: Column, d: Column, lvl: int) -> DataFrame:
        return parts.select(
            a.alias("ancestor_concept_id"), d.alias("descendant_concept_id"), F.lit(lvl).alias("min_levels_of_separation")
        )

    ancestor = (
        edge(leaf_id, leaf_id, 0)
        .unionByName(edge(brand_id, brand_id, 0))
        .unionByName(edge(size_id, size_id, 0))
        .unionByName(edge(root_id, root_id, 0))
        .unionByName(edge(brand_id, leaf_id, 1))
        .unionByName(edge(size_id, leaf_id, 1))
        .unionByName(edge(root_id, leaf_id, 2))
        .unionByName(edge(root_id, brand_id, 1))
        .unionByName(edge(root_id, size_id, 1))
        .distinct()
    )

    def cs(df: DataFrame, include: bool) -> DataFrame:
        return df.select(
            "concept_id",
            F.col("concept_id").cast("string").alias("concept_code"),
            "concept_name",
            F.col("domain_id").alias("domain"),
            F.lit("Fixture").alias("vocabulary"),
            F.lit("S").alias("is_standard"),
            F.lit(include).alias("include_descendants"),
        )

    concept_set = (
        cs(brand.where(F.col("concept_id") % 100 <= 8), True)
        .unionByName(cs(size.where(F.col("concept_id") % 100 <= 5), True))
        .unionByName(cs(root.where(F.col("concept_id").isin(*CONCEPT_SET_ROOTS)), True))
        .unionByName(cs(leaf.where((F.col("concept_id") - LEAF_BASE) % 7 == 0), False))
    )
    return concept, ancestor, concept_set


DOMAIN_TABLES = {1: "drug_exposure", 2: "procedure_occurrence", 3: "measurement", 4: "observation",
                 5: "device_exposure", 6: "condition_occurrence"}


def domain_tables(events: DataFrame) -> dict[str, DataFrame]:
    """The six clinical tables of the event stream, split by the part type's domain."""

    def dom(t: int) -> DataFrame:
        return events.where(F.col("t") == t)

    null_l, null_i, null_s = F.lit(None).cast("long"), F.lit(None).cast("int"), F.lit(None).cast("string")

    drug = dom(1).select(
        F.col("rid").alias("drug_exposure_id"), F.col("pid").alias("person_id"), F.col("cid").alias("drug_concept_id"),
        F.col("sd").alias("drug_exposure_start_date"), F.col("sdt").alias("drug_exposure_start_datetime"),
        F.col("ed").alias("drug_exposure_end_date"), F.col("edt").alias("drug_exposure_end_datetime"),
        F.col("ed").alias("verbatim_end_date"), F.lit(RECORD_TYPE).alias("drug_type_concept_id"),
        null_s.alias("stop_reason"), F.lit(0).alias("refills"), F.col("qty").alias("quantity"),
        F.lit(1).alias("days_supply"), F.lit("as directed").alias("sig"), F.lit(0).alias("route_concept_id"),
        F.concat(F.lit("LOT"), F.col("ln").cast("string")).alias("lot_number"), null_l.alias("provider_id"),
        F.col("vid").alias("visit_occurrence_id"), null_l.alias("visit_detail_id"),
        F.col("src").alias("drug_source_value"), F.lit(0).alias("drug_source_concept_id"),
        F.col("route").alias("route_source_value"), F.lit("mg").alias("dose_unit_source_value"),
    )
    procedure = dom(2).select(
        F.col("rid").alias("procedure_occurrence_id"), F.col("pid").alias("person_id"),
        F.col("cid").alias("procedure_concept_id"), F.col("sd").alias("procedure_date"),
        F.col("sdt").alias("procedure_datetime"), F.col("ed").alias("procedure_end_date"),
        F.col("edt").alias("procedure_end_datetime"), F.lit(RECORD_TYPE).alias("procedure_type_concept_id"),
        F.lit(0).alias("modifier_concept_id"), F.col("qty").cast("int").alias("quantity"),
        null_l.alias("provider_id"), F.col("vid").alias("visit_occurrence_id"), null_l.alias("visit_detail_id"),
        F.col("src").alias("procedure_source_value"), F.lit(0).alias("procedure_source_concept_id"),
        null_s.alias("modifier_source_value"),
    )
    measurement = dom(3).select(
        F.col("rid").alias("measurement_id"), F.col("pid").alias("person_id"),
        F.col("cid").alias("measurement_concept_id"), F.col("sd").alias("measurement_date"),
        F.col("sdt").alias("measurement_datetime"), F.date_format("sdt", "HH:mm").alias("measurement_time"),
        F.lit(RECORD_TYPE).alias("measurement_type_concept_id"), F.lit(0).alias("operator_concept_id"),
        F.col("val").alias("value_as_number"), F.lit(0).alias("value_as_concept_id"), F.lit(0).alias("unit_concept_id"),
        F.lit(0.0).alias("range_low"), F.lit(100000.0).alias("range_high"), null_l.alias("provider_id"),
        F.col("vid").alias("visit_occurrence_id"), null_l.alias("visit_detail_id"),
        F.col("src").alias("measurement_source_value"), F.lit(0).alias("measurement_source_concept_id"),
        F.lit("unit").alias("unit_source_value"), F.lit(0).alias("unit_source_concept_id"),
        F.col("src").alias("value_source_value"), null_l.alias("measurement_event_id"),
        null_i.alias("meas_event_field_concept_id"),
    )
    observation = dom(4).select(
        F.col("rid").alias("observation_id"), F.col("pid").alias("person_id"),
        F.col("cid").alias("observation_concept_id"), F.col("sd").alias("observation_date"),
        F.col("sdt").alias("observation_datetime"), F.lit(RECORD_TYPE).alias("observation_type_concept_id"),
        F.col("val").alias("value_as_number"), F.col("src").alias("value_as_string"),
        F.lit(0).alias("value_as_concept_id"), F.lit(0).alias("qualifier_concept_id"), F.lit(0).alias("unit_concept_id"),
        null_l.alias("provider_id"), F.col("vid").alias("visit_occurrence_id"), null_l.alias("visit_detail_id"),
        F.col("src").alias("observation_source_value"), F.lit(0).alias("observation_source_concept_id"),
        F.lit("unit").alias("unit_source_value"), null_s.alias("qualifier_source_value"),
        F.col("src").alias("value_source_value"), null_l.alias("observation_event_id"),
        null_i.alias("obs_event_field_concept_id"),
    )
    device = dom(5).select(
        F.col("rid").alias("device_exposure_id"), F.col("pid").alias("person_id"),
        F.col("cid").alias("device_concept_id"), F.col("sd").alias("device_exposure_start_date"),
        F.col("sdt").alias("device_exposure_start_datetime"), F.col("ed").alias("device_exposure_end_date"),
        F.col("edt").alias("device_exposure_end_datetime"), F.lit(RECORD_TYPE).alias("device_type_concept_id"),
        F.concat(F.lit("UDI"), F.col("rid").cast("string")).alias("unique_device_id"), null_s.alias("production_id"),
        F.col("qty").cast("int").alias("quantity"), null_l.alias("provider_id"),
        F.col("vid").alias("visit_occurrence_id"), null_l.alias("visit_detail_id"),
        F.col("src").alias("device_source_value"), F.lit(0).alias("device_source_concept_id"),
        F.lit(0).alias("unit_concept_id"), null_s.alias("unit_source_value"), null_i.alias("unit_source_concept_id"),
    )
    condition = dom(6).select(
        F.col("rid").alias("condition_occurrence_id"), F.col("pid").alias("person_id"),
        F.col("cid").alias("condition_concept_id"), F.col("sd").alias("condition_start_date"),
        F.col("sdt").alias("condition_start_datetime"), F.col("ed").alias("condition_end_date"),
        F.col("edt").alias("condition_end_datetime"), F.lit(RECORD_TYPE).alias("condition_type_concept_id"),
        F.lit(0).alias("condition_status_concept_id"), null_s.alias("stop_reason"), null_l.alias("provider_id"),
        F.col("vid").alias("visit_occurrence_id"), null_l.alias("visit_detail_id"),
        F.col("src").alias("condition_source_value"), F.lit(0).alias("condition_source_concept_id"),
        null_s.alias("condition_status_source_value"),
    )

    return {"drug_exposure": drug, "procedure_occurrence": procedure, "measurement": measurement,
            "observation": observation, "device_exposure": device, "condition_occurrence": condition}


def event_stream(spark: SparkSession, sf_dir: str, persons: DataFrame | None = None, concepts: DataFrame | None = None) -> DataFrame:
    """The events, of some ``persons`` (person_id) or ``concepts`` (concept_id) only if these are given, which leave
    the others out before orders and items are joined."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("long").alias("o_custkey"), F.to_date("o_orderdate").alias("o_day"))
    line = _read(spark, sf_dir, "lineitem")
    unmapped = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 3)
    items = line.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.when(unmapped, F.lit(0).cast("long")).otherwise(F.lit(LEAF_BASE) + F.col("l_partkey")).alias("cid"),
        F.when(F.col("l_linestatus") == "O", False).otherwise(True).alias("_closed"),
    )
    if persons is not None:
        orders = join_lookup(orders, persons.select(F.col("person_id").alias("_pid")).distinct(), "o_custkey", "_pid", "left_semi")
    if concepts is not None:
        items = join_lookup(items, concepts.select(F.col("concept_id").alias("_cid")).distinct(), "cid", "_cid", "left_semi")
    ev = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        _parts(spark, sf_dir).select("p_partkey", "p_name", "t"), F.col("l_partkey") == F.col("p_partkey")
    )
    start = F.date_add("o_day", (3 * F.col("l_linenumber") - 4).cast("int"))
    end = F.when(F.col("_closed"), F.date_add(start, (F.col("l_quantity").cast("int") % 10).cast("int")))
    hrs = F.col("l_partkey") % 24
    return ev.select(
        (((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 20000 + F.col("l_partkey")) * 1000 + F.col("l_suppkey"))
        .cast("long")
        .alias("rid"),
        F.col("o_custkey").alias("pid"),
        F.col("o_orderkey").cast("long").alias("vid"),
        "cid",
        F.col("p_name").alias("src"),
        start.alias("sd"),
        end.alias("ed"),
        F.col("l_extendedprice").alias("val"),
        _hours(start, hrs).alias("sdt"),
        _hours(end, hrs).alias("edt"),
        F.concat(F.lit("R"), (F.col("l_suppkey") % 4).cast("string")).alias("route"),
        F.col("t"),
        F.col("l_quantity").alias("qty"),
        F.col("l_linenumber").alias("ln"),
    )


def clinical_view(spark: SparkSession, sf_dir: str) -> ClinicalTables:
    customer = _read(spark, sf_dir, "customer")
    nation = _read(spark, sf_dir, "nation")
    orders = _read(spark, sf_dir, "orders")

    # ---- person
    p = F.col("c_custkey")
    birth = F.make_date(1900 + (7 * p) % 100, 1 + p % 12, 1 + p % 28)
    person = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            p.cast("long").alias("person_id"),
            F.when(p % 2 == 0, GENDER_EVEN).otherwise(GENDER_ODD).cast("int").alias("gender_concept_id"),
            F.year(birth).alias("year_of_birth"),
            F.month(birth).alias("month_of_birth"),
            F.dayofmonth(birth).alias("day_of_birth"),
            birth.cast("timestamp_ntz").alias("birth_datetime"),
            (F.lit(RACE_BASE) + F.col("n_regionkey")).cast("int").alias("race_concept_id"),
            F.when(p % 4 == 0, ETHNICITY_NOT_IN_VOCAB).otherwise(ETHNICITY_IN_VOCAB).cast("int").alias("ethnicity_concept_id"),
            F.col("c_nationkey").cast("long").alias("location_id"),
            F.lit(None).cast("long").alias("provider_id"),
            F.lit(None).cast("long").alias("care_site_id"),
            F.col("c_name").alias("person_source_value"),
            F.when(p % 2 == 0, "M").otherwise("F").alias("gender_source_value"),
            F.lit(0).alias("gender_source_concept_id"),
            F.col("n_name").alias("race_source_value"),
            F.lit(0).alias("race_source_concept_id"),
            F.col("c_mktsegment").alias("ethnicity_source_value"),
            F.lit(0).alias("ethnicity_source_concept_id"),
        )
    )

    # ---- visit_occurrence
    vstart = F.to_date("o_orderdate")
    vend = F.date_add(vstart, (F.col("o_orderkey") % 14).cast("int"))
    vtype = (
        F.when(F.col("o_orderstatus") == "F", VISIT_TYPE["F"])
        .when(F.col("o_orderstatus") == "P", VISIT_TYPE["P"])
        .otherwise(VISIT_TYPE["O"])
    )
    visit = orders.select(
        F.col("o_orderkey").cast("long").alias("visit_occurrence_id"),
        F.col("o_custkey").cast("long").alias("person_id"),
        vtype.cast("int").alias("visit_concept_id"),
        vstart.alias("visit_start_date"),
        _hours(vstart, F.lit(0)).alias("visit_start_datetime"),
        vend.alias("visit_end_date"),
        _hours(vend, F.col("o_orderkey") % 24).alias("visit_end_datetime"),
        F.lit(RECORD_TYPE).alias("visit_type_concept_id"),
        F.lit(None).cast("long").alias("provider_id"),
        F.lit(None).cast("long").alias("care_site_id"),
        F.col("o_orderpriority").alias("visit_source_value"),
        F.lit(0).alias("visit_source_concept_id"),
        F.lit(0).alias("admitted_from_concept_id"),
        F.lit("home").alias("admitted_from_source_value"),
        F.lit(0).alias("discharged_to_concept_id"),
        F.lit("home").alias("discharged_to_source_value"),
        F.lit(None).cast("long").alias("preceding_visit_occurrence_id"),
    )

    # ---- events: one stream, split by domain
    events = event_stream(spark, sf_dir)
    domains = domain_tables(events)

    # ---- death: persons with p % 5 = 0, 30 days after their last visit
    last_visit = visit.groupBy("person_id").agg(F.max("visit_start_date").alias("last_start"))
    dd = F.date_add(F.col("last_start"), 30)
    death = (
        person.select("person_id")
        .where(F.col("person_id") % 5 == 0)
        .join(last_visit, "person_id")
        .select(
            "person_id",
            dd.alias("death_date"),
            F.when(F.col("person_id") % 10 == 0, F.lit(None)).otherwise(_hours(dd, F.lit(0))).alias("death_datetime"),
            F.lit(RECORD_TYPE).alias("death_type_concept_id"),
            (F.lit(LEAF_BASE) + F.col("person_id")).alias("cause_concept_id"),
            F.concat(F.lit("cause"), (F.col("person_id") % 7).cast("string")).alias("cause_source_value"),
            F.lit(0).alias("cause_source_concept_id"),
        )
    )

    concept, ancestor, concept_set = vocabulary(spark, sf_dir)
    return ClinicalTables(
        person=person,
        visit_occurrence=visit,
        death=death,
        concept=concept,
        concept_ancestor=ancestor,
        concept_set=concept_set,
        events=events,
        **domains,
    )
