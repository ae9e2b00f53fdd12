"""cohortkit: turn an OMOP-style clinical warehouse into a shareable research registry on Spark.

Every step is a function from DataFrames and parameters to DataFrames:

* ``operators.concepts``   concept-set expansion over a closed vocabulary hierarchy
* ``operators.cohort``     qualifying diagnoses, index visits, cohort table, attrition
* ``operators.extract``    windowed extraction of every clinical table around cohort visits
* ``operators.generalise`` replace rare diagnoses by their most specific common ancestor
* ``operators.deid``       keyed date shifting and id remapping, per-table specs
* ``operators.quality``    post de-identification checks as report rows
* ``operators.profile``    condition / measurement / drug / device profiles
* ``operators.summary``    cohort summary report (age, race, ethnicity, deaths, stay)

``plans.pipeline`` chains them and writes the registry tables; ``sources`` holds the readers
(parquet tables, concept-set CSV, literal rows, the test fixture view).
"""

from cohortkit.params import Params

__all__ = ["Params"]
