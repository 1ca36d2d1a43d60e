"""The 22 base tables: their fixed schema, names and parquet reader."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AUDIT = "created_date_time timestamp, last_modified_date_time timestamp, last_modified_by_id bigint"
_VISIT = (
    "id bigint, individual_id bigint, program_enrolment_id bigint, encounter_date_time timestamp, "
    "created_by_id bigint, last_modified_by_id bigint, is_voided boolean"
)

# The columns the claim rules read, by their names in this package.
SCHEMAS: dict[str, str] = {
    "users": "id bigint, username string",
    "individual": (
        "id bigint, created_by_id bigint, is_voided boolean, gender string, date_of_birth date, "
        f"date_of_death date, date_of_sterilization date, date_of_antra_injection date, {_AUDIT}"
    ),
    "household": f"id bigint, {_AUDIT}",
    "pregnancy": (
        "id bigint, individual_id bigint, is_voided boolean, "
        f"program_exit_date_time timestamp, {_AUDIT}"
    ),
    "child": (
        "id bigint, individual_id bigint, is_voided boolean, "
        f"program_exit_date_time timestamp, {_AUDIT}"
    ),
    "anc": f"{_VISIT}, pmsma string, ifa_180 string, td1 date, td2 date, td_booster date",
    "hbnc": f"{_VISIT}, place_of_delivery string, delivery_type string",
    "hbyc": _VISIT,
    "abortion": "id bigint, individual_id bigint, date_of_abortion date, date_of_discharge date",
    "delivery": (
        "id bigint, individual_id bigint, encounter_date_time timestamp, date_of_delivery date, "
        "date_of_admission date, cancel_date_time timestamp, place_of_delivery string"
    ),
    "family_planning": (
        "id bigint, individual_id bigint, enrolment_date_time timestamp, "
        "program_exit_date_time timestamp, gap_text string, total_children decimal(38,0), "
        "child1_dob date, child2_dob date"
    ),
    "fp_followup": (
        "id bigint, individual_id bigint, encounter_date_time timestamp, "
        "date_of_sterilisation date, date_of_copper_t date"
    ),
    "tuberculosis": "id bigint, individual_id bigint, program_exit_date_time timestamp",
    "tb_followup": (
        "id bigint, individual_id bigint, encounter_date_time timestamp, tb_status string, "
        "tb_status_date date, type_of_tb string, treatment_completion_date date"
    ),
    "cbac": "id bigint, individual_id bigint, encounter_date_time timestamp",
    "acute_encephalitis": (
        "id bigint, individual_id bigint, enrolment_date_time timestamp, referred_to string"
    ),
    "checklist": "id bigint, program_enrolment_id bigint",
    "checklist_item": (
        "id bigint, checklist_id bigint, checklist_item_detail_id bigint, completion_date timestamp"
    ),
    "checklist_item_detail": "id bigint, concept_id bigint",
    "concept": "id bigint, name string",
    "relationship": (
        "id bigint, individual_a_id bigint, individual_b_id bigint, relationship_type_id bigint"
    ),
    "relationship_type": "id bigint",
}

# Tables whose stored name differs from the name used here.
STORED_TABLES: dict[str, str] = {
    "pregnancy": "individual_pregnancy",
    "child": "individual_child",
    "anc": "individual_pregnancy_anc",
    "abortion": "individual_pregnancy_abortion",
    "delivery": "individual_pregnancy_delivery",
    "hbnc": "individual_child_hbnc",
    "hbyc": "individual_child_hbyc",
    "family_planning": "individual_family_planning",
    "fp_followup": "individual_family_planning_fp_followup",
    "tuberculosis": "individual_tuberculosis",
    "tb_followup": "individual_tuberculosis_tuberculosis_follow_up",
    "cbac": "individual_cbac",
    "acute_encephalitis": "individual_acute_encephalitis",
    "relationship": "individual_relationship",
    "relationship_type": "individual_relationship_type",
}

# Form questions that are column names in the stored tables.
QUESTIONS: dict[str, dict[str, str]] = {
    "individual": {
        "date_of_death": "Date of death",
        "date_of_sterilization": "Date of Sterilization",
        "date_of_antra_injection": "Date of ANTRA injection",
    },
    "anc": {
        "pmsma": "Whether ANC done under PMSMA",
        "ifa_180": "180 Iron Folic Acid Tablet issued or not?",
        "td1": "TD 1 Dose",
        "td2": "TD 2 Dose",
        "td_booster": "TD Booster Dose",
    },
    "hbnc": {"place_of_delivery": "Place of delivery", "delivery_type": "Delivery type"},
    "abortion": {
        "date_of_abortion": "Date of abortion",
        "date_of_discharge": "Date of Discharge (Abortion)",
    },
    "delivery": {
        "date_of_delivery": "Date of delivery",
        "date_of_admission": "Date of Admission",
        "place_of_delivery": "Place of delivery",
    },
    "family_planning": {
        "gap_text": "Gap between 1st child and 2nd child",
        "total_children": "Total number of children",
        "child1_dob": "1st Child date of birth",
        "child2_dob": "2nd Child date of birth",
    },
    "fp_followup": {
        "date_of_sterilisation": "Date of sterilisation for family planning method",
        "date_of_copper_t": "Date of Copper T",
    },
    "tb_followup": {
        "tb_status": "TB case status",
        "tb_status_date": "TB case status date",
        "type_of_tb": "Type of TB",
        "treatment_completion_date": "Treatment completion date",
    },
    "acute_encephalitis": {"referred_to": "Referred to"},
}


class Tables:
    """The base tables by name, each opened when first used.

    ``tables["anc"]`` is a DataFrame with the columns of SCHEMAS.
    """

    def __init__(self, opener: Callable[[str], DataFrame]) -> None:
        self._opener = opener
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise KeyError(f"no base table named {name!r}")
        if name not in self._frames:
            self._frames[name] = self._opener(name)
        return self._frames[name]


def stored_schema(table: str) -> T.StructType:
    """The schema of ``table`` under its stored column names."""
    questions = QUESTIONS.get(table, {})
    fields = T.StructType.fromDDL(SCHEMAS[table]).fields
    return T.StructType([T.StructField(questions.get(f.name, f.name), f.dataType) for f in fields])


def read_tables(spark: SparkSession, directory: str) -> Tables:
    """The stored tables, one parquet folder each, with the columns of SCHEMAS.

    The stored type of each column is read from the footers. A question whose answer is a
    date in some forms and a time in others keeps its time: rules that compare the answer
    as it is then lose the last day after midnight, rules that compare its day do not, and
    both print what the forms hold. Other columns come in their declared types; a question
    that the stored table does not have yet is null.
    """

    def read(table: str) -> DataFrame:
        stored = spark.read.parquet(f"{directory}/{STORED_TABLES.get(table, table)}")
        names = T.StructType.fromDDL(SCHEMAS[table]).fieldNames()
        found = {field.name: field.dataType for field in stored.schema}
        return stored.select(
            *(
                _declared(field, found.get(field.name)).alias(name)
                for field, name in zip(stored_schema(table), names)
            )
        )

    return Tables(read)


def _declared(field: T.StructField, found: T.DataType | None) -> Column:
    if found is None:
        return F.lit(None).cast(field.dataType)
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DateType) and isinstance(
        found, (T.TimestampType, T.TimestampNTZType)
    ):
        return column.cast("timestamp")
    return column if found == field.dataType else column.cast(field.dataType)


def write_tables(
    tables: Tables, directory: str, times: dict[str, dict[str, Column]] | None = None
) -> None:
    """Write base tables in the stored layout, which ``read_tables`` reads.

    ``times`` gives, by table and column, a time to store instead of a declared date.
    Columns that a table does not have are stored as nulls.
    """
    for table, ddl in SCHEMAS.items():
        frame = tables[table]
        timed = (times or {}).get(table, {})
        columns = []
        for field, stored in zip(T.StructType.fromDDL(ddl), stored_schema(table)):
            if field.name in timed:
                value = timed[field.name].cast("timestamp")
            elif field.name in frame.columns:
                value = F.col(field.name).cast(field.dataType)
            else:
                value = F.lit(None).cast(field.dataType)
            columns.append(value.alias(stored.name))
        frame.select(*columns).write.parquet(f"{directory}/{STORED_TABLES.get(table, table)}")
