"""Small hand-made base tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from claimwright.sources.tables import SCHEMAS, Tables


def make_tables(spark: SparkSession, **rows: list[dict]) -> Tables:
    """Tables with the given rows; columns left out are null, tables left out are empty."""

    def build(name: str):
        schema = T.StructType.fromDDL(SCHEMAS[name])
        values = [tuple(row.get(f.name) for f in schema) for row in rows.get(name, [])]
        unknown = {key for row in rows.get(name, []) for key in row} - set(schema.fieldNames())
        assert not unknown, f"{name} has no columns {unknown}"
        return spark.createDataFrame(values, schema)

    return Tables(build)


def person(id: int, worker: int = 1, **columns) -> dict:
    return {
        "id": id,
        "created_by_id": worker,
        "last_modified_by_id": worker,
        "is_voided": False,
        "gender": "Female",
        **columns,
    }


def visit(id: int, individual: int, at, worker: int = 1, enrolment: int = 10, **columns) -> dict:
    return {
        "id": id,
        "individual_id": individual,
        "program_enrolment_id": enrolment,
        "encounter_date_time": at,
        "created_by_id": worker,
        "last_modified_by_id": worker,
        "is_voided": False,
        **columns,
    }


WORKERS = [{"id": 1, "username": "anu"}, {"id": 2, "username": "bina"}]
