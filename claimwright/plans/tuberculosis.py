"""Tuberculosis follow-ups and the rules on their status."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions.ages import between_one_and_six_months
from claimwright.functions.periods import day_text
from claimwright.operators.numbering import ByTime, number_rows
from claimwright.plans.run import Run, union_all, variants


def enrolment_rows(run: Run) -> DataFrame:
    """Tuberculosis enrolments per person: each follow-up is met once per enrolment."""
    return (
        run.tables["tuberculosis"]
        .groupBy(F.col("individual_id").alias("person_id"))
        .agg(F.count("*").alias("copies"))
    )


def followups(run: Run) -> DataFrame:
    """Follow-ups of enrolled people, each once, with ``copies``, its rows in the join."""
    people = run.tables["individual"].select(
        F.col("id").alias("person_id"), "created_by_id", "last_modified_by_id"
    )
    return (
        run.tables["tb_followup"]
        .withColumnsRenamed({"individual_id": "person_id", "id": "followup_id"})
        .join(enrolment_rows(run), "person_id")
        .join(people, "person_id")
    )


def numbered_followups(run: Run) -> DataFrame:
    """Follow-ups numbered from the latest; an unknown time counts as the latest.

    Copies of a follow-up take consecutive numbers, given as a range.
    """
    by = ByTime("encounter_date_time", "followup_id", descending=True)
    numbered = number_rows(followups(run), ["person_id"], by, "last_visit_number", "copies")
    first = F.col("last_visit_number") - F.col("copies") + 1
    return numbered.withColumn("first_visit_number", first)


def confirmed(run: Run) -> DataFrame:
    """Follow-ups that confirmed the disease, with the status date."""
    return followups(run).where(F.col("tb_status") == "Confirmed").select(
        "person_id", "encounter_date_time", F.col("tb_status_date").alias("confirmed_date"), "copies"
    )


def completed(run: Run) -> DataFrame:
    """Follow-ups with a treatment completed in the period."""
    return (
        followups(run)
        .where(_completed(run))
        .select("person_id", F.col("treatment_completion_date").alias("completed_date"), "copies")
    )


def _completed(run: Run) -> Column:
    return (F.col("tb_status") == "Treatment completed") & run.on_days("treatment_completion_date")


def _recency(followup_id: str) -> Column:
    """Encounter time and id as one number that grows with both; null without a time.

    A number of fixed width, so that the latest row is found by a hash aggregation: the
    microseconds take the digits above the ids, which are shifted to be positive.
    """
    wide = "decimal(38,0)"
    micros = F.unix_micros(F.col("encounter_date_time").cast("timestamp")).cast(wide)
    return micros * F.lit(Decimal(1 << 64)) + (F.col(followup_id).cast(wide) + F.lit(Decimal(1 << 63)))


def latest_encounters(run: Run) -> DataFrame:
    """Per enrolled person: the time of the latest follow-up, null if some time is unknown."""
    return _latest(followups(run).withColumn("recency", _recency("followup_id")))


def _latest(rows: DataFrame) -> DataFrame:
    """``person_id, newest, latest_encounter``: what counts as each person's latest row.

    An unknown time counts as the latest, and then no known one does.
    """
    unknown = F.max(F.col("encounter_date_time").isNull())
    return rows.groupBy("person_id").agg(
        F.when(~unknown, F.max("recency")).alias("newest"),
        F.when(~unknown, F.max("encounter_date_time")).alias("latest_encounter"),
    )


def latest_by_type(run: Run) -> DataFrame:
    """Per person, type and encounter time: that time if it is the person's latest, else null."""
    kinds = ["person_id", "created_by_id", "last_modified_by_id", "type_of_tb", "encounter_date_time"]
    groups = (
        followups(run)
        .withColumn("recency", _recency("followup_id"))
        .groupBy(*kinds)
        .agg(F.max("recency").alias("recency"))
    )
    newest = _latest(groups).select("person_id", "newest")
    latest = F.when(F.col("recency") == F.col("newest"), F.col("encounter_date_time"))
    return (
        groups.where(F.col("encounter_date_time").isNotNull())
        .join(newest, "person_id")
        .select(*kinds, latest.alias("latest_encounter"))
    )


def _case_types(run: Run) -> DataFrame:
    """Per enrolled person: the types ever seen, and the day of the latest follow-up if resistant.

    One hash aggregation, combined on the map side; a person's follow-ups are never
    gathered. The last digit of the newest row's number says whether it is a resistant one.
    """
    at = F.col("encounter_date_time")
    resistant = F.coalesce(F.col("type_of_tb") == "Drug resistant", F.lit(False))
    marked = _recency("id") * 2 + resistant.cast("int")

    def seen(kind: str) -> Column:
        return F.coalesce(F.max(F.col("type_of_tb") == kind), F.lit(False))

    enrolled = run.tables["tuberculosis"].select("individual_id")
    return (
        run.narrow(run.tables["tb_followup"])
        .groupBy("individual_id")
        .agg(
            F.max(at.isNull()).alias("unknown"),
            F.max(at).alias("at"),
            F.max(marked).alias("newest"),
            seen("Drug resistant").alias("resistant"),
            seen("Drug sensitive").alias("sensitive"),
        )
        .where(F.col("resistant") | F.col("sensitive"))
        .join(enrolled, "individual_id", "left_semi")
        .select(
            F.col("individual_id").alias("person_id"),
            "resistant",
            "sensitive",
            F.when(~F.col("unknown") & (F.pmod("newest", F.lit(2)) == 1), F.to_date("at")).alias(
                "latest"
            ),
        )
    )


def confirmed_cases(run: Run) -> DataFrame:
    """r26: cases confirmed in the period of people with an ongoing enrolment."""
    ongoing = (
        run.tables["tuberculosis"]
        .where(F.col("program_exit_date_time").isNull())
        .select("individual_id")
    )
    rows = run.tables["tb_followup"].where(
        (F.col("tb_status") == "Confirmed") & run.on_days("tb_status_date")
    )
    day = day_text("tb_status_date")
    return (
        run.narrow(rows)
        .select("individual_id", day.alias("day"))
        .distinct()
        .join(ongoing, "individual_id", "left_semi")
        .select(
            F.lit("r26").alias("rule"),
            F.col("individual_id").alias("person_id"),
            F.col("day").alias("completion"),
            F.col("day").alias("registration"),
        )
    )


def treatment_claims(run: Run, rules: set[str]) -> DataFrame | None:
    """Candidate tuples of r28 (in treatment), r29 and r30 (treatment completed)."""
    if not rules & {"r28", "r29", "r30"}:
        return None
    types = _case_types(run)
    rows = run.narrow(run.tables["tb_followup"])
    confirmations = rows.where(F.col("tb_status") == "Confirmed")
    frames = []
    if "r28" in rules:
        recent = (
            confirmations.where(
                between_one_and_six_months(run.params.today, F.col("tb_status_date"))
            )
            .select(
                F.col("individual_id").alias("person_id"),
                F.col("tb_status_date").cast("string").alias("registration"),
            )
            .distinct()
        )
        frames.append(
            recent.join(types.where("resistant"), "person_id").select(
                F.lit("r28").alias("rule"),
                "person_id",
                F.lit(None).cast("string").alias("completion"),
                "registration",
                "latest",
            )
        )
    finished = [
        (F.col(kind), F.lit(rule))
        for rule, kind in (("r29", "resistant"), ("r30", "sensitive"))
        if rule in rules
    ]
    if finished:
        first = confirmations.select(
            F.col("individual_id").alias("person_id"),
            day_text("tb_status_date").alias("registration"),
        ).distinct()
        last = (
            rows.where(_completed(run))
            .select(
                F.col("individual_id").alias("person_id"),
                day_text("treatment_completion_date").alias("completion"),
            )
            .distinct()
        )
        frames.append(
            last.join(types, "person_id")
            .join(first, "person_id")
            .select(
                variants(*finished).alias("rule"),
                "person_id",
                "completion",
                "registration",
                F.lit(None).cast("date").alias("latest"),
            )
        )
    return union_all(frames)
