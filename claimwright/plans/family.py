"""Deliveries, abortions and family planning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions.periods import day_text, live
from claimwright.functions.texts import digits_at_least
from claimwright.plans.run import Run, any_of, union_all, variants


def _ongoing(run: Run, table: str) -> DataFrame:
    return run.tables[table].where(F.col("program_exit_date_time").isNull())


def _enrolled(run: Run, table: str) -> DataFrame:
    return _ongoing(run, table).select("individual_id")


def delivery_followups(run: Run) -> DataFrame:
    """Deliveries, planning enrolments and follow-ups of live people, as legs of their join.

    Whoever's the people are. Per person the join meets every delivery with every ongoing
    planning enrolment and every follow-up, once per ongoing pregnancy. A leg lists the rows
    of one side, and ``copies`` how often the join would repeat each of them: the product of
    the other sides' rows, so the combinations themselves are never made.
    """

    def side(table: str, leg: str, columns: dict[str, str], ongoing: Column) -> DataFrame:
        return (
            run.tables[table]
            .where(ongoing)
            .select(
                F.col("individual_id").alias("person_id"),
                F.lit(leg).alias("leg"),
                *(F.col(source).alias(name) for name, source in columns.items()),
            )
        )

    not_ended = F.col("program_exit_date_time").isNull()
    sides = [
        side(
            "delivery",
            "delivery",
            {"date_of_delivery": "date_of_delivery", "delivery_encounter": "encounter_date_time"},
            F.col("cancel_date_time").isNull(),
        ),
        side(
            "fp_followup",
            "followup",
            {
                "date_of_sterilisation": "date_of_sterilisation",
                "date_of_copper_t": "date_of_copper_t",
                "followup_encounter": "encounter_date_time",
            },
            F.lit(True),
        ),
        side("family_planning", "planning", {"planning_enrolment": "enrolment_date_time"}, not_ended),
    ]
    pregnancies = side("pregnancy", "pregnancy", {}, not_ended)
    legs = ["delivery", "followup", "planning", "pregnancy"]
    met = (
        union_all([df.select("person_id", "leg") for df in [*sides, pregnancies]])
        .groupBy("person_id")
        .agg(*(F.count_if(F.col("leg") == leg).alias(f"{leg}_rows") for leg in legs))
        .where(" and ".join(f"{leg}_rows > 0" for leg in legs))
    )
    people = (
        run.tables["individual"]
        .where(live(F.col("is_voided")))
        .select(F.col("id").alias("person_id"), "created_by_id", "last_modified_by_id")
    )

    def others(leg: str) -> Column:
        return reduce(Column.__mul__, (F.col(f"{other}_rows") for other in legs if other != leg))

    copies = F.coalesce(*(F.when(F.col("leg") == leg, others(leg)) for leg in legs[:3]))
    rows = reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), sides)
    return (
        rows.join(people.join(met, "person_id"), "person_id")
        .withColumn("copies", copies)
        .select(
            "person_id",
            "created_by_id",
            "last_modified_by_id",
            "leg",
            "date_of_delivery",
            "delivery_encounter",
            "date_of_sterilisation",
            "date_of_copper_t",
            "followup_encounter",
            "planning_enrolment",
            "copies",
        )
    )


def method_after_delivery(run: Run, rules: set[str]) -> DataFrame | None:
    """Sterilisation (r10) and Copper-T (r12) of people with a delivery.

    Both sides are reduced to distinct days per person first; the pairs of days left are
    the claim lines themselves.
    """
    choices = []
    for rule, column in (("r10", "date_of_sterilisation"), ("r12", "date_of_copper_t")):
        if rule in rules:
            shown = F.col(column).cast("string") if rule == "r10" else day_text(column)
            claim = F.struct(F.lit(rule).alias("rule"), shown.alias("day"))
            choices.append((run.on_days(column), claim))
    if not choices:
        return None
    methods = (
        run.narrow(run.tables["fp_followup"].where(any_of(*choices)))
        .select("individual_id", variants(*choices).alias("m"))
        .select("individual_id", "m.rule", F.col("m.day").alias("completion"))
        .distinct()
    )
    deliveries = (
        run.narrow(run.tables["delivery"])
        .where(F.col("cancel_date_time").isNull() & F.col("date_of_delivery").isNotNull())
        .groupBy("individual_id", F.col("date_of_delivery").cast("string").alias("registration"))
        .agg(F.max(F.coalesce(run.at_instants("encounter_date_time"), F.lit(False))).alias("dated"))
    )
    return (
        methods.join(_enrolled(run, "family_planning"), "individual_id", "left_semi")
        .join(_enrolled(run, "pregnancy"), "individual_id", "left_semi")
        .join(deliveries, "individual_id")
        .where((F.col("rule") != "r10") | F.col("dated"))
        .select("rule", F.col("individual_id").alias("person_id"), "completion", "registration")
    )


def planning_after_abortion(run: Run) -> DataFrame:
    """r11: planning enrolments in the period of people with an abortion."""
    enrolled = (
        run.narrow(_ongoing(run, "family_planning").where(run.on_days("enrolment_date_time")))
        .select("individual_id", day_text("enrolment_date_time").alias("completion"))
        .distinct()
    )
    abortions = (
        run.narrow(run.tables["abortion"])
        .where(F.col("date_of_abortion").isNotNull())
        .select("individual_id", F.col("date_of_abortion").cast("string").alias("registration"))
        .distinct()
    )
    return enrolled.join(abortions, "individual_id").select(
        F.lit("r11").alias("rule"),
        F.col("individual_id").alias("person_id"),
        "completion",
        "registration",
    )


def spaced_children(run: Run) -> DataFrame:
    """r13: planning enrolments in the period with at least 36 months between the children."""
    rows = run.tables["family_planning"].where(
        run.on_days("enrolment_date_time") & digits_at_least(F.col("gap_text"), 36)
    )
    return _children(run.narrow(rows), "r13")


def sterilised_after_two(run: Run) -> DataFrame:
    """r14: ongoing enrolments with two children and a sterilisation in the period."""
    rows = _ongoing(run, "family_planning").where(
        F.col("enrolment_date_time").isNotNull() & (F.col("total_children") == 2)
    )
    sterilised = (
        run.tables["fp_followup"]
        .where(run.at_instants("date_of_sterilisation"))
        .select("individual_id")
    )
    rows = run.narrow(rows).join(sterilised, "individual_id", "left_semi")
    return _children(rows, "r14")


def _children(rows: DataFrame, rule: str) -> DataFrame:
    return rows.select(
        F.lit(rule).alias("rule"),
        F.col("individual_id").alias("person_id"),
        day_text("child2_dob").alias("completion"),
        day_text("child1_dob").alias("registration"),
    )
