"""Completed vaccinations per child, from the checklists of their enrolments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions.ages import full_years
from claimwright.functions.periods import day_text, neither_nor_as_written
from claimwright.operators.key_filter import KeyFilter, worth_filtering
from claimwright.plans.run import Run, variants

# Vaccine names of the two series.
PRIMARY = ("BCG", "Pentavalent 3", "OPV 3", "Measles 1", "JE 1")
BOOSTER = ("DPT Booster 1", "DPT Booster 2", "OPV Booster", "Measles 2", "JE 2")

# Relationship types that link a mother to her child.
MOTHER_CHILD_TYPES = (664, 673)

# What a completed item counts for: a series is counted whole, the second booster by day.
USES = {"primary": PRIMARY, "booster": BOOSTER, "dpt2": ("DPT Booster 2",)}


def checklist_owners(run: Run) -> DataFrame:
    """Checklist, the person it belongs to and whether the enrolment has ended.

    For one worker these are few: once that is checked, the items are cut down to them
    where they are read.
    """

    def enrolments() -> DataFrame:
        return run.narrow(run.tables["child"]).select(
            F.col("id").alias("program_enrolment_id"),
            F.col("individual_id").alias("person_id"),
            F.col("program_exit_date_time").isNotNull().alias("exited"),
        )

    def owners(enrolled: DataFrame) -> DataFrame:
        checklists = run.tables["checklist"].select(
            F.col("id").alias("checklist_id"), "program_enrolment_id"
        )
        return checklists.join(enrolled, "program_enrolment_id").drop("program_enrolment_id")

    if not run.for_one_worker:
        return owners(enrolments())
    return run.lookup("owners", lambda: owners(run.lookup("enrolments", enrolments)))


def named_details(run: Run) -> DataFrame:
    """Checklist item details of the vaccines; a handful of rows, checked before use."""

    def build() -> DataFrame:
        concepts = (
            run.tables["concept"]
            .where(F.col("name").isin(*PRIMARY, *BOOSTER))
            .select(F.col("id").alias("concept_id"), F.col("name").alias("vaccine"))
        )
        details = run.tables["checklist_item_detail"].select(
            F.col("id").alias("checklist_item_detail_id"), "concept_id"
        )
        return details.join(concepts, "concept_id").drop("concept_id")

    return run.lookup("vaccine details", build)


def completed_items(run: Run, names: set[str]) -> DataFrame:
    """Completed checklist items of the given vaccines."""
    return (
        run.tables["checklist_item"]
        .where(F.col("completion_date").isNotNull())
        .select("checklist_id", "checklist_item_detail_id", "completion_date")
        .join(named_details(run), "checklist_item_detail_id")
        .where(F.col("vaccine").isin(sorted(names)))
        .drop("checklist_item_detail_id")
    )


def _checklists_of_active(run: Run) -> KeyFilter:
    """Checklists, at least all, of children with an item completed in the period."""
    child = run.tables["child"].select(
        F.col("id").alias("program_enrolment_id"), F.col("individual_id").alias("person_id")
    )
    checklists = run.tables["checklist"].select(
        F.col("id").alias("checklist_id"), "program_enrolment_id"
    )
    done = run.tables["checklist_item"].where(run.on_days("completion_date"))
    for key, rows in (
        ("checklist_id", checklists),
        ("program_enrolment_id", child),
        ("person_id", child),
        ("program_enrolment_id", checklists),
    ):
        done = rows.where(KeyFilter(done, key).may_hold(key))
    return KeyFilter(done, "checklist_id")


def vaccinations(run: Run, uses: list[str], in_period: bool = False) -> DataFrame:
    """Completed items per person and use: first and last completion, number of rows.

    A series has one row per person, ``key`` being null; 'dpt2' has one row per day. The
    enrolment has not ended.

    The small tables are joined first, so the items are shuffled twice: to their checklist's
    person, and, already counted per map task, to the group. With ``in_period`` the series
    may lack children without any item in the period, whose items are then not shuffled.
    """

    def use(name: str) -> tuple[Column, Column]:
        key = day_text("completion_date") if name == "dpt2" else F.lit(None).cast("string")
        return F.col("vaccine").isin(*USES[name]), F.struct(
            F.lit(name).alias("use"), key.alias("key")
        )

    done = completed_items(run, set().union(*(USES[name] for name in uses)))
    if in_period and not run.for_one_worker and worth_filtering(run.tables["checklist_item"]):
        active = _checklists_of_active(run).may_hold("checklist_id")
        # The second booster counts on any day.
        done = done.where(active | F.col("vaccine").isin(*USES["dpt2"]) if "dpt2" in uses else active)
    items = done.select(
        "checklist_id", "completion_date", variants(*(use(name) for name in uses)).alias("u")
    )
    owners = checklist_owners(run).where(~F.col("exited")).drop("exited")
    return (
        items.join(owners, "checklist_id")
        .groupBy("person_id", F.col("u.use").alias("use"), F.col("u.key").alias("key"))
        .agg(
            F.min("completion_date").alias("first_completion"),
            F.max("completion_date").alias("last_completion"),
            F.count("*").alias("items"),
        )
    )


def series(run: Run, use: str) -> DataFrame:
    """Per worker and child: first and last completion, item rows done and age in years."""
    people = run.people_of_workers().where("is_live")
    return (
        vaccinations(run, [use])
        .join(people, "person_id")
        .select("*", F.explode("workers").alias("w"))
        .select(
            F.col("w.worker_id").alias("worker_id"),
            "person_id",
            "last_completion",
            "first_completion",
            (F.col("items") * F.col("w.copies")).alias("vaccines_done"),
            full_years(run.params.today, F.col("date_of_birth")).alias("age_in_years"),
        )
    )


def _mother_child_edges(run: Run) -> DataFrame:
    """Mother and child of every mother-child relationship, whoever they are."""
    types = (
        run.tables["relationship_type"]
        .where(F.col("id").isin(*MOTHER_CHILD_TYPES))
        .select(F.col("id").alias("relationship_type_id"))
        .distinct()
    )
    # Distinct ids out of a list of two: at most two rows.
    return (
        run.tables["relationship"]
        .where(F.col("relationship_type_id").isin(*MOTHER_CHILD_TYPES))
        .join(F.broadcast(types), "relationship_type_id", "left_semi")
        .select(
            F.col("individual_a_id").alias("mother_id"), F.col("individual_b_id").alias("child_id")
        )
    )


def mother_child(run: Run) -> DataFrame:
    """Mother and child of every mother-child relationship between two live people."""
    edges = _mother_child_edges(run)
    for end in ("mother_id", "child_id"):
        edges = edges.join(run.live_people().withColumnRenamed("person_id", end), end, "left_semi")
    return edges.select("mother_id", "child_id")


def family_members(edges: DataFrame) -> DataFrame:
    """Each end of a mother-child edge as ``person_id``, with the edge."""
    ends = F.array_distinct(F.array("mother_id", "child_id"))
    return edges.select(F.explode(ends).alias("person_id"), "mother_id", "child_id")


def birth_doses(run: Run) -> DataFrame:
    """r23: birth doses completed in the period, with the admissions of the mother.

    The person is either end of a mother-child edge. The person's own liveness is left to
    the join with the people, so only the other end of the edge is looked up here.
    """
    doses = (
        completed_items(run, {"BCG"})
        .where(run.on_days("completion_date"))
        .join(checklist_owners(run), "checklist_id")
        .select("person_id", F.col("completion_date").cast("string").alias("completion"))
        .distinct()
    )
    other = F.when(F.col("person_id") == F.col("mother_id"), F.col("child_id")).otherwise(
        F.col("mother_id")
    )
    # Distinct before the doses are met: a mother of many children is one row here.
    members = (
        run.narrow(family_members(_mother_child_edges(run)), "person_id")
        .withColumn("other_id", other)
        .join(run.live_people().withColumnRenamed("person_id", "other_id"), "other_id", "left_semi")
        .select("person_id", "mother_id")
        .distinct()
    )
    admissions = (
        run.tables["delivery"]
        .where(neither_nor_as_written(F.col("place_of_delivery")))
        .select(
            F.col("individual_id").alias("mother_id"),
            F.col("date_of_admission").cast("string").alias("registration"),
        )
        .distinct()
    )
    return (
        doses.join(members, "person_id")
        .join(admissions, "mother_id")
        .select(F.lit("r23").alias("rule"), "person_id", "completion", "registration")
        .distinct()
    )


def vaccine_claims(run: Run, rules: set[str]) -> DataFrame | None:
    """Candidate tuples of the series (r15, r16) and of the second booster (r17)."""
    use_of = {"r15": "primary", "r16": "booster", "r17": "dpt2"}
    wanted = {rule: use for rule, use in use_of.items() if rule in rules}
    if not wanted:
        return None
    rule = F.create_map(*(F.lit(x) for rule, use in wanted.items() for x in (use, rule)))
    by_day = F.col("use") == "dpt2"
    completion, registration = (
        F.when(by_day, F.col("key")).otherwise(F.col(side).cast("string"))
        for side in ("last_completion", "first_completion")
    )
    return (
        vaccinations(run, list(wanted.values()), in_period=True)
        .where(by_day | run.on_days("last_completion"))
        .select(
            rule[F.col("use")].alias("rule"),
            "person_id",
            completion.alias("completion"),
            registration.alias("registration"),
            F.when(~by_day, F.col("items")).alias("items"),
        )
    )
