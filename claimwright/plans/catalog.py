"""Every derived dataset by name, for use outside the report.

The columns are those a worker would read; days and times keep their types. Over all
workers the datasets that are a worker's own have a leading ``worker`` column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.functions.ages import between_one_and_six_months, full_years
from claimwright.functions.periods import (
    at_instants,
    between_is_known,
    day_text,
    neither_nor_as_written,
    on_days,
)
from claimwright.functions.texts import digits_at_least, digits_number
from claimwright.operators.numbering import ByTime, number_rows
from claimwright.plans import activity, family, tuberculosis, vaccines, visits
from claimwright.plans.run import Run

Dataset = Callable[[Run], DataFrame]


def _own(run: Run, df: DataFrame) -> DataFrame:
    """A dataset of workers: without ``worker_id`` for one worker, else with the name."""
    if run.for_one_worker:
        return df.drop("worker_id")
    named = run.scope.named(df)
    return named.select("worker", *(c for c in named.columns if c not in ("worker", "worker_id")))


def _client_user(run: Run) -> DataFrame:
    users = run.scope.users
    if run.params.username is None:
        return users
    return users.where(F.col("username") == run.params.username)


def _nth(kind: str, n: int, in_period: bool, columns: tuple[str, ...] = ()) -> Dataset:
    """The nth visit; ``columns`` names the kind's own columns, if wanted."""

    def build(run: Run) -> DataFrame:
        df = visits.nth_visit(run, kind, n, in_period)
        own = [F.col(source).alias(name) for source, name in zip(("note", "mode"), columns)]
        df = df.select("worker_id", "person_id", F.col("day").alias("visit_date"), *own)
        return _own(run, df.distinct())

    return build


def _hbnc_visits(run: Run) -> DataFrame:
    numbered = visits.numbered_visits(run, "hbnc").select(
        "worker_id",
        "person_id",
        F.to_date("at").alias("visit_date"),
        F.col("note").alias("place_of_delivery"),
        F.col("mode").alias("delivery_type"),
        "visit_number",
    )
    return _own(run, numbered)


def _hbyc_visits(run: Run) -> DataFrame:
    numbered = visits.numbered_visits(run, "hbyc").select(
        "worker_id", "person_id", F.to_date("at").alias("visit_date"), "visit_number"
    )
    return _own(run, numbered)


def _anc_visits(run: Run) -> DataFrame:
    """Antenatal visits, each once with the range of its numbers and its own columns."""
    people = run.tables["individual"].select(
        F.col("id").alias("person_id"), "gender", "date_of_sterilization"
    )
    own = run.tables["anc"].select(
        F.col("id").alias("visit_id"), "pmsma", "ifa_180", "td1", "td2", "td_booster"
    )
    numbered = (
        visits.numbered_visits(run, "anc")
        .join(own, "visit_id")
        .join(people, "person_id")
        .select(
            "worker_id",
            "person_id",
            F.to_date("at").alias("visit_date"),
            "pmsma",
            "ifa_180",
            "td1",
            "td2",
            "td_booster",
            "date_of_sterilization",
            "gender",
            "copies",
            "first_visit_number",
            "last_visit_number",
        )
    )
    return _own(run, numbered)


def _anc_abortions(run: Run) -> DataFrame:
    """The abortion side of the antenatal visits: each row with the visits it meets."""
    met = (
        visits.worker_visits(run, ["anc"])
        .groupBy("worker_id", "person_id")
        .agg(F.count("*").alias("copies"))
        .join(run.live_people(), "person_id")
    )
    rows = run.tables["abortion"].withColumnRenamed("individual_id", "person_id")
    met_rows = rows.join(met, "person_id").select(
        "worker_id", "person_id", "date_of_abortion", "date_of_discharge", "copies"
    )
    return _own(run, met_rows)


def _pmsma(run: Run) -> DataFrame:
    found = visits.pmsma_visits(run)
    return _own(run, found.select("worker_id", "person_id", F.col("day").alias("visit_date")))


def _dose(run: Run, doses: DataFrame) -> DataFrame:
    found = doses.join(run.live_people(), "person_id")
    return _own(run, found.select("worker_id", "person_id", F.col("day").alias("dose_date")))


def _series(use: str) -> Dataset:
    return lambda run: _own(run, vaccines.series(run, use))


def _fp_delivery(run: Run) -> DataFrame:
    return family.delivery_followups(run)


def _tb_followups(run: Run) -> DataFrame:
    return tuberculosis.numbered_followups(run).select(
        "person_id",
        "created_by_id",
        "last_modified_by_id",
        "tb_status_date",
        "tb_status",
        "type_of_tb",
        "encounter_date_time",
        "treatment_completion_date",
        "copies",
        "first_visit_number",
        "last_visit_number",
    )


PLACE = ("place_of_delivery", "delivery_type")

DATASETS: dict[str, Dataset] = {
    "d01_client_user": _client_user,
    "d02_activity": lambda run: _own(run, activity.activity(run)),
    "d03_activity_total": activity.activity_total,
    "d04_hbnc_visits": _hbnc_visits,
    "d05_hbyc_visits": _hbyc_visits,
    "d06_anc_visits": _anc_visits,
    "d06_anc_abortions": _anc_abortions,
    "d07_first_anc": _nth("anc", 1, False),
    "d08_second_anc": _nth("anc", 2, False, ("ifa_180",)),
    "d09_fourth_anc": _nth("anc", 4, True),
    "d10_seventh_anc": _nth("anc", 7, True),
    "d11_eighth_anc": _nth("anc", 8, True),
    "d12_first_hbnc": _nth("hbnc", 1, True),
    "d13_second_hbnc": _nth("hbnc", 2, True),
    "d14_third_hbnc": _nth("hbnc", 3, True),
    "d15_fourth_hbnc": _nth("hbnc", 4, True),
    "d16_fifth_hbnc": _nth("hbnc", 5, True),
    "d17_sixth_hbnc": _nth("hbnc", 6, True, PLACE),
    "d18_seventh_hbnc": _nth("hbnc", 7, True, PLACE),
    "d19_first_hbyc": _nth("hbyc", 1, True),
    "d20_fifth_hbyc": _nth("hbyc", 5, True),
    "d21_mother_child": vaccines.mother_child,
    "d22_primary_series": _series("primary"),
    "d23_booster_series": _series("booster"),
    "d24_fp_delivery": _fp_delivery,
    "d25_pmsma_visits": _pmsma,
    "d26_first_td": lambda run: _dose(run, visits.first_td_doses(run)),
    "d27_second_td": lambda run: _dose(run, visits.period_td_doses(run, True, False)),
    "d28_td_booster": lambda run: _dose(run, visits.period_td_doses(run, False, True)),
    "d29_tb_followups": _tb_followups,
    "d30_tb_confirmed": tuberculosis.confirmed,
    "d31_tb_completed": tuberculosis.completed,
    "d32_tb_latest": tuberculosis.latest_by_type,
}


def _scope_both(run: Run) -> DataFrame:
    rows = run.scope.created_and_modified(run.tables["anc"])
    return run.scope.named(rows).select("worker", F.col("id").alias("visit_id"))


def _scope_either(run: Run) -> DataFrame:
    people = run.people_of_workers().select("person_id", F.explode("workers").alias("w"))
    people = people.select("person_id", "w.worker_id", F.col("w.copies").alias("matches"))
    return run.scope.named(people).select("worker", "person_id", F.col("matches").cast("bigint"))


def _scope_modified(run: Run) -> DataFrame:
    rows = run.scope.modified(run.tables["household"])
    return run.scope.named(rows).select("worker", F.col("id").alias("household_id"))


def _edge_members(run: Run) -> DataFrame:
    return vaccines.family_members(vaccines.mother_child(run)).select("person_id", "mother_id")


def _window(test: Callable) -> Dataset:
    def build(run: Run) -> DataFrame:
        rows = run.tables["cbac"].where(test("encounter_date_time", run.params))
        return rows.select("id", "individual_id", "encounter_date_time")

    return build


def _or_inequality(run: Run) -> DataFrame:
    rows = run.tables["hbnc"].where(neither_nor_as_written(F.col("place_of_delivery")))
    return rows.groupBy("place_of_delivery").agg(F.count("*").alias("visits"))


def _between_not_null(run: Run) -> DataFrame:
    known = between_is_known(F.col("last_modified_date_time"))
    return run.tables["household"].select("id", known.alias("known"))


def _age_years(run: Run) -> DataFrame:
    age = full_years(run.params.today, F.col("date_of_birth"))
    return run.tables["individual"].select("id", age.cast("bigint").alias("age_in_years"))


def _age_interval(run: Run) -> DataFrame:
    due = between_one_and_six_months(run.params.today, F.col("tb_status_date"))
    return run.tables["tb_followup"].select("id", due.alias("in_treatment"))


def _digits(run: Run) -> DataFrame:
    gap = F.col("gap_text")
    return run.tables["family_planning"].select(
        "id", digits_number(gap).try_cast("bigint").alias("months"), digits_at_least(gap, 36).alias("spaced")
    )


def _filtered_max(run: Run) -> DataFrame:
    return tuberculosis.latest_encounters(run).select("person_id", "latest_encounter")


def _group_finer(run: Run) -> DataFrame:
    at = F.col("completion_date")
    return (
        run.tables["checklist_item"]
        .where(at.isNotNull())
        .groupBy("checklist_item_detail_id", at)
        .agg(F.count("*").alias("items"))
        .select("checklist_item_detail_id", day_text("completion_date").alias("completion_day"), "items")
    )


def _nulls_last(run: Run) -> DataFrame:
    rows = run.tables["hbnc"].select("id", "individual_id", "encounter_date_time")
    by = ByTime("encounter_date_time", "id")
    return number_rows(rows, ["individual_id"], by, "nth").drop("encounter_date_time")


def _nulls_first(run: Run) -> DataFrame:
    rows = run.tables["hbnc"].select("id", "individual_id", "encounter_date_time")
    by = ByTime("encounter_date_time", "id", descending=True)
    return number_rows(rows, ["individual_id"], by, "nth").drop("encounter_date_time")


# Single operators over whole tables, for all workers.
OPERATORS: dict[str, Dataset] = {
    "scope_both": _scope_both,
    "scope_either": _scope_either,
    "scope_modified": _scope_modified,
    "edge_members": _edge_members,
    "window_days": _window(on_days),
    "window_instants": _window(at_instants),
    "or_inequality": _or_inequality,
    "between_not_null": _between_not_null,
    "age_years": _age_years,
    "age_interval": _age_interval,
    "digits_numeric": _digits,
    "filtered_max": _filtered_max,
    "group_finer": _group_finer,
    "null_order_asc": _nulls_last,
    "null_order_desc": _nulls_first,
}
