"""Numbered antenatal, newborn and young-child visits, and the rules on the nth visit."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions.periods import day_text, live
from claimwright.operators.key_filter import KeyFilter, worth_filtering
from claimwright.operators.numbering import ByTime, first_k, number_rows, running_copies
from claimwright.plans.run import Run, union_all, variants

PROGRAM = {"anc": "pregnancy", "hbnc": "child", "hbyc": "child"}

# Last visit number any rule or dataset asks for.
LAST_VISIT = {"anc": 8, "hbnc": 7, "hbyc": 5}

# The visits that rules pair: kind, visit number and what else has to hold. The place test
# of the sixth newborn visit passes for every known place: it is "not home or not in transit".
CELLS: dict[str, tuple[str, int, str]] = {
    "anc_1": ("anc", 1, "true"),
    "anc_2_tablets": ("anc", 2, "note = 'Yes'"),
    "anc_4": ("anc", 4, "true"),
    "anc_8": ("anc", 8, "true"),
    "hbnc_1": ("hbnc", 1, "true"),
    "hbnc_2": ("hbnc", 2, "true"),
    "hbnc_3": ("hbnc", 3, "true"),
    "hbnc_6_normal": ("hbnc", 6, "note is not null and mode <> 'C-section'"),
    "hbnc_6_section": ("hbnc", 6, "note is not null and mode = 'C-section'"),
    "hbnc_7_outside": ("hbnc", 7, "note in ('Home', 'In-transit')"),
    "hbyc_5": ("hbyc", 5, "true"),
}


@dataclass(frozen=True)
class Pairing:
    """A visit in the period that completes a rule, and the one that registered it."""

    done: str
    registered: str
    # The registering visit has to be in the period, too, to be shown.
    dated: bool = False
    # Without a registering visit there is no claim.
    needed: bool = False


PAIRINGS: dict[str, Pairing] = {
    "r01": Pairing("anc_4", "anc_1"),
    "r02": Pairing("anc_4", "anc_2_tablets", needed=True),
    "r06": Pairing("anc_8", "anc_1"),
    "r18": Pairing("hbnc_6_normal", "hbnc_2", dated=True),
    "r19": Pairing("hbnc_6_section", "hbnc_3", dated=True),
    "r20": Pairing("hbnc_7_outside", "hbnc_1", dated=True),
    "r21": Pairing("hbyc_5", "hbnc_1", dated=True),
}

VISITOR = ("worker_id", "visitor_id")


# Earliest first, unknown times last, the encounter id deciding ties.
BY_TIME = ByTime("at", "visit_id")


def _encounters(run: Run, kind: str) -> DataFrame:
    rows = run.tables[kind].where(live(F.col("is_voided")))
    if kind == "anc":
        rows = rows.where(F.col("encounter_date_time").isNotNull())
    return rows


def _valid_enrolments(run: Run, kinds: list[str]) -> DataFrame:
    """Enrolments that are not voided: program, id and ``person_id``."""
    return union_all(
        [
            run.tables[program]
            .where(live(F.col("is_voided")))
            .select(
                F.lit(program).alias("program"),
                F.col("id").alias("enrolment_id"),
                F.col("individual_id").alias("person_id"),
            )
            for program in sorted({PROGRAM[kind] for kind in kinds})
        ]
    )


def _in_valid_enrolments(run: Run, rows: DataFrame, kinds: list[str]) -> DataFrame:
    """Rows whose enrolment exists and is not voided, with the enrolment's ``person_id``."""
    enrolments = _valid_enrolments(run, kinds)
    if len({PROGRAM[kind] for kind in kinds}) == 1:
        return rows.join(enrolments.drop("program"), "enrolment_id")
    return rows.join(enrolments, ["program", "enrolment_id"])


def _enrolments_of_active(run: Run, kinds: list[str], active: DataFrame) -> DataFrame:
    """Enrolments, at least all, of the people who have one among ``active``."""
    enrolments = _valid_enrolments(run, kinds)
    named = enrolments.where(KeyFilter(active, "enrolment_id").may_hold("enrolment_id"))
    return enrolments.where(KeyFilter(named, "person_id").may_hold("person_id"))


def _active_visitors(run: Run, kinds: list[str]) -> KeyFilter:
    """Encounter persons whose visits can matter to a claim of the period.

    A claim needs a visit in the period, and the visits of everyone whose encounters belong
    to an enrolment of the same person. Found by filters alone, from the period's scan on:
    no visit is shuffled for it, and visits of other people are not shuffled later.
    """

    def encounters(*tests: Column) -> DataFrame:
        return union_all(
            [
                _encounters(run, kind)
                .where(reduce(Column.__and__, tests, F.lit(True)))
                .select(F.col("program_enrolment_id").alias("enrolment_id"), "individual_id")
                for kind in kinds
            ]
        )

    active = encounters(run.on_days("encounter_date_time"))
    theirs = KeyFilter(_enrolments_of_active(run, kinds, active), "enrolment_id")
    return KeyFilter(encounters(theirs.may_hold("program_enrolment_id")), "individual_id")


def _many_visits(run: Run, kinds: list[str]) -> bool:
    """Whether filtering the visits pays; those of one worker are few already."""
    return not run.for_one_worker and any(worth_filtering(run.tables[kind]) for kind in kinds)


def worker_visits(run: Run, kinds: list[str], visitors: KeyFilter | None = None) -> DataFrame:
    """Valid visits created and modified by the same worker, at least those of ``visitors``.

    ``person_id`` is the person of the enrolment, who is paid for and must not be voided;
    ``visitor_id`` is the person of the encounter, by whom visits are numbered.
    ``note`` and ``mode`` hold the kind's own columns: tablets issued for antenatal
    visits, place and type of delivery for newborn visits.
    """
    frames = []
    for kind in kinds:
        rows = _encounters(run, kind)
        if visitors is not None:
            rows = rows.where(visitors.may_hold("individual_id"))
        rows = run.scope.created_and_modified(rows)
        note, mode = {
            "anc": (F.col("ifa_180"), F.lit(None).cast("string")),
            "hbnc": (F.col("place_of_delivery"), F.col("delivery_type")),
            "hbyc": (F.lit(None).cast("string"), F.lit(None).cast("string")),
        }[kind]
        frames.append(
            rows.select(
                F.lit(kind).alias("kind"),
                F.lit(PROGRAM[kind]).alias("program"),
                F.col("program_enrolment_id").alias("enrolment_id"),
                "worker_id",
                F.col("individual_id").alias("visitor_id"),
                F.col("id").alias("visit_id"),
                F.col("encounter_date_time").alias("at"),
                note.alias("note"),
                mode.alias("mode"),
            )
        )
    valid = _in_valid_enrolments(run, union_all(frames), kinds)
    # Visits of a voided person do not count towards the numbers of others.
    return valid.drop("program", "enrolment_id").join(run.live_people(), "person_id", "left_semi")


def abortion_rows(run: Run) -> DataFrame:
    """Abortion rows per person: each antenatal visit is met once per row."""
    return (
        run.tables["abortion"]
        .groupBy(F.col("individual_id").alias("person_id"))
        .agg(F.count("*").alias("abortions"))
    )


def repeated_visits(
    run: Run, kinds: list[str], visitors: KeyFilter | None = None
) -> DataFrame:
    """Valid visits with ``copies``, the rows each has after meeting the abortions.

    The copies of an antenatal visit tie with each other and with nothing else, so they take
    consecutive visit numbers, and no copy has to be made to know them. The person of the
    enrolment had the abortions: visits of one visitor can have uneven copies.
    """
    visits = worker_visits(run, kinds, visitors)
    if "anc" not in kinds:
        return visits.withColumn("copies", F.lit(1).cast("bigint"))
    met = F.when(F.col("kind") == "anc", F.col("abortions"))
    return visits.join(abortion_rows(run), "person_id", "left").withColumn(
        "copies", F.coalesce(met, F.lit(1))
    ).drop("abortions")


def numbered_visits(run: Run, kind: str) -> DataFrame:
    """All visits of a kind with their visit numbers.

    An antenatal visit that meets several abortion rows has a range of numbers.
    """
    visits = repeated_visits(run, [kind])
    if kind != "anc":
        return number_rows(visits, VISITOR, BY_TIME, "visit_number")
    numbered = number_rows(visits, VISITOR, BY_TIME, "last_visit_number", "copies")
    first = F.col("last_visit_number") - F.col("copies") + 1
    return numbered.withColumn("first_visit_number", first)


def _first_visits(
    run: Run, kinds: list[str], k: int, visitors: KeyFilter | None = None
) -> DataFrame:
    """Each visitor's visits with a number up to ``k``, the last of its numbers being ``last``."""
    keys = [*VISITOR, "kind"]
    visits = first_k(repeated_visits(run, kinds, visitors), keys, BY_TIME.order(), k)
    return visits.withColumn("last", running_copies(keys, BY_TIME.order(), "copies"))


def _has_number(n: int) -> str:
    return f"(last - copies < {n} and last >= {n})"


def nth_visit(run: Run, kind: str, n: int, in_period: bool) -> DataFrame:
    """The nth visits of a kind: person, day and the kind's own columns.

    A person has several if encounters of several persons belong to its enrolments.
    """
    visits = _first_visits(run, [kind], n).where(_has_number(n)).withColumn("day", F.to_date("at"))
    if in_period:
        visits = visits.where(run.on_days("day"))
    return visits.select("worker_id", "person_id", "day", "note", "mode")


def _paired_days(run: Run, cells: list[str]) -> DataFrame:
    """One row per worker and person: ``days``, the different days of its cells.

    Every kind is scanned once, whatever the number of rules that read it. Each visit says
    which cells it is of (bit i for the i-th), and equal days are joined before the shuffle:
    ``days`` grows with the calendar, not with the visits or the visitors.
    """
    kinds = sorted({CELLS[cell][0] for cell in cells})
    visitors = _active_visitors(run, kinds) if _many_visits(run, kinds) else None
    numbered = _first_visits(run, kinds, max(LAST_VISIT[kind] for kind in kinds), visitors)

    def bit(i: int, cell: str) -> str:
        kind, n, test = CELLS[cell]
        return f"if(kind = '{kind}' and {_has_number(n)} and {test}, {1 << i}, 0)"

    held = F.expr(" | ".join(bit(i, cell) for i, cell in enumerate(cells)))
    return (
        numbered.select(*VISITOR[:1], "person_id", F.to_date("at").alias("day"), held.alias("cells"))
        .where("cells <> 0 and day is not null")
        .groupBy("worker_id", "person_id")
        .agg(F.collect_set(F.struct("day", "cells")).alias("days"))
    )


def nth_visit_claims(run: Run, rules: set[str]) -> DataFrame | None:
    """Claim tuples of the rules that pair one visit with an earlier one.

    A person's days of one cell meet those of the other: all of them, as several encounter
    persons can each have an nth visit that belongs to the person.
    """
    wanted = [rule for rule in PAIRINGS if rule in rules]
    if not wanted:
        return None
    cells = [
        cell
        for cell in CELLS
        if any(cell in (PAIRINGS[rule].done, PAIRINGS[rule].registered) for rule in wanted)
    ]

    def days_of(cell: str, dated: bool) -> Column:
        def belongs(d: Column) -> Column:
            here = d["cells"].bitwiseAND(F.lit(1 << cells.index(cell))) != 0
            if dated:
                here = here & d["day"].between(F.lit(run.params.from_date), F.lit(run.params.to_date))
            return here

        found = F.filter("days", belongs)
        return F.array_distinct(F.transform(found, lambda d: d["day"].cast("string")))

    def claims(rule: str) -> Column:
        pairing = PAIRINGS[rule]
        registered = days_of(pairing.registered, pairing.dated)
        if not pairing.needed:
            nothing = F.array(F.lit(None).cast("string"))
            registered = F.when(F.size(registered) == 0, nothing).otherwise(registered)
        return F.flatten(
            F.transform(
                days_of(pairing.done, True),
                lambda done: F.transform(
                    registered,
                    lambda first: F.struct(
                        F.lit(rule).alias("rule"),
                        done.alias("completion"),
                        first.alias("registration"),
                    ),
                ),
            )
        )

    return (
        _paired_days(run, cells)
        .select("worker_id", "person_id", F.explode(F.concat(*map(claims, wanted))).alias("c"))
        .select("worker_id", "c.rule", "person_id", "c.completion", "c.registration")
    )


def _doses(run: Run, rows: DataFrame, *choices: tuple[str, Column]) -> DataFrame:
    """Distinct (worker, person, dose, day) of valid antenatal visits."""
    doses = variants(
        *(
            (day.isNotNull(), F.struct(F.lit(name).alias("dose"), day.alias("day")))
            for name, day in choices
        )
    )
    rows = run.scope.created_and_modified(rows).select(
        F.col("program_enrolment_id").alias("enrolment_id"),
        "worker_id",
        doses.alias("d"),
    )
    return (
        _in_valid_enrolments(run, rows, ["anc"])
        .select("worker_id", "person_id", "d.dose", "d.day")
        .distinct()
    )


def first_td_doses(run: Run, enrolments: KeyFilter | None = None) -> DataFrame:
    """Each distinct first-dose day of a person, whenever it was."""
    rows = _encounters(run, "anc").where(F.col("td1").isNotNull())
    if enrolments is not None:
        rows = rows.where(enrolments.may_hold("program_enrolment_id"))
    return _doses(run, rows, ("first", F.col("td1").cast("date")))


def period_td_doses(run: Run, second: bool, booster: bool) -> DataFrame:
    """Second doses (with the first on the same visit) and boosters of visits in the period."""
    rows = _encounters(run, "anc").where(run.on_days("encounter_date_time"))
    choices = []
    if second:
        day = F.when(F.col("td1").isNotNull(), F.col("td2").cast("date"))
        choices.append(("second", day))
    if booster:
        choices.append(("booster", F.col("td_booster").cast("date")))
    known = F.lit(False)
    for _, day in choices:
        known = known | day.isNotNull()
    return _doses(run, rows.where(known), *choices)


def td_claims(run: Run, rules: set[str]) -> DataFrame | None:
    """Claim tuples of the second dose and the booster."""
    second, booster = "r03" in rules, "r04" in rules
    if not (second or booster):
        return None
    doses = period_td_doses(run, second, booster)
    registered = F.col("day")
    if second:
        enrolments = None
        if _many_visits(run, ["anc"]):
            dosed = _encounters(run, "anc").where(
                run.on_days("encounter_date_time") & F.col("td2").isNotNull()
            )
            dosed = dosed.select(F.col("program_enrolment_id").alias("enrolment_id"))
            enrolments = KeyFilter(_enrolments_of_active(run, ["anc"], dosed), "enrolment_id")
        firsts = first_td_doses(run, enrolments).select(
            "worker_id",
            "person_id",
            F.lit("second").alias("dose"),
            F.col("day").alias("first_day"),
        )
        doses = doses.join(firsts, ["worker_id", "person_id", "dose"], "left")
        registered = F.when(F.col("dose") == "second", F.col("first_day")).otherwise(registered)
    rule = F.when(F.col("dose") == "second", "r03").otherwise("r04")
    return doses.withColumn("registered", registered).select(
        "worker_id",
        rule.alias("rule"),
        "person_id",
        day_text("day").alias("completion"),
        day_text("registered").alias("registration"),
    )


def pmsma_visits(run: Run) -> DataFrame:
    """Distinct days a worker's person had a visit under the monthly scheme."""
    rows = run.scope.created_and_modified(
        _encounters(run, "anc").where(
            (F.col("pmsma") == "Yes") & run.on_days("encounter_date_time")
        )
    ).select(
        F.col("program_enrolment_id").alias("enrolment_id"),
        "worker_id",
        F.to_date("encounter_date_time").alias("day"),
    )
    return (
        _in_valid_enrolments(run, rows, ["anc"])
        .select("worker_id", "person_id", "day")
        .distinct()
        .join(run.live_people(), "person_id")
    )
