"""The claim rules: what each pays, whom it credits, and the lines they yield.

Every rule reduces to tuples of (rule, person, completion, registration), each at most
once per worker. The tuples of all requested rules go through one join with the people
and one aggregation, so counting rows equals counting distinct people.
"""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions.ages import full_years
from claimwright.functions.periods import day_text
from claimwright.plans import family, tuberculosis, vaccines, visits
from claimwright.plans.run import Run, any_of, union_all, variants


class Scope(Enum):
    """Whose claim a rule is."""

    BOTH = "the worker created and last modified the visit"
    EITHER = "the worker created or last modified the person"
    UNSCOPED = "every worker's, whoever registered the person"


@dataclass(frozen=True)
class Rule:
    code: str
    rate: int
    scope: Scope
    live_people: bool = True
    # Grouped by the full timestamp but shown as its day: equal lines can repeat.
    instant_completion: bool = False
    instant_registration: bool = False


# Codes and rates of the thirty rules.
RULES: dict[str, Rule] = {
    "r01": Rule("C1.1", 100, Scope.BOTH),
    "r02": Rule("C1.3", 100, Scope.BOTH),
    "r03": Rule("C1.5", 100, Scope.BOTH),
    "r04": Rule("C1.5", 100, Scope.BOTH),
    "r05": Rule("C1.8", 200, Scope.UNSCOPED, live_people=False),
    "r06": Rule("C1.9", 100, Scope.BOTH),
    "r07": Rule("I1.1", 100, Scope.UNSCOPED),
    "r08": Rule("I2.1", 300, Scope.UNSCOPED, live_people=False),
    "r09": Rule("I2.2", 400, Scope.UNSCOPED, live_people=False),
    "r10": Rule("I2.3", 400, Scope.EITHER),
    "r11": Rule("I2.4", 300, Scope.EITHER),
    "r12": Rule("I2.5", 150, Scope.EITHER),
    "r13": Rule("I2.7", 500, Scope.EITHER, live_people=False),
    "r14": Rule("I2.8", 1000, Scope.EITHER, live_people=False),
    "r15": Rule("C3.4", 100, Scope.EITHER, instant_completion=True, instant_registration=True),
    "r16": Rule("C3.5", 75, Scope.EITHER, instant_completion=True, instant_registration=True),
    "r17": Rule("C3.6", 50, Scope.EITHER),
    "r18": Rule("C4.1", 250, Scope.BOTH),
    "r19": Rule("C4.1", 250, Scope.BOTH),
    "r20": Rule("C4.1", 250, Scope.BOTH),
    "r21": Rule("C4.7", 50, Scope.BOTH),
    "r22": Rule("C7.1", 10, Scope.EITHER),
    "r23": Rule("I1.4", 300, Scope.EITHER, instant_completion=True),
    "r24": Rule("I1.5", 200, Scope.EITHER, instant_completion=True),
    "r25": Rule("C2.4", 100, Scope.EITHER),
    "r26": Rule("I8.1", 500, Scope.EITHER),
    "r27": Rule("I8.13", 300, Scope.EITHER, live_people=False),
    "r28": Rule("I8.14", 2000, Scope.EITHER, live_people=False),
    "r29": Rule("I8.15", 3000, Scope.EITHER, live_people=False),
    "r30": Rule("I8.17", 1000, Scope.EITHER, live_people=False),
}

# Rules that differ in code and rate only: evaluated once, priced for each.
SAME_TUPLES = {"r24": "r23"}

LINE_COLUMNS = (
    "code",
    "rate",
    "beneficiary_count",
    "total_claim_amount",
    "work_completion_date",
    "date_of_registration",
)

_KEYS = ("rule", "person_id", "completion", "registration")


def _on_one_day(rule: str, rows: DataFrame, day: Column) -> DataFrame:
    """Tuples of a rule whose completion and registration are the same day."""
    return rows.select("individual_id", day.alias("day")).select(
        F.lit(rule).alias("rule"),
        F.col("individual_id").alias("person_id"),
        F.col("day").alias("completion"),
        F.col("day").alias("registration"),
    )


def _cbac(run: Run) -> DataFrame:
    rows = run.tables["cbac"].where(run.at_instants("encounter_date_time"))
    return _on_one_day("r22", run.narrow(rows), day_text("encounter_date_time"))


def _antra(run: Run) -> DataFrame:
    rows = run.tables["individual"].where(run.at_instants("date_of_antra_injection"))
    rows = run.narrow(rows, "id").withColumnRenamed("id", "individual_id")
    return _on_one_day("r25", rows, F.col("date_of_antra_injection").cast("string"))


def _encephalitis(run: Run) -> DataFrame:
    rows = run.tables["acute_encephalitis"].where(
        run.on_days("enrolment_date_time") & (F.col("referred_to") != "Other private hospital")
    )
    return _on_one_day("r27", run.narrow(rows), day_text("enrolment_date_time"))


def _visit_tuples(run: Run, rules: set[str]) -> list[DataFrame]:
    """Tuples whose worker is the visit's."""
    frames = [visits.nth_visit_claims(run, rules), visits.td_claims(run, rules)]
    return [df for df in frames if df is not None]


def _person_tuples(run: Run, rules: set[str]) -> list[DataFrame]:
    """Tuples credited to the workers of the person."""
    # A person's many events on a day have to become one tuple before the join.
    repeated = {
        "r13": family.spaced_children,
        "r14": family.sterilised_after_two,
        "r22": _cbac,
        "r27": _encephalitis,
    }
    distinct = {
        "r11": family.planning_after_abortion,
        "r23": vaccines.birth_doses,
        "r25": _antra,
        "r26": tuberculosis.confirmed_cases,
    }
    frames = []
    events = [build(run).select(*_KEYS) for rule, build in repeated.items() if rule in rules]
    if events:
        frames.append(union_all(events).distinct())
    frames += [build(run) for rule, build in distinct.items() if rule in rules]
    frames += [
        df
        for df in (
            family.method_after_delivery(run, rules),
            tuberculosis.treatment_claims(run, rules),
            vaccines.vaccine_claims(run, rules),
        )
        if df is not None
    ]
    return frames


def _scheme_tuples(run: Run) -> DataFrame:
    """r07: days of scheme visits, whoever made them; the visit itself may be voided."""
    rows = run.tables["anc"].where((F.col("pmsma") == "Yes") & run.on_days("encounter_date_time"))
    return _on_one_day("r07", rows, day_text("encounter_date_time")).distinct()


def _people_lines(run: Run, rules: set[str]) -> DataFrame:
    """Lines of the rules on the people themselves: the people are counted as they are read."""
    sterilised = F.col("date_of_sterilization").cast("string")
    in_period = run.on_days("date_of_sterilization")
    choices = [
        (test, F.struct(F.lit(rule).alias("rule"), day.alias("day")))
        for rule, test, day in (
            ("r05", run.at_instants("date_of_death"), day_text("date_of_death")),
            ("r08", (F.col("gender") == "Female") & in_period, sterilised),
            ("r09", (F.col("gender") == "Male") & in_period, sterilised),
        )
        if rule in rules
    ]
    return (
        run.tables["individual"]
        .where(any_of(*choices))
        .select(variants(*choices).alias("c"))
        .select(
            F.lit(None).cast("bigint").alias("worker_id"),
            "c.rule",
            F.col("c.day").alias("completion"),
            F.col("c.day").alias("registration"),
            _no_day("latest"),
        )
    )


_OPTIONAL = {"worker_id": "bigint", "latest": "date", "items": "bigint"}


def _with_columns(df: DataFrame) -> DataFrame:
    present = set(df.columns)
    optional = [
        F.col(name) if name in present else F.lit(None).cast(kind).alias(name)
        for name, kind in _OPTIONAL.items()
    ]
    return df.select(*_KEYS, *optional)


def _met_people(run: Run, rules: set[str], tuples: DataFrame) -> DataFrame:
    """Tuples of qualifying people with the worker they are credited to.

    One join serves every rule: it tells whether the person is live, how old, and who the
    workers are where the rule goes by the person.
    """
    by_person = sorted(rule for rule in rules if RULES[rule].scope is Scope.EITHER)
    people = run.people(everyone=len(by_person) < len(rules))
    own = F.expr("array(named_struct('worker_id', worker_id, 'copies', 1))")
    credited = F.when(F.col("rule").isin(by_person), F.col("workers")).otherwise(own)

    voided_too = sorted(rule for rule in rules if not RULES[rule].live_people)
    qualifies = F.col("is_live") | F.col("rule").isin(voided_too)
    age = full_years(run.params.today, F.col("date_of_birth"))
    items = F.col("items") * F.col("w.copies")
    if "r15" in rules:
        qualifies = qualifies & ((F.col("rule") != "r15") | ((items == 5) & (age <= 1)))
    if "r16" in rules:
        qualifies = qualifies & ((F.col("rule") != "r16") | ((items >= 4) & (age <= 2)))
    return (
        tuples.join(people, "person_id")
        .select("*", F.explode(credited).alias("w"))
        .where(qualifies)
        .select(
            F.col("w.worker_id").alias("worker_id"), "rule", "completion", "registration", "latest"
        )
    )


def _no_day(name: str) -> Column:
    return F.lit(None).cast("date").alias(name)


def priced_lines(run: Run, rules: list[str]) -> DataFrame:
    """Claim lines of the given rules: ``worker_id`` (null for unscoped rules), ``rule`` and LINE_COLUMNS."""
    priced = {rule: SAME_TUPLES.get(rule, rule) for rule in rules}
    evaluated = set(priced.values())
    frames = _visit_tuples(run, evaluated) + _person_tuples(run, evaluated)
    if "r07" in evaluated:
        frames.append(_scheme_tuples(run))
    on_people = evaluated & {"r05", "r08", "r09"}
    credited = []
    if frames:
        tuples = union_all([_with_columns(df) for df in frames])
        credited.append(_met_people(run, evaluated - on_people, tuples))
    if on_people:
        credited.append(_people_lines(run, on_people))
    tuples = union_all(credited)
    counted = tuples.groupBy("worker_id", "rule", "completion", "registration").agg(
        F.count("*").alias("beneficiary_count"), F.max("latest").alias("latest")
    )
    prices: dict[str, list[str]] = {}
    for rule, source in priced.items():
        terms = RULES[rule]
        prices.setdefault(source, []).append(
            f"named_struct('rule', '{rule}', 'code', '{terms.code}', 'rate', {terms.rate}, "
            f"'instant_completion', {terms.instant_completion}, "
            f"'instant_registration', {terms.instant_registration})"
        )
    listed = ", ".join(f"'{source}', array({', '.join(terms)})" for source, terms in prices.items())

    def shown(side: str) -> Column:
        return F.when(F.col(f"p.instant_{side}"), F.substring(side, 1, 10)).otherwise(F.col(side))

    # In treatment (r28) the latest visit is an aggregate, not a group key.
    completion = F.when(F.col("p.rule") == "r28", F.col("latest").cast("string")).otherwise(
        shown("completion")
    )
    return counted.select("*", F.expr(f"explode(map({listed})[rule])").alias("p")).select(
        "worker_id",
        F.col("p.rule").alias("rule"),
        F.col("p.code").alias("code"),
        F.col("p.rate").alias("rate"),
        "beneficiary_count",
        (F.col("beneficiary_count") * F.col("p.rate")).cast("string").alias("total_claim_amount"),
        completion.alias("work_completion_date"),
        shown("registration").alias("date_of_registration"),
    )
