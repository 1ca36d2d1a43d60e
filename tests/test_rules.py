"""Hand-made rows for the traps of single rules."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

from claimwright.params import ReportParams
from claimwright.plans import report, tuberculosis, vaccines, visits
from claimwright.plans.catalog import DATASETS
from claimwright.plans.run import Run
from tests.tables import WORKERS, make_tables, person, visit

PERIOD = ReportParams("2024-01-01", "2024-01-31", username="anu", as_of="2024-02-01")


def run_of(spark, params=PERIOD, **rows) -> Run:
    return Run(make_tables(spark, **{"users": WORKERS, **rows}), params)


def lines(run: Run, rule: str) -> list[tuple]:
    rows = report.claims(run, [rule]).collect()
    return sorted(
        (r.beneficiary_count, r.work_completion_date, r.date_of_registration or "") for r in rows
    )


def jan(day: int, *time: int) -> datetime:
    return datetime(2024, 1, day, *time)


PREGNANCY = {"id": 10, "individual_id": 100, "is_voided": False}
CHILD = {"id": 10, "individual_id": 100, "is_voided": False}


def test_fourth_visit_without_abortion(spark):
    anc = [visit(n, 100, jan(n)) for n in (1, 2, 3, 4)]
    run = run_of(spark, individual=[person(100)], pregnancy=[PREGNANCY], anc=anc)
    assert lines(run, "r01") == [(1, "2024-01-04", "2024-01-01")]


def test_a_visit_pays_for_the_person_of_its_enrolment(spark):
    anc = [visit(n, 200, jan(n)) for n in (1, 2, 3, 4)]
    people = [person(100), person(200, is_voided=True)]
    run = run_of(spark, individual=people, pregnancy=[PREGNANCY], anc=anc)
    assert lines(run, "r01") == [(1, "2024-01-04", "2024-01-01")]
    voided = [person(100, is_voided=True), person(200)]
    run = run_of(spark, individual=voided, pregnancy=[PREGNANCY], anc=anc)
    assert lines(run, "r01") == []


def two_visitors(first, second, **columns):
    """Visits of two encounter persons in one enrolment, by their days."""
    return [visit(n, 200, at, **columns) for n, at in enumerate(first)] + [
        visit(100 + n, 300, at, **columns) for n, at in enumerate(second)
    ]


def test_nth_visits_of_several_encounter_persons_are_crossed(spark):
    anc = two_visitors(
        [jan(1), jan(2), jan(4), jan(10)], [jan(3), jan(5), jan(6), jan(12)], ifa_180="Yes"
    )
    rows = {"individual": [person(100)], "pregnancy": [PREGNANCY], "anc": anc}
    run = run_of(spark, **rows)
    assert lines(run, "r01") == [
        (1, "2024-01-10", "2024-01-01"),
        (1, "2024-01-10", "2024-01-03"),
        (1, "2024-01-12", "2024-01-01"),
        (1, "2024-01-12", "2024-01-03"),
    ]
    assert lines(run, "r02") == [
        (1, "2024-01-10", "2024-01-02"),
        (1, "2024-01-10", "2024-01-05"),
        (1, "2024-01-12", "2024-01-02"),
        (1, "2024-01-12", "2024-01-05"),
    ]
    # Equal days are one, for the person is counted once.
    same = two_visitors([jan(n) for n in (1, 2, 4, 10)], [jan(n) for n in (1, 3, 5, 10)])
    assert lines(run_of(spark, **{**rows, "anc": same}), "r01") == [(1, "2024-01-10", "2024-01-01")]
    assert [r.visit_date for r in DATASETS["d09_fourth_anc"](run).orderBy("visit_date").collect()] == [
        date(2024, 1, 10), date(2024, 1, 12),
    ]


def test_newborn_visits_of_several_encounter_persons_are_crossed(spark):
    hbnc = two_visitors(
        [jan(n) for n in range(1, 7)],
        [jan(n) for n in range(11, 17)],
        place_of_delivery="Hospital",
        delivery_type="Normal",
    )
    run = run_of(spark, individual=[person(100)], child=[CHILD], hbnc=hbnc)
    assert lines(run, "r18") == [
        (1, done, first)
        for done in ("2024-01-06", "2024-01-16")
        for first in ("2024-01-02", "2024-01-12")
    ]


def test_one_encounter_person_in_enrolments_with_uneven_abortions(spark):
    # Person 100 had two abortions, person 101 none: the visits count 2, 1, 2, 1 rows.
    anc = [visit(n, 200, jan(n), enrolment=10 + (n + 1) % 2) for n in (1, 2, 3, 4)]
    run = run_of(
        spark,
        individual=[person(100), person(101)],
        pregnancy=[PREGNANCY, {"id": 11, "individual_id": 101, "is_voided": False}],
        anc=anc,
        abortion=[{"id": 1, "individual_id": 100}, {"id": 2, "individual_id": 100}],
    )
    numbered = visits.numbered_visits(run, "anc").orderBy("at").collect()
    assert [(r.first_visit_number, r.last_visit_number) for r in numbered] == [
        (1, 2), (3, 3), (4, 5), (6, 6),
    ]
    # The fourth row is the second visit of person 100, whose first row is its first visit.
    assert lines(run, "r01") == [(1, "2024-01-03", "2024-01-01")]


def test_planning_join_is_counted_whoever_the_people_are(spark):
    run = run_of(
        spark,
        individual=[person(100, worker=2), person(101, is_voided=True)],
        family_planning=[
            {"id": n, "individual_id": 100 + n % 2, "enrolment_date_time": jan(n + 1)} for n in range(4)
        ]
        + [{"id": 9, "individual_id": 100, "program_exit_date_time": jan(1)}],
        pregnancy=[{"id": n, "individual_id": 100 + n % 2} for n in range(6)],
        delivery=[{"id": n, "individual_id": 100 + n % 2, "date_of_delivery": date(2024, 1, 2)} for n in range(3)],
        fp_followup=[{"id": n, "individual_id": 100, "date_of_copper_t": date(2024, 1, n)} for n in range(1, 6)],
    )
    t, key = run.tables, "individual_id"
    plain = (
        t["individual"].where("not is_voided").withColumnRenamed("id", key)
        .join(t["family_planning"].where("program_exit_date_time is null"), key)
        .join(t["pregnancy"].where("program_exit_date_time is null").select(key), key)
        .join(t["delivery"].where("cancel_date_time is null").select(key, "date_of_delivery"), key)
        .join(t["fp_followup"].select(key, "date_of_copper_t"), key)
    )
    legs = DATASETS["d24_fp_delivery"](run).collect()
    for leg, column, source in (
        ("delivery", "date_of_delivery", "date_of_delivery"),
        ("followup", "date_of_copper_t", "date_of_copper_t"),
        ("planning", "planning_enrolment", "enrolment_date_time"),
    ):
        got = Counter()
        for row in legs:
            if row.leg == leg:
                got[row.person_id, row[column], row.created_by_id] += row.copies
        assert got == Counter((r[key], r[source], 2) for r in plain.collect()), leg


def test_two_abortions_number_each_visit_twice(spark):
    anc = [visit(n, 100, jan(n)) for n in (1, 2, 3, 4, 5)]
    run = run_of(
        spark,
        individual=[person(100)],
        pregnancy=[PREGNANCY],
        anc=anc,
        abortion=[{"id": 1, "individual_id": 100}, {"id": 2, "individual_id": 100}],
    )
    assert lines(run, "r01") == [(1, "2024-01-02", "2024-01-01")]  # visit 4 is the 2nd encounter
    assert lines(run, "r06") == [(1, "2024-01-04", "2024-01-01")]  # visit 8 is the 4th
    numbered = visits.numbered_visits(run, "anc").orderBy("at").collect()
    assert [(r.first_visit_number, r.last_visit_number) for r in numbered] == [
        (1, 2), (3, 4), (5, 6), (7, 8), (9, 10),
    ]
    second = DATASETS["d08_second_anc"](run).collect()
    assert [r.visit_date for r in second] == [date(2024, 1, 1)]


def test_numbering_runs_after_void_and_scope_but_before_the_period(spark):
    anc = [
        visit(1, 100, datetime(2023, 12, 1)),
        visit(2, 100, jan(2), is_voided=True),
        visit(3, 100, jan(3), is_voided=None),
        visit(4, 100, jan(4), worker=2),
        visit(5, 100, None),
        visit(6, 100, jan(6), enrolment=11),
        visit(7, 100, jan(7), ifa_180="Yes"),
        visit(8, 100, jan(8)),
        visit(9, 100, jan(9, 23, 59)),
    ]
    pregnancies = [PREGNANCY, {"id": 11, "individual_id": 100, "is_voided": True}]
    run = run_of(spark, individual=[person(100)], pregnancy=pregnancies, anc=anc)
    assert lines(run, "r01") == [(1, "2024-01-09", "2023-12-01")]
    assert lines(run, "r02") == [(1, "2024-01-09", "2024-01-07")]


def test_numbering_runs_across_enrolments(spark):
    anc = [visit(n, 100, jan(n), enrolment=10 + n % 2) for n in (1, 2, 3, 4)]
    pregnancies = [PREGNANCY, {**PREGNANCY, "id": 11}]
    run = run_of(spark, individual=[person(100)], pregnancy=pregnancies, anc=anc)
    assert lines(run, "r01") == [(1, "2024-01-04", "2024-01-01")]


def test_unknown_times_are_the_last_newborn_visits(spark):
    hbnc = [visit(1, 100, None)] + [visit(n, 100, jan(n)) for n in range(2, 8)]
    rows = [{**h, "place_of_delivery": "Home", "delivery_type": "Normal"} for h in hbnc]
    run = run_of(spark, individual=[person(100)], child=[CHILD], hbnc=rows)
    # Six known visits, the unknown one is the seventh. 'Home' passes the place test.
    assert lines(run, "r18") == [(1, "2024-01-07", "2024-01-03")]
    assert lines(run, "r20") == []


def test_unknown_place_fails_and_c_section_takes_the_third_visit(spark):
    def newborn(individual, enrolment, place):
        return [
            visit(100 * individual + n, individual, jan(n), enrolment=enrolment,
                  place_of_delivery=place, delivery_type="C-section")
            for n in range(1, 7)
        ]

    run = run_of(
        spark,
        individual=[person(100), person(101)],
        child=[CHILD, {"id": 11, "individual_id": 101, "is_voided": False}],
        hbnc=newborn(100, 10, "Hospital") + newborn(101, 11, None),
    )
    assert lines(run, "r18") == []
    assert lines(run, "r19") == [(1, "2024-01-06", "2024-01-03")]


def test_registration_outside_the_period_is_blank(spark):
    hbnc = [visit(n, 100, datetime(2023, 12, 20) + timedelta(days=3 * n)) for n in range(1, 8)]
    rows = [{**h, "place_of_delivery": "Hospital", "delivery_type": "Normal"} for h in hbnc]
    run = run_of(spark, individual=[person(100)], child=[CHILD], hbnc=rows)
    assert lines(run, "r18") == [(1, "2024-01-07", "")]


def test_second_dose_pairs_with_every_first_dose(spark):
    anc = [
        visit(1, 100, datetime(2023, 11, 1), td1=date(2023, 11, 1)),
        visit(2, 100, jan(5), td1=date(2023, 12, 1), td2=date(2024, 1, 5), td_booster=date(2024, 1, 6)),
        visit(3, 100, jan(6), td2=date(2024, 1, 9)),
    ]
    run = run_of(spark, individual=[person(100)], pregnancy=[PREGNANCY], anc=anc)
    assert lines(run, "r03") == [(1, "2024-01-05", "2023-11-01"), (1, "2024-01-05", "2023-12-01")]
    assert lines(run, "r04") == [(1, "2024-01-06", "2024-01-06")]


def test_screenings_at_the_end_of_the_period(spark):
    cbac = [
        {"id": 1, "individual_id": 100, "encounter_date_time": jan(31)},
        {"id": 2, "individual_id": 101, "encounter_date_time": jan(31, 0, 1)},
        {"id": 3, "individual_id": 100, "encounter_date_time": jan(30, 9)},
        {"id": 4, "individual_id": 100, "encounter_date_time": jan(30, 18)},
        {"id": 5, "individual_id": 102, "encounter_date_time": jan(30, 18)},
        {"id": 6, "individual_id": 103, "encounter_date_time": jan(30, 18)},
    ]
    people = [person(100), person(101), person(102, is_voided=None), person(103, worker=2)]
    run = run_of(spark, individual=people, cbac=cbac)
    assert lines(run, "r22") == [(1, "2024-01-30", "2024-01-30"), (1, "2024-01-31", "2024-01-31")]


def test_creator_and_modifier_both_claim(spark):
    people = [person(100, created_by_id=1, last_modified_by_id=2)]
    cbac = [{"id": 1, "individual_id": 100, "encounter_date_time": jan(3)}]
    params = ReportParams("2024-01-01", "2024-01-31", as_of="2024-02-01")
    run = run_of(spark, params, individual=people, cbac=cbac)
    assert sorted(r.worker for r in report.claims(run, ["r22"]).collect()) == ["anu", "bina"]


VACCINES = ("BCG", "Pentavalent 3", "OPV 3", "Measles 1", "JE 1", "DPT Booster 2")


def vaccinated(spark, items, born=date(2023, 6, 1), users=WORKERS, **more):
    """A child with completed items given as (vaccine number, time)."""
    return run_of(
        spark,
        **{
            "users": users,
            "individual": [person(100, date_of_birth=born)],
            "child": [CHILD],
            "checklist": [{"id": 1, "program_enrolment_id": 10}],
            "concept": [{"id": n, "name": name} for n, name in enumerate(VACCINES)],
            "checklist_item_detail": [{"id": n, "concept_id": n} for n in range(len(VACCINES))],
            "checklist_item": [
                {"id": k, "checklist_id": 1, "checklist_item_detail_id": n, "completion_date": at}
                for k, (n, at) in enumerate(items)
            ],
            **more,
        },
    )


def test_five_rows_of_one_vaccine_count_as_five(spark):
    items = [(0, jan(2, 9))] * 4 + [(0, jan(20, 10))]
    run = vaccinated(spark, items)
    assert lines(run, "r15") == [(1, "2024-01-20", "2024-01-02")]
    (row,) = vaccines.series(run, "primary").collect()
    assert (row.vaccines_done, row.age_in_years) == (5, 0)


def test_six_rows_or_an_older_child_earn_nothing(spark):
    assert lines(vaccinated(spark, [(0, jan(2))] * 6), "r15") == []
    assert lines(vaccinated(spark, [(0, jan(2))] * 5, born=date(2021, 1, 1)), "r15") == []


def test_shared_usernames_double_the_vaccine_rows(spark):
    users = [{"id": 1, "username": "anu"}, {"id": 2, "username": "anu"}]
    child = [person(100, created_by_id=1, last_modified_by_id=2, date_of_birth=date(2023, 6, 1))]
    run = vaccinated(spark, [(n, jan(2)) for n in range(5)], users=users, individual=child)
    assert [r.vaccines_done for r in vaccines.series(run, "primary").collect()] == [10]
    assert lines(run, "r15") == []


def test_equal_lines_repeat_when_only_the_time_differs(spark):
    people = [person(n, date_of_birth=date(2023, 6, 1)) for n in (100, 101)]
    children = [CHILD, {"id": 11, "individual_id": 101, "is_voided": False}]
    checklists = [{"id": 1, "program_enrolment_id": 10}, {"id": 2, "program_enrolment_id": 11}]
    items = [
        {"id": 10 * c + n, "checklist_id": c, "checklist_item_detail_id": n, "completion_date": jan(2, 8 + c)}
        for c in (1, 2)
        for n in range(5)
    ]
    run = vaccinated(
        spark, [], individual=people, child=children, checklist=checklists, checklist_item=items
    )
    assert lines(run, "r15") == [(1, "2024-01-02", "2024-01-02")] * 2


def test_second_booster_has_no_period(spark):
    run = vaccinated(spark, [(5, datetime(2010, 5, 1, 8)), (5, datetime(2010, 5, 1, 9))])
    assert lines(run, "r17") == [(1, "2010-05-01", "2010-05-01")]


def test_birth_dose_of_mother_or_child_uses_the_mothers_delivery(spark):
    relations = [
        {"id": 1, "individual_a_id": 200, "individual_b_id": 100, "relationship_type_id": 664},
        {"id": 2, "individual_a_id": 200, "individual_b_id": 101, "relationship_type_id": 664},
        {"id": 3, "individual_a_id": 201, "individual_b_id": 100, "relationship_type_id": 700},
        {"id": 4, "individual_a_id": 202, "individual_b_id": 100, "relationship_type_id": 673},
        {"id": 5, "individual_a_id": None, "individual_b_id": 100, "relationship_type_id": 673},
    ]
    deliveries = [
        {"id": 1, "individual_id": 200, "date_of_admission": date(2024, 1, 1), "place_of_delivery": "Home"},
        {"id": 2, "individual_id": 200, "date_of_admission": date(2024, 1, 9), "place_of_delivery": None},
        {"id": 3, "individual_id": 201, "date_of_admission": date(2024, 1, 8), "place_of_delivery": "Home"},
        {"id": 4, "individual_id": 202, "date_of_admission": date(2024, 1, 7), "place_of_delivery": "Home"},
        {"id": 5, "individual_id": 100, "date_of_admission": date(2024, 1, 6), "place_of_delivery": "Home"},
    ]
    run = vaccinated(
        spark,
        [(0, jan(3, 8)), (0, jan(3, 9))],
        individual=[person(100), person(101), person(200), person(201), person(202, is_voided=True)],
        relationship=relations,
        relationship_type=[{"id": 664}, {"id": 673}, {"id": 700}],
        delivery=deliveries,
    )
    assert lines(run, "r23") == [(1, "2024-01-03", "2024-01-01")] * 2
    amounts = [r.total_claim_amount for r in report.claims(run, ["r23", "r24"]).collect()]
    assert sorted(amounts) == ["200", "200", "300", "300"]


def tb(id, at, status, status_date=None, kind="Drug resistant", done=None, individual=100):
    return {
        "id": id,
        "individual_id": individual,
        "encounter_date_time": at,
        "tb_status": status,
        "tb_status_date": status_date,
        "type_of_tb": kind,
        "treatment_completion_date": done,
    }


def test_treatment_shows_the_latest_visit_of_the_type(spark):
    followups = [
        tb(1, jan(1), "Confirmed", date(2024, 1, 2)),
        tb(2, jan(5), "On treatment"),
        tb(3, jan(5), "On treatment"),
        tb(4, jan(1), "Confirmed", date(2024, 2, 20)),  # in the future of the run
    ]
    enrolments = [{"id": n, "individual_id": 100} for n in (1, 2)]
    run = run_of(spark, individual=[person(100)], tb_followup=followups, tuberculosis=enrolments)
    assert lines(run, "r28") == [(1, "2024-01-05", "2024-01-02")]
    numbered = tuberculosis.numbered_followups(run).orderBy("first_visit_number").collect()
    assert [(r.followup_id, r.first_visit_number, r.last_visit_number) for r in numbered] == [
        (3, 1, 2), (2, 3, 4), (4, 5, 6), (1, 7, 8),
    ]


def test_unknown_visit_time_is_the_latest(spark):
    followups = [tb(1, jan(1), "Confirmed", date(2024, 1, 2)), tb(2, None, "On treatment")]
    run = run_of(
        spark,
        individual=[person(100)],
        tb_followup=followups,
        tuberculosis=[{"id": 1, "individual_id": 100}],
    )
    (row,) = report.claims(run, ["r28"]).collect()
    assert (row.work_completion_date, row.date_of_registration) == (None, "2024-01-02")


def test_latest_visit_of_another_type_is_not_shown(spark):
    followups = [
        tb(1, jan(1), "Confirmed", date(2024, 1, 2)),
        tb(2, jan(9), "On treatment", kind="Drug sensitive"),
    ]
    run = run_of(
        spark,
        individual=[person(100)],
        tb_followup=followups,
        tuberculosis=[{"id": 1, "individual_id": 100}],
    )
    (row,) = report.claims(run, ["r28"]).collect()
    assert (row.beneficiary_count, row.work_completion_date) == (1, None)


def test_completed_treatment_counts_under_each_type_seen(spark):
    followups = [
        tb(1, jan(1), "Confirmed", date(2023, 7, 1)),
        tb(2, jan(9), "Treatment completed", done=date(2024, 1, 9), kind="Drug sensitive"),
        tb(3, jan(9), "Treatment completed", done=date(2024, 2, 9)),
        tb(4, jan(1), "Confirmed", date(2023, 7, 1), individual=101),
        tb(5, jan(9), "Treatment completed", done=date(2024, 1, 9), individual=101),
    ]
    run = run_of(
        spark,
        individual=[person(100), person(101)],
        tb_followup=followups,
        tuberculosis=[{"id": 1, "individual_id": 100, "program_exit_date_time": jan(2)}],
    )
    assert lines(run, "r29") == [(1, "2024-01-09", "2023-07-01")]
    assert lines(run, "r30") == [(1, "2024-01-09", "2023-07-01")]


def test_spacing_needs_36_months_in_digits(spark):
    texts = {100: "36 months", 101: "3 yr 2", 102: "none", 103: None, 104: "3 years 6"}
    plans = [
        {"id": n, "individual_id": n, "enrolment_date_time": jan(9), "gap_text": text,
         "child1_dob": date(2018, 1, 1), "child2_dob": date(2021, 2, 1)}
        for n, text in texts.items()
    ]
    run = run_of(spark, individual=[person(n) for n in texts], family_planning=plans)
    assert lines(run, "r13") == [(2, "2021-02-01", "2018-01-01")]


def test_unscoped_rules_see_everyone(spark):
    people = [
        person(100, worker=2, date_of_death=date(2024, 1, 31), date_of_sterilization=date(2024, 1, 2)),
        person(101, worker=9, date_of_death=date(2024, 1, 31), is_voided=True),
        person(102, worker=2, gender="Male", date_of_sterilization=date(2024, 1, 2)),
    ]
    anc = [visit(1, 100, jan(2), worker=9, pmsma="Yes", is_voided=True), visit(2, 101, jan(2), pmsma="Yes")]
    run = run_of(spark, individual=people, anc=anc)
    assert lines(run, "r05") == [(2, "2024-01-31", "2024-01-31")]
    assert lines(run, "r07") == [(1, "2024-01-02", "2024-01-02")]
    assert lines(run, "r08") == [(1, "2024-01-02", "2024-01-02")]
    assert lines(run, "r09") == [(1, "2024-01-02", "2024-01-02")]


def test_total_and_form_of_an_unknown_worker_hold_the_unscoped_lines(spark):
    params = ReportParams("2024-01-01", "2024-01-31", username="nobody", as_of="2024-02-01")
    run = run_of(spark, params, individual=[person(100, date_of_death=date(2024, 1, 31))])
    (row,) = report.claim_form(run).collect()
    assert (row.s_no, row.code, row.total_claim_amount, row.section) == ("1", "C1.8", "200", "")
