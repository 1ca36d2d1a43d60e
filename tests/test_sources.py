"""The stored layout: fixed schemas, question names and what reaches the scans."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as registry
from claimwright.operators.key_filter import SIZE_SETTING
from claimwright.plans import report, visits
from claimwright.plans.rules import RULES
from claimwright.plans.run import Run
from claimwright.sources.star import star_tables
from claimwright.sources.tables import QUESTIONS, SCHEMAS, STORED_TABLES, read_tables, stored_schema, write_tables

SF = "/root/testdata/sf0.001"
WORKER = "Supplier#000000003"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The derived tables written as the stored ones, and read back."""
    folder = tmp_path_factory.mktemp("stored")
    star = star_tables(spark, SF)
    for table, ddl in SCHEMAS.items():
        questions = QUESTIONS.get(table, {})
        derived = star[table]
        columns = []
        for field in T.StructType.fromDDL(ddl):
            value = F.col(field.name) if field.name in derived.columns else F.lit(None)
            columns.append(value.cast(field.dataType).alias(questions.get(field.name, field.name)))
        derived.select(*columns).write.parquet(str(folder / STORED_TABLES.get(table, table)))
    return read_tables(spark, str(folder))


def test_there_are_22_tables_with_unique_stored_columns(spark):
    assert len(SCHEMAS) == 22
    for table in SCHEMAS:
        names = stored_schema(table).fieldNames()
        assert len(set(name.lower() for name in names)) == len(names)


def test_unknown_table(stored):
    with pytest.raises(KeyError, match="no base table"):
        stored["payments"]


def test_stored_tables_give_the_same_report(spark, stored):
    for params in (registry.WIDE, replace(registry.WIDE, username=WORKER)):
        got = report.claims(Run(stored, params)).collect()
        want = report.claims(Run(star_tables(spark, SF), params)).collect()
        assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def scans(df) -> list[str]:
    return re.findall(r"FileScan parquet .*", df._jdf.queryExecution().executedPlan().toString())


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_period_and_flags_reach_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    run = Run(stored, replace(registry.ONE, username=WORKER))
    (scan,) = [s for s in scans(report.claims(run, ["r07"])) if "pregnancy_anc" in s]
    pushed = scan[scan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(encounter_date_time" in pushed
    assert "LessThan(encounter_date_time" in pushed
    assert "EqualTo(`Whether ANC done under PMSMA`,Yes)" in pushed
    assert "ifa" not in scan.lower().replace("180 iron", "") and "TD 1 Dose" not in scan


def test_one_workers_ids_reach_the_visit_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    run = Run(stored, replace(registry.ONE, username=WORKER))
    hbnc = [s for s in scans(report.claims(run, ["r18", "r19", "r20"])) if "child_hbnc" in s]
    assert len(hbnc) == 1
    assert re.search(r"PushedFilters: .*EqualTo\(created_by_id,3\)|In\(created_by_id", hbnc[0])


@pytest.mark.parametrize("username", [None, WORKER])
def test_no_nested_loops_and_one_scan_per_visit_frame(spark, stored, username):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    run = Run(stored, replace(registry.WIDE, username=username))
    df = report.claims(run)
    plan = executed(df)
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    folders = Counter(re.search(r"Location: .*?/([\w-]+)\]", s).group(1) for s in scans(df) if "Location" in s)
    assert folders["individual_child_hbnc"] == 1
    assert folders["individual_child_hbyc"] == 1
    # Visits, first doses, doses of the period, and the unscoped scheme visits.
    assert folders["individual_pregnancy_anc"] == 4
    # The series, and the birth doses of the period.
    assert folders["checklist_item"] == 2


def test_without_broadcasts_only_checked_lookups_are_broadcast(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(report.claims(Run(stored, registry.WIDE)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Details of the wanted vaccines (twice) and the two relationship types.
    assert plan.count("BroadcastExchange") == 3
    assert "SortMergeJoin" in plan


def test_one_workers_checklist_items_are_not_shuffled_to_the_checklists(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = executed(report.claims(Run(stored, replace(registry.WIDE, username=WORKER)), ["r15"]))
        everyone = executed(report.claims(Run(stored, registry.WIDE), ["r15"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"BroadcastHashJoin \[checklist_id", one)
    assert re.search(r"SortMergeJoin \[checklist_id", everyone)


def test_every_rule_plans_without_python(stored):
    run = Run(stored, registry.WIDE)
    assert "Python" not in executed(report.claims(run, list(RULES)))


def test_stored_times_keep_their_instants(spark, tmp_path):
    """The last day of the period: out where the answer is compared as it is, in by its day."""
    at = F.to_timestamp(F.lit("2000-12-31 09:30:00"))
    star = star_tables(spark, SF)
    times = {
        "individual": {n: at for n in ("date_of_death", "date_of_sterilization", "date_of_antra_injection")},
        "fp_followup": {"date_of_sterilisation": at},
    }
    write_tables(star, str(tmp_path), times)
    tables = read_tables(spark, str(tmp_path))
    assert dict(tables["individual"].dtypes)["date_of_death"] == "timestamp"
    run = Run(tables, registry.EVERYONE)
    raw, by_day = ["r05", "r14", "r25"], ["r08", "r09"]
    assert all(report.claims(run, [rule]).count() == 0 for rule in raw)
    for rule in by_day:
        assert {r.work_completion_date for r in report.claims(run, [rule]).collect()} == {"2000-12-31 09:30:00"}
    later = Run(tables, replace(registry.EVERYONE, to_date="2001-01-01"))
    assert all(report.claims(later, [rule]).count() > 0 for rule in raw + by_day)


def test_visits_are_filtered_by_active_people_before_they_are_shuffled(spark, stored):
    params = replace(registry.EVERYONE, from_date="1999-05-01", to_date="1999-05-07")
    rules = ["r01", "r02", "r03", "r06", "r15", "r16", "r17", "r18", "r19", "r20", "r21"]
    plain = report.claims(Run(stored, params), rules)
    spark.conf.set(SIZE_SETTING, "0")
    try:
        filtered = report.claims(Run(stored, params), rules)
        plan = executed(filtered)
        kept = visits.worker_visits(Run(stored, params), ["anc"], visits._active_visitors(Run(stored, params), ["anc"]))
        rows, every = kept.count(), visits.worker_visits(Run(stored, params), ["anc"]).count()
    finally:
        spark.conf.unset(SIZE_SETTING)
    assert "Subquery" not in executed(plain) and plain.count() > 0
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, filtered.collect()))
    scans_below = [part.rsplit("Exchange", 1)[-1] for part in plan.split("FileScan parquet")[:-1]]
    tested = [part for part in scans_below if "shiftright(pmod(xxhash64(" in part and "Filter" in part]
    # Antenatal, newborn and young-child visits, first doses and checklist items.
    assert len(tested) >= 5
    assert 0 < rows < every / 3


def test_every_active_person_keeps_all_visits(spark, stored):
    params = replace(registry.EVERYONE, from_date="1999-05-01", to_date="1999-05-07")
    run = Run(stored, params)
    kept = visits.worker_visits(run, ["hbnc"], visits._active_visitors(run, ["hbnc"]))
    every = visits.worker_visits(run, ["hbnc"])
    active = every.where(run.on_days("at")).select("person_id").distinct()
    theirs = every.join(every.join(active, "person_id", "left_semi").select("visitor_id").distinct(), "visitor_id", "left_semi")
    theirs = theirs.select(*kept.columns)
    assert theirs.count() > 0 and theirs.exceptAll(kept).count() == 0
