"""One worker against all workers, and the rewrites against their plain forms."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from claimwright.plans import report, visits
from claimwright.plans.catalog import DATASETS
from claimwright.plans.rules import LINE_COLUMNS, RULES
from claimwright.plans.run import Run
from claimwright.sources.star import star_tables

SF = "/root/testdata/sf0.001"
WORKERS = ["Supplier#000000003", "Supplier#000000007"]
WIDE = registry.WIDE


@pytest.fixture(scope="module")
def tables(spark):
    return star_tables(spark, SF)


@pytest.fixture(scope="module")
def all_lines(tables):
    return report.claims(Run(tables, WIDE)).collect()


@pytest.mark.parametrize("worker", WORKERS)
def test_one_worker_equals_the_batch_filtered(tables, all_lines, worker):
    one = report.claims(Run(tables, replace(WIDE, username=worker))).collect()
    batch = [row[1:] for row in all_lines if row.worker in (None, worker)]
    assert Counter(map(tuple, one)) == Counter(map(tuple, batch))


def test_batch_forms_continue_after_the_shared_lines(tables):
    batch = report.claim_form(Run(tables, WIDE)).collect()
    one = report.claim_form(Run(tables, replace(WIDE, username=WORKERS[0]))).collect()
    mine = [tuple(row)[1:] for row in batch if row.worker in (None, WORKERS[0])]
    assert sorted(map(tuple, one)) == sorted(mine)
    assert sorted(int(row.s_no) for row in one) == list(range(1, len(one) + 1))


def test_totals_agree_with_the_lines(tables, all_lines):
    totals = {r.worker: r.grand_total for r in report.claim_totals(Run(tables, WIDE)).collect()}
    one = report.claim_totals(Run(tables, replace(WIDE, username=WORKERS[1]))).collect()
    shared = sum(int(r.total_claim_amount) for r in all_lines if r.worker is None)
    own = sum(int(r.total_claim_amount) for r in all_lines if r.worker == WORKERS[1])
    assert totals[WORKERS[1]] == shared + own == one[0].grand_total


def test_nth_visits_by_pivot_equal_the_join_form(tables):
    run = Run(tables, replace(WIDE, username=None))
    numbered = visits.numbered_visits(run, "hbnc").withColumn("day", F.to_date("at"))
    inside = numbered.where(run.on_days("day"))

    def nth(n, name):
        return inside.where(F.col("visit_number") == n).select(
            "worker_id", "person_id", F.col("day").alias(name), "note", "mode"
        )

    joined = (
        nth(6, "done")
        .where("note is not null and mode <> 'C-section'")
        .join(nth(2, "registered").drop("note", "mode"), ["worker_id", "person_id"], "left")
        .groupBy("worker_id", "done", "registered")
        .agg(F.countDistinct("person_id").alias("n"))
        .select("n", F.col("done").cast("string"), F.col("registered").cast("string"))
    )
    lines = report.claims(run, ["r18"]).select(
        "beneficiary_count", "work_completion_date", "date_of_registration"
    )
    assert Counter(map(tuple, lines.collect())) == Counter(map(tuple, joined.collect()))


def test_rules_alone_equal_the_report(tables, all_lines):
    run = Run(tables, WIDE)
    for rule in ("r02", "r12", "r16", "r24", "r28"):
        alone = Counter(map(tuple, report.claims(run, [rule]).collect()))
        terms = RULES[rule]
        together = Counter(tuple(r) for r in all_lines if (r.code, r.rate) == (terms.code, terms.rate))
        assert alone == together, rule


def test_report_by_name(tables):
    params = replace(WIDE, username=WORKERS[0], user_name="सीता")
    assert report.run_report("claims", tables, params).columns == list(LINE_COLUMNS)
    (header,) = report.run_report("claim headers", tables, params).collect()
    assert header.worker_name == "सीता" and header.month_year == "अगस्त 2001"
    assert "सीता" in header.intro
    with pytest.raises(ValueError, match="no report named"):
        report.run_report("payments", tables, params)


@pytest.mark.parametrize("folders", [1, 64])
def test_a_form_out_of_a_batch_is_that_of_a_single_run(spark, tables, tmp_path, folders):
    folder = str(tmp_path / "forms")
    report.write_forms(report.claim_form(Run(tables, WIDE)), folder, folders)
    for worker in [*WORKERS, "nobody"]:
        found = report.claim_form_of(spark, folder, worker, folders).collect()
        single = report.claim_form(Run(tables, replace(WIDE, username=worker))).collect()
        assert sorted(found) == sorted(single)
        assert [int(row.s_no) for row in found] == list(range(1, len(found) + 1))


def test_writing_a_batch_evaluates_the_form_once(spark, tables, tmp_path):
    form = report.claim_form(Run(tables, WIDE))
    evaluated = spark.sparkContext.accumulator(0)

    def passed_on(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    report.write_forms(form.mapInArrow(passed_on, form.schema), str(tmp_path / "forms"))
    assert evaluated.value == form.count() > 0


def jobs_of(spark, name, build) -> int:
    spark.sparkContext.setJobGroup(name, name)
    build()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    spark.sparkContext.setJobGroup("", "")
    return found


@pytest.mark.parametrize("key", ["d04_hbnc_visits", "d06_anc_visits", "d29_tb_followups", "d32_tb_latest"])
def test_building_a_numbered_dataset_starts_no_job(spark, tables, key):
    run = Run(tables, replace(WIDE, username=WORKERS[0]))
    run.scope.workers, run.scope._aliases  # the worker lookup
    assert jobs_of(spark, key, lambda: DATASETS[key](run)) == 0


def test_building_the_form_of_all_workers_only_makes_lookups(spark, tables):
    run = Run(tables, WIDE)
    report.claims(run)  # the users' aliases and the vaccine details
    assert jobs_of(spark, "form", lambda: report.claim_form(run)) == 0


def test_latest_visits_are_found_by_hashing(tables):
    run = Run(tables, WIDE)
    for df in (report.claims(run, ["r28", "r29", "r30"]), DATASETS["d32_tb_latest"](run)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_every_rule_has_lines_in_the_wide_period(spark):
    lines = report.claims(Run(star_tables(spark, "/root/testdata/sf0.01"), WIDE))
    codes = {row.code for row in lines.select("code").distinct().collect()}
    assert codes == {terms.code for terms in RULES.values()}
