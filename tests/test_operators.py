from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimwright.operators.key_filter import KeyFilter
from claimwright.operators.lookups import remove_stored, stored
from claimwright.operators.numbering import ByTime, first_k, number_rows
from claimwright.operators.scope import WorkerScope
from claimwright.operators.sizing import fits
from tests.tables import make_tables, person

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """One person with most of the rows, many of them at the same time, and many others."""
    rows = [(1, START, n) for n in range(3000)]
    rows += [(1, START + timedelta(hours=n % 7), 3000 + n) for n in range(1000)]
    rows += [(2 + n % 200, None if n % 5 == 0 else START + timedelta(days=n % 3), 5000 + n) for n in range(2000)]
    rows += [(None, START, 9000), (None, START, 9001)]
    return spark.createDataFrame(rows, "person bigint, at timestamp, id bigint").repartition(8, "id")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("id_bits", [20, 4])
def test_numbering_of_a_hot_group_equals_a_plain_window(spark, hot, descending, id_bits, monkeypatch):
    monkeypatch.setattr("claimwright.operators.numbering.RUN_ID_BITS", id_bits)
    by = ByTime("at", "id", descending)
    got = number_rows(hot, ["person"], by, "nth")
    window = Window.partitionBy("person").orderBy(*by.order())
    want = hot.withColumn("nth", F.row_number().over(window))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_numbering_with_copies_equals_numbering_the_copies(spark, hot):
    rows = hot.withColumn("copies", F.col("id") % 4 + 1)
    got = number_rows(rows, ["person"], ByTime("at", "id"), "last", "copies").select("id", "last")
    made = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    window = Window.partitionBy("person").orderBy(F.col("at").asc_nulls_last(), "id", "copy")
    want = made.withColumn("nth", F.row_number().over(window)).groupBy("id").agg(F.max("nth"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_numbering_sorts_no_more_than_a_run_together_and_starts_no_job(spark, hot, monkeypatch):
    monkeypatch.setattr("claimwright.operators.numbering.RUN_ID_BITS", 6)
    spark.sparkContext.setJobGroup("numbering", "building")
    numbered = number_rows(hot, ["person"], ByTime("at", "id"), "nth")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("numbering")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "its_run" in plan[plan.index("Exchange hashpartitioning") :]
    # The hot group's 3,000 rows of one instant fall into runs of 64 ids.
    runs = hot.where("person = 1").groupBy("at", F.shiftright("id", 6)).count()
    assert runs.agg(F.max("count")).first()[0] <= 64


def test_key_filter_passes_its_keys_and_few_others(spark):
    keys = spark.range(0, 3000, 3).withColumn("id", F.when(F.col("id") > 0, F.col("id")))
    rows = spark.range(3000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"))
    kept = {r.k for r in rows.where(KeyFilter(keys, "id").may_hold("k")).collect()}
    assert kept >= set(range(3, 3000, 3)) and None not in kept and len(kept) < 1100
    nobody = KeyFilter(keys.where("id < 0"), "id")
    assert rows.where(nobody.may_hold("k")).count() == 0


def test_lookups_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    kept = stored(spark.range(10).mapInPandas(count, "id long"), "test")
    assert kept.rows == 10 and kept.joinable(9) is kept.frame
    assert "broadcast" in kept.joinable(10)._jdf.queryExecution().toString().lower()
    assert kept.frame.count() == 10 and made.value == 10
    remove_stored(spark)


def test_first_k_limits_groups_before_the_shuffle(hot):
    df = first_k(hot, ["person"], [F.col("at").asc_nulls_last(), F.col("id").asc()], 3)
    counts = df.groupBy("person").count().agg(F.max("count")).first()[0]
    assert counts == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_fits_reads_a_bound(spark):
    assert fits(spark.range(10), 10)
    assert not fits(spark.range(11), 10)


USERS = [
    {"id": 1, "username": "anu"},
    {"id": 2, "username": "bina"},
    {"id": 3, "username": "anu"},
    {"id": 4, "username": None},
]

PAIRS = [(1, 1), (1, 3), (3, 1), (1, 2), (2, 2), (2, 4), (9, 1), (None, 1), (1, None), (None, None), (4, 4)]


def people(spark):
    return make_tables(
        spark,
        users=USERS,
        individual=[
            person(n, created_by_id=created, last_modified_by_id=modified)
            for n, (created, modified) in enumerate(PAIRS)
        ],
    )


def or_join(tables, on):
    users = tables["users"].where("username is not null").select(F.col("id").alias("uid"), "username")
    rows = tables["individual"].join(users, F.expr(on))
    return rows.groupBy("username", "id").count()


@pytest.mark.parametrize("username", [None, "anu", "bina", "nobody"])
def test_either_scope_equals_the_or_join_with_shared_usernames(spark, username):
    tables = people(spark)
    scope = WorkerScope(tables["users"], username)
    rows = scope.created_or_modified(tables["individual"]).select("id", F.explode("workers").alias("w"))
    got = scope.named(rows.select("id", "w.worker_id", "w.copies")).select("worker", "id", "copies")
    want = or_join(tables, "uid = created_by_id or uid = last_modified_by_id")
    if username is not None:
        want = want.where(F.col("username") == username)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("username", [None, "anu", "bina", "nobody"])
def test_both_scope_compares_usernames(spark, username):
    tables = people(spark)
    scope = WorkerScope(tables["users"], username)
    got = scope.named(scope.created_and_modified(tables["individual"])).select("worker", "id")
    users = tables["users"].where("username is not null")
    want = (
        tables["individual"]
        .join(users.select(F.col("id").alias("c"), F.col("username").alias("u")), F.expr("c = created_by_id"))
        .join(users.select(F.col("id").alias("m"), F.col("username").alias("v")), F.expr("m = last_modified_by_id"))
        .where("u = v")
        .select("u", "id")
    )
    if username is not None:
        want = want.where(F.col("u") == username)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
