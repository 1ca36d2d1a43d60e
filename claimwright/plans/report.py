"""The claims report and the form made of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.functions.texts import cell, leading_integer, month_year_hi
from claimwright.operators.lookups import stored
from claimwright.operators.numbering import running_copies
from claimwright.params import ReportParams
from claimwright.plans.rules import LINE_COLUMNS, RULES, Scope, priced_lines
from claimwright.plans.run import Run
from claimwright.sources.tables import Tables

# Form columns in print order and their Hindi headings.
FORM_COLUMNS: dict[str, str] = {
    "s_no": "क्र. स.",
    "code": "सेवा/कार्य का कोड",
    "rate": "प्रोत्साहन राशि का सामान्य दर",
    "beneficiary_count": "लाभार्थियो की संख्या",
    "total_claim_amount": "दावा की गयी राशि",
    "work_completion_date": "कार्य पूर्ण की अंतिम तिथि",
    "location_of_health_centre": "प्रखंड का नाम / जिला अस्पताल",
    "registration_code": "पंजी का कोड",
    "section": "खंड",
    "date_of_registration": "पंजी में अंकित दिनांक",
    "asha_signature": "आशा फैसिलिटेटर का हस्ताक्षर",
}

# Monthly services and their rates.
MONTHLY_RATES: dict[str, int] = {
    "PC1.1": 300,
    "PC1.2": 300,
    "PC1.3": 300,
    "PC1.4": 300,
    "PC1.5": 300,
    "PI1.1": 150,
    "PC1.6": 200,
    "PC1.7": 150,
}

# The parts of the form's opening sentence.
INTRO_NAME = "आशा का नाम"
INTRO_CENTRE = "स्वास्थ केंद्र का नाम ___________"
INTRO_MONTH = "माह-वर्ष जिसके लिए प्रत्साहन राशि का दावा किया गया है --"

ALL_RULES = list(RULES)
UNSCOPED = [rule for rule, terms in RULES.items() if terms.scope is Scope.UNSCOPED]
NUMERIC = {"rate", "beneficiary_count", "s_no"}


def claims(run: Run, rules: list[str] = ALL_RULES) -> DataFrame:
    """Claim lines of one worker, or of all of them with a leading ``worker`` column.

    Over all workers, lines of unscoped rules belong to every worker's claim; they appear
    once, with a null worker, instead of once per worker.
    """
    lines = _claimed(run, rules)
    if run.params.username is not None:
        return lines.select(*LINE_COLUMNS)
    return lines.select("worker", *LINE_COLUMNS)


def _claimed(run: Run, rules: list[str]) -> DataFrame:
    """Priced lines with the username; lines of unknown users are dropped."""
    lines = priced_lines(run, rules)
    if run.for_one_worker:
        return lines.withColumn(
            "worker", F.when(F.col("worker_id").isNotNull(), F.lit(run.params.username))
        )
    named = lines.join(run.scope.workers, "worker_id", "left")
    return named.where(F.col("worker_id").isNull() | F.col("worker").isNotNull())


def form_lines(run: Run) -> DataFrame:
    """Claim lines with their serial number ``s_no`` on the worker's form.

    The unscoped lines come first, so they have the same numbers on every form and are
    numbered once; a worker's own lines follow, in rule and date order. Lines that print
    alike are counted before they are numbered: what a worker's window holds grows with the
    rules and days of the calendar, not with the people.
    """
    shared = F.col("rule").isin(UNSCOPED)
    order = [
        F.col("rule").asc(),
        F.col("work_completion_date").asc_nulls_last(),
        F.col("date_of_registration").asc_nulls_last(),
        F.col("beneficiary_count").asc(),
    ]
    alike = (
        _claimed(run, ALL_RULES)
        .groupBy("worker", "rule", *LINE_COLUMNS)
        .agg(F.count("*").alias("copies"))
        .withColumn("last", running_copies(["worker"], order, "copies"))
    )
    numbers = F.sequence(F.col("last") - F.col("copies") + 1, F.col("last"))
    before = _claimed(run, UNSCOPED).agg(F.count("*")).scalar()
    return alike.withColumn("own_no", F.explode(numbers)).select(
        "worker",
        "rule",
        *LINE_COLUMNS,
        F.when(shared, F.col("own_no")).otherwise(F.col("own_no") + before).alias("s_no"),
    )


def claim_form(run: Run) -> DataFrame:
    """The form's eleven columns as printed text, blank where nothing is known."""
    known = {*LINE_COLUMNS, "s_no"}

    def printed(name: str) -> Column:
        if name not in known:
            return F.lit("").alias(name)
        return cell(F.col(name), name in NUMERIC).alias(name)

    worker = [] if run.params.username is not None else ["worker"]
    return form_lines(run).select(*worker, *(printed(name) for name in FORM_COLUMNS))


def with_headings(form: DataFrame) -> DataFrame:
    """The form under its Hindi headings."""
    return form.withColumnsRenamed(FORM_COLUMNS)


def claim_totals(run: Run) -> DataFrame:
    """Grand total of each worker's claim lines; monthly services are not part of it.

    The unscoped lines count for every worker; their sum is computed once, as a scalar.
    """

    def amount(lines: DataFrame) -> DataFrame:
        return lines.select("worker_id", leading_integer(F.col("total_claim_amount")).alias("amount"))

    scoped = [rule for rule in ALL_RULES if RULES[rule].scope is not Scope.UNSCOPED]
    shared = (
        amount(priced_lines(run, UNSCOPED)).agg(F.coalesce(F.sum("amount"), F.lit(0))).scalar()
    )
    sums = amount(priced_lines(run, scoped)).groupBy("worker_id").agg(F.sum("amount").alias("own"))
    return (
        run.scope.workers.join(sums, "worker_id", "left")
        .select("worker", (F.coalesce(F.col("own"), F.lit(0)) + shared).alias("grand_total"))
    )


def monthly_rates(run: Run) -> DataFrame:
    """The monthly services with their rates, on every worker's form."""
    services = F.array(
        *(
            F.struct(
                F.lit(code).alias("code"),
                F.lit(rate).alias("rate"),
                F.lit(f"{rate}/-रूपये प्रतिमाह").alias("label"),
                F.lit("").alias("tick"),
            )
            for code, rate in MONTHLY_RATES.items()
        )
    )
    return run.scope.workers.select("worker", F.explode(services).alias("s")).select(
        "worker", "s.code", "s.rate", "s.label", "s.tick"
    )


def claim_headers(run: Run) -> DataFrame:
    """Per worker: the name shown, the run's month and the form's opening sentence."""
    name = F.lit(run.params.user_name) if run.params.user_name else F.col("worker")
    month = month_year_hi(run.params.today)
    return run.scope.workers.select(
        "worker",
        name.alias("worker_name"),
        month.alias("month_year"),
        F.concat_ws(" ", F.lit(INTRO_NAME), name, F.lit(INTRO_CENTRE), F.lit(INTRO_MONTH), month).alias(
            "intro"
        ),
    )


REPORTS: dict[str, Callable[[Run], DataFrame]] = {
    "claims": claims,
    "claim form": claim_form,
    "claim totals": claim_totals,
    "monthly rates": monthly_rates,
    "claim headers": claim_headers,
}


def run_report(name: str, tables: Tables, params: ReportParams) -> DataFrame:
    """Run a report by name; its columns and rows are the returned DataFrame."""
    try:
        report = REPORTS[name]
    except KeyError:
        raise ValueError(f"no report named {name!r}; there are: {', '.join(REPORTS)}") from None
    return report(Run(tables, params))


# Folders that the forms of a batch are dealt to.
FORM_FOLDERS = 64


def _folder_of(worker: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(worker), F.lit(folders)).cast("int")


def write_forms(form: DataFrame, directory: str, folders: int = FORM_FOLDERS) -> None:
    """Write the forms of all workers as Parquet, in two parts.

    ``shared`` has the unscoped lines, which open every form, once. ``own`` has each
    worker's lines, dealt to ``folders`` folders and sorted by worker and number within
    files, so that a reader opens one folder and skips to the worker. A worker with very
    many lines is spread over several files. Both parts are split off a stored copy of the
    lines, so that the rules are evaluated once.
    """
    form = stored(form.withColumn("s_no", F.col("s_no").cast("bigint")), "forms").frame
    form.where(F.col("worker").isNull()).drop("worker").write.parquet(f"{directory}/shared")
    (
        form.where(F.col("worker").isNotNull())
        .withColumn("folder", _folder_of(F.col("worker"), folders))
        .repartitionByRange("folder", "worker", "s_no")
        .sortWithinPartitions("folder", "worker", "s_no")
        .write.partitionBy("folder")
        .parquet(f"{directory}/own")
    )


def claim_form_of(
    spark: SparkSession, directory: str, worker: str, folders: int = FORM_FOLDERS
) -> DataFrame:
    """One worker's whole form out of a written batch, the shared block before the own one.

    The same rows as a run for that worker alone. ``folders`` is that of the writing.
    """
    own = spark.read.parquet(f"{directory}/own").where(
        (F.col("folder") == _folder_of(F.lit(worker), folders)) & (F.col("worker") == worker)
    )
    shared = spark.read.parquet(f"{directory}/shared")
    form = shared.select(*FORM_COLUMNS).union(own.select(*FORM_COLUMNS)).orderBy("s_no")
    return form.withColumn("s_no", F.col("s_no").cast("string"))
