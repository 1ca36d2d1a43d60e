"""Independent SQL for every registered query, in the plain relational shape.

Each statement reads the driver's parquet tables through the same derived views and
then joins, numbers and groups without any of the package's rewrites: OR joins stay OR
joins, fan-outs are made, and every dataset is derived again wherever it is used.
"""

from __future__ import annotations

from dataclasses import dataclass

from claimwright.params import ReportParams
from claimwright.sources.star import VIEWS
from oracle.terms import (
    FORM,
    INTRO_CENTRE,
    INTRO_MONTH,
    INTRO_NAME,
    MONTH_NAMES,
    MONTHLY,
    TERMS,
    UNSCOPED,
)

# Rules that print an answer as the form holds it, whether a date or a time.
AS_HELD = ("r08", "r09", "r25")


@dataclass(frozen=True)
class Oracle:
    """SQL under one set of parameters; without a username it covers all workers.

    ``views`` are further views, after the derived ones, or in their place.
    """

    params: ReportParams
    views: tuple[tuple[str, str], ...] = ()

    @property
    def period(self) -> str:
        return f"date '{self.params.from_date}' and date '{self.params.to_date}'"

    @property
    def today(self) -> str:
        return f"date '{self.params.as_of}'"

    @property
    def one_worker(self) -> bool:
        return self.params.username is not None

    def statement(self, select: str) -> str:
        """A whole statement: the derived views, the datasets and ``select``."""
        ctes = {**VIEWS, **dict(self.views), **self.datasets()}
        body = ",\n".join(f"{name} as ({sql.strip()})" for name, sql in ctes.items())
        return f"with {body}\n{select.strip()}"

    def datasets(self) -> dict[str, str]:
        who = f"where username = '{self.params.username}'" if self.one_worker else ""
        sets = {
            "me": f"select id, username as worker from fx_users {who}",
            "either": """
                select i.*, me.worker from fx_individual i
                join me on me.id = i.created_by_id or me.id = i.last_modified_by_id""",
            "edges": """
                select r.individual_a_id as mother_id, r.individual_b_id as child_id
                from fx_relationship r
                join fx_relationship_type t on t.id = r.relationship_type_id
                join fx_individual a on a.id = r.individual_a_id and not a.is_voided
                join fx_individual b on b.id = r.individual_b_id and not b.is_voided
                where r.relationship_type_id in (664, 673)""",
            "fp": """
                select i.worker, i.id as person_id, d.id as delivery_id, f.id as followup_id,
                       d.date_of_delivery, d.encounter_date_time as delivery_encounter,
                       f.date_of_sterilisation, f.date_of_copper_t,
                       f.encounter_date_time as followup_encounter
                from either i
                join fx_family_planning e on e.individual_id = i.id
                join fx_pregnancy p on p.individual_id = i.id
                join fx_delivery d on d.individual_id = i.id
                join fx_fp_followup f on f.individual_id = i.id
                where not i.is_voided and e.program_exit_date_time is null
                  and p.program_exit_date_time is null and d.cancel_date_time is null""",
            "planned": """
                select i.id as person_id, i.created_by_id, i.last_modified_by_id,
                       d.id as delivery_id, f.id as followup_id, e.id as planning_id,
                       d.date_of_delivery, d.encounter_date_time as delivery_encounter,
                       f.date_of_sterilisation, f.date_of_copper_t,
                       f.encounter_date_time as followup_encounter,
                       e.enrolment_date_time as planning_enrolment
                from fx_individual i
                join fx_family_planning e on e.individual_id = i.id
                join fx_pregnancy p on p.individual_id = i.id
                join fx_delivery d on d.individual_id = i.id
                join fx_fp_followup f on f.individual_id = i.id
                where not i.is_voided and e.program_exit_date_time is null
                  and p.program_exit_date_time is null and d.cancel_date_time is null""",
            "tb": """
                select i.id as person_id, i.created_by_id, i.last_modified_by_id,
                       f.id as followup_id, f.tb_status, f.tb_status_date, f.type_of_tb,
                       f.encounter_date_time, f.treatment_completion_date,
                       row_number() over (partition by f.individual_id
                           order by f.encounter_date_time desc nulls first, f.id desc) as visit_number
                from fx_individual i
                join fx_tuberculosis e on e.individual_id = i.id
                join fx_tb_followup f on f.individual_id = i.id""",
            "done_items": """
                select e.individual_id as person_id, e.program_exit_date_time, c.name,
                       x.completion_date
                from fx_checklist_item x
                join fx_checklist_item_detail d on d.id = x.checklist_item_detail_id
                join fx_concept c on c.id = d.concept_id
                join fx_checklist l on l.id = x.checklist_id
                join fx_child e on e.id = l.program_enrolment_id
                where x.completion_date is not null""",
        }
        for name, program, columns, extra in (
            ("hbnc", "child", "v.place_of_delivery, v.delivery_type", ""),
            ("hbyc", "child", "v.id as hbyc_id", ""),
            (
                "anc",
                "pregnancy",
                "v.pmsma, v.ifa_180, v.td1, v.td2, v.td_booster, i.gender, i.date_of_sterilization, "
                "a.id as abortion_id, a.date_of_abortion, a.date_of_discharge",
                "and v.encounter_date_time is not null",
            ),
        ):
            more = "left join fx_abortion a on a.individual_id = i.id" if name == "anc" else ""
            sets[f"{name}_visits"] = f"""
                select u.worker, i.id as person_id, v.id as visit_id, v.encounter_date_time,
                       cast(v.encounter_date_time as date) as day, {columns},
                       row_number() over (partition by u.worker, v.individual_id
                           order by v.encounter_date_time nulls last, v.id) as visit_number
                from fx_individual i
                left join fx_{program} e on e.individual_id = i.id and not e.is_voided
                left join fx_{name} v on v.program_enrolment_id = e.id and not v.is_voided {extra}
                {more}
                join me u on u.id = v.created_by_id
                join me w on w.id = v.last_modified_by_id and w.worker = u.worker
                where not i.is_voided"""
        for name, use in (("primary_series", PRIMARY), ("booster_series", BOOSTER)):
            sets[name] = f"""
                select i.worker, i.id as person_id, max(x.completion_date) as last_completion,
                       min(x.completion_date) as first_completion, count(*) as vaccines_done,
                       extract(year from age({self.today}, i.date_of_birth)) as age_in_years
                from done_items x join either i on i.id = x.person_id
                where x.name in ({use}) and not i.is_voided and x.program_exit_date_time is null
                group by i.worker, i.id, i.date_of_birth"""
        return sets

    def nth(self, kind: str, n: int, in_period: bool = True, columns: str = "") -> str:
        test = f"and day between {self.period}" if in_period else ""
        return f"""(select distinct worker, person_id, day {columns} from {kind}_visits
                    where visit_number = {n} {test})"""

    # Tuples of each rule: worker, person_id, c (completion key), r (registration key).

    def tuples(self, rule: str) -> str:
        period = self.period
        pair = "l.worker, l.person_id, l.day as c, f.day as r"
        on = "on f.worker = l.worker and f.person_id = l.person_id"
        place = ", place_of_delivery, delivery_type"

        def pair_of(last: str, first: str, test: str = "true") -> str:
            return f"select {pair} from {last} l left join {first} f {on} where {test}"

        not_home = "(l.place_of_delivery <> 'Home' or l.place_of_delivery <> 'In-transit')"
        tb_pairs = f"""
            select m.worker, t.person_id, cast(z.treatment_completion_date as date) as c,
                   cast(y.tb_status_date as date) as r
            from tb t
            join tb y on y.person_id = t.person_id and y.tb_status = 'Confirmed'
            join tb z on z.person_id = t.person_id and z.tb_status = 'Treatment completed'
            join me m on m.id = t.created_by_id or m.id = t.last_modified_by_id
            where cast(z.treatment_completion_date as date) between {period} and t.type_of_tb = """
        bcg = f"""
            select i.worker, i.id as person_id, x.completion_date as c, d.date_of_admission as r
            from done_items x join either i on i.id = x.person_id
            join edges g on i.id = g.mother_id or i.id = g.child_id
            left join fx_delivery d on d.individual_id = g.mother_id
            where x.name = 'BCG' and not i.is_voided
              and cast(x.completion_date as date) between {period}
              and (d.place_of_delivery <> 'Home' or d.place_of_delivery <> 'In-transit')"""
        return {
            "r01": pair_of(self.nth("anc", 4), self.nth("anc", 1, False)),
            "r02": pair_of(
                self.nth("anc", 4), self.nth("anc", 2, False, ", ifa_180"), "f.ifa_180 = 'Yes'"
            ),
            "r03": f"""
                select l.worker, l.person_id, l.td2 as c, f.td1 as r
                from (select distinct worker, person_id, td2 from anc_visits
                      where td2 is not null and td1 is not null and day between {period}) l
                left join (select distinct worker, person_id, td1 from anc_visits
                           where td1 is not null) f {on}""",
            "r04": f"""
                select worker, person_id, td_booster as c, td_booster as r from anc_visits
                where td_booster is not null and day between {period}""",
            "r05": f"""
                select null as worker, id as person_id, cast(date_of_death as date) as c,
                       cast(date_of_death as date) as r
                from fx_individual where date_of_death between {period}""",
            "r06": pair_of(self.nth("anc", 8), self.nth("anc", 1, False)),
            "r07": f"""
                select null as worker, i.id as person_id, cast(v.encounter_date_time as date) as c,
                       cast(v.encounter_date_time as date) as r
                from fx_individual i join fx_anc v on v.individual_id = i.id
                where v.pmsma = 'Yes' and not i.is_voided
                  and cast(v.encounter_date_time as date) between {period}""",
            **{
                rule: f"""
                select null as worker, id as person_id, date_of_sterilization as c,
                       date_of_sterilization as r
                from fx_individual where gender = '{gender}'
                  and cast(date_of_sterilization as date) between {period}"""
                for rule, gender in (("r08", "Female"), ("r09", "Male"))
            },
            "r10": f"""
                select worker, person_id, date_of_sterilisation as c, date_of_delivery as r from fp
                where date_of_sterilisation between {period} and date_of_delivery is not null
                  and delivery_encounter between {period}""",
            "r11": f"""
                select i.worker, i.id as person_id, cast(e.enrolment_date_time as date) as c,
                       a.date_of_abortion as r
                from either i join fx_family_planning e on e.individual_id = i.id
                join fx_abortion a on a.individual_id = i.id
                where e.program_exit_date_time is null and not i.is_voided
                  and cast(e.enrolment_date_time as date) between {period}
                  and a.date_of_abortion is not null""",
            "r12": f"""
                select worker, person_id, date_of_copper_t as c, date_of_delivery as r from fp
                where date_of_copper_t between {period} and date_of_delivery is not null""",
            "r13": f"""
                select i.worker, i.id as person_id, e.child2_dob as c, e.child1_dob as r
                from either i join fx_family_planning e on e.individual_id = i.id
                where try_cast(regexp_replace(e.gap_text, '\\D', '', 'g') as decimal(38, 0)) >= 36
                  and cast(e.enrolment_date_time as date) between {period}""",
            "r14": f"""
                select i.worker, i.id as person_id, e.child2_dob as c, e.child1_dob as r
                from either i join fx_family_planning e on e.individual_id = i.id
                join fx_fp_followup f on f.individual_id = i.id
                where e.program_exit_date_time is null and e.enrolment_date_time is not null
                  and e.total_children = 2 and f.date_of_sterilisation between {period}""",
            "r15": f"""
                select worker, person_id, last_completion as c, first_completion as r
                from primary_series where vaccines_done = 5 and age_in_years <= 1
                  and cast(last_completion as date) between {period}""",
            "r16": f"""
                select worker, person_id, last_completion as c, first_completion as r
                from booster_series where vaccines_done >= 4 and age_in_years <= 2
                  and cast(last_completion as date) between {period}""",
            "r17": """
                select i.worker, i.id as person_id, cast(x.completion_date as date) as c,
                       cast(x.completion_date as date) as r
                from done_items x join either i on i.id = x.person_id
                where x.name = 'DPT Booster 2' and not i.is_voided
                  and x.program_exit_date_time is null""",
            "r18": pair_of(
                self.nth("hbnc", 6, True, place),
                self.nth("hbnc", 2),
                f"{not_home} and l.delivery_type <> 'C-section'",
            ),
            "r19": pair_of(
                self.nth("hbnc", 6, True, place),
                self.nth("hbnc", 3),
                f"{not_home} and l.delivery_type = 'C-section'",
            ),
            "r20": pair_of(
                self.nth("hbnc", 7, True, place),
                self.nth("hbnc", 1),
                "(l.place_of_delivery = 'Home' or l.place_of_delivery = 'In-transit')",
            ),
            "r21": pair_of(self.nth("hbyc", 5), self.nth("hbnc", 1)),
            "r22": f"""
                select i.worker, i.id as person_id, cast(v.encounter_date_time as date) as c,
                       cast(v.encounter_date_time as date) as r
                from either i join fx_cbac v on v.individual_id = i.id
                where not i.is_voided and v.encounter_date_time between {period}""",
            "r23": bcg,
            "r24": bcg,
            "r25": f"""
                select worker, id as person_id, date_of_antra_injection as c,
                       date_of_antra_injection as r
                from either where not is_voided and date_of_antra_injection between {period}""",
            "r26": f"""
                select i.worker, i.id as person_id, f.tb_status_date as c, f.tb_status_date as r
                from either i join fx_tuberculosis e on e.individual_id = i.id
                join fx_tb_followup f on f.individual_id = i.id
                where e.program_exit_date_time is null and f.tb_status = 'Confirmed'
                  and f.tb_status_date between {period} and not i.is_voided""",
            "r27": f"""
                select i.worker, i.id as person_id, cast(e.enrolment_date_time as date) as c,
                       cast(e.enrolment_date_time as date) as r
                from either i join fx_acute_encephalitis e on e.individual_id = i.id
                where e.referred_to <> 'Other private hospital'
                  and cast(e.enrolment_date_time as date) between {period}""",
            "r28": f"""
                select m.worker, t.person_id, y.tb_status_date as r,
                       case when t.visit_number = 1 then cast(t.encounter_date_time as date) end as latest
                from tb t join tb y on y.person_id = t.person_id and y.tb_status = 'Confirmed'
                join me m on m.id = t.created_by_id or m.id = t.last_modified_by_id
                where t.type_of_tb = 'Drug resistant'
                  and age({self.today}, y.tb_status_date) >= interval '1 month'
                  and age({self.today}, y.tb_status_date) < interval '6 month'""",
            "r29": tb_pairs + "'Drug resistant'",
            "r30": tb_pairs + "'Drug sensitive'",
        }[rule]

    def rule_lines(self, rule: str) -> str:
        """Claim lines of a rule with the worker and the rule's name."""
        code, rate = TERMS[rule]
        day = "cast({0} as varchar)" if rule in AS_HELD else "cast(cast({0} as date) as varchar)"
        if rule == "r28":
            done, keys = day.format("max(latest)"), "worker, r"
        else:
            done, keys = day.format("c"), "worker, c, r"
        return f"""
            select worker, '{rule}' as rule, '{code}' as code, {rate} as rate,
                   count(distinct person_id) as beneficiary_count,
                   cast(count(distinct person_id) * {rate} as varchar) as total_claim_amount,
                   {done} as work_completion_date, {day.format("r")} as date_of_registration
            from ({self.tuples(rule)}) group by {keys}"""

    def all_lines(self) -> str:
        return "\nunion all\n".join(self.rule_lines(rule) for rule in TERMS)

    def claims(self, rules: list[str]) -> str:
        lines = "\nunion all\n".join(self.rule_lines(rule) for rule in rules)
        drop = "worker, rule" if self.one_worker else "rule"
        return self.statement(f"select * exclude ({drop}) from ({lines})")

    def form(self, headings: bool = False) -> str:
        unscoped = ", ".join(f"'{rule}'" for rule in UNSCOPED)
        numbered = f"""
            select *, row_number() over (partition by forms.worker
                order by rule not in ({unscoped}), rule, work_completion_date nulls last,
                         date_of_registration nulls last, beneficiary_count) as s_no
            from (select lines.* exclude (worker), me.worker from ({self.all_lines()}) lines
                  join me on lines.worker is null or lines.worker = me.worker) forms"""
        if not self.one_worker:
            # A line that is on every form is listed once, without a worker.
            numbered = f"""
                select distinct * replace (
                    case when rule in ({unscoped}) then null else worker end as worker)
                from ({numbered})"""
        known = "s_no code rate beneficiary_count total_claim_amount work_completion_date date_of_registration".split()
        cells = ", ".join(
            f"coalesce(cast({name} as varchar), '') as \"{FORM[name] if headings else name}\""
            if name in known
            else f"'' as \"{FORM[name] if headings else name}\""
            for name in FORM
        )
        worker = "" if self.one_worker else "worker, "
        return self.statement(f"select {worker}{cells} from ({numbered})")

    def totals(self) -> str:
        return self.statement(
            f"""select me.worker,
                       cast(coalesce(sum(cast(l.total_claim_amount as bigint)), 0) as bigint) as grand_total
                from me left join ({self.all_lines()}) l on l.worker is null or l.worker = me.worker
                group by me.worker"""
        )

    def monthly_rates(self) -> str:
        rows = ", ".join(f"('{code}', {rate})" for code, rate in MONTHLY.items())
        return self.statement(
            f"""select me.worker, s.code, s.rate, s.rate || '/-रूपये प्रतिमाह' as label, '' as tick
                from me, (values {rows}) s(code, rate)"""
        )

    def headers(self) -> str:
        months = ", ".join(f"'{name}'" for name in MONTH_NAMES)
        month = f"list_value({months})[month({self.today})] || ' ' || year({self.today})"
        return self.statement(
            f"""select worker, worker as worker_name, {month} as month_year,
                       '{INTRO_NAME} ' || worker || ' {INTRO_CENTRE} {INTRO_MONTH} ' || {month} as intro
                from me"""
        )

    def activity(self) -> str:
        return " union all ".join(
            f"""select me.worker, case
                       when x.created_date_time between {self.period} then 'Yes'
                       when (x.last_modified_date_time between {self.period}) is not null then 'Yes'
                       else 'No' end as activity
                from fx_{name} x join me on me.id = x.last_modified_by_id"""
            for name in ("individual", "household", "pregnancy", "child")
        )


PRIMARY = "'BCG', 'Pentavalent 3', 'OPV 3', 'Measles 1', 'JE 1'"
BOOSTER = "'DPT Booster 1', 'DPT Booster 2', 'OPV Booster', 'Measles 2', 'JE 2'"
