"""SQL for the derived datasets and single operators."""

from __future__ import annotations

import re

from oracle.sql import Oracle

VISIT_NUMBERS = (
    "count(*) as copies, min(visit_number) as first_visit_number, max(visit_number) as last_visit_number"
)

PLANNED = [
    "date_of_delivery",
    "delivery_encounter",
    "date_of_sterilisation",
    "date_of_copper_t",
    "followup_encounter",
    "planning_enrolment",
]

NTH = {
    "d07_first_anc": ("anc", 1, False, ""),
    "d08_second_anc": ("anc", 2, False, ", ifa_180"),
    "d09_fourth_anc": ("anc", 4, True, ""),
    "d10_seventh_anc": ("anc", 7, True, ""),
    "d11_eighth_anc": ("anc", 8, True, ""),
    "d12_first_hbnc": ("hbnc", 1, True, ""),
    "d13_second_hbnc": ("hbnc", 2, True, ""),
    "d14_third_hbnc": ("hbnc", 3, True, ""),
    "d15_fourth_hbnc": ("hbnc", 4, True, ""),
    "d16_fifth_hbnc": ("hbnc", 5, True, ""),
    "d17_sixth_hbnc": ("hbnc", 6, True, ", place_of_delivery, delivery_type"),
    "d18_seventh_hbnc": ("hbnc", 7, True, ", place_of_delivery, delivery_type"),
    "d19_first_hbyc": ("hbyc", 1, True, ""),
    "d20_fifth_hbyc": ("hbyc", 5, True, ""),
}


# Datasets that belong to a worker: over all workers they say whose each row is.
OF_WORKERS = [
    "d02_activity",
    "d04_hbnc_visits",
    "d05_hbyc_visits",
    "d06_anc_visits",
    "d06_anc_abortions",
    *NTH,
    "d22_primary_series",
    "d23_booster_series",
    "d25_pmsma_visits",
    "d26_first_td",
    "d27_second_td",
    "d28_td_booster",
]


def dataset_sql(key: str, o: Oracle) -> str:
    if key in NTH:
        kind, n, in_period, columns = NTH[key]
        select = f"""select person_id, cast(day as varchar) as visit_date {columns}
            from {o.nth(kind, n, in_period, columns)}"""
    else:
        select = _selects(o)[key]
    if key in OF_WORKERS and not o.one_worker:
        select = re.sub(r"^\s*select (distinct )?", r"select \1worker, ", select)
    return o.statement(select)


def _selects(o: Oracle) -> dict[str, str]:
    period, today = o.period, o.today
    return {
        "d01_client_user": "select id, worker as username from me",
        "d02_activity": f"select activity from ({o.activity()})",
        "d03_activity_total": f"select count(*) as total from ({o.activity()}) where activity = 'Yes'",
        "d04_hbnc_visits": """select person_id, cast(day as varchar) as visit_date, place_of_delivery,
            delivery_type, visit_number from hbnc_visits""",
        "d05_hbyc_visits": """select person_id, cast(day as varchar) as visit_date, visit_number
            from hbyc_visits""",
        "d06_anc_visits": f"""select person_id, cast(any_value(day) as varchar) as visit_date,
            any_value(pmsma) as pmsma, any_value(ifa_180) as ifa_180,
            cast(any_value(td1) as varchar) as td1, cast(any_value(td2) as varchar) as td2,
            cast(any_value(td_booster) as varchar) as td_booster,
            cast(any_value(date_of_sterilization) as varchar) as date_of_sterilization,
            any_value(gender) as gender, {VISIT_NUMBERS}
            from anc_visits group by worker, person_id, visit_id""",
        "d06_anc_abortions": """select person_id, cast(any_value(date_of_abortion) as varchar) as date_of_abortion,
            cast(any_value(date_of_discharge) as varchar) as date_of_discharge, count(*) as copies
            from anc_visits where abortion_id is not null group by worker, person_id, abortion_id""",
        "d21_mother_child": "select mother_id, child_id from edges",
        **{
            key: f"""select person_id, cast(last_completion as varchar) as last_completion,
                cast(first_completion as varchar) as first_completion, vaccines_done, age_in_years
                from {name}"""
            for key, name in (
                ("d22_primary_series", "primary_series"),
                ("d23_booster_series", "booster_series"),
            )
        },
        "d24_fp_delivery": "\nunion all\n".join(
            f"""select person_id, any_value(created_by_id) as created_by_id,
                   any_value(last_modified_by_id) as last_modified_by_id, '{leg}' as leg,
                   {', '.join(f"cast({f'any_value({c})' if c in own else 'null'} as varchar) as {c}" for c in PLANNED)},
                   count(*) as copies
            from planned group by person_id, {leg}_id"""
            for leg, own in (
                ("delivery", PLANNED[:2]),
                ("followup", PLANNED[2:5]),
                ("planning", PLANNED[5:]),
            )
        ),
        "d25_pmsma_visits": f"""select distinct person_id, cast(day as varchar) as visit_date
            from anc_visits where pmsma = 'Yes' and day between {period}""",
        "d26_first_td": """select distinct person_id, cast(td1 as varchar) as dose_date
            from anc_visits where td1 is not null""",
        "d27_second_td": f"""select distinct person_id, cast(td2 as varchar) as dose_date
            from anc_visits where td2 is not null and td1 is not null and day between {period}""",
        "d28_td_booster": f"""select distinct person_id, cast(td_booster as varchar) as dose_date
            from anc_visits where td_booster is not null and day between {period}""",
        "d29_tb_followups": f"""select person_id, any_value(created_by_id) as created_by_id,
            any_value(last_modified_by_id) as last_modified_by_id,
            cast(any_value(tb_status_date) as varchar) as tb_status_date,
            any_value(tb_status) as tb_status, any_value(type_of_tb) as type_of_tb,
            cast(any_value(encounter_date_time) as varchar) as encounter_date_time,
            cast(any_value(treatment_completion_date) as varchar) as treatment_completion_date,
            {VISIT_NUMBERS} from tb group by person_id, followup_id""",
        "d30_tb_confirmed": """select person_id,
            cast(any_value(encounter_date_time) as varchar) as encounter_date_time,
            cast(any_value(tb_status_date) as varchar) as confirmed_date, count(*) as copies
            from tb where tb_status = 'Confirmed' group by person_id, followup_id""",
        "d31_tb_completed": f"""select person_id,
            cast(any_value(treatment_completion_date) as varchar) as completed_date, count(*) as copies
            from tb where tb_status = 'Treatment completed' and treatment_completion_date between {period}
            group by person_id, followup_id""",
        "d32_tb_latest": """select person_id, created_by_id, last_modified_by_id, type_of_tb,
            cast(encounter_date_time as varchar) as encounter_date_time,
            cast(max(encounter_date_time) filter (where visit_number = 1) as varchar) as latest_encounter
            from tb where encounter_date_time is not null
            group by person_id, created_by_id, last_modified_by_id, type_of_tb, tb.encounter_date_time""",
    }


def operator_sql(key: str, o: Oracle) -> str:
    period, today = o.period, o.today
    selects = {
        "scope_both": """select u.worker, v.id as visit_id from fx_anc v
            join me u on u.id = v.created_by_id
            join me w on w.id = v.last_modified_by_id and w.worker = u.worker""",
        "scope_either": "select worker, id as person_id, count(*) as matches from either group by worker, id",
        "scope_modified": """select me.worker, h.id as household_id
            from fx_household h join me on me.id = h.last_modified_by_id""",
        "edge_members": """select i.id as person_id, g.mother_id
            from fx_individual i join edges g on i.id = g.mother_id or i.id = g.child_id""",
        "window_days": f"""select id, individual_id, cast(encounter_date_time as varchar) as encounter_date_time
            from fx_cbac where cast(encounter_date_time as date) between {period}""",
        "window_instants": f"""select id, individual_id, cast(encounter_date_time as varchar) as encounter_date_time
            from fx_cbac where encounter_date_time between {period}""",
        "or_inequality": """select place_of_delivery, count(*) as visits from fx_hbnc
            where place_of_delivery <> 'Home' or place_of_delivery <> 'In-transit'
            group by place_of_delivery""",
        "between_not_null": f"""select id,
            (last_modified_date_time between {period}) is not null as known from fx_household""",
        "age_years": f"""select id, extract(year from age({today}, date_of_birth)) as age_in_years
            from fx_individual""",
        "age_interval": f"""select id, age({today}, tb_status_date) >= interval '1 month'
            and age({today}, tb_status_date) < interval '6 month' as in_treatment from fx_tb_followup""",
        "digits_numeric": """select id,
            try_cast(regexp_replace(gap_text, '\\D', '', 'g') as bigint) as months,
            try_cast(regexp_replace(gap_text, '\\D', '', 'g') as bigint) >= 36 as spaced
            from fx_family_planning""",
        "filtered_max": """select person_id,
            cast(max(encounter_date_time) filter (where visit_number = 1) as varchar) as latest_encounter
            from tb group by person_id""",
        "group_finer": """select checklist_item_detail_id,
            cast(cast(completion_date as date) as varchar) as completion_day, count(*) as items
            from fx_checklist_item where completion_date is not null
            group by checklist_item_detail_id, completion_date""",
        "null_order_asc": """select id, individual_id, row_number() over (partition by individual_id
            order by encounter_date_time nulls last, id) as nth from fx_hbnc""",
        "null_order_desc": """select id, individual_id, row_number() over (partition by individual_id
            order by encounter_date_time desc nulls first, id desc) as nth from fx_hbnc""",
    }
    return o.statement(selects[key])
