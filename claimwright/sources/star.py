"""The claim tables as views over star-schema parquet.

Each view stands in for one registration, enrolment or encounter table and is
derived from the whole of its driver table. The SQL is plain enough for Spark
and any ANSI engine to read unchanged, so a check can run on the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from claimwright.sources.tables import Tables

# View name -> SQL, each view after the ones it reads.
VIEWS: dict[str, str] = {
    "fx_users": """
select s_suppkey as id,
       s_name as username
from supplier
""",
    "fx_individual": """
select c_custkey as id,
       c_custkey % 10 as created_by_id,
       case when c_custkey % 4 = 0 then (c_custkey + 1) % 10 else c_custkey % 10 end as last_modified_by_id,
       c_custkey % 23 = 0 as is_voided,
       case when c_custkey % 3 = 0 then 'Male' else 'Female' end as gender,
       date '1995-01-01' + cast(c_custkey * 7 % 2400 as int) as date_of_birth,
       case when c_custkey % 11 = 0 then date '1996-01-01' + cast(c_custkey * 13 % 2000 as int) end as date_of_death,
       case when c_custkey % 5 = 0 then date '1996-01-01' + cast(c_custkey * 17 % 2000 as int) end as date_of_sterilization,
       case when c_custkey % 7 = 0 then date '1996-01-01' + cast(c_custkey * 19 % 2000 as int) end as date_of_antra_injection,
       timestamp '1996-01-01 06:30:00' + interval '1' day * cast(c_custkey % 900 as int) as created_date_time,
       case when c_custkey % 6 <> 0 then timestamp '1997-01-01 18:00:00' + interval '1' day * cast(c_custkey % 1500 as int) end as last_modified_date_time
from customer
""",
    "fx_pregnancy": """
select 1000000 + c_custkey as id,
       c_custkey as individual_id,
       c_custkey % 29 = 0 as is_voided,
       case when c_custkey % 10 = 9 then timestamp '2001-01-01 00:00:00' end as program_exit_date_time,
       timestamp '1997-03-01 08:00:00' + interval '1' day * cast(c_custkey % 800 as int) as created_date_time,
       case when c_custkey % 8 <> 0 then timestamp '1998-03-01 08:00:00' + interval '1' day * cast(c_custkey % 1200 as int) end as last_modified_date_time,
       c_custkey % 10 as last_modified_by_id
from customer where c_custkey % 3 <> 0
""",
    "fx_child": """
select 2000000 + c_custkey as id,
       c_custkey as individual_id,
       c_custkey % 31 = 0 as is_voided,
       case when c_custkey % 13 = 0 then timestamp '2001-01-01 00:00:00' end as program_exit_date_time,
       timestamp '1997-03-01 08:00:00' + interval '1' day * cast(c_custkey % 800 as int) as created_date_time,
       case when c_custkey % 8 <> 0 then timestamp '1998-03-01 08:00:00' + interval '1' day * cast(c_custkey % 1200 as int) end as last_modified_date_time,
       c_custkey % 10 as last_modified_by_id
from customer
""",
    "fx_encounter": """
select o_orderkey as id,
       o_custkey as individual_id,
       case when o_orderkey % 37 <> 0 then o_orderdate + interval '1' second * cast(o_orderkey * 61 % 86400 as int) end as encounter_date_time,
       o_custkey % 10 as created_by_id,
       case when o_orderkey % 13 = 0 then (o_custkey + 1) % 10 else o_custkey % 10 end as last_modified_by_id,
       o_orderkey % 41 = 0 as is_voided,
       o_orderstatus,
       o_orderpriority,
       o_orderdate
from orders
""",
    "fx_anc": """
select id,
       individual_id,
       1000000 + individual_id - case when id % 4 = 1 then 10 else 0 end as program_enrolment_id,
       encounter_date_time,
       created_by_id,
       last_modified_by_id,
       is_voided,
       case when o_orderpriority = '1-URGENT' then 'Yes' else 'No' end as pmsma,
       case when o_orderstatus = 'F' then 'Yes' else 'No' end as ifa_180,
       case when id % 4 = 0 then cast(o_orderdate as date) end as td1,
       case when id % 8 = 0 then cast(o_orderdate as date) + 28 end as td2,
       case when id % 9 = 0 then cast(o_orderdate as date) end as td_booster
from fx_encounter
""",
    "fx_hbnc": """
select id,
       individual_id,
       2000000 + individual_id - case when id % 4 = 1 then 10 else 0 end as program_enrolment_id,
       encounter_date_time,
       created_by_id,
       last_modified_by_id,
       is_voided,
       case o_orderpriority when '1-URGENT' then 'Home' when '2-HIGH' then 'In-transit' when '5-LOW' then null else 'Hospital' end as place_of_delivery,
       case when o_orderstatus = 'P' then 'C-section' else 'Normal' end as delivery_type
from fx_encounter
""",
    "fx_hbyc": """
select id,
       individual_id,
       2000000 + individual_id - case when id % 4 = 1 then 10 else 0 end as program_enrolment_id,
       encounter_date_time,
       created_by_id,
       last_modified_by_id,
       is_voided
from fx_encounter where id % 3 <> 0
""",
    "fx_abortion": """
select id,
       individual_id,
       cast(o_orderdate as date) as date_of_abortion,
       cast(o_orderdate as date) + 3 as date_of_discharge
from fx_encounter where id % 19 = 0
""",
    "fx_delivery": """
select id,
       individual_id,
       encounter_date_time,
       cast(o_orderdate as date) as date_of_delivery,
       cast(o_orderdate as date) - 1 as date_of_admission,
       case when id % 14 = 0 then encounter_date_time end as cancel_date_time,
       case o_orderpriority when '1-URGENT' then 'Home' when '2-HIGH' then 'In-transit' when '5-LOW' then null else 'Hospital' end as place_of_delivery
from fx_encounter where id % 7 = 0
""",
    "fx_family_planning": """
select 3000000 + c_custkey as id,
       c_custkey as individual_id,
       timestamp '1996-06-01 10:00:00' + interval '1' day * cast(c_custkey * 11 % 1800 as int) as enrolment_date_time,
       case when c_custkey % 17 = 0 then timestamp '2001-01-01 00:00:00' end as program_exit_date_time,
       case c_custkey % 7 when 0 then '36 months' when 1 then '24 months' when 2 then '48' when 3 then null when 4 then 'about 3 yr 6' when 5 then 'unknown' else '35 months' end as gap_text,
       c_custkey % 3 + 1 as total_children,
       date '1992-01-01' + cast(c_custkey % 700 as int) as child1_dob,
       date '1995-06-01' + cast(c_custkey % 700 as int) as child2_dob
from customer where c_custkey % 2 = 0
""",
    "fx_fp_followup": """
select id,
       individual_id,
       encounter_date_time,
       case when id % 2 = 0 then cast(o_orderdate as date) end as date_of_sterilisation,
       case when id % 3 = 0 then cast(o_orderdate as date) end as date_of_copper_t
from fx_encounter where id % 5 = 0
""",
    "fx_tuberculosis": """
select 4000000 + c_custkey as id,
       c_custkey as individual_id,
       case when c_custkey % 19 = 0 then timestamp '2001-01-01 00:00:00' end as program_exit_date_time
from customer where c_custkey % 3 = 0
""",
    "fx_tb_followup": """
select id,
       individual_id,
       encounter_date_time,
       case when o_orderstatus = 'O' then 'Confirmed' when o_orderstatus = 'F' then 'Treatment completed' else 'On treatment' end as tb_status,
       cast(o_orderdate as date) as tb_status_date,
       case when individual_id % 2 = 0 then 'Drug resistant' else 'Drug sensitive' end as type_of_tb,
       case when o_orderstatus = 'F' then cast(o_orderdate as date) + 10 end as treatment_completion_date
from fx_encounter where individual_id % 3 = 0
""",
    "fx_cbac": """
select event_id as id,
       user_id as individual_id,
       ts as encounter_date_time
from events where event_type = 'view'
""",
    "fx_household": """
select event_id as id,
       user_id % 10 as last_modified_by_id,
       ts as created_date_time,
       case when event_id % 3 <> 0 then ts + interval '1' day * 2 end as last_modified_date_time
from events where event_type = 'signup'
""",
    "fx_acute_encephalitis": """
select 5000000 + c_custkey as id,
       c_custkey as individual_id,
       timestamp '1996-03-01 09:00:00' + interval '1' day * cast(c_custkey * 23 % 1900 as int) as enrolment_date_time,
       case c_mktsegment when 'MACHINERY' then 'Other private hospital' when 'BUILDING' then null else 'District hospital' end as referred_to
from customer where c_custkey % 2 = 1
""",
    "fx_checklist": """
select o_orderkey as id,
       2000000 + o_custkey as program_enrolment_id
from orders
""",
    "fx_checklist_item": """
select l_orderkey * 10 + l_linenumber as id,
       l_orderkey as checklist_id,
       l_partkey as checklist_item_detail_id,
       case when l_returnflag <> 'R' then l_shipdate + interval '1' second * cast(l_partkey * 7 % 86400 as int) end as completion_date
from lineitem
""",
    "fx_checklist_item_detail": """
select p_partkey as id,
       p_partkey as concept_id
from part
""",
    "fx_concept": """
select p_partkey as id,
       case p_partkey % 40 when 0 then 'BCG' when 1 then 'Pentavalent 3' when 2 then 'OPV 3' when 3 then 'Measles 1' when 4 then 'JE 1' when 5 then 'DPT Booster 1' when 6 then 'DPT Booster 2' when 7 then 'OPV Booster' when 8 then 'Measles 2' when 9 then 'JE 2' else p_name end as name
from part
""",
    "fx_relationship": """
select c_custkey as id,
       c_custkey as individual_a_id,
       c_custkey + 1 as individual_b_id,
       case c_custkey % 4 when 0 then 664 when 1 then 673 else 700 end as relationship_type_id
from customer
""",
    "fx_relationship_type": """
select distinct cast(case p_partkey % 3 when 0 then 664 when 1 then 673 else 700 end as int) as id
from part
""",
}

STAR_TABLES = ("customer", "events", "lineitem", "orders", "part", "supplier")


def star_tables(spark: SparkSession, directory: str) -> Tables:
    """The 22 claim tables derived from the star-schema parquet in ``directory``."""
    frames: dict[str, DataFrame] = {}

    def frame(name: str) -> DataFrame:
        if name not in frames:
            if name in STAR_TABLES:
                frames[name] = spark.read.parquet(f"{directory}/{name}.parquet")
            else:
                query = re.sub(r"\bfrom (\w+)", r"from {\1}", VIEWS[name])
                sources = set(re.findall(r"\bfrom \{(\w+)\}", query))
                frames[name] = spark.sql(query, **{source: frame(source) for source in sources})
        return frames[name]

    return Tables(lambda table: frame(f"fx_{table}"))
