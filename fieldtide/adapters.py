"""The shapes the operators expect, as views over the test tables.

The texts below run on Spark and, for the checks, on DuckDB; {name} stands for a table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fieldtide.session import bucketed

AS_OF_ORDERS = "1998-03-10"
AS_OF_EVENTS = "2024-02-05"

VIEWS: dict[str, str] = {
    "fx_bow": "select o_orderkey ldlead, cast(o_orderdate as date) ldjobenddate from {orders}",
    "fx_leads": """
select o_orderkey ldlead, o_custkey % 1000 ldlocation2, o_totalprice ldsalesamt,
 cast(o_orderdate as date) - cast(o_orderkey % 45 as int) ldadate,
 case when o_orderkey % 10 = 0 then cast(o_orderdate as date) + 2 end ldcandate,
 case when o_orderkey % 10 in (1, 2) then null when o_orderkey % 10 in (3, 4)
      then cast(o_orderdate as date) + 7 else cast(o_orderdate as date) end ldjobenddate,
 case when o_orderstatus = 'F' and o_orderkey % 10 <> 1 then cast(o_orderdate as date) end ldfupdate,
 o_custkey % 10 ldsales1 from {orders}""",
    "fx_loc": """
select lpad(cast(c_custkey % 1000 as string), 4, '0') loc_nbr, r_name division, n_name region,
 n_name || '-' || c_mktsegment branch, case when c_mktsegment = 'HOUSEHOLD' then 'Y' else 'N' end scn_flg
 from (select min(c_custkey) first_key from {customer} group by c_custkey % 1000) firsts
 join {customer} on c_custkey = first_key
 join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "fx_scorecard": """
select lpad(cast(o_custkey % 1000 as string), 4, '0') str_nbr, cast(o_orderdate as date) cal_dt,
 1 ty_job_count, cast(o_totalprice as decimal(18, 2)) ty_revenue,
 case when o_orderpriority = '5-LOW' then 'OTH' else 'MAIN' end program_group,
 case when o_orderstatus = 'P' then 'Y' else '' end sfi_flg from {orders}""",
    "fx_users": "select s_suppkey user_no, s_name first_nm, 'N' || cast(s_nationkey as string) last_nm from {supplier}",
    "fx_salesmen": """
select cast(s_suppkey as string) sm_no, s_name sm_first_nm, 'S' || cast(s_nationkey as string) sm_last_nm from {supplier}""",
    "fx_assign": """
select cast(o_orderkey as string) ja_lead, 'IM' ja_position, o_orderkey % 10 ja_user from {orders} union all
select cast(o_orderkey as string), 'PC', (o_orderkey + 3) % 10 from {orders} where o_orderstatus <> 'P'""",
    "fx_reasons": """
select event_id lrkey, cast(event_id % 1000 as string) lrlead, event_id % 3 lrreason, event_id % 2 lrsubreason,
 event_id % 10 lruser, cast(ts as date) lrdate from {events}""",
    "fx_reason_names": "select cast(r_regionkey as bigint) rmreason, r_name || '  ' rmdesc from {region}",
    "fx_subreason_names": """
select cast(n_nationkey % 3 as bigint) srreason, cast(n_nationkey % 2 as bigint) srsubreason, min(n_name) srdesc
 from {nation} group by n_nationkey % 3, n_nationkey % 2""",
    "fx_lead_dates": """
select user_id ldlead, cast(min(ts) as date) - cast((user_id % 3) * 400 as int) ldadate,
 case when user_id % 4 = 0 then null else date '2024-02-05' end ldfupdate from {events} group by user_id""",
    "fx_audit": """
select event_id audit_key, ts audit_ts, user_id lead,
 case when event_id % 5 = 0 then null else cast(ts as date) + cast(event_id % 21 as int) end plan_dt,
 case when event_id % 17 = 0 then 'MEA' else 'INS' end audit_type from {events} where event_type = 'purchase'""",
    "fx_comments": r"""
select event_id cmkey, user_id cmlead, ts cmdatetime, event_id % 10 cmuser, case
 when event_type = 'error' and event_id % 2 = 0 then 'Service appointment scheduled by TOA failed - no slot'
 when event_type = 'error' then 'Comments from APP Workflow: customer called, storm damage'
 when event_type = 'view' and event_id % 4 = 0 then 'Installer appointment scheduled by TOA'
 when event_type = 'view' and event_id % 4 = 1 then 'x Unschedule Reason code -  Weather Scheduling Comments -  heavy rain by TOA'
 when event_type = 'view' and event_id % 4 = 2 then 'x Reschedule Reason code -  Other Scheduling Comments -  call back by TOA'
 when event_type = 'view' then 'Email send to a@b.c file.pdf attached'
 when event_type = 'click' and event_id % 3 = 0 then 'Override Reason code -  Capacity by TOA'
 when event_type = 'click' and event_id % 3 = 1 then 'Measure appointment Re-scheduled by TOA'
 else 'plain note ' || cast(event_id as string) end cmcomment
 from {events} where event_type in ('error', 'view', 'click')""",
    "fx_history": """
select event_id hist_key, cast(user_id as string) lead, ts reason_ts,
 case when event_id % 7 = 0 then 'Status' else 'Provider_Issues__c' end field,
 'Reschedule Requested - ' || case when event_id % 2 = 0 then 'Customer' else 'Crew' end newvalue
 from {events} where event_type = 'signup'""",
    "fx_history_events": """
select event_id hist_key, 'A' || cast(event_id as string) appt_id, ts reason_ts,
 case when event_id % 7 = 0 then 'Status' else 'Provider_Issues__c' end field,
 'Reschedule Requested - ' || case when event_id % 2 = 0 then 'Customer' else 'Crew' end newvalue
 from {events} where event_type = 'signup'""",
    "fx_workorders": """
select 'W' || cast(event_id as string) workorder_id, cast(user_id as string) lms_lead_id, ts workorder_created
 from {events} where event_type = 'signup'""",
    "fx_appointments": """
select 'A' || cast(event_id as string) appt_id, 'W' || cast(event_id as string) parent_record_id,
 ts appt_created, event_type appt_status, cast(event_id % 5 as int) record_type_id, value appt_value from {events}""",
    "fx_record_types": "select r_regionkey id, r_name name from {region}",
    "fx_yard": """
select event_id trailer_key, user_id dc_nbr, cast(ts as date) in_yard_dt, value units from {events} where event_type = 'view'""",
    "fx_arrivals": "select event_id arr_key, user_id arr_dc_nbr, cast(ts as date) arvl_dt from {events} where event_type = 'click'",
    "fx_alloc": """
select *, cast(floor(0.6 * sum(virt_qty) over (partition by sku_nbr, rdc_nbr)) as double) qty_to_alloc from
 (select l_partkey sku_nbr, l_suppkey % 5 rdc_nbr, l_orderkey loc_nbr, sum(l_quantity) virt_qty,
  min(l_linenumber) buy_uom_qty, round(min(l_discount) * 40, 2) wos, min(l_suppkey) mvndr from {lineitem} group by 1, 2, 3) q""",
    "fx_trailers": """
select cast(l_suppkey % 5 as string) rdc_nbr, 'T' || cast(l_orderkey as string) trlr_nbr, l_orderkey po_nbr,
 cast(o_orderdate as date) po_crt_dt, l_partkey sku_nbr, l_quantity units_ordered, l_suppkey vendor_id,
 cast(l_shipdate as date) in_yard_dt,
 case l_linenumber % 6 when 0 then 'OVR' when 1 then 'PT3' when 2 then 'PLT' when 3 then 'FLU' else 'STD' end putwy_type,
 case l_returnflag when 'A' then 'RDC' when 'N' then 'LTL' when 'R' then 'TF' else 'ZZ' end load_typ,
 case when l_tax = 0.08 then 'Z9' end move_2_zone
 from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "fx_yard_arrivals": """
select l_suppkey % 5 dc_nbr, 'T' || cast(l_orderkey as string) tlr_nbr, min(l_shipdate) arvl_tm,
 case when l_orderkey % 11 = 0 then 'DD1' else 'A1' end zone from {lineitem} group by l_suppkey % 5, l_orderkey""",
    "fx_plan": """
select case when o_orderpriority = '5-LOW' then date '1998-03-09' else date '1998-03-10' end cal_dt,
 cast(k.rdc as string) rdc_nbr, 'T' || cast(o_orderkey as string) trlr_nbr, cast(o_orderkey % 200 as string) asn_nbr,
 cast(o_orderkey % 7 as int) priority_nbr, 'N' execute
 from {orders} join (select distinct l_orderkey, l_suppkey % 5 rdc from {lineitem}) k on o_orderkey = k.l_orderkey""",
    "fx_plan_errors": """
select distinct cast(l_suppkey % 5 as string) rdc_nbr, cast(l_orderkey % 200 as string) asn_nbr
 from {lineitem} where l_returnflag = 'R' and l_quantity = 50""",
    "fx_allocated": """
select distinct l_orderkey po_nbr, l_suppkey % 5 recv_loc_nbr, cast(o_orderdate as date) po_crt_dt
 from {lineitem} join {orders} on l_orderkey = o_orderkey where o_orderstatus = 'F'""",
    "fx_requests": """
select l_orderkey * 10 + l_suppkey % 5 agg_nbr, cast(l_suppkey % 5 as string) mkt_dc_nbr, cast(min(o_orderdate) as date) ord_dt,
 min(l_suppkey) mvndr_nbr, l_orderkey po_nbr,
 case l_orderkey % 3 when 0 then 'PGM1' when 1 then 'PGM2' else 'OTHER' end crt_pgm_id, l_orderkey % 7 agg_typ_cd
 from {lineitem} join {orders} on l_orderkey = o_orderkey group by l_orderkey, l_suppkey % 5""",
    "fx_order_events": """
select l_orderkey po_nbr, cast(l_suppkey % 5 as string) recv_loc_nbr, cast(min(o_orderdate) as date) ord_crt_dt,
 l_orderkey % 4 dsvc_typ_cd, l_orderkey % 3 rmeth_cd
 from {lineitem} join {orders} on l_orderkey = o_orderkey group by l_orderkey, l_suppkey % 5""",
    "fx_skus": """
select p_partkey sku_nbr, date '1990-01-01' + cast(p_size as int) sku_crt_dt from {part} union all
select p_partkey, date '1989-01-01' from {part}""",
    "fx_allocs": """
select l_orderkey * 10 + l_suppkey % 5 agg_nbr, o_custkey % 1000 loc_nbr, l_partkey sku_nbr,
 l_quantity expctd_alloc_qty, round(l_quantity * l_discount, 2) conf_alloc_qty,
 case when l_linestatus = 'O' then timestamp '9999-12-31 00:00:00' else l_shipdate end eff_end_dttm
 from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "fx_store_params": """
select cast(o_custkey % 1000 as string) str_nbr, l_partkey sku_nbr, date '1990-01-01' + cast(min(p_size) as int) sku_crt_dt,
 date '1998-03-09' cal_dt, min(l_linenumber) buy_uom_qty
 from {lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey group by o_custkey % 1000, l_partkey""",
    "fx_store_stock": """
select cast(o_custkey % 1000 as string) str_nbr, l_partkey sku_nbr, date '1990-01-01' + cast(min(p_size) as int) sku_crt_dt,
 min(l_quantity) - 20 oh_qty, min(l_quantity) oo_qty, case when min(l_tax) > 0.02 then 3.0 end cord_alloc_qty,
 cast(min(l_linenumber) as double) lead_tm_qty, 2.0 rev_tm_qty,
 cast(min(l_linenumber) * 3 as double) lead_tm_days, case when min(l_discount) > 0.01 then 7.0 end rev_tm_days_cnt
 from {lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey group by o_custkey % 1000, l_partkey""",
    "fx_series": """
select year(o_orderdate) yr, month(o_orderdate) mo, cast(date_trunc('month', o_orderdate) as date) ds,
 o_orderpriority series, count(*) y from {orders} group by 1, 2, 3, 4""",
    "fx_text": """
select doc_id, text || case doc_id % 5 when 0 then ' I DONT know what''s wrong, don''t ask'
 when 1 then ' see https://ex.org/a%20b?x=1 to set up' when 2 then ' Star Review side by side'
 when 3 then ' put together' else '' end text from {documents}""",
    "fx_params": """
select l_linenumber trumping_level, l_suppkey % 3 type, l_discount store_group, l_tax volume_id, l_returnflag velocity_id,
 l_extendedprice sku, l_quantity sku_grp, l_discount store, l_partkey parm_code, l_quantity parm_value,
 cast(cast(l_shipdate as date) as string) eff_begin_date, cast(cast(l_shipdate as date) + 30 as string) eff_end_date,
 l_tax start_fscl_wk_nbr, l_discount end_fscl_wk_nbr, l_linestatus param_desc,
 case when l_linestatus = 'O' then 'late' end ootl_reason_code from {lineitem}""",
    "fx_results": "select user_id, event_type mail, date_trunc('hour', ts) run_ts, value, event_id from {events}",
}

_SCHEMAS: dict[str, StructType] = {}
_NAME = re.compile(r"\{(\w+)\}")


class Tables:
    """The test tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._bucketed: dict[str, DataFrame] = {}

    def bucketed(self, keys: Mapping[str, str], views: Sequence[str]) -> Tables:
        """These tables for ``views`` that join some of them again and again by one key: those are written in its buckets.

        Only columns that the views name are written.
        """
        named = set(re.findall(r"\w+", " ".join(VIEWS[v] for v in views)))
        tables = Tables(self.spark, self.folder)
        for name, key in keys.items():
            rows = self.table(name)
            tables._bucketed[name] = bucketed(rows.select(*[c for c in rows.columns if c in named]), name, key)
        return tables

    def table(self, name: str) -> DataFrame:
        """The table, with the schema known from its first use (as from a catalog)."""
        if name in self._bucketed:
            return self._bucketed[name]
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def fx(self, name: str) -> DataFrame:
        text = VIEWS[name]
        return self.spark.sql(text, **{t: self.table(t) for t in sorted(set(_NAME.findall(text)))})


CALENDAR_SQL = """
select cal_dt, cast(floor((cal_dt - fy_start) / 7) + 1 as int) fscl_wk_nbr,
 cast(fy as varchar) || lpad(cast(cast(floor((cal_dt - fy_start) / 7) + 1 as int) as varchar), 2, '0') fscl_yr_wk_key,
 cast(date_trunc('week', cal_dt) as date) wk_begin, cast(date_trunc('week', cal_dt) as date) - 7 prev_wk_begin
from (select cal_dt, case when cal_dt >= this_start then year(cal_dt) else year(cal_dt) - 1 end fy,
        case when cal_dt >= this_start then this_start else last_start end fy_start
      from (select cal_dt, cast(date_trunc('week', make_date(year(cal_dt), 2, 1) + 3) as date) this_start,
              cast(date_trunc('week', make_date(year(cal_dt) - 1, 2, 1) + 3) as date) last_start
            from (select cast(unnest(generate_series(date '1994-01-01', date '2025-12-31', interval 1 day)) as date) cal_dt) d) s) f"""


def with_views(*names: str) -> str:
    """The WITH clause of a check that needs these views (``fx_cal`` is the calendar)."""
    parts = [f"{n} as ({CALENDAR_SQL if n == 'fx_cal' else _NAME.sub(r'\1', VIEWS[n])})" for n in names]
    return "with " + ",\n".join(parts)
