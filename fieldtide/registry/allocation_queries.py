"""Supply, allocation and uploads."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldtide.adapters import AS_OF_ORDERS, Tables
from fieldtide.functions import fixed_values as fixed
from fieldtide.functions.rules import store_rank
from fieldtide.operators import allocation as al
from fieldtide.operators import ordered
from fieldtide.plans.allocation import allocation_tables
from fieldtide.registry.core import query

SINCE = "1995-06-01"
SKU_SQL = "newest as (select sku_nbr, max(sku_crt_dt) sku_crt_dt from fx_skus group by 1)"
# Lines on the yard: trailers for which an arrival, an allowed request and an order event exist.
LINES_SQL = f"""allowed as (select po_nbr, ord_dt, mkt_dc_nbr::bigint dc from fx_requests where (crt_pgm_id in {fixed.CREATE_PROGRAMS} or agg_typ_cd = 5)
 and exists (select 1 from fx_order_events o where o.po_nbr = fx_requests.po_nbr and o.recv_loc_nbr::bigint = mkt_dc_nbr::bigint
  and ord_crt_dt = ord_dt and dsvc_typ_cd <> 3 and rmeth_cd in (1, 2))),
lines as (select *, rdc_nbr::bigint rdc from fx_trailers where putwy_type in {fixed.PUTAWAY_TYPES} and load_typ in {fixed.LOAD_TYPES} and move_2_zone is null
 and exists (select 1 from fx_yard_arrivals where dc_nbr = rdc_nbr::bigint and tlr_nbr = trlr_nbr and zone not like 'DD%'
  and abs(date_diff('day', arvl_tm::date, in_yard_dt)) <= 3)
 and exists (select 1 from allowed where allowed.po_nbr = fx_trailers.po_nbr and dc = rdc_nbr::bigint and ord_dt = po_crt_dt))"""
SUPPLY_SQL = f"""supply as (select sku_nbr, sku_crt_dt, rdc_nbr, vendor_id mven, sum(units_ordered) units_ordered from
 (select distinct sku_nbr, po_nbr, rdc_nbr, units_ordered, vendor_id from lines
  where exists (select 1 from fx_plan where cal_dt = date '{AS_OF_ORDERS}' and fx_plan.rdc_nbr::bigint = rdc and fx_plan.trlr_nbr = lines.trlr_nbr)
  and not exists (select 1 from fx_allocated d where d.po_nbr = lines.po_nbr and recv_loc_nbr = rdc and d.po_crt_dt = lines.po_crt_dt)) x
 join newest using (sku_nbr) group by 1, 2, 3, 4)"""
CONF_SQL = f"""confirmed as (select mkt_dc_nbr rdc_nbr, loc_nbr, sku_nbr, sku_crt_dt, sum(conf_alloc_qty) conf_alloc_qty
 from (select * from fx_allocs where eff_end_dttm::date = date '{fixed.OPEN_END}') a
 join (select agg_nbr, mkt_dc_nbr from fx_requests where ord_dt > date '{SINCE}') q using (agg_nbr) join newest using (sku_nbr) group by 1, 2, 3, 4)"""
VIRT_SQL = f"""expected as (select mkt_dc_nbr rdc_nbr, loc_nbr, sku_nbr, sku_crt_dt, mvndr_nbr, sum(expctd_alloc_qty) virt_qty from fx_allocs
 join (select agg_nbr, mkt_dc_nbr, mvndr_nbr from fx_requests where ord_dt > date '{SINCE}' and (mvndr_nbr, po_nbr, mkt_dc_nbr::bigint) in
  (select vendor_id, po_nbr, rdc from lines)) q using (agg_nbr) join newest using (sku_nbr) group by 1, 2, 3, 4, 5)"""
STOCK = "oh_qty + oo_qty + coalesce(conf_alloc_qty, 0) - coalesce(cord_alloc_qty, 0)"
DEMAND = "7 * (lead_tm_qty + rev_tm_qty) / nullif(coalesce(rev_tm_days_cnt, 0) + coalesce(lead_tm_days, 0), 0)"
WOS_SQL = f"if({STOCK} < 0, 0, ({STOCK}) / nullif({DEMAND}, 0))"
INPUT_SQL = f"""wanted as (select distinct mven mvndr, e.rdc_nbr, sku_nbr, sku_crt_dt, loc_nbr, virt_qty, units_ordered qty_to_alloc, conf_alloc_qty
 from expected e join supply s using (sku_nbr, sku_crt_dt) left join (select sku_nbr, sku_crt_dt, loc_nbr, conf_alloc_qty from confirmed) c using (sku_nbr, sku_crt_dt, loc_nbr)
 where s.rdc_nbr::bigint = e.rdc_nbr::bigint),
packs as (select str_nbr::bigint loc_nbr, sku_nbr, sku_crt_dt, buy_uom_qty from fx_store_params where cal_dt = date '{AS_OF_ORDERS}' - 1),
stock as (select * exclude (str_nbr), str_nbr::bigint loc_nbr from fx_store_stock),
weighed as (select mvndr, rdc_nbr, sku_nbr, loc_nbr, buy_uom_qty, oh_qty, oo_qty, virt_qty, qty_to_alloc, sum({WOS_SQL}) wos
 from wanted left join packs using (loc_nbr, sku_nbr, sku_crt_dt) left join stock using (loc_nbr, sku_nbr, sku_crt_dt)
 where virt_qty > 0 group by all),
input as (select *, case when wos = 0 then 1 when wos < 2 then 2 else 3 end store_rank from weighed)"""
YARD_VIEWS = ["fx_trailers", "fx_yard_arrivals", "fx_requests", "fx_order_events"]
INPUT_VIEWS = [*YARD_VIEWS, "fx_plan", "fx_allocated", "fx_skus", "fx_allocs", "fx_store_params", "fx_store_stock"]
INPUT_PARTS = ", ".join([SKU_SQL, LINES_SQL, SUPPLY_SQL, CONF_SQL, VIRT_SQL, INPUT_SQL])


def running_sql(source: str, order: str) -> str:
    """The running allocation, trim and upload rows of an input with these columns."""
    return f"""cums as (select *, row_number() over w alloc_no, sum(virt_qty) over w cum_qty from {source}
  window w as (partition by sku_nbr, rdc_nbr order by {order} rows between unbounded preceding and current row)),
shares as (select *, case when cum_qty < qty_to_alloc then virt_qty when cum_qty >= qty_to_alloc then qty_to_alloc - (cum_qty - virt_qty) end included_qty from cums),
trimmed as (select * from
 (select * replace (case when wos = 0 then included_qty - buy_uom_qty else included_qty end as included_qty) from shares where included_qty > 0) x
 where included_qty > 0)"""


ALLOC_ORDER = "store_rank, virt_qty desc, wos nulls last, loc_nbr"
RANKED = "ranked as (select *, case when wos = 0 then 1 when wos < 2 then 2 else 3 end store_rank from fx_alloc)"


def ranked(t: Tables):
    return t.fx("fx_alloc").withColumn("store_rank", store_rank(F.col("wos")))


def yard(t: Tables):
    return al.yard_supply(
        t.fx("fx_trailers"), t.fx("fx_yard_arrivals"), t.fx("fx_plan"), t.fx("fx_allocated"), t.fx("fx_requests"),
        t.fx("fx_order_events"), t.fx("fx_skus"), AS_OF_ORDERS)


def virtual(t: Tables):
    return al.virtual_allocations(
        t.fx("fx_allocs"), t.fx("fx_requests"), t.fx("fx_skus"), t.fx("fx_trailers"), t.fx("fx_yard_arrivals"),
        t.fx("fx_order_events"), SINCE)


def confirmed(t: Tables):
    return al.confirmed_allocations(t.fx("fx_allocs"), t.fx("fx_requests"), t.fx("fx_skus"), SINCE)


def allocation_rows(t: Tables):
    names = ("fx_trailers", "fx_yard_arrivals", "fx_plan", "fx_allocated", "fx_requests", "fx_order_events", "fx_skus",
             "fx_allocs", "fx_store_params", "fx_store_stock")
    # Eight of these views join the lines to their orders.
    t = t.bucketed({"lineitem": "l_orderkey", "orders": "o_orderkey"}, names)
    rows = allocation_tables(*[t.fx(n) for n in names], AS_OF_ORDERS, SINCE)
    return rows.withColumn("wos", F.round("wos", 6))


@query("yard_supply", ", ".join([SKU_SQL, LINES_SQL, SUPPLY_SQL]) + "---select * from supply",
       views=[*YARD_VIEWS, "fx_plan", "fx_allocated", "fx_skus"], texts=["sku_crt_dt"])
def yard_query(t):
    return yard(t)


@query("alloc_sums", SKU_SQL + ", " + CONF_SQL + "---select * from confirmed", views=["fx_skus", "fx_allocs", "fx_requests"], texts=["sku_crt_dt"], digits={"conf_alloc_qty": 4})
def sums(t):
    return confirmed(t)


@query("virtual_allocations", ", ".join([SKU_SQL, LINES_SQL, VIRT_SQL]) + "---select * from expected", views=[*YARD_VIEWS, "fx_skus", "fx_allocs"], texts=["sku_crt_dt"])
def virtual_query(t):
    return virtual(t)


@query("weeks_of_supply", f"""c as (select str_nbr, sku_nbr, cast(null as double) conf_alloc_qty from fx_store_stock)
---select str_nbr, sku_nbr, sum({WOS_SQL}) wos from fx_store_stock join c using (str_nbr, sku_nbr) group by 1, 2""",
       views=["fx_store_stock"], digits={"wos": 6})
def weeks(t):
    rows = t.fx("fx_store_stock").withColumn("conf_alloc_qty", F.lit(None).cast("double"))
    value = al.weeks_of_supply(*[F.col(c) for c in (
        "oh_qty", "oo_qty", "conf_alloc_qty", "cord_alloc_qty", "lead_tm_qty", "rev_tm_qty", "lead_tm_days", "rev_tm_days_cnt")])
    return rows.groupBy("str_nbr", "sku_nbr").agg(F.sum(value).alias("wos"))


@query("allocation_input", INPUT_PARTS + "---select * from input", views=INPUT_VIEWS, digits={"wos": 6})
def input_query(t):
    return allocation_rows(t)


@query("running_allocation", RANKED + ", " + running_sql("ranked", ALLOC_ORDER) + """---select sku_nbr, rdc_nbr, loc_nbr, store_rank, virt_qty, wos,
 qty_to_alloc, alloc_no, cum_qty, included_qty from shares""", views=["fx_alloc"])
def running(t):
    return al.running_allocation(ranked(t)).select(
        "sku_nbr", "rdc_nbr", "loc_nbr", "store_rank", "virt_qty", "wos", "qty_to_alloc", "alloc_no", "cum_qty", "included_qty")


@query("allocation_trim", RANKED + ", " + running_sql("ranked", ALLOC_ORDER) + "---select sku_nbr, rdc_nbr, loc_nbr, included_qty from trimmed", views=["fx_alloc"])
def trim(t):
    return al.allocation_trim(al.running_allocation(ranked(t))).select("sku_nbr", "rdc_nbr", "loc_nbr", "included_qty")


UPLOAD_SELECT = """select mvndr vendor, rdc_nbr rdc, sku_nbr sku, loc_nbr loc, '03/10/1998' start_date, '03/11/1998' end_date, included_qty qty,
 row_number() over (order by rdc_nbr, sku_nbr, alloc_no) row_no,
 cast(ceil(row_number() over (order by rdc_nbr, sku_nbr, alloc_no) / 1999.0) as bigint) chunk_no from trimmed"""


@query("allocation_upload", INPUT_PARTS.replace("sum(" + WOS_SQL + ") wos", "round(sum(" + WOS_SQL + "), 6) wos") + ", "
       + running_sql("input", ALLOC_ORDER + ", mvndr") + "---" + UPLOAD_SELECT, views=INPUT_VIEWS, digits={"qty": 4})
def upload(t):
    return al.allocation_upload(allocation_rows(t), AS_OF_ORDERS)


@query("export_csv_chunked", """select l_orderkey, n row_no, cast(ceil(n / 1999.0) as bigint) chunk_no from (select l_orderkey, row_number() over
 (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax) n from lineitem) x""")
def chunks(t):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    rows = ordered.chunk_numbers(t.table("lineitem").select(*order), [F.col(c) for c in order])
    return rows.select("l_orderkey", "row_no", "chunk_no")


FLAG_SQL = f"""flagged as (select p.* replace (case when cal_dt = date '{AS_OF_ORDERS}' and e.rdc_nbr is not null then 'N'
 when cal_dt = date '{AS_OF_ORDERS}' then 'Y' else execute end as execute) from fx_plan p
 left join fx_plan_errors e on e.rdc_nbr = p.rdc_nbr and e.asn_nbr = p.asn_nbr)"""


@query("merge_flags", FLAG_SQL + "---select * from flagged", views=["fx_plan", "fx_plan_errors"], texts=["cal_dt"])
def flags(t):
    return al.merge_flags(t.fx("fx_plan"), t.fx("fx_plan_errors"), ["rdc_nbr", "asn_nbr"], AS_OF_ORDERS)


@query("override_upload", FLAG_SQL + f"""---select distinct rdc_nbr, ' ' mvndr_nbr, trlr_nbr trailer_nbr, ' ' po_nbr, priority_nbr,
 '03/10/1998' start_date, '03/13/1998' end_date from flagged where cal_dt = date '{AS_OF_ORDERS}' and execute = 'Y'""", views=["fx_plan", "fx_plan_errors"])
def override(t):
    return al.override_upload(t.fx("fx_plan"), t.fx("fx_plan_errors"), AS_OF_ORDERS)


@query("export_upload_template", "select s_suppkey, '03/10/1998' start_date, '03/13/1998' end_date from supplier")
def template(t):
    return al.upload_dates(t.table("supplier").select("s_suppkey"), AS_OF_ORDERS, 3)
