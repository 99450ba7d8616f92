"""Operators that are plain Spark, shown on the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldtide.adapters import AS_OF_ORDERS
from fieldtide.functions import dates, rules
from fieldtide.operators import columns, joins, ordered
from fieldtide.operators.allocation import latest_sku
from fieldtide.registry.core import query
from fieldtide.registry.falloff_queries import cal


@query("project_star_plus", """select * exclude (o_orderpriority), case when o_orderstatus = 'F' then o_totalprice else 0 end filled
 from orders""", texts=["o_orderdate"])
def star_plus(t):
    filled = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)
    return columns.project_star_plus(t.table("orders"), {"filled": filled}, ["o_orderpriority"])


@query("rename_columns", "select s_suppkey Vendor, s_name Name, s_nationkey Region, s_acctbal Balance from supplier")
def rename(t):
    by_name = columns.rename_columns(t.table("supplier"), {"s_suppkey": "v", "s_name": "n"})
    by_place = columns.rename_columns(by_name, ["a", "b", "c", "d"])
    header = t.spark.createDataFrame([], "Vendor long, Name string, Region int, Balance double")
    return columns.rename_columns(by_place, header)


@query("rank_flag", "select o_orderkey, coalesce(o_custkey % 12 <= 5, false) in_top from orders")
def flag(t):
    return t.table("orders").select("o_orderkey", rules.rank_flag(F.col("o_custkey") % 12).alias("in_top"))


@query("store_rank", "select sku_nbr, rdc_nbr, loc_nbr, case when wos = 0 then 1 when wos < 2 then 2 else 3 end store_rank from fx_alloc", views=["fx_alloc"])
def rank(t):
    return t.fx("fx_alloc").select("sku_nbr", "rdc_nbr", "loc_nbr", rules.store_rank(F.col("wos")).alias("store_rank"))


@query("filter_predicates", """select o_orderkey from orders where o_orderstatus in ('F', 'O') and o_orderpriority not like '5%'
 and o_orderdate between timestamp '1996-01-01' and timestamp '1998-03-10' and o_orderdate >= date '1998-03-10' - 728
 and (o_totalprice > 50000 or o_custkey <> 7) and o_orderkey is not null""")
def predicates(t):
    day = F.col("o_orderdate")
    rows = columns.filter_predicates(
        t.table("orders"),
        F.col("o_orderstatus").isin("F", "O"),
        ~F.col("o_orderpriority").like("5%"),
        day.between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit(AS_OF_ORDERS).cast("timestamp_ntz")),
        day >= F.date_sub(F.lit(AS_OF_ORDERS).cast("date"), 728),
        (F.col("o_totalprice") > 50000) | (F.col("o_custkey") != 7),
        F.col("o_orderkey").isNotNull(),
    )
    return rows.select("o_orderkey")


@query("filter_single_series", "select ds, y from fx_series where series = '2-HIGH'", views=["fx_series"], texts=["ds"])
def one_series(t):
    return columns.filter_single_series(t.fx("fx_series"), "2-HIGH").select("ds", "y")


@query("current_version", "select agg_nbr, loc_nbr, sku_nbr from fx_allocs where cast(eff_end_dttm as date) = date '9999-12-31'", views=["fx_allocs"])
def current(t):
    return columns.current_version(t.fx("fx_allocs"), "eff_end_dttm").select("agg_nbr", "loc_nbr", "sku_nbr")


@query("lookup_replace", """select l_orderkey, l_linenumber, l_quantity, case l_returnflag when 'A' then 'accepted' when 'R' then 'returned' else l_returnflag end flag
 from lineitem""")
def replace(t):
    flag = rules.lookup_replace(F.col("l_returnflag"), {"A": "accepted", "R": "returned"})
    return t.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", flag.alias("flag"))


@query("drop_all_null", """select o_orderkey, a, b from (select o_orderkey, case when o_orderstatus = 'F' then o_totalprice end a,
 case when o_orderpriority = '2-HIGH' then o_custkey end b from orders) x where a is not null or b is not null""")
def all_null(t):
    rows = t.table("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("a"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_custkey")).alias("b"),
    )
    return columns.drop_all_null(rows, ["a", "b"])


@query("inner_join", """select l_orderkey, l_linenumber, l_partkey, l_quantity, p_name, o_orderdate from lineitem
 join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey where p_size > 10""", texts=["o_orderdate"])
def inner(t):
    parts = t.table("part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    orders = t.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return lines.join(parts, "l_partkey").join(orders, "l_orderkey")


@query("cast_key_join", """select ja_lead, ja_position, ldsalesamt from fx_assign join fx_leads on cast(ja_lead as bigint) = ldlead""", views=["fx_assign", "fx_leads"])
def cast_key(t):
    keyed = t.fx("fx_assign").withColumn("ldlead", F.expr("try_cast(ja_lead as bigint)"))
    return keyed.join(t.fx("fx_leads"), "ldlead").select("ja_lead", "ja_position", "ldsalesamt")


@query("multi_key_join", """select a.po_nbr, a.mkt_dc_nbr, b.dsvc_typ_cd from fx_requests a join fx_order_events b
 on a.po_nbr = b.po_nbr and a.mkt_dc_nbr = b.recv_loc_nbr and a.ord_dt = b.ord_crt_dt""", views=["fx_requests", "fx_order_events"])
def multi_key(t):
    events = t.fx("fx_order_events").select("po_nbr", F.col("recv_loc_nbr").alias("mkt_dc_nbr"), F.col("ord_crt_dt").alias("ord_dt"), "dsvc_typ_cd")
    return t.fx("fx_requests").join(events, ["po_nbr", "mkt_dc_nbr", "ord_dt"]).select("po_nbr", "mkt_dc_nbr", "dsvc_typ_cd")


@query("anti_join", """select r.po_nbr, r.mkt_dc_nbr from fx_requests r left join fx_allocated e on e.po_nbr = r.po_nbr
 and e.recv_loc_nbr = cast(r.mkt_dc_nbr as bigint) and e.po_crt_dt = r.ord_dt where e.po_nbr is null""", views=["fx_requests", "fx_allocated"])
def anti(t):
    rows = t.fx("fx_requests").withColumn("dc", F.expr("try_cast(mkt_dc_nbr as bigint)"))
    left = joins.anti_join(rows, t.fx("fx_allocated"), {"po_nbr": "po_nbr", "dc": "recv_loc_nbr", "ord_dt": "po_crt_dt"})
    return left.select("po_nbr", "mkt_dc_nbr")


@query("semi_join", "select lrkey, lrlead from fx_reasons where cast(lrlead as bigint) in (select ldlead from fx_bow)", views=["fx_reasons", "fx_bow"])
def semi(t):
    rows = t.fx("fx_reasons").withColumn("lead", F.expr("try_cast(lrlead as bigint)"))
    return joins.semi_join(rows, t.fx("fx_bow"), {"lead": "ldlead"}).select("lrkey", "lrlead")


@query("null_rejecting_left_join", """select ldlead, division from fx_leads left join fx_loc on loc_nbr = lpad(cast(ldlocation2 as varchar), 4, '0')
 where scn_flg = 'N'""", views=["fx_leads", "fx_loc"])
def null_rejecting(t):
    leads = t.fx("fx_leads").select("ldlead", F.lpad(F.col("ldlocation2").cast("string"), 4, "0").alias("loc_nbr"))
    return leads.join(t.fx("fx_loc"), "loc_nbr", "left").where("scn_flg = 'N'").select("ldlead", "division")


@query("safe_ratio", "select l_orderkey, l_linenumber, l_tax, l_discount, l_tax / nullif(l_discount, 0) ratio from lineitem", digits={"ratio": 8})
def ratio(t):
    return t.table("lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount", rules.safe_ratio(F.col("l_tax"), F.col("l_discount")).alias("ratio"))


@query("distinct_rows", "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def distinct(t):
    return t.table("lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("dynamic_distinct_list", "select distinct series from fx_series", views=["fx_series"])
def distinct_list(t):
    return columns.dynamic_distinct_list(t.fx("fx_series"), "series")


@query("multi_key_sort", """select s_suppkey, s_nationkey, s_acctbal, row_number() over (order by s_nationkey, s_acctbal desc, s_suppkey) line from supplier""")
def sort(t):
    # The line number, computed in blocks, makes the order visible to the check.
    order = [F.col("s_nationkey"), F.col("s_acctbal").desc(), F.col("s_suppkey")]
    rows = t.table("supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return ordered.numbered(rows, [], order, number="line").orderBy(*order)


@query("top_n_comments", """select cmlead, n, row_number() over (order by n desc, cmlead) place from
 (select cmlead, count(*) n from fx_comments group by 1) g order by n desc, cmlead limit 20""", views=["fx_comments"])
def top_n(t):
    counted = t.fx("fx_comments").groupBy("cmlead").agg(F.count(F.lit(1)).alias("n"))
    top = counted.orderBy(F.desc("n"), "cmlead").limit(20)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "cmlead")).cast("long"))


@query("union_all", "select o_custkey k, 'order' src from orders union all select c_custkey, 'customer' from customer")
def union(t):
    orders = t.table("orders").select(F.col("o_custkey").alias("k"), F.lit("order").alias("src"))
    return orders.unionByName(t.table("customer").select(F.lit("customer").alias("src"), F.col("c_custkey").alias("k")))


@query("union_distinct", "select o_custkey k from orders union select c_custkey from customer")
def union_dist(t):
    return t.table("orders").select(F.col("o_custkey").alias("k")).union(t.table("customer").select("c_custkey")).distinct()


@query("fn_string", r"""select cmkey, 'lead ' || cast(cmlead as varchar) joined, lpad(cast(cmkey % 10000 as varchar), 4, '0') padded,
 replace(cmcomment, 'by TOA', '') replaced, rtrim(substr(cmcomment, 24)) tail, lower(trim(cmcomment)) lowered,
 substr(cast(cmdatetime as varchar), 1, 10) day_text, strpos(cmcomment, 'Reason') pos, length(cmcomment) len from fx_comments""", views=["fx_comments"])
def strings(t):
    c = F.col("cmcomment")
    return t.fx("fx_comments").select(
        "cmkey",
        F.concat(F.lit("lead "), F.col("cmlead").cast("string")).alias("joined"),
        F.lpad((F.col("cmkey") % 10000).cast("string"), 4, "0").alias("padded"),
        F.replace(c, F.lit("by TOA"), F.lit("")).alias("replaced"),
        F.rtrim(F.substr(c, F.lit(24))).alias("tail"),
        F.lower(F.trim(c)).alias("lowered"),
        F.expr("substr(cast(cmdatetime as string), 0, 10)").alias("day_text"),
        F.instr(c, "Reason").cast("long").alias("pos"),
        F.length(c).cast("long").alias("len"),
    )


@query("fn_regex", r"""select cmkey, regexp_replace(cmcomment, '[^a-zA-Z ]', '', 'g') letters,
 regexp_replace(cmcomment, 'plain|Measure|Email|Service|Override', '#', 'g') cut from fx_comments""", views=["fx_comments"])
def regex(t):
    c = F.col("cmcomment")
    return t.fx("fx_comments").select(
        "cmkey", F.regexp_replace(c, "[^a-zA-Z ]", "").alias("letters"),
        F.regexp_replace(c, "plain|Measure|Email|Service|Override", "#").alias("cut"))


@query("fn_null", """select ldlead, coalesce(ldjobenddate, ldfupdate) any_date, ldcandate is null is_open,
 case when ldfupdate is null then 0 else ldsalesamt end done_amt from fx_leads""", views=["fx_leads"], texts=["any_date"])
def nulls(t):
    return t.fx("fx_leads").select(
        "ldlead", F.coalesce("ldjobenddate", "ldfupdate").alias("any_date"), F.col("ldcandate").isNull().alias("is_open"),
        F.when(F.col("ldfupdate").isNull(), 0.0).otherwise(F.col("ldsalesamt")).alias("done_amt"))


@query("fn_date", """select o_orderkey, cast(cast(o_orderdate as date) + 3 as varchar) later, cast(cast(o_orderdate as date) - 1 as varchar) before,
 date_diff('day', cast(o_orderdate as date), date '1998-03-10') as days, strftime(o_orderdate, '%m/%d/%Y') us_day, strftime(o_orderdate, '%Y%m%d') compact from orders""")
def date_functions(t):
    day = F.col("o_orderdate").cast("date")
    return t.table("orders").select(
        "o_orderkey", F.date_add(day, 3).cast("string").alias("later"), F.date_sub(day, 1).cast("string").alias("before"),
        F.datediff(F.lit(AS_OF_ORDERS).cast("date"), day).cast("long").alias("days"),
        F.date_format(day, "MM/dd/yyyy").alias("us_day"), F.date_format(day, "yyyyMMdd").alias("compact"))


@query("fn_datetime_diff", """select event_id, date_diff('minute', timestamp '2024-01-15 12:30:30', ts) as minutes, date_diff('hour', timestamp '2024-01-15 12:30:30', ts) as hours,
 date_diff('day', timestamp '2024-01-15 12:30:30', ts) as days from events""")
def datetime_diff(t):
    anchor = F.lit("2024-01-15 12:30:30").cast("timestamp_ntz")
    units = [dates.fn_datetime_diff(u, F.col("ts"), anchor).alias(f"{u}s") for u in ("minute", "hour", "day")]
    return t.table("events").select("event_id", *units)


@query("fn_timezone", """select event_id, strftime(timezone('UTC', timezone('America/New_York', ts)), '%Y-%m-%d %H:%M:%S') as utc,
 strftime(timezone('America/New_York', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') as local from events""")
def zone(t):
    form = "yyyy-MM-dd HH:mm:ss"
    return t.table("events").select(
        "event_id",
        F.date_format(dates.fn_timezone(F.col("ts"), "America/New_York"), form).alias("utc"),
        F.date_format(dates.fn_timezone(F.col("ts"), "UTC", "America/New_York"), form).alias("local"))


@query("fiscal_calendar", """select o_orderkey, c.fscl_wk_nbr, c.fscl_yr_wk_key, cast(c.wk_begin as varchar) wk_begin, cast(c.prev_wk_begin as varchar) prev_wk_begin
 from orders join fx_cal c on c.cal_dt = cast(o_orderdate as date)""", views=["fx_cal"])
def fiscal(t):
    days = cal(t).withColumns({c: F.col(c).cast("string") for c in ("wk_begin", "prev_wk_begin")})
    rows = t.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("cal_dt"))
    return rows.join(days, "cal_dt").drop("cal_dt")


@query("fiscal_week", "select o_orderkey, cast(floor((cast(o_orderdate as date) - date '1995-01-30') / 7) as bigint) + 1 week_no from orders")
def week(t):
    return t.table("orders").select("o_orderkey", dates.fiscal_week(F.col("o_orderdate").cast("date"), "1995-01-30").alias("week_no"))


@query("fn_math", "select l_orderkey, l_linenumber, l_quantity, l_tax, greatest(l_tax, l_discount, 0.05) high, abs(l_tax - l_discount) gap, greatest(l_quantity - 25, 0) clipped from lineitem", digits={"gap": 6})
def math_functions(t):
    tax, discount = F.col("l_tax"), F.col("l_discount")
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", F.greatest(tax, discount, F.lit(0.05)).alias("high"),
        F.abs(tax - discount).alias("gap"), F.greatest(F.col("l_quantity") - 25, F.lit(0.0)).alias("clipped"))


@query("fn_cast", """select o_orderkey, cast(cast(o_custkey as varchar) as bigint) as_long, cast(o_orderkey as double) as_double, cast(o_orderkey as varchar) as_text,
 try_cast(o_orderpriority as bigint) bad_long, cast(cast(o_orderdate as date) as varchar) as_day from orders""")
def casts(t):
    return t.table("orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").cast("long").alias("as_long"), F.col("o_orderkey").cast("double").alias("as_double"),
        F.col("o_orderkey").cast("string").alias("as_text"), F.expr("try_cast(o_orderpriority as bigint)").alias("bad_long"),
        F.col("o_orderdate").cast("date").cast("string").alias("as_day"))


@query("latest_sku", "select sku_nbr, max(sku_crt_dt) sku_crt_dt from fx_skus group by 1", views=["fx_skus"], texts=["sku_crt_dt"])
def skus(t):
    return latest_sku(t.fx("fx_skus"))

