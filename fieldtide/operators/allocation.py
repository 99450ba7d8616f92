"""Stock allocation: supply on the yard, weeks of supply, running allocation, uploads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtide.functions import dates, rules
from fieldtide.functions import fixed_values as fixed
from fieldtide.operators import columns, joins, ordered


def latest_sku(skus: DataFrame) -> DataFrame:
    """Every SKU with its latest creation date."""
    return skus.groupBy("sku_nbr").agg(F.max("sku_crt_dt").alias("sku_crt_dt"))


def alloc_sums(df: DataFrame, keys: Sequence[str], quantity: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(quantity).alias(name))


def confirmed_allocations(allocs: DataFrame, requests: DataFrame, skus: DataFrame, since: str, stores: DataFrame | None = None) -> DataFrame:
    """Open confirmed quantity per store and SKU of requests after ``since``, of SKUs and stores in ``stores`` only if given."""
    opened = columns.current_version(allocs, "eff_end_dttm")
    opened = opened if stores is None else of_items(opened, stores, "loc_nbr")
    asked = requests.where(F.col("ord_dt") > F.lit(since).cast("date")).select("agg_nbr", F.col("mkt_dc_nbr").alias("rdc_nbr"))
    rows = opened.join(asked, "agg_nbr").join(latest_sku(skus), "sku_nbr")
    return alloc_sums(rows, ["rdc_nbr", "loc_nbr", "sku_nbr", "sku_crt_dt"], "conf_alloc_qty", "conf_alloc_qty")


def _int(column: str) -> Column:
    return F.expr(f"try_cast({column} as bigint)")


def stores_of(rows: DataFrame) -> DataFrame:
    """The stores of every SKU of rows with ``sku_nbr`` and ``loc_nbr``, as one list of numbers per SKU."""
    return rows.groupBy(F.col("sku_nbr").alias("_sku")).agg(F.collect_set(_int("loc_nbr")).alias("_stores"))


def of_items(df: DataFrame, stores: DataFrame, store: str) -> DataFrame:
    """The rows whose SKU has their store in ``stores`` (``stores_of``); rows that lie by SKU already are not moved."""
    return df.join(stores, (F.col("sku_nbr") == F.col("_sku")) & F.array_contains("_stores", _int(store)), "left_semi")


def yard_lines(trailers: DataFrame, arrivals: DataFrame, requests: DataFrame, events: DataFrame) -> DataFrame:
    """Trailer lines with a matching arrival (within three days), request and order event."""
    waiting = trailers.where(
        F.col("putwy_type").isin(*fixed.PUTAWAY_TYPES)
        & F.col("load_typ").isin(*fixed.LOAD_TYPES)
        & F.col("move_2_zone").isNull()
    ).withColumn("_rdc", _int("rdc_nbr"))
    # Only existence matters from here on (the result is distinct), so these are semi joins. Requests, events and trailers
    # meet by order, and the days a trailer arrived on are one list: both are short.
    wanted = requests.where(
        F.col("crt_pgm_id").isin(*fixed.CREATE_PROGRAMS) | (F.col("agg_typ_cd") == fixed.ANY_PROGRAM_TYPE)
    ).select("po_nbr", _int("mkt_dc_nbr").alias("_dc"), "ord_dt")
    allowed = events.where(
        (F.col("dsvc_typ_cd") != fixed.EXCLUDED_SERVICE) & F.col("rmeth_cd").isin(*fixed.RECEIVE_METHODS)
    ).select("po_nbr", _int("recv_loc_nbr").alias("_recv"), "ord_crt_dt")
    ordered_now = joins.semi_join_by(wanted, allowed, "po_nbr", {"po_nbr": "po_nbr", "_dc": "_recv", "ord_dt": "ord_crt_dt"})
    rows = joins.semi_join_by(waiting, ordered_now, "po_nbr", {"po_nbr": "po_nbr", "_rdc": "_dc", "po_crt_dt": "ord_dt"})
    seen = arrivals.where(~F.col("zone").like(fixed.EXCLUDED_ZONE)).groupBy(
        _int("dc_nbr").alias("_dc"), F.col("tlr_nbr").alias("_tlr")
    ).agg(F.collect_set(F.col("arvl_tm").cast("date")).alias("_days"))
    near = F.exists("_days", lambda day: dates.fn_datetime_diff("day", day, F.col("in_yard_dt")).between(-3, 3))
    return rows.join(seen, (F.col("_rdc") == F.col("_dc")) & (F.col("trlr_nbr") == F.col("_tlr")) & near, "left_semi")


def yard_supply(
    trailers: DataFrame, arrivals: DataFrame, plan: DataFrame, allocated: DataFrame, requests: DataFrame,
    events: DataFrame, skus: DataFrame, as_of: str, lines: DataFrame | None = None,
) -> DataFrame:
    """Units on the yard per SKU, DC and vendor that are planned today and not yet allocated.

    Equal lines (SKU, order, DC, units, vendor) count once. ``lines`` takes a stored result of
    ``yard_lines`` when several steps need it.
    """
    today = plan.where(F.col("cal_dt") == F.lit(as_of).cast("date")).select(
        _int("rdc_nbr").alias("_plan_rdc"), F.col("trlr_nbr").alias("_plan_trlr")
    )
    done = allocated.select("po_nbr", _int("recv_loc_nbr").alias("_recv"), "po_crt_dt")
    rows = lines if lines is not None else yard_lines(trailers, arrivals, requests, events)
    rows = joins.semi_join(rows, today, {"_rdc": "_plan_rdc", "trlr_nbr": "_plan_trlr"})
    rows = joins.anti_join_by(rows, done, "po_nbr", {"po_nbr": "po_nbr", "_rdc": "_recv", "po_crt_dt": "po_crt_dt"})
    distinct = rows.join(latest_sku(skus), "sku_nbr").select(
        "sku_nbr", "po_nbr", "sku_crt_dt", "rdc_nbr", "units_ordered", F.col("vendor_id").alias("mven")
    ).distinct()
    return alloc_sums(distinct, ["sku_nbr", "sku_crt_dt", "rdc_nbr", "mven"], "units_ordered", "units_ordered")


def virtual_allocations(
    allocs: DataFrame, requests: DataFrame, skus: DataFrame, trailers: DataFrame, arrivals: DataFrame,
    events: DataFrame, since: str, lines: DataFrame | None = None,
) -> DataFrame:
    """Expected quantity per store, SKU and vendor of requests whose order is on the yard."""
    here = lines if lines is not None else yard_lines(trailers, arrivals, requests, events)
    here = here.select("vendor_id", "po_nbr", "_rdc")
    asked = requests.where(F.col("ord_dt") > F.lit(since).cast("date")).withColumn("_dc", _int("mkt_dc_nbr"))
    asked = joins.semi_join_by(asked, here, "po_nbr", {"mvndr_nbr": "vendor_id", "po_nbr": "po_nbr", "_dc": "_rdc"})
    asked = asked.select("agg_nbr", F.col("mkt_dc_nbr").alias("rdc_nbr"), "mvndr_nbr")
    rows = allocs.join(asked, "agg_nbr").join(latest_sku(skus), "sku_nbr")
    keys = ["rdc_nbr", "loc_nbr", "sku_nbr", "sku_crt_dt", "mvndr_nbr"]
    return alloc_sums(rows, keys, "expctd_alloc_qty", "virt_qty")


def weeks_of_supply(
    on_hand: Column, on_order: Column, confirmed: Column, committed: Column,
    lead_qty: Column, review_qty: Column, lead_days: Column, review_days: Column,
) -> Column:
    """Available stock over weekly demand; 0 when stock is negative, NULL when demand is unknown or 0."""
    zero = F.lit(0)
    stock = on_hand + on_order + F.coalesce(confirmed, zero) - F.coalesce(committed, zero)
    days = F.coalesce(review_days, zero) + F.coalesce(lead_days, zero)
    weekly = F.try_divide(lead_qty + review_qty, days) * 7
    return F.when(stock < 0, F.lit(0.0)).otherwise(F.try_divide(stock, weekly))


def allocation_input(
    virtual: DataFrame, yard: DataFrame, confirmed: DataFrame, parameters: DataFrame, inventory: DataFrame, as_of: str
) -> DataFrame:
    """One row per vendor, DC, SKU and store with stock, weeks of supply, limit and store rank."""
    supply = yard.select(
        _int("rdc_nbr").alias("_yard_rdc"), "sku_nbr", "sku_crt_dt",
        F.col("units_ordered").alias("qty_to_alloc"), F.col("mven").alias("mvndr"),
    )
    rows = virtual.withColumn("_rdc", _int("rdc_nbr")).join(supply, ["sku_nbr", "sku_crt_dt"])
    rows = rows.where(F.col("_rdc") == F.col("_yard_rdc")).withColumn("_loc", _int("loc_nbr"))
    conf = confirmed.select("sku_nbr", "sku_crt_dt", _int("loc_nbr").alias("_loc"), "conf_alloc_qty")
    item = ["sku_nbr", "sku_crt_dt", "_loc"]
    rows = rows.join(conf, item, "left").select(
        "mvndr", "rdc_nbr", *item, "loc_nbr", "virt_qty", "conf_alloc_qty", "qty_to_alloc"
    ).distinct()
    yesterday = F.date_sub(F.lit(as_of).cast("date"), 1)
    pack = parameters.where(F.col("cal_dt") == yesterday).select(
        _int("str_nbr").alias("_loc"), "sku_nbr", "sku_crt_dt", "buy_uom_qty"
    )
    stock = inventory.withColumn("_loc", _int("str_nbr")).drop("str_nbr")
    rows = rows.join(pack, item, "left").join(stock, item, "left")
    weeks = weeks_of_supply(*[F.col(c) for c in (
        "oh_qty", "oo_qty", "conf_alloc_qty", "cord_alloc_qty",
        "lead_tm_qty", "rev_tm_qty", "lead_tm_days", "rev_tm_days_cnt",
    )])
    keys = ["mvndr", "rdc_nbr", "sku_nbr", "loc_nbr", "buy_uom_qty", "oh_qty", "oo_qty", "virt_qty", "qty_to_alloc"]
    detail = rows.groupBy(*keys).agg(F.sum(weeks).alias("wos")).where(F.col("virt_qty") > 0)
    return detail.withColumn("store_rank", rules.store_rank(F.col("wos")))


def running_allocation(
    df: DataFrame, keys: Sequence[str] = ("sku_nbr", "rdc_nbr"), order: Sequence[Column] | None = None,
    quantity: str = "virt_qty", limit: str = "qty_to_alloc", **options,
) -> DataFrame:
    """Give stores their quantity in order until the limit of the key is used up.

    The running sum counts rows (not ranges of equal values). A store past the limit gets what
    is left, which is negative once nothing is left; ``allocation_trim`` removes those.
    """
    if order is None:
        order = [F.col("store_rank"), F.col("virt_qty").desc(), F.col("wos").asc_nulls_last(), F.col("loc_nbr")]
        order += [F.col("mvndr")] if "mvndr" in df.columns else []
    rows = ordered.numbered(df, list(keys), order, number="alloc_no", sums={"cum_qty": quantity}, **options)
    cum, qty, cap = F.col("cum_qty"), F.col(quantity), F.col(limit)
    return rows.withColumn("included_qty", F.when(cum < cap, qty).when(cum >= cap, cap - (cum - qty)))


def allocation_trim(df: DataFrame) -> DataFrame:
    """Keep positive shares; empty stores give back one buy pack."""
    share = F.col("included_qty")
    less_pack = F.when(F.col("wos") == 0, share - F.col("buy_uom_qty")).otherwise(share)
    return df.where(share > 0).withColumn("included_qty", less_pack).where(F.col("included_qty") > 0)


def upload_dates(df: DataFrame, as_of: str, end_days: int, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Start date and end date (``end_days`` later) as MM/dd/yyyy text."""
    day = F.lit(as_of).cast("date")
    return df.withColumns({
        start: F.date_format(day, "MM/dd/yyyy"), end: F.date_format(F.date_add(day, end_days), "MM/dd/yyyy")
    })


def allocation_upload(allocated: DataFrame, as_of: str, size: int = 1999) -> DataFrame:
    """Upload rows of an allocation input, numbered in chunks of ``size``.

    Numbering stores its sorted input, so the many joins behind it run once.
    """
    kept = allocation_trim(running_allocation(allocated))
    rows = kept.select(
        F.col("mvndr").alias("vendor"), F.col("rdc_nbr").alias("rdc"), F.col("sku_nbr").alias("sku"),
        F.col("loc_nbr").alias("loc"), F.col("included_qty").alias("qty"),
        "store_rank", "alloc_no",
    )
    rows = upload_dates(rows, as_of, 1)
    order = [F.col("rdc"), F.col("sku"), F.col("alloc_no")]
    numbered = ordered.chunk_numbers(rows, order, size)
    return numbered.select("vendor", "rdc", "sku", "loc", "start_date", "end_date", "qty", "row_no", "chunk_no")


def merge_flags(plan: DataFrame, errors: DataFrame, keys: Sequence[str], as_of: str) -> DataFrame:
    """Flag today's rows Y, those listed as errors N; other days keep their flag."""
    listed = errors.select(*keys).distinct().withColumn("_error", F.lit(True))
    today = F.col("cal_dt") == F.lit(as_of).cast("date")
    flag = F.when(today & F.col("_error"), "N").when(today, "Y").otherwise(F.col("execute"))
    return plan.join(listed, list(keys), "left").withColumn("execute", flag).drop("_error").select(*plan.columns)


def override_upload(plan: DataFrame, errors: DataFrame, as_of: str, keys: Sequence[str] = ("rdc_nbr", "asn_nbr")) -> DataFrame:
    """Distinct trailers to execute today in the upload layout, valid for three days."""
    flagged = merge_flags(plan, errors, keys, as_of)
    today = flagged.where((F.col("cal_dt") == F.lit(as_of).cast("date")) & (F.col("execute") == "Y"))
    rows = today.select(
        "rdc_nbr", F.lit(" ").alias("mvndr_nbr"), F.col("trlr_nbr").alias("trailer_nbr"),
        F.lit(" ").alias("po_nbr"), "priority_nbr",
    ).distinct()
    return upload_dates(rows, as_of, 3)
