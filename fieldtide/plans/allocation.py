"""From trailers on the yard to the allocation input and its upload."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldtide.operators import allocation as al
from fieldtide.session import stored


def allocation_tables(
    trailers: DataFrame, arrivals: DataFrame, plan: DataFrame, allocated: DataFrame, requests: DataFrame,
    events: DataFrame, skus: DataFrame, allocs: DataFrame, parameters: DataFrame, inventory: DataFrame,
    as_of: str, since: str,
) -> DataFrame:
    """The allocation input of a day.

    The lines on the yard feed both supply and expected quantity; they are a small part of the
    trailers and are stored, so the joins behind them run once. So are the expected quantities: and only their SKUs
    and stores are taken from the tables that hold all of them.
    """
    lines = stored(al.yard_lines(trailers, arrivals, requests, events), "yard-lines")
    supply = al.yard_supply(trailers, arrivals, plan, allocated, requests, events, skus, as_of, lines)
    virtual = stored(al.virtual_allocations(allocs, requests, skus, trailers, arrivals, events, since, lines), "virtual")
    stores = al.stores_of(virtual)
    confirmed = al.confirmed_allocations(allocs, requests, skus, since, stores)
    parameters, inventory = (al.of_items(df, stores, "str_nbr") for df in (parameters, inventory))
    return al.allocation_input(virtual, supply, confirmed, parameters, inventory, as_of)
