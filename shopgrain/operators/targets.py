"""Unified monthly targets: stores, telesales and marketplaces."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as words
from ..functions.clean import money, trimmed, whole
from ..sources.contract import contract_columns


def fact_target(stores: DataFrame, telesales: DataFrame, marketplaces: DataFrame) -> DataFrame:
    """One row per store, for telesales, and per platform, each by month.

    The key is the first day of the month; it is cast strictly, as a target
    without a readable month is an error in the source.
    """
    c = F.col
    per_store = {
        "DateKey": c("Datekey").cast("int"),
        "StoreID": c("StoreId"),
        "StoreName": trimmed(c("StoreName")),
        "RegionName": trimmed(c("Region")),
        "StoreType": trimmed(c("StoreType")),
        "AM_Name": trimmed(c("AM")),
        "Channel": words.CHANNEL["store"],
        "ChannelGroup": words.CHANNEL_GROUP["store"],
        "TargetRevenue": c("Target"),
    }
    for_telesales = {
        "DateKey": c("DateKey").cast("int"),
        "StoreName": words.TARGET_TELESALES_NAME,
        "Channel": words.CHANNEL["telesales"],
        "ChannelGroup": words.CHANNEL_GROUP["telesales"],
        "TargetRevenue": c("Target"),
        "TargetAOV": money(c("AOV")),
        "TargetOrders": whole(c("Orders")),
        "TargetItems": whole(c("Items")),
    }
    per_platform = {
        "DateKey": c("DateKey").cast("int"),
        "StoreName": c("Platform"),
        "Platform": c("Platform"),
        "Channel": words.TARGET_ECOM_CHANNEL,
        "ChannelGroup": words.TARGET_ECOM_CHANNEL,
        "TargetRevenue": c("TargetGMV"),
    }
    branches = [(stores, per_store), (telesales, for_telesales), (marketplaces, per_platform)]
    return reduce(
        DataFrame.unionByName,
        [frame.select(*contract_columns("fact_target", values)) for frame, values in branches],
    )
