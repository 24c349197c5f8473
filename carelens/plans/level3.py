"""Level 3 of a review: suspect linkages and cross tabs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from carelens.operators import compare, linkage
from carelens.operators import flags as fl
from carelens.sources.tables import Tables

FLAG_KEYS = ["flagid", "message", "flag_descr", "flag_type", "abort_yn"]


def masters(mil: DataFrame) -> Tables:
    """Flagged linkages counted by message, and the two cross tabs."""
    found = linkage.birth_type_linkage(mil).select(*FLAG_KEYS).unionByName(linkage.linkage_gaps(mil, []))
    return {
        "all_l3_flags_mstr": fl.count_messages(found),
        "l3_mil_aggregate": linkage.cross_tab(linkage.linkage_columns(mil), linkage.ALL_CLASSES),
        "l3_mil_aggregate_deliv": linkage.cross_tab(
            linkage.delivery_columns(mil), linkage.DELIVERY_CLASSES
        ),
    }


def results(written: Tables) -> Tables:
    """Flag counts over the written master."""
    return {"all_l3_flags": fl.roll_up([written["all_l3_flags_mstr"]])}


def sign_off(new: DataFrame, old: DataFrame) -> DataFrame:
    """Flag counts against those of the previous load."""
    return compare.load_comparison(new, old)
