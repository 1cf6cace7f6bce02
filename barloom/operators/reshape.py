"""Money reports: from one row per investor to one row per side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barloom import fixed_values as fv
from barloom.functions.labels import normalise_label, side_of_label


def money_report(report: DataFrame) -> DataFrame:
    """Turn ``stock_class, data_date, investor, <side columns…>`` by 90 degrees.

    Side columns carry their published labels; units and wordings of the two markets
    are brought in line. Investors are the fixed columns of the result.
    """
    keys = ["stock_class", "data_date", "investor"]
    sides = [name for name in report.columns if name not in keys]
    long = report.unpivot(keys, sides, "label", "amount").select(
        *keys, normalise_label(F.col("label")).alias("buy_sell_type_ch"), "amount"
    )
    wide = (
        long.groupBy("data_date", "stock_class", "buy_sell_type_ch")
        .pivot("investor", list(fv.MONEY_INVESTORS))
        .agg(F.sum("amount").cast("bigint"))
    )
    return wide.select(
        "data_date",
        "stock_class",
        side_of_label(F.col("buy_sell_type_ch")).alias("buy_sell_type"),
        "buy_sell_type_ch",
        *fv.MONEY_INVESTORS,
    )
