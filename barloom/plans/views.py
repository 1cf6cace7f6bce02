"""Market tables derived from the supplied star-schema tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.session import exists, work_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Trades: one per line item, the stock being a group of suppliers."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        F.floor(F.col("l_suppkey") / 20.0).alias("code"),
        F.to_date("l_shipdate").alias("data_date"),
        price.alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.struct(
            "l_orderkey", "l_linenumber", "l_partkey", price.alias("price"), "l_quantity"
        ).alias("trade"),
    )


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars. First and last trade are minimum and maximum, so each task combines
    its trades before the shuffle, and a stock with very many trades sends few rows."""
    grouped = ticks(spark, folder).groupBy("code", "data_date").agg(
        F.min("trade").alias("first"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max("trade").alias("last"),
        F.sum("quantity").cast("bigint").alias("volume"),
    )
    return grouped.select(
        F.col("code").cast("string").alias("stock_code"),
        "data_date",
        F.col("first.price").alias("open_price"),
        "high_price",
        "low_price",
        F.col("last.price").alias("close_price"),
        "volume",
    )


def state_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of files below a path, and a hash of their paths, lengths and times; the files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    spread = F.pmod(F.xxhash64("path", "length", "modificationTime"), F.lit(1 << 40))
    row = files.select("path", "length", "modificationTime").agg(F.count("*"), F.coalesce(F.sum(spread), F.lit(0))).first()
    return row[0], row[1]


@dataclass(frozen=True)
class StoredBars:
    """Where the bars of a folder are stored, and the state of its trades they were made from."""

    state: tuple[int, int]
    path: str


_STORED: dict[tuple[str, str], StoredBars] = {}


def stored_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars as a stored price table, for work that reads them more than once.

    Without it every pass would aggregate the trades again. A session stores the bars of a
    folder once for each state of its files: trades that were replaced give new bars.
    """
    key = (spark.sparkContext.applicationId, folder)
    state = state_of(spark, f"{folder}/lineitem.parquet")
    known = _STORED.get(key)
    if known is None or known.state != state or not exists(spark, known.path):
        path = work_folder(spark, "stock_price")
        bars(spark, folder).write.parquet(path)
        _STORED[key] = StoredBars(state, path)
    return spark.read.parquet(_STORED[key].path)


def forget_stored_bars() -> None:
    """The next reader of any folder stores its bars anew."""
    _STORED.clear()


def signed_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Events as signed share counts."""
    sign = F.when(F.col("event_id") % 3 == 0, -1).otherwise(1)
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("stock_code"),
        F.to_date("ts").alias("data_date"),
        "event_type",
        (F.round(F.col("value") * 100).cast("bigint") * sign).alias("amount"),
    )


_FLOW_EVENTS = {
    "view": "foreign_investor_vol_amount",
    "signup": "foreign_investor_dealer_vol_amount",
    "purchase": "investment_trust_vol_amount",
    "error": "dealer_vol_amount",
    "click": "dealer_hedge_vol_amount",
}


def flows(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.col("amount")
    return signed_flows(spark, folder).groupBy("stock_code", "data_date").agg(
        *[
            F.sum(F.when(F.col("event_type") == event, amount).otherwise(0)).alias(name)
            for event, name in _FLOW_EVENTS.items()
        ],
        F.sum(amount).alias("institutional_investors_vol_amount"),
    )


def securities(spark: SparkSession, folder: str) -> DataFrame:
    """Versioned security master: one version per order of a customer."""
    customer, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    key = F.col("c_custkey")
    capital = F.round(F.abs(F.col("c_acctbal") * 1000)).cast("bigint")
    return customer.join(orders, key == F.col("o_custkey")).select(
        key.cast("string").alias("stock_code"),
        F.col("c_name").alias("company_name_ch"),
        F.col("c_mktsegment").alias("industry"),
        F.when(key % 50 == 0, F.lit(0)).otherwise(capital).cast("bigint").alias("company_capital"),
        F.when(key % 2 == 0, "TWSE").otherwise("OTC").alias("stock_class"),
        F.col("o_orderstatus").alias("stock_status"),
        F.to_date("o_orderdate").alias("update_date"),
    )


def holidays(spark: SparkSession, folder: str) -> DataFrame:
    """Holidays of one day and more, some of them overlapping over New Year, some inverted."""
    n, name = F.col("n_nationkey").cast("int"), F.col("n_name")

    def day(year: Column | int, month: int, day: int) -> Column:
        return F.make_date(F.lit(year) if isinstance(year, int) else year, F.lit(month), F.lit(day))

    def holiday(kind: str, start: Column, end: Column) -> Column:
        named = F.concat(F.lit(kind), name)
        return F.struct(named.alias("holiday_name"), start.alias("holiday_start"), end.alias("holiday_end"))

    first, odd = day(1995, 1, 2), day(1992, 3, 5)
    usual = holiday("", F.date_add(first, n * 97), F.date_add(first, n * 97 + n % 5))
    late = F.when(n < 7, holiday("late ", day(n + 1992, 12, 30), day(n + 1993, 1, 2)))
    new = F.when(n < 7, holiday("new ", day(n + 1993, 1, 1), day(n + 1993, 1, 3)))
    inverted = F.when(n % 3 == 0, holiday("odd ", F.date_add(odd, n * 89), F.date_add(odd, n * 89 - 3)))
    rows = F.explode(F.array(usual, late, new, inverted)).alias("h")
    return table(spark, folder, "nation").select(rows).where("h IS NOT NULL").select("h.*")


def revenue(spark: SparkSession, folder: str) -> DataFrame:
    month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("k"), month.alias("ym"))
        .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("gross_revenue"))
        .select(F.col("k").cast("string").alias("stock_code"), "ym", "gross_revenue")
    )


def quotes_of(events: DataFrame) -> DataFrame:
    """Events, stored or streaming, as raw quotes with missing markers."""
    value, event = F.col("value").cast("string"), F.col("event_id").cast("string")
    return events.select(
        F.col("user_id").cast("string").alias("c"),
        "ts",
        F.when(F.col("event_type") == "error", "-").otherwise(value).alias("z"),
        F.concat(value, F.lit("_"), event, F.lit("_")).alias("b"),
        F.when(F.col("event_type") == "signup", "-").otherwise(event).alias("v"),
    )


def quotes(spark: SparkSession, folder: str) -> DataFrame:
    return quotes_of(table(spark, folder, "events"))


#: a sign of its own for each plain letter
LETTER_SIGNS = ("abcdefghijklmnopqrstuvwxyz", "日月火水木金土山川田人口手目耳心石竹米糸羊舟虫見言車")


def han_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Articles in Han signs without spaces: one sign per letter, other marks as they are."""
    text = F.translate(F.lower(F.replace(F.col("text"), F.lit(" "), F.lit(""))), *LETTER_SIGNS)
    return table(spark, folder, "documents").select("doc_id", text.alias("text"))
