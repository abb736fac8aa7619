"""Raw retail tables, with planted defects, derived from order/lineitem star-schema tables.

Defects are chosen by key arithmetic, so any scale and any engine derives the
same rows. Used to exercise the rules; nothing here is part of the pipeline.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import MONEY, RAW

# The day that counts as today for these tables.
AS_OF = "2025-01-01"


def _hits(key: str, modulus: int, *rests: int) -> Column:
    return (F.col(key) % modulus).isin(*rests)


def _id(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _money(value: Column | float) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(MONEY)


def _times(copies: Column) -> Column:
    """1 .. copies, one output row each, from a single scan of the source."""
    return F.explode(F.sequence(F.lit(1), copies))


def customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    country = (
        F.when(_hits("c_custkey", 89, 11), "")
        .when(F.col("n_name") == "NATION_0", "USA")
        .when(F.col("n_name") == "NATION_1", "UK")
        .otherwise(F.col("n_name"))
    )
    email = (
        F.when(_hits("c_custkey", 89, 23), "no mail at all")
        .when(_hits("c_custkey", 89, 37), F.lit(None))
        .otherwise(
            F.concat(
                F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com")
            )
        )
    )
    rows = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        F.when(_hits("c_custkey", 89, 53), "")
        .otherwise(_id("C", "c_custkey"))
        .alias("customer_id"),
        F.when(_hits("c_custkey", 89, 71), "").otherwise(F.col("c_name")).alias("name"),
        email.alias("email"),
        F.date_add(
            F.lit("2023-07-01").cast("date"), (F.col("c_custkey") % 430).cast("int")
        ).alias("signup_date"),
        country.alias("country"),
        _times(F.when(_hits("c_custkey", 89, 5, 29), 2).otherwise(1)).alias("copy"),
    )
    return rows.drop("copy")


def products(part: DataFrame) -> DataFrame:
    return part.select(
        _id("P", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(_hits("p_partkey", 41, 9), "").otherwise(F.col("p_type")).alias("category"),
        F.when(_hits("p_partkey", 41, 3), _money(-7.25))
        .when(_hits("p_partkey", 41, 17), _money(F.lit(None)))
        .otherwise(_money(F.col("p_retailprice")))
        .alias("price"),
        F.when(_hits("p_partkey", 41, 26), -3)
        .otherwise(F.col("p_size"))
        .cast("int")
        .alias("stock"),
    )


def orders(source: DataFrame) -> DataFrame:
    status = (
        F.when(_hits("o_orderkey", 190, 31), F.lit(None))
        .when(F.col("o_orderstatus") == "F", "Delivered")
        .when(F.col("o_orderstatus") == "P", "Cancelled")
        .when(_hits("o_orderkey", 2, 0), "Shipped")
        .otherwise("Processing")
    )
    return source.select(
        F.when(_hits("o_orderkey", 4900, 4801), "")
        .otherwise(_id("O", "o_orderkey"))
        .alias("order_id"),
        F.when(_hits("o_orderkey", 190, 77), F.lit(None))
        .otherwise(_id("C", "o_custkey"))
        .alias("customer_id"),
        F.when(_hits("o_orderkey", 190, 13), "2024-06-31")
        .when(_hits("o_orderkey", 190, 149), "2031-05-09")
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("order_date"),
        status.alias("status"),
        _money(F.col("o_totalprice")).alias("total_amount"),
    )


def order_items(lineitem: DataFrame) -> DataFrame:
    missing_id = _hits("l_orderkey", 930, 607) & (F.col("l_linenumber") == 1)
    no_quantity = (F.col("l_orderkey") + F.col("l_linenumber")) % 470 == 19
    return lineitem.select(
        F.when(missing_id, "")
        .otherwise(F.concat(_id("OI", "l_orderkey"), _id("-", "l_linenumber")))
        .alias("order_item_id"),
        _id("O", "l_orderkey").alias("order_id"),
        _id("P", "l_partkey").alias("product_id"),
        F.when(no_quantity, 0).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.when(_hits("l_partkey", 41, 3), _money(-7.25))
        .when(_hits("l_orderkey", 640, 11), _money(F.lit(None)))
        .otherwise(_money(F.col("l_extendedprice")))
        .alias("price"),
    )


def payments(source: DataFrame) -> DataFrame:
    """One payment per order, and a second one for every ninth order."""
    methods = F.array(*[F.lit(m) for m in ("card", "wallet", "cash", "voucher")])
    parts = source.select(
        "o_orderkey",
        "o_totalprice",
        _times(F.when(_hits("o_orderkey", 9, 4), 2).otherwise(1)).alias("part"),
    )
    second = F.col("part") == 2
    return parts.select(
        F.when(second, _id("B", "o_orderkey"))
        .when(_hits("o_orderkey", 870, 215), "")
        .otherwise(_id("A", "o_orderkey"))
        .alias("payment_id"),
        _id("O", "o_orderkey").alias("order_id"),
        F.when(second, "wallet")
        .otherwise(F.element_at(methods, (F.col("o_orderkey") % 4 + 1).cast("int")))
        .alias("payment_method"),
        F.when(second, _money(6.45))
        .when(_hits("o_orderkey", 190, 43), _money(-12.5))
        .when(_hits("o_orderkey", 190, 88), _money(0.0))
        .when(_hits("o_orderkey", 190, 121), _money(F.lit(None)))
        .otherwise(_money(F.col("o_totalprice")))
        .alias("amount"),
    )


class RetailTables(Mapping):
    """The five raw tables over a folder of star-schema Parquet, each planned when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._build = {
            "customers": (customers, "customer", "nation"),
            "products": (products, "part"),
            "orders": (orders, "orders"),
            "order_items": (order_items, "lineitem"),
            "payments": (payments, "orders"),
        }

    def _source(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")

    def __getitem__(self, table: str) -> DataFrame:
        build, *sources = self._build[table]
        return build(*map(self._source, sources)).select(*RAW[table].fieldNames())

    def __iter__(self):
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)
