"""A stored layout in which the large joins and groupings find their rows already together.

Order lines are stored with the price of their product, bucketed and sorted by order, and
order headers are bucketed alike. A line is shuffled once, when it is written; from then on sums
per order, and their join with the headers, read matching buckets and shuffle nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillframe.operators.checks import require_columns
from tillframe.operators.hotkeys import HotKeys, salted_join
from tillframe.sources.files import scratch_path


@dataclass(frozen=True)
class SalesLayout:
    """Names of the two tables in the session's catalog."""

    lines: str
    headers: str
    buckets: int

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        return spark.table(self.lines), spark.table(self.headers)

    def drop(self, spark: SparkSession) -> None:
        """Forget the tables; their files stay where they were written."""
        for name in (self.lines, self.headers):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """Store rows in `buckets` buckets by `key`, each written by one task as one sorted file."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def write_sales_layout(orders: DataFrame, products: DataFrame, headers: DataFrame, name: str | None = None, buckets: int | None = None,
                       hot: HotKeys | None = None, path: str | None = None) -> SalesLayout:
    """Store the lines of known products with their price and category, and the headers, both bucketed by order.

    `hot`, from `hotkeys.hot_keys`, salts the one join with the products. Buckets default to the shuffle
    partitions; give about the stored bytes over 256 MB.
    """
    require_columns(orders, ["order_id", "product_id", "quantity"], "orders")
    require_columns(products, ["product_id", "price"], "products")
    require_columns(headers, ["order_id"], "headers")
    spark = orders.sparkSession
    name, path = name or f"sales_{uuid.uuid4().hex}", path or scratch_path(spark, "layout")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = products.select("product_id", *[x for x in ("price", "category") if x in products.columns])
    lines = orders.drop("price", "category")
    priced = salted_join(lines, known, hot) if hot else lines.join(known, "product_id")
    layout = SalesLayout(f"{name}_lines", f"{name}_headers", buckets)
    bucketed(priced, layout.lines, "order_id", buckets, f"{path}/lines")
    bucketed(headers, layout.headers, "order_id", buckets, f"{path}/headers")
    return layout
