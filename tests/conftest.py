import pytest

from tillframe.session import get_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests", "local[8]", 8,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    changed = {}

    def change(name, value):
        changed.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def shop(spark):
    """A small shop: three products, and orders that cover ties, nulls and strangers."""
    products = spark.createDataFrame(
        [(1, "A", 10.0), (2, "B", 2.5), (3, "B", 0.1)],
        "product_id bigint, category string, price double",
    )
    orders = spark.createDataFrame(
        [
            (1, 1, 1, 2, "2024-01-05 10:00:00"),
            (2, 2, 2, 8, "2024-01-20 11:00:00"),
            (None, 3, 3, 3, "2024-03-01 00:00:00"),
            (4, 3, 3, 4, "2024-03-02 00:00:00"),
            (5, 4, 9, 1, "2024-03-03 00:00:00"),
        ],
        "order_id bigint, customer_id bigint, product_id bigint, quantity int, order_date string",
    ).selectExpr("order_id", "customer_id", "product_id", "quantity",
                 "cast(order_date as timestamp_ntz) as order_date")
    return orders, products


def rows(df):
    return [tuple(row) for row in df.collect()]
