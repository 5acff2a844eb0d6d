import re

import pytest

from tillframe import __main__ as command_line


@pytest.fixture
def call(spark, tmp_path, capsys):
    def run(*argv):
        args = command_line.parse([*argv, "--data", str(tmp_path)])
        command_line.COMMANDS[args.command](spark, args)
        return capsys.readouterr().out

    return run


def test_shop_commands(call, tmp_path):
    with pytest.raises(FileNotFoundError, match="orders.parquet"):
        call("analyze")
    out = call("generate", "--customers", "50", "--products", "20", "--orders", "400", "--as-of", "2024-01-01")
    assert "TOTAL" in out and "user1@example.com" in out
    shown = call("analyze", "--top", "3")
    assert "monthly_growth_pct" in shown and not (tmp_path / "processed").exists()
    saved = call("analyze", "--top", "3", "--save")
    assert (tmp_path / "processed" / "top_customers.parquet" / "_SUCCESS").exists()
    assert shown.split("+\noperation")[0][:500] == saved.split("+\noperation")[0][:500]
    assert "true" in call("compare")


def test_store_commands(call, tmp_path):
    call("generate", "--kind", "store", "--customers", "30", "--products", "20", "--orders", "100")
    assert (tmp_path / "raw" / "order_items.csv").exists()
    assert "segment" in call("report")
    assert len(list((tmp_path / "processed").glob("*.csv"))) == 6


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_formats_are_honoured(call, tmp_path, fmt):
    sizes = ("--customers", "20", "--products", "10", "--orders", "60", "--format", fmt)
    out = call("generate", "--kind", "store", *sizes)
    assert "size_bytes" in out and "last_modified" in out and (tmp_path / "raw" / f"orders.{fmt}").exists()
    assert "segment" in call("report", "--format", fmt)
    other = "csv" if fmt == "parquet" else "orc"
    call("generate", "--customers", "20", "--products", "10", "--orders", "60", "--format", other)
    assert "monthly_growth_pct" in call("analyze", "--format", other) and "true" in call("compare", "--format", other)


def test_no_customers_are_no_customers(call):
    out = call("generate", "--customers", "0", "--products", "5", "--orders", "10")
    assert re.search(r"\|customers *\|0 ", out) and re.search(r"\|products *\|5 ", out)


def test_formats(call):
    out = call("formats", "--rows", "1000")
    assert "PARQUET" in out and "file_size_mb" in out
