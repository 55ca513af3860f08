"""Plans that stay cheap on large tables: what is generated is compiled, and rows are shuffled once."""

import re

import pytest

from pactframe.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
JIT_LIMIT = 8000  # bytes of a method that the JVM still compiles


def largest_method(df, capsys) -> int:
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    limit = df.sparkSession.conf.get("spark.sql.codegen.hugeMethodLimit")
    df.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")  # as a session without settings of its own
    try:
        capsys.readouterr()
        df.select("*").explain("codegen")
        return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)))
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        df.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", limit)


@pytest.mark.parametrize("name", ["rule_extract", "priced_lines", "line_flags"])
def test_line_rules_are_compiled(spark, capsys, name):
    assert largest_method(QUERIES[name](spark, SF), capsys) < JIT_LIMIT


@pytest.mark.parametrize("name", ["pack_results", "unpack_results"])
def test_products_are_dealt_by_affair_once(spark, capsys, name):
    """Two exchanges for either join and none behind them: the windows and the packing find the rows dealt by affair."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        capsys.readouterr()
        QUERIES[name](spark, SF).explain()
        assert capsys.readouterr().out.count("Exchange hashpartitioning") == 4
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
