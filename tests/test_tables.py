"""The order-line tables as lines."""

import re

from cartonwise.sources.tables import read_lines


def test_large_joins_shuffle_no_names_of_small_tables(spark, capsys):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read_lines(spark, "/root/testdata/sf0.001").explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffled = dict((key, columns) for columns, key in re.findall(
        r"Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\((l_orderkey|l_partkey)", capsys.readouterr().out))
    assert set(shuffled) == {"l_orderkey", "l_partkey"}
    assert not any(name in columns for columns in shuffled.values() for name in ("s_name", "n_name", "r_name"))
    assert "p_name" not in shuffled["l_orderkey"]
