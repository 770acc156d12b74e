"""The quality rules and their SQL on rows where a bound lies above its floor."""

import pytest

from basketry.llm import rules
from basketry.llm.oracle import SQL


def test_group_above_the_floor_inside_one_bucket(spark):
    """60 equal texts with 300 symbols per 1000 words, beside ordinary ones and one that is beyond."""
    duckdb = pytest.importorskip("duckdb")
    plain = " ".join(f"word{k}" for k in range(100))
    odd = " ".join(f"w{k}#" if k < 30 else f"w{k}" for k in range(100))
    worse = " ".join(f"w{k}##" if k < 90 else f"w{k}" for k in range(100))
    rows = [(i, odd, "en", "copies", 0) for i in range(60)] + [(60, worse, "en", "copies", 0)]
    rows += [(100 + i, plain + f" end{i}.", "en", "prose", 0) for i in range(60)] + [(200, odd, "en", "prose", 0), (201, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(map(tuple, rules.digest(df).collect()))
    kept = {r[0] for r in got if r[-1]}
    assert kept == set(range(60)) | set(range(100, 160))
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    sql = con.execute(SQL["op6_quality_rules"])
    names = [c[0] for c in sql.description]
    assert names == rules.digest(df).columns
    assert sorted(sql.fetchall()) == got
