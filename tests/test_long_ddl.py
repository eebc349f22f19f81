"""DDL targets are read from the whole statement."""

from pyspark.sql import functions as F
from tidelog.functions.text import ddl_targets


def test_long_statements(spark):
    names = [f"table_{k}" for k in range(20_000)]
    cases = [
        "DROP TABLE " + ", ".join(names),
        "RENAME TABLE " + ", ".join(f"{n} TO x.`{n}``n`" for n in names),
        "/* " + "note " * 4000 + "*/ " + "/* b */ " * 3000 + "ALTER TABLE t ADD x INT",
        "CREATE TABLE `" + "``" * 20_000 + "` (a INT)",
        "INSERT INTO t VALUES " + "(1), " * 20_000,
    ]
    df = spark.createDataFrame(list(enumerate(cases)), "n int, q string")
    got = {r.n: [tuple(t) for t in r.t] for r in df.select("n", ddl_targets(F.col("q"), F.lit("def")).alias("t")).collect()}
    assert got[0] == [("def", n) for n in names]
    assert got[1] == [t for n in names for t in (("def", n), ("x", f"{n}`n"))]
    assert got[2] == [("def", "t")] and got[3] == [("def", "`" * 20_000)] and got[4] == []
