"""Registered source queries on small tables with keys and gaps that the given tables do not have."""

import duckdb
import pytest

from targetlens.plans import source_queries as sq


@pytest.fixture
def check(spark, tmp_path):
    """Writes tables of SQL texts and returns the rows of a query after comparing them with its SQL."""
    def run(name, **tables):
        db = duckdb.connect()
        for table, text in tables.items():
            path = tmp_path / f"{table}.parquet"
            db.execute(f"COPY ({text}) TO '{path}' (FORMAT parquet)")
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
        df = sq.QUERIES[name](spark, str(tmp_path))
        got = sorted(map(tuple, df.collect()), key=repr)
        columns = ", ".join(f'"{c}"' for c in df.columns)
        assert got == sorted(db.execute(f"SELECT {columns} FROM ({sq.ORACLES[name]})").fetchall(), key=repr)
        return got

    return run


def line_items(*rows):
    fields = ("l_orderkey::BIGINT AS l_orderkey, l_partkey::BIGINT AS l_partkey, l_suppkey::BIGINT AS l_suppkey, "
              "l_linenumber::INTEGER AS l_linenumber, l_quantity::DOUBLE AS l_quantity, l_returnflag, l_linestatus, "
              "0.05::DOUBLE AS l_discount, 0.02::DOUBLE AS l_tax")
    names = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus"
    return f"SELECT {fields} FROM (VALUES {', '.join(map(repr, rows))}) t({names})"


def test_best_mode_with_part_keys_over_a_million(check):
    rows = [(1, 2_500_000, 1, 1, 10, "A", "F"), (1, 3, 1, 2, 10, "A", "F"), (2, 5 * 10 ** 14, 1, 1, 4, "A", "F"), (2, 1, 1, 7, 4, "R", "F")]
    assert check("best_mode", lineitem=line_items(*rows)) == [(1, 1, -2.0), (2, 1, -0.8)]


def test_clinical_join_with_a_customer_without_orders(check):
    got = check(
        "clinical_join", customer="SELECT unnest([1, 2, 3])::BIGINT AS c_custkey",
        orders="SELECT unnest([1, 1, 3])::BIGINT AS o_custkey, unnest(['F', 'O', 'O']) AS o_orderstatus")
    assert [(row[-2], row[-1]) for row in got if "C-2" in row] == [(None, 0.0)]


def test_hetero_groups_of_two_atoms(check):
    rows = [(1, 1, 3, 1, 1, "R", "O"), (1, 2, 6, 2, 1, "R", "O"), (2, 1, 1, 1, 1, "R", "O"), (3, 1, 1, 1, 1, "A", "O"), (3, 1, 1, 2, 1, "A", "O")]
    assert len(check("scan_hetero_groups", lineitem=line_items(*rows))) == 1


def test_barcode_keys_are_not_broadcast(spark, monkeypatch):
    from targetlens.sources import parsers as ps

    plans = []
    monkeypatch.setattr(ps, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or df)
    cells = spark.range(40).selectExpr("concat('AC', id, '-1_x') AS cell", "'S' AS sample")
    found = ps.barcode_match_join(cells, spark.range(0, 40, 2).selectExpr("concat('AC', id, '-1') AS barcode")).collect()
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
    assert len(found) == 20 and all(r.cell == f"{r.barcode}_x" and r.strategy == 2 for r in found)


def test_a_name_is_cleaned_once(spark):
    from pyspark.sql import functions as F

    from targetlens.functions.columns import safe_name

    rows = [("..a b__", ), ("._", ), (None, ), ("x" * 81, ), ("_" * 90, ), ("a" + "_" * 200 + "b", )]
    df = spark.createDataFrame(rows, "t string").select("t", safe_name("t", F.lit("doc")).alias("n"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    got = [r.n for r in df.collect()]
    assert got[:3] == ["a_b", "doc", "doc"] and got[4] == "doc" and [len(n) for n in (got[3], got[5])] == [80, 80]


def test_first_lines_of_matrix_files_are_a_table_of_their_own(spark, monkeypatch):
    from targetlens.sources import parsers as ps

    kept, keep = [], ps.cut_lineage
    monkeypatch.setattr(ps, "cut_lineage", lambda df: kept.append(df.columns) or keep(df))
    lines = spark.createDataFrame([("f", 1, "%%x"), ("f", 2, "1 1 1"), ("f", 3, "1 1 7")], "file string, line_no long, value string")
    names = spark.createDataFrame([("f", 1, "a")], "file string, pos long, name string")
    assert [tuple(r) for r in ps.scan_mtx(lines, names, names).collect()] == [("f", "a", "a", 7.0)]
    assert kept == [["file", "_head"]]
