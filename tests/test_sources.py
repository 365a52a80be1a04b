"""Streamed file hashes, the as-of lookup by a window, and the entry without its optional parts."""

import datetime
import hashlib
import os
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfline.operators import joins
from shelfline.sources import files, hashes


def test_file_larger_than_its_block_by_a_thousand(spark, tmp_path):
    big = os.urandom(1 << 20)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "big.bin").write_bytes(big)
    (tmp_path / "empty.bin").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(b"x")
    got = {r.relative_path: r for r in hashes.file_hashes(spark, str(tmp_path), "*.bin", block=1000).collect()}
    assert set(got) == {"sub/big.bin", "empty.bin"}
    assert got["sub/big.bin"].sha256 == hashlib.sha256(big).hexdigest() and got["sub/big.bin"].size_bytes == len(big)
    assert got["empty.bin"].sha256 == hashlib.sha256(b"").hexdigest()
    assert [r.sha256 for r in hashes.file_hashes(spark, f"file://{tmp_path}", "other.txt").collect()] == [hashlib.sha256(b"x").hexdigest()]
    assert all(r.sha256 is None for r in hashes.file_hashes(spark, str(tmp_path), hashed=False).collect())
    assert hashes.file_hashes(spark, str(tmp_path), "*.none").count() == 0
    assert files.build_manifest(spark, str(tmp_path)).count() == 3


def test_a_reader_holds_one_block(monkeypatch):
    reader = hashes.HashReader({"path": "/any", "blockBytes": "10"})
    asked = []

    class Stream:
        left = 95

        def read(self, n):
            asked.append(n)
            n = min(n, self.left)
            self.left -= n
            return b"y" * n

        __enter__ = lambda self: self
        __exit__ = lambda self, *a: None

    class System:
        def open_input_stream(self, path, buffer_size):
            return Stream()

    monkeypatch.setattr(hashes, "opened", lambda p: (System(), p))
    (row,) = reader.read(hashes.Files([("/any/f", "f", 95)]))
    assert row[4] == hashlib.sha256(b"y" * 95).hexdigest() and set(asked) == {10}


@pytest.mark.parametrize("days", [1, 7, 92])
def test_latest_version_is_that_of_the_range_join(spark, days):
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
    dim = spark.createDataFrame(
        [(1, day(0), day(10), "a"), (1, day(10), day(11), "b"), (1, day(20), datetime.date(9999, 12, 31), "c"), (2, day(5), day(400), "d"), (None, day(0), day(9), "n"), (4, day(900), day(901), "e")],
        "k int, effective_from date, effective_to date, v string")
    fact = spark.createDataFrame([(k, day(n) if n is not None else None, i) for i, (k, n) in enumerate([(k, n) for k in (1, 2, 3, None) for n in (-3, 0, 9, 10, 11, 15, 20, 21, 300, None)] + [(1, 10)] * 3)], "k int, d date, _at int")
    want = Counter(tuple(r) for r in joins.asof_dim(fact, dim, "k", F.col("d")).select("k", "d", "_at", "v").collect())
    got = joins.asof_window(fact, dim, "k", F.col("d"), days)
    assert Counter(tuple(r) for r in got.select("k", "d", "_at", "v").collect()) == want
    assert joins.asof_window(fact.limit(0), dim, "k", F.col("d")).count() == 0
    assert joins.asof_window(fact, dim.limit(0), "k", F.col("d")).filter("v IS NOT NULL").count() == 0


def test_lookup_by_window_shuffles_once(spark):
    dim = spark.range(10).selectExpr("id AS k", "date'2024-01-01' AS effective_from", "date'2025-01-01' AS effective_to", "'x' AS v")
    plan = joins.asof_window(spark.range(10).selectExpr("id AS k", "date'2024-02-01' AS d"), dim, "k", F.col("d"))._jdf.queryExecution().explainString(__import__("pyspark").SparkContext._active_spark_context._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert plan.count("Exchange hashpartitioning") == 1


def test_entry_without_its_optional_parts():
    """A subpackage that cannot be imported, as with a missing library, leaves the other queries."""
    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); "
            "assert 'flagship_store_stockouts' in q and not [n for n in q if n.startswith('op') and n[2].isdigit()] and 'pipeline' not in q; e.oracle_sql()")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True).returncode == 0
