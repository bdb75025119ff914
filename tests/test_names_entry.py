"""Select items of one name, quoted placeholders, and the entry without its optional folders."""

import os
import shutil
import subprocess
import sys
from collections import Counter

import pytest

from conftest import ROOT
from parity.operators import checks


@pytest.mark.parametrize("items", ["k, v + 1, v - 1", "k, v, v", "k, v + 1, V + 1, v"])
def test_items_of_one_name(spark, golden, items):
    src, dst = golden
    res = checks.content(spark, src, dst, "k = k", items, items, key_fields="k")
    plain = checks.content(spark, src, dst, "k = k", "k, v", "k, v", key_fields="k")
    assert len(set(map(str.lower, res.comparison.rows().columns))) == len(res.comparison.rows().columns)

    def statuses(r):
        return Counter(tuple(x) for x in r.comparison.summary().collect())
    assert statuses(res) == statuses(plain)
    assert res.verdict.first() == plain.verdict.first()
    assert sorted(res.keys.collect()) == sorted(plain.keys.collect())
    assert res.rows.count() == plain.rows.count()
    assert spark.sql(res.description.replace("<DataFrame>", "VALUES (1, 2) AS t(k, v)")).columns == [
        c for c in res.comparison.rows().columns if c.endswith("_src")] + [
        c for c in res.comparison.rows().columns if c.endswith("_dest")]


def test_a_key_field_is_never_an_expression_named_like_it(spark):
    src = spark.createDataFrame([(1, 5, "real"), (2, 6, "other")], "k int, v int, v_1 string")
    dst = spark.createDataFrame([(1, 5, "real"), (2, 7, "other")], "k int, v int, v_1 string")
    res = checks.content(spark, src, dst, "k = k", "v + 1", "v + 1", key_fields="v_1")
    assert [r[0] for r in res.keys.collect()] == ["v_1='other'"]


def test_quoted_placeholder_is_text(spark, golden):
    src, dst = golden
    res = checks.volume(spark, src, dst, "n <> 'x = ?' AND k = ?", "n <> 'x = ?'", params={"k": 5})
    assert tuple(res.verdict.first())[:3] == (2, 4, "NOK")


def test_entry_without_the_optional_folders(tmp_path):
    repo = tmp_path / "repo"
    shutil.copytree(ROOT, repo, ignore=shutil.ignore_patterns(".git", "*.md", "*.json"))
    code = "import __spark_entry__ as E; q = E.queries(); print(len(q), 'pipeline' in q, 'op1_quality_lines' in E.oracle_sql())"

    def run():
        out = subprocess.run([sys.executable, "-c", code], cwd=repo, capture_output=True, text=True, timeout=300,
                             env={**os.environ, "PYTHONPATH": ""})
        return out.stdout.split(), out.stderr
    full, _ = run()
    for f in (repo / "parity" / "llm").glob("*.py"):
        f.unlink()                                      # __pycache__ stays, as after a delete of tracked files
    left, err = run()
    assert left and int(left[0]) < int(full[0]) and left[1:] == ["False", "False"], err
    shutil.rmtree(repo / "parity" / "llm")
    (repo / "corpus_pipeline.py").unlink()
    assert run()[0] == left
