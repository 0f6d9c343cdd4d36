import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from duck import same

from tessera import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, name):
    same(catalog.QUERIES[name](spark, SF), catalog.ORACLES[name], SF)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_without_the_training_data_subpackage(tmp_path):
    """A copy of the tree without the llm folders still gives queries and SQL, with the pipeline's file and without."""
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json", "*.md"))
    code = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); assert set(s) <= set(q); assert 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q); print(len(q))"
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
        assert done.returncode == 0 and int(done.stdout) == len(catalog.QUERIES), done.stderr
        (tmp_path / "r" / "corpus_pipeline.py").unlink(missing_ok=True)
