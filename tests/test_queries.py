import pytest

from helpers import ROOT, same_as_sql
from weft import queries

NAMES = [n for n in queries.oracle_sql() if n in queries.QUERIES and not n.startswith("stream_")]
FAST = ["flows", "normalized_flows", "shift", "windows", "dispatch", "prorate", "keyed_conv_tos", "conv_tos_sum", "all_summaries", "index_names", "hosts_in_ranges",
        "sanitized_names", "series_filtered_hosts", "summary_json", "volume_conservation", "too_old_dropped", "missing_fields_count",
        "sample_index", "synthetic_flows", "simulated_flows"]


@pytest.mark.parametrize("name", FAST)
def test_same_as_sql(spark, name):
    same_as_sql(spark, name, queries.QUERIES[name], queries.oracle_sql()[name])


def test_every_query_is_named():
    assert set(queries.oracle_sql()) <= set(queries.QUERIES)
    assert set(queries.QUERIES) == set(queries.oracle_sql())


def test_entry_imports_without_the_training_data_package(tmp_path):
    import shutil
    import subprocess
    import sys

    shutil.copytree(f"{ROOT}/weft", tmp_path / "weft", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert int(said.stdout.split()[0]) == len(queries.QUERIES)
