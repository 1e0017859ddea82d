"""Stored tables outlive a cleared shared folder, and the shared folder is the one that the session names."""

import os
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest

from spendgrid.plans.catalog import run, warehouse
from spendgrid.plans.warehouse import _BUILT
from spendgrid.session import shared_folder
from spendgrid.sources.tables import bucketed_name, delete, files_of


def rows(spark, name, folder):
    return sorted(map(str, run(name, spark, folder).collect()))


def test_tables_that_have_gone_are_built_again(spark, folder, tmp_path):
    os.symlink(folder, tmp_path / "in")
    folder = str(tmp_path / "in")
    w = warehouse(spark, folder)
    names = ("customer_category_spend", "category_affinity")
    before = [rows(spark, name, folder) for name in names]
    paths = {name: _BUILT[w._slot(name)][0] for name in ("transactions", *names)}
    for path in paths.values():
        delete(spark, path)
    assert [rows(spark, name, folder) for name in names] == before
    assert w.measures("customer_category_spend")["row_count"] == len(before[0])
    spark.sql(f"DROP TABLE {bucketed_name(paths['customer_category_spend'])}")  # the files stay
    assert rows(spark, names[0], folder) == before[0]


def test_tables_whose_files_have_gone_in_part_are_built_again(spark, folder, tmp_path):
    os.symlink(folder, tmp_path / "in")
    folder = str(tmp_path / "in")
    names = ("category_affinity", "churn_rules", "cluster_summary", "clv_training_set")
    before = [rows(spark, name, folder) for name in names]
    base = warehouse(spark, folder)._base
    stored = [kept[0] for slot, kept in _BUILT.items() if slot[1] == base and slot[2] == "fixed"]
    for path in stored:  # the folders and their first files stay
        for file, _, _ in files_of(spark, path)[1:] or files_of(spark, path):
            delete(spark, file)
    assert [rows(spark, name, folder) for name in names] == before


def test_queries_of_one_session_run_at_the_same_time(spark, folder, tmp_path):
    os.symlink(folder, tmp_path / "in")
    names = ("cohort_retention", "churn_rules", "category_affinity", "churn_risk", "clv_training_set", "behavioral_summary")
    with ThreadPoolExecutor(len(names)) as threads:
        at_once = list(threads.map(lambda name: rows(spark, name, str(tmp_path / "in")), names))
    assert at_once == [rows(spark, name, folder) for name in names]


def test_sessions_with_one_application_id_write_to_folders_of_their_own(tmp_path):
    code = (
        "from types import SimpleNamespace as S; from spendgrid.plans import warehouse as w; w.state_of = lambda *_: ();"
        f"s = S(conf={{'spark.checkpoint.dir': '{tmp_path}'}}, sparkContext=S(master='local', applicationId='app-20261202000000-0000'));"
        "print(w.Warehouse(s, 'in', None)._base, w.Warehouse(s, 'in', None)._base)"
    )
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = [subprocess.run([sys.executable, "-c", code], cwd=top, capture_output=True, text=True, check=True).stdout.split() for _ in range(2)]
    assert [len(set(x)) for x in said] == [1, 1] and said[0] != said[1]


@pytest.mark.parametrize("named", ["file:///mnt/shared/", "/mnt/shared", "hdfs://x/y"])
def test_the_checkpoint_folder_of_a_cluster_is_used(named):
    context = SimpleNamespace(master="spark://host:7077")
    assert shared_folder(SimpleNamespace(conf={"spark.checkpoint.dir": named}, sparkContext=context)) == named.rstrip("/")
    with pytest.raises(ValueError):
        shared_folder(SimpleNamespace(conf={}, sparkContext=context))
