from __future__ import annotations

import shutil

import pyarrow.parquet as pq

from checks import DATA, TABLES
from martwright.plans.queries import inputs_for, run
from martwright.session import shared_folder


def _copy(folder):
    folder.mkdir()
    for table in TABLES:
        shutil.copyfile(f"{DATA}/sf0.001/{table}.parquet", f"{folder}/{table}.parquet")
    return str(folder)


def test_star_is_built_once_and_again_after_changes(spark, tmp_path):
    folder = _copy(tmp_path / "data")
    first = inputs_for(spark, folder)
    before = run("dq_cascade_delete", spark, folder).collect()
    assert inputs_for(spark, folder) is first and first.star is first.star

    # A published star that somebody swept away is built anew.
    shutil.rmtree(f"{shared_folder(spark)}/martwright/{first.identity}")
    assert sorted(run("dq_cascade_delete", spark, folder).collect()) == sorted(before)

    # Half of the lines are gone: the next query must see it.
    path = f"{folder}/lineitem.parquet"
    table = pq.read_table(path)
    pq.write_table(table.slice(0, table.num_rows // 2), path)
    after = run("dq_cascade_delete", spark, folder).collect()
    assert sum(r.lines for r in after) < sum(r.lines for r in before)
    assert inputs_for(spark, folder) is not first
