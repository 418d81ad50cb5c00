"""Frames that a query reads several times are written first: what its steps get is read back, not derived from the table again."""

import pytest

from conftest import SF_SMALL
from hotbeat.plans import catalog, hotspots


class Reached(Exception):
    pass


@pytest.mark.parametrize("query,where,step", [
    (catalog.flagship_patrol_plan, hotspots, "find_hotspots"),
    (catalog.m14_kprototypes, catalog.km, "kprototypes"),
    (catalog.m14_kprototypes_check, catalog.km, "default_gamma"),
    (catalog.l10_cluster_feature, catalog.dbs, "dbscan"),
    (lambda spark, sf: catalog.cluster_model(spark, catalog.enr(spark, sf).withColumn("cluster", catalog.F.lit(0))), catalog.sp, "stratified_split"),
    (lambda spark, sf: catalog.cluster_model(spark, catalog.enr(spark, sf).withColumn("cluster", catalog.F.lit(0))), catalog, "with_dummies"),
    (catalog.labelled, catalog.sp, "stratified_split"),
    (catalog.labelled, catalog.sp, "stratified_folds"),
    (catalog.m8_dbscan_mixed_features, catalog.dbs, "dbscan_features"),
])
def test_steps_read_written_rows(spark, monkeypatch, query, where, step):
    def reached(df, *args, **more):
        raise Reached(df._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(where, step, reached)
    with pytest.raises(Reached) as got:
        query(spark, SF_SMALL)
    assert "ExistingRDD" in str(got.value) and "FileScan" not in str(got.value)
