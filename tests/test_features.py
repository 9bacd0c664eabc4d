"""Feature step semantics on hand rows and the model path."""

import datetime as dt

import pytest

from panelkit.operators import features as FE
from panelkit.schema import snapshot_schema

D = dt.date
PRODUCTS = ["ind_1m_a", "ind_1m_b"]


def _rows(spark):
    base = {c.name: None for c in snapshot_schema().fields if not c.name.startswith("ind_1m_")}
    recs = []
    for i, (inc, ct, g, seg) in enumerate([
            (100.0, "1", "H", "01 - TOP"), (0.0, "P", "V", "02 - PARTICULARES"),
            (-5.0, "1.0", None, None), (None, "3", "H", "03 - UNIVERSITARIO")]):
        r = dict(base)
        r.update(fetch_date=D(2016, 1, 28), id=i, registration_date=D(2015, 11, 2), age=" 40",
                 tenure_months="   2", income=inc, client_type_1m=ct, gender=g,
                 client_segment=seg, ind_new_client=1.0, client_relationship_status=1.0,
                 ind_client_activity=1.0, province_code=28.0, entry_channel="KAT",
                 client_activity_1m="A", ind_foreigner="N", ind_deceased="N",
                 ind_1m_a=i % 2, ind_1m_b=None)
        recs.append(r)
    fields = [f for f in snapshot_schema().fields if not f.name.startswith("ind_1m_")]
    from pyspark.sql import types as T
    schema = T.StructType(fields + [T.StructField(p, T.IntegerType()) for p in PRODUCTS])
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in recs], schema)


def test_process_frame_semantics(spark):
    out = {r.id: r for r in FE.process_frame(_rows(spark), PRODUCTS, 7.0).collect()}
    assert abs(out[0].income - 4.605170185988092) < 1e-12      # ln(100)
    assert out[1].income == 7.0 and out[2].income == 7.0       # ln(0), ln(<0) -> NULL -> median (X3)
    assert out[3].income == 7.0                                # NULL -> median
    assert out[1].client_type_1m == 0                          # 'P' parsed first -> 0 (X5)
    assert out[2].client_type_1m == 1                          # '1.0' -> 1
    assert out[2].gender == "V" and out[2].client_segment == 0.0
    assert out[0].tenure_months == 2 and out[0].number_of_products == 0
    assert "id" in out[0].asDict() and "registration_date" not in out[0].asDict()


def test_map_p_to_5_option(spark):
    out = {r.id: r for r in FE.process_frame(_rows(spark), PRODUCTS, 7.0, map_p_to_5=True).collect()}
    assert out[1].client_type_1m == 5


def test_encoder_constant_column_and_unseen(spark):
    rows = _rows(spark)
    fitted = FE.FeatureEncoder(PRODUCTS).fit(rows)
    t = fitted.transform(rows).collect()
    assert all(r.fetch_month == 0.0 for r in t)               # constant column -> 0 (X8)
    unseen = rows.withColumn("gender", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("X"))
    u = fitted.transform(unseen).collect()
    assert all(r.gender_V == 0.0 for r in u)                   # unseen -> all zeros
    with pytest.raises(Exception):
        fitted.transform(unseen, unknown="error").collect()    # X9 'error' option


def test_feature_names_follow_assembly(spark):
    fitted = FE.FeatureEncoder(PRODUCTS).fit(_rows(spark))
    names = fitted.feature_names
    assert names[:6] == ["age", "tenure_months", "income", "fetch_year", "fetch_month",
                         "number_of_products"]
    assert "gender_V" in names and "entry_channel_freq" in names
    a = fitted.assemble(fitted.transform(_rows(spark))).first()
    assert len(a.features) == len(names)


def test_trees_have_the_depth_of_the_reference():
    import inspect

    from panelkit.operators import model
    d = inspect.signature(model.fit_product_model).parameters
    assert (d["max_iter"].default, d["max_depth"].default) == (100, 6)


def test_fit_layout_small_frames_in_few_partitions():
    from panelkit.operators.model import ROWS_PER_PARTITION, fit_layout
    # five fits share the slots of a small frame; a large one is cut in whole waves, two fits at once
    assert fit_layout(100_000, 5, 12) == (3, 5)
    assert fit_layout(100_000, 5, 12, 4) == (3, 4)
    partitions, at_once = fit_layout(28 * ROWS_PER_PARTITION, 5, 12)
    assert partitions == 36 and at_once == 2
    assert fit_layout(0, 1, 1) == (1, 2)


def test_fits_read_a_written_frame(spark, sf_small, monkeypatch):
    """The frame that boosting reads has the written table behind it, not the whole preparation."""
    from panelkit.operators import model as MD
    from panelkit.plans.q_model import OP, TARGETS, labelled_split
    train, _ = labelled_split(spark, sf_small)
    plans, fit = [], MD.GBTClassifier.fit

    def seen(self, data, *more):
        plans.append(data._jdf.queryExecution().analyzed().toString())
        return fit(self, data, *more)

    monkeypatch.setattr(MD.GBTClassifier, "fit", seen)
    model = MD.fit_product_model(train, OP, TARGETS, max_iter=1, max_depth=2)
    assert len(plans) == len(model.targets) > 0
    assert all("Relation" in p and "Window" not in p and "Join" not in p for p in plans)
