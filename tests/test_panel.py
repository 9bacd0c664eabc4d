"""Panel windows and filters on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from panelkit.operators import panel as P

D = dt.date


def _panel(spark, rows):
    return spark.createDataFrame(rows, "id long, fetch_date date, a int, b int")


def test_labels_use_period_order_not_file_order(spark):
    # Rows out of order in the input; the label follows the period order.
    rows = [(1, D(2015, 3, 28), 1, 0), (1, D(2015, 1, 28), 0, 0), (1, D(2015, 2, 28), 0, 1)]
    out = P.build_labels(_panel(spark, rows), ["a", "b"]).orderBy("fetch_date").collect()
    assert [(r.fetch_date, r.target__a, r.target__b) for r in out] == [
        (D(2015, 1, 28), 0, 1), (D(2015, 2, 28), 1, 0)]


def test_next_row_ignores_missing_month(spark):
    # The next row is the next period present, even across a gap.
    rows = [(1, D(2015, 1, 28), 0, 0), (1, D(2015, 4, 28), 1, 0)]
    out = P.build_labels(_panel(spark, rows), ["a", "b"]).collect()
    assert len(out) == 1 and out[0].target__a == 1


def test_single_row_client_and_null_value(spark):
    rows = [(1, D(2015, 1, 28), 0, 0), (2, D(2015, 1, 28), None, 0), (2, D(2015, 2, 28), 1, 1)]
    out = {r.id: r for r in P.build_labels(_panel(spark, rows), ["a", "b"]).collect()}
    assert 1 not in out                      # one row: nothing to label (W04)
    assert out[2].target__a == 0             # NULL now compares as 0 (pandas semantics)
    assert out[2].target__b == 1


def test_drop_inactive_both_forms_agree(spark):
    rows = [(1, D(2015, 1, 28), 0, 0), (1, D(2015, 2, 28), 0, 0), (1, D(2015, 3, 28), 0, 0),
            (2, D(2015, 1, 28), 0, 0), (2, D(2015, 2, 28), 1, 0), (2, D(2015, 3, 28), 1, 0)]
    lab = P.build_labels(_panel(spark, rows), ["a", "b"])
    t = ["target__a", "target__b"]
    w = P.drop_clients_without_acquisition(lab, t, use_window=True)
    j = P.drop_clients_without_acquisition(lab, t, use_window=False)
    assert sorted(w.select("id", "fetch_date").collect()) == sorted(j.select("id", "fetch_date").collect())
    assert {r.id for r in w.collect()} == {2}


def test_exactly_ten_nulls_is_dropped(spark):
    # X11: the code keeps rows with fewer than 10 NULLs.
    cols = [f"c{i}" for i in range(12)]
    schema = ", ".join(f"{c} int" for c in cols)
    rows = [tuple([None] * 10 + [1, 1]), tuple([None] * 9 + [1, 1, 1])]
    df = spark.createDataFrame(rows, schema)
    assert P.keep_few_nulls(df, 10).count() == 1


def test_transition_counts_add_up(spark, sf_small):
    # Invariant: the four transition counts sum to the comparable cells (no NULLs here).
    from panelkit.operators import profile as A
    from panelkit.sources import standins as S
    op = S.order_panel(spark, sf_small)
    t = P.transition_table(op, S.ORDER_PRODUCTS).agg(F.sum("n")).first()[0]
    c = A.comparable_cells(op, S.ORDER_PRODUCTS).first()[0]
    assert t == c


def test_downsample_is_repeatable_and_keeps_active(spark, sf_small):
    from panelkit.sources import standins as S
    op = S.order_panel(spark, sf_small)
    a = P.downsample_inactive(op, ["ind_1m_large"], 0.2, 42)
    b = P.downsample_inactive(op, ["ind_1m_large"], 0.2, 42)
    assert sorted(a.collect()) == sorted(b.collect())
    active = op.groupBy("id").agg(F.max("ind_1m_large").alias("m")).where("m > 0")
    kept = a.select("id").distinct()
    assert active.join(kept, "id", "left_anti").count() == 0


def test_train_test_disjoint(spark, sf_small):
    from panelkit.sources import standins as S
    train, test = P.label_and_split(S.order_panel(spark, sf_small), S.ORDER_PRODUCTS,
                                    S.ORDER_SPLIT_DATE)
    k = ["id", "fetch_date"]
    assert train.select(*k).join(test.select(*k), k).count() == 0


def test_strict_next_month_option(spark):
    rows = [(1, D(2015, 1, 28), 0, 0), (1, D(2015, 4, 28), 1, 0), (1, D(2015, 5, 28), 0, 1)]
    loose = {r.fetch_date: r for r in P.build_labels(_panel(spark, rows), ["a", "b"]).collect()}
    strict = {r.fetch_date: r for r in P.build_labels(_panel(spark, rows), ["a", "b"],
                                                      next_period="month").collect()}
    assert loose[D(2015, 1, 28)].target__a == 1 and strict[D(2015, 1, 28)].target__a == 0
    assert strict[D(2015, 4, 28)].target__b == 1


def test_csv_positional_rename_keeps_padding(spark, tmp_path):
    from pyspark.sql import types as T

    from panelkit.sources import io as IO
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("age", T.StringType()),
                           T.StructField("fetch_date", T.DateType())])
    df = spark.createDataFrame([(1, " 64", D(2016, 4, 28)), (2, " NA", None)], schema)
    path = str(tmp_path / "csv")
    IO.write_csv(df, path, ["ncodpers", "age", "fecha_dato"])
    back = IO.read_csv_typed(spark, path, schema)
    assert back.columns == ["id", "age", "fetch_date"]
    assert sorted(back.collect()) == sorted(df.collect())


def test_float_written_products_read_as_int(spark, tmp_path):
    from panelkit import schema
    from panelkit.sources import io as IO
    header = ",".join(src for src, _ in schema.SOURCE_TO_NAME)
    vals = ["2016-04-28", "464063", "N", "ES", "H", " 64", "2004-03-15", "0", "    145", "1",
            "", "1.0", "A", "S", "N", "", "KAB", "N", "1", "50", "ZARAGOZA", "1", "217094.52",
            "02 - PARTICULARES"] + ["0"] * 21 + ["1.0", "0.0", "1"]
    path = tmp_path / "raw.csv"
    path.write_text(header + "\n" + ",".join(vals) + "\n")
    t = IO.csv_to_parquet(spark, str(path), str(tmp_path / "pq"), schema.snapshot_schema(raw=True),
                          post=schema.cast_products)
    r = t.first()
    assert r.ind_1m_salary_acc == 1 and r.ind_1m_pension_obligation_account == 0
    assert r.ind_1m_debit_account == 1 and r.age == " 64" and r.tenure_months == "    145"
    assert dict(t.dtypes)["ind_1m_salary_acc"] == "int"
