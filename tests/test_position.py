import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from series_tables import frame, hours

from tidecast.operators import position, windows
from tidecast.operators.position import Order


def two_series(n=900):
    rng = np.random.default_rng(1)
    parts = []
    for name, m in (("a", n), ("b", n // 3)):
        y = rng.normal(50, 10, m)
        y[rng.integers(0, m, m // 20)] = np.nan
        parts.append(pd.DataFrame({"k": name, "time": hours(m), "y": y}))
    return pd.concat(parts, ignore_index=True)


@pytest.mark.parametrize("partitions", [1, 4, 37])
@pytest.mark.parametrize("bucket", [3600 * 5, 86_400 * 7, None])
def test_position_matches_sorted_order(spark, partitions, bucket):
    pdf = two_series()
    df = frame(spark, pdf, partitions)
    out = position.with_position(df, Order("time", ("k",), bucket_seconds=bucket), "pos", "n").toPandas()
    out = out.sort_values(["k", "time"])
    assert (out.pos.to_numpy() == out.groupby("k").cumcount().to_numpy()).all()
    assert (out.n == out.groupby("k").time.transform("size")).all()


@pytest.mark.parametrize("block", [7, 64, 10_000])
@pytest.mark.parametrize("bucket", [3600, 86_400, None])
def test_blocks_keep_every_row_once_and_whole_frames(spark, block, bucket):
    pdf = two_series()
    order = Order("time", ("k",), bucket_seconds=bucket)
    before, after = 5, 3

    def build(rows, w, whole):
        return rows.withColumn("n", F.count(F.lit(1)).over(w.rowsBetween(-before, after)))

    out = position.framed(frame(spark, pdf), order, before, after, build, block).toPandas().sort_values(["k", "time"])
    assert len(out) == len(pdf)
    pos = out.groupby("k").cumcount()
    size = out.groupby("k").time.transform("size")
    want = np.minimum(pos, before) + np.minimum(size - 1 - pos, after) + 1
    assert (out.n.to_numpy() == want.to_numpy()).all()


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(position, "BUCKET_BITS", 5)


def test_buckets_by_place(spark, small_buckets):
    """Dense times, ties, null keys and null times: every row once, in order, in buckets of bounded size."""
    n = 5000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.lit("a")).alias("k"), F.col("id").cast("double").alias("y"),
        F.when(F.col("id") >= 10, F.timestamp_seconds(F.floor(F.col("id") / 4))).alias("time")).repartition(7)
    order = Order("time", ("k",), ("y",))
    sizes = position.bucketed(df, order).groupBy("k", "_bucket").count().toPandas()["count"]
    assert sizes.sum() == n and sizes.max() <= 32
    out = position.with_position(df, order, "pos", "n").toPandas().sort_values("y")
    for _, g in out.groupby("k", dropna=False):
        assert g.pos.tolist() == list(range(len(g))) and (g.n == len(g)).all()
    assert len(out) == n
    frames = position.framed(df, order, 3, 2, lambda rows, w, _: rows.withColumn("n", F.sum("y").over(w.rowsBetween(-3, 2))), 64)
    frames = frames.toPandas().sort_values("y")
    assert len(frames) == n
    for _, g in frames.groupby("k", dropna=False):
        y = np.concatenate([[0] * 3, g.y, [0] * 2])
        assert g.n.tolist() == [y[i:i + 6].sum() for i in range(len(g))]
    held = windows.split_holdout(df, order, 0.2).toPandas()
    assert len(held) == n and held.is_holdout.sum() == sum(int(np.ceil(len(g) * 0.2)) for _, g in out.groupby("k", dropna=False))
    nulls = df.withColumn("y", F.when(F.col("y") % 50 == 0, F.col("y"))).withColumn("t", F.col("time"))
    assert windows.backfill(nulls, ["y"], Order("time", ("k",))).count() == n


def test_one_dense_series_makes_bounded_blocks(spark):
    n = 600_000
    df = spark.range(n).select(F.timestamp_seconds("id").alias("time"), F.col("id").cast("double").alias("y"))
    blocks, parts = position.halo_blocks(df, Order("time"), 10, 0)
    sizes = blocks.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_home").cast("int")).alias("home")).toPandas()
    assert sizes.home.sum() == n and sizes.n.max() <= position.BLOCK_ROWS + 3 * position.BUCKET_ROWS


@pytest.mark.parametrize("fraction", [0.1, 0.37])
def test_holdout_is_the_last_rows(spark, fraction):
    pdf = two_series(500)
    out = windows.split_holdout(frame(spark, pdf), Order("time", ("k",), bucket_seconds=86_400), fraction).toPandas()
    for _, g in out.sort_values("time").groupby("k"):
        held = int(np.ceil(len(g) * fraction))
        assert g.is_holdout.to_numpy().tolist() == [False] * (len(g) - held) + [True] * held


def test_folds_expand_and_never_look_ahead(spark):
    pdf = two_series(505)
    k = 5
    out = windows.expanding_folds(frame(spark, pdf), Order("time", ("k",), bucket_seconds=40_000), k).toPandas()
    for _, g in out.sort_values("time").groupby("k"):
        size = len(g) // (k + 1)
        want = [0] * (len(g) - k * size) + [f for f in range(1, k + 1) for _ in range(size)]
        assert g.segment.to_numpy().tolist() == want


def reference_outliers(y, n, z):
    known = y[~np.isnan(y)]
    flags = np.zeros(len(known), bool)
    h = n // 2
    for i in range(h, len(known) - h):
        w = known[i - h:i + h + 1]
        if w.std() > 0 and abs(known[i] - w.mean()) / w.std() >= z:
            flags[i] = True
    out = np.zeros(len(y), bool)
    out[~np.isnan(y)] = flags
    return out


@pytest.mark.parametrize("block", [60, 333, 50_000])
def test_outliers_match_row_by_row(spark, block):
    pdf = two_series(800)
    rng = np.random.default_rng(5)
    spots = rng.integers(0, len(pdf), 30)
    pdf.loc[spots, "y"] = 50 + rng.choice([-1, 1], 30) * 10_000.0
    pdf.loc[100:240, "y"] = 42.0
    out = windows.detect_outliers(frame(spark, pdf), "y", Order("time", ("k",), bucket_seconds=20 * 3600), n=50,
                                  block_rows=block).toPandas()
    assert len(out) == len(pdf)
    for _, g in out.sort_values("time").groupby("k"):
        assert (g.is_outlier.to_numpy() == reference_outliers(g.y.to_numpy(), 50, 3.290526731491926)).all()


def test_low_side_only(spark):
    pdf = pd.DataFrame({"time": hours(100), "y": np.tile([9.0, 11.0], 50)})
    pdf.loc[40, "y"], pdf.loc[60, "y"] = -500.0, 500.0
    out = windows.detect_outliers(frame(spark, pdf), "y", Order("time"), n=20, p=0.01, side="low").toPandas()
    assert out[out.is_outlier].time.tolist() == [pdf.time[40]]


@pytest.mark.parametrize("w", [24, 300])
@pytest.mark.parametrize("block", [400, 100_000])
def test_trailing_statistics(spark, w, block):
    pdf = two_series(1000)
    pdf["y"] = pdf.y.where(~pdf.index.isin(range(0, 2000)), pdf.y.fillna(3.0))
    pdf.loc[500, "y"] = np.nan
    out = windows.trailing_mse(frame(spark, pdf), "y", w, Order("time", ("k",)), block).toPandas()
    for name, g in pdf.groupby("k"):
        got = out[out.k == name].set_index("time")
        mean = g.set_index("time").y.rolling(w).mean()
        known = mean[mean.notna()]
        mse = ((known - g.set_index("time").y[known.index]) ** 2).rolling(w).mean()
        np.testing.assert_allclose(got.trailing_mean.sort_index(), known, rtol=1e-9)
        np.testing.assert_allclose(got.trailing_mse.sort_index(), mse, rtol=1e-9)


def test_trailing_mean_small_case(spark):
    pdf = pd.DataFrame({"time": hours(5), "y": [1.0, np.nan, 3.0, 4.0, 5.0]})
    out = windows.trailing_mean(frame(spark, pdf), "y", 2, Order("time")).orderBy("time").toPandas()
    assert out.trailing_mean.isna().tolist() == [True, True, True, False, False]
    assert out.trailing_mean.tolist()[3:] == [3.5, 4.5]


@pytest.mark.parametrize("bucket", [7 * 3600, None])
def test_backfill_crosses_buckets(spark, bucket):
    pdf = two_series(400)
    pdf.loc[50:130, "y"] = np.nan
    pdf.loc[395:399, "y"] = np.nan
    out = windows.backfill(frame(spark, pdf), ["y"], Order("time", ("k",), bucket_seconds=bucket)).toPandas()
    for name, g in pdf.groupby("k"):
        got = out[out.k == name].sort_values("time").y.to_numpy()
        np.testing.assert_array_equal(got, g.y.bfill().to_numpy())


def test_sequence_windows_count_and_content(spark):
    pdf = pd.DataFrame({"time": hours(60), "y": np.arange(60.0), "x": np.arange(60.0) * 2})
    out = windows.sequence_windows(frame(spark, pdf), ["y", "x"], "y", 10, 4, Order("time", bucket_seconds=5 * 3600),
                                   block_rows=16).orderBy("time").collect()
    assert len(out) == 60 - (10 + 4 - 1)
    for i, r in enumerate(out):
        assert [v[0] for v in r.inputs] == list(map(float, range(i, i + 10)))
        assert r.target == i + 10 + 4 - 1


@pytest.mark.parametrize("bits", [3, 14])
def test_running_counts(spark, monkeypatch, bits):
    monkeypatch.setattr(position, "BUCKET_BITS", bits)
    rng = np.random.default_rng(2)
    v = np.unique(rng.lognormal(0, 3, 500))
    pdf = pd.DataFrame({"k": np.where(np.arange(len(v)) % 3 == 0, "a", "b"), "v": v, "n": rng.integers(1, 9, len(v))})
    out = position.running_counts(frame(spark, pdf), ["k"], "v", "n").toPandas().sort_values("v")
    want = out.groupby("k").n.cumsum() - out.n
    assert (out.before == want).all()


@pytest.mark.parametrize("total", [1, 2, 3, 97, 1000, 1024])
def test_partner_is_a_shuffle(spark, total):
    rows = spark.range(total).select(F.col("id"), position.partner(F.col("id"), F.lit(total), 5).alias("to"),
                                     position.partner(F.col("id"), F.lit(total), 6).alias("other")).toPandas()
    assert sorted(rows.to) == sorted(rows.other) == list(range(total))
    if total > 90:
        away = np.abs(rows.to - rows.id)
        assert (away == 0).mean() < 0.05 and 0.28 < away.mean() / total < 0.39  # a third of the length for a random shuffle
        assert abs(np.corrcoef(rows.to, rows.id)[0, 1]) < 0.25 and abs(np.corrcoef(rows.to[1:], rows.to[:-1])[0, 1]) < 0.25
        assert (rows.to != rows.other).mean() > 0.9


def test_one_index_for_a_chain(spark, monkeypatch):
    """Operators on the rows of an index give what they give alone, and sort and store nothing themselves."""
    monkeypatch.setattr(position, "BUCKET_BITS", 4)
    pdf = two_series(300)
    df, order = frame(spark, pdf), Order("time", ("k",))
    column = [c for c in pdf.columns if c not in ("time", "k")][0]
    steps = [lambda d, o: position.with_position(d, o, "pos", "total"), lambda d, o: windows.split_holdout(d, o, 0.25),
             lambda d, o: windows.trailing_mean(d, column, 20, o, "mean", block_rows=60), lambda d, o: windows.with_lags(d, [column], 2, o, block_rows=60),
             lambda d, o: windows.expanding_folds(d, o, 3), lambda d, o: windows.backfill(d, [column], o),
             lambda d, o: windows.detect_outliers(d, column, o, n=30, block_rows=60)]
    alone = df
    for step in steps:
        alone = step(alone, order)
    stored, indexed = position.order_index(df, order)
    written = []
    monkeypatch.setattr(position, "write_scratch", lambda *a: written.append(a) or pytest.fail("an operator stored rows"))
    for step in steps:
        stored = step(stored, indexed)
    got, want = (d.orderBy("k", "time").toPandas() for d in (stored.drop("_bucket"), alone))
    pd.testing.assert_frame_equal(got[want.columns], want)
    some = position.with_position(stored.filter("pos % 3 = 0").drop("pos", "total"), position.filtered(indexed)).toPandas()
    assert sorted(some[some.k == some.k[0]].pos) == list(range((some.k == some.k[0]).sum()))
    with pytest.raises(ValueError):
        position.with_position(stored.drop("_bucket"), indexed)


def test_fit_bucket_narrows_until_small(spark):
    pdf = two_series(900)
    order = Order("time", ("k",))
    assert position.fit_bucket(frame(spark, pdf), order, 800).bucket_seconds == 30 * 86_400
    assert position.fit_bucket(frame(spark, pdf), order, 30).bucket_seconds == 86_400


def test_head_and_tail_per_series(spark):
    pdf = two_series(200)
    order = Order("time", ("k",), bucket_seconds=50_000)
    for fn, pick in ((windows.tail, lambda g: g.tail(70)), (windows.head, lambda g: g.head(70))):
        out = fn(frame(spark, pdf), 70, order).toPandas().sort_values(["k", "time"])
        want = pdf.sort_values(["k", "time"]).groupby("k", group_keys=False)[["k", "time"]].apply(pick)
        assert out.time.tolist() == want.time.tolist()
