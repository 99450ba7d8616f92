"""Operators against brute force and by their properties."""

import random
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldtide.adapters import AS_OF_EVENTS, Tables
from fieldtide.functions import dates
from fieldtide.operators import allocation as al
from fieldtide.operators import calendar, clustering, falloff, features, joins, timeseries
from fieldtide.operators import comments as cm
from fieldtide.operators import text as tt
from fieldtide.operators.reviews import RawSentences, explode_reviews

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(5)
    # One key holds most rows on both sides.
    left = [(i, 1 if i % 3 else i, rng.randrange(0, 5000)) for i in range(150)]
    right = [(i, 1 if i % 4 else i, rng.randrange(0, 5000)) for i in range(150)]
    base = pd.Timestamp("2024-01-01")

    def frame(rows, names):
        pdf = pd.DataFrame([(i, k, base + pd.Timedelta(minutes=m)) for i, k, m in rows], columns=names)
        df = spark.createDataFrame(pdf)
        return df.withColumn(names[2], F.col(names[2]).cast("timestamp_ntz"))

    got = joins.interval_join(frame(left, ["a", "k", "t"]), frame(right, ["b", "rk", "rt"]), {"k": "rk"}, "t", "rt", -720, 60)
    want = set()
    for i, k, t in left:
        found = [j for j, rk, rt in right if rk == k and -720 <= rt - t <= 60]
        want |= {(i, j) for j in found} or {(i, None)}
    pairs = [tuple(r) for r in got.select("a", "b").collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_interval_join_keeps_left_rows_without_time(spark):
    left = spark.sql("select 1 k, cast(null as timestamp_ntz) t")
    right = spark.sql("select 1 rk, timestamp_ntz'2024-01-01 00:00:00' rt")
    assert joins.interval_join(left, right, {"k": "rk"}, "t", "rt", -5, 5).collect()[0]["rt"] is None


def test_between_join_lists_each_pair_once(spark):
    left = spark.sql("select 1 id, 7 k, date'2024-01-01' lo, date'2024-12-31' hi union all select 2, 7, date'2024-05-01', date'2024-04-01'")
    right = spark.sql("select explode(sequence(date'2023-12-01', date'2025-02-01', interval 9 day)) d, 7 rk")
    bounds = [dates.unit_index(F.col(c), "day") for c in ("lo", "hi", "d")]
    got = joins.between_join(left, right, {"k": "rk"}, *bounds, 32)
    want = right.where("d between date'2024-01-01' and date'2024-12-31'").count()
    assert got.count() == want == got.distinct().count()


def test_running_allocation(spark):
    data = [  # sku, rdc, store, rank, qty, wos, pack, limit
        (1, 1, 1, 1, 5.0, 0.0, 2, 12.0), (1, 1, 2, 2, 4.0, 1.0, 1, 12.0), (1, 1, 3, 2, 4.0, 1.0, 1, 12.0), (1, 1, 4, 3, 9.0, 3.0, 1, 12.0),
        (2, 1, 1, 3, 3.0, 3.0, 1, 3.0), (2, 1, 2, 3, 2.0, 3.0, 1, 3.0), (3, 1, 1, 3, 2.0, 3.0, 1, None), (4, 1, 1, 1, 2.0, 0.0, None, 9.0),
    ]
    df = spark.createDataFrame(data, "sku_nbr int, rdc_nbr int, loc_nbr int, store_rank int, virt_qty double, wos double, buy_uom_qty int, qty_to_alloc double")
    got = al.running_allocation(df)
    shares = {(r.sku_nbr, r.loc_nbr): r.included_qty for r in got.collect()}
    assert shares == {(1, 1): 5, (1, 2): 4, (1, 3): 3, (1, 4): -1, (2, 1): 3, (2, 2): 0, (3, 1): None, (4, 1): 2}
    kept = {(r.sku_nbr, r.loc_nbr): r.included_qty for r in al.allocation_trim(got).collect()}
    assert kept == {(1, 1): 3, (1, 2): 4, (1, 3): 3, (2, 1): 3}


def test_allocation_never_exceeds_its_limit(tables):
    from fieldtide.registry.allocation_queries import ranked

    shares = al.running_allocation(ranked(tables)).where("included_qty > 0")
    over = shares.groupBy("sku_nbr", "rdc_nbr", "qty_to_alloc").agg(F.sum("included_qty").alias("s")).where("s > qty_to_alloc")
    assert over.count() == 0


def test_merge_flags(spark):
    plan = spark.sql("""select * from values (date'2024-01-02', 'a', '1', 'Z'), (date'2024-01-02', 'b', '1', null),
        (date'2024-01-01', 'a', '1', 'Z') t(cal_dt, rdc_nbr, asn_nbr, execute)""")
    errors = spark.sql("select * from values ('a', '1'), ('a', '1') t(rdc_nbr, asn_nbr)")
    got = sorted((str(r.cal_dt), r.rdc_nbr, r.execute) for r in al.merge_flags(plan, errors, ["rdc_nbr", "asn_nbr"], "2024-01-02").collect())
    assert got == [("2024-01-01", "a", "Z"), ("2024-01-02", "a", "N"), ("2024-01-02", "b", "Y")]


def test_role_join_repeats_rows_for_several_people(spark):
    jobs = spark.sql("select 1L lead")
    assign = spark.sql("select '1' ja_lead, 'IM' ja_position, id ja_user from range(2)")
    users = spark.sql("select id user_no, 'F' first_nm, cast(id as string) last_nm from range(2)")
    got = joins.role_join(jobs, assign, users, {"ism_name": "IM", "isc_name": "PC"}, "lead").collect()
    assert sorted(r.ism_name for r in got) == ["F 0", "F 1"] and {r.isc_name for r in got} == {None}


def test_report_total_is_the_sum_of_its_regions(tables):
    from fieldtide.registry.falloff_queries import region_table

    rows = falloff.region_report(region_table(tables)).collect()
    total = [r for r in rows if r.location_level == "Grand Total"]
    regions = [r for r in rows if r.location_level == "Region"]
    assert len(total) == 1 and total[0].report_line == len(rows)
    assert total[0].bow_scheduled_jobs == sum(r.bow_scheduled_jobs for r in regions)


def test_report_levels_keep_a_region_without_name_apart(spark):
    cols = list(falloff.REPORT_SUMS)
    df = spark.createDataFrame([("d", None, *[1.0] * len(cols)), ("d", "r", *[1.0] * len(cols))],
                               "division string, region string, " + ", ".join(f"{c} double" for c in cols))
    got = sorted((r.location_level, str(r.location)) for r in falloff.report_levels(df).collect())
    assert got == [("Division", "d"), ("Grand Total", "Grand Total"), ("Region", "None"), ("Region", "r")]


def test_only_flagged_branches(tables):
    from fieldtide.registry.falloff_queries import branch_table

    branches = branch_table(tables)
    listed = falloff.branch_report(branches, only_flagged=True, n=5).where("location_level = 'Branch'")
    flagged = branches.where("branch_top5_falloff_pct_of_job_amt").select("division", "branch").distinct()
    assert listed.count() == flagged.count() > 0


def test_falloff_comments_by_type(spark, tables):
    cal = calendar.fiscal_calendar(spark, "2023-01-01", "2025-12-31")
    inputs = [tables.fx(n) for n in ("fx_audit", "fx_lead_dates", "fx_comments", "fx_history")]
    got = cm.falloff_comments(*inputs, cal, AS_OF_EVENTS)
    types = {r["type"]: r["count"] for r in got.groupBy("type").count().collect()}
    assert set(types) == {"Rescheduled", "Unscheduled", "Aged"} and sum(types.values()) == 122
    once = cm.falloff_comments(*inputs, cal, AS_OF_EVENTS, distinct_comments=True)
    assert once.count() == got.count()


def brute_match(query, sentences):
    """The similarity of every n-gram of every sentence."""
    best = []
    for sentence in sentences:
        words = sentence.split()
        n = min(len(query.split()), len(words))
        grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if n else []
        best.append(max([SequenceMatcher(None, g, query).ratio() for g in grams] or [0.0]))
    return int(np.argmax(best))


def test_match_sentences_equals_brute_force():
    rng = random.Random(11)
    vocabulary = ["fit", "door", "the", "very", "café", "rain", "a", "installed", "today", "late,", "crew."]
    for _ in range(150):
        raw = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 9))) for _ in range(rng.randrange(1, 7))]
        raw += rng.choices(raw, k=1)
        query = rng.choice([rng.choice(raw), " ".join(rng.choices(vocabulary, k=rng.randrange(1, 8)))]).replace("é", "")
        if query.split():
            assert RawSentences(raw).best_match(query) == brute_match(query, raw), (query, raw)


def test_explode_reviews_last_entry_wins(spark):
    schema = "omsid long, num_reviews long, reviews array<struct<Id: string, ReviewText: string>>"
    data = [(1, 3, [("a", "old"), ("a", "new"), ("b", None)]), (2, 0, [("c", "x")]), (3, 1, [("d", None)])]
    got = [tuple(r) for r in explode_reviews(spark.createDataFrame(data, schema)).collect()]
    assert got == [(1, "a", "new")]


def test_lemma_table(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "two geese  fly"), (2, ""), (3, None), (4, "hounds ran\u00a0away hounds"), (None, "geese")], "id int, t string")
    lemmas = spark.createDataFrame([("geese", "goose"), ("fly", "fly"), ("hounds", "hound"), ("hounds", "dog"), ("two", None), (None, "x")],
                                   "form string, lemma string")
    got = tt.lemmatize(texts, "t", lemmas, key="id")
    assert {r.id: r.lemmatized for r in got.collect()} == {
        1: "two goose fly", 2: "", 3: None, 4: "dog ran\u00a0away dog", None: "goose"}
    assert sorted(str(r.lemmatized) for r in tt.lemmatize(texts, "t", lemmas).collect()) == sorted(str(r.lemmatized) for r in got.collect())
    monkeypatch.setattr(tt, "SMALL_TABLE", 0)
    with pytest.raises(ValueError):
        tt.lemmatize(texts, "t", lemmas)


def test_nearest_centroid_of_many(spark):
    rng = np.random.default_rng(0)
    points, centers = rng.normal(0, 1, (50, 4)), rng.normal(0, 1, (1500, 4))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id int, embedding array<double>")
    means = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "label int, centroid array<double>")
    gap = np.sqrt(((points[:, None] - centers[None]) ** 2).sum(2))
    got = clustering.centroid_distance(df, means).orderBy("vec_id").collect()
    assert [r.cluster_id for r in got] == gap.argmin(1).tolist()
    assert np.allclose([r.center_dist for r in got], gap.min(1))


def test_cluster_ratio_far_from_the_origin(spark):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.1, (30, 2)) for c in (0, 1)])
    rows = [(i, i // 30, p.tolist(), (p + 1e7).tolist()) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id int, label int, near array<double>, far array<double>")
    near, far = (clustering.cluster_ch(df, vec=v).first()["ch"] for v in ("near", "far"))
    assert far == pytest.approx(near, rel=1e-4)


def test_mape_measures_zero_actuals_by_the_mean(spark):
    df = spark.createDataFrame([("a", 0.0, -4.0), ("a", 8.0, 6.0)], "series string, y double, yhat double")
    assert timeseries.mape(df, ["series"]).first()["mape"] == pytest.approx((4 / 4 + 2 / 8) / 2 * 100)


def test_best_params_first_setting_wins_ties(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, None), ("b", 1, float("nan")), ("b", 2, 7.0)],
                               "series string, param_id int, test_mape double")
    assert {r.series: r.param_id for r in timeseries.best_params(df).collect()} == {"a": 1, "b": 2}


def test_forecast_beats_the_value_of_last_year(spark):
    months = pd.date_range("2014-01-01", "2020-12-01", freq="MS")
    t = np.arange(len(months))
    y = 200 + 2.0 * t + 40 * np.sin(2 * np.pi * t / 12) + np.random.default_rng(3).normal(0, 3, len(t))
    history = spark.createDataFrame(pd.DataFrame({"series": "s", "ds": months.date, "y": y}))
    train = history.where("ds < date'2020-01-01'")
    got = timeseries.forecast_fit(train, history, timeseries.DEFAULT_GRID).toPandas()
    assert (got.yhat_lower <= got.yhat).all() and (got.yhat <= got.yhat_upper).all()
    naive = np.abs(y[-12:] - y[-24:-12]).mean()
    for _, one in got[pd.to_datetime(got.ds) >= "2020-01-01"].groupby("param_id"):
        assert np.abs(one.sort_values("ds").yhat.to_numpy() - y[-12:]).mean() < naive


def test_future_frame_starts_after_a_month_end(spark):
    df = spark.sql("select 's' series, date'2024-01-31' ds, 1 y")
    got = sorted(str(r.ds) for r in timeseries.future_frame(df, 2).collect())
    assert got == ["2024-01-31", "2024-02-29", "2024-03-31"]


def test_knee_of_a_known_curve(spark):
    # 1/x on 1..10: the elbow by the published method
    df = spark.createDataFrame([(i, 1.0 / i) for i in range(1, 11)], "k int, sse double")
    assert clustering.knee_point(df).first()["knee"] in (2, 3)
    line = spark.createDataFrame([(i, 10.0 - i) for i in range(1, 11)], "k int, sse double")
    assert clustering.knee_point(line).count() == 1


def test_kmeans_sweep_finds_separated_groups(spark):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.1, (40, 3)) for c in (0, 5, 10)])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id int, embedding array<double>")
    table, models = clustering.kmeans_sweep(df, [2, 3, 4], restarts=5, vec="embedding")
    rows = {r.k: r for r in table.collect()}
    assert rows[2].sse > rows[3].sse and max(rows.values(), key=lambda r: r.silhouette).k == 3
    assert models[3].centers.shape == (3, 3) and sorted(models[3].members) == [40, 40, 40]


def test_euclidean_silhouette_by_sample(tables):
    df = tables.table("embeddings")
    whole = clustering.silhouette_by_sample(df).first()
    rows = df.collect()
    x, at = np.array([r.embedding for r in rows], dtype=float), np.array([r.label for r in rows])
    gaps, out = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), []
    for i in range(len(x)):
        a = gaps[i, at == at[i]].sum() / ((at == at[i]).sum() - 1)
        b = min(gaps[i, at == j].mean() for j in set(at) - {at[i]})
        out.append((b - a) / max(a, b))
    assert whole.silhouette == pytest.approx(np.mean(out), abs=1e-9)
    part = clustering.silhouette_by_sample(df, sample=20).first()
    assert abs(part.silhouette - whole.silhouette) < 0.02 and part.error < 0.02


def test_centroids_in_blocks(tables, monkeypatch):
    df = tables.table("embeddings")
    means = clustering.cluster_means(df)
    whole = clustering.centroid_distance(df, means).select("vec_id", "cluster_id").collect()
    monkeypatch.setattr(clustering, "CENTERS", 3)
    assert sorted(clustering.centroid_distance(df, means).select("vec_id", "cluster_id").collect()) == sorted(whole)


def test_one_hot_unseen_category_gives_zeros(spark):
    train = spark.createDataFrame([("Red", 1), ("Blue", 3), ("Green", 2)], "color string, n int")
    valid = spark.createDataFrame([("Red", 1), ("Yellow", 3)], "color string, n int")
    got = features.one_hot(train, ["color", "n"]).transform(valid)
    assert got.columns[2:] == ["color_Blue", "color_Green", "color_Red", "n_1", "n_2", "n_3"]
    assert [tuple(r)[2:] for r in got.collect()] == [(0, 0, 1, 1, 0, 0), (0, 0, 0, 0, 0, 1)]
    vector = features.one_hot_vector(["color"]).fit(train).transform(valid).collect()
    assert [v.color_vec.toArray().tolist() for v in vector] == [[0, 0, 1], [0, 0, 0]]


def test_one_hot_keeps_every_category(spark):
    train = spark.createDataFrame([("A-B",), ("A_B",), ("a b",), ("C",)], "k string")
    got = {r.k: tuple(r)[1:] for r in features.one_hot(train, ["k"]).transform(train).collect()}
    assert sorted(sum(v) for v in got.values()) == [1, 1, 1, 1] and len(set(got.values())) == 4
    many = spark.range(0, 1200).select(F.col("id").cast("string").alias("k"))
    assert len(features.one_hot(many, ["k"]).names["k"]) == 1200


def test_appointment_detail_plans_inner_joins(tables):
    from fieldtide.registry.falloff_queries import appts

    plan = appts(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan


def test_pivot_limits_rows_before_the_shuffle(tables):
    plan = falloff.pivot_last_n(tables.fx("fx_comments"), "cmlead", "cmkey", "cmcomment", "last")
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_no_query_plans_a_cross_join(spark):
    from __spark_entry__ import queries

    for name in ("job_level_table", "region_report", "falloff_comments", "yard_supply", "boxcox_lambda", "interval_join", "cluster_ch"):
        plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_existence_by_one_key_equals_existence_by_all(spark):
    rng = random.Random(8)
    some = lambda n: rng.choice([None, *range(n)])
    df = spark.createDataFrame([(i, some(4), some(3), some(3)) for i in range(200)], "id int, k int, a int, b int")
    other = spark.createDataFrame([(some(4), some(3), some(3)) for _ in range(12)], "ok int, oa int, ob int")
    on = {"k": "ok", "a": "oa", "b": "ob"}
    ids = lambda rows: sorted(r.id for r in rows.select("id").collect())
    assert ids(joins.semi_join_by(df, other, "k", on)) == ids(joins.semi_join(df, other, on))
    assert ids(joins.anti_join_by(df, other, "k", on)) == ids(joins.anti_join(df, other, on))


def test_allocation_moves_lines_and_orders_once(spark, tables):
    from fieldtide.registry.allocation_queries import allocation_rows

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = allocation_rows(tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for key in ("l_orderkey", "o_orderkey"):
        assert f"hashpartitioning({key}" not in plan
    # Stock and parameters meet the wanted SKUs and stores before they are moved by item.
    assert plan.count("array_contains(_stores") == 3


def test_equal_sentences_are_not_compared_by_blocks(monkeypatch):
    monkeypatch.setattr(SequenceMatcher, "ratio", lambda self: pytest.fail("compared"))
    assert RawSentences(["one two, three.", "red green blue"]).best_match("red green blue") == 1
    long = "ab" * 150
    monkeypatch.undo()
    assert RawSentences(["zz", long]).best_match(long) == (1 if SequenceMatcher(None, long, long).ratio() else 0)
