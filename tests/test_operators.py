import pytest
from pyspark.sql import functions as F

from feedback_engine.operators import dedup, filters, report, stages, upsert
from feedback_engine.operators.skew import salted_lookup
from tests.conftest import plan_of


def test_language_filter(spark):
    df = spark.createDataFrame([("zh-cn",), (None,), ("EN",)], "language string")
    kept = lambda keep, **k: {r[0] for r in filters.filter_language(df, keep, **k).collect()}
    assert kept({"zh"}) == {None}
    assert kept({"zh"}, primary_subtag=True) == {None, "zh-cn"}
    assert kept([" En ", ""]) == {None, "EN"}
    assert kept([" "]) == kept(None) == {"zh-cn", None, "EN"}
    assert filters.parse_language_list("en, zh,,") == ["en", "zh"]
    assert filters.parse_language_list(" ,") is None
    with pytest.raises(ValueError):
        filters.filter_min_quality(df, 1.5)


def test_strong_title_rescues_post(spark):
    df = spark.createDataFrame([("x" * 10, 1), ("x" * 9, 1), ("", 0)], "title string, is_low_signal int")
    assert {len(r.title) for r in filters.filter_low_signal_posts(df).collect()} == {10, 0}


def hot_batch(spark, rows=20000):
    """A third of all rows is one key."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, rows, 1, 8).select(
        F.col("id").alias("arrival_seq"),
        F.when(hot, F.lit("app")).otherwise(F.concat(F.lit("a"), F.col("id") % 50)).alias("app_id"),
        F.when(hot, F.lit("u")).otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("userName"),
        F.when(hot, F.lit("same")).otherwise(F.concat(F.lit("t"), F.col("id") % 700)).alias("review_text"),
    )


def test_dedup_prunes_hot_keys_before_the_shuffle(spark):
    df = dedup.dedup_reviews(hot_batch(spark))
    keys = list(dedup.REVIEW_KEYS)
    expected = hot_batch(spark).groupBy(*keys).agg(F.min("arrival_seq").alias("arrival_seq"))
    assert df.select(*keys, "arrival_seq").exceptAll(expected.select(*keys, "arrival_seq")).count() == 0
    assert df.count() == expected.count()
    plan = plan_of(df)
    # Top-down: final limit, exchange, partial limit, each once.
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert plan.count("Exchange") == 1


def test_latest_per_key_takes_the_last(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 1)], "k string, arrival_seq long")
    got = {(r.k, r.arrival_seq) for r in dedup.latest_per_key(df, ("k",)).collect()}
    assert got == {("a", 3), ("b", 1)}


def test_bounded_fetch(spark):
    df = hot_batch(spark).withColumn("arrival_seq", F.col("arrival_seq") * 50_000)
    got = dedup.bounded_fetch(df, "app_id", 7)
    counts = {r["count"] for r in got.groupBy("app_id").count().collect()}
    assert counts == {7}
    first = got.filter("app_id = 'app'").agg(F.max("arrival_seq")).first()[0]
    assert first == 6 * 3 * 50_000
    with pytest.raises(ValueError):
        dedup.bounded_fetch(df, "app_id", 0)


def test_salted_lookup_equals_plain_join(spark):
    facts = hot_batch(spark).select("arrival_seq", F.nullif("userName", F.lit("u7")).alias("username"))
    users = facts.select("username").distinct().filter("username <> 'u8'").withColumn("uid", F.md5("username"))
    plain = facts.join(users, "username", "left").select("arrival_seq", "username", "uid")
    salted = salted_lookup(facts, users, ("username",), "arrival_seq", share=0.2, salts=8)
    salted = salted.select("arrival_seq", "username", "uid")
    assert salted.count() == plain.count() == 20000
    assert salted.exceptAll(plain).count() == 0


def test_stage_counts_agree_with_the_pipeline(spark):
    df = hot_batch(spark).withColumns({
        "language": F.when(F.length("review_text") % 2 == 0, "en"),
        "quality_score": F.length("review_text") / 5.0,
        "is_low_signal": (F.col("review_text") == "same").cast("int"),
    })
    chosen = filters.optional_filters("reviews", drop_low_signal=True, min_quality=0.5)
    counts = stages.stage_counts(df, "app_id", "userName", ("review_text",), chosen)
    totals = counts.agg(*[F.sum(c).alias(c) for c in counts.columns if c != "app_id"]).first()
    unique = dedup.dedup_reviews(df)
    kept = filters.apply_quality_filters(unique, "reviews", drop_low_signal=True, min_quality=0.5)
    assert totals.rows_after_clean == 20000
    assert totals.duplicates_removed == 20000 - unique.count()
    assert totals.rows_final == kept.count()


def test_new_users_and_upsert(spark):
    users = upsert.stage_users(
        spark.createDataFrame([("a",), ("a",), ("[deleted]",), (None,)], "author string"), "author", "reddit"
    )
    assert [r.username for r in users.collect()] == ["a"]
    assert upsert.new_users(users, users).count() == 0
    old = spark.createDataFrame([("k1", 1), ("k2", 1)], "k string, v int")
    new = spark.createDataFrame([("k2", 2), ("k3", 2)], "k string, v int")
    once = upsert.upsert(old, new, "k")
    assert sorted(map(tuple, once.collect())) == [("k1", 1), ("k2", 2), ("k3", 2)]
    assert sorted(upsert.upsert(once, new, "k").collect()) == sorted(once.collect())
    counts = upsert.affected_rows(old, new, "k").first()
    assert (counts.affected, counts.inserted, counts.updated) == (2, 1, 1)


def test_communities_first_claim_wins(spark):
    stored = spark.createDataFrame([("t5_1", "old")], "subreddit_id string, name string")
    batch = spark.createDataFrame(
        [(1, "t5_1", "new"), (2, "t5_2", "Two"), (3, "t5_2", "renamed"), (4, "t5_3", "old"), (5, " ", "x")],
        "arrival_seq long, subreddit_id string, subreddit_name string",
    )
    got = upsert.insert_communities(stored, upsert.stage_communities(batch)).collect()
    assert sorted(map(tuple, got)) == [("t5_1", "old"), ("t5_2", "two")]


def scored(spark, scores):
    return spark.createDataFrame(
        [(i, q, int(q is not None and q < 0.3), "r" if q and q < 0.3 else "", None, 10, 2)
         for i, q in enumerate(scores)],
        "arrival_seq int, quality_score double, is_low_signal int, low_signal_reasons string, "
        "language string, cleaned_length int, word_count int",
    )


def test_histogram_labels(spark):
    rows = report.quality_histogram(scored(spark, [1.0, 0.999, 0.3, None])).collect()
    assert [(r.score_range, r.n) for r in rows] == [("[0.3 - 0.4)", 1), ("[0.9 - 1.0)", 1), ("[1.0]", 1)]
    every = scored(spark, [k / 1000 for k in range(1001)])
    got = {r.score_range: r.n for r in report.quality_histogram(every).collect()}
    assert got["[1.0]"] == 1 and set(got.values()) == {1, 100}


def test_full_report_agrees_with_its_sections(spark):
    df = scored(spark, [0.1, 0.1, 0.55, 0.9, None])
    full = report.full_report({"reviews": df, "posts": df})
    assert full.filter("table_name = 'posts'").count() * 2 == full.count()
    sections = {r.section: r["count"] for r in full.filter("table_name = 'posts'").groupBy("section").count().collect()}
    assert sections == {"overview": 1, "language": 1, "reason": 1, "histogram": 3}
    over = report.overview(df).first()
    row = full.filter("section = 'overview' AND table_name = 'posts'").first()
    assert (row.n, row.avg_quality, row.avg_length) == (over.n_rows, over.avg_quality, over.avg_length)
    assert over.low_signal_pct == 40.0
    assert report.overview(df.limit(0)).count() == 0


def test_overview_is_one_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    scored(spark, [0.5]).write.parquet(path)
    plan = plan_of(report.overview(spark.read.parquet(path)))
    assert plan.count("FileScan") == 1 and "arrival_seq" not in plan


def test_observation(spark, tmp_path):
    observed, observation = report.observe_stage(scored(spark, [0.1, 0.5]), "final")
    observed.write.parquet(str(tmp_path / "out"))
    assert observation.get["n_rows"] == 2 and observation.get["avg_quality"] == 0.3


@pytest.mark.parametrize("count", [1001, 1500, 4000])
def test_bounded_fetch_of_many_rows_ranks_a_part_only(spark, count):
    """Uneven arrivals, ties of sources in size, null sources; the hot source is never in one window whole."""
    rows = [("hot", k * k) for k in range(6000)] + [("even", 7 * k) for k in range(4000)] + [("few", k) for k in range(30)]
    rows += [(None, 10**12 + k) for k in range(2000)]
    df = spark.createDataFrame(rows, "app_id string, arrival_seq long").repartition(8)
    got = sorted(map(tuple, dedup.bounded_fetch(df, "app_id", count).collect()), key=repr)
    by_app = {a: sorted(n for b, n in rows if b == a)[:count] for a, _ in rows}
    assert got == sorted(((a, n) for a, kept in by_app.items() for n in kept), key=repr)
    ranked = dedup._fetch_many(df.filter("app_id = 'hot'"), "app_id", count, "arrival_seq")
    windowed = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window" in windowed and "percentile_approx" in windowed


def test_integrity_reads_each_table_once(spark):
    from feedback_engine.operators import integrity
    from feedback_engine.session import new_workspace

    given = {
        "communities": ([("c1", "n1"), ("c1", "n2"), ("c3", "n2")], "subreddit_id string, name string"),
        "users": ([("u1", "a|b", "c"), ("u2", "a", "b|c"), ("u3", "x", "y"), ("u4", "x", "y")], "user_id string, username string, platform string"),
        "posts": ([("p1", "c1", "u1"), ("p2", "c9", None), ("p3", "c9", "u9")], "post_id string, subreddit_id string, user_id string"),
    }
    tables = {}
    for name, (rows, schema) in given.items():
        path = new_workspace(spark, name)
        spark.createDataFrame(rows, schema).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    unique, foreign = integrity.check_unique(tables), integrity.check_foreign_keys(tables)
    assert sorted(map(tuple, unique.collect())) == [
        ("communities", "name", "n2", 2), ("communities", "subreddit_id", "c1", 2), ("users", "username,platform", "x|y", 2)
    ]
    assert sorted(map(tuple, foreign.collect())) == [("posts", "subreddit_id", "c9", 2), ("posts", "user_id", "u9", 1)]
    scans = [df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") for df in (unique, foreign)]
    assert scans == [3, 3]
