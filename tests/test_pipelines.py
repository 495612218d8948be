"""End to end, on the shared test tables."""

import pytest
from pyspark.sql import functions as F

from feedback_engine import catalog
from feedback_engine.fixtures import Inputs
from feedback_engine.functions.dispatch import APP, COMMUNITY, POST
from feedback_engine.operators import columns, dedup, langid, report, stages, upsert
from feedback_engine.plans import ingest, posts, reviews, routing
from feedback_engine.schemas import RAW_POST
from feedback_engine.session import new_workspace, remove_folders
from feedback_engine.sources.store import FeedbackStore
from feedback_engine.streaming.ingest import Arrivals, ingest_posts, ingest_reviews
from tests.conftest import plan_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def inputs(spark):
    return Inputs(spark, SMALL)


@pytest.fixture
def store(spark):
    return FeedbackStore(spark, new_workspace(spark, "store")).initialize()


def rows(df):
    return sorted(map(str, df.collect()))


def test_texts_are_cleaned_once(inputs):
    """One cleaning per text column, no Python workers, filters above it."""
    df = reviews.review_pipeline(inputs.reviews(), drop_low_signal=True, min_quality=0.3)
    plan = plan_of(df)
    # Two branches of the union, title and text each.
    assert plan.count("java_method") in (2, 4)
    assert "Python" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning(_hash") == 1


def test_filters_before_dedup_give_the_same_rows(inputs):
    options = dict(drop_low_signal=True, min_quality=0.3, keep_languages=["en", "de"])
    from feedback_engine.operators import dedup, filters

    for pipeline, clean, unique, kind, landed in (
        (reviews.review_pipeline, reviews.clean_reviews, dedup.dedup_reviews, "reviews", inputs.reviews()),
        (posts.post_pipeline, posts.clean_posts, dedup.dedup_posts, "posts", inputs.posts()),
    ):
        language = catalog.language()
        stepwise = unique(clean(landed, language))
        if kind == "posts":
            stepwise = filters.filter_empty_post(stepwise)
        stepwise = filters.apply_quality_filters(stepwise, kind, **options)
        assert rows(pipeline(landed, language, **options)) == rows(stepwise)


def test_count_bounds_each_app(inputs):
    got = reviews.review_pipeline(inputs.reviews(), count=3)
    assert got.groupBy("app_id").count().agg(F.max("count")).first()[0] <= 3


def test_replayed_batch_changes_nothing(inputs, store):
    batch = catalog.final_reviews(inputs)
    apps = catalog.app_names(inputs)
    counts = ingest.store_reviews(store, 0, batch, apps).first()
    assert counts.inserted == counts.affected - counts.updated > 0
    once = {t: rows(store.read(t)) for t in ("reviews", "users", "apps")}
    ingest.store_reviews(store, 0, batch, apps)
    assert {t: rows(store.read(t)) for t in once} == once
    again = ingest.store_reviews(store, 1, batch, apps).first()
    assert again.inserted == 0 and again.affected == counts.affected
    assert {t: rows(store.read(t)) for t in once} == once
    store.initialize()
    assert rows(store.read("reviews")) == once["reviews"]


def test_log_equals_merge_and_compaction(inputs, spark, store):
    first, later = catalog.staged(inputs)
    merged = rows(upsert.upsert(first, later, "review_key"))
    catalog.load_reviews(inputs, store)
    assert rows(store.read("reviews")) == merged
    compacted = store.compact(new_workspace(spark, "compacted"), {"reviews": 1})
    assert rows(compacted.read("reviews")) == merged
    assert compacted.log("reviews").count() == len(merged)
    # A later batch merges into the compacted rows.
    ingest.store_reviews(compacted, 2, catalog.final_reviews(inputs), catalog.app_names(inputs))
    again = upsert.upsert(compacted.read("reviews"), first, "review_key")
    assert rows(compacted.read("reviews")) == rows(again)
    assert compacted.read("users").count() == store.read("users").count()


def test_compaction_keeps_later_batches(inputs, spark, store):
    catalog.load_reviews(inputs, store)
    catalog.load_posts(inputs, store)
    whole = {table: rows(store.read(table)) for table in ("reviews", "posts", "users", "apps")}
    compacted = store.compact(new_workspace(spark, "compacted"), {"reviews": 0})
    assert {table: rows(compacted.read(table)) for table in whole} == whole
    assert compacted.log("posts").filter("feed = 'base'").count() == 0
    with pytest.raises(ValueError, match="exists"):
        store.compact(compacted.root, {"reviews": 1})
    # Compacting what was compacted before gives the same tables again.
    twice = compacted.compact(new_workspace(spark, "compacted"), {"reviews": 1, "posts": 0})
    assert {table: rows(twice.read(table)) for table in whole} == whole


def test_ambiguous_communities_are_quarantined(inputs, store):
    batch = catalog.final_posts(inputs)
    several = F.concat(F.lit("t5_"), F.col("num_comments"))
    mixed = batch.withColumn(
        "subreddit_id", F.when(F.col("subreddit_name") == "sub1", several)
        .when(F.col("subreddit_name") == "sub2", F.lit("\t\u00a0")).otherwise(F.col("subreddit_id"))
    )
    good, bad = ingest.split_communities(mixed)
    assert {r[0] for r in bad.select("subreddit_name").distinct().collect()} == {"sub1", "sub2"}
    ingest.store_posts(store, 0, mixed)
    assert store.read("posts").count() == good.count() == batch.count() - bad.count()
    assert store.read("communities").count() == 3


def test_apps_without_reviews_are_not_stored(inputs, store):
    none = catalog.final_reviews(inputs).filter("false")
    ingest.store_reviews(store, 0, none, catalog.app_names(inputs))
    assert store.read("apps").count() == store.read("reviews").count() == 0


def test_copies_in_two_languages_count_as_the_first(spark):
    columns_ = "app_id string, userName string, review_text string, language string, arrival_seq long"
    same = ("a", "u", "the very same text of a review")
    copies = spark.createDataFrame([(*same, "de", 1), (*same, "en", 2)], columns_)
    counts = stages.stage_counts(
        copies, "app_id", "userName", ("review_text",), {"language": F.col("language") == "en"}
    )
    found = counts.first()
    assert (found.rows_after_clean, found.duplicates_removed, found.dropped_language) == (2, 1, 1)
    assert found.rows_final == dedup.dedup_reviews(copies).filter("language = 'en'").count() == 0


def test_deleted_author_loses_the_user(inputs, store):
    batch = catalog.final_posts(inputs)
    ingest.store_posts(store, 0, batch)
    assert store.read("posts").filter("user_id IS NOT NULL").count() > 0
    ingest.store_posts(store, 1, batch.withColumn("author", F.lit("[deleted]")))
    assert store.read("posts").filter("user_id IS NOT NULL").count() == 0


def test_language_profile_on_held_out_documents(spark):
    texts = catalog.labelled_texts(Inputs(spark, "/root/testdata/sf0.01"))
    train, held_out = texts.filter("doc_id % 2 = 0"), texts.filter("doc_id % 2 = 1")
    profile = langid.LanguageProfile.from_rows(langid.train_profile(train, "cleaned", "lang"))
    scored = held_out.select("lang", profile.detect(F.col("cleaned")).alias("found"))
    right, total = scored.agg(F.count_if(F.col("lang") == F.col("found")), F.count("found")).first()
    assert total > 400 and right / total > 0.95
    assert profile.best(["x" * 19, None, "漢" * 40]) == [None] * 3
    # The same profile used inside the pipeline.
    got = reviews.review_pipeline(Inputs(spark, SMALL).reviews(), profile)
    assert got.filter("language IS NOT NULL AND cleaned_length < 20").count() == 0
    assert got.filter("language = lang_hint").count() > 0.9 * got.filter("language IS NOT NULL").count()


def test_scores_follow_labels(spark):
    """On average only, and over enough labelled rows: scores know sizes, not sense."""
    inputs = Inputs(spark, "/root/testdata/sf0.01")
    scored = inputs.table("documents").join(inputs.table("labels"), "doc_id").select(
        "quality", catalog.quality.preprocess_text(F.col("text"))["quality_score"].alias("score")
    )
    mean = {r.quality: r.m for r in scored.groupBy("quality").agg(F.avg("score").alias("m")).collect()}
    assert mean[1] >= mean[0]


def test_post_stream_shares_the_store(inputs, spark, store):
    """Both feeds count their own batches; neither overwrites the other's users."""
    ingest.store_reviews(store, 0, catalog.final_reviews(inputs), catalog.app_names(inputs))
    reviewers = store.read("users").count()
    base = new_workspace(spark, "posts")
    columns.align_schema(inputs.posts(), RAW_POST).write.parquet(f"{base}/landing")
    for _ in range(2):
        ingest_posts(spark, Arrivals(f"{base}/landing", f"{base}/checkpoint"), store).awaitTermination()
    assert store.read("posts").count() == posts.post_pipeline(inputs.posts()).count()
    assert store.read("users").filter("platform = 'apple'").count() == reviewers
    assert store.read("users").filter("platform = 'reddit'").count() > 0


def test_stream_ends_where_batches_end(inputs, spark, store):
    """The lines that arrive whole, taken as two batches; the others are in quarantine."""
    streamed, quarantine = catalog.ingested(inputs)
    found = catalog.detector(inputs)
    for batch_id, landed in enumerate((inputs.reviews(), inputs.later_reviews())):
        whole = landed.filter(F.col("arrival_seq") % catalog.BROKEN_EVERY != 0)
        ingest.store_reviews(store, batch_id, reviews.review_pipeline(whole, found), catalog.app_names(inputs))
    for table in ("reviews", "users", "apps"):
        assert rows(streamed.read(table)) == rows(store.read(table))
    broken = spark.read.parquet(quarantine)
    both = inputs.reviews().unionAll(inputs.later_reviews())
    assert broken.count() == both.filter(F.col("arrival_seq") % catalog.BROKEN_EVERY == 0).count()


def test_micro_batches_are_bounded_and_replayed_alike(spark, store):
    """Three files, one a batch; the last batch's commit is lost, so it runs again and changes nothing."""
    base = new_workspace(spark, "lines")
    line = '{{"arrival_seq":{0},"app_id":"a","userName":"u{0}","rating":"5","title":"t","date":"2024-01-05","review":"a good thing no {0}"}}'
    for k in range(3):
        lines = [(line.format(k),), ("{cut",), ("",)]
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(f"{base}/landing")
    arrivals = Arrivals(f"{base}/landing", f"{base}/checkpoint", "json", f"{base}/quarantine", max_files=1)

    def apps(landed):
        return landed.select("app_id", F.lit("A").alias("app_name"), "arrival_seq")

    def run():
        ingest_reviews(spark, arrivals, store, apps).awaitTermination()
        bad = spark.read.parquet(arrivals.quarantine).select("batch_id", "reason", "_corrupt_record")
        batches = sorted(map(tuple, store.log("reviews").filter("feed = 'reviews'").select("batch_id", "review_key").collect()))
        return rows(store.read("reviews")), batches, sorted(map(tuple, bad.collect()))

    first = run()
    assert len(first[0]) == 3 and [b for b, _ in first[1]] == [0, 1, 2]
    assert [(b, r) for b, r, _ in first[2]] == [(k, r) for k in range(3) for r in ("blank", "broken")]
    remove_folders(spark, f"{base}/checkpoint/commits/2")
    assert run() == first
    with pytest.raises(ValueError):
        Arrivals("l", "c", "json")
    with pytest.raises(ValueError):
        Arrivals("l", "c", max_files=1, max_bytes=1)


def test_profiles_are_stored_by_version(spark):
    texts = catalog.labelled_texts(Inputs(spark, SMALL))
    folder = new_workspace(spark, "profiles")
    profile = langid.train_profile(texts, "cleaned", "lang")
    langid.save_profile(profile, folder, 1)
    langid.save_profile(profile.filter("lang = 'en'"), folder, 2)
    assert langid.LanguageProfile.from_rows(langid.stored_profile(spark, folder)).languages == ["en"]
    assert rows(langid.stored_profile(spark, folder, 1)) == rows(profile)


def test_a_large_profile_gives_the_same_languages(spark):
    texts = catalog.labelled_texts(Inputs(spark, SMALL))
    odd = spark.createDataFrame([(-1, "x" * 19), (-2, None), (-3, "漢" * 40), (-4, ""), (-5, "the " * 9)], "doc_id long, cleaned string")
    both = texts.select("doc_id", "cleaned").unionByName(odd)
    profile = ingest.materialize(langid.train_profile(texts, "cleaned", "lang"), "profile")
    sent = langid.detect_languages(both, "doc_id", "cleaned", profile)
    joined = langid.detect_languages(both, "doc_id", "cleaned", profile, sent_rows=10)
    assert rows(sent) == rows(joined)
    assert joined.filter("doc_id < 0 AND language IS NULL").count() == 4


def test_totals_taken_while_writing(inputs):
    """The same numbers as the aggregates over what was written."""
    for cleaned in (catalog.clean(inputs), catalog.clean_posts(inputs)):
        written, totals = ingest.materialize_observed(cleaned, "observed", "after_clean")
        expected = report.overview(written).select("n_rows", "low_signal_rows", "avg_quality").first()
        assert tuple(totals.first()) == ("after_clean", *expected)
    _, none = ingest.materialize_observed(cleaned.filter("false"), "observed", "empty")
    assert tuple(none.first()) == ("empty", 0, 0, 0.0)


def test_requests_run_the_pipelines_they_name(inputs, store):
    """What was asked for is stored and nothing else; asking again adds nothing."""
    counts = {r.feed: r for r in catalog.ingest_requests(inputs, store).collect()}
    assert counts["reviews"].inserted > 0 and counts["posts"].inserted > 0
    asked = {(r.kind, r.value) for r in routing.classify_inputs(inputs.requests(), "input").collect()}
    assert {r.app_id for r in store.read("reviews").select("app_id").collect()} <= {v for k, v in asked if k == APP}
    names = {v for k, v in asked if k == COMMUNITY}
    posts_of = store.read("posts").join(store.read("communities"), "subreddit_id")
    outside = posts_of.filter(~F.col("name").isin(*names)).select("post_id").collect()
    assert outside and {r.post_id for r in outside} <= {v for k, v in asked if k == POST}
    before = {table: rows(store.read(table)) for table in ("reviews", "posts", "users", "apps", "communities")}
    again = {r.feed: r for r in catalog.ingest_requests(inputs, store, 1).collect()}
    assert all(again[feed].inserted == 0 and again[feed].affected == counts[feed].affected for feed in again)
    assert before == {table: rows(store.read(table)) for table in before}


def test_a_post_asked_for_by_id_is_no_copy(inputs):
    """The same post under two ids: its community stores the first, and either is stored when asked for."""
    first = inputs.plain_posts().filter("selftext <> ''").limit(1)
    landed = first.unionByName(first.withColumns({"id": F.lit("Copy1"), "arrival_seq": F.col("arrival_seq") + 1}))
    landed = ingest.materialize(landed, "landed")
    name = landed.select(F.lower("subreddit.display_name")).first()[0]

    def stored_ids(*asked):
        requests = inputs.spark.createDataFrame(list(asked), "kind string, value string")
        own = FeedbackStore(inputs.spark, new_workspace(inputs.spark, "store")).initialize()
        routing.ingest_requested(
            own, 0, requests, inputs.numbered_reviews().limit(0), landed, lambda _: catalog.app_names(inputs).limit(0)
        )
        return {r.post_id.lower() for r in own.read("posts").collect()}

    original = next(r.id.lower() for r in landed.collect() if r.id != "Copy1")
    assert stored_ids((COMMUNITY, name)) == {original}
    assert stored_ids((POST, "copy1"), (POST, "copy1")) == {"copy1"}
    assert stored_ids((COMMUNITY, name), (POST, "copy1"), (None, None)) == {original, "copy1"}
    assert stored_ids((None, "x")) == set()


def test_a_kind_reads_its_own_requests(inputs):
    requests = routing.written_by_kind(routing.classify_inputs(inputs.requests(), "input"))
    plan = plan_of(routing.route_by_source(requests)[POST])
    assert "PartitionFilters: [isnotnull(kind" in plan and "DataFilters: []" in plan
    assert requests.count() == requests.distinct().count()
