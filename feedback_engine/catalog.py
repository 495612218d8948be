"""One query per operator, over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_engine.fixtures import APP_NUMBER, STORED_COMMUNITIES, Inputs
from feedback_engine.functions import casts, dispatch, keys, quality, text
from feedback_engine.operators import columns, dedup, filters, integrity, langid, report, upsert
from feedback_engine.operators.quality import attach_quality
from feedback_engine.plans import ingest, posts, reviews, routing
from feedback_engine.schemas import (
    APPS, POST_PLATFORM, POSTS, QUALITY, RAW_REVIEW, REVIEW_PLATFORM, REVIEWS, USERS,
)
from feedback_engine.session import new_workspace
from feedback_engine.sources import landing
from feedback_engine.sources.store import FeedbackStore
from feedback_engine.streaming.ingest import Arrivals, ingest_reviews

Query = Callable[[Inputs], DataFrame]
REGISTRY: dict[str, Query] = {}

# The filter settings used wherever a query exercises the optional filters.
OPTIONS = {"drop_low_signal": True, "min_quality": 0.3, "keep_languages": [" EN", "de", "zh-cn", ""]}
POST_ID = "1_1"

# Raw texts whose decorations give each rule something to do.
DECORATED = (
    "'Visit https://shop.example.com/a?b=1 It’s “fine”, don''t goooo!!! ' || text || ' 😀👍🏽 1️⃣ ™'"
)


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        REGISTRY[name] = build
        return build

    return register


def text_query(name: str, source: str, rule: Callable[[Column], Column], alias: str = "out") -> None:
    """A query that applies one column rule to a text made from every document."""
    REGISTRY[name] = lambda i: i.text(source).select("doc_id", rule(F.col("c")).alias(alias))


# --- shared steps -----------------------------------------------------------------

def language() -> Column:
    return Inputs.language("_quality.cleaned_text")


# Folders of stored language profiles, by application and data folder.
PROFILES: dict[tuple[str, str], str] = {}


def detector(i: Inputs) -> langid.LanguageProfile:
    """The profile of the folder's documents, trained and stored once, then read by whatever detects."""
    trained = (i.spark.sparkContext.applicationId, i.sf_dir)
    if trained not in PROFILES:
        folder = new_workspace(i.spark, "language_profile")
        langid.save_profile(langid.train_profile(labelled_texts(i), "cleaned", "lang"), folder, 1)
        PROFILES[trained] = folder
    return langid.LanguageProfile.from_rows(langid.stored_profile(i.spark, PROFILES[trained]))


def typed(i: Inputs) -> DataFrame:
    return landing.typed_reviews(landing.scan_reviews(i.reviews()))


def clean(i: Inputs) -> DataFrame:
    return reviews.clean_reviews(i.reviews(), language())


def clean_later(i: Inputs) -> DataFrame:
    return reviews.clean_reviews(i.later_reviews(), language())


def final_reviews(i: Inputs) -> DataFrame:
    return reviews.review_pipeline(i.reviews(), language())


def later_reviews(i: Inputs) -> DataFrame:
    return reviews.review_pipeline(i.later_reviews(), language())


def clean_posts(i: Inputs) -> DataFrame:
    return posts.clean_posts(i.posts(), language())


def final_posts(i: Inputs) -> DataFrame:
    return posts.post_pipeline(i.posts(), language())


def assessed(i: Inputs) -> DataFrame:
    """Cleaned text and signals of every raw review, dropped ones included."""
    return i.reviews().select(
        "arrival_seq", quality.preprocess_text(F.col("review")).alias("q")
    ).select("arrival_seq", "q.*")


def shown(df: DataFrame, *drop: str) -> DataFrame:
    """Times as text, so that results compare alike in any engine."""
    times = [c for c, t in df.dtypes if t == "timestamp"]
    return df.drop("lang_hint", *drop).withColumns(
        {c: casts.timestamp_text(F.col(c)) for c in times}
    )


def narrow(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, "language", "quality_score", "is_low_signal")


# --- scans ------------------------------------------------------------------------

query("scan_reviews")(lambda i: landing.scan_reviews(i.reviews()).drop("lang_hint"))
query("scan_posts")(lambda i: shown(landing.scan_posts(i.posts())))
query("scan_post_by_id")(lambda i: shown(posts.post_by_id(i.posts(), POST_ID, language())))
@query("bounded_fetch")
def bounded_fetch(i: Inputs) -> DataFrame:
    """A few reviews of each app, and many of each language, which is a source that holds most of the rows."""
    few = dedup.bounded_fetch(i.reviews(), "app_id", 5).select("app_id", "arrival_seq")
    many = dedup.bounded_fetch(i.reviews(), "lang_hint", 1200)
    return few.unionAll(many.select("lang_hint", "arrival_seq"))


query("resolve_app_name")(
    lambda i: i.app_details().select(
        "app_id", casts.app_name(F.col("app_name"), F.col("name"), F.col("app_id")).alias("resolved")
    )
)


def app_names(i: Inputs) -> DataFrame:
    """Apps with their names, in an order of arrival."""
    return i.app_details().select(
        "app_id",
        casts.app_name(F.col("app_name"), F.col("name"), F.col("app_id")).alias("app_name"),
        F.when(F.col("name").isNull(), 0).otherwise(1).alias("arrival_seq"),
    )


def new_store(i: Inputs) -> FeedbackStore:
    return FeedbackStore(i.spark, new_workspace(i.spark, "store")).initialize()


def load_reviews(i: Inputs, store: FeedbackStore, detected: bool = False) -> FeedbackStore:
    """Two batches of reviews written one after the other."""
    found = detector(i) if detected else language()
    for batch_id, landed in enumerate((i.reviews(), i.later_reviews())):
        ingest.store_reviews(store, batch_id, reviews.review_pipeline(landed, found), app_names(i))
    return store


def load_posts(i: Inputs, store: FeedbackStore) -> FeedbackStore:
    ingest.store_posts(store, 0, final_posts(i))
    return store


def stored(store: FeedbackStore, *tables: str) -> DataFrame:
    """Rows of several tables, each with the name of its own; columns that a table lacks are null."""
    named = [store.read(t).withColumn("table_name", F.lit(t)) for t in tables]
    return shown(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named))


query("sink_reviews")(
    lambda i: stored(load_reviews(i, new_store(i), detected=True), "reviews", "users", "apps")
)
query("sink_posts")(lambda i: stored(load_posts(i, new_store(i)), "posts", "users", "communities"))


@query("scan_store")
def scan_store(i: Inputs) -> DataFrame:
    """Both fact tables read back, as the reports read them."""
    store = new_store(i)
    stored_reviews = narrow(load_reviews(i, store).read("reviews"), "review_key")
    stored_posts = narrow(load_posts(i, store).read("posts"), "post_id")
    return stored_reviews.withColumnRenamed("review_key", "id").unionByName(
        stored_posts.withColumnRenamed("post_id", "id")
    )


@query("partial_batch")
def partial_batch(i: Inputs) -> DataFrame:
    """Landed JSON lines of which every seventh is cut off; the others go on."""
    path = new_workspace(i.spark, "landing")
    line = F.to_json(F.struct(*[c for c in RAW_REVIEW.fieldNames()]))
    cut = F.when(F.col("arrival_seq") % 7 == 0, F.expr("left(line, 25)")).otherwise(F.col("line"))
    i.reviews().withColumn("line", line).select(cut.alias("value")).write.text(path)
    parsed = landing.parse_json_lines(i.spark.read.text(path), RAW_REVIEW)
    good, bad = landing.split_corrupt(parsed)
    return good.groupBy("app_id").agg(
        F.count("*").alias("n"), F.sum(F.length("review")).alias("chars")
    ).unionByName(
        bad.agg(
            F.lit("(quarantined)").alias("app_id"),
            F.count("*").alias("n"),
            F.sum(F.length(landing.CORRUPT)).alias("chars"),
        )
    )


# --- projections and casts --------------------------------------------------------

query("cast_rating")(
    lambda i: i.reviews().select("arrival_seq", casts.cast_rating(F.col("rating")).alias("rating"))
)
query("parse_timestamp_utc")(
    lambda i: landing.typed_reviews(landing.scan_reviews(i.reviews()), landing.VOTE).select(
        "arrival_seq", casts.timestamp_text(F.col("timestamp")).alias("timestamp")
    )
)
query("epoch_to_timestamp")(
    lambda i: i.posts().select(
        "id", casts.timestamp_text(casts.epoch_to_timestamp(F.col("created_utc"))).alias("timestamp")
    )
)
query("author_default")(
    lambda i: i.reviews().select("arrival_seq", casts.review_author(F.col("userName")).alias("author"))
)
query("author_deleted")(
    lambda i: i.posts().select("id", casts.post_author(F.col("author")).alias("author"))
)
query("community_id_fallback")(
    lambda i: landing.scan_posts(i.posts()).select("post_id", "subreddit_id", "subreddit_name")
)
query("null_defaults")(
    lambda i: landing.scan_posts(i.posts()).select(
        "post_id", "title", "flair", "post_text", "score", "num_comments"
    )
)
query("attach_quality")(
    lambda i: attach_quality(
        landing.scan_reviews(i.reviews()).select("arrival_seq", "review_text", "lang_hint"),
        "review_text", (), language(),
    ).drop("lang_hint")
)
query("align_schema")(
    lambda i: shown(
        columns.align_schema(
            landing.scan_posts(i.posts()).withColumn("word_count", F.length("title").cast("string")),
            POSTS,
        )
    )
)


@query("evolve_schema")
def evolve_schema(i: Inputs) -> DataFrame:
    """Reviews written before there were quality columns, read with them."""
    store = new_store(i)
    old = upsert.stage_reviews(final_reviews(i)).drop(*QUALITY.fieldNames())
    old.write.parquet(f"{store.root}/reviews/feed=reviews/batch_id=0")
    return store.read("reviews").select("review_key", "rating", *QUALITY.fieldNames())


# --- filters ----------------------------------------------------------------------

query("filter_required")(
    lambda i: typed(i).transform(filters.filter_required).select("arrival_seq", "rating")
)
query("filter_rating_range")(
    lambda i: typed(i).transform(filters.filter_rating_range).select("arrival_seq", "rating")
)
query("filter_empty_review")(
    lambda i: assessed(i).withColumnRenamed("cleaned_text", "review_text")
    .transform(filters.filter_empty_review).select("arrival_seq", "char_length")
)
query("filter_empty_post")(
    lambda i: clean_posts(i).transform(filters.filter_empty_post).select("post_id", "title")
)
query("filter_language")(
    lambda i: reviews.clean_reviews(i.reviews(), detector(i))
    .transform(filters.filter_language, OPTIONS["keep_languages"])
    .select("arrival_seq", "language")
)
query("filter_min_quality")(
    lambda i: clean(i).transform(filters.filter_min_quality, OPTIONS["min_quality"])
    .select("arrival_seq", "quality_score")
)
query("filter_low_signal_reviews")(
    lambda i: clean(i).transform(filters.filter_low_signal_reviews)
    .select("arrival_seq", "low_signal_reasons")
)
query("filter_low_signal_posts")(
    lambda i: clean_posts(i).transform(filters.filter_low_signal_posts)
    .select("post_id", "title", "is_low_signal")
)


@query("filter_pipeline")
def filter_pipeline(i: Inputs) -> DataFrame:
    kept_reviews = reviews.review_pipeline(i.reviews(), language(), **OPTIONS).select(
        F.lit("reviews").alias("table_name"), F.col("arrival_seq"), F.col("review_text").alias("body")
    )
    kept_posts = posts.post_pipeline(i.posts(), language(), **OPTIONS).select(
        F.lit("posts").alias("table_name"), F.col("arrival_seq"), F.col("post_text").alias("body")
    )
    return kept_reviews.unionByName(kept_posts)


query("parse_language_list")(
    lambda i: i.text("' ' || lang || ', zh,, ' || CASE WHEN doc_id % 3 = 0 THEN ' , ' ELSE source END")
    .select("doc_id", F.array_join(filters.language_list(F.col("c")), "|").alias("codes"))
)

# --- text -------------------------------------------------------------------------

text_query("fold_smart_quotes", "'“It’s” ‘fine’ ‚‛„‟′″ ' || text", text.fold_smart_quotes)
text_query(
    "strip_urls",
    "'Visit HTTPS://shop.example.com/a?b=1 http: www. ' || text || ' WWW.x.example/y'",
    text.strip_urls,
)
text_query("strip_emoji", "'👍🏽 1️⃣ ™ 👩‍💻 2 ' || text || ' ❤️😀'", text.strip_emoji)
WIDE = "".join(chr(0xFEE0 + c) for c in range(0x21, 0x7F))
ASCII = "".join(chr(c) for c in range(0x21, 0x7F))
query("nfkc_normalize")(
    lambda i: i.table("documents")
    .select("doc_id", F.concat(F.lit("ﬁ…① "), F.translate("text", ASCII, WIDE)).alias("c"))
    .select("doc_id", text.nfkc_normalize(F.col("c")).alias("out"))
)
text_query("strip_non_text", "'a\"b—c (d) ' || text", text.strip_non_text)
text_query("squeeze_whitespace", "' \t a \n\n b  ' || text || '  '", text.squeeze_whitespace)
text_query("clean_text", DECORATED, text.clean_text)
APOSTROPHES = "'don''t won''t CAN''T shan''t you''re I''ve he''ll I''d I''m it''s WON''T DON''T ' || text"
text_query("expand_contractions", APOSTROPHES, text.expand_contractions)
text_query("collapse_letters", "'goooood AAaa zzz ' || text || ' mmm'", text.collapse_letters)
text_query("collapse_punctuation", "'!!!! ?!?! ok... ' || text || '!!,,'", text.collapse_punctuation)
text_query(
    "normalize_text", "'I can''t   goooo!!! ' || text || ' '", text.normalize_text
)
query("preprocess_text")(
    lambda i: i.text(DECORATED)
    .select("doc_id", quality.preprocess_text(F.col("c")).alias("q")).select("doc_id", "q.*")
)

# --- quality ----------------------------------------------------------------------

for _name, _column in {
    "char_length": "char_length",
    "low_signal_reasons": "low_signal_reasons",
    "is_low_signal": "is_low_signal",
    "quality_score": "quality_score",
}.items():
    query(_name)(lambda i, c=_column: assessed(i).select("arrival_seq", c))

query("word_count")(
    # Over raw text, where white space is not yet squeezed.
    lambda i: i.reviews().select(
        "arrival_seq", quality.word_count(F.coalesce("review", F.lit(""))).alias("word_count")
    )
)
query("alpha_ratio")(
    lambda i: assessed(i).select("arrival_seq", quality.alpha_ratio(F.col("cleaned_text")).alias("alpha"))
)
query("low_signal_phrase")(
    lambda i: assessed(i).select(
        "arrival_seq", quality.low_signal_phrase(F.col("cleaned_text")).cast("int").alias("is_phrase")
    )
)


def labelled_texts(i: Inputs) -> DataFrame:
    return i.table("documents").select(
        "doc_id", "lang", text.clean_and_normalize(F.col("text")).alias("cleaned")
    )


query("langid_train")(lambda i: langid.train_profile(labelled_texts(i), "cleaned", "lang"))


@query("langid_score")
def langid_score(i: Inputs) -> DataFrame:
    """The trained profile applied to every document and every turn."""
    turns = i.table("conversations").select(
        (F.col("conv_id") * -1000 - F.col("turn") - 1).alias("id"), F.col("text")
    )
    texts = i.table("documents").select(F.col("doc_id").alias("id"), "text").unionByName(turns)
    cleaned = texts.select("id", text.clean_and_normalize(F.col("text")).alias("cleaned"))
    profile = ingest.materialize(REGISTRY["langid_train"](i), "profile")
    return langid.detect_languages(cleaned, "id", "cleaned", profile)


# --- source recognition -------------------------------------------------------------

for _name, _form in {
    "src_app_url": dispatch.APP_URL,
    "src_app_id": dispatch.APP_ID,
    "src_post_url": dispatch.POST_URL,
    "src_community_url": dispatch.COMMUNITY_URL,
    "src_community_name": dispatch.COMMUNITY_NAME,
}.items():
    query(_name)(
        lambda i, form=_form: i.source_inputs().select(
            "page_id", dispatch.extract(dispatch.fold_input(F.col("input")), form).alias("value")
        )
    )

query("classify_source")(
    lambda i: routing.classify_inputs(i.source_inputs(), "input").select("page_id", "kind", "value")
)


@query("route_by_source")
def route_by_source(i: Inputs) -> DataFrame:
    """Every input that a pipeline gets."""
    classified = routing.classify_inputs(i.source_inputs(), "input")
    routed = None
    for kind, branch in routing.route_by_source(classified).items():
        part = branch.select(F.lit(kind).alias("pipeline"), "page_id", "value")
        routed = part if routed is None else routed.unionByName(part)
    return routed


def ingest_requests(i: Inputs, store: FeedbackStore, batch_id: int = 0) -> DataFrame:
    """What the requests name, stored; the affected counts of both feeds."""
    numbered = app_names(i).withColumn("app_id", F.expr(APP_NUMBER))
    return routing.ingest_requested(
        store, batch_id, routing.classify_inputs(i.requests(), "input"), i.numbered_reviews(), i.plain_posts(),
        lambda landed: numbered.join(landed.select("app_id"), "app_id", "left_semi"), language(),
    )


@query("routed_ingest")
def routed_ingest(i: Inputs) -> DataFrame:
    """Every table that the pipelines asked for have stored."""
    store = new_store(i)
    ingest_requests(i, store)
    return stored(store, "reviews", "posts", "users", "apps", "communities")


# --- keys and de-duplication --------------------------------------------------------

query("review_key")(
    lambda i: clean(i).select("arrival_seq", upsert.batch_review_key().alias("review_key"))
)
query("dedup_reviews")(
    lambda i: clean(i).transform(dedup.dedup_reviews).select("arrival_seq", *dedup.REVIEW_KEYS)
)
query("dedup_posts")(
    lambda i: clean_posts(i).transform(dedup.dedup_posts).select("arrival_seq", *dedup.POST_KEYS)
)
query("dedup_counts")(
    lambda i: reviews.review_stage_counts(clean(i)).select(
        "app_id", "rows_after_clean", "duplicates_removed"
    )
)
query("dropped_counts")(
    lambda i: posts.post_stage_counts(clean_posts(i), **OPTIONS)
)
query("latest_per_key")(
    lambda i: dedup.latest_per_key(
        clean(i).unionByName(clean_later(i)).withColumn("review_key", upsert.batch_review_key()),
        ("review_key",),
    ).select("review_key", "arrival_seq", "rating")
)

# --- upserts ------------------------------------------------------------------------


def stored_apps(i: Inputs) -> DataFrame:
    """An older list of apps: every name was made from the id."""
    return columns.align_schema(
        i.app_details().select("app_id").distinct()
        .select("app_id", F.concat(F.lit("AppId_"), F.col("app_id")).alias("app_name"),
                F.lit(REVIEW_PLATFORM).alias("platform")),
        APPS,
    )


query("upsert_apps")(lambda i: upsert.upsert_apps(stored_apps(i), app_names(i)))


def first_users(i: Inputs) -> DataFrame:
    return upsert.stage_users(final_reviews(i), "userName", REVIEW_PLATFORM)


@query("insert_new_users")
def insert_new_users(i: Inputs) -> DataFrame:
    stored = columns.align_schema(first_users(i), USERS)
    incoming = upsert.stage_users(later_reviews(i), "userName", REVIEW_PLATFORM).unionByName(
        upsert.stage_users(final_posts(i), "author", POST_PLATFORM)
    )
    return upsert.insert_users(stored, ingest.materialize(incoming, "users"))


query("insert_new_communities")(
    lambda i: upsert.insert_communities(
        i.sql(STORED_COMMUNITIES), upsert.stage_communities(landing.scan_posts(i.posts()))
    )
)


@query("lookup_user_id")
def lookup_user_id(i: Inputs) -> DataFrame:
    """Later reviews against earlier users; names with a hundredth of the rows are hot."""
    reviewers = landing.typed_reviews(landing.scan_reviews(i.later_reviews())).select(
        "arrival_seq", F.col("userName").alias("username"), F.lit(REVIEW_PLATFORM).alias("platform")
    )
    authors = i.posts().select(
        "arrival_seq", F.col("author").alias("username"), F.lit(POST_PLATFORM).alias("platform")
    )
    return upsert.lookup_user_id(
        reviewers.unionByName(authors), first_users(i), share=0.01, salts=4
    ).select("arrival_seq", "username", "user_id")


def staged(i: Inputs) -> tuple[DataFrame, DataFrame]:
    return upsert.stage_reviews(final_reviews(i)), upsert.stage_reviews(later_reviews(i))


@query("upsert_reviews")
def upsert_reviews(i: Inputs) -> DataFrame:
    """An upsert reads the batch twice (keys, rows), so the batch is written first."""
    existing, incoming = staged(i)
    return shown(upsert.upsert(existing, ingest.materialize(incoming, "batch"), "review_key"))


def staged_posts(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Posts as stored, and the same posts later: new scores, some authors gone."""
    landed = i.posts()
    gone = F.when(F.col("score") % 3 == 0, F.lit(None)).otherwise(F.col("author"))
    later = landed.select(
        *[c for c in landed.columns if c not in ("author", "score")],
        gone.alias("author"),
        (F.col("score") + 1000).alias("score"),
    )
    return (
        upsert.stage_posts(posts.post_pipeline(landed, language(), drop_low_signal=True)),
        upsert.stage_posts(posts.post_pipeline(later, language())),
    )


@query("upsert_posts")
def upsert_posts(i: Inputs) -> DataFrame:
    existing, incoming = staged_posts(i)
    return shown(upsert.upsert(existing, ingest.materialize(incoming, "batch"), "post_id"))


@query("affected_rows")
def affected_rows(i: Inputs) -> DataFrame:
    existing = upsert.stage_reviews(final_reviews(i))
    incoming = later_reviews(i).select(upsert.batch_review_key().alias("review_key"))
    return upsert.affected_rows(existing, incoming, "review_key")


# --- integrity ----------------------------------------------------------------------

query("check_single_community")(
    lambda i: integrity.check_communities(
        landing.scan_posts(i.posts()).select("subreddit_name", "subreddit_id")
        .unionByName(i.sql(STORED_COMMUNITIES).select(F.col("name").alias("subreddit_name"), "subreddit_id"))
    )
)
query("check_required_columns")(
    lambda i: columns.require_columns(
        landing.scan_posts(i.posts()), upsert.REQUIRED_POST_COLUMNS
    ).select(*upsert.REQUIRED_POST_COLUMNS).transform(shown)
)


def unchecked(i: Inputs, landed: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables as they would be without any filter, upsert or key."""
    raw = landing.typed_reviews(landing.scan_reviews(landed or i.reviews())).select(
        "*",
        upsert.batch_review_key().alias("review_key"),
        F.col("timestamp").alias("review_timestamp"),
        F.lit(REVIEW_PLATFORM).alias("source"),
        keys.user_id(F.lit(REVIEW_PLATFORM), F.col("userName")).alias("user_id"),
    )
    flat = landing.scan_posts(i.posts()).select(
        "*",
        F.lit(POST_PLATFORM).alias("source"),
        keys.user_id(
            F.lit(POST_PLATFORM), F.nullif(F.col("author"), F.lit(casts.DELETED))
        ).alias("user_id"),
    )
    return {
        "reviews": columns.align_schema(raw, REVIEWS),
        "posts": columns.align_schema(flat, POSTS),
        "communities": i.sql(STORED_COMMUNITIES),
        "users": columns.align_schema(first_users(i), USERS),
        "apps": columns.align_schema(app_names(i).withColumn("platform", F.lit(None)), APPS),
    }


query("check_domain")(lambda i: integrity.check_domain(unchecked(i)))


@query("check_unique")
def check_unique(i: Inputs) -> DataFrame:
    """Both batches appended to each other instead of merged."""
    tables = unchecked(i, i.reviews().unionByName(i.later_reviews()))
    claimed = upsert.stage_communities(landing.scan_posts(i.posts())).drop("arrival_seq")
    tables["communities"] = tables["communities"].unionByName(claimed)
    return integrity.check_unique(tables)


query("check_foreign_keys")(lambda i: integrity.check_foreign_keys(unchecked(i)))
query("defaults")(
    lambda i: columns.backfill_quality(i.reviews().select("arrival_seq")).select(
        "*", F.lit(REVIEW_PLATFORM).alias("platform"), F.lit(REVIEW_PLATFORM).alias("source")
    )
)

# --- reports ------------------------------------------------------------------------

query("overview")(lambda i: report.overview(final_reviews(i)))
query("language_distribution")(lambda i: report.language_distribution(final_reviews(i)))
query("reason_breakdown")(lambda i: report.reason_breakdown(final_reviews(i)))
query("quality_histogram")(lambda i: report.quality_histogram(final_reviews(i)))


def both_facts(i: Inputs) -> dict[str, tuple[DataFrame, str, str]]:
    return {
        "reviews": (final_reviews(i), "review_text", "arrival_seq"),
        "posts": (final_posts(i), "post_text", "arrival_seq"),
    }


query("worst_examples")(lambda i: report.examples(both_facts(i), 20, worst=True))
query("best_examples")(lambda i: report.examples(both_facts(i), 20, worst=False))


@query("full_report")
def full_report(i: Inputs) -> DataFrame:
    """Both facts, in the languages found in their texts."""
    found = detector(i)
    return report.full_report({
        "reviews": reviews.review_pipeline(i.reviews(), found),
        "posts": posts.post_pipeline(i.posts(), found),
    })


@query("batch_stats")
def batch_stats(i: Inputs) -> DataFrame:
    """Both stages of both kinds of batch; each is written once, and its totals are taken meanwhile."""
    found = None
    for name, cleaned, source, select in (
        ("reviews", clean(i), "app_id", reviews.select_reviews),
        ("posts", clean_posts(i), "subreddit_id", posts.select_posts),
    ):
        batch, totals = ingest.materialize_observed(cleaned, name, "after_clean")
        stages = {"after_clean": batch, "final": select(batch, **OPTIONS)}
        parts = [report.batch_stats(df, source, stage).withColumnRenamed(source, "source") for stage, df in stages.items()]
        for part in (*parts, totals):
            part = part.withColumn("table_name", F.lit(name))
            found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    return found


query("stage_comparison")(lambda i: reviews.review_stages(i.reviews(), language(), **OPTIONS))


# --- streaming ----------------------------------------------------------------------


# Every so many lines, one arrives cut off.
BROKEN_EVERY, BROKEN_CHARS = 7, 25


def ingested(i: Inputs) -> tuple[FeedbackStore, str]:
    """Two deliveries of JSON lines, some of them broken, ingested as they come: the store, and the quarantine."""
    base = new_workspace(i.spark, "stream")
    store = FeedbackStore(i.spark, f"{base}/store").initialize()
    arrivals = Arrivals(f"{base}/landing", f"{base}/checkpoint", "json", f"{base}/quarantine", max_files=1000)

    def apps_of(landed: DataFrame) -> DataFrame:
        return app_names(i).join(landed.select("app_id"), "app_id", "left_semi")

    found = detector(i)
    line = F.to_json(F.struct(*RAW_REVIEW.fieldNames()))
    cut = F.when(F.col("arrival_seq") % BROKEN_EVERY == 0, F.left("line", F.lit(BROKEN_CHARS))).otherwise(F.col("line"))
    for delivery in (i.reviews(), i.later_reviews()):
        delivery.withColumn("line", line).select(cut.alias("value")).write.mode("append").text(arrivals.landing)
        ingest_reviews(i.spark, arrivals, store, apps_of, found).awaitTermination()
    return store, arrivals.quarantine


query("incremental_ingest")(lambda i: stored(ingested(i)[0], "reviews", "users", "apps"))
query("incremental_quarantine")(
    lambda i: i.spark.read.parquet(ingested(i)[1]).select("batch_id", "reason", F.col(landing.CORRUPT).alias("line"))
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    return {name: bind(build) for name, build in REGISTRY.items()}
