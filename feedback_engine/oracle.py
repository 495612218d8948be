"""The same results in DuckDB SQL, to check the Spark queries against.

DuckDB's regex engine has neither back-references nor look-around, and no NFKC;
the fixtures stay within what it can express. Steps are common table
expressions, pulled in by name.
"""

from __future__ import annotations

from feedback_engine import fixtures as fx
from feedback_engine.functions import dispatch, quality
from feedback_engine.functions.text import (
    CONTRACTED_ENDINGS,
    CONTRACTED_WORDS,
    EMOJI,
    SMART_QUOTES,
)

# --- expressions --------------------------------------------------------------------

_WS = r"\s\x0b\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_W = r"\p{L}\p{N}_"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sub(expr: str, pattern: str, replacement: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(replacement)}, '{flags}')"


def quotes(e: str) -> str:
    return f"translate({e}, {lit(''.join(SMART_QUOTES))}, {lit(''.join(SMART_QUOTES.values()))})"


def urls(e: str) -> str:
    return sub(e, rf"(?:https?://|www\.)[^{_WS}]+", " ", "gi")


def emoji(e: str) -> str:
    tail = r"[\x{FE0F}\x{1F3FB}-\x{1F3FF}]*"
    one = rf"[{EMOJI}]{tail}"
    return sub(e, rf"[0-9#*]\x{{FE0F}}?\x{{20E3}}|{one}(?:\x{{200D}}{one})*", " ")


def non_text(e: str) -> str:
    return sub(e, rf"[^{_W}{_WS}!?,.'\-]", " ")


def squeeze(e: str) -> str:
    return f"trim({sub(e, rf'[{_WS}]+', ' ')})"


def clean(e: str) -> str:
    return squeeze(non_text(emoji(urls(quotes(f"coalesce({e}, '')")))))


def contractions(e: str) -> str:
    for word, full in CONTRACTED_WORDS:
        e = sub(e, rf"\b{word}\b", full, "gi")
    for ending, full in CONTRACTED_ENDINGS:
        e = sub(e, rf"([{_W}]+){ending}\b", rf"\1 {full}", "gi")
    return e


def letters(e: str) -> str:
    for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
        e = sub(e, f"{c}{{3,}}", c * 2)
    return e


def punctuation(e: str) -> str:
    for c in "!?.,":
        e = sub(e, f"[{c}]{{2,}}", c)
    return e


def normalize(e: str) -> str:
    return squeeze(punctuation(letters(contractions(e))))


def words(t: str) -> str:
    tokens = f"len(regexp_extract_all({t}, {lit(f'[^{_WS}]+')}))"
    cjk = rf"len(regexp_extract_all({t}, '[\x{{4e00}}-\x{{9fff}}]'))"
    return (
        f"CASE WHEN {cjk} > 0 AND {cjk}::DOUBLE / length({t}) > 0.3::DOUBLE "
        f"THEN greatest({tokens}, {cjk}) ELSE {tokens} END"
    )


def alpha(t: str) -> str:
    kept = sub(t, r"\P{L}+", "")
    return f"length({kept})::DOUBLE / greatest(length({t}), 1)"


def phrase(t: str) -> str:
    listed = ", ".join(lit(p) for p in quality.LOW_SIGNAL_PHRASES)
    return f"lower(trim({t}, ' .!?,-')) IN ({listed})"


def fixed(e: str, places: int) -> str:
    return f"CAST(printf('%.{places}f', {e}) AS DOUBLE)"


def key_of(t: str, ts: str = "timestamp", user: str = "userName") -> str:
    return f"sha256(app_id || '|' || {user} || '|' || {ts} || '|' || substring(trim({t}), 1, 100))"


def instant(e: str, day_first: str = "false") -> str:
    def form(shape: str, layout: str, text: str = e) -> str:
        return f"WHEN regexp_matches({e}, '{shape}') THEN try_strptime({text}, '{layout}') "

    return (
        f"strftime(CASE WHEN regexp_matches({e}, '[+]\\d\\d:\\d\\d$') "
        f"THEN make_timestamp(epoch_us(try_cast({e} AS TIMESTAMPTZ))) "
        + f"WHEN regexp_matches({e}, '^[0-9]+/[0-9]+/[0-9]{{4}}') AND {day_first} "
        f"THEN try_strptime({e}, '%d/%m/%Y %H:%M') "
        + form("^[0-9]+/[0-9]+/[0-9]{4}", "%m/%d/%Y %H:%M")
        + form("^[0-9]{4}/", "%Y/%m/%d %H:%M")
        + form("^[0-9]{8}$", "%Y%m%d")
        + form("^[A-Z][a-z]+ ", "%b %d, %Y")
        + form(" GMT$", "%d %b %Y %H:%M:%S", f"replace({e}, ' GMT', '')")
        + f"ELSE try_cast({e} AS TIMESTAMP) END, '%Y-%m-%d %H:%M:%S')"
    )


def rating(e: str) -> str:
    return f"CAST(trunc(try_cast({e} AS DOUBLE)) AS INTEGER)"


AUTHOR = "trim(coalesce(userName, 'Anonymous'))"
COMMUNITY = (
    "coalesce(nullif(subreddit_id, ''), nullif(fullname, ''), 't5_' || nullif(short_id, ''), '')"
)
LANG = "CASE WHEN length(t) < 20 THEN NULL ELSE lang_hint END AS language"
SCORE_BASE = f"least(1.0::DOUBLE, n_words / 20.0::DOUBLE) * 0.7::DOUBLE + alpha * 0.3::DOUBLE"
QUALITY_COLUMNS = (
    "cleaned_length, word_count, language, quality_score, is_low_signal, low_signal_reasons"
)

# --- common table expressions ---------------------------------------------------------

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql, needs)


def scored(name: str, source: str) -> None:
    """``source`` has the cleaned text as ``t``; adds the quality signals."""
    cte(f"{name}_sized", f"SELECT *, {words('t')} AS n_words, {alpha('t')} AS alpha FROM {source}",
        source)
    cte(
        f"{name}_reasoned",
        f"""SELECT *, CASE WHEN t = '' THEN 'empty' ELSE concat_ws(',',
          CASE WHEN length(t) < 10 THEN 'too_short' END,
          CASE WHEN n_words < 3 THEN 'too_few_words' END,
          CASE WHEN alpha < 0.3::DOUBLE THEN 'non_alphabetic' END,
          CASE WHEN {phrase('t')} THEN 'low_signal_phrase' END) END AS low_signal_reasons
        FROM {name}_sized""",
        f"{name}_sized",
    )
    discounted = fixed(f"({SCORE_BASE}) * 0.3::DOUBLE", 3)
    cte(
        name,
        f"""SELECT *, length(t) AS cleaned_length, n_words AS word_count,
          CASE WHEN low_signal_reasons <> '' THEN 1 ELSE 0 END AS is_low_signal,
          CASE WHEN low_signal_reasons <> '' THEN {discounted} ELSE {fixed(SCORE_BASE, 3)} END
            AS quality_score
        FROM {name}_reasoned""",
        f"{name}_reasoned",
    )


def final_steps(p: str) -> None:
    """First copies of the reviews of a batch, and the rows they are stored as."""
    cte(
        f"{p}final",
        f"""SELECT * FROM {p}reviews QUALIFY row_number() OVER
          (PARTITION BY app_id, userName, review_text ORDER BY arrival_seq) = 1""",
        f"{p}reviews",
    )
    cte(
        f"{p}staged",
        f"""SELECT review_key, app_id, sha256('apple|' || userName) AS user_id, rating, title,
          review_text, timestamp AS review_timestamp, 'apple' AS source, {QUALITY_COLUMNS}
        FROM {p}final QUALIFY row_number() OVER
          (PARTITION BY review_key ORDER BY arrival_seq DESC) = 1""",
        f"{p}final",
    )


def merged_steps(p: str) -> None:
    """What the store holds after two batches: reviews, their users and their apps."""
    cte(
        f"{p}merged_reviews",
        f"""SELECT * FROM {p}staged WHERE review_key NOT IN (SELECT review_key FROM {p}later_staged)
        UNION ALL SELECT * FROM {p}later_staged""",
        f"{p}staged", f"{p}later_staged",
    )
    cte(
        f"{p}stored_reviews",
        f"""SELECT 'reviews' AS table_name, * FROM {p}merged_reviews
        UNION ALL BY NAME SELECT DISTINCT 'users' AS table_name, sha256('apple|' || userName) AS user_id,
          userName AS username, 'apple' AS platform
          FROM (SELECT userName FROM {p}final UNION ALL SELECT userName FROM {p}later_final)
        UNION ALL BY NAME SELECT 'apps' AS table_name, app_id, app_name, 'apple' AS platform FROM app_names
          WHERE app_id IN (SELECT app_id FROM {p}final UNION ALL SELECT app_id FROM {p}later_final)
          QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY arrival_seq DESC) = 1""",
        f"{p}merged_reviews", f"{p}final", f"{p}later_final", "app_names",
    )


ASKED_REVIEWS = f"""SELECT * REPLACE ({fx.APP_NUMBER} AS app_id) FROM raw_reviews
  WHERE {fx.APP_NUMBER} IN (SELECT value FROM asked WHERE kind = '{dispatch.APP}')"""
for _p, _raw, *_needs in (
    ("", fx.RAW_REVIEWS), ("later_", fx.RAW_REVIEWS_LATER), ("asked_", ASKED_REVIEWS, "raw_reviews", "asked"),
):
    cte(f"{_p}raw_reviews", _raw, *_needs)
    cte(
        f"{_p}typed",
        f"""SELECT arrival_seq, app_id, {AUTHOR} AS userName, {rating('rating')} AS rating,
          coalesce(title, '') AS title, {instant('date')} AS timestamp, review AS review_text,
          lang_hint FROM {_p}raw_reviews""",
        f"{_p}raw_reviews",
    )
    cte(
        f"{_p}cleaned",
        f"""SELECT * EXCLUDE (title, review_text), {clean('title')} AS title,
          {normalize(clean('review_text'))} AS t FROM {_p}typed
        WHERE rating IS NOT NULL AND timestamp IS NOT NULL AND rating BETWEEN 1 AND 5""",
        f"{_p}typed",
    )
    scored(f"{_p}scored", f"{_p}cleaned")
    cte(
        f"{_p}reviews",
        f"""SELECT *, t AS review_text, {LANG}, {key_of('t')} AS review_key
        FROM {_p}scored WHERE t <> ''""",
        f"{_p}scored",
    )
    final_steps(_p)
# Every raw review assessed, without dropping any.
cte(
    "all_texts",
    f"SELECT arrival_seq, review, lang_hint, {normalize(clean('review'))} AS t FROM raw_reviews",
    "raw_reviews",
)
scored("assessed", "all_texts")



def final_post_steps(p: str) -> None:
    cte(
        f"{p}posts_dedup",
        f"""SELECT * FROM {p}posts QUALIFY row_number() OVER
          (PARTITION BY subreddit_id, author, title, post_text ORDER BY arrival_seq) = 1""",
        f"{p}posts",
    )
    cte(
        f"{p}final_posts",
        f"SELECT * FROM {p}posts_dedup WHERE title <> '' OR post_text <> ''",
        f"{p}posts_dedup",
    )


cte("raw_posts", fx.RAW_POSTS)
cte(
    "later_raw_posts",
    """SELECT * REPLACE (score + 1000 AS score,
      CASE WHEN score % 3 = 0 THEN NULL ELSE author END AS author)
    FROM raw_posts""",
    "raw_posts",
)
_ASKED_IDS = f"(SELECT value FROM asked WHERE kind = '{dispatch.POST}')"
_ASKED_NAMES = f"(SELECT value FROM asked WHERE kind = '{dispatch.COMMUNITY}')"
cte(
    "asked_raw_posts",
    f"""SELECT * REPLACE ({fx.PLAIN_POST_ID} AS id) FROM raw_posts
    WHERE {fx.PLAIN_POST_ID} IN {_ASKED_IDS} OR lower(display_name) IN {_ASKED_NAMES}""",
    "raw_posts", "asked",
)
for _p in ("", "later_", "asked_"):
    cte(
        f"{_p}flat_posts",
        f"""SELECT arrival_seq, id AS post_id, lower(display_name) AS subreddit_name,
          {COMMUNITY} AS subreddit_id, coalesce(nullif(author, ''), '[deleted]') AS author,
          coalesce(title, '') AS title, coalesce(selftext, '') AS post_text, score, num_comments,
          strftime(make_timestamp(CAST(floor(created_utc) AS BIGINT) * 1000000),
            '%Y-%m-%d %H:%M:%S') AS timestamp,
          coalesce(link_flair_text, '') AS flair, url AS post_url, lang_hint FROM {_p}raw_posts""",
        f"{_p}raw_posts",
    )
    cte(
        f"{_p}cleaned_posts",
        f"""SELECT * EXCLUDE (title, post_text), {clean('title')} AS title,
          {normalize(clean('post_text'))} AS t FROM {_p}flat_posts""",
        f"{_p}flat_posts",
    )
    scored(f"{_p}scored_posts", f"{_p}cleaned_posts")
    cte(f"{_p}posts", f"SELECT *, t AS post_text, {LANG} FROM {_p}scored_posts", f"{_p}scored_posts")
    final_post_steps(_p)
    cte(
        f"{_p}staged_posts",
        f"""SELECT post_id, subreddit_id,
          CASE WHEN author <> '[deleted]' THEN sha256('reddit|' || author) END AS user_id, title,
          post_text, score, num_comments, timestamp AS created_timestamp, flair, post_url,
          'reddit' AS source, {QUALITY_COLUMNS}, title AS headline FROM {_p}final_posts""",
        f"{_p}final_posts",
    )
# Posts asked for by id are no copies of others.
cte(
    "asked_final_posts",
    f"""SELECT * FROM asked_posts WHERE (title <> '' OR post_text <> '') AND (post_id IN {_ASKED_IDS}
      OR arrival_seq IN (SELECT arrival_seq FROM asked_posts_dedup WHERE subreddit_name IN {_ASKED_NAMES}))""",
    "asked_posts", "asked_posts_dedup", "asked",
)
_forms = [
    f"nullif(regexp_extract(input, {lit(form)}, 1), '') AS v{n}"
    for n, (_, form) in enumerate(dispatch.RULES)
]
_kinds = " ".join(f"WHEN v{n} IS NOT NULL THEN '{k}'" for n, (k, _) in enumerate(dispatch.RULES))


def classified_steps(inputs: str, sql: str, folded: str, matched: str, classified: str) -> None:
    cte(inputs, sql)
    cte(
        folded,
        rf"SELECT page_id, lower(regexp_replace(input, '^\s+|\s+$', '', 'g')) AS input FROM {inputs}",
        inputs,
    )
    cte(matched, f"SELECT page_id, {', '.join(_forms)} FROM {folded}", folded)
    cte(
        classified,
        f"SELECT page_id, CASE {_kinds} END AS kind, coalesce(v0, v1, v2, v3, v4) AS value FROM {matched}",
        matched,
    )


classified_steps("source_inputs", fx.SOURCE_INPUTS, "folded", "matched", "classified")
classified_steps("requests", fx.REQUESTS, "folded_requests", "matched_requests", "asked")
cte("app_details", fx.APP_DETAILS)
cte(
    "app_names",
    """SELECT app_id, coalesce(nullif(app_name, ''), nullif(name, ''), 'AppId_' || app_id)
      AS app_name, CASE WHEN name IS NULL THEN 0 ELSE 1 END AS arrival_seq FROM app_details""",
    "app_details",
)
cte("stored_communities", fx.STORED_COMMUNITIES)
merged_steps("")
# What the store's users hold after the first batch of reviews.
cte(
    "first_users",
    """SELECT DISTINCT sha256('apple|' || userName) AS user_id, userName AS username,
      'apple' AS platform FROM final""",
    "final",
)
for _p, _typed in (("", "typed"), ("later_", "later_typed")):
    cte(
        f"{_p}unchecked",
        f"""SELECT *, {key_of("coalesce(review_text, '')", "coalesce(timestamp, '')")} AS key_full,
          sha256('apple|' || userName) AS user_id FROM {_typed}""",
        _typed,
    )
    # Nulls count as empty in the key.
    cte(
        f"{_p}unchecked_reviews",
        f"SELECT * RENAME (key_full AS review_key) FROM {_p}unchecked",
        f"{_p}unchecked",
    )
cte(
    "labelled",
    f"SELECT doc_id, lang, {normalize(clean('text'))} AS cleaned FROM documents",
)
cte("chars", "SELECT lang, string_split(lower(cleaned), '') AS l FROM labelled", "labelled")
cte(
    "gram_counts",
    """SELECT lang, gram, count(*) AS n FROM (SELECT lang, unnest(list_transform(
      generate_series(1, len(l) - 2), lambda i: l[i] || l[i + 1] || l[i + 2])) AS gram FROM chars)
    GROUP BY ALL""",
    "chars",
)
cte(
    "profile",
    """SELECT lang, gram, n,
      CAST(round(ln((n + 1)::DOUBLE / mass) * 1000.0::DOUBLE) AS BIGINT) AS logp,
      CAST(round(ln(1.0::DOUBLE / mass) * 1000.0::DOUBLE) AS BIGINT) AS floor
    FROM gram_counts
    JOIN (SELECT lang, CAST(sum(n) + count(*) AS BIGINT) AS mass FROM gram_counts GROUP BY lang)
      USING (lang)""",
    "gram_counts",
)


def detection_steps(name: str, texts: str, *needs: str) -> None:
    """(id, language) of ``texts`` (id, cleaned) that hold a trigram of the profile."""
    cte(f"{name}_texts", f"SELECT id, string_split(lower(cleaned), '') AS l FROM ({texts})", *needs)
    cte(
        f"{name}_grams",
        f"""SELECT id, gram, count(*) AS times FROM (SELECT id, unnest(list_transform(
          generate_series(1, len(l) - 2), lambda i: l[i] || l[i + 1] || l[i + 2])) AS gram
          FROM {name}_texts WHERE len(l) >= 20) GROUP BY ALL""",
        f"{name}_texts",
    )
    cte(
        f"{name}_scores",
        f"""SELECT g.id, p.lang, sum(times * (logp - p.floor)) + any_value(total * p.floor) AS score
        FROM {name}_grams g JOIN profile p USING (gram)
        JOIN (SELECT id, sum(times) AS total FROM {name}_grams GROUP BY id) USING (id) GROUP BY ALL""",
        f"{name}_grams", "profile",
    )
    cte(name, f"SELECT id, arg_min(lang, (-score, lang)) AS language FROM {name}_scores GROUP BY id", f"{name}_scores")


detection_steps("lang", f"""SELECT id, {normalize(clean('text'))} AS cleaned FROM (
  SELECT doc_id AS id, text FROM documents
  UNION ALL SELECT conv_id * -1000 - turn - 1, text FROM conversations)""")


def detected(p: str, name: str) -> str:
    """The rows of a step with the language found in their texts."""
    return (f"SELECT r.* REPLACE (d.language AS language) FROM {p}{name} r "
            f"LEFT JOIN {p}{name}_language d ON d.id = r.arrival_seq")


# The same batches with languages found instead of given ("d"), and of those the lines that arrive whole ("l").
for _p, _name, _finish in (("", "reviews", final_steps), ("later_", "reviews", final_steps), ("", "posts", final_post_steps)):
    detection_steps(f"{_p}{_name}_language", f"SELECT arrival_seq AS id, t AS cleaned FROM {_p}{_name}", f"{_p}{_name}")
    cte(f"d_{_p}{_name}", detected(_p, _name), f"{_p}{_name}", f"{_p}{_name}_language")
    _finish(f"d_{_p}")
for _p in ("", "later_"):
    cte(f"l_{_p}reviews", f"SELECT * FROM d_{_p}reviews WHERE arrival_seq % 7 <> 0", f"d_{_p}reviews")
    final_steps(f"l_{_p}")
merged_steps("d_")
merged_steps("l_")

# The optional filters as set in the query catalogue.
KEEP = "(language IS NULL OR lower(language) IN ('en', 'de', 'zh-cn'))"
SCORE_OK = "coalesce(quality_score >= 0.3::DOUBLE, false)"
SIGNAL_OK = "is_low_signal = 0"
POST_SIGNAL_OK = "(is_low_signal = 0 OR length(title) >= 10)"


def average_score() -> str:
    total = "sum(CAST(round(quality_score * 1000) AS BIGINT))::DOUBLE / 1000.0::DOUBLE"
    return f"{total} / count(quality_score)"


AVG_Q = fixed(average_score(), 3)
AVG_LEN = fixed("sum(cleaned_length)::DOUBLE / count(cleaned_length)", 1)
AVG_WORDS = fixed("sum(word_count)::DOUBLE / count(word_count)", 1)
LABEL = (
    "CASE WHEN bucket < 10 THEN printf('[%.1f - %.1f)', bucket / 10.0::DOUBLE, "
    "(bucket + 1) / 10.0::DOUBLE) ELSE '[1.0]' END"
)

# --- queries ---------------------------------------------------------------------------

ORACLE: dict[str, str] = {}


def oracle(name: str, select: str, *needs: str) -> None:
    order: list[str] = []

    def visit(step: str) -> None:
        for earlier in CTES[step][1]:
            visit(earlier)
        if step not in order:
            order.append(step)

    for step in needs:
        visit(step)
    steps = ", ".join(f"{s} AS MATERIALIZED ({CTES[s][0]})" for s in order)
    ORACLE[name] = (f"WITH {steps} " if order else "") + select


def text_oracle(name: str, source: str, rule) -> None:
    ORACLE[name] = f"SELECT doc_id, {rule('c')} AS out FROM (SELECT doc_id, {source} AS c FROM documents)"


oracle("scan_reviews", """SELECT arrival_seq, app_id, userName, rating, title, date AS timestamp,
  review AS review_text FROM raw_reviews""", "raw_reviews")
oracle("scan_posts", "SELECT * EXCLUDE (lang_hint) FROM flat_posts", "flat_posts")
POST_OUT = f"""arrival_seq, post_id, subreddit_name, subreddit_id, author, title, post_text, score,
  num_comments, timestamp, flair, post_url, {QUALITY_COLUMNS}"""
oracle("scan_post_by_id", f"SELECT {POST_OUT} FROM posts WHERE post_id = '1_1' "
       "AND (title <> '' OR post_text <> '')", "posts")
oracle("bounded_fetch", """SELECT app_id, arrival_seq FROM raw_reviews QUALIFY row_number() OVER
  (PARTITION BY app_id ORDER BY arrival_seq) <= 5
  UNION ALL (SELECT lang_hint, arrival_seq FROM raw_reviews QUALIFY row_number() OVER
  (PARTITION BY lang_hint ORDER BY arrival_seq) <= 1200)""", "raw_reviews")
oracle("resolve_app_name", "SELECT app_id, app_name AS resolved FROM app_names", "app_names")
oracle("sink_reviews", "SELECT * FROM d_stored_reviews", "d_stored_reviews")
oracle("sink_posts", """SELECT 'posts' AS table_name, * EXCLUDE (headline) FROM staged_posts
  UNION ALL BY NAME SELECT DISTINCT 'users' AS table_name, sha256('reddit|' || author) AS user_id,
    author AS username, 'reddit' AS platform FROM final_posts WHERE author <> '[deleted]'
  UNION ALL BY NAME SELECT DISTINCT 'communities' AS table_name, subreddit_id, subreddit_name AS name
    FROM final_posts""", "staged_posts", "final_posts")
oracle("scan_store", """SELECT review_key AS id, language, quality_score, is_low_signal
  FROM merged_reviews UNION ALL SELECT post_id, language, quality_score, is_low_signal
  FROM staged_posts""", "merged_reviews", "staged_posts")
oracle("partial_batch", """SELECT CASE WHEN arrival_seq % 7 = 0 THEN '(quarantined)' ELSE app_id END
  AS app_id, count(*) AS n,
  sum(CASE WHEN arrival_seq % 7 = 0 THEN 25 ELSE length(review) END) AS chars
  FROM raw_reviews GROUP BY 1""", "raw_reviews")

oracle("cast_rating", f"SELECT arrival_seq, {rating('rating')} AS rating FROM raw_reviews",
       "raw_reviews")
_FIRST, _SECOND = (f"CAST(nullif(regexp_extract(date, '^([0-9]{{1,2}})/([0-9]{{1,2}})/[0-9]{{4}}', {k}), '') AS INTEGER)" for k in (1, 2))
cte("date_votes", f"""SELECT app_id, sum(CASE WHEN {_FIRST} > 12 AND {_SECOND} <= 12 THEN 1
  WHEN {_FIRST} <= 12 AND {_SECOND} > 12 THEN -1 ELSE 0 END) > 0 AS day_first
  FROM raw_reviews GROUP BY app_id""", "raw_reviews")
oracle("parse_timestamp_utc", f"""SELECT arrival_seq, {instant('date', 'day_first')} AS timestamp
  FROM raw_reviews JOIN date_votes USING (app_id)""", "raw_reviews", "date_votes")
oracle("epoch_to_timestamp", "SELECT post_id AS id, timestamp FROM flat_posts", "flat_posts")
oracle("author_default", f"SELECT arrival_seq, {AUTHOR} AS author FROM raw_reviews", "raw_reviews")
oracle("author_deleted", "SELECT post_id AS id, author FROM flat_posts", "flat_posts")
oracle("community_id_fallback", "SELECT post_id, subreddit_id, subreddit_name FROM flat_posts",
       "flat_posts")
oracle("null_defaults", "SELECT post_id, title, flair, post_text, score, num_comments FROM flat_posts",
       "flat_posts")
oracle("attach_quality", f"SELECT arrival_seq, t AS review_text, cleaned_length, word_count, {LANG}, "
       "quality_score, is_low_signal, low_signal_reasons FROM assessed", "assessed")
oracle("align_schema", """SELECT post_id, subreddit_id, NULL AS user_id, title, post_text, score,
  num_comments, NULL AS created_timestamp, flair, post_url, NULL AS source,
  NULL AS cleaned_length, length(title) AS word_count, NULL AS language, NULL AS quality_score,
  0 AS is_low_signal, NULL AS low_signal_reasons FROM flat_posts""", "flat_posts")
oracle("evolve_schema", """SELECT review_key, rating, NULL AS cleaned_length, NULL AS word_count,
  NULL AS language, NULL AS quality_score, 0 AS is_low_signal, NULL AS low_signal_reasons
  FROM staged""", "staged")

oracle("filter_required", """SELECT arrival_seq, rating FROM typed
  WHERE rating IS NOT NULL AND timestamp IS NOT NULL""", "typed")
oracle("filter_rating_range", "SELECT arrival_seq, rating FROM typed WHERE rating BETWEEN 1 AND 5",
       "typed")
oracle("filter_empty_review", "SELECT arrival_seq, length(t) AS char_length FROM all_texts WHERE t <> ''",
       "all_texts")
oracle("filter_empty_post", "SELECT post_id, title FROM posts WHERE title <> '' OR post_text <> ''",
       "posts")
oracle("filter_language", f"SELECT arrival_seq, language FROM d_reviews WHERE {KEEP}", "d_reviews")
oracle("filter_min_quality", f"SELECT arrival_seq, quality_score FROM reviews WHERE {SCORE_OK}",
       "reviews")
oracle("filter_low_signal_reviews",
       f"SELECT arrival_seq, low_signal_reasons FROM reviews WHERE {SIGNAL_OK}", "reviews")
oracle("filter_low_signal_posts",
       f"SELECT post_id, title, is_low_signal FROM posts WHERE {POST_SIGNAL_OK}", "posts")
oracle("filter_pipeline", f"""SELECT 'reviews' AS table_name, arrival_seq, review_text AS body
  FROM final WHERE {KEEP} AND {SCORE_OK} AND {SIGNAL_OK}
  UNION ALL SELECT 'posts', arrival_seq, post_text FROM final_posts
  WHERE {KEEP} AND {SCORE_OK} AND {POST_SIGNAL_OK}""", "final", "final_posts")
ORACLE["parse_language_list"] = """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang || '|zh'
  ELSE lang || '|zh|' || source END AS codes FROM documents"""

text_oracle("fold_smart_quotes", "'“It’s” ‘fine’ ‚‛„‟′″ ' || text", quotes)
text_oracle("strip_urls",
            "'Visit HTTPS://shop.example.com/a?b=1 http: www. ' || text || ' WWW.x.example/y'", urls)
text_oracle("strip_emoji", "'👍🏽 1️⃣ ™ 👩‍💻 2 ' || text || ' ❤️😀'", emoji)
# The documents are in NFKC form already: undoing the widening must restore them.
ORACLE["nfkc_normalize"] = "SELECT doc_id, 'fi...1 ' || text AS out FROM documents"
text_oracle("strip_non_text", "'a\"b—c (d) ' || text", non_text)
text_oracle("squeeze_whitespace", "' \t a \n\n b  ' || text || '  '", squeeze)
DECORATED = (
    "'Visit https://shop.example.com/a?b=1 It’s “fine”, don''t goooo!!! ' || text || ' 😀👍🏽 1️⃣ ™'"
)
text_oracle("clean_text", DECORATED, clean)
text_oracle("expand_contractions", "'don''t won''t CAN''T shan''t you''re I''ve he''ll I''d I''m it''s "
            "WON''T DON''T ' || text", contractions)
text_oracle("collapse_letters", "'goooood AAaa zzz ' || text || ' mmm'", letters)
text_oracle("collapse_punctuation", "'!!!! ?!?! ok... ' || text || '!!,,'", punctuation)
text_oracle("normalize_text", "'I can''t   goooo!!! ' || text || ' '", normalize)
cte("decorated", f"SELECT doc_id, {normalize(clean(DECORATED))} AS t FROM documents")
scored("decorated_scored", "decorated")
oracle("preprocess_text", """SELECT doc_id, t AS cleaned_text, cleaned_length AS char_length, word_count,
  is_low_signal, quality_score, low_signal_reasons FROM decorated_scored""", "decorated_scored")

oracle("char_length", "SELECT arrival_seq, cleaned_length AS char_length FROM assessed", "assessed")
for _name in ("low_signal_reasons", "is_low_signal", "quality_score", "alpha"):
    oracle(_name, f"SELECT arrival_seq, {_name} FROM assessed", "assessed")
ORACLE["alpha_ratio"] = ORACLE.pop("alpha")
oracle("word_count", f"SELECT arrival_seq, {words('t')} AS word_count "
       "FROM (SELECT arrival_seq, coalesce(review, '') AS t FROM raw_reviews)", "raw_reviews")
oracle("low_signal_phrase", f"SELECT arrival_seq, CASE WHEN {phrase('t')} THEN 1 ELSE 0 END "
       "AS is_phrase FROM all_texts", "all_texts")
oracle("langid_train", "SELECT * FROM profile", "profile")
oracle("langid_score", "SELECT id, language FROM lang_texts LEFT JOIN lang USING (id)", "lang_texts", "lang")

for _n, _name in enumerate(("src_app_url", "src_app_id", "src_post_url", "src_community_url",
                            "src_community_name")):
    oracle(_name, f"SELECT page_id, v{_n} AS value FROM matched", "matched")
oracle("classify_source", "SELECT page_id, kind, value FROM classified", "classified")
oracle("route_by_source", """SELECT kind AS pipeline, page_id, value FROM classified
  WHERE kind IS NOT NULL""", "classified")

oracle("routed_ingest", f"""SELECT 'reviews' AS table_name, * FROM asked_staged
  UNION ALL BY NAME SELECT 'posts' AS table_name, * EXCLUDE (headline) FROM asked_staged_posts
  UNION ALL BY NAME SELECT DISTINCT 'users' AS table_name, sha256('apple|' || userName) AS user_id,
    userName AS username, 'apple' AS platform FROM asked_final
  UNION ALL BY NAME SELECT DISTINCT 'users' AS table_name, sha256('reddit|' || author) AS user_id,
    author AS username, 'reddit' AS platform FROM asked_final_posts WHERE author <> '[deleted]'
  UNION ALL BY NAME SELECT 'apps' AS table_name, {fx.APP_NUMBER} AS app_id, app_name, 'apple' AS platform FROM app_names
    WHERE {fx.APP_NUMBER} IN (SELECT app_id FROM asked_final)
    QUALIFY row_number() OVER (PARTITION BY app_names.app_id ORDER BY arrival_seq DESC) = 1
  UNION ALL BY NAME SELECT DISTINCT 'communities' AS table_name, subreddit_id, subreddit_name AS name
    FROM asked_final_posts""",
  "asked_staged", "asked_staged_posts", "asked_final", "asked_final_posts", "app_names")

oracle("review_key", "SELECT arrival_seq, review_key FROM reviews", "reviews")
oracle("dedup_reviews", "SELECT arrival_seq, app_id, userName, review_text FROM final", "final")
oracle("dedup_posts", "SELECT arrival_seq, subreddit_id, author, title, post_text FROM posts_dedup",
       "posts_dedup")
oracle("dedup_counts", """SELECT app_id, count(*) AS rows_after_clean, count(*) -
  count(DISTINCT (userName, review_text)) AS duplicates_removed FROM reviews GROUP BY app_id""",
       "reviews")
_EMPTY_OK = "(title <> '' OR post_text <> '')"
oracle("dropped_counts", f"""SELECT subreddit_id, any_value(n) AS rows_after_clean,
  any_value(n) - count(*) AS duplicates_removed,
  count_if(NOT {_EMPTY_OK}) AS dropped_empty,
  count_if({_EMPTY_OK} AND NOT {KEEP}) AS dropped_language,
  count_if({_EMPTY_OK} AND {KEEP} AND NOT {SCORE_OK}) AS dropped_min_quality,
  count_if({_EMPTY_OK} AND {KEEP} AND {SCORE_OK} AND NOT {POST_SIGNAL_OK}) AS dropped_low_signal,
  count_if({_EMPTY_OK} AND {KEEP} AND {SCORE_OK} AND {POST_SIGNAL_OK}) AS rows_final
  FROM posts_dedup JOIN (SELECT subreddit_id, count(*) AS n FROM posts GROUP BY 1)
  USING (subreddit_id) GROUP BY subreddit_id""", "posts_dedup")
oracle("latest_per_key", """SELECT review_key, arrival_seq, rating FROM (
  SELECT review_key, arrival_seq, rating FROM reviews
  UNION ALL SELECT review_key, arrival_seq, rating FROM later_reviews)
  QUALIFY row_number() OVER (PARTITION BY review_key ORDER BY arrival_seq DESC) = 1""",
       "reviews", "later_reviews")

oracle("upsert_apps", """SELECT app_id, coalesce(n.app_name, 'AppId_' || app_id) AS app_name,
  'apple' AS platform FROM (SELECT DISTINCT app_id FROM app_details) LEFT JOIN (
    SELECT app_id, app_name FROM app_names QUALIFY row_number() OVER
    (PARTITION BY app_id ORDER BY arrival_seq DESC) = 1) n USING (app_id)""", "app_names")
oracle("insert_new_users", """SELECT * FROM first_users
  UNION SELECT sha256('apple|' || userName), userName, 'apple' FROM later_final
  UNION SELECT sha256('reddit|' || author), author, 'reddit' FROM final_posts
  WHERE author <> '[deleted]'""", "first_users", "later_final", "final_posts")
oracle("insert_new_communities", """SELECT * FROM stored_communities UNION ALL
  SELECT DISTINCT subreddit_id, subreddit_name FROM flat_posts
  WHERE subreddit_id NOT IN (SELECT subreddit_id FROM stored_communities)
  AND subreddit_name NOT IN (SELECT name FROM stored_communities)""",
       "stored_communities", "flat_posts")
oracle("lookup_user_id", """SELECT f.arrival_seq, f.username, u.user_id FROM (
  SELECT arrival_seq, userName AS username, 'apple' AS platform FROM later_typed
  UNION ALL SELECT arrival_seq, author, 'reddit' FROM raw_posts) f
  LEFT JOIN first_users u ON f.username = u.username AND f.platform = u.platform""",
       "later_typed", "raw_posts", "first_users")
oracle("upsert_reviews", "SELECT * FROM merged_reviews", "merged_reviews")
oracle("upsert_posts", f"""SELECT * EXCLUDE (headline) FROM (
  SELECT * FROM staged_posts WHERE {POST_SIGNAL_OK}
  AND post_id NOT IN (SELECT post_id FROM later_staged_posts)
  UNION ALL SELECT * FROM later_staged_posts)""", "staged_posts", "later_staged_posts")
oracle("affected_rows", """SELECT count(*) AS affected, count(DISTINCT review_key) FILTER
  (WHERE review_key NOT IN (SELECT review_key FROM staged)) AS inserted,
  count(*) - count(DISTINCT review_key) FILTER
  (WHERE review_key NOT IN (SELECT review_key FROM staged)) AS updated FROM later_final""",
       "later_final", "staged")

oracle("check_single_community", """WITH pairs AS (
  SELECT name, id, count(*) AS n FROM (SELECT subreddit_name AS name, subreddit_id AS id
    FROM flat_posts UNION ALL SELECT name, subreddit_id FROM stored_communities) GROUP BY ALL),
  per_id AS (SELECT id, count(*) AS names FROM pairs GROUP BY id)
  SELECT name, count(*) AS n_ids, max(names) AS max_names_per_id,
    count_if(trim(coalesce(id, '')) = '') AS blank_ids, sum(n) AS n_rows,
    CASE WHEN count(*) = 1 AND max(names) = 1 AND count_if(trim(coalesce(id, '')) = '') = 0
      THEN 1 ELSE 0 END AS is_valid FROM pairs JOIN per_id USING (id) GROUP BY name""".replace(
    "WITH pairs", "SELECT * FROM (WITH pairs") + ")", "flat_posts", "stored_communities")
oracle("check_required_columns", """SELECT post_id, subreddit_id, subreddit_name, author, title,
  post_text, score, num_comments, timestamp, flair, post_url FROM flat_posts""", "flat_posts")
_RULES = {
    "reviews": ("unchecked_reviews", {
        "review_key is null": "review_key IS NULL", "app_id is null": "app_id IS NULL",
        "review_text is null": "review_text IS NULL", "source is null": "false",
        "rating out of range": "NOT (rating BETWEEN 1 AND 5)"}),
    "posts": ("flat_posts", {
        "post_id is null": "post_id IS NULL", "subreddit_id is null": "subreddit_id IS NULL",
        "source is null": "false"}),
    "communities": ("stored_communities", {
        "subreddit_id is null": "subreddit_id IS NULL", "name is null": "name IS NULL"}),
    "users": ("first_users", {
        "username is null": "username IS NULL", "platform is null": "platform IS NULL"}),
    "apps": ("app_names", {
        "app_id is null": "app_id IS NULL", "app_name is null": "app_name IS NULL",
        "platform is null": "true"}),
}
oracle("check_domain", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{label}' AS rule, count_if({test}) AS violations FROM {src}"
    for t, (src, rules) in _RULES.items() for label, test in rules.items()),
    *[src for src, _ in _RULES.values()])


def _repeated(table: str, key: str, value: str, source: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{key}' AS key_name, {value} AS key_value, "
            f"count(*) AS n FROM {source} GROUP BY {value} HAVING count(*) > 1")


_CLAIMED = """(SELECT subreddit_id, name FROM stored_communities UNION ALL
  SELECT DISTINCT subreddit_id, subreddit_name FROM flat_posts)"""
oracle("check_unique", " UNION ALL ".join([
    _repeated("reviews", "review_key", "review_key", "(SELECT review_key FROM unchecked_reviews "
              "UNION ALL SELECT review_key FROM later_unchecked_reviews)"),
    _repeated("posts", "post_id", "post_id", "flat_posts"),
    _repeated("communities", "subreddit_id", "subreddit_id", _CLAIMED),
    _repeated("communities", "name", "name", _CLAIMED),
    _repeated("users", "username,platform", "username || '|' || platform", "first_users"),
    _repeated("apps", "app_id", "app_id", "app_names"),
]), "unchecked_reviews", "later_unchecked_reviews", "flat_posts", "stored_communities",
    "first_users", "app_names")
_POST_USERS = """(SELECT CASE WHEN author <> '[deleted]' THEN sha256('reddit|' || author) END
  AS user_id FROM flat_posts)"""


def _orphans(table: str, column: str, source: str, parent: str, key: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, {column} AS value, "
            f"count(*) AS n FROM {source} WHERE {column} NOT IN (SELECT {key} FROM {parent}) "
            f"GROUP BY {column}")


oracle("check_foreign_keys", " UNION ALL ".join([
    _orphans("reviews", "app_id", "unchecked_reviews", "app_names", "app_id"),
    _orphans("reviews", "user_id", "unchecked_reviews", "first_users", "user_id"),
    _orphans("posts", "subreddit_id", "flat_posts", "stored_communities", "subreddit_id"),
    _orphans("posts", "user_id", _POST_USERS, "first_users", "user_id"),
]), "unchecked_reviews", "app_names", "first_users", "flat_posts", "stored_communities")
oracle("defaults", """SELECT arrival_seq, NULL AS cleaned_length, NULL AS word_count, NULL AS language,
  NULL AS quality_score, 0 AS is_low_signal, NULL AS low_signal_reasons, 'apple' AS platform,
  'apple' AS source FROM raw_reviews""", "raw_reviews")

_LOW = "count_if(is_low_signal = 1)"
_LOW_PCT = fixed(f"{_LOW}::DOUBLE / count(*) * 100", 1)
OVERVIEW = f"""count(*) AS n_rows, {_LOW} AS low_signal_rows,
  {_LOW_PCT} AS low_signal_pct, {AVG_Q} AS avg_quality,
  {AVG_LEN} AS avg_length, {AVG_WORDS} AS avg_words"""
oracle("overview", f"SELECT {OVERVIEW} FROM final", "final")
oracle("language_distribution", f"""SELECT coalesce(language, 'unknown') AS lang, count(*) AS n,
  {AVG_Q} AS avg_q FROM final GROUP BY 1 ORDER BY n DESC, lang LIMIT 10""", "final")
_REASON = "coalesce(nullif(low_signal_reasons, ''), '(clean)')"
oracle("reason_breakdown", f"""SELECT {_REASON} AS reason, count(*) AS n FROM final
  WHERE is_low_signal = 1 GROUP BY 1 ORDER BY n DESC, reason LIMIT 10""", "final")
_BUCKET = "CAST(trunc(quality_score * 10) AS INTEGER)"
oracle("quality_histogram", f"""SELECT {LABEL} AS score_range, n FROM (
  SELECT {_BUCKET} AS bucket, count(*) AS n FROM final WHERE quality_score IS NOT NULL
  GROUP BY 1)""", "final")


def _examples(shown: str, low: int, order: str) -> str:
    return " UNION ALL ".join(
        f"""(SELECT '{name}' AS table_name, arrival_seq AS id, quality_score, {shown},
          substring({text}, 1, 120) AS preview FROM {step} WHERE is_low_signal = {low}
          ORDER BY quality_score {order}, arrival_seq LIMIT 20)"""
        for name, step, text in (("reviews", "final", "review_text"), ("posts", "final_posts", "post_text"))
    )


oracle("worst_examples", _examples("low_signal_reasons", 1, "ASC"), "final", "final_posts")
oracle("best_examples", _examples("language", 0, "DESC"), "final", "final_posts")
cte("facts", "SELECT 'reviews' AS table_name, " + QUALITY_COLUMNS + """ FROM d_final
  UNION ALL SELECT 'posts', """ + QUALITY_COLUMNS + " FROM d_final_posts", "d_final", "d_final_posts")
_TOP = "QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY n DESC, group_name) <= 10"
oracle("full_report", f"""SELECT table_name, 'overview' AS section, 'all' AS group_name,
    count(*) AS n, {_LOW} AS low_signal_rows, {_LOW_PCT} AS low_signal_pct, {AVG_Q} AS avg_quality,
    {AVG_LEN} AS avg_length, {AVG_WORDS} AS avg_words FROM facts GROUP BY table_name
  UNION ALL (SELECT table_name, 'language', coalesce(language, 'unknown') AS group_name,
    count(*) AS n, NULL, NULL, {AVG_Q}, NULL, NULL FROM facts GROUP BY table_name, group_name {_TOP})
  UNION ALL (SELECT table_name, 'reason', {_REASON} AS group_name, count(*) AS n, NULL, NULL, NULL, NULL,
    NULL FROM facts WHERE is_low_signal = 1 GROUP BY table_name, group_name {_TOP})
  UNION ALL SELECT table_name, 'histogram', {LABEL}, n, NULL, NULL, NULL, NULL, NULL FROM (
    SELECT table_name, {_BUCKET} AS bucket, count(*) AS n FROM facts
    WHERE quality_score IS NOT NULL GROUP BY ALL)""", "facts")


def _stats(table: str, stage: str, step: str, source: str) -> str:
    return f"""SELECT '{table}' AS table_name, source, '{stage}' AS stage, n_rows, low_signal_rows, avg_quality, langs FROM (
      SELECT {source} AS source, count(*) AS n_rows, {_LOW} AS low_signal_rows, {AVG_Q} AS avg_quality
      FROM {step} GROUP BY 1) JOIN (
      SELECT source, string_agg(lang || '=' || n, ', ' ORDER BY n DESC, lang) AS langs FROM (
        SELECT {source} AS source, coalesce(language, 'unknown') AS lang, count(*) AS n FROM {step}
        GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY {source} ORDER BY n DESC, lang) <= 5)
      GROUP BY source) USING (source)"""


def _totals(table: str, step: str) -> str:
    return (f"SELECT '{table}' AS table_name, NULL AS source, 'after_clean' AS stage, count(*) AS n_rows, "
            f"{_LOW} AS low_signal_rows, {AVG_Q} AS avg_quality, NULL AS langs FROM {step}")


cte("filtered", f"SELECT * FROM final WHERE {KEEP} AND {SCORE_OK} AND {SIGNAL_OK}", "final")
cte("filtered_posts", f"SELECT * FROM final_posts WHERE {KEEP} AND {SCORE_OK} AND {POST_SIGNAL_OK}", "final_posts")
oracle("batch_stats", " UNION ALL ".join([
    _stats("reviews", "after_clean", "reviews", "app_id"), _stats("reviews", "final", "filtered", "app_id"),
    _stats("posts", "after_clean", "posts", "subreddit_id"), _stats("posts", "final", "filtered_posts", "subreddit_id"),
    _totals("reviews", "reviews"), _totals("posts", "posts"),
]), "reviews", "filtered", "posts", "filtered_posts")
oracle("stage_comparison", """SELECT app_id, rows_raw, coalesce(c, 0) AS rows_after_clean,
  coalesce(f, 0) AS rows_final FROM (SELECT app_id, count(*) AS rows_raw FROM raw_reviews GROUP BY 1)
  LEFT JOIN (SELECT app_id, count(*) AS c FROM reviews GROUP BY 1) USING (app_id)
  LEFT JOIN (SELECT app_id, count(*) AS f FROM filtered GROUP BY 1) USING (app_id)""",
       "raw_reviews", "filtered")
oracle("incremental_ingest", "SELECT * FROM l_stored_reviews", "l_stored_reviews")
# A line starts with the number of its record; of the first 25 characters nothing else is whole.
oracle("incremental_quarantine", """SELECT batch_id, 'broken' AS reason,
  substring('{"arrival_seq":' || arrival_seq || ',"app_id":"' || app_id || '"', 1, 25) AS line FROM (
  SELECT 0 AS batch_id, arrival_seq, app_id FROM raw_reviews
  UNION ALL SELECT 1, arrival_seq, app_id FROM later_raw_reviews) WHERE arrival_seq % 7 = 0""",
       "raw_reviews", "later_raw_reviews")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
