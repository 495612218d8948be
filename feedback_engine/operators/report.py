"""Health reports over batches and stored tables.

Scores have three places, so averages are taken over their integer thousandths:
the result does not depend on the order rows are added up in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from feedback_engine.functions.quality import round_half_even_exact

# Fixed values.
TOP_GROUPS = 10
TOP_LANGUAGES = 5
PREVIEW_CHARS = 120
UNKNOWN = "unknown"
CLEAN = "(clean)"


def language_group() -> Column:
    return F.coalesce(F.col("language"), F.lit(UNKNOWN))


def reason_group() -> Column:
    return F.coalesce(F.nullif(F.col("low_signal_reasons"), F.lit("")), F.lit(CLEAN))


def quality_bucket() -> Column:
    return (F.col("quality_score") * 10).cast("int")


def bucket_label(bucket: Column) -> Column:
    low, high = (bucket / 10).cast("double"), ((bucket + 1) / 10).cast("double")
    return F.when(bucket < 10, F.format_string("[%.1f - %.1f)", low, high)).otherwise("[1.0]")


def _thousandths() -> Column:
    return F.round(F.col("quality_score") * 1000).cast("bigint")


def _average_score() -> Column:
    n = F.count("quality_score")
    return round_half_even_exact(F.try_divide(F.sum(_thousandths()) / 1000.0, n), 3)


def _average(name: str) -> Column:
    return round_half_even_exact_large(F.try_divide(F.sum(name), F.count(name)), 1)


def round_half_even_exact_large(value: Column, places: int) -> Column:
    """As ``round_half_even_exact``, for values that may reach the thousands."""
    return F.replace(F.format_number(value, places), F.lit(","), F.lit("")).cast("double")


def _low_share() -> Column:
    """Per cent of rows that are of low signal."""
    low = F.count_if(F.col("is_low_signal") == 1)
    return round_half_even_exact(F.try_divide(low, F.count("*")) * 100, 1)


def overview(df: DataFrame, *by: str) -> DataFrame:
    """Rows, low-signal share and averages, in one pass; no row for an empty table."""
    low = F.count_if(F.col("is_low_signal") == 1)
    return (
        df.groupBy(*by)
        .agg(
            F.count("*").alias("n_rows"),
            low.alias("low_signal_rows"),
            _low_share().alias("low_signal_pct"),
            _average_score().alias("avg_quality"),
            _average("cleaned_length").alias("avg_length"),
            _average("word_count").alias("avg_words"),
        )
        .filter(F.col("n_rows") > 0)
    )


def language_distribution(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(language_group().alias("lang"))
        .agg(F.count("*").alias("n"), _average_score().alias("avg_q"))
        .orderBy(F.desc("n"), F.asc("lang"))
        .limit(TOP_GROUPS)
    )


def reason_breakdown(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("is_low_signal") == 1)
        .groupBy(reason_group().alias("reason"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc("reason"))
        .limit(TOP_GROUPS)
    )


def quality_histogram(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("quality_score").isNotNull())
        .groupBy(quality_bucket().alias("bucket"))
        .agg(F.count("*").alias("n"))
        .orderBy("bucket")
        .select(bucket_label(F.col("bucket")).alias("score_range"), "n")
    )


def worst_examples(df: DataFrame, text: str, key: str, n: int) -> DataFrame:
    """The ``n`` low-signal rows of the lowest scores."""
    return examples({"": (df, text, key)}, n, worst=True).drop("table_name").withColumnRenamed("id", key)


def best_examples(df: DataFrame, text: str, key: str, n: int) -> DataFrame:
    """The ``n`` other rows of the highest scores."""
    return examples({"": (df, text, key)}, n, worst=False).drop("table_name").withColumnRenamed("id", key)


def examples(tables: dict[str, tuple[DataFrame, str, str]], n: int, worst: bool) -> DataFrame:
    """The ``n`` worst or best rows of each of the tables, given as (rows, text column, key column).

    Keys are of one type in all tables. Each table's rows are cut down to ``n``
    within every task before they move.
    """
    order = [F.asc("quality_score") if worst else F.desc("quality_score"), F.asc("id")]
    shown = "low_signal_reasons" if worst else "language"
    found = None
    for name, (df, text, key) in tables.items():
        part = (
            df.filter(F.col("is_low_signal") == (1 if worst else 0))
            .select(
                F.lit(name).alias("table_name"), F.col(key).alias("id"), "quality_score", shown,
                F.substring(text, 1, PREVIEW_CHARS).alias("preview"),
            )
            .orderBy(*order)
            .limit(n)
        )
        found = part if found is None else found.unionByName(part)
    return found


def full_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Overview, languages, reasons and histogram of all tables in one job.

    Grouping sets compute the four sections from a single scan of each table;
    what remains after partial aggregation is a handful of rows per task.
    """
    facts = None
    for name, df in tables.items():
        part = df.select(
            F.lit(name).alias("table_name"),
            language_group().alias("lang"),
            F.when(F.col("is_low_signal") == 1, reason_group()).alias("reason"),
            quality_bucket().alias("bucket"),
            "quality_score",
            "cleaned_length",
            "word_count",
            "is_low_signal",
        )
        facts = part if facts is None else facts.unionByName(part)
    table, lang = F.col("table_name"), F.col("lang")
    reason, bucket = F.col("reason"), F.col("bucket")
    grouped = facts.groupingSets(
        [[table], [table, lang], [table, reason], [table, bucket]], table, lang, reason, bucket
    ).agg(
        F.grouping_id(table, lang, reason, bucket).alias("gid"),
        F.count("*").alias("n"),
        F.count_if(F.col("is_low_signal") == 1).alias("low"),
        _low_share().alias("low_pct"),
        _average_score().alias("avg_quality"),
        _average("cleaned_length").alias("avg_length"),
        _average("word_count").alias("avg_words"),
    )
    # Bits of gid, left to right: table, lang, reason, bucket; 0 means grouped by.
    section = (
        F.when(F.col("gid") == 0b0111, "overview")
        .when(F.col("gid") == 0b0011, "language")
        .when(F.col("gid") == 0b0101, "reason")
        .otherwise("histogram")
    )
    group = F.coalesce(
        lang, reason, F.when(bucket.isNotNull(), bucket_label(bucket)), F.lit("all")
    )
    labelled = grouped.select(
        "table_name", section.alias("section"), group.alias("group_name"), "*"
    ).filter(
        ((F.col("section") != "reason") | reason.isNotNull())
        & ((F.col("section") != "histogram") | bucket.isNotNull())
    )
    ranked = Window.partitionBy("table_name", "section").orderBy(F.desc("n"), F.asc("group_name"))
    overall = F.col("section") == "overview"
    return (
        labelled.withColumn("rank", F.row_number().over(ranked))
        .filter(~F.col("section").isin("language", "reason") | (F.col("rank") <= TOP_GROUPS))
        .select(
            "table_name",
            "section",
            "group_name",
            "n",
            F.when(overall, F.col("low")).alias("low_signal_rows"),
            F.when(overall, F.col("low_pct")).alias("low_signal_pct"),
            F.when(overall | (F.col("section") == "language"), F.col("avg_quality")).alias(
                "avg_quality"
            ),
            F.when(overall, F.col("avg_length")).alias("avg_length"),
            F.when(overall, F.col("avg_words")).alias("avg_words"),
        )
    )


def batch_stats(df: DataFrame, source: str, stage: str) -> DataFrame:
    """Per source: rows, low-signal rows, average score, five commonest languages."""
    per_language = df.groupBy(source, language_group().alias("lang")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("is_low_signal") == 1).alias("low"),
        F.sum(_thousandths()).alias("score"),
        F.count("quality_score").alias("scored"),
    )
    # One entry per language and source is left, so the list stays short.
    commonest = F.slice(F.array_sort(F.collect_list(F.struct(-F.col("n"), "lang"))), 1, TOP_LANGUAGES)
    shown = F.transform(
        commonest, lambda e: F.concat(e["lang"], F.lit("="), (-e["col1"]).cast("string"))
    )
    average = F.coalesce(F.try_divide(F.sum("score") / 1000.0, F.sum("scored")), F.lit(0.0))
    return per_language.groupBy(source).agg(
        F.lit(stage).alias("stage"),
        F.sum("n").alias("n_rows"),
        F.sum("low").alias("low_signal_rows"),
        round_half_even_exact(average, 3).alias("avg_quality"),
        F.array_join(shown, ", ").alias("langs"),
    )


def observe_stage(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Collect a stage's numbers while the DataFrame is written, without a second pass."""
    observation = Observation(stage)
    observed = df.observe(
        observation,
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("is_low_signal"), F.lit(0)).alias("low_signal_rows"),
        F.coalesce(_average_score(), F.lit(0.0)).alias("avg_quality"),
    )
    return observed, observation
