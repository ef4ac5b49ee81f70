"""Model answers on reviews: parse, validate, route, judge, and the model hooks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.buckets import rating_sentiment
from ..functions.numeric import col, floored_ratio, mean, percent, ratio, round_half_up
from ..functions.text import stable_bucket, strip_fence

# The answer contract.
SENTIMENTS = ("POSITIVE", "NEGATIVE", "NEUTRAL")
URGENCIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
CATEGORIES = (
    "PRODUCT_QUALITY",
    "DELIVERY",
    "PRICING",
    "FRAUD_SUSPICION",
    "CUSTOMER_SERVICE",
    "RETURN_REFUND",
    "GENERAL_FEEDBACK",
)
FALLBACK_SUMMARY = "LLM enrichment failed — fallback applied"
JUDGE_FAILED = "Judge failed — defaulting to PASS"

# Scalars are read as text, so that a number or flag in quotes still counts.
_ANSWER = (
    "sentiment string, sentiment_score string, primary_category string, issue_type string, urgency_level string, "
    "key_entities array<string>, one_line_summary string, requires_action string, suggested_action string, _broken string"
)
_VERDICT = (
    "confidence_score string, sentiment_correct string, category_correct string, summary_accurate string, "
    "overall_verdict string, reasoning string, _broken string"
)


def parse_json(raw: str | Column, schema: str) -> Column:
    """Struct of the model's JSON; ``_broken`` holds the text when it is not valid JSON."""
    return F.from_json(strip_fence(raw), schema, {"columnNameOfCorruptRecord": "_broken"})


def parse_answers(df: DataFrame, raw: str = "raw_response") -> DataFrame:
    """Add the answer's fields and whether the text was valid JSON."""
    a = F.col("_a")
    parsed = df.withColumn("_a", parse_json(raw, _ANSWER))
    fields = {
        "sentiment": F.upper(a["sentiment"]),
        "sentiment_score": a["sentiment_score"].try_cast("double"),
        "primary_category": F.upper(a["primary_category"]),
        "issue_type": a["issue_type"],
        "urgency_level": F.upper(a["urgency_level"]),
        "key_entities": a["key_entities"],
        "one_line_summary": a["one_line_summary"],
        "requires_action": a["requires_action"].try_cast("boolean"),
        "suggested_action": a["suggested_action"],
        "is_json": a.isNotNull() & a["_broken"].isNull(),
    }
    return parsed.withColumns(fields).drop("_a")


def failure_reasons() -> Column:
    """Array of everything wrong with a parsed answer; empty when it is valid."""
    c = F.col

    def enum(name: str, allowed: tuple[str, ...]) -> Column:
        missing = F.when(c(name).isNull(), F.lit(f"missing {name}"))
        return missing.when(~c(name).isin(*allowed), F.lit(f"invalid {name}"))

    checks = [
        enum("sentiment", SENTIMENTS),
        F.when(c("sentiment_score").isNull(), F.lit("missing sentiment_score")).when(
            ~c("sentiment_score").between(0.0, 1.0), F.lit("score out of range")
        ),
        enum("primary_category", CATEGORIES),
        enum("urgency_level", URGENCIES),
        *[
            F.when(c(name).isNull(), F.lit(f"missing {name}"))
            for name in ("key_entities", "one_line_summary", "requires_action")
        ],
    ]
    return F.when(~c("is_json"), F.array(F.lit("invalid json"))).otherwise(F.array_compact(F.array(*checks)))


def validate_answers(parsed: DataFrame) -> DataFrame:
    """Add failure_reasons and validation_passed, and round the score."""
    out = parsed.withColumn("failure_reasons", failure_reasons())
    return out.withColumns(
        {
            "validation_passed": F.size("failure_reasons") == 0,
            "sentiment_score": round_half_up("sentiment_score", 3),
        }
    )


def enrich(responses: DataFrame, model: str = "model", raw: str = "raw_response") -> DataFrame:
    """Answers where valid, values derived from the stars elsewhere."""
    own = ["review_id", "review_text", "seller_id", "product_category", "city", "rating", "review_date"]
    checked = validate_answers(parse_answers(responses.select(*own, raw), raw))
    ok = F.col("validation_passed")

    def pick(name: str, fallback: Column) -> Column:
        return F.when(ok, F.col(name)).otherwise(fallback)

    values = {
        "sentiment": pick("sentiment", rating_sentiment("rating")),
        "sentiment_score": pick("sentiment_score", F.col("rating").cast("double") / 5.0),
        "primary_category": pick("primary_category", F.lit("GENERAL_FEEDBACK")),
        "issue_type": pick("issue_type", F.lit(None)),
        "urgency_level": pick("urgency_level", F.lit("LOW")),
        "key_entities": pick("key_entities", F.array().cast("array<string>")),
        "one_line_summary": pick("one_line_summary", F.lit(FALLBACK_SUMMARY)),
        "requires_action": pick("requires_action", F.lit(False)),
        "suggested_action": pick("suggested_action", F.lit(None)),
        "model_used": pick_model(ok, model),
        "enrichment_success": ok,
    }
    return checked.withColumns(values).drop("is_json")


def pick_model(ok: Column, model: str) -> Column:
    return F.when(ok, F.lit(model)).otherwise(F.lit("fallback"))


def split_dead_letters(enriched: DataFrame, failed_at: str) -> tuple[DataFrame, DataFrame]:
    """(successful rows, dead letters). Persist ``enriched`` when both are written."""
    review = ["review_id", "review_text", "seller_id", "product_category", "city", "rating", "review_date"]
    dead = enriched.filter(~F.col("enrichment_success")).select(
        "review_id",
        F.col("review_text").alias("original_text"),
        F.array_join("failure_reasons", "; ").alias("failure_reason"),
        F.to_json(F.struct(*review)).alias("raw_review"),
        F.to_timestamp(F.lit(failed_at)).alias("failed_at"),
    )
    return enriched.filter("enrichment_success"), dead


def enrichment_numbers() -> list[Column]:
    """Counters of one enrichment run, as aggregates that add up over parts."""
    has_json = ~F.array_contains("failure_reasons", "invalid json")
    return [
        F.count("*").alias("processed"),
        F.count_if(has_json).alias("llm_success"),
        F.count_if(~has_json).alias("llm_failed"),
        F.count_if("enrichment_success").alias("validation_passed"),
        F.count_if(has_json & ~F.col("enrichment_success")).alias("validation_failed"),
        F.count_if(~F.col("enrichment_success")).alias("dlq_count"),
    ]


def enrichment_counters(enriched: DataFrame) -> DataFrame:
    """Counters of one enrichment run in one row."""
    return enriched.agg(*enrichment_numbers())


def run_log(enriched: DataFrame, run_id: str, run_date: str) -> DataFrame:
    """The run-log row: totals and the average score."""
    exact = F.sum(F.col("sentiment_score").cast("decimal(18,6)")).cast("double")
    return enriched.agg(
        F.lit(run_id).alias("run_id"),
        F.to_timestamp(F.lit(run_date)).alias("run_date"),
        F.count("*").alias("total_processed"),
        F.count_if("enrichment_success").alias("successful"),
        F.count_if(~F.col("enrichment_success")).alias("failed"),
        round_half_up(F.try_divide(exact, F.count("sentiment_score").cast("double")), 4).alias("avg_sentiment_score"),
    )


# ---- prompts --------------------------------------------------------------------------

ENRICH_TEMPLATE = (
    "Read this customer review of an online shop and answer with one JSON object only.\n"
    'Review: "{review_text}"\nCategory: {product_category}\nStars: {rating} of 5\n'
    "Fields: sentiment (" + ", ".join(SENTIMENTS) + "), sentiment_score (0.0 to 1.0), primary_category ("
    + ", ".join(CATEGORIES) + "), issue_type, urgency_level (" + ", ".join(URGENCIES) + "), key_entities, "
    "one_line_summary, requires_action, suggested_action."
)
JUDGE_TEMPLATE = (
    "Check how an earlier step labelled a review. Answer with one JSON object only.\n"
    'Review: "{review_text}"\nStars: {rating} of 5\nSentiment: {sentiment} ({sentiment_score})\n'
    "Category: {primary_category}\nSummary: {one_line_summary}\nUrgency: {urgency_level}\n"
    "Fields: confidence_score (0.0 to 1.0), sentiment_correct, category_correct, summary_accurate, overall_verdict "
    "(PASS when confidence_score >= 0.7, else FAIL), reasoning."
)


def build_prompt(template: str, cut: dict[str, int] | None = None) -> Column:
    """Fill {column} places of a template; ``cut`` limits how much of a column is shown."""
    cut, parts, rest = cut or {}, [], template
    while "{" in rest:
        text, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        value = F.substring(name, 1, cut[name]) if name in cut else F.col(name)
        parts += [F.lit(text), F.coalesce(value.cast("string"), F.lit(""))]
    return F.concat(*parts, F.lit(rest))


# ---- judging --------------------------------------------------------------------------


def wants_judge(share_percent: int = 20) -> Column:
    """Never for fallback rows, always for critical or fraud reviews, else a fixed sample."""
    special = (F.col("urgency_level") == "CRITICAL") | (F.col("primary_category") == "FRAUD_SUSPICION")
    sampled = stable_bucket("review_id", 100) < share_percent
    return F.col("enrichment_success") & (special | sampled)


def judge_verdicts(df: DataFrame, raw: str = "judge_response", passing: float = 0.7) -> DataFrame:
    """Add the verdict; an unusable answer passes with confidence 0.5."""
    v = F.col("_v")
    parsed = df.withColumn("_v", parse_json(raw, _VERDICT))
    flags = ("sentiment_correct", "category_correct", "summary_accurate")
    values = {
        "confidence_score": v["confidence_score"].try_cast("double"),
        **{name: v[name].try_cast("boolean") for name in flags},
        "overall_verdict": v["overall_verdict"],
        "reasoning": v["reasoning"],
    }
    usable = v.isNotNull() & v["_broken"].isNull()
    for value in values.values():
        usable = usable & value.isNotNull()
    defaults = {
        "confidence_score": F.lit(0.5),
        **{name: F.lit(True) for name in flags},
        "overall_verdict": F.lit("PASS"),
        "reasoning": F.lit(JUDGE_FAILED),
    }
    out = parsed.withColumn("judged", usable)
    out = out.withColumns({n: F.when(usable, value).otherwise(defaults[n]) for n, value in values.items()}).drop("_v")
    disagrees = F.col("judged") & ((F.col("overall_verdict") == "PASS") != (F.col("confidence_score") >= passing))
    return out.withColumn("inconsistent", disagrees)


def judge_numbers() -> list[Column]:
    passed = F.col("judged") & (F.col("overall_verdict") == "PASS")
    return [
        F.count_if("judged").alias("judged"),
        F.count_if(passed).alias("passed"),
        F.count_if(F.col("judged") & ~passed).alias("failed"),
    ]


def judge_counters(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(*judge_numbers())


# ---- review analytics -----------------------------------------------------------------


def _score_mean() -> Column:
    exact = F.sum(F.col("sentiment_score").cast("decimal(18,6)")).cast("double")
    return F.try_divide(exact, F.count("sentiment_score").cast("double"))


def sentiment_summary(reviews: DataFrame) -> DataFrame:
    good = reviews.filter("enrichment_success")
    return good.groupBy("sentiment").agg(
        F.count("*").alias("count"),
        round_half_up(_score_mean(), 3).alias("avg_score"),
        round_half_up(ratio(F.sum("rating"), F.count("rating")), 2).alias("avg_rating"),
    )


def seller_sentiment(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("seller_id").agg(
        F.count("*").alias("total_reviews"),
        round_half_up(_score_mean(), 3).alias("avg_sentiment"),
        F.count_if(F.col("sentiment") == "POSITIVE").alias("positive_count"),
        F.count_if(F.col("sentiment") == "NEGATIVE").alias("negative_count"),
        round_half_up(ratio(F.sum("rating"), F.count("rating")), 2).alias("avg_rating"),
    )


def review_metrics(reviews: DataFrame) -> DataFrame:
    """Headline numbers: total, positive and negative reviews with their shares."""
    good = reviews.filter("enrichment_success")
    base = good.agg(
        F.count("*").alias("total_reviews"),
        F.count_if(F.col("sentiment") == "POSITIVE").alias("positive"),
        F.count_if(F.col("sentiment") == "NEGATIVE").alias("negative"),
    )
    shares = {
        f"{n}_pct": round_half_up(floored_ratio(n, "total_reviews") * F.lit(100.0), 1) for n in ("positive", "negative")
    }
    return base.withColumns(shares)


# ---- model hooks ----------------------------------------------------------------------


def call_model(
    df: DataFrame,
    prompt: str,
    answer: Callable[[list[str]], list[str]],
    name: str = "raw_response",
    retries: int = 3,
    wait_seconds: float = 1.0,
) -> DataFrame:
    """Add the answer of a user-given model to each prompt, a batch at a time inside tasks.

    A failing batch is tried again with doubled waits; after the last try its answers are
    null, which later lands in the dead letters.
    """

    @F.pandas_udf("string")
    def replies_to(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompts in batches:
            replies: list[str | None] = [None] * len(prompts)
            for attempt in range(retries):
                try:
                    replies = list(answer(prompts.tolist()))
                    break
                except Exception:  # any failure of the outside model counts as one try
                    if attempt < retries - 1:
                        time.sleep(wait_seconds * 2**attempt)
            yield pd.Series(replies, dtype="object")

    # Only the prompt travels to Python; a call of a model is never repeated by the optimizer.
    return df.withColumn(name, replies_to.asNondeterministic()(F.col(prompt)))


def embed(
    df: DataFrame, text: str, model: Callable[[list[str]], list[list[float]]], name: str = "embedding"
) -> DataFrame:
    """Add the unit-length vector a user-given model makes of a text."""

    @F.pandas_udf("array<double>")
    def unit_vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if not len(texts):
                yield pd.Series([], dtype="object")
                continue
            vectors = np.asarray(model(texts.tolist()), dtype="float64")
            norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
            norms[norms == 0] = 1.0
            yield pd.Series(list(vectors / norms), dtype="object")

    return df.withColumn(name, unit_vectors.asNondeterministic()(F.col(text)))


def enriched_records(
    responses: DataFrame, model: Callable[[list[str]], list[list[float]]], enriched_at: str, name: str = "model"
) -> DataFrame:
    """The full enriched record: valid or derived values, the vector of the text, and the time of the run.

    A vector is made of valid answers only, as derived rows go to the dead letters; the time is given, so a repeated run agrees.
    """
    rows = enrich(responses, name)
    shown = F.when(F.col("enrichment_success"), F.col("review_text"))
    good = embed(rows.withColumn("_shown", F.coalesce(shown, F.lit(""))), "_shown", model).drop("_shown")
    vector = F.when(F.col("enrichment_success"), F.col("embedding"))
    return good.withColumns({"embedding": vector, "enriched_at": F.to_timestamp(F.lit(enriched_at))})
