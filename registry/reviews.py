"""V queries, A11-A13 over reviews, S13 and S14."""

import re

from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.functions.buckets import sentiment_band
from bazaarflow.functions.text import language_hint, strip_fence
from bazaarflow.operators import reviews as R, search as S, upsert as U
from bazaarflow.operators.counters import as_row, write_counted
from bazaarflow.session import scratch_path
from bazaarflow.sources import events as Ev
from bazaarflow.streaming.runner import run_counted

from .base import big, day, query, rnd, using

TRIM = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def fence_sql(x):
    t = TRIM.format(x=x)
    inner = f"split_part({t}, '```', 2)"
    return f"""case when starts_with({t}, '```') then case when starts_with({inner}, 'json') then substr({inner}, 5)
      else {inner} end else {t} end"""


PARSED = {
    "stripped": f"select *, {fence_sql('raw_response')} as js from model_responses",
    "answers": """select review_id, doc_id, review_text, seller_id, product_category, city, rating, review_date,
      json_valid(js) as is_json, upper(json_extract_string(j, '$.sentiment')) as sentiment,
      try_cast(json_extract_string(j, '$.sentiment_score') as double) as sentiment_score,
      upper(json_extract_string(j, '$.primary_category')) as primary_category,
      json_extract_string(j, '$.issue_type') as issue_type,
      upper(json_extract_string(j, '$.urgency_level')) as urgency_level,
      array_to_string(cast(json_extract_string(j, '$.key_entities[*]') as varchar[]), ',') as key_entities,
      json_extract_string(j, '$.one_line_summary') as one_line_summary,
      try_cast(json_extract_string(j, '$.requires_action') as boolean) as requires_action,
      json_extract_string(j, '$.suggested_action') as suggested_action
      from (select *, case when json_valid(js) then js end as j from stripped) t""",
}
LISTS = {
    "sentiment": "('POSITIVE', 'NEGATIVE', 'NEUTRAL')",
    "urgency_level": "('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')",
    "primary_category": "('PRODUCT_QUALITY','DELIVERY','PRICING','FRAUD_SUSPICION','CUSTOMER_SERVICE','RETURN_REFUND',"
    "'GENERAL_FEEDBACK')",
}


def enum_sql(name):
    return f"case when {name} is null then 'missing {name}' when {name} not in {LISTS[name]} then 'invalid {name}' end"


CHECKED = PARSED | {
    "checked": f"""select *, case when not is_json then 'invalid json' else concat_ws('; ', {enum_sql('sentiment')},
      case when sentiment_score is null then 'missing sentiment_score'
        when sentiment_score not between 0 and 1 then 'score out of range' end,
      {enum_sql('primary_category')}, {enum_sql('urgency_level')},
      case when key_entities is null then 'missing key_entities' end,
      case when one_line_summary is null then 'missing one_line_summary' end,
      case when requires_action is null then 'missing requires_action' end) end as reasons from answers"""
}
ENRICHED = CHECKED | {
    "enriched": f"""select review_id, review_text, seller_id, product_category, city, rating, review_date, reasons,
      reasons = '' as enrichment_success,
      case when reasons = '' then sentiment when rating >= 4 then 'POSITIVE' when rating <= 2 then 'NEGATIVE'
        else 'NEUTRAL' end as sentiment,
      case when reasons = '' then {rnd('sentiment_score', 3)} else cast(rating as double) / 5 end as sentiment_score,
      case when reasons = '' then primary_category else 'GENERAL_FEEDBACK' end as primary_category,
      case when reasons = '' then issue_type end as issue_type,
      case when reasons = '' then urgency_level else 'LOW' end as urgency_level,
      case when reasons = '' then key_entities else '' end as key_entities,
      case when reasons = '' then one_line_summary else 'LLM enrichment failed — fallback applied' end as one_line_summary,
      case when reasons = '' then requires_action else false end as requires_action,
      case when reasons = '' then suggested_action end as suggested_action,
      case when reasons = '' then 'model' else 'fallback' end as model_used from checked"""
}


@query(
    "v1_parse_answers",
    using(
        "model_responses",
        """select review_id, is_json, sentiment, sentiment_score, primary_category, issue_type, urgency_level, key_entities,
      one_line_summary, requires_action, suggested_action from answers where is_json""",
        also=PARSED,
    ),
)
def v1(spark, root):
    parsed = R.parse_answers(B.model_responses(spark, root).select("review_id", "raw_response"))
    return parsed.filter("is_json").drop("raw_response")


@query(
    "v1_all_answers",
    using(
        "model_responses",
        """select a.*, m.raw_response from (select review_id, is_json, sentiment, sentiment_score, primary_category, issue_type, urgency_level,
      key_entities, one_line_summary, requires_action, suggested_action from answers) a
      join (select review_id, raw_response from model_responses) m using (review_id)""",
        also=PARSED,
    ),
)
def v1_all(spark, root):
    """Broken answers too, with their text and no fields."""
    return R.parse_answers(B.model_responses(spark, root).select("review_id", "raw_response"))


@query(
    "v1_stripped_text",
    using("model_responses", "select review_id, js from stripped", also=PARSED),
)
def v1_text(spark, root):
    return B.model_responses(spark, root).select("review_id", strip_fence("raw_response").alias("js"))


@query(
    "v3_validate_answers",
    using(
        "model_responses",
        f"""select review_id, reasons = '' as validation_passed, reasons as failure_reasons,
      case when is_json then {rnd('sentiment_score', 3)} end as score from checked""",
        also=CHECKED,
    ),
)
def v3(spark, root):
    checked = R.validate_answers(R.parse_answers(B.model_responses(spark, root)))
    return checked.select(
        "review_id",
        "validation_passed",
        F.array_join("failure_reasons", "; ").alias("failure_reasons"),
        F.when(F.col("is_json"), F.col("sentiment_score")).alias("score"),
    )


@query(
    "v4_enriched_reviews",
    using(
        "model_responses",
        f"""select * exclude (reasons) replace ({day('review_date')} as review_date),
      reasons as failure_reasons, enrichment_success as validation_passed from enriched""",
        also=ENRICHED,
    ),
)
def v4(spark, root):
    out = R.enrich(B.model_responses(spark, root)).drop("raw_response")
    return out.withColumn("failure_reasons", F.array_join("failure_reasons", "; "))


@query(
    "v4_dead_letters",
    using(
        "model_responses",
        """select review_id, review_text as original_text, reasons as failure_reason, review_text as raw_text,
      rating as raw_rating, '2024-02-01 00:00:00.000000' as failed_at from enriched where not enrichment_success""",
        also=ENRICHED,
    ),
)
def v4_dead(spark, root):
    _, dead = R.split_dead_letters(R.enrich(B.model_responses(spark, root)), "2024-02-01 00:00:00")
    raw = F.from_json("raw_review", "review_text string, rating bigint")
    return dead.select(
        "review_id",
        "original_text",
        "failure_reason",
        raw["review_text"].alias("raw_text"),
        raw["rating"].alias("raw_rating"),
        "failed_at",
    )


ENRICHMENT_NUMBERS = using(
    "model_responses",
    """select count(*) as processed, count(*) filter (reasons <> 'invalid json') as llm_success,
      count(*) filter (reasons = 'invalid json') as llm_failed, count(*) filter (reasons = '') as validation_passed,
      count(*) filter (reasons not in ('', 'invalid json')) as validation_failed,
      count(*) filter (reasons <> '') as dlq_count from checked""",
    also=CHECKED,
)
COUNTED = "processed bigint, llm_success bigint, llm_failed bigint, validation_passed bigint, validation_failed bigint, dlq_count bigint"


@query("a13_enrichment_counters", ENRICHMENT_NUMBERS)
def a13_enrichment(spark, root):
    """Out of the write of the enriched reviews."""
    rows = R.enrich(B.model_responses(spark, root))
    return as_row(spark, write_counted(rows, scratch_path(spark, "enriched"), R.enrichment_numbers())[1], COUNTED)


@query("a13_stream_counters", ENRICHMENT_NUMBERS)
def a13_stream(spark, root):
    """The same out of the batches of a stream."""
    source, out = scratch_path(spark, "responses"), scratch_path(spark, "enriched")
    responses = B.model_responses(spark, root)
    files = Ev.write_for_stream(responses, source)
    stream = spark.readStream.schema(responses.schema).option("maxFilesPerTrigger", files).parquet(source)
    counters = run_counted(R.enrich(stream), R.enrichment_numbers(), out, scratch_path(spark, "enriched-checkpoint"))[1]
    return as_row(spark, counters, COUNTED)


@query(
    "a13_run_log",
    using(
        "model_responses",
        f"""select 'run-1' as run_id, '2024-02-01 00:00:00.000000' as run_date, count(*) as total_processed,
      count(*) filter (enrichment_success) as successful, count(*) filter (not enrichment_success) as failed,
      {rnd('''(cast(sum(cast(sentiment_score as decimal(18,6))) as double) / count(sentiment_score))''', 4)}
        as avg_sentiment_score from enriched""",
        also=ENRICHED,
    ),
)
def a13_run(spark, root):
    return R.run_log(R.enrich(B.model_responses(spark, root)), "run-1", "2024-02-01 00:00:00")


TEMPLATE = "Review: {review_text} / Stars: {rating} / Category: {product_category}"


@query(
    "v5_prompts",
    using(
        "reviews_fact",
        """select review_id, concat('Review: ', review_text, ' / Stars: ', rating, ' / Category: ', product_category) as prompt,
      substr(review_text, 1, 500) as shown from reviews_fact""",
    ),
)
def v5(spark, root):
    return B.reviews_fact(spark, root).select(
        "review_id",
        R.build_prompt(TEMPLATE).alias("prompt"),
        R.build_prompt("{review_text}", cut={"review_text": 500}).alias("shown"),
    )


def filled_sql(template, cut=None):
    """A template with its places as columns of a query."""
    cut, parts = cut or {}, re.split(r"\{(\w+)\}", template)
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    value = lambda c: f"substr({c}, 1, {cut[c]})" if c in cut else c
    return "concat(" + ", ".join(value(p) if i % 2 else quoted(p) for i, p in enumerate(parts) if p) + ")"


@query(
    "v5_enrichment_prompts",
    using("reviews_fact", f"select review_id, {filled_sql(R.ENRICH_TEMPLATE)} as prompt from reviews_fact"),
)
def v5_enrichment(spark, root):
    """The prompt that the enrichment sends, of every review."""
    return B.reviews_fact(spark, root).select("review_id", R.build_prompt(R.ENRICH_TEMPLATE).alias("prompt"))


@query(
    "v5_judge_prompts",
    using("model_responses", f"select review_id, {filled_sql(R.JUDGE_TEMPLATE, {'review_text': 500})} as prompt from enriched", also=ENRICHED),
)
def v5_judge(spark, root):
    """The prompt that the judge gets of every enriched review, its text cut."""
    enriched = R.enrich(B.model_responses(spark, root))
    return enriched.select("review_id", R.build_prompt(R.JUDGE_TEMPLATE, cut={"review_text": 500}).alias("prompt"))


WANTED = """enrichment_success and (urgency_level = 'CRITICAL' or primary_category = 'FRAUD_SUSPICION'
  or cast('0x' || substr(md5(review_id), 1, 8) as bigint) % 100 < 20)"""


@query("v6_select_for_judge", using("reviews_fact", f"select review_id from reviews_fact where {WANTED}"))
def v6(spark, root):
    return B.reviews_fact(spark, root).filter(R.wants_judge()).select("review_id")


VERDICTS = {
    "told": f"select *, {fence_sql('judge_response')} as js from judge_responses where {WANTED}",
    "verdicts": """select review_id, json_valid(js) as judged,
      case when json_valid(js) then try_cast(json_extract_string(js, '$.confidence_score') as double) else 0.5 end
        as confidence_score,
      case when json_valid(js) then json_extract_string(js, '$.category_correct') = 'true' else true end as category_correct,
      case when json_valid(js) then json_extract_string(js, '$.overall_verdict') else 'PASS' end as overall_verdict,
      case when json_valid(js) then json_extract_string(js, '$.reasoning') else 'Judge failed — defaulting to PASS' end
        as reasoning from (select * replace (case when json_valid(js) and trim(js, chr(10)) like '{%' then js end as js) from
        (select review_id, js from told) s) t""",
    "judged_rows": "select * replace (coalesce(judged, false) as judged) from verdicts",
}


def verdicts(spark, root):
    return R.judge_verdicts(B.judge_responses(spark, root).filter(R.wants_judge()))


@query(
    "v7_judge_verdicts",
    using(
        "judge_responses",
        """select *, judged and ((overall_verdict = 'PASS') <> (confidence_score >= 0.7::double)) as inconsistent
      from judged_rows""",
        also=VERDICTS,
    ),
)
def v7(spark, root):
    return verdicts(spark, root).select(
        "review_id", "judged", "confidence_score", "category_correct", "overall_verdict", "reasoning", "inconsistent"
    )


@query(
    "a13_judge_counters",
    using(
        "judge_responses",
        """select count(*) filter (judged) as judged, count(*) filter (judged and overall_verdict = 'PASS') as passed,
      count(*) filter (judged and overall_verdict <> 'PASS') as failed from judged_rows""",
        also=VERDICTS,
    ),
)
def a13_judge(spark, root):
    counters = write_counted(verdicts(spark, root), scratch_path(spark, "verdicts"), R.judge_numbers())[1]
    return as_row(spark, counters, "judged bigint, passed bigint, failed bigint")


SUMMARY = f"""select sentiment, count(*) as count,
  {rnd('(cast(sum(cast(sentiment_score as decimal(18,6))) as double) / count(*))', 3)} as avg_score,
  {rnd('(cast(sum(rating) as double) / count(*))', 2)} as avg_rating
  from reviews_fact where enrichment_success group by 1"""


@query("a11_sentiment_summary", using("reviews_fact", SUMMARY))
def a11(spark, root):
    return R.sentiment_summary(B.reviews_fact(spark, root))


@query(
    "a12_seller_sentiment",
    using(
        "reviews_fact",
        f"""select seller_id, count(*) as total_reviews,
      {rnd('(cast(sum(cast(sentiment_score as decimal(18,6))) as double) / count(*))', 3)} as avg_sentiment,
      count(*) filter (sentiment = 'POSITIVE') as positive_count, count(*) filter (sentiment = 'NEGATIVE') as negative_count,
      {rnd('(cast(sum(rating) as double) / count(*))', 2)} as avg_rating from reviews_fact group by 1""",
    ),
)
def a12(spark, root):
    return R.seller_sentiment(B.reviews_fact(spark, root))


@query(
    "v10_review_metrics",
    using(
        "reviews_fact",
        f"""select *, {rnd('(cast(positive as double) / greatest(1, total_reviews) * 100.0::double)', 1)} as positive_pct,
      {rnd('(cast(negative as double) / greatest(1, total_reviews) * 100.0::double)', 1)} as negative_pct
      from (select count(*) as total_reviews, count(*) filter (sentiment = 'POSITIVE') as positive,
        count(*) filter (sentiment = 'NEGATIVE') as negative from reviews_fact where enrichment_success) t""",
    ),
)
def v10(spark, root):
    return R.review_metrics(B.reviews_fact(spark, root))


@query(
    "v10_seller_bands",
    using(
        "reviews_fact",
        f"""select seller_id, avg_sentiment, case when avg_sentiment >= 0.7::double then 'STRONG'
      when avg_sentiment >= 0.4::double then 'MIXED' else 'POOR' end as band from (select seller_id,
      {rnd('(cast(sum(cast(sentiment_score as decimal(18,6))) as double) / count(*))', 3)} as avg_sentiment
      from reviews_fact group by 1) t""",
    ),
)
def v10_bands(spark, root):
    sellers = R.seller_sentiment(B.reviews_fact(spark, root)).select("seller_id", "avg_sentiment")
    return sellers.withColumn("band", sentiment_band("avg_sentiment"))


@query(
    "v9_language_hint",
    """select doc_id, case when regexp_matches(lower(text), 'bahut|accha|mila|bilkul|deta|hoon') then 'hinglish'
    else 'english' end as language_hint from documents""",
)
def v9(spark, root):
    return B.table(spark, root, "documents").select("doc_id", language_hint("text").alias("language_hint"))


def by_length(texts):
    """Stand-in for a user's model: answers from the prompt alone."""
    return [f'{{"length": {len(t)}}}' for t in texts]


def length_and_spaces(texts):
    return [[float(len(t)), float(t.count(" "))] for t in texts]


@query(
    "v11_model_hook",
    using("reviews_fact", """select review_id, concat('{"length": ', length(review_text), '}') as raw_response from reviews_fact"""),
)
def v11(spark, root):
    prompts = B.reviews_fact(spark, root).select("review_id", R.build_prompt("{review_text}").alias("prompt"))
    return R.call_model(prompts, "prompt", by_length).drop("prompt")


@query(
    "v11_embedding_hook",
    using(
        "reviews_fact",
        """select review_id, n / sqrt(n * n + s * s) as x, s / sqrt(n * n + s * s) as y
      from (select review_id, length(review_text)::double as n,
        (length(review_text) - length(replace(review_text, ' ', '')))::double as s from reviews_fact) t""",
    ),
)
def v11_embed(spark, root):
    texts = B.reviews_fact(spark, root).select("review_id", "review_text")
    out = R.embed(texts, "review_text", length_and_spaces)
    return out.select("review_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))


@query(
    "v4_enriched_records",
    using(
        "model_responses",
        """select review_id, enrichment_success, model_used, '2024-02-01 00:00:00.000000' as enriched_at,
      case when enrichment_success then n / sqrt(n * n + s * s) end as x, case when enrichment_success then s / sqrt(n * n + s * s) end as y
      from (select *, length(review_text)::double as n,
        (length(review_text) - length(replace(review_text, ' ', '')))::double as s from enriched) t""",
        also=ENRICHED,
    ),
)
def v4_records(spark, root):
    """With the vector of a valid answer's text and the time of the run."""
    out = R.enriched_records(B.model_responses(spark, root), length_and_spaces, "2024-02-01 00:00:00")
    x, y = F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y")
    return out.select("review_id", "enrichment_success", "model_used", "enriched_at", x, y)


# ---- vector search --------------------------------------------------------------------


def hits_sql(where="true"):
    return {
        "scored": f"""select query_id, review_id, list_dot_product(q, v) / (sqrt(list_dot_product(q, q))
          * sqrt(list_dot_product(v, v))) as score from (select query_id, query_vector::double[] as q from search_queries) a,
          (select review_id, embedding::double[] as v from vectors where {where}) b""",
        "hits": f"""select query_id, place, review_id, {rnd('score', 3)} as similarity_score from (select *,
          row_number() over (partition by query_id order by score desc, review_id) as place from scored) t where place <= 5""",
    }


SEARCH = "select query_id::bigint as query_id, place, review_id, similarity_score from hits"


@query("v2_semantic_search", using("vectors search_queries", SEARCH, also=hits_sql()))
def v2(spark, root):
    return S.semantic_search(B.search_queries(spark, root), B.vectors(spark, root))


@query("v2_search_by_blocks", using("vectors search_queries", SEARCH, also=hits_sql()))
def v2_blocks(spark, root):
    """The form for more queries than a task holds: blocks of queries meet blocks of vectors."""
    return S.semantic_search(B.search_queries(spark, root), B.vectors(spark, root), max_query_bytes=0, block_bytes=1 << 14)


@query("v2_approximate_search")
def v2_approximate(spark, root):
    """Strips wide enough for these vectors, whose nearest neighbours are far."""
    return S.approximate_search(B.search_queries(spark, root), B.vectors(spark, root), tables=8, projections=2, bucket_length=0.4)


@query(
    "v2_semantic_search_filtered",
    using("vectors search_queries", SEARCH, also=hits_sql("sentiment = 'NEGATIVE'")),
)
def v2_filtered(spark, root):
    return S.semantic_search(B.search_queries(spark, root), B.vectors(spark, root), sentiment="NEGATIVE")


@query(
    "j5_similarity_join",
    using(
        "vectors search_queries reviews_fact",
        """select query_id::bigint as query_id, review_id, similarity_score, seller_id, r.sentiment as sentiment
      from hits join reviews_fact r using (review_id)""",
        also=hits_sql(),
    ),
)
def j5(spark, root):
    hits = S.semantic_search(B.search_queries(spark, root), B.vectors(spark, root))
    payload = B.reviews_fact(spark, root).select("review_id", "seller_id", "sentiment")
    return hits.join(payload, "review_id").drop("place")


CONTEXT = {
    "lines": f"""select query_id, string_agg(concat(place, '. [', r.sentiment, '] Similarity: ',
      printf('%.2f', {rnd('similarity_score', 2)}), ' | Seller: ', seller_id, ' | Summary: ', one_line_summary,
      ' | Text: ', substr(review_text, 1, 200), '...'), chr(10) order by place) as body
      from hits join reviews_fact r using (review_id) group by 1""",
    "stats": f"""select string_agg(concat('- ', sentiment, ': ', count, ' reviews (avg score: ', avg_score, ', avg rating: ',
      avg_rating, ')'), chr(10) order by count desc, sentiment) as body from ({SUMMARY}) t""",
    "issues": """select string_agg(concat('- [', urgency_level, '] Seller ', seller_id, ' in ', city, ': ', one_line_summary),
      chr(10) order by lvl, review_date desc, review_id) as body from (select *, case urgency_level when 'CRITICAL' then 1
      else 2 end as lvl from reviews_fact where urgency_level in ('HIGH', 'CRITICAL') and requires_action
      order by lvl, review_date desc, review_id limit 3) t""",
}


@query(
    "v8_assemble_context",
    using(
        "vectors search_queries reviews_fact",
        """select query_id::bigint as query_id, concat('RELEVANT REVIEWS FROM DATABASE:', chr(10), lines.body, chr(10), chr(10),
      'SENTIMENT DISTRIBUTION:', chr(10), stats.body, chr(10), chr(10), 'URGENT ISSUES REQUIRING ACTION:', chr(10),
      issues.body) as context from lines, stats, issues""",
        also=hits_sql() | CONTEXT,
    ),
)
def v8(spark, root):
    questions = B.search_queries(spark, root)
    hits = S.semantic_search(questions, B.vectors(spark, root))
    return S.assemble_context(hits, B.reviews_fact(spark, root), questions=questions)


# ---- upserts --------------------------------------------------------------------------


def review_versions(spark, root):
    """Base: every review unrated. Delta: the labelled ones, twice, the newer version right."""
    reviews = B.reviews_fact(spark, root).select("review_id", "doc_id", "review_text", "rating", "sentiment")
    blank = F.lit(0).alias("version")
    base = reviews.select("review_id", "review_text", F.lit(0).alias("rating"), F.lit("NONE").alias("sentiment"), blank)
    labelled = reviews.join(B.table(spark, root, "labels"), "doc_id", "left_semi")
    old = labelled.select("review_id", "review_text", "rating", F.lit("OLD").alias("sentiment"), F.lit(1).alias("version"))
    new = labelled.select("review_id", "review_text", "rating", "sentiment", F.lit(2).alias("version"))
    return base, old.unionByName(new)


@query(
    "s13_upsert_by_key",
    using(
        "reviews_fact",
        """select review_id, review_text, case when l.doc_id is null then 0 else rating end as rating,
      case when l.doc_id is null then 'NONE' else sentiment end as sentiment,
      case when l.doc_id is null then 0 else 2 end::bigint as version
      from reviews_fact r left join labels l on r.doc_id = l.doc_id""",
    ),
)
def s13(spark, root):
    base, delta = review_versions(spark, root)
    return U.upsert(base, delta, ["review_id"], "version")


@query(
    "s13_persisted",
    using(
        "reviews_fact",
        """select review_id, review_text, case when l.doc_id is null and r.doc_id % 10 <> 3 then 0 else rating end as rating,
      case when r.doc_id % 10 = 3 then 'SECOND' when l.doc_id is null then 'NONE' else sentiment end as sentiment,
      case when r.doc_id % 10 = 3 then 3 when l.doc_id is null then 0 else 2 end::bigint as version
      from reviews_fact r left join labels l on r.doc_id = l.doc_id
      union all select 'REV-new', 'new', 5, 'SECOND', 3""",
    ),
)
def s13_persisted(spark, root):
    """A stored table after its first rows and two deltas."""
    path = scratch_path(spark, "reviews-table")
    base, delta = review_versions(spark, root)
    reviews = B.reviews_fact(spark, root).filter("doc_id % 10 = 3")
    second = reviews.select("review_id", "review_text", "rating", F.lit("SECOND").alias("sentiment"), F.lit(3).alias("version"))
    added = spark.range(1).select(F.lit("REV-new").alias("review_id"), F.lit("new").alias("review_text"), F.lit(5).cast(second.schema["rating"].dataType).alias("rating"), F.lit("SECOND").alias("sentiment"), F.lit(3).alias("version"))
    for rows in (base, delta, second.unionByName(added)):
        rows = rows.withColumn("rating", F.col("rating").cast(second.schema["rating"].dataType))
        U.upsert_into(path, rows, ["review_id"], "version", buckets=16)
    return U.read_table(spark, path)


@query(
    "s14_upsert_vectors",
    using(
        "reviews_fact vectors",
        """select review_id, substr(review_text, 1, 500) as original_text, rating, r.sentiment as sentiment,
      array_length(embedding) as dims, list_sum(embedding::double[]) > 0 as positive_sum
      from reviews_fact r join vectors using (review_id)""",
    ),
)
def s14(spark, root):
    c = F.col
    enriched = B.reviews_fact(spark, root).join(B.vectors(spark, root).select("review_id", "embedding"), "review_id")
    points = U.vector_points(enriched)
    old = points.withColumns({"sentiment": F.lit("OLD"), "version": F.lit(0)})
    out = U.upsert(old, points.withColumn("version", F.lit(1)), ["review_id"], "version")
    total = F.aggregate(c("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return out.select(
        "review_id", "original_text", "rating", "sentiment", F.size("embedding").alias("dims"), (total > 0).alias("positive_sum")
    )
