"""Text functions: redaction, guardrails, model output, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.catalog import common
from replyscope.catalog.aggregates import GATED, gated_messages
from replyscope.catalog.common import (
    CLEAN, MESSAGES, NAMES, NEIGHBOURS, PREDICTIONS, THREADS, query, sql_fill, sql_redact, sql_replace, sql_text, table,
)
from replyscope.fixed_values import REDACTION_RULES
from replyscope.functions import prompts
from replyscope.functions.guardrails import guardrail_flags, reply_safety
from replyscope.functions.model_output import batch_labels, label_in_answer, label_status, normalise_label, urgency_signals
from replyscope.functions.redaction import redact, redact_columns
from replyscope.functions.text import word_count
from replyscope.operators import labelling
from replyscope.operators.similarity import normalise
from replyscope.operators.threads import flatten_threads
from replyscope.plans.jobs import nested_examples
from replyscope.sources.taxonomy import intent_of


def contact_texts(spark, sf_dir):
    """Documents followed by personal data made from their number."""
    number = F.col("doc_id")
    extra = F.format_string(
        " Hello @user_%d, mail user%d@example.org or see HTTPS://shop.example/o?id=%d now. Order 114-%07d-%07d and "
        "case REF-AB%06d. Call 555-%03d-%04d, (800) 555-%04d or account %012d with card 4111 1111 1111 %04d ",
        number, number, number, number, number, number, number % 1000, number % 10000, number % 10000, number, number % 10000,
    )
    return common.documents(spark, sf_dir, "doc_id", "text").select("doc_id", F.concat(F.col("text"), extra).alias("text"))


CONTACT = """contact AS (
  SELECT doc_id, text || printf(' Hello @user_%d, mail user%d@example.org or see HTTPS://shop.example/o?id=%d now. Order 114-%07d-%07d and '
    || 'case REF-AB%06d. Call 555-%03d-%04d, (800) 555-%04d or account %012d with card 4111 1111 1111 %04d ',
    doc_id, doc_id, doc_id, doc_id, doc_id, doc_id, doc_id % 1000, doc_id % 10000, doc_id % 10000, doc_id, doc_id % 10000) AS text
  FROM documents)"""


def register_rule(name: str) -> None:
    @query(
        f"redact_{name}",
        f"""WITH {CONTACT}, cleaned AS (SELECT doc_id, {sql_redact('text', [name])} AS redacted FROM contact)
SELECT doc_id, md5(redacted) AS digest, CAST(length(redacted) AS BIGINT) AS n_chars FROM cleaned""",
    )
    def run(spark, sf_dir):
        cleaned = contact_texts(spark, sf_dir).select("doc_id", redact(F.col("text"), [name]).alias("redacted"))
        return cleaned.select("doc_id", F.md5("redacted").alias("digest"), F.length("redacted").cast("long").alias("n_chars"))


for rule in REDACTION_RULES:
    register_rule(rule[0])


@query(
    "redact_all",
    f"""WITH {CONTACT}
SELECT doc_id, md5({sql_redact('text')}) AS text_digest,
       {sql_redact("CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '  ' ELSE text END")} = '' AS other_empty FROM contact""",
)
def redact_all(spark, sf_dir):
    """All rules on two columns; null becomes empty, blank text stays, a missing column is skipped."""
    number = F.col("doc_id") % 3
    rows = contact_texts(spark, sf_dir).withColumn(
        "other", F.when(number == 1, "  ").when(number == 2, F.col("text"))
    )
    cleaned = redact_columns(rows, ["text", "other", "absent"])
    return cleaned.select("doc_id", F.md5("text").alias("text_digest"), (F.col("other") == "").alias("other_empty"))


@query(
    "redact_selected",
    f"""WITH {CONTACT}
SELECT doc_id, md5(regexp_replace({sql_replace('text', ['email', 'handle'])}, '^\\s+|\\s+$', '', 'g')) AS digest FROM contact""",
)
def redact_selected(spark, sf_dir):
    """A caller's choice of rules."""
    return contact_texts(spark, sf_dir).select("doc_id", F.md5(redact(F.col("text"), ["email", "handle"])).alias("digest"))


@query("word_counts", "SELECT doc_id, CAST(len(regexp_extract_all(text, '\\S+')) AS BIGINT) AS n_words FROM documents")
def word_counts(spark, sf_dir):
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    return docs.select("doc_id", word_count(F.col("text")).cast("long").alias("n_words"))


def draft_replies(spark, sf_dir):
    """Drafts with claims made from document numbers; precedents are the drafts of three neighbours."""
    number = F.col("doc_id")
    claim = F.concat(
        F.lit("We will reply within "), (number % 6 + 1).cast("string"), F.lit(" business days. You get $"),
        (number % 40).cast("string"), F.lit(".50 or a "), (number % 8 * 10).cast("string"),
        F.lit("% refund, as our policy states. We promise a call within "), (number % 5 + 2).cast("string"), F.lit(" hours."),
    )
    drafts = table(spark, sf_dir, "documents").select("doc_id", claim.alias("draft_reply"))
    known = (
        common.neighbours(spark, sf_dir)
        .where("rank <= 3")
        .join(drafts.select(F.col("doc_id").alias("match_id"), F.col("draft_reply").alias("reply")), "match_id")
        .groupBy(F.col("vec_id").alias("doc_id"))
        .agg(F.array_sort(F.collect_list(F.struct("rank", "reply"))).alias("_known"))
        .select("doc_id", F.col("_known.reply").alias("precedents"))
    )
    return drafts.join(known, "doc_id", "left")


DRAFTS = f"""{NEIGHBOURS},
drafts AS (
  SELECT doc_id, 'We will reply within ' || (doc_id % 6 + 1) || ' business days. You get $' || (doc_id % 40) || '.50 or a '
    || (doc_id % 8 * 10) || '% refund, as our policy states. We promise a call within ' || (doc_id % 5 + 2) || ' hours.' AS draft
  FROM documents),
known AS (
  SELECT n.vec_id AS doc_id, lower(string_agg(d.draft, ' ' ORDER BY n.rank)) AS known
  FROM neighbours n JOIN drafts d ON d.doc_id = n.match_id WHERE n.rank <= 3 GROUP BY 1),
pairs AS (SELECT d.doc_id, d.draft, coalesce(k.known, '') AS known FROM drafts d LEFT JOIN known k ON k.doc_id = d.doc_id)"""


def sql_flags(patterns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT doc_id, {sql_text(label)} AS pattern_type, unnest(regexp_extract_all(draft, '(?i){pattern}')) AS matched_text, known FROM pairs"
        for pattern, label in patterns
    )


MESSAGE = "'Unverifiable claim detected: ''' || matched_text || ''' (type: ' || pattern_type || ') not found in retrieved precedents.'"


@query(
    "guardrail_flags",
    f"""WITH {DRAFTS}, flags AS ({sql_flags(fixed.CLAIM_PATTERNS)})
SELECT doc_id, pattern_type, matched_text, false AS grounded, {MESSAGE} AS message FROM flags WHERE NOT contains(known, lower(matched_text))""",
)
def flags(spark, sf_dir):
    return guardrail_flags(draft_replies(spark, sf_dir), "doc_id")


CONFIGURED = [(pattern, fixed.CUSTOM_CLAIM_LABEL) for pattern in fixed.CONFIGURED_CLAIM_PATTERNS]


@query(
    "guardrail_flags_custom",
    f"""WITH {DRAFTS}, flags AS ({sql_flags(CONFIGURED)})
SELECT doc_id, pattern_type, matched_text, false AS grounded, {MESSAGE} AS message FROM flags WHERE NOT contains(known, lower(matched_text))""",
)
def flags_custom(spark, sf_dir):
    """A caller's patterns instead of the built-in ones."""
    return guardrail_flags(draft_replies(spark, sf_dir), "doc_id", patterns=fixed.CONFIGURED_CLAIM_PATTERNS)


@query(
    "reply_safety",
    f"""WITH {DRAFTS}, flags AS ({sql_flags(fixed.CLAIM_PATTERNS)}),
bad AS (SELECT doc_id, count(*) AS n FROM flags WHERE NOT contains(known, lower(matched_text)) GROUP BY 1)
SELECT p.doc_id, coalesce(b.n, 0) AS n_flags, b.n IS NULL AS is_safe FROM pairs p LEFT JOIN bad b ON b.doc_id = p.doc_id""",
)
def safety(spark, sf_dir):
    rows = reply_safety(draft_replies(spark, sf_dir))
    return rows.select("doc_id", F.col("n_flags").cast("long").alias("n_flags"), "is_safe")


@query(
    "normalised_vectors",
    """SELECT vec_id, round(list_sum(list_transform(v, lambda x: x * x)), 6) AS squares, round(v[1] / sqrt(s), 6) AS first_value
FROM (SELECT vec_id, list_transform(w, lambda x: x / sqrt(s)) AS v0, w, s, list_transform(w, lambda x: x / sqrt(s)) AS v FROM (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (vec_id % 5 + 1)) AS w,
         list_sum(list_transform(embedding, lambda x: (CAST(x AS DOUBLE) * (vec_id % 5 + 1)) ** 2)) AS s FROM embeddings))""".replace(
        "round(v[1] / sqrt(s), 6)", "round(v[1], 6)"
    ),
)
def normalised_vectors(spark, sf_dir):
    """Stretched vectors brought back to unit length."""
    stretched = F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") % 5 + 1))
    rows = common.vectors(spark, sf_dir).select("vec_id", normalise(stretched).alias("unit"))
    squares = F.aggregate("unit", F.lit(0.0), lambda total, x: total + x * x)
    return rows.select("vec_id", F.round(squares, 6).alias("squares"), F.round(F.get("unit", F.lit(0)), 6).alias("first_value"))


@query(
    "parsed_urgency",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'neutral' ELSE event_type END AS sentiment,
       CASE WHEN event_id % 5 = 0 THEN 'low' END AS urgency,
       CASE WHEN event_id % 5 = 0 THEN 0.0::DOUBLE ELSE CAST(props->>'k' AS INT) / 100.0::DOUBLE END AS urgency_score FROM events""",
)
def parsed_urgency(spark, sf_dir):
    """Model answers in fences, with and without a language tag, some of them broken."""
    body = F.concat(
        F.lit('{"sentiment": "'), F.col("event_type"), F.lit('", "urgency_score": '),
        (F.get_json_object("props", "$.k").cast("int") / F.lit(100.0)).cast("string"), F.lit("}"),
    )
    raw = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("not {"), body))
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n``` done")))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit("```"), body, F.lit("```")))
        .otherwise(body)
    )
    rows = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return rows.select("event_id", urgency_signals(F.col("raw")).alias("_signals")).select("event_id", "_signals.*")


def label_answers(asked):
    """The answer of a model to each batch: entries out of range, repeated and missing; some broken."""
    name = lambda i: intent_of((F.col("batch") + i) % 10)
    entry = lambda i, label: F.concat(F.lit('{"index": '), i.cast("string"), F.lit(', "intent": "'), label, F.lit('"}'))
    size = F.size("texts")
    regular = F.transform(F.sequence(F.lit(0), size - 1), lambda i: entry(i, name(i)))
    extra = F.array(entry(F.lit(1), F.lit("delivery_problem")), entry(size + 1, F.lit("app_technical")))
    text = F.concat(F.lit("["), F.array_join(F.concat(regular, extra), ", "), F.lit("]"))
    raw = F.when(F.col("batch") % 4 == 3, F.concat(F.lit("Sorry. "), text)).when(
        F.col("batch") % 4 == 2, F.concat(F.lit("```json\n"), text, F.lit("\n```"))
    ).otherwise(text)
    return asked.select("batch", raw.alias("raw"))


BATCHED = f"""{MESSAGES},
placed AS (SELECT tweet_id, position, text, row_number() OVER (ORDER BY position) - 1 AS place FROM messages WHERE inbound),
batched AS (SELECT tweet_id, position, text, place // 20 AS batch, CAST(place % 20 + 1 AS INT) AS index FROM placed),
sized AS (SELECT *, count(*) OVER (PARTITION BY batch) AS size FROM batched),
labelled AS (
  SELECT tweet_id, batch, index, CASE WHEN batch % 4 = 3 THEN NULL WHEN index = 1 THEN 'delivery_problem'
         WHEN index < size THEN {NAMES}[(batch + index) % 10 + 1] END AS intent FROM sized)"""


@query("batch_labels", f"WITH {BATCHED} SELECT tweet_id, batch, index, intent FROM labelled")
def labels_of_batches(spark, sf_dir):
    """One label per message from the answers to batches of twenty."""
    rows = common.messages(spark, sf_dir).where("inbound").select("tweet_id", "position", "text")
    batched = labelling.in_batches(rows, "position")
    answers = label_answers(labelling.batch_texts(batched))
    return batch_labels(answers, batched).select("tweet_id", "batch", "index", "intent")


FIRST_NAME = "coalesce(" + ", ".join(
    f"CASE WHEN contains(lower(answer), '{name}') THEN '{name}' END" for name in fixed.INTENT_NAMES
) + f", '{fixed.FALLBACK_INTENT}')"


@query(
    "label_from_answer",
    f"""WITH {PREDICTIONS},
answers AS (
  SELECT vec_id, CASE WHEN vec_id % 6 = 0 THEN 'no idea' WHEN vec_id % 6 = 1 THEN 'Either ' || upper(intent) || ' or ' || truth
                      ELSE 'Intent: ' || intent || '.' END AS answer FROM predictions)
SELECT vec_id, {FIRST_NAME} AS human_intent FROM answers""",
)
def label_from_answer(spark, sf_dir):
    """First taxonomy name in a free-text answer."""
    number = F.col("vec_id") % 6
    answer = (
        F.when(number == 0, "no idea")
        .when(number == 1, F.concat(F.lit("Either "), F.upper("intent"), F.lit(" or "), F.col("truth")))
        .otherwise(F.concat(F.lit("Intent: "), F.col("intent"), F.lit(".")))
    )
    return common.predictions(spark, sf_dir).select("vec_id", label_in_answer(answer).alias("human_intent"))


@query(
    "typed_labels",
    f"""WITH {PREDICTIONS},
typed AS (
  SELECT vec_id, intent, lower(trim(CASE vec_id % 6 WHEN 0 THEN '' WHEN 1 THEN ' ' || upper(intent) WHEN 2 THEN upper(truth)
    WHEN 3 THEN 'refund' WHEN 4 THEN 'pr' ELSE 'nothing like it' END)) AS wanted FROM predictions),
matched AS (SELECT *, list_filter({NAMES}, lambda x: contains(x, wanted)) AS hits FROM typed)
SELECT vec_id, CASE WHEN wanted = '' OR wanted = intent THEN intent WHEN list_contains({NAMES}, wanted) THEN wanted
                    WHEN len(hits) = 1 THEN hits[1] END AS human_intent,
       CASE WHEN wanted = '' OR wanted = intent THEN 'accepted' WHEN list_contains({NAMES}, wanted) THEN 'exact'
            WHEN len(hits) = 1 THEN 'partial' WHEN len(hits) > 1 THEN 'ambiguous' ELSE 'unknown' END AS status FROM matched""",
)
def typed_labels(spark, sf_dir):
    """Typed labels resolved against prediction and taxonomy."""
    number = F.col("vec_id") % 6
    typed = (
        F.when(number == 0, "")
        .when(number == 1, F.concat(F.lit(" "), F.upper("intent")))
        .when(number == 2, F.upper("truth"))
        .when(number == 3, "refund")
        .when(number == 4, "pr")
        .otherwise("nothing like it")
    )
    return common.predictions(spark, sf_dir).select(
        "vec_id", normalise_label(typed, F.col("intent")).alias("human_intent"), label_status(typed, F.col("intent")).alias("status")
    )


@query(
    "labelling_prompts",
    f"""WITH {BATCHED},
texts AS (SELECT batch, string_agg(index || '. ' || text, chr(10) ORDER BY index) AS lines FROM batched GROUP BY 1)
SELECT batch, md5({sql_fill(fixed.LABEL_PROMPT, taxonomy=sql_text(prompts.taxonomy_text()), messages='lines')}) AS digest FROM texts""",
)
def labelling_prompts(spark, sf_dir):
    rows = common.messages(spark, sf_dir).where("inbound").select("tweet_id", "position", "text")
    batched = labelling.in_batches(rows, "position")
    asked = labelling.batch_texts(batched)
    return asked.select("batch", F.md5(prompts.labelling_prompt(F.col("texts"))).alias("digest"))


NAME_LINES = sql_text("\n".join(f"- {name}" for name in fixed.INTENT_NAMES))


@query(
    "single_label_prompts",
    f"""WITH {MESSAGES}
SELECT tweet_id, md5({sql_fill(fixed.SINGLE_LABEL_PROMPT, intents=NAME_LINES, message='text')}) AS digest FROM messages WHERE inbound""",
)
def single_label_prompts(spark, sf_dir):
    rows = common.messages(spark, sf_dir).where("inbound")
    return rows.select("tweet_id", F.md5(prompts.single_label_prompt(F.col("text"))).alias("digest"))


def prompt_inputs(spark, sf_dir):
    """Threads with prediction and examples of the vector whose id is the conversation number."""
    rows = common.clean_threads(spark, sf_dir).withColumn("vec_id", common.vector_id())
    replies = rows.select(
        F.col("vec_id").alias("match_id"), "customer_text", F.coalesce("brand_reply", F.lit("")).alias("brand_reply")
    )
    found = nested_examples(common.neighbours(spark, sf_dir).join(replies, "match_id"), "vec_id")
    number = F.col("vec_id") % 3
    mood = F.when(number == 0, "urgent").when(number == 1, "negative").otherwise("neutral")
    return (
        rows.join(common.predictions(spark, sf_dir), "vec_id").join(found, "vec_id", "left").withColumn("sentiment", mood)
    )


EXAMPLE = sql_fill(
    fixed.REPLY_EXAMPLE, rank="n.rank", similarity="printf('%.2f', round_even(n.similarity, 2))",
    customer_text="c.customer_text", brand_reply="c.brand_reply",
)
PRECEDENT = sql_fill(fixed.JUDGE_EXAMPLE, rank="n.rank", customer_text="c.customer_text", brand_reply="c.brand_reply")
PROMPTS = f"""{THREADS},
clean AS (
  SELECT thread_id, CAST(thread_id AS BIGINT) // 1000000 AS vec_id, brand, {sql_redact('customer_text')} AS customer_text,
         {sql_redact('brand_reply')} AS brand_reply FROM threads),
{PREDICTIONS},
lines AS (
  SELECT t.thread_id, t.turn, CASE WHEN t.inbound THEN 'Customer' ELSE c.brand END || ': ' || {sql_redact('t.text')} AS line
  FROM turns t JOIN clean c ON c.thread_id = t.thread_id
  QUALIFY row_number() OVER (PARTITION BY t.thread_id ORDER BY t.turn DESC) <= 6),
history AS (SELECT thread_id, string_agg(line, chr(10) ORDER BY turn) AS history FROM lines GROUP BY 1),
examples AS (
  SELECT n.vec_id, string_agg({EXAMPLE}, chr(10) || chr(10) ORDER BY n.rank) AS context,
         string_agg({PRECEDENT}, chr(10) || chr(10) ORDER BY n.rank) AS precedents
  FROM neighbours n JOIN clean c ON c.vec_id = n.match_id GROUP BY 1),
inputs AS (
  SELECT c.*, p.intent, coalesce(e.context, {sql_text(fixed.NO_PRECEDENTS)}) AS context, coalesce(e.precedents, 'None') AS precedents,
         {sql_text(fixed.HISTORY_HEADER)} || h.history || chr(10) AS history,
         CASE c.vec_id % 3 WHEN 0 THEN {sql_text(fixed.URGENT_NOTE)} WHEN 1 THEN {sql_text(fixed.NEGATIVE_NOTE)} ELSE '' END AS note
  FROM clean c JOIN predictions p ON p.vec_id = c.vec_id JOIN history h ON h.thread_id = c.thread_id
  LEFT JOIN examples e ON e.vec_id = c.vec_id)"""
REPLY_SYSTEM_SQL = sql_fill(fixed.REPLY_SYSTEM, brand="brand", sentiment_note="note")
REPLY_USER_SQL = sql_fill(
    fixed.REPLY_USER, intent="intent", description="intent", context="context", history="history", message="customer_text"
)
JUDGE_USER_SQL = sql_fill(
    fixed.JUDGE_USER, intent="intent", message="customer_text", context="precedents", draft="brand_reply"
)


@query(
    "reply_prompts",
    f"WITH RECURSIVE {PROMPTS} SELECT thread_id, md5({REPLY_SYSTEM_SQL}) AS system_digest, md5({REPLY_USER_SQL}) AS user_digest FROM inputs",
)
def reply_prompts(spark, sf_dir):
    rows = prompt_inputs(spark, sf_dir)
    chat = prompts.reply_chat(
        F.col("customer_text"), F.col("intent"), F.col("intent"), F.col("examples"), F.col("turns"), F.col("brand"), F.col("sentiment")
    )
    return rows.select("thread_id", chat.alias("_chat")).select(
        "thread_id",
        F.md5(F.get("_chat", F.lit(0))["content"]).alias("system_digest"),
        F.md5(F.get("_chat", F.lit(1))["content"]).alias("user_digest"),
    )


@query("judge_prompts", f"WITH RECURSIVE {PROMPTS} SELECT thread_id, md5({JUDGE_USER_SQL}) AS user_digest FROM inputs")
def judge_prompts(spark, sf_dir):
    rows = prompt_inputs(spark, sf_dir)
    chat = prompts.judge_chat(F.col("customer_text"), F.col("brand_reply"), F.col("examples"), F.col("intent"))
    return rows.select("thread_id", F.md5(F.get(chat, F.lit(1))["content"]).alias("user_digest"))


@query(
    "urgency_prompts",
    f"WITH {MESSAGES} SELECT tweet_id, md5({sql_fill(fixed.URGENCY_USER, message='text')}) AS user_digest FROM messages WHERE inbound",
)
def urgency_prompts(spark, sf_dir):
    rows = common.messages(spark, sf_dir).where("inbound")
    chat = prompts.urgency_chat(F.col("text"))
    return rows.select("tweet_id", F.md5(F.get(chat, F.lit(1))["content"]).alias("user_digest"))


@query(
    "turns_as_json",
    f"""WITH RECURSIVE {CLEAN}
SELECT thread_id, n_turns, n_turns AS n_parsed, md5(customer_text) AS first_customer FROM clean""",
)
def turns_as_json(spark, sf_dir):
    """Turn arrays as JSON text and parsed back."""
    schema = "array<struct<tweet_id:string,author_id:string,text:string,inbound:boolean,created_at:string>>"
    rows = flatten_threads(common.clean_threads(spark, sf_dir)).withColumn("_turns", F.from_json("turns_json", schema))
    first = F.get(F.filter("_turns", lambda turn: turn["inbound"]), F.lit(0))["text"]
    return rows.select(
        "thread_id",
        F.col("n_turns").cast("long").alias("n_turns"),
        F.size("_turns").cast("long").alias("n_parsed"),
        F.md5(first).alias("first_customer"),
    )


def sql_number(name: str) -> str:
    return f"printf('%.2f', round_even({name}, 2))"


REASONS = f"""list_filter([
      CASE WHEN lang <> 'en' THEN 'Message appears to be non-English; requires specialized handling.' END,
      CASE WHEN intent IN ('billing_payment', 'account_access', 'seller_complaint') THEN 'Intent ''' || intent
        || ''' is in the high-risk escalation denylist (billing/account/security issues require human review).' END,
      CASE WHEN confidence < 0.7 THEN 'Classifier confidence is low (' || {sql_number('confidence')}
        || ' < threshold 0.70); the predicted intent ''' || intent || ''' may be incorrect.' END,
      CASE WHEN similarity < 0.6 THEN 'Best retrieval similarity is ' || {sql_number('similarity')}
        || ' (< threshold 0.60); no sufficiently similar historical resolution found to ground a safe reply.' END,
      CASE WHEN urgency >= 0.8 THEN 'Urgency score ' || {sql_number('urgency')}
        || ' (>= threshold 0.80); customer appears very distressed (sentiment: ' || sentiment || ').' END,
      CASE WHEN len(regexp_extract_all(message, '\\S+')) < 3 THEN 'Message is very short (' || len(regexp_extract_all(message, '\\S+'))
        || ' words); insufficient context for reliable classification or reply generation.' END], lambda x: x IS NOT NULL)"""


@query(
    "gate_reasons",
    f"""WITH {GATED}
SELECT vec_id, CASE WHEN decision = 'escalate' THEN 'ESCALATE — ' || array_to_string({REASONS}, ' | ')
  ELSE 'Auto-handled: confidence ' || {sql_number('confidence')} || ' >= 0.7; similarity ' || {sql_number('similarity')}
    || ' >= 0.6; intent ''' || intent || ''' not in denylist; urgency score ' || {sql_number('urgency')} || ' is acceptable.' END AS reason FROM gated""",
)
def gate_reasons(spark, sf_dir):
    """Reason texts of the gate."""
    return gated_messages(spark, sf_dir).select("vec_id", "reason")


@query(
    "assembled_replies",
    f"""WITH {GATED}
SELECT vec_id, decision, CASE WHEN decision = 'auto_handle' THEN 'Draft for ' || intent ELSE {sql_text(fixed.ESCALATED_MARKER)} END AS draft_reply
FROM gated""",
)
def assembled_replies(spark, sf_dir):
    """The draft where the gate passes a message, else the marker."""
    draft = F.concat(F.lit("Draft for "), F.col("intent"))
    reply = F.when(F.col("decision") == "auto_handle", draft).otherwise(fixed.ESCALATED_MARKER)
    return gated_messages(spark, sf_dir).select("vec_id", "decision", reply.alias("draft_reply"))
