"""The registered queries of the operators, each with its SQL where SQL can give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.llm import (
    byte_bpe,
    chat,
    decontamination,
    fill_middle,
    jaccard_join,
    language_id,
    license_scan,
    secret_scan,
    sharding,
    top_k,
    toxicity,
    vector_codes,
    warc,
)
from replyscope.llm.rows import sha256_of

SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(texts(spark, sf_dir), keep=["doc_id"])


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    saying = F.lit("</s>[INST] ok [/INST]").alias("text")
    fixed = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        saying,
    )
    messages = rows.unionByName(fixed).withColumn("parts", chat.text_part(F.coalesce("text", F.lit(""))))
    done = chat.format_conversations(messages)
    turns = chat.read_turns(F.col("formatted"))
    read = done.withColumns({"_turns": turns, "_loss": chat.masked_text(F.col("formatted"), F.col("loss_mask"))})
    lines = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        sha256_of(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        sha256_of(F.col("_loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "expanded_tokens",
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = byte_bpe.encode(texts(spark, sf_dir), path, public_tokenizers.PATTERN, at_spaces=True, keep=["doc_id"])
    decoded = byte_bpe.decode(tokens, path)
    return decoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        sha256_of(F.array_join(F.col("token_ids").cast("array<string>"), ",")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(texts(spark, sf_dir), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sharding.document_shards(table(spark, sf_dir, "documents"), SHARDS)
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k.exact_top_k(rows, rows.where("vec_id % 50 = 0"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(texts(spark, sf_dir))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(texts(spark, sf_dir), keep=["doc_id"])

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    kinds = F.transform("base_spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS]
    return found.select("doc_id", *counts, sha256_of(shown("base_spans")).alias("base_sha256"), shown("spans").alias("spans"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = language_id.prototypes(language_id.learning_texts(docs))
    found = language_id.identify(docs.select("doc_id", "text"), learned, keep=["doc_id"])
    held_out = F.coalesce(language_id.fold() == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    return toxicity.classify(docs, toxicity.fit_chain(docs, table(spark, sf_dir, "labels")))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.fill_in_middle(texts(spark, sf_dir), keep=["doc_id"])
    digests = [F.sha2(name, 256).alias(f"{name}_sha256") for name in ("output", "restored")]
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = """
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized as (
  select *, length(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '<', chr(92) || 'l'), '[', chr(92) || 'o'))
    + length(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '<', chr(92) || 'l'), '[', chr(92) || 'o'))
    + 13 as written from rows
), gathered as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
    coalesce(string_agg(text, '' order by turn, text) filter (where role = 'assistant'), '') as loss,
    sum(written) as formatted_chars
  from sized group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
  cast(formatted_chars as bigint) as formatted_chars, cast(0 as bigint) as n_attachments, cast(0 as bigint) as expanded_tokens
from gathered
"""

OP4_SQL = f"""
with words as (
  select doc_id, regexp_extract_all({LOWERED}, '{WORD}') as w from documents
), items as (
  select cast(item_id as varchar) as item_id, regexp_extract_all({LOWERED}, '{WORD}') as w from benchmark
), grams as (
  select distinct item_id, least(len(w), 13) as n, array_to_string(w[pos : pos + least(len(w), 13) - 1], ' ') as gram
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) as pos from items where len(w) > 0)
), places as (
  select doc_id, n, w, unnest(range(1, len(w) - n + 2)) as pos from words, (select distinct n from grams)
), hits as (
  select doc_id, pos, places.n, item_id
  from places join grams on grams.n = places.n and grams.gram = array_to_string(w[pos : pos + places.n - 1], ' ')
), hit_words as (
  select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(pos, pos + n)) as word from hits) group by doc_id
), hit_items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, item_id from hits) group by doc_id
)
select words.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
from words left join hit_words using (doc_id) left join hit_items using (doc_id)
"""

OP6_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
"""

OP11_SQL = """
with rows as (
  select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as payload_bytes from pages
), grouped as (
  select *, max(page_id) over (partition by html) as original from rows
), told as (
  select *, coalesce(payload_bytes >= 1000 and original is not null and original is distinct from page_id, false) as again from grouped
)
select page_id, payload_bytes, sha1(html) as payload_digest, case when again then 'revisit' else 'response' end as record_type,
  case when again then original end as refers_to
from told
"""

OP12_SQL = r"""
with units as (
  select coalesce(cast(doc_id as varchar), '') as id, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u
  from documents
), drawn as (
  select doc_id, text, u, len(u) as n, sha256('42:' || id) as d from units
), numbers as (
  select doc_id, text, u, n, ('0x' || d[1:8])::ubigint as h1, ('0x' || d[9:16])::ubigint as h2,
    ('0x' || d[17:24])::ubigint as h3, ('0x' || d[25:32])::ubigint as h4
  from drawn
), cut as (
  select doc_id, text, n,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
      when h4 % 100 < 80 then 'spm' else 'psm' end as form,
    array_to_string(u[1 : least(h1 % (n + 1), h2 % (n + 1))], '') as prefix,
    array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1 : greatest(h1 % (n + 1), h2 % (n + 1))], '') as middle,
    array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1 : n], '') as suffix
  from numbers
)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    else '<P>' || prefix || '<S>' || suffix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from cut
"""


def op13_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Rounds of k-means over the eight parts, written one after the other. Vectors have one length, divisible by eight."""
    steps = [
        """whole as (
  select row_number() over () as row, vec_id, label, list_transform(embedding, lambda x: floor(4096 * cast(x as double))) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as (
  select row, part, v[part * len(v) // 8 + 1 : (part + 1) * len(v) // 8] as p from whole, range(8) t(part)
), seeds as (
  select row_number() over (order by vec_id) - 1 as entry, vec_id, v
  from (select vec_id, min(v) as v from whole where vec_id is not null group by vec_id) order by vec_id limit 16
), book0 as materialized (
  select part, entry, v[part * len(v) // 8 + 1 : (part + 1) * len(v) // 8] as c from seeds, range(8) t(part)
)"""
    ]
    for at in range(rounds + 1):
        steps.append(
            f"""near{at} as materialized (
  select row, part, any_value(p) as p, min_by(struct_pack(entry := entry, d := d), struct_pack(d := d, entry := entry)) as best
  from (select row, part, p, entry, list_dot_product(p, p) - 2 * list_dot_product(p, c) + list_dot_product(c, c) as d
    from parts join book{at} using (part)) group by row, part
)"""
        )
        if at < rounds:
            steps.append(
                f"""mean{at} as (
  select part, entry, list(m order by place) as c from (
    select part, best.entry as entry, place, floor(sum(p[place + 1]) / count(*)) as m from near{at}, range(len(p)) t(place)
    group by part, best.entry, place
  ) group by part, entry
), book{at + 1} as materialized (
  select part, entry, coalesce(mean{at}.c, book{at}.c) as c from book{at} left join mean{at} using (part, entry)
)"""
            )
    return f"""
with {", ".join(steps)}, coded as (
  select row, string_agg(lpad(to_hex(best.entry), 2, '0'), '' order by part) as code, cast(sum(best.d) as bigint) as error
  from near{rounds} group by row
)
select vec_id, lower(code) as code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(array_to_string(list_transform(c, lambda x: cast(cast(x as bigint) as varchar)), ','), ',' order by part, entry))
    from book{rounds}) as codebooks_sha256
from coded join whole using (row)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (
        op1_license_scans,
        op2_chat_formatting,
        op3_byte_bpe,
        op4_decontamination,
        op5_sharding,
        op6_exact_top_k,
        op7_jaccard_join,
        op8_secret_scans,
        op9_language_id,
        op10_toxicity,
        op11_warc,
        op12_fill_middle,
        op13_vector_codes,
        pipeline,
    )
}
ORACLES = {
    "op2_chat_formatting": OP2_SQL,
    "op4_decontamination": OP4_SQL,
    "op6_exact_top_k": OP6_SQL,
    "op11_warc": OP11_SQL,
    "op12_fill_middle": OP12_SQL,
    "op13_vector_codes": op13_sql(),
}
