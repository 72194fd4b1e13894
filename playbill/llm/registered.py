"""The registered queries of this subpackage, with production parameters."""

import public_tokenizers
from pyspark.sql import functions as F

from playbill.llm import (
    fill_in_middle,
    fingerprints,
    guess_cost,
    label_shards,
    packing,
    piece_codec,
    quality_model,
    rule_cascade,
    surrogates,
    threshold_search,
    token_files,
    warc,
    whitening,
)
from playbill.llm.support import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: For the checks; a job that hides real data passes a key of its own.
SURROGATE_KEY = "key of the checks"


def op1_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


def op2_factorisation(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_model.score(docs, quality_model.train(docs, labels))


def op3_warc(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op4_simhash(spark, sf_dir):
    found = fingerprints.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op5_surrogates(spark, sf_dir):
    return surrogates.replace_entities(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op6_secrets(spark, sf_dir):
    return guess_cost.secret_spans(table(spark, sf_dir, "documents"))


def op7_top_k(spark, sf_dir):
    return threshold_search.top_k(table(spark, sf_dir, "embeddings"))


def op8_sentencepiece(spark, sf_dir):
    return piece_codec.round_trip(table(spark, sf_dir, "documents"), PIECE_BPE)


def op9_shards(spark, sf_dir):
    return label_shards.shard_documents(table(spark, sf_dir, "documents"))


def op10_rules(spark, sf_dir):
    return rule_cascade.apply_rules(table(spark, sf_dir, "documents"))


def op11_token_files(spark, sf_dir):
    return token_files.token_round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


def op12_whitening(spark, sf_dir):
    made = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # A deviation beyond 64 bits fails the job (ANSI cast) instead of wrapping around.
    return made.withColumn("deviation", F.col("deviation").cast("long"))


def op13_fill_in_middle(spark, sf_dir):
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_packing": op1_packing,
    "op2_factorisation": op2_factorisation,
    "op3_warc": op3_warc,
    "op4_simhash": op4_simhash,
    "op5_surrogates": op5_surrogates,
    "op6_secrets": op6_secrets,
    "op7_top_k": op7_top_k,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_shards": op9_shards,
    "op10_rules": op10_rules,
    "op11_token_files": op11_token_files,
    "op12_whitening": op12_whitening,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_RULES = """
10 * n_symbols > 3 * n_words
or (2 * n_dup_lines > n_lines and n_dup_lines > 2)
or word_chars < 3 * n_words
or word_chars > 20 * n_words
or 5 * len(list_filter(words, lambda w: regexp_matches(w, '\\p{L}'))) < 4 * n_words
or 2 * len(list_filter(words, lambda w: length(w) > 2 and w = upper(w) and w <> lower(w))) > n_words
or (3 * n_words > 10 * len(list_distinct(words)) and n_words < 100)
or 10 * len(list_filter(range(2, greatest(3, n_words + 1)), lambda i: words[i] = words[i - 1]))
    > 2 * n_words
or 10 * len(list_filter(words, lambda w: w like '%...')) > 3 * n_words
"""
#: The SQL that an independent engine runs on the same tables, where SQL can express a query.
ORACLE: dict[str, str] = {
    "op3_warc": """
with captures as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hashed,
           min(page_id) over (partition by coalesce(html, '')) as first_id
    from pages
), digits as (
    select *, cast(cast(unhex(hashed) as bit) as varchar) as bits from captures
)
select page_id, strlen(payload) as payload_bytes,
       array_to_string(list_transform(range(0, 160, 5), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + 16 * cast(substr(bits, i + 1, 1) as integer)
             + 8 * cast(substr(bits, i + 2, 1) as integer)
             + 4 * cast(substr(bits, i + 3, 1) as integer)
             + 2 * cast(substr(bits, i + 4, 1) as integer)
             + cast(substr(bits, i + 5, 1) as integer), 1)), '') as payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to,
       true as has_request
from digits
""",
    "op7_top_k": """
with vectors as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
    from vectors q join vectors c on q.vec_id <> c.vec_id
    where q.vec_id % 50 = 0
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as place
    from scored
)
select query_id, cast(place as integer) as "rank", vec_id, score from ranked where place <= 5
""",
    "op10_rules": f"""
with listed as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
    from documents
), windows as (
    select doc_id, place, words[place:place + 7] as part
    from (select doc_id, words, unnest(range(1, len(words) - 6)) as place from listed)
), again as (
    select doc_id, place from (
        select *, count(*) over (partition by doc_id, part) as times from windows
    ) where times > 1
), covered as (
    select doc_id, sum(least(8, coalesce(place - before, 8))) as n from (
        select *, lag(place) over (partition by doc_id order by place) as before from again
    ) group by doc_id
), figures as (
    select doc_id, words, cast(len(words) as bigint) as n_words, len(lines) as n_lines,
           cast(length(array_to_string(words, '')) as bigint) as word_chars,
           cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
           cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
           cast(coalesce(n, 0) as bigint) as n_repeat_words
    from listed left join covered using (doc_id)
), judged as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from figures
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not coalesce({_RULES}, false) as kept
from judged
""",
    "op13_fill_in_middle": """
with hashed as (
    select doc_id, coalesce(text, '') as text, cast(length(coalesce(text, '')) as bigint) as n,
           sha256('1:' || coalesce(cast(doc_id as varchar), '')) as digits
    from documents
), numbers as (
    select *, cast('0x' || substr(digits, 1, 8) as bigint) % (n + 1) as p1,
           cast('0x' || substr(digits, 9, 8) as bigint) % (n + 1) as p2,
           cast('0x' || substr(digits, 17, 8) as bigint) % 100 as h3,
           cast('0x' || substr(digits, 25, 8) as bigint) % 100 as h4
    from hashed
), formed as (
    select *, least(p1, p2) as a, greatest(p1, p2) as b,
           case when n = 0 or contains(text, '<P>') or contains(text, '<S>')
                     or contains(text, '<M>') or h3 >= 90 then 'plain'
                when h4 < 20 then 'spm' else 'psm' end as form
    from numbers
), cut as (
    select *, substr(text, 1, a) as prefix, substr(text, a + 1, b - a) as middle,
           substr(text, b + 1) as suffix
    from formed
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then text
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end)
           as output_sha256,
       sha256(case form when 'plain' then text else prefix || middle || suffix end)
           as restored_sha256
from cut
""",
}
