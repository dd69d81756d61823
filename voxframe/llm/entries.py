"""The operators' queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprint, hardneg, infill, langid, linededup, media, neardup, packing, quality, tokencount, urlfilter, warc
from ._common import materialise, read


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_payloads(read(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), percent=85)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read(spark, sf_dir, "pages"), urlfilter.RULES)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialise(fingerprint.edited_likeness(read(spark, sf_dir, "documents")), "fingerprints")
    return fingerprint.near_lists(found, F.col("doc_id") % 100 == 0)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read(spark, sf_dir, "pages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mined(read(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digests(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_language_id, op3_media, op4_near_duplicates, op5_line_dedup, op6_quality, op7_token_counts, op8_bpe, op9_url_filter, op10_fingerprints, op11_warc, op12_hard_negatives, op13_infill)}

ORACLE_SQL = {
    "op5_line_dedup": r"""
with split as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), line as (
    select doc_id, generate_subscripts(lines, 1) as pos, unnest(lines) as line from split
), keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from line
), repeated as (
    select key, max(doc_id) as last_doc from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), marked as (
    select k.doc_id, k.pos, k.line, coalesce(k.doc_id <> r.last_doc, false) as dropped from keyed k left join repeated r on k.key = r.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
""",
    "op11_warc": """
with page as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), grouped as (
    select *, min(page_id) over (partition by payload_digest) as first_id from page
), referring as (
    select *, payload_bytes >= 100 and page_id is distinct from first_id as again from grouped
)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type, case when again then first_id end as refers_to
from referring
""",
    "op12_hard_negatives": """
with taking_part as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
    select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
    from taking_part a join taking_part b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positive as (
    select anchor_id, other_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
), ranked as (
    select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by n.score desc, n.other_id)::int as rank,
        n.other_id as negative_id, positive_score, n.score as negative_score
    from positive p join scored n on p.anchor_id = n.anchor_id and not n.same and 30 * positive_score <= 100 * n.score and 100 * n.score <= 90 * positive_score
)
select * from ranked where rank <= 10
""",
    "op13_infill": r"""
with doc as (
    select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as h from documents
), cut as (
    select *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units,
        ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2, ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
    from doc
), counted as (
    select *, len(units) as n from cut
), formed as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form
    from counted
), parted as (
    select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle, array_to_string(units[b + 1:], '') as suffix from formed
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from parted
""",
}
