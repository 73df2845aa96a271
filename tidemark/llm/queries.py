"""The queries opN_<name> over the synthetic tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid
from .bpe import encode_documents
from .decontam import contaminated
from .embed_dedup import near_vectors
from .line_dedup import dedup_lines
from .quality import classify
from .simhash import near_duplicates
from .substring import repeated_passages
from .url_filter import judge_urls
from .warc import archive_and_read


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive_and_read(table(spark, sf_dir, "pages").select("page_id", "url", "html"), with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "n_words", "tiles")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.train_on(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path()))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def digests(encoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_warc, op3_simhash, op4_embedding_dedup, op5_quality, op6_decontamination, op7_url_filter, op8_language_id, op9_bpe, op10_substring_dedup)}

ASCII_UP, ASCII_LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL = {
    "op1_line_dedup": f"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select *, translate(trim(line, {SPACE}), '{ASCII_UP}', '{ASCII_LOW}') as key from l),
lost as (select key, max(doc_id) as last from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
m as (select k.*, (lost.key is not null and k.doc_id is distinct from lost.last) as gone from k left join lost using (key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from m group by doc_id
""",
    "op2_warc": """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
d as (select page_id, octet_length(payload)::bigint as payload_bytes, sha256(payload) as payload_digest from p),
r as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest, payload_bytes) else page_id end as first from d)
select page_id, payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id != first then first end as refers_to
from r
""",
    "op4_embedding_dedup": """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings),
sound as (select * from v where label is not null and e is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(e, lambda x: x != 0)) > 0),
links as materialized (select a.vec_id as a, b.vec_id as b from sound a join sound b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id != b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.93),
reach(vec_id, low) as (select vec_id, vec_id from v union select links.b, reach.low from reach join links on links.a = reach.vec_id where reach.low < links.b),
c as (select vec_id, min(low) as component_id from reach group by vec_id)
select c.vec_id, (select count(*) from links where a = c.vec_id)::bigint as n_links, component_id, c.vec_id = component_id as kept from c
""",
    "op7_url_filter": """
with u as (select page_id, case when url like '%://%' then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
hp as (select page_id, regexp_extract(rest, '^[^/?#]*') as h, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
l as (select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from hp),
rules(rh, rp, says) as (values ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
m as (select l.*, rh || rp as rule, says, row_number() over (partition by page_id order by length(rh || rp) desc nulls last) as k
  from l left join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
select page_id, host, path, rule, coalesce(says, 'allow') as verdict from m where k = 1
""",
}
