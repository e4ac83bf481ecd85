"""One query per operator, each over its whole table."""

import public_tokenizers
from pyspark.sql import functions as F

from geolayers.llm.bilinear_lm import score_documents
from geolayers.llm.dart_minhash import duplicate_classes
from geolayers.llm.hard_negatives import mine_hard_negatives
from geolayers.llm.host_rules import FEATURES, judge_documents
from geolayers.llm.html_text import extract_text
from geolayers.llm.language_id import fold, learn_dictionaries, predict_languages
from geolayers.llm.packing import pack_documents
from geolayers.llm.pieces import decode_pieces, encode_sampled
from geolayers.llm.registry import ORACLES, QUERIES, query, table
from geolayers.llm.resampling import resample
from geolayers.llm.token_files import read_token_files, write_token_files
from geolayers.llm.topk import top_k
from geolayers.llm.url_trie import judge_urls, rule
from geolayers.llm.warc import read_captures, write_archives
from geolayers.session import shared_path

__all__ = ["ORACLES", "QUERIES"]

WORD_BPE, END = "word_bpe_49k.json", 2
PIECES = "piece_bpe_32k.model"

URL_RULES = [
    rule("allow", "com/"),
    rule("block", "example.com/en/"),
    rule("allow", "www.example.com/en/"),
    rule("block", "net/es/"),
    rule("block", "net/fr/"),
]


@query("op1_html_text")
def html_text(spark, source):
    return extract_text(table(spark, source, "pages"))


@query("op2_token_files")
def token_files(spark, source):
    path = shared_path(spark, "tokens")
    write_token_files(table(spark, source, "documents"), path, public_tokenizers.path(WORD_BPE), END)
    found = read_token_files(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


WORD = r"[^\x20\x09-\x0D]+"

HOST_RULES_SQL = rf"""
with w as (
  select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{WORD}') as words
  from documents
), p as (
  select doc_id, unnest(words) as word, unnest(range(len(words))) as i from w
), g as (
  select doc_id, i, word || ' ' || lead(word, 1) over d || ' ' || lead(word, 2) over d as win
  from p window d as (partition by doc_id order by i)
), again as (
  select doc_id, i from g where win is not null qualify count(*) over (partition by doc_id, win) > 1
), repeated as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from again) group by 1
), lines as (
  select doc_id, count(*) - count(distinct line) as n
  from (select doc_id, unnest(string_split(text, chr(10))) as line from w)
  where regexp_matches(line, '{WORD}') group by 1
), f as (
  select w.doc_id, source, len(words) as n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(lines.n, 0) as n_dup_lines, coalesce(repeated.n, 0) as n_repeat_words
  from w left join lines using (doc_id) left join repeated using (doc_id)
), b as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f
), h as (
  select source, count(*) as n, count(*) filter (base_failed) as f from b where source is not null group by 1
), s as (
  select count(*) as hosts, sum(n) as docs, sum(n * n) as squares, sum(f) / sum(n) as m,
         sum(f * f / n) as ratio from h
), t as (
  select *, case when m in (0, 1) then 0 else (ratio - docs * m * m) / (m * (1 - m)) end as spread,
         docs - squares / docs - (hosts - 1) as room from s
), k as (
  select m, 1 / least(greatest(case when room > 0 then (spread - (hosts - 1)) / room else 0 end, 1e-6), 1 - 1e-6) - 1 as k
  from t
), bad as (
  select source from h, k where (f + m * k) / (n + k) > 0.5
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (source is not null and source in (select source from bad)) as kept,
       source is not null and source in (select source from bad) as host_failed
from b"""


@query("op3_host_rules", HOST_RULES_SQL)
def host_rules(spark, source):
    judged = judge_documents(table(spark, source, "documents").select("doc_id", "source", "text"))
    return judged.select("row.doc_id", *(f"measures.{c}" for c in FEATURES), "base_failed", "kept", "host_failed")


TOP_K_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score
from s qualify rank <= 20"""


@query("op4_nra_top_k", TOP_K_SQL)
def nra_top_k(spark, source):
    return top_k(table(spark, source, "embeddings"), F.col("id") % 20 == 0)


@query("op5_bilinear_lm")
def bilinear_lm(spark, source):
    docs = table(spark, source, "documents")
    return score_documents(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1)


@query("op6_dart_minhash")
def dart_minhash(spark, source):
    return duplicate_classes(table(spark, source, "documents"))


@query("op7_packing")
def packing(spark, source):
    pieces = pack_documents(table(spark, source, "documents"), public_tokenizers.path(WORD_BPE), END)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


@query("op8_sampled_pieces")
def sampled_pieces(spark, source):
    model = public_tokenizers.path(PIECES)
    encoded = encode_sampled(table(spark, source, "documents").select("doc_id", "text"), model)
    decoded = decode_pieces(encoded, model)
    return decoded.select(
        F.col("row.row.doc_id").alias("doc_id"),
        F.expr("length(row.ids) div 4").alias("n_pieces"),
        F.crc32("row.ids").alias("ids_crc32"),
        F.col("text").eqNullSafe(F.col("row.row.text")).alias("lossless"),
    )


@query("op9_language_id")
def language_id(spark, source):
    docs = table(spark, source, "documents").select("doc_id", "text", "lang")
    dictionaries = learn_dictionaries(docs.filter(fold("doc_id") != 2))
    found = predict_languages(docs.select("doc_id", "text"), dictionaries)
    return found.select("row.doc_id", (fold("row.doc_id") == 2).alias("held_out"), "lang_pred", "score", "accepted")


URL_TRIE_SQL = """
with u as (
  select page_id, coalesce(instr(url, '://') > 0, false) as has,
         regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') as rest
  from pages
), p as (
  select page_id,
         case when has then translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
         case when has then substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) else '' end as path
  from u
), r as (
  select *, '.' || host as dotted from p
), v as (
  select page_id, host, path,
         case when dotted like '%.www.example.com' and starts_with(path, '/en/') then 'www.example.com/en/'
              when dotted like '%.example.com' and starts_with(path, '/en/') then 'example.com/en/'
              when dotted like '%.com' and starts_with(path, '/') then 'com/'
              when dotted like '%.net' and starts_with(path, '/es/') then 'net/es/'
              when dotted like '%.net' and starts_with(path, '/fr/') then 'net/fr/' end as rule
  from r
)
select page_id, host, path, rule,
       case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict
from v"""


@query("op10_url_trie", URL_TRIE_SQL)
def url_trie(spark, source):
    return judge_urls(table(spark, source, "pages"), URL_RULES)


WARC_SQL = r"""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest,
    max(page_id) over (partition by coalesce(html, '')) as last, coalesce(url, '') as url from pages
), u as (
  select *, instr(url, '://') > 0 as has,
    regexp_extract(case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else url end, '^[^#]*') as whole from p
), h as (
  select *, case when has then regexp_extract(whole, '^[^/?]*') else '' end as host from u
), k as (
  select *, payload_bytes >= 1000 and page_id <> last as again,
    array_to_string(list_reverse(string_split(translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.')), ',')
      || ')' || substr(whole, length(host) + 1) as urlkey from h
)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
  case when again then last end as refers_to, urlkey, row_number() over (partition by urlkey order by page_id) as capture
from k"""
FIRST_SECOND = 1_704_067_200  # pages have no times: their numbers count seconds from here


@query("op11_warc", WARC_SQL)
def warc(spark, source):
    path = shared_path(spark, "archives")
    index = write_archives(table(spark, source, "pages"), path, F.col("page_id") + FIRST_SECOND)
    found = read_captures(index, path)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "capture")


HARD_NEGATIVES_SQL = """
with v as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null
    and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
), s as (
  select a.id as anchor_id, c.id, a.label = c.label as same, cast(list_inner_product(a.v, c.v) as bigint) as score
  from v a join v c on a.id <> c.id where a.id % 100 = 0
), p as (
  select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, id) as rank,
  id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5"""


@query("op12_hard_negatives", HARD_NEGATIVES_SQL)
def hard_negatives(spark, source):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, source, "embeddings"), F.col("id") % 100 == 0, label)


RESAMPLING_SQL = r"""
with bits as (
  select list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, cast(b as bigint))) as crc
), texts as (
  select true as is_doc, doc_id as id, text from documents union all select false, item_id, text from benchmark
), numbered as (
  select row_number() over () as row, * from texts
), words as (
  select row, is_doc, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
  from numbered where text is not null
), hexed as (
  select word, hex(encode(word)) as h from (select distinct word from words)
), hashed as (
  select word, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: cast('0x' || h[2 * i + 1 : 2 * i + 2] as bigint)),
    lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 as bucket
  from hexed, bits
), found as (
  select row, is_doc, bucket from words join hashed using (word)
), counts as (
  select bucket, count(*) filter (is_doc) as s, count(*) filter (not is_doc) as t from found group by bucket
), sums as (
  select cast(sum(s) as double) as all_s, cast(sum(t) as double) as all_t from counts
), gains as (
  select bucket, cast(floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) as bigint) as gain from counts, sums
), weights as (
  select row, count(*) as n_features, cast(floor(sum(gain) / count(*)) as bigint) as weight
  from found join gains using (bucket) where is_doc group by row
), scores as (
  select id as doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    cast('0x' || substr(sha256('2024:' || id), 1, 8) as bigint) as h
  from numbered left join weights using (row) where is_doc
), scored as (
  select doc_id, n_features, weight,
    weight + cast(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) as bigint) as score from scores
), ranked as (
  select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
    count(*) filter (n_features >= 20) over () as able from scored
)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= able * 10 // 100 then place end as rank
from ranked"""


@query("op13_resampling", RESAMPLING_SQL)
def resampling(spark, source):
    found = resample(table(spark, source, "documents"), table(spark, source, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
