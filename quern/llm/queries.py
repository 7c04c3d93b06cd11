"""The registered query of every operator, with production parameters, and the SQL that gives the same rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_documents
from .conversation_trie import conversation_trie
from .embed_dedup import near_vectors
from .exact_dedup import exact_dedup
from .importance import resample
from .mixing import mix
from .order_minhash import near_classes
from .quality_net import quality
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .toxicity import toxicity
from .url_filter import filter_urls, host_of
from .warc import derivatives, responses


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: (verdict, host and path) of the url rules; the longest that fits decides.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def insecure_hosts(pages: DataFrame) -> DataFrame:
    """Hosts that serve more than half of their pages without encryption."""
    plain = F.coalesce(F.lower("url").startswith("http://"), F.lit(False))
    return pages.groupBy(host_of(F.col("url")).alias("host")).agg((F.count_if(plain) * 2 > F.count(F.lit(1))).alias("most")).filter("most").select("host")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, URL_RULES, insecure_hosts(pages))


OP2_SQL = r"""
select page_id, host, path, rule,
       case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
            when count(*) filter (where plain) over (partition by host) * 2 > count(*) over (partition by host) then 'block' else 'allow' end as verdict
from (select page_id, host, path, plain,
        case when (host = 'example.org' or host like '%.example.org') and path like '/en/1%' then 'example.org/en/1'
             when (host = 'example.org' or host like '%.example.org') and path like '/es/%' then 'example.org/es/'
             when (host = 'com' or host like '%.com') and path like '/fr/%' then 'com/fr/'
             when (host = 'com' or host like '%.com') and path like '/de/%' then 'com/de/'
             when (host = 'org' or host like '%.org') and path like '/%' then 'org/' end as rule
      from (select page_id, coalesce(lower(url) like 'http://%', false) as plain,
              translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
              regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
            from pages) a) b
"""


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derivatives(responses(table(spark, sf_dir, "pages")))
    return rows.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest", "content_length")


def _op4_sql() -> str:
    from .warc import ENTITIES, SPACES, STEPS

    quote = lambda s: "'" + s.replace("'", "''") + "'"
    text = "html"
    for pattern, to in STEPS:
        text = f"regexp_replace({text}, {quote(pattern)}, {quote(to)}, 'g')"
    for name, to in ENTITIES:
        text = f"replace({text}, {quote(name)}, {quote(to)})"
    for pattern, to in SPACES:
        text = f"regexp_replace({text}, {quote(pattern)}, {quote(to)}, 'g')"
    urn = lambda x: f"(select '<urn:uuid:' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) || '>' from (select md5({x}) as h))"
    return rf"""
with p as (select page_id, coalesce(url, '') as target_uri, coalesce(html, '') as html, 'sha256:' || sha256(coalesce(html, '')) as source_digest from pages),
r as (select *, {urn("'response' || chr(10) || coalesce(cast(page_id as varchar), '') || chr(10) || target_uri || chr(10) || source_digest")} as refers_to from p),
d as (select *, {urn("'conversion' || chr(10) || refers_to")} as conversion_id, {urn("'metadata' || chr(10) || refers_to")} as metadata_id, {text} as text,
        trim(regexp_replace(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1), '\s+', ' ', 'g')) as title,
        len(regexp_extract_all(html, '(?i)(<a\s[^>]*href\s*=)', 1)) as links from r),
u as (select page_id, 'conversion' as warc_type, conversion_id as record_id, refers_to, target_uri, source_digest, text as block from d
      union all
      select page_id, 'metadata', metadata_id, refers_to, target_uri, source_digest,
        concat('title: ', title, chr(13), chr(10), 'links: ', links, chr(13), chr(10), 'conversion: ', conversion_id, chr(13), chr(10),
          'source-payload-digest: ', source_digest, chr(13), chr(10), 'HTTP/1.1 200 OK', chr(13), chr(10), 'Content-Type: text/html; charset=utf-8', chr(13), chr(10),
          'Content-Length: ', strlen(html), chr(13), chr(10)) from d)
select page_id, warc_type, record_id, refers_to, target_uri, source_digest, 'sha256:' || sha256(block) as block_digest, cast(strlen(block) as bigint) as content_length from u
"""


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = """
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents) d
"""


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "n_copies", "copy", "mix_key", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP8_SQL = """
with s as (select source, count(*) as n from documents group by source),
t as (select sum(n) as total, count(*) as sources from s),
r as (select source, 1.0::double / sources * total / n as rate from s, t),
p as (select source, greatest(1, cast(ceil(rate / 64) as bigint)) as parts, rate / greatest(1, ceil(rate / 64)) as mean from r),
k as (select source, parts, mean, unnest(range(0, cast(floor(mean + 15 * sqrt(mean) + 30) as bigint) + 1)) as k from p),
c as (select source, parts, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) over (partition by source order by k) as cdf from k),
l as (select source, parts, list(cdf order by k) as cdf from c group by source, parts),
u as (select d.doc_id, d.source, d.text, l.cdf,
        list_transform(range(0, l.parts), lambda j: cast('0x' || substr(sha256('0:' || j || ':' || d.doc_id), 1, 13) as bigint) / 4503599627370496.0::double) as us
      from documents d join l on d.source is not distinct from l.source),
n as (select doc_id, source, text, cast(list_sum(list_transform(us, lambda u: len(list_filter(cdf, lambda x: x <= u)))) as integer) as n_copies from u),
x as (select doc_id, source, text, n_copies, unnest(generate_series(1, n_copies)) as copy from n)
select doc_id, source, n_copies, cast(copy as integer) as copy, substr(sha256('0:order:' || doc_id || ':' || copy), 1, 16) as mix_key,
       sha256(coalesce(text, '')) as text_sha256 from x
"""

def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP9_SQL = """
with recursive e as materialized (select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: x::double) as v,
    label is not null and vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0 as ok from embeddings),
n as (select r, vec_id, label, v, sqrt(list_dot_product(v, v)) as norm from e where ok),
l as materialized (select a.r as a, b.r as b from n a join n b on a.label = b.label and a.r <> b.r where list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
c as (select r as node, vec_id as low from n union select l.b, c.low from c join l on l.a = c.node),
m as (select node, min(low) as component from c group by node),
k as (select a, count(*) as n from l group by a)
select e.vec_id, coalesce(k.n, 0) as n_links, coalesce(m.component, e.vec_id) as component_id, e.vec_id = coalesce(m.component, e.vec_id) as kept
from e left join k on k.a = e.r left join m on m.node = e.r
"""


def vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pattern of the installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), *vocabulary()).drop("ids")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _crc32(codes: str) -> str:
    """SQL for the unsigned crc32 of a list of bytes."""
    step = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {codes}), lambda c, b: {step}), 4294967295)"


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = rf"""
with words as (select 1 as corpus, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from documents
  union all select 0, null, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark),
hashed as materialized (select w, {_crc32("list_transform(range(1, len(hx), 2), lambda i: cast('0x' || substr(hx, i, 2) as bigint))")} % 10000 as bucket from (select w, hex(encode(w)) as hx from (select distinct w from words) d) e),
placed as materialized (select corpus, doc_id, bucket from words join hashed using (w)),
sums as (select count(*) filter (where corpus = 1)::double as ss, count(*) filter (where corpus = 0)::double as tt from placed),
gain as materialized (select bucket, floor(1000 * ln((count(*) filter (where corpus = 0) + 1.0::double) * (ss + 10000) / ((count(*) filter (where corpus = 1) + 1.0::double) * (tt + 10000))))::bigint as g
  from placed, sums group by bucket, ss, tt),
per as (select doc_id, count(*) as n, sum(g) as total from placed join gain using (bucket) where corpus = 1 group by doc_id),
weighed as (select d.doc_id, coalesce(n, 0) as n_features, coalesce(floor(total::double / n)::bigint, 0) as weight,
    coalesce(floor(total::double / n)::bigint, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) as bigint) + 0.5::double) / 4294967296.0::double)))::bigint as score
  from documents d left join per on per.doc_id = d.doc_id),
placed_at as (select *, case when n_features >= 20 then row_number() over (partition by n_features >= 20 order by score desc, doc_id) end as place, count(*) filter (where n_features >= 20) over () as able from weighed)
select doc_id, n_features, weight, score, case when place <= 10 * able // 100 then place end as rank from placed_at
"""


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = rf"""
with t as materialized (select conv_id as c, role, text, piece, row_number() over (partition by conv_id order by turn nulls first, piece) as k
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as piece from conversations where conv_id is not null) q),
c as (select c, n, {_crc32("list_transform(range(1, len(s) + 1), lambda i: ascii(substr(s, i, 1))::bigint)")} % 9 as h from (select c, count(*) as n, cast(c as varchar) as s from t group by c) q),
b as (select c.c, c.h, least(c.h, coalesce(base.n, 0)) as taken, c.c - c.c % 5 as base from c left join c as base on base.c = c.c - c.c % 5),
r as (select b.c, t.k as d, piece, strlen(text) as size from b join t on t.c = b.base and t.k <= b.h
  union all select b.c, b.taken + t.k - b.h, piece, strlen(text) from b join t on t.c = b.c and t.k > b.h),
p as materialized (select c, d, size, string_agg(piece, '') over (partition by c order by d) as prefix from r union all select c, 0, 0, '' from c),
n as materialized (select prefix, d, min(c) as conv_id, count(*) as n_convs, any_value(size) as size from p group by prefix, d),
kids as (select substr(prefix, 1, 64 * (d - 1)) as prefix, count(*) as n from n where d > 0 group by 1),
e as (select prefix, sha256(string_agg(c::varchar, ',' order by c)) as ends from (select c, max_by(prefix, d) as prefix from p group by c) q group by prefix),
sub as (select substr(prefix, 1, 64 * a) as prefix, sum((n_convs - 1) * size)::bigint as saved, count(*) filter (where leaf) as leaves
  from (select n.prefix, n_convs, size, kids.n is null as leaf, unnest(range(0, d + 1)) as a from n left join kids on kids.prefix = n.prefix) q group by 1)
select n.conv_id, n.d as depth, up.conv_id as parent_conv_id, n.n_convs, coalesce(kids.n, 0) as n_children, sub.leaves as n_leaves, sub.saved as saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
from n join sub on sub.prefix = n.prefix left join kids on kids.prefix = n.prefix left join e on e.prefix = n.prefix
left join n up on n.d > 0 and up.prefix = substr(n.prefix, 1, 64 * (n.d - 1))
"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filters": op2_url_filters,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_order_minhash": op7_order_minhash,
    "op8_mixing": op8_mixing,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_bpe": op10_bpe,
    "op11_quality": op11_quality,
    "op12_importance": op12_importance,
    "op13_conversation_trie": op13_conversation_trie,
}
ORACLE_SQL = {
    "op2_url_filters": OP2_SQL,
    "op4_warc_derivatives": _op4_sql(),
    "op6_exact_dedup": OP6_SQL,
    "op8_mixing": OP8_SQL,
    "op9_embedding_dedup": OP9_SQL,
    "op12_importance": OP12_SQL,
    "op13_conversation_trie": OP13_SQL,
}
