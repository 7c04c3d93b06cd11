"""Views that give the shared tables the shapes the operators read, as text for Spark and for DuckDB."""

import re

from pyspark.sql import DataFrame, SparkSession

from quern.functions.text import SPACE

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_BLOCKS = "select doc_id, ord, text, {page} as page, case when length(text) < 40 then 'heading' else 'text' end as chunk_type from ({lines}) b"
VIEWS = {
    "v_blocks": (
        _BLOCKS.format(page="cast(ord div 10 as int)", lines=r"select doc_id, posexplode(split(text, '\\n', -1)) as (ord, text) from {documents}"),
        _BLOCKS.format(page="cast(ord // 10 as int)", lines="select doc_id, unnest(string_split(text, chr(10))) as text, cast(generate_subscripts(string_split(text, chr(10)), 1) - 1 as int) as ord from documents"),
    ),
    "v_documents": """select doc_id as id, source as file_name, concat(source, '/', cast(doc_id as varchar(20)), '.txt') as file_path,
       lang as domain_code, case when doc_id % 11 = 0 then null else doc_id % 3 end as audience_id, cast(doc_id % 4 + 1 as int) as severity from {documents}""",
    "v_doc_tags": """select doc_id as document_id, 'SOP' as tag from {documents} where doc_id % 2 = 0
       union all select doc_id, 'MANUAL' from {documents} where doc_id % 3 = 0 union all select doc_id, 'SPEC' from {documents} where doc_id % 5 = 0""",
    "v_questions": """select conv_id * 100 + turn as question_id, conv_id as doc_id, cast(row_number() over (partition by conv_id order by turn) as int) as question_index,
       text as question from {conversations} where role = 'user'""",
    "v_candidates": """select q.conv_id * 100 + q.turn as question_id, q.conv_id as doc_id, concat('m', cast(a.turn % 3 as varchar(5))) as model_name, a.turn as ord, a.text as answer, d.text as context
       from {conversations} q join {conversations} a on q.conv_id = a.conv_id and q.role = 'user' and a.role = 'assistant' join {documents} d on d.doc_id = q.conv_id""",
    "v_sft": """select conv_id, turn, prompt, response from (select conv_id, turn, role, text as prompt, lead(role) over (partition by conv_id order by turn) as nrole,
       lead(text) over (partition by conv_id order by turn) as response from {conversations}) t where role = 'user' and nrole = 'assistant'""",
    "v_ocr_lines": """select event_id as ord, user_id as page, value as y, event_type as text, cast(regexp_extract(props, '[0-9]+', 0) as int) / 100.0 as confidence from {events}""",
    "v_runs": """select o.o_orderkey as run_id, o.o_custkey as document_id, o.o_orderdate as started_at,
       case when o.o_orderstatus = 'O' then null else l.fin end as finished_at, o.o_orderstatus = 'F' as success
       from {orders} o left join (select l_orderkey, max(l_shipdate) as fin from {lineitem} group by l_orderkey) l on o.o_orderkey = l.l_orderkey""",
    "v_metrics": """select user_id as run_id, event_type as metric, cast(row_number() over (partition by user_id, event_type order by ts, event_id) as int) as step, value, ts from {events}""",
    "v_feedback": """select event_id, event_type as model_name, cast(user_id % 3 as int) as version, cast(regexp_extract(props, '[0-9]+', 0) as int) % 5 + 1 as rating, value as latency, cast(length(props) as int) as input_tokens, cast(length(event_type) as int) as output_tokens from {events}""",
    "v_embeddings": """select vec_id as id, case vec_id % 4 when 0 then 'document' when 1 then 'chunk' when 2 then 'question' else 'answer' end as parent_type,
       vec_id * 3 as parent_id, embedding, label from {embeddings}""",
    "v_cells": """select r.r_name as sheet, cast(row_number() over (partition by r.r_name order by n.n_nationkey) + 1 as int) as row_no, n.n_name as a, '' as b, cast(n.n_nationkey as varchar(9)) as c
       from {nation} n join {region} r on n.n_regionkey = r.r_regionkey union all select r_name, 1, 'name', 'blank', '' from {region}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    text = text[0] if isinstance(text, tuple) else text
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", text))})


def crc32_sql(codes: str) -> str:
    """SQL for the unsigned crc32 of a list of bytes."""
    step = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {codes}), lambda c, b: {step}), 4294967295)"


def duck(body: str) -> str:
    """The body with a WITH clause for the views it names; S(x), W(x) and WS(x) stand for strip, words and word set."""
    macros = {
        "WS": f"list_distinct(list_filter(regexp_split_to_array(lower({{0}}), '{SPACE}+'), lambda w: w <> ''))",
        "W": f"list_filter(regexp_split_to_array({{0}}, '{SPACE}+'), lambda w: w <> '')",
        "S": f"regexp_replace({{0}}, '\\A{SPACE}+|{SPACE}+\\z', '', 'g')",
    }
    for name, text in macros.items():
        while m := re.search(rf"\b{name}\(", body):
            depth, i = 1, m.end()
            while depth:
                depth += {"(": 1, ")": -1}.get(body[i], 0)
                i += 1
            body = body[: m.start()] + text.replace("{0}", body[m.end() : i - 1]) + body[i:]
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    texts = [VIEWS[v][1] if isinstance(VIEWS[v], tuple) else VIEWS[v] for v in used]
    heads = [f"{v} as ({re.sub(r'[{}]', '', t)})" for v, t in zip(used, texts)]
    return ("with " + ", ".join(heads) + (", " + body[5:] if body.startswith("with ") else " " + body)) if heads else body
