"""Queries and SQL of questions, answers and embeddings."""

from pyspark.sql import functions as F

from quern.operators import answers as A
from quern.operators import embed as E
from quern.operators import neardup as N
from quern.operators import questions as Q
from quern.sources.files import load_keyed, save_keyed, shared_path, upsert

from .flagship import flagship
from .views import crc32_sql, duck, table, view

RAW = """select q.doc_id, q.question_index - 1 as ord, case (q.question_index + q.doc_id) % 4 when 0 then 'what ' || lower(substr(d.text, 1, 60)) when 1 then 'Where ' || substr(d.text, 1, 40) || '?'
 when 2 then 'Why ' || substr(d.text, 10, 50) || '?' else 'so who ' || substr(d.text, 1, 30) end as question, d.text as context from {v_questions} q join {documents} d on d.doc_id = q.doc_id"""
DRAW = RAW.replace("{", "").replace("}", "")


def _raw(s, d):
    return s.sql(RAW, v_questions=view(s, d, "v_questions"), documents=table(s, d, "documents")).withColumn("ord", F.col("ord").cast("int"))


def _cand(s, d):
    """Candidates; every seventh answer is empty, so that all branches of the score are met."""
    return view(s, d, "v_candidates").withColumn("answer", F.when((F.col("question_id") + F.col("ord")) % 7 == 0, "").otherwise(F.col("answer")))


def _contexts(s, d):
    return table(s, d, "documents").select("doc_id", F.col("text").alias("context"))


def _scored(s, d, **how):
    return A.scored_in(_cand(s, d).drop("context"), _contexts(s, d), **how)


def _best(s, d):
    return A.best_of_n(_scored(s, d))


def _dressed(s, d):
    """Answers with role prefixes, openers and quotes in front."""
    front = F.element_at(F.array(*map(F.lit, ["Human: ", "answer: Overall, ", "'", "Based on the context: ", ""])), (F.col("ord") % 5 + 1).cast("int"))
    return view(s, d, "v_candidates").select("question_id", "ord", F.concat(F.lit(" "), front, F.col("answer")).alias("answer"), "context")


def _question_vectors(s, d):
    """Encoded questions, grouped by their document."""
    asked = view(s, d, "v_questions")
    made = E.embed(asked.select(F.col("question_id").alias("id"), F.col("question").alias("text")))
    return asked.join(made, asked["question_id"] == made["id"]).select("doc_id", F.col("question_id").alias("ord"), "vector")


def _what_is():
    def make():
        def model(pdf):
            return pdf[["doc_id", "ord"]].assign(question=["What is " + t + "?" for t in pdf["text"]])

        return model

    return make


def _strict():
    """As _what_is, but it doesn't take blank texts."""

    def make():
        def model(pdf):
            if (pdf["text"].str.strip() == "").any():
                raise ValueError("a blank text")
            return pdf[["doc_id", "ord"]].assign(question=["What is " + t + "?" for t in pdf["text"]])

        return model

    return make


def _q15_resumable(s, d):
    """All blocks in slices; blank ones can't be asked about and come back with the reason."""
    out = shared_path(s, "questions")
    made = Q.generate_resumable(view(s, d, "v_blocks").select("doc_id", "ord", "text"), _strict(), "doc_id long, ord int, question string", ["doc_id", "ord"], out, slices=4)
    return made.select("doc_id", "ord", "question", "error")


def _a17_by_model(s, d):
    """Every question to three models, dealt by model; a second call finds all answers there."""
    out = shared_path(s, "answers")
    asked = view(s, d, "v_questions").select("question_id", "question", F.explode(F.array(*map(F.lit, ["m0", "m1", "m2"]))).alias("model_name"))
    how = ("question_id long, model_name string, answer string", ["question_id", "model_name"], out, "model_name", 3, 4)
    Q.generate_resumable(asked, Q.by_class_path("quern.operators.models.NamedModel"), *how)
    return Q.generate_resumable(asked, Q.by_class_path("quern.operators.models.NamedModel"), *how).drop("error")


def _cleaned_by_model(s, d):
    """Dressed answers as if of every family of models."""
    family = F.element_at(F.array(*map(F.lit, ["openelm-simple", "TinyLlama", "qwen2", "flan"])), (F.col("question_id") % 4 + 1).cast("int"))
    return A.clean_by_model(_dressed(s, d).withColumn("model_name", family)).select("question_id", "ord", "model_name", "answer")


def _rankings(s, d):
    return A.rerank(_scored(s, d)).select("question_id", "best_model", "best_answer", "worst_model", "worst_answer")


def _a14_overwrite(s, d):
    """Stored rankings, of which those of labelled documents are replaced in place."""
    path = shared_path(s, "rankings")
    rankings = _rankings(s, d)
    save_keyed(rankings, path, "question_id", 16)
    labelled = view(s, d, "v_questions").join(table(s, d, "labels").select("doc_id"), "doc_id", "left_semi").select("question_id")
    again = rankings.join(labelled, "question_id", "left_semi").withColumns({"best_model": F.col("worst_model"), "worst_model": F.col("best_model")})
    upsert(path, again, "question_id", A.overwrite_rankings, 16)
    return load_keyed(s, path).select("question_id", "best_model", "worst_model")


def _attempts(s, d):
    raw = _raw(s, d).withColumn("attempt", (F.col("ord") % 3 + 1)).withColumn("crashed", (F.col("doc_id") % 5 == 0) & (F.col("attempt") == 1))
    return Q.choose_attempt(raw, "doc_id").select("doc_id", "attempt", "ord", "question")


def _models(s, d):
    return table(s, d, "nation").select(F.concat(F.lit("m"), F.col("n_nationkey").cast("string")).alias("name"), (F.col("n_nationkey") % 2 == 0).alias("enabled"))


QUERIES = {
    "flagship": flagship,
    "q1_sentences": lambda s, d: Q.sentences(table(s, d, "documents")),
    "q2_facts": lambda s, d: Q.facts(Q.sentences(table(s, d, "documents"))),
    "q3_statement_to_question": lambda s, d: Q.facts(Q.sentences(table(s, d, "documents"))).select("doc_id", "ord", Q.statement_to_question(F.col("sentence")).alias("question")),
    "q4_rule_based_qa": lambda s, d: Q.rule_based_qa(table(s, d, "documents")),
    "q5_fact_lines": lambda s, d: Q.fact_lines(table(s, d, "documents")),
    "q6_fact_to_question": lambda s, d: Q.fact_lines(table(s, d, "documents")).select("doc_id", "ord", Q.fact_to_question(F.col("fact")).alias("question")),
    "q7_parse_questions": lambda s, d: Q.parse_questions(table(s, d, "documents").select("doc_id", F.concat(F.lit("Questions:\nQ: "), F.replace("text", F.lit("\n"), F.lit("\nQuestion: ")), F.lit("\n\ncontext")).alias("text"))),
    "q8_apply_templates": lambda s, d: Q.apply_templates(_raw(s, d)).select("doc_id", "ord", "question"),
    "q9_quality_pass": lambda s, d: _raw(s, d).select("doc_id", "ord", Q.quality_pass(F.col("question"), F.col("context")).alias("ok")),
    "q10_valid_question": lambda s, d: _raw(s, d).select("doc_id", "ord", Q.valid_question(F.col("question")).alias("ok"), Q.valid_question(F.col("question"), 40).alias("ok_strict")),
    "q11_greedy_dedupe": lambda s, d: Q.greedy_dedupe(_question_vectors(s, d), "doc_id", 0.7),
    "q11_corpus_dedupe": lambda s, d: N.keep_first(_question_vectors(s, d).select("ord", "vector"), 0.7),
    "q11b_exact_dedupe": lambda s, d: Q.exact_dedupe(view(s, d, "v_questions").withColumn("ord", F.col("question_id")), "doc_id").select("doc_id", "ord", "question"),
    "q12_choose_attempt": _attempts,
    "q13_number_questions": lambda s, d: Q.number_questions(view(s, d, "v_questions").select("doc_id", F.col("question_id").alias("ord")), "doc_id"),
    "q14_render_prompt": lambda s, d: Q.render_prompt(_raw(s, d), "CONTEXT:\n{context}\n\nQUESTION: {question}", 1230, "head", strict=False).select("doc_id", "ord", F.sha2("prompt", 256).alias("prompt_sha"), F.length("prompt").alias("n"), (~F.col("prompt").rlike(Q.PLACE)).alias("ok")),
    "q15_generate_questions": lambda s, d: Q.generate(view(s, d, "v_blocks").select("doc_id", "ord", "text"), _what_is(), "doc_id long, ord int, question string"),
    "q15_resumable": _q15_resumable,
    "a1_work_items": lambda s, d: A.work_items(
        view(s, d, "v_questions").groupBy("doc_id").agg(F.array_sort(F.collect_list("question")).alias("questions")).withColumn("chunk_id", F.lit("p1_c1")),
        table(s, d, "documents").select("doc_id", F.lit("p1_c1").alias("chunk_id"), F.col("text").alias("context")), view(s, d, "v_questions").withColumn("chunk_id", F.lit("p1_c1")),
    ).select("doc_id", "question_index", "question_id", "asked"),
    "a2_normalize": lambda s, d: _cand(s, d).select("question_id", "ord", A.normalize(F.when(F.col("ord") % 5 == 1, F.concat(F.lit(" ["), "answer")).when(F.col("ord") % 5 == 3, F.concat("answer", F.lit("? "))).otherwise(F.col("answer"))).alias("answer")),
    "a3_extract": lambda s, d: view(s, d, "v_candidates").join(view(s, d, "v_questions").select("question_id", "question"), "question_id").select("question_id", "ord", A.extract(F.concat(F.lit("x Answer: "), F.col("answer"), F.when(F.col("ord") % 3 == 1, " Question: y").otherwise("")), F.col("question")).alias("answer")),
    "a4_keywords": lambda s, d: view(s, d, "v_candidates").select("question_id", "ord", F.array_join(F.array_sort(A.keywords(F.col("answer"))), " ").alias("keywords")),
    "a5_clean_output": lambda s, d: _dressed(s, d).select("question_id", "ord", A.clean_output(F.col("answer")).alias("answer")),
    "a5_clean_by_model": _cleaned_by_model,
    "a6_strip_prompt": lambda s, d: view(s, d, "v_candidates").select("question_id", "ord", A.strip_prompt(F.concat(F.when(F.col("ord") % 2 == 0, "a ").otherwise(""), F.lit("PROMPT "), "answer"), F.lit("PROMPT")).alias("answer")),
    "a7_grounding": lambda s, d: view(s, d, "v_candidates").select("question_id", "ord", A.grounded(F.col("answer"), F.col("context")).alias("ok"), A.grounded(F.col("answer"), F.col("context"), 4).alias("ok_aggressive"), A.grounded_long(F.col("answer"), F.col("context")).alias("ok_long"), A.grounded_strict(F.col("answer"), F.col("context")).alias("ok_strict")),
    "a7_ground_or_refuse": lambda s, d: A.ground_or_refuse(view(s, d, "v_candidates"), A.grounded(F.col("answer"), F.col("context"))).select("question_id", "ord", "answer"),
    "a8_score": lambda s, d: A.scored_in(_scored(s, d).withColumnRenamed("score", "s"), _contexts(s, d), none_shared=-5.0, by_length=False).select("question_id", "ord", F.col("s").alias("score"), F.col("score").alias("plain_score")),
    "a9_sample_plan": lambda s, d: A.sample_plan(view(s, d, "v_questions").select("question_id"), _models(s, d).filter("enabled").select("name")),
    "a10_best_of_n": lambda s, d: _best(s, d).select("question_id", "model_name", "ord", "score"),
    "a11_rank_models": lambda s, d: A.rank_models(_best(s, d)).select("question_id", "model_name", "is_best", "is_worst", *[F.col("answer_scores")[m].alias(f"score_{m}") for m in ("m0", "m1", "m2")]),
    "a12_nested_samples": lambda s, d: A.nested_samples(_scored(s, d)).select("question_id", F.explode("per_model_samples").alias("model_name", "_s")).select("question_id", "model_name", F.size("_s").alias("n"), F.array_join(F.transform("_s", lambda r: r["sample_id"].cast("string")), ",").alias("sample_order")),
    "a13_wide_answers": lambda s, d: A.wide_answers(_best(s, d), ["m0", "m1", "m2"]),
    "a14_rerank": lambda s, d: A.rerank(_scored(s, d)).select("question_id", "best_model", "best_answer", "worst_model", "worst_answer", F.size("answer_scores").alias("n_models")),
    "a14_overwrite": _a14_overwrite,
    "a15_unknown_models": lambda s, d: A.unknown_models(view(s, d, "v_candidates").select("question_id", "ord", "model_name"), _models(s, d).filter("enabled")),
    "a16_select_models": lambda s, d: A.select_models(_models(s, d), [" M2 ", "m4", "m5", "nope"])[0].withColumn("what", F.lit("chosen")).drop("enabled").unionByName(A.select_models(_models(s, d), [" M2 ", "m4", "m5", "nope"])[1].withColumn("what", F.lit("missing"))),
    "a17_generate_answers": lambda s, d: Q.generate(view(s, d, "v_blocks").select("doc_id", "ord", "text").repartition("doc_id"), Q.by_class_path("quern.operators.models.EchoModel"), "doc_id long, ord int, answer string"),
    "a17_by_model": _a17_by_model,
    "e1_embed": lambda s, d: E.embed(table(s, d, "documents").select(F.col("doc_id").alias("id"), "text")).select("id", F.posexplode("vector").alias("dim", "value")).filter("value <> 0").withColumn("value", F.round("value", 9)),
    "e2_embedding_table": lambda s, d: E.embedding_table(view(s, d, "v_embeddings"), "hash64").select("parent_type", "parent_id", "model_name", "actual_dimensions", F.col("meta")["source"].alias("source")),
    "e3_group_cosine": lambda s, d: E.group_cosine(view(s, d, "v_embeddings").filter("label is not null").select("label", "id", F.col("embedding").alias("vector")), "label", 0.3).withColumn("cosine", F.round("cosine", 6)),
}
STARTS = "(lower(s) like 'this %' or lower(s) like 'that %' or lower(s) like 'these %' or lower(s) like 'those %' or lower(s) like 'it %')"
MARKS = "(" + " or ".join(f"contains(lower(s), '{m}')" for m in Q.FACT_MARKS) + ")"
SENT = r"""with p as (select doc_id, string_split(regexp_replace(S(text), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) as parts from documents),
r as (select doc_id, cast(i - 1 as int) as ord, S(parts[i]) as s from (select doc_id, parts, unnest(range(1, len(parts) + 1)) as i from p) x), sent as (select * from r where length(s) > 20)"""
FACTS = SENT + f", facts as (select * from sent where not {STARTS} and {MARKS})"
_c = r"regexp_replace(S(s), '\.+$', '')"
QUESTION = f"case when contains(lower({_c}), ' must ') then 'What must be done ' || S(substr({_c}, instr(lower({_c}), 'must') + 4)) || '?'"
for _v in ("allows", "enables", "supports"):
    QUESTION += f" when contains(lower({_c}), ' {_v} ') then 'What does ' || S(substr({_c}, 1, instr(lower({_c}), '{_v}') - 1)) || ' {_v}?'"
for _v in ("occurs", "results", "removes"):
    QUESTION += f" when contains(lower({_c}), ' {_v} ') then 'What happens when ' || S(substr({_c}, 1, instr(lower({_c}), '{_v}') - 1)) || '?'"
QUESTION += rf" else 'What is stated about ' || regexp_extract({_c}, '(\S+)', 1) || '?' end"
LINES = r"""with l as (select doc_id, cast(i - 1 as int) as ord, regexp_replace(parts[i], '^[ \-*\t]+|[ \-*\t]+$', '', 'g') as fact from (select doc_id, string_split(text, chr(10)) as parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents) x),
f as (select * from l where length(fact) > 20 and fact not like '%?')"""
_f = r"regexp_replace(fact, '\.+$', '')"
SCORE = """case when answer = '' then '-infinity'::double else cast(n as double) {none} {length} end"""
CAND = """with c as (select question_id, model_name, ord, case when (question_id + ord) % 7 = 0 then '' else answer end as answer, context from v_candidates),
n as (select *, len(list_intersect(WS(S(answer)), WS(context))) as n, len(WS(S(answer))) as w from c),
s as (select *, case when answer = '' then '-infinity'::double else n + case when n = 0 then -10.0 else 0.0 end + case when w between 5 and 40 then 1.0 when w < 3 or w > 80 then -2.0 else 0.0 end end as score,
  case when answer = '' then '-infinity'::double else n + case when n = 0 then -5.0 else 0.0 end end as plain_score from n)"""
RERANK = CAND + """, p as (select question_id, model_name, max(score) as top, min(ord) as ord from s group by all),
bw as (select question_id, (array_agg(model_name order by top desc, ord))[1] as best_model, (array_agg(model_name order by top, ord))[1] as worst_model from p group by question_id)"""
BEST = CAND + ", b as (select * from s qualify row_number() over (partition by question_id, model_name order by score desc, ord) = 1)"
TEMPLATED = rf"""with q as ({DRAW}), t as (select doc_id, ord, context, case when regexp_matches(S(question), '^\p{{Lu}}') and S(question) like '%?' then S(question)
  else replace(['What is #?', 'What does # refer to?', 'Where is # located?', 'Which # is mentioned?', 'When does # occur?'][ord % 5 + 1], '#', regexp_replace(case when regexp_matches(S(question), '(?i)(what|where|which|when|who)\s+') then S(regexp_extract(S(question), '(?i)(what|where|which|when|who)\s+(.*)', 2)) else S(question) end, '\?+$', '')) end as question from q)"""
OK9 = r"(length(S(question)) >= 12 and regexp_matches(lower(S(question)), '^(what|where|which|when|who)') and S(question) like '%?' and len(list_intersect(WS(regexp_replace(S(question), '\?+$', '')), WS(context))) >= 2)"
OK10 = r"(S(question) like '%?' and regexp_matches(S(question), '(?i)^(what|who|when|where|why|how|which)\b') and not regexp_matches(S(question), '\d+\.\d+\.\d+\.\d+') and length(S(question)) <= {n})"
_keys = "list_filter(list_distinct(regexp_extract_all(lower({x}), '([a-z]{{3,}})', 1)), lambda k: not list_contains([" + ", ".join(f"'{w}'" for w in A.STOP) + "], k))"
_dressed_sql = "S(['Human: ', 'answer: Overall, ', chr(39), 'Based on the context: ', ''][ord % 5 + 1] || answer)"
CLEAN = _dressed_sql
SQL = {
    "flagship": r"""with b as (select doc_id, ord, S(text) as text from v_blocks where length(S(text)) > 5), d as (select * from b qualify row_number() over (partition by doc_id, text order by ord) = 1),
        l as (select doc_id, 'p1_c' || row_number() over (partition by doc_id order by ord) as chunk_id, text from d where length(text) >= 40),
        p as (select doc_id, chunk_id, text, string_split(regexp_replace(S(text), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) as parts from l),
        r as (select doc_id, chunk_id, text, cast(i - 1 as int) as ord, S(parts[i]) as s from (select *, unnest(range(1, len(parts) + 1)) as i from p) x), facts as (select * from r where length(s) > 20 and not """
    + STARTS + " and " + MARKS + "), n as (select *, len(list_intersect(WS(s), WS(text))) as n, len(WS(s)) as w from facts) select doc_id, chunk_id, ord, " + QUESTION
    + " as prompt, text as context, s as response, n + case when n = 0 then -10.0 else 0.0 end + case when w between 5 and 40 then 1.0 when w < 3 or w > 80 then -2.0 else 0.0 end as score from n",
    "q1_sentences": SENT + " select doc_id, ord, s as sentence from sent",
    "q2_facts": FACTS + " select doc_id, ord, s as sentence from facts",
    "q3_statement_to_question": FACTS + f" select doc_id, ord, {QUESTION} as question from facts",
    "q4_rule_based_qa": FACTS + f" select doc_id, ord, 'Answer the question using only the provided context.' as instruction, s as context, {QUESTION} as question, s as response from facts",
    "q5_fact_lines": LINES + " select doc_id, ord, fact from f",
    "q6_fact_to_question": LINES + f""" select doc_id, ord, case when lower({_f}) like 'the person%' then 'What must the person completing the action do?' when lower({_f}) like 'the technician%' then 'What must the technician do?'
        when contains(lower({_f}), 'date of release') then 'What is the date of release of the document?' when contains(lower({_f}), 'procedure') then 'What is the procedure described?'
        when lower({_f}) like 'unused pages%' then 'Why are unused pages required?' else 'What is stated regarding ' || lower({_f}) || '?' end as question from f""",
    "q7_parse_questions": r"""with l as (select doc_id, cast(i as int) as ord, S(replace(parts[i], 'Question:', '')) as q from (select doc_id, string_split(text, chr(10)) as parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents) x),
        k as (select doc_id, ord, case when q like '%?' then q else q || '?' end as question from l where q <> '' and not regexp_matches(lower(q), '^(questions|context)')),
        u as (select doc_id, question, min(ord) as ord from k group by doc_id, question) select * from u qualify row_number() over (partition by doc_id order by ord) <= 5""",
    "q8_apply_templates": TEMPLATED + " select doc_id, cast(ord as int) as ord, question from t",
    "q9_quality_pass": f"with q as ({DRAW}) select doc_id, cast(ord as int) as ord, {OK9} as ok from q",
    "q10_valid_question": f"with q as ({DRAW}) select doc_id, cast(ord as int) as ord, {OK10.format(n=240)} as ok, {OK10.format(n=40)} as ok_strict from q",
    "q11b_exact_dedupe": "select doc_id, question_id as ord, question from v_questions where S(question) <> '' qualify row_number() over (partition by doc_id, lower(S(question)) order by question_id) = 1",
    "q12_choose_attempt": TEMPLATED + f""", a as (select *, cast(ord % 3 + 1 as int) as attempt from t where not (doc_id % 5 = 0 and ord % 3 = 0)), v as (select *, {OK9} as ok9, {OK10.format(n=240)} as ok10 from a),
        g as (select * from v where ok9 and ok10 qualify row_number() over (partition by doc_id, attempt, lower(S(question)) order by ord) = 1), f as (select doc_id, min(attempt) as a from g group by doc_id),
        l as (select doc_id, max(attempt) as a from a where doc_id not in (select doc_id from f) group by doc_id)
        select g.doc_id, attempt, cast(ord as int) as ord, question from g join f on g.doc_id = f.doc_id and attempt = f.a union all select v.doc_id, attempt, cast(ord as int), question from v join l on v.doc_id = l.doc_id and attempt = l.a where ok10""",
    "q13_number_questions": "select doc_id, question_id as ord, question_index from v_questions",
    "q14_render_prompt": f"with q as ({DRAW}), p as (select doc_id, ord, right('CONTEXT:' || chr(10) || substr(context, 1, 1200) || chr(10) || chr(10) || 'QUESTION: ' || question, 1230) as p from q) select doc_id, cast(ord as int) as ord, sha256(p) as prompt_sha, cast(length(p) as int) as n, not regexp_matches(p, '\\{{\\s*\\w+\\s*\\}}') as ok from p",
    "q15_generate_questions": "select doc_id, ord, 'What is ' || text || '?' as question from v_blocks",
    "a1_work_items": "with g as (select doc_id, question as asked, cast(row_number() over (partition by doc_id order by question) as int) as question_index from v_questions) select g.doc_id, g.question_index, q.question_id, g.asked from g join documents d on d.doc_id = g.doc_id join v_questions q on q.doc_id = g.doc_id and q.question_index = g.question_index",
    "a2_normalize": CAND + ", d as (select question_id, ord, S(case ord % 5 when 1 then ' [' || answer when 3 then answer || '? ' else answer end) as a from c) select question_id, ord, case when a <> '' and a not like '%?' and not regexp_matches(a, '^[{\\[]') then a end as answer from d".replace("\\\\", "\\"),
    "a3_extract": f"select question_id, ord, case when S(answer) <> '' and S(answer) not like '%?' and len(list_intersect({_keys.format(x='question')}, {_keys.format(x='answer')})) > 0 then S(answer) end as answer from v_candidates join v_questions using (question_id)",
    "a4_keywords": f"select question_id, ord, array_to_string(list_sort({_keys.format(x='answer')}), ' ') as keywords from v_candidates",
    "a6_strip_prompt": "select question_id, ord, S(answer) as answer from v_candidates",
    "a5_clean_output": r"""with a as (select question_id, ord, S(answer) as x from v_candidates), q as (select question_id, ord, regexp_replace(regexp_replace(x, '^[`''"]+|[`''"]+$', '', 'g'), '\s+', ' ', 'g') as x from a),
        o as (select question_id, ord, case when regexp_extract(x, '^(.+?[.!?])(\s|$)', 1) <> '' then S(regexp_extract(x, '^(.+?[.!?])(\s|$)', 1)) else x end as x from q) select question_id, ord, case when x <> '' and not regexp_matches(x, '[.!?]$') then x || '.' else x end as answer from o""",
    "a7_grounding": r"""with g as (select *, len(list_intersect(WS(answer), WS(context))) as n, len(list_intersect(list_filter(WS(answer), lambda k: length(k) > 3), list_filter(WS(context), lambda k: length(k) > 3))) as l from v_candidates)
        select question_id, ord, n >= 2 as ok, n >= 4 as ok_aggressive, l > 0 as ok_long, len(W(answer)) >= 3 and n >= 2 as ok_strict from g""",
    "a7_ground_or_refuse": "select question_id, ord, case when len(list_intersect(WS(answer), WS(context))) >= 2 then answer else 'Insufficient information in context.' end as answer from v_candidates",
    "a14_overwrite": RERANK + " select question_id, case when again then worst_model else best_model end as best_model, case when again then best_model else worst_model end as worst_model from (select bw.*, q.doc_id in (select doc_id from labels) as again from bw join v_questions q using (question_id)) x",
    "a17_by_model": "select question_id, m as model_name, m || ': ' || question as answer from v_questions, (select unnest(['m0', 'm1', 'm2']) as m) x",
    "q15_resumable": "select doc_id, ord, case when S(text) <> '' then 'What is ' || text || '?' end as question, case when S(text) = '' then 'ValueError: a blank text' end as error from v_blocks",
    "a8_score": CAND + " select question_id, ord, score, plain_score from s",
    "a9_sample_plan": "select question_id, 'm' || n_nationkey as name, cast(i as int) as sample_id, i > 3 as do_sample from v_questions, nation, range(1, 9) r(i) where n_nationkey % 2 = 0",
    "a10_best_of_n": BEST + " select question_id, model_name, ord, score from b",
    "a11_rank_models": BEST + """ select question_id, model_name, row_number() over (partition by question_id order by score desc, ord, model_name) = 1 as is_best,
        row_number() over (partition by question_id order by score, ord desc, model_name desc) = 1 and count(*) over (partition by question_id) > 1 as is_worst,
        max(score) filter (where model_name = 'm0') over (partition by question_id) as score_m0, max(score) filter (where model_name = 'm1') over (partition by question_id) as score_m1,
        max(score) filter (where model_name = 'm2') over (partition by question_id) as score_m2 from b""",
    "a12_nested_samples": CAND + " select question_id, model_name, cast(count(*) as int) as n, string_agg(cast(ord as varchar), ',' order by score desc, ord) as sample_order from s group by question_id, model_name",
    "a13_wide_answers": BEST + " select question_id, " + ", ".join(f"max(answer) filter (where model_name = 'm{i}') as answer_m{i}" for i in range(3)) + " from b group by question_id",
    "a14_rerank": CAND + """, p as (select question_id, model_name, max(score) as top, min(ord) as ord from s group by all),
        bw as (select question_id, (array_agg(model_name order by top desc, ord))[1] as best_model, (array_agg(model_name order by top, ord))[1] as worst_model, cast(count(*) as int) as n_models from p group by question_id)
        select bw.question_id, best_model, (select s.answer from s where s.question_id = bw.question_id and s.model_name = best_model order by score desc, ord limit 1) as best_answer, worst_model,
        (select s.answer from s where s.question_id = bw.question_id and s.model_name = worst_model order by score, ord limit 1) as worst_answer, n_models from bw""",
    "a15_unknown_models": "select question_id, ord, model_name from v_candidates where model_name not in (select 'm' || n_nationkey from nation where n_nationkey % 2 = 0)",
    "a16_select_models": "select 'm' || n_nationkey as name, 'chosen' as what from nation where n_nationkey in (2, 4) union all select 'm5', 'missing' union all select 'nope', 'missing'",
    "e2_embedding_table": "select parent_type, parent_id, 'hash64' as model_name, cast(len(embedding) as int) as actual_dimensions, parent_type as source from v_embeddings",
    "e3_group_cosine": """with v as (select label, id, list_transform(embedding, lambda x: x::double) as e from v_embeddings where label is not null),
        p as (select a.label, a.id as a, b.id as b, list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) as cosine from v a join v b on a.label = b.label and a.id < b.id) select label, a, b, round(cosine, 6) as cosine from p where cosine >= 0.3""",
    "e1_embed": f"""with w as (select doc_id as id, unnest(W(lower(coalesce(text, '')))) as w from documents), u as (select w, hex(encode(w)) as hx from (select distinct w from w) d),
        h as materialized (select w, cast({crc32_sql("list_transform(range(1, len(hx), 2), lambda i: cast('0x' || substr(hx, i, 2) as bigint))")} % 64 as int) as dim from u),
        c as (select id, dim, count(*) as n from w join h using (w) group by id, dim) select id, dim, round(n / sqrt(sum(n * n) over (partition by id)), 9) as value from c""",
    "a17_generate_answers": "select doc_id, ord, string_split(text, '.')[1] as answer from v_blocks",
}
ORACLE_SQL = {k: duck(v) for k, v in SQL.items()}
