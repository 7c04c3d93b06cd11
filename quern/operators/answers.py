"""Candidate answers: normalising, cleaning, grounding, scoring and ranking."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import after_first, once, shared_words, strip, word_set, words

#: Words without content, and openers that models like; fixed values.
STOP = ["what", "when", "where", "which", "who", "how", "is", "are", "was", "were", "the", "a", "an", "to", "for", "of", "and", "or", "in", "on", "be", "should", "must"]
PREFIXES = ["Human:", "Assistant:", "User:", "System:", "Q:", "A:", "Answer:", "Context:"]
OPENERS = ["Based on the context", "According to the context", "From the context", "As stated", "As described", "In summary", "Overall", "To summarize", "The answer is"]
INSUFFICIENT = "Insufficient information in context."


def work_items(groups: DataFrame, chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, questions[]) exploded and joined to its chunk and to the question of that index."""
    rows = groups.select("doc_id", "chunk_id", F.posexplode("questions").alias("_i", "asked")).withColumn("question_index", F.col("_i") + 1).drop("_i")
    key = ["doc_id", "chunk_id"]
    return rows.join(chunks.select(*key, "context"), key).join(questions.select(*key, "question_index", "question_id"), [*key, "question_index"])


def normalize(c: Column) -> Column:
    """Stripped; null for blank text, questions, and what looks like JSON."""
    a = strip(c)
    return F.when((a != "") & ~a.endswith("?") & ~a.rlike(r"^[{\[]"), a)


def keywords(c: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("([a-z]{3,})"), F.lit(1))
    return F.array_except(F.array_distinct(found), F.array(*map(F.lit, STOP)))


def extract(text: Column, question: Column) -> Column:
    """After Answer:, before Question:; null for questions and for texts that share no keyword with the question."""
    t = strip(text)
    t = F.coalesce(strip(after_first(t, "Answer:")), t)
    t = strip(F.substring_index(t, "Question:", 1))
    return F.when((t != "") & ~t.endswith("?") & F.arrays_overlap(keywords(question), keywords(t)), t)


def clean_output(c: Column, strict: bool = True, one_sentence: bool = True, prefixes=tuple(PREFIXES), quotes: bool = True) -> Column:
    """Without role prefixes, one opener and quotes; single spaces; one sentence with a mark at its end.

    Every step reads the one before once, so the expression stays small however many steps there are.
    """
    a = strip(F.coalesce(c, F.lit("")))
    for p in prefixes:
        a = strip(F.regexp_replace(a, rf"(?i)^{p}\s*", ""))
    if strict:
        a = strip(F.regexp_replace(a, rf"(?is)^(?:{'|'.join(OPENERS)})[ :,\-]*(.*?)[ :,\-]*\z", "$1"))
    if quotes:
        a = F.regexp_replace(a, "^[`'\"]+|[`'\"]+$", "")
    a = F.regexp_replace(a, r"\s+", " ")
    if one_sentence:
        a = strip(F.regexp_replace(a, r"^(.+?[.!?])(?:\s.*)?\z", "$1"))
    return strip(F.regexp_replace(a, r"(?<=[^.!?])\z", "."))


def strip_chat_marks(c: Column) -> Column:
    """Without the marks of chat formats, ahead of clean_output."""
    a = strip(c)
    for mark in ("<|im_start|>assistant", "<|im_start|>user", "<|im_end|>", "<<<", ">>", "<|im_start|>"):
        a = F.replace(a, F.lit(mark), F.lit(""))
    return strip(a)


#: What small chat models put in front; fixed values.
CHAT_PREFIXES = [r"assistant[:\-]\s*", r"answer[:\-]\s*", r"response[:\-]\s*", r"a:\s*", r"q:\s*", r"here is.*?:\s*"]
#: Runs of this mark that the oldest cleaner removes, and where it ends a text, in this order; fixed values.
GARBLE, ENDS = "<", [".", "?", "!"]


def strip_chat_prefixes(c: Column) -> Column:
    """Without each of the prefixes once, in their order, ahead of clean_output."""
    a = strip(c)
    for p in CHAT_PREFIXES:
        a = strip(F.regexp_replace(a, f"(?i)^{p}", ""))
    return a


def clean_simple(c: Column) -> Column:
    """The oldest cleaner: what follows the last assistant mark, without angle brackets, single spaces, up to the first full stop.

    Where there is no full stop, up to the first question mark, else the first exclamation mark.
    """
    a = F.substring_index(F.coalesce(c, F.lit("")), "<|im_start|>assistant", -1)
    a = F.array_join(words(F.replace(a, F.lit(GARBLE), F.lit(""))), " ")
    out = F.lit(None).cast("string")
    for mark in reversed(ENDS):
        out = F.when(F.contains(a, F.lit(mark)), F.concat(F.substring_index(a, mark, 1), F.lit(mark))).otherwise(F.coalesce(out, a))
    return strip(out)


def clean_by_model(df: DataFrame, model: str = "model_name", text: str = "answer") -> DataFrame:
    """The cleaner of each model family by its name; others take the common one."""
    c, name = F.col(text), F.lower(F.coalesce(F.col(model), F.lit("")))
    more = (*PREFIXES, "Response:", "Explanation:")
    out = (
        F.when(name.contains("openelm-simple"), clean_simple(c))
        .when(name.contains("openelm"), clean_output(strip_chat_marks(c)))
        .when(name.contains("qwen"), clean_output(c, prefixes=more, quotes=False))
        .when(name.contains("tinyllama"), clean_output(strip_chat_prefixes(c)))
    )
    return df.withColumn(text, out.otherwise(clean_output(c)))


def strip_prompt(text: Column, prompt: Column) -> Column:
    """Without the echoed prompt: as a prefix, else up to its last occurrence."""
    rest = text.substr(F.length(prompt) + 1, F.length(text))
    return strip(F.when(text.startswith(prompt), rest).when(F.length(prompt) > 0, F.call_function("substring_index", text, prompt, F.lit(-1))).otherwise(text))


def grounded(answer: Column, context: Column, least: int = 2) -> Column:
    return shared_words(answer, context) >= least


def grounded_long(answer: Column, context: Column) -> Column:
    """A word of more than 3 letters is shared, and the answer doesn't say that it lacks information."""
    long = lambda c: F.filter(word_set(c), lambda w: F.length(w) > 3)
    return ~F.lower(answer).startswith("insufficient information") & F.arrays_overlap(long(answer), long(context))


def grounded_strict(answer: Column, context: Column) -> Column:
    return (F.size(words(answer)) >= 3) & (shared_words(answer, context) >= 2)


def ground_or_refuse(df: DataFrame, ok: Column) -> DataFrame:
    return df.withColumn("answer", F.when(F.coalesce(ok, F.lit(False)), F.col("answer")).otherwise(INSUFFICIENT))


def score(answer: Column, context: Column, none_shared: float = -10.0, by_length: bool = True, known: Column | None = None) -> Column:
    """Shared distinct words, with a penalty for none and a bonus or penalty for length; -Infinity for no answer.

    known: the context's word set, where it is at hand; the context isn't read then.
    """
    known = word_set(context) if known is None else known

    def points(counts: Column) -> Column:
        n, shared = counts["n"], counts["shared"]
        s = shared.cast("double") + F.when(shared == 0, none_shared).otherwise(0.0)
        return s + F.when(n.between(5, 40), 1.0).when((n < 3) | (n > 80), -2.0).otherwise(0.0) if by_length else s

    # The second set is hashed, so it is the answer's, which is the small one.
    sets = F.struct(word_set(strip(answer)).alias("own"), known.alias("known"))
    counts = once(sets, lambda r: F.struct(F.size(r["own"]).alias("n"), F.size(F.array_intersect(r["known"], r["own"])).alias("shared")))
    return F.when(F.coalesce(answer, F.lit("")) == "", F.lit(float("-inf"))).otherwise(once(counts, points))


def scored(df: DataFrame, **how) -> DataFrame:
    return df.withColumn("score", score(F.col("answer"), F.col("context"), **how))


def scored_in(answers: DataFrame, contexts: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """answers with score, against the contexts (key, context).

    A context's word set is made once, and an answer that a context has more than once, as to many questions, is scored once.
    """
    used = contexts.join(answers.select(key).distinct(), key, "left_semi")
    known = used.select(key, word_set(F.col("context")).alias("_known"))
    pairs = answers.select(key, "answer").distinct().join(known, key)
    points = pairs.select(F.col(key).alias("_key"), F.col("answer").alias("_answer"), score(F.col("answer"), F.lit(None), known=F.col("_known"), **how).alias("score"))
    rest = [c for c in answers.columns if c not in (key, "score")]
    return answers.drop("score").join(points, (F.col(key) == F.col("_key")) & F.col("answer").eqNullSafe(F.col("_answer"))).select(key, *rest, "score")


#: Models that a plan of samples takes at most.
MODELS = 1000


def sample_plan(questions: DataFrame, models: DataFrame, fixed: int = 3, drawn: int = 5) -> DataFrame:
    """A row for every question, model and sample; models (name) is a list of at most MODELS."""
    names = [r["name"] for r in models.select("name").limit(MODELS + 1).collect()]
    if len(names) > MODELS:
        raise ValueError(f"more than {MODELS} models")
    each = questions.select("*", F.explode(F.array(*map(F.lit, names)).cast("array<string>")).alias("name"))
    return each.select("*", F.explode(F.sequence(F.lit(1), F.lit(fixed + drawn))).alias("sample_id")).withColumn("do_sample", F.col("sample_id") > fixed)


def best_of_n(df: DataFrame) -> DataFrame:
    """The best sample of every question and model; ties go to the earlier one."""
    w = Window.partitionBy("question_id", "model_name").orderBy(F.desc("score"), "ord")
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def rank_models(df: DataFrame) -> DataFrame:
    """is_best, is_worst and the map of scores by model for every (question_id, model_name, ord, answer, score).

    In a stable descending sort the first is best and the last worst; a sole answer is not worst. A row for each model
    and question is expected, as best_of_n gives them.
    """
    w = Window.partitionBy("question_id")
    scores = F.map_from_entries(F.array_sort(F.collect_list(F.struct("model_name", "score")).over(w)))
    first = F.row_number().over(w.orderBy(F.desc("score"), "ord", "model_name"))
    last = F.row_number().over(w.orderBy("score", F.desc("ord"), F.desc("model_name")))
    out = df.withColumns({"_f": first, "_l": last, "_n": F.count(F.lit(1)).over(w), "answer_scores": scores})
    return out.withColumns({"is_best": F.col("_f") == 1, "is_worst": (F.col("_l") == 1) & (F.col("_n") > 1)}).drop("_f", "_l", "_n")


def nested_samples(df: DataFrame) -> DataFrame:
    """question_id, per_model_samples: model to its samples (rank order)."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("_s"), "ord", "answer", "score")))
    per = df.groupBy("question_id", "model_name").agg(F.transform(rows, lambda r: F.struct(r["ord"].alias("sample_id"), r["answer"].alias("answer"), r["score"].alias("score"))).alias("samples"))
    return per.groupBy("question_id").agg(F.map_from_entries(F.collect_list(F.struct("model_name", "samples"))).alias("per_model_samples"))


def wide_answers(df: DataFrame, models: list[str]) -> DataFrame:
    """question_id and a column answer_<model> for every model."""
    out = df.groupBy("question_id").pivot("model_name", models).agg(F.first("answer"))
    return out.select("question_id", *[F.col(m).alias(f"answer_{m}") for m in models])


def rerank(df: DataFrame) -> DataFrame:
    """Ranking of stored answers: best and worst model by their best score (null is 0), earliest on ties."""
    s = F.coalesce("score", F.lit(0.0))
    key, low = F.struct(s.alias("s"), (-F.col("ord")).alias("o")), F.struct(s.alias("s"), F.col("ord").alias("o"))
    per = df.groupBy("question_id", "model_name").agg(
        F.max(s).alias("top"), F.min("ord").alias("ord"), F.max_by("answer", key).alias("best"), F.min_by("answer", low).alias("worst")
    )
    up, down = F.struct("top", (-F.col("ord")).alias("o")), F.struct("top", "ord")
    return per.groupBy("question_id").agg(
        F.max_by("model_name", up).alias("best_model"), F.max_by("best", up).alias("best_answer"), F.min_by("model_name", down).alias("worst_model"),
        F.min_by("worst", down).alias("worst_answer"), F.map_from_entries(F.collect_list(F.struct("model_name", "top"))).alias("answer_scores"),
    )


def overwrite_rankings(stored: DataFrame, new: DataFrame) -> DataFrame:
    """One ranking for each question: the new one where there is one."""
    return new.unionByName(stored.join(new.select("question_id"), "question_id", "left_anti"))


def unknown_models(df: DataFrame, models: DataFrame) -> DataFrame:
    """Answers of models that nobody registered; must be empty before a write."""
    return df.join(models.select(F.col("name").alias("model_name")), "model_name", "left_anti")


def select_models(models: DataFrame, asked: list[str]) -> tuple[DataFrame, DataFrame]:
    """(chosen, missing): enabled models among those asked for, all enabled ones for an empty list."""
    enabled = models.filter("enabled")
    names = sorted({a.strip().lower() for a in asked} - {""})
    if not names:
        return enabled, enabled.select("name").limit(0)
    want = models.sparkSession.createDataFrame([(n,) for n in names], "name string")
    key = enabled.withColumn("_k", F.lower(strip(F.col("name"))))
    return key.join(want.withColumnRenamed("name", "_k"), "_k", "left_semi").drop("_k"), want.join(key.select(F.col("_k").alias("name")), "name", "left_anti")
