"""From text to questions: rule-based questions, parsing and gates for generated ones, batch generation."""

import re
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import once, shared_words, strip

#: Words and templates of the rules; fixed values.
BAD_STARTS = ["this ", "that ", "these ", "those ", "it "]
FACT_MARKS = [" is ", " are ", " must ", " shall ", " allows ", " enable", " occurs ", " results ", " removes ", " requires ", " supports "]
TEMPLATES = ["What is {focus}?", "What does {focus} refer to?", "Where is {focus} located?", "Which {focus} is mentioned?", "When does {focus} occur?"]
QUALITY_STARTS = "what|where|which|when|who"
PLACE = r"\{\s*\w+\s*\}"
VALID_STARTS = "what|who|when|where|why|how|which"


def sentences(df: DataFrame, longer_than: int = 20) -> DataFrame:
    """doc_id, ord, sentence of (doc_id, text): split at white space after . ! or ?"""
    # Stripped before the explode, so that every later use of a sentence reads a column.
    parts = F.transform(F.split(strip(F.col("text")), r"(?<=[.!?])\s+", -1), strip)
    return df.select("doc_id", F.posexplode(parts).alias("ord", "sentence")).filter(F.length("sentence") > longer_than)


def is_fact(c: Column) -> Column:
    def fits(low: Column) -> Column:
        bad, marks = F.lit(False), F.lit(False)
        for x in BAD_STARTS:
            bad = bad | low.startswith(x)
        for x in FACT_MARKS:
            marks = marks | low.contains(x)
        return ~bad & marks

    return once(F.lower(c), fits)


def facts(df: DataFrame) -> DataFrame:
    return df.filter(is_fact(F.col("sentence")))


def fact_list(text: Column, longer_than: int = 20) -> Column:
    """The facts among a text's sentences as an array of (ord, sentence), for rows that carry more than an id: those without any are seen before they are exploded."""
    parts = F.transform(F.split(strip(text), r"(?<=[.!?])\s+", -1), lambda s, i: F.struct(i.alias("ord"), strip(s).alias("sentence")))
    return F.filter(parts, lambda r: (F.length(r["sentence"]) > longer_than) & is_fact(r["sentence"]))


def statement_to_question(c: Column) -> Column:
    """The first rule that fits; a keyword needs spaces around it, its first occurrence counts."""

    def question(s: Column, low: Column) -> Column:
        before = lambda verb: strip(F.substring(s, F.lit(1), F.instr(low, verb) - 1))
        out = F.when(low.contains(" must "), F.concat(F.lit("What must be done "), strip(s.substr(F.instr(low, "must") + 4, F.length(s))), F.lit("?")))
        for verb in ("allows", "enables", "supports"):
            out = out.when(low.contains(f" {verb} "), F.concat(F.lit("What does "), before(verb), F.lit(f" {verb}?")))
        for verb in ("occurs", "results", "removes"):
            out = out.when(low.contains(f" {verb} "), F.concat(F.lit("What happens when "), before(verb), F.lit("?")))
        return out.otherwise(F.concat(F.lit("What is stated about "), F.regexp_extract(s, r"(\S+)", 1), F.lit("?")))

    return once(F.regexp_replace(strip(c), r"\.+$", ""), lambda s: once(F.lower(s), lambda low: question(s, low)))


def rule_based_qa(df: DataFrame, instruction: str = "Answer the question using only the provided context.") -> DataFrame:
    """Question and answer rows of every fact in (doc_id, text)."""
    rows = facts(sentences(df))
    return rows.select(
        "doc_id", "ord", F.lit(instruction).alias("instruction"), F.col("sentence").alias("context"),
        statement_to_question(F.col("sentence")).alias("question"), F.col("sentence").alias("response"),
    )


def fact_lines(df: DataFrame, longer_than: int = 20) -> DataFrame:
    """Lines without bullets, long enough and no questions."""
    rows = df.select("doc_id", F.posexplode(F.split("text", r"\r\n|[\n\r]", -1)).alias("ord", "fact"))
    rows = rows.withColumn("fact", F.regexp_replace("fact", r"^[ \-*\t]+|[ \-*\t]+$", ""))
    return rows.filter((F.length("fact") > longer_than) & ~F.col("fact").endswith("?"))


def fact_to_question(c: Column) -> Column:
    fact = F.regexp_replace(c, r"\.+$", "")
    low = F.lower(fact)
    return (
        F.when(low.startswith("the person"), "What must the person completing the action do?")
        .when(low.startswith("the technician"), "What must the technician do?")
        .when(low.contains("date of release"), "What is the date of release of the document?")
        .when(low.contains("procedure"), "What is the procedure described?")
        .when(low.startswith("unused pages"), "Why are unused pages required?")
        .otherwise(F.concat(F.lit("What is stated regarding "), low, F.lit("?")))
    )


def parse_questions(df: DataFrame, n: int = 5) -> DataFrame:
    """(doc_id, text) of a model to its first n distinct questions, in order."""
    rows = df.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("ord", "question"))
    q = strip(F.col("question"))
    for label in ("Q:", "Q1:", "Q2:", "Question:"):
        q = F.replace(q, F.lit(label), F.lit(""))
    rows = rows.withColumn("question", strip(q)).filter((F.col("question") != "") & ~F.lower("question").rlike("^(questions|context)"))
    rows = rows.withColumn("question", F.when(F.col("question").endswith("?"), F.col("question")).otherwise(F.concat("question", F.lit("?"))))
    firsts = rows.groupBy("doc_id", "question").agg(F.min("ord").alias("ord"))
    return firsts.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))).filter(F.col("_n") <= n).drop("_n")


def apply_templates(df: DataFrame) -> DataFrame:
    """(…, ord, question): kept when it begins with a capital and ends with ?, else put into template ord mod 5."""
    q = strip(F.coalesce("question", F.lit("")))
    focus = F.regexp_extract(q, r"(?i)(what|where|which|when|who)\s+(.*)", 2)
    focus = F.when(q.rlike(r"(?i)(what|where|which|when|who)\s+"), strip(focus)).otherwise(q)
    templates = F.array(*map(F.lit, TEMPLATES))
    made = F.replace(F.element_at(templates, (F.col("ord") % len(TEMPLATES) + 1).cast("int")), F.lit("{focus}"), F.regexp_replace(focus, r"\?+$", ""))
    return df.withColumn("question", F.when(q.rlike(r"^\p{Lu}") & q.endswith("?"), q).otherwise(made)).filter(q != "")


def quality_pass(question: Column, context: Column, least: int = 12) -> Column:
    q = strip(question)
    shared = shared_words(F.regexp_replace(q, r"\?+$", ""), context)
    return (F.length(q) >= least) & F.lower(q).rlike(f"^({QUALITY_STARTS})") & q.endswith("?") & (shared >= 2)


def valid_question(question: Column, longest: int = 240) -> Column:
    q = strip(question)
    return q.endswith("?") & q.rlike(rf"(?i)^({VALID_STARTS})\b") & ~q.rlike(r"\d+\.\d+\.\d+\.\d+") & (F.length(q) <= longest)


def _cosine(a, b):
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def greedy_dedupe(df: DataFrame, group: str, threshold: float = 0.70) -> DataFrame:
    """(group, ord, vector): in order, a row stays when no kept row is nearer than the threshold.

    The kept rows of a group are an array, so groups are the questions of a chunk; for a corpus see neardup.keep_first.
    A zero vector is near to none.
    """
    kind = df.select(F.struct("ord", "vector").alias("r")).schema["r"].dataType.simpleString()
    rows = F.array_sort(F.collect_list(F.struct("ord", "vector")))
    kept = F.aggregate(
        rows, F.array().cast(f"array<{kind}>"),
        lambda acc, r: F.when(F.exists(acc, lambda k: _cosine(k["vector"], r["vector"]) > threshold), acc).otherwise(F.concat(acc, F.array(r))),
    )
    return df.groupBy(group).agg(kept.alias("_k")).select(group, F.explode("_k.ord").alias("ord"))


def exact_dedupe(df: DataFrame, group: str) -> DataFrame:
    """The first of every question in a group, by its stripped lower-case text; blank ones go."""
    key = F.lower(strip(F.col("question")))
    w = Window.partitionBy(group, key).orderBy("ord")
    return df.withColumn("_n", F.row_number().over(w)).filter((F.col("_n") == 1) & (key != "")).drop("_n")


def choose_attempt(df: DataFrame, group: str) -> DataFrame:
    """(group, attempt, ord, question, context, crashed): questions of the first attempt with a survivor.

    Else those of the last attempt that didn't crash that pass the validity gate alone.
    """
    made = apply_templates(df.filter("not crashed"))
    valid = valid_question(F.col("question"))
    good = made.filter(quality_pass(F.col("question"), F.col("context")) & valid)
    good = exact_dedupe(good.withColumn("_g", F.struct(group, "attempt")), "_g").drop("_g")
    first = good.groupBy(group).agg(F.min("attempt").alias("_a"))
    last = df.filter("not crashed").groupBy(group).agg(F.max("attempt").alias("_a")).join(first, group, "left_anti")
    pick = lambda rows, which: rows.join(which, group).filter("attempt = _a").drop("_a")
    return pick(good, first).unionByName(pick(made.filter(valid), last)).drop("crashed")


def number_questions(df: DataFrame, group: str) -> DataFrame:
    return df.withColumn("question_index", F.row_number().over(Window.partitionBy(group).orderBy("ord")))


def render_prompt(df: DataFrame, template: str, longest: int = 2400, cut_from: str = "tail", out: str = "prompt", context: str = "context", context_longest: int = 1200, strict: bool = True) -> DataFrame:
    """Fills {column} places; a missing column fails when the plan is made; too long a prompt loses its head or tail.

    The context column is cut to context_longest first. With strict, a prompt that still holds a {place} fails.
    """
    names = re.findall(r"\{(\w+)\}", template)
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"the template needs columns {missing}")
    if cut_from not in ("head", "tail"):
        raise ValueError(f"cut_from is head or tail, not {cut_from}")
    parts = re.split(r"(\{\w+\})", template)
    value = lambda n: F.left(F.col(n), F.lit(context_longest)) if n == context else F.col(n).cast("string")
    text = F.concat(*(F.coalesce(value(p[1:-1]), F.lit("")) if p[:1] == "{" else F.lit(p) for p in parts if p))
    cut = F.left(text, F.lit(longest)) if cut_from == "tail" else F.right(text, F.lit(longest))
    if not strict:
        return df.withColumn(out, cut)
    bad = F.raise_error(F.concat(F.lit("a place was not rendered: "), F.regexp_extract(cut, PLACE, 0))).cast("string")
    return df.withColumn(out, F.when(cut.rlike(PLACE), bad).otherwise(cut))


def generate(df: DataFrame, make: Callable, schema: str) -> DataFrame:
    """Batch generation: make() is called once in a Python worker and gives a function from pandas frames to frames."""

    def run(frames):
        model = make()
        for pdf in frames:
            yield model(pdf)

    return df.mapInPandas(run, schema)


def quarantined(make: Callable, columns: list[str]) -> Callable:
    """A factory for generate() whose model doesn't fail: rows that it can't take come back with what was wrong in error.

    A batch that fails is tried again row by row, so that one bad row doesn't cost the others.
    """

    def factory():
        model = make()

        def run(pdf):
            try:
                return model(pdf).assign(error=None)
            except Exception:
                if len(pdf) > 1:
                    return pd.concat([run(pdf.iloc[i : i + 1]) for i in range(len(pdf))])
                import traceback

                what = traceback.format_exc().strip().rpartition("\n")[2]
                out = pd.DataFrame({c: pdf[c].tolist() if c in pdf else [None] for c in columns})
                return out.assign(error=what)

        return run

    return factory


def generate_resumable(df: DataFrame, make: Callable, schema: str, key: list[str], out: str, model: str | None = None, slices: int = 16, parts: int = 8) -> DataFrame:
    """generate() over the rows whose keys out lacks, in slices that are written one after another; all of out, when done.

    After a crash the same call goes on where it stopped: what a slice has written isn't made again, and a slice that
    didn't end leaves nothing. Rows that fail are kept with error set, and are not tried again. model: a column of model
    names; a slice's rows are then dealt by it, over parts tasks a model, so a worker loads one model for its rows.
    key: columns of df and of schema.
    """
    spark = df.sparkSession
    columns = [f.name for f in T.StructType.fromDDL(schema).fields]
    made = quarantined(make, columns)
    slot = F.pmod(F.xxhash64(F.lit("slice"), *key), F.lit(slices))
    for i in range(slices):
        todo = df.filter(slot == i)
        done = f"{out}/slice={i}"
        try:
            todo = todo.join(spark.read.schema(schema).parquet(done).select(*key).distinct(), key, "left_anti")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        if todo.isEmpty():
            continue
        if model:
            todo = todo.repartition(model, F.pmod(F.xxhash64(*key), F.lit(parts)))
        generate(todo, made, schema + ", error string").write.mode("append").parquet(done)
    return spark.read.schema(schema + ", error string").parquet(out).select(*columns, "error")


def by_class_path(path: str) -> Callable:
    """A factory for generate(): imports package.module.Class in the worker, once for each process."""

    def make():
        import importlib

        if path not in _loaded:
            module, _, name = path.rpartition(".")
            _loaded[path] = getattr(importlib.import_module(module), name)()
        return _loaded[path]

    return make


_loaded: dict = {}
