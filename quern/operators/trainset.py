"""Training rows: texts, labels, truncation, shards, step plans."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import strip, words
from quern.sources.files import stored


def sft_text(df: DataFrame) -> DataFrame:
    """train_text of (prompt or instruction, response) or text; null for rows that have neither."""
    c = lambda n: F.nullif(F.col(n), F.lit("")) if n in df.columns else F.lit(None).cast("string")
    pair = F.concat(F.lit("Instruction: "), F.coalesce(c("prompt"), c("instruction")), F.lit("\nResponse: "), c("response"))
    return df.withColumn("train_text", F.coalesce(pair, c("text")))


def sft_rejects(df: DataFrame) -> DataFrame:
    return sft_text(df).filter("train_text is null")


def plain_text(df: DataFrame) -> DataFrame:
    c = lambda n: F.col(n) if n in df.columns else F.lit(None).cast("string")
    pair = strip(F.concat(F.coalesce(c("prompt"), F.lit("")), F.lit("\n"), F.coalesce(c("response"), F.lit(""))))
    return df.withColumn("train_text", F.coalesce(F.nullif(c("text"), F.lit("")), pair))


def _numbered(labels: DataFrame, order: str) -> DataFrame:
    """label_id from 0 in this order, however many labels there are: range partitions are counted, and rows numbered inside."""
    rows = stored(labels.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    numbered = rows.withColumn("_part", part).join(F.broadcast(before), "_part")
    label_id = F.col("_before") + F.col("_at") - F.shiftleft(F.col("_part"), 33)
    return numbered.withColumn("label_id", label_id.cast("int")).drop("_part", "_at", "_before")


def first_seen_labels(df: DataFrame, label: str = "label", order: str = "ord") -> DataFrame:
    """label_id in the order in which labels are first seen."""
    ids = _numbered(df.groupBy(label).agg(F.min(order).alias("_o")), "_o").drop("_o")
    return df.join(ids, label)


def intent_rows(df: DataFrame, order: str = "ord") -> DataFrame:
    """text (or query, or instruction) and label_id of (order, …, label, label_id); a given label_id stands.

    Other labels are numbered in the order in which they are first seen. A row without text, or without label and
    label_id, fails.
    """
    c = lambda n: F.col(n).cast("string") if n in df.columns else F.lit(None).cast("string")
    text = F.coalesce(*(F.nullif(c(n), F.lit("")) for n in ("text", "query", "instruction")))
    given = c("label_id").cast("int")
    rows = df.select(order, text.alias("text"), c("label").alias("label"), given.alias("_given"))
    ids = _numbered(rows.filter("_given is null and label is not null").groupBy("label").agg(F.min(order).alias("_o")), "_o").drop("_o")
    fail = lambda what: F.raise_error(F.lit(f"an intent row has no {what}"))
    joined = rows.join(ids, "label", "left")
    label_id = F.coalesce("_given", "label_id")
    return joined.select(
        order, F.when(F.col("text").isNull(), fail("text").cast("string")).otherwise(F.col("text")).alias("text"),
        F.when(label_id.isNull(), fail("label").cast("int")).otherwise(label_id).alias("label_id"),
    )


def sorted_labels(df: DataFrame, label: str = "label") -> DataFrame:
    return _numbered(df.select(label).distinct(), label)


def collate(df: DataFrame, batch_size: int, max_length: int, order: str = "ord") -> DataFrame:
    """Words as tokens, cut to max_length; n_pad to the longest of the batch; labels of padding are -100.

    batch numbers come from the given order column, which runs from 0.
    """
    w = words(F.coalesce("train_text", F.lit("")))
    rows = df.withColumns({"tokens": F.slice(w, 1, max_length), "batch": F.floor(F.col(order) / batch_size)})
    most = F.max(F.size("tokens")).over(Window.partitionBy("batch"))
    rows = rows.withColumn("n_pad", most - F.size("tokens"))
    return rows.withColumn("label_mask", F.concat(F.array_repeat(F.lit(1), F.size("tokens")), F.array_repeat(F.lit(-100), F.col("n_pad"))))


def shard(df: DataFrame, key: str, world: int, seed: int = 0, digits: int = 3) -> DataFrame:
    """rank and place of every row in a hashed order, dealt in turn; first rows again until shards are equal.

    A global row number without one task: buckets of the first hex digits of the hash, row numbers inside, and the sums
    of the buckets before. digits: 4,096 buckets by default, 65,536 with 4, and no more than that.
    """
    if not 1 <= digits <= 4:
        raise ValueError("digits is 1 to 4")
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    rows = df.withColumn("_h", h).withColumn("_b", F.left("_h", F.lit(digits)))
    sizes = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumns({"_before": F.sum("_n").over(Window.orderBy("_b")) - F.col("_n"), "_total": F.sum("_n").over(Window.partitionBy())})
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)) - 1 + F.col("_before")
    placed = rows.join(F.broadcast(before), "_b").withColumn("place", place.cast("long"))
    extra = F.pmod(-F.col("_total"), F.lit(world))
    again = placed.filter(F.col("place") < extra).withColumn("place", F.col("place") + F.col("_total"))
    return placed.unionByName(again).withColumn("rank", (F.col("place") % world).cast("int")).drop("_h", "_b", "_n", "_before", "_total")


def step_plan(df: DataFrame, batch: int, accumulate: int, epochs: int, max_steps: int | None = None) -> DataFrame:
    """Rows, rows without a pair, batches, planned and really stepped optimizer steps; no rows fail."""
    sums = sft_text(df).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("response").isNull()).alias("n_fallback"), F.count_if(F.col("train_text").isNull()).alias("n_invalid"))
    n = F.when(F.col("n_rows") == 0, F.raise_error(F.lit("the dataset is empty")).cast("long")).otherwise(F.col("n_rows"))
    out = sums.withColumn("batches", F.ceil(n / batch).cast("long"))
    planned = (F.ceil(F.col("batches") / accumulate) * epochs).cast("long")
    out = out.withColumn("planned", planned if max_steps is None else F.least(planned, F.lit(max_steps).cast("long")))
    stepped = F.floor(F.col("batches") * epochs / accumulate).cast("long")
    return out.withColumn("stepped", stepped if max_steps is None else F.least(stepped, F.lit(max_steps).cast("long")))
