"""Scoring of all topics against all documents, top-k cut and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trawl.functions.scoring import Collection, Scorer, rounded
from trawl.operators.keyed import BROADCAST_ROWS, is_small
from trawl.storage import scratch_path, written

PUSHED_TERMS = 500
# Matches, and topics, of one cell of a salted term.
SALT_ROWS = 5_000_000
TOPIC_ROWS = 1000
TOP_K_GROUP_ROWS = 2_000_000
# Rows of a group that tasks may send to the shuffle without a first pass for its bar.
SHUFFLED_GROUP_ROWS = 300_000
# One in so many documents is scored in that pass.
BAR_SHARE = 4
# Bins of scores per doubling; the offset keeps those of positive scores above zero.
BINS = 64
BIN_OFFSET = 100_000


def weigh_topic_terms(topic_terms: DataFrame, terms: DataFrame) -> DataFrame:
    """Topic terms that occur in the collection, with their statistics."""
    small = is_small(topic_terms, BROADCAST_ROWS)
    side = F.broadcast(topic_terms) if small else topic_terms
    return terms.join(side, "term").select("qid", "term", "qtf", "df", "ttf")


def restrict_to_terms(postings: DataFrame, weighed: DataFrame) -> DataFrame:
    """Push the distinct topic terms into the scan when there are few.

    Files are sorted by term, so Parquet then reads only the pages that can hold them.
    With more terms the join alone does the selection.
    """
    wanted = [r.term for r in weighed.select("term").distinct().limit(PUSHED_TERMS + 1).collect()]
    if len(wanted) > PUSHED_TERMS:
        return postings
    _raise_setting(postings.sparkSession, "spark.sql.parquet.pushdown.inFilterThreshold", PUSHED_TERMS)
    return postings.where(F.col("term").isin(wanted))


def match_postings(
    postings: DataFrame, weighed: DataFrame, side: DataFrame | None = None
) -> DataFrame:
    """Postings of the topic terms, one row per (topic, document, matched term), with
    the columns of ``side``: ``weighed`` itself or the same rows with more columns.

    The topic side is broadcast after a count, which keeps the postings where they are
    and their partitioning by document. A topic side too large for that is joined by a
    shuffle on the term, with the postings of every term spread over salts because the
    frequent terms hold most of them.
    """
    side = weighed if side is None else side
    if is_small(weighed, BROADCAST_ROWS):
        return restrict_to_terms(postings, weighed).join(F.broadcast(side), "term")
    return salted_match(postings, side)


def salted_match(postings: DataFrame, weighed: DataFrame) -> DataFrame:
    """Shuffle join on (term, cell): the matches of a term are laid out as a grid of cells,
    salts of its postings by salts of its topics, of ``SALT_ROWS`` matches about."""
    left, right = into_cells(postings, weighed)
    cell = ["term", "salt", "topic_salt"]
    return left.join(right, cell).drop("salt", "topic_salt")


def into_cells(postings: DataFrame, weighed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join by ``term, salt, topic_salt``.

    A posting goes to one salt and there to every topic salt, a topic's term to one topic
    salt and there to every salt. Terms of a single cell are left alone; those with more
    are at most all matches divided by ``SALT_ROWS``, and are broadcast after a count.
    """
    topics = F.count("*")
    topic_salts = F.ceil(topics / TOPIC_ROWS)
    salts = F.ceil(F.max("df") * F.least(topics, F.lit(TOPIC_ROWS)) / SALT_ROWS)
    grid = weighed.groupBy("term").agg(salts.alias("salts"), topic_salts.alias("topic_salts"))
    grid = grid.where("salts > 1 OR topic_salts > 1")
    if is_small(grid, BROADCAST_ROWS):
        grid = F.broadcast(grid)

    def laid_out(rows: DataFrame, own: str, key: str, other: str, numbers: tuple[str, str]) -> DataFrame:
        count, copies = (F.coalesce(F.col(n), F.lit(1)).cast("long") for n in numbers)
        spread = rows.join(grid, "term", "left").withColumn(own, F.pmod(F.xxhash64(key), count))
        return spread.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).drop("salts", "topic_salts")

    return (
        laid_out(postings, "salt", "docno", "topic_salt", ("salts", "topic_salts")),
        laid_out(weighed, "topic_salt", "qid", "salt", ("topic_salts", "salts")),
    )


def candidates(matches: DataFrame) -> DataFrame:
    """Documents with at least one term of the topic, and how many distinct ones."""
    return matches.groupBy("qid", "docno").agg(F.count("*").alias("matched_terms"))


def matched_sums() -> list:
    """Sums over the topic's tokens found in the document, repeats counted again."""
    return [
        F.sum(F.col("qtf") * F.col("tf")).alias("sum_tf"),
        F.sum(F.col("qtf") * F.col("df")).alias("sum_df"),
        F.sum(F.col("qtf") * F.col("ttf")).alias("sum_ttf"),
    ]


def with_topic_sums(
    weighed: DataFrame, scorers: list[Scorer], collection: Collection
) -> DataFrame:
    """Add the per-topic sums that scorers ask for to every term row of the topic.

    They ride along with the matches, so nothing is joined by topic after scoring.
    """
    topic = Window.partitionBy("qid")
    return weighed.select(
        "*",
        *[
            F.sum(s.topic(collection)).over(topic).alias(f"t_{s.name}")
            for s in scorers
            if s.topic is not None
        ],
    )


def score_pairs(
    matches: DataFrame, scorers: list[Scorer], collection: Collection
) -> DataFrame:
    """One row per (topic, document) candidate, one score column per model.

    All models come from one grouping. Over postings partitioned by document the
    grouping needs no exchange.
    """
    sums = [F.sum(s.match(collection)).alias(f"m_{s.name}") for s in scorers]
    constants = [
        F.max(f"t_{s.name}").alias(f"t_{s.name}") for s in scorers if s.topic is not None
    ]
    pairs = matches.groupBy("qid", "docno", "doclength").agg(*sums, *constants)
    return pairs.select(
        "qid",
        "docno",
        *[
            s.score(collection, F.col(f"m_{s.name}"), F.col(f"t_{s.name}")).alias(s.name)
            for s in scorers
        ],
    )


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket that a table hash-bucketed by ``key`` keeps a row in."""
    return F.pmod(F.hash(key), F.lit(buckets))


def rank_hits(
    scored: DataFrame,
    models: list[str],
    k: int,
    parts: int = 1,
    digits: dict[str, int] | None = None,
) -> DataFrame:
    """Best ``k`` documents per model and topic, zero scores dropped after the cut,
    then ranked without gaps.

    Order goes by the score rounded to the model's ``digits`` (6 by default) and then by
    document id, so that it does not depend on the order of summation. Whether a score is
    zero, and the score returned, are the score itself.

    Each task keeps at most ``k`` rows per group before the shuffle. From ``parts``
    buckets one group still receives up to ``parts * k`` rows; when that is too many to
    shuffle, rows that cannot be among the best are left out first (``above_bars``).
    """
    _raise_setting(scored.sparkSession, "spark.sql.optimizer.windowGroupLimitThreshold", k)
    hits = scored.unpivot(["qid", "docno"], models, "model", "score")
    place = rounded(F.col("score"), 6)
    for model, own in (digits or {}).items():
        if own != 6:
            place = F.when(F.col("model") == model, rounded(F.col("score"), own)).otherwise(place)
    hits = hits.withColumn("place", place)
    order = [F.desc("place"), F.asc("docno")]
    if parts * k > min(TOP_K_GROUP_ROWS, SHUFFLED_GROUP_ROWS):
        hits = above_bars(hits, ["model", "qid"], "place", k, BAR_SHARE)
    best_first = Window.partitionBy("model", "qid").orderBy(*order)
    top = hits.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return top.where(F.col("score") != 0).select(
        "qid", "docno", "model", "score",
        F.row_number().over(best_first).cast("long").alias("rank"),
    )


def score_bin(score: Column) -> Column:
    """A number that never falls as the score rises: ``BINS`` steps per doubling."""
    step = F.floor(F.log2(F.abs(score)) * BINS) + BIN_OFFSET
    return F.when(score > 0, step).when(score < 0, -step).otherwise(F.lit(0).cast("long"))


def above_bars(hits: DataFrame, group: list[str], score: str, k: int, share: int = 1) -> DataFrame:
    """Rows in reach of the best ``k`` of their group: all of these, and few others.

    A first pass over ``hits`` counts each group's rows by bins of the score, reduced in
    every task. The highest bin that ``k`` rows reach is the group's bar; groups of fewer
    rows have none. The second pass drops what lies below its bar before any shuffle.

    ``k`` rows among some documents are as many among all, so a bar found in the first pass
    from one in ``share`` documents leaves out none of the best either; it is lower, and
    about ``share`` times ``k`` rows stay.
    """
    met = hits.where(F.pmod(F.xxhash64("docno"), F.lit(share)) == 0) if share > 1 else hits
    binned = met.groupBy(*group, score_bin(F.col(score)).alias("bin")).count()
    downwards = Window.partitionBy(*group).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    reached = binned.withColumn("reached", F.sum("count").over(downwards)).where(F.col("reached") >= k)
    bars = written(reached.groupBy(*group).agg(F.max("bin").alias("bar")), "bars")
    side = F.broadcast(bars) if is_small(bars, BROADCAST_ROWS) else bars
    near = hits.join(side, group, "left")
    return near.where(F.col("bar").isNull() | (score_bin(F.col(score)) >= F.col("bar"))).drop("bar")


def rank_all(predictions: DataFrame, group: list[str], score: str, parts: int) -> DataFrame:
    """Rank every row of each group by descending ``score``; ties by document id.

    Nothing is cut here, so one group may be most of the table. When the largest group
    is too many rows for one task, rows are range-partitioned by (group, score, id),
    ranked inside each range, and shifted by the number of rows in earlier ranges. Pass
    a written table: it is read more than once.
    """
    order = [F.desc(score), F.asc("docno")]
    sizes = predictions.groupBy(*group).count()
    largest = sizes.agg(F.max("count")).first()[0] or 0
    if largest <= TOP_K_GROUP_ROWS:
        best_first = Window.partitionBy(*group).orderBy(*order)
        return predictions.withColumn("rank", F.row_number().over(best_first).cast("long"))
    return rank_by_ranges(predictions, group, score, parts)


def rank_by_ranges(
    predictions: DataFrame, group: list[str], score: str, parts: int
) -> DataFrame:
    spark = predictions.sparkSession
    order = [F.desc(score), F.asc("docno")]
    path = scratch_path(spark, "ranges")
    # Range bounds are sampled, so the split into ranges is written before it is used.
    (
        predictions.repartitionByRange(parts, *group, *order)
        .withColumn("range", F.spark_partition_id())
        .write.parquet(path)
    )
    ranged = spark.read.parquet(path)
    earlier = Window.partitionBy(*group).orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = (
        ranged.groupBy(*group, "range").count()
        .withColumn("shift", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        .drop("count")
    )
    within = Window.partitionBy(*group, "range").orderBy(*order)
    ranked = ranged.withColumn("rank", F.row_number().over(within))
    return (
        ranked.join(shifts, [*group, "range"])
        .withColumn("rank", F.col("rank") + F.col("shift"))
        .drop("range", "shift")
    )


def _raise_setting(spark: SparkSession, key: str, value: int) -> None:
    if int(spark.conf.get(key)) < value:
        spark.conf.set(key, str(value))
