"""Benchmark decontamination: n-grams of test items found in training text.

Everything is a DataFrame expression. The distinct test n-grams are counted, fetched and
sent to every task as a hash set: ``SET_GRAMS`` of them inside the expression, more of them
as a broadcast of their 64-bit hashes. Each document's windows are hashed in place and looked
up, and hits are verified against the n-gram's own words, so that neither the text nor its
windows are shuffled. Only beyond ``BROADCAST_HASHES`` n-grams do windows meet them in a
shuffle.

Defined cases: null or empty text has no words and no hits; a null or word-free item has
no n-gram; repeated documents give one row each; repeated items share their n-grams and
are all named; empty tables give no rows or no hits; further columns pass through, and
columns named like an added one are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import ascii_lower, only_null_free, stored

WINDOW = 13
# Most distinct n-grams sent inside the expression, and most bytes of them.
SET_GRAMS, SET_BYTES = 20_000, 4 << 20
# Most hashes sent to every executor, about 50 bytes each there.
BROADCAST_HASHES = 4_000_000
# Most bytes of n-grams, of the items they name, or of hits sent to every executor.
BROADCAST_BYTES = 64 << 20
# Windows of a text made at a time, and parts of an n-gram that very many texts hold.
BLOCK, SALTS = 4096, 16
# Delimiters left once A-Z are lower-cased: every ASCII character but digits and a-z.
DELIMITER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ADDED = ["n_words", "hits", "n_hit", "words"]


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of digits, a-z and everything beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(only_null_free(text)), DELIMITER), "")


def item_grams(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct n-grams of the items: ``gram``, ``length`` and the sorted ids that hold it.

    An item shorter than the window is one n-gram of its own length.
    """
    words = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("words"))
    sized = words.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    grams = sized.select(
        "item_id", "length",
        F.explode(F.transform(starts, lambda i: F.concat_ws(" ", F.slice("words", i, F.col("length"))))).alias("gram"),
    )
    return grams.groupBy("gram", "length").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))


def gram_hash(words: Column, start: Column, length: int) -> Column:
    return F.xxhash64(F.slice(words, start, length))


def _literals(values: list, quote: bool) -> str:
    # Words hold neither quotes nor backslashes: both are delimiters.
    return ", ".join(f"'{v}'" if quote else f"{v}L" for v in values)


def covered(hits: Column) -> Column:
    """Number of words inside any hit window; hits are sorted (start, length) pairs."""
    folded = F.aggregate(
        hits,
        F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
        lambda acc, hit: F.struct(
            (acc["total"] + F.greatest(F.lit(0), hit["start"] + hit["length"] - F.greatest(acc["end"], hit["start"]))).alias("total"),
            F.greatest(acc["end"], hit["start"] + hit["length"]).alias("end"),
        ),
    )
    return folded["total"].cast("long")


def _with_words(docs: DataFrame, text_col: str) -> DataFrame:
    clear = docs.drop(*[c for c in ADDED if c != text_col])
    return clear.withColumn("words", words_of(F.col(text_col))).withColumn("n_words", F.size("words").cast("long"))


def _hits_by_set(docs: DataFrame, grams: list, text_col: str) -> DataFrame:
    """Hits found in place, with the n-grams as a hash set inside the expression.

    The words are bound to a lambda variable: a filter on the hits that is pushed below the
    projection then splits the text once, not at every window.
    """
    found = []
    for length in sorted({g["length"] for g in grams}):
        own = [g for g in grams if g["length"] == length]
        hashes, texts = _literals(sorted({g["hash"] for g in own}), False), _literals(sorted(g["gram"] for g in own), True)
        starts = f"sequence(1, greatest(size(ws) - {length - 1}, 1))"
        found.append(
            f"CASE WHEN size(ws) >= {length} THEN transform(filter(filter({starts}, "
            f"i -> xxhash64(slice(ws, i, {length})) IN ({hashes})), "
            f"i -> concat_ws(' ', slice(ws, i, {length})) IN ({texts})), "
            f"i -> struct(i AS start, {length} AS length)) "
            "ELSE array() END"
        )
    empty = "CAST(array() AS ARRAY<STRUCT<start: INT, length: INT>>)"
    hits = f"element_at(transform(array(words), ws -> sort_array(concat({empty}, {', '.join(found)}))), 1)" if found else empty
    return _with_words(docs, text_col).withColumn("hits", F.expr(hits))


def _bytes(df: DataFrame, size: Column) -> int:
    return int(df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0])


def _windows(kept: DataFrame, length: int) -> DataFrame:
    """Every window of ``length`` words, made a block of words at a time."""
    blocks = kept.where(F.size("words") >= length).select(
        "__row", "words", F.explode(F.sequence(F.lit(0), F.floor((F.size("words") - length) / BLOCK).cast("int"))).alias("block"))
    parts = blocks.select("__row", "block", F.slice("words", F.col("block") * BLOCK + 1, BLOCK + length - 1).alias("part"))
    grams = F.transform(F.sequence(F.lit(1), F.size("part") - length + 1), lambda i: F.concat_ws(" ", F.slice("part", i, length)))
    windows = parts.select("__row", "block", F.posexplode(grams).alias("at", "gram"))
    place = (F.col("block") * BLOCK + F.col("at") + 1).alias("start")
    return windows.select("__row", F.struct(place, F.lit(length).alias("length")).alias("hit"), "gram")


def _verified(found: DataFrame, known: DataFrame, size: Column) -> DataFrame:
    """``found`` joined with ``known`` n-grams by their words; frequent ones are salted."""
    if _bytes(known, size) <= BROADCAST_BYTES:
        return found.join(F.broadcast(known), "gram")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    salted = found.withColumn("__salt", F.pmod(F.xxhash64("__row"), F.lit(SALTS)).cast("int"))
    return salted.join(known.select("*", salts), ["gram", "__salt"]).drop("__salt")


def _hits_by_hash(docs: DataFrame, grams: DataFrame, lengths: list[int], few: bool, text_col: str) -> DataFrame:
    """The same hits for test sets too large to sit in an expression.

    Windows are made where their text lies and looked up among the hashes; with ``few``
    hashes by broadcast. Rows are written with an id first, so that the id cannot change
    between its uses; what is found returns to them by that id.
    """
    kept = stored(_with_words(docs, text_col).withColumn("__row", F.monotonically_increasing_id()), "windows")
    hashes = grams.select(F.xxhash64("gram").alias("hash")).distinct()
    known = grams.select("gram")
    parts = []
    for length in lengths:
        windows = _windows(kept, length).withColumn("hash", F.xxhash64("gram"))
        parts.append(windows.join(F.broadcast(hashes) if few else hashes, "hash", "left_semi").drop("hash"))
    found = reduce(DataFrame.union, parts)
    hit = _verified(found, known, F.length("gram") + 32)
    hits = stored(hit.groupBy("__row").agg(F.sort_array(F.collect_set("hit")).alias("hits")), "hits")
    small = _bytes(hits, F.size("hits") * 16 + 64) <= BROADCAST_BYTES
    none = F.expr("CAST(array() AS ARRAY<STRUCT<start: INT, length: INT>>)")
    marked = kept.join(F.broadcast(hits) if small else hits, "__row", "left")
    return marked.withColumn("hits", F.coalesce("hits", none)).drop("__row")


def _mark(docs: DataFrame, grams: DataFrame, text_col: str, set_grams: int, most_hashes: int) -> DataFrame:
    facts = grams.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.length("gram")), F.lit(0)).alias("size"), F.sort_array(F.collect_set("length")).alias("lengths"),
    ).first()
    if not facts.n or (facts.n <= set_grams and facts.size <= SET_BYTES):
        fetched = grams.select("gram", "length", F.xxhash64(F.split("gram", " ")).alias("hash")).collect()
        marked = _hits_by_set(docs, fetched, text_col)
    else:
        marked = _hits_by_hash(docs, grams, facts.lengths, facts.n <= most_hashes, text_col)
    return marked.withColumn("n_hit", covered(F.col("hits")))


def mark_hits(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    window: int = WINDOW, set_grams: int = SET_GRAMS, most_hashes: int = BROADCAST_HASHES,
) -> DataFrame:
    """Add ``words``, ``n_words``, ``hits`` (start from 1, length; sorted) and ``n_hit``.

    ``n_hit`` counts the words that lie inside any occurrence of a test n-gram.
    """
    grams = stored(item_grams(items, item_col, item_text, window), "grams")
    return _mark(docs, grams, text_col, set_grams, most_hashes)


def is_contaminated(share: int = 20) -> Column:
    """At least one hit word, and hit words make one in ``share`` or more."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return mark_hits(docs, items, **options).where(~is_contaminated()).select(*docs.columns)


def remove_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """Documents with every hit word blanked out of their word sequence.

    Adds ``clean_words``: the document's words outside all hits, in order.
    """
    marked = mark_hits(docs, items, text_col=text_col, **options)
    outside = F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("word"), (i + 1).alias("at"))),
        lambda w: ~F.exists("hits", lambda h: (w["at"] >= h["start"]) & (w["at"] < h["start"] + h["length"])),
    )
    clean = F.when(F.size("hits") == 0, F.col("words")).otherwise(F.transform(outside, lambda w: w["word"]))
    return marked.withColumn("clean_words", clean).select(*docs.columns, "clean_words", "n_hit")


def contamination(
    docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", window: int = WINDOW, set_grams: int = SET_GRAMS, most_hashes: int = BROADCAST_HASHES,
) -> DataFrame:
    """One row per document: words, hit words, the items found, and the verdict.

    Only documents with hits go through the join that names the items.
    """
    grams = stored(item_grams(items, item_col, item_text, window), "grams")
    marked = _mark(docs, grams, text_col, set_grams, most_hashes)
    texts = F.array_distinct(F.transform("hits", lambda h: F.concat_ws(" ", F.slice("words", h["start"], h["length"]))))
    # The rows are written narrow: what both sides of the union read, and a fixed number for each.
    rows = stored(marked.select(
        F.monotonically_increasing_id().alias("__row"), F.col(doc_col), "n_words", "n_hit", texts.alias("grams")), "marked")
    named = rows.where(F.size("grams") > 0).select("__row", F.col(doc_col), "n_words", "n_hit", F.explode("grams").alias("gram"))
    width = F.length("gram") + F.aggregate("items", F.lit(0), lambda n, item: n + F.length(item) + 16)
    found = _verified(named, grams.select("gram", "items"), width).groupBy("__row").agg(
        F.first(doc_col).alias(doc_col), F.first("n_words").alias("n_words"), F.first("n_hit").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    clean = rows.where(F.size("grams") == 0).withColumn("items", F.expr("CAST(array() AS ARRAY<STRING>)"))
    columns = [F.col(doc_col), "n_words", "n_hit", "items"]
    return found.select(*columns).union(clean.select(*columns)).select(
        doc_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        is_contaminated().alias("contaminated"),
    )
