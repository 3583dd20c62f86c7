"""Ranked lexical search of all documents for each item, over trees of document vectors.

A document is kept as the frequencies of those of its terms that some item asks for, and
its number of terms. Tasks put these vectors, terms in the order of falling document
frequency, into a trie: documents that begin with the same frequent terms share a path.
Every node holds its term, the run of documents below it (the documents are sorted by
path), the largest frequency of its term below it and the smallest length norm m below it.
From the last two comes an upper bound of what the term adds to any document below.

For an item only the nodes of its terms count; lists of the nodes of each term lead to
them. The bounds along the path of a document sum up to a bound of its score. The k best
bounds are scored exactly first and set the bar; then the trie is searched depth first: a
node with no bound below it that reaches the bar is left out with all below it, every
other document is scored exactly and may raise the bar. Equal scores count as reaching
the bar, so ties are decided by id alone. The bar goes on from tree to tree of a task.

Documents with equal vectors and norms share one place in the tree. Of these only the k
smallest ids can be among the k best of any item, so a group of copies costs k ids.

Items are taken in blocks of a bounded number of terms; a block's terms and weights are
what tasks and driver hold. Every block reads the documents once.

Defined cases: rows of one item id (the null id too) are one item; null and empty texts
have no terms; documents without terms count nowhere and are never returned; an item
without a matching document has no row; null ids come last among equal scores; repeated
documents are ranked apart; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import stored

# Term entries of the items of one block, by a hash of the item.
BLOCK_ENTRIES = 500_000
# A tree closes at so many documents or vector entries.
TREE_DOCS = 20_000
TREE_ENTRIES = 2_000_000
# Parts of the length norm m = 100 - PIVOT + PIVOT * length / mean length.
PIVOT = 25

_separators = [b for b in range(128) if not chr(b).isalnum()]
_table = bytearray(range(256))
for _b in _separators:
    _table[_b] = 32
for _b in range(ord("A"), ord("Z") + 1):
    _table[_b] = _b + 32
TABLE = bytes(_table)


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all other characters, A-Z lower-cased."""
    return (text or b"").translate(TABLE).split()


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    for value in batch.column("text").cast(pa.binary()):
        yield value.as_py()


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, asked``: how often each item holds each of its terms."""

    def run(batches):
        for batch in batches:
            ids = batch.column("item_id")
            for i, text in enumerate(_texts(batch)):
                counts = Counter(terms_of(text))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([i] * len(counts), pa.int64())), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                    ["item_id", "term", "asked"],
                )

    schema = T.StructType([items.schema["item_id"], T.StructField("term", T.BinaryType()), T.StructField("asked", T.LongType())])
    entries = items.select("item_id", "text").mapInArrow(run, schema)
    return entries.groupBy("item_id", "term").agg(F.sum("asked").alias("asked"))


def restricted_vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of documents with a term; terms are places in ``vocabulary``."""
    places = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        place = {term: i for i, term in enumerate(places.value)}.get
        for batch in batches:
            kept, n, ends, terms, tfs = [], [], [0], [], []
            for i, text in enumerate(_texts(batch)):
                words = terms_of(text)
                if words:
                    counts = Counter(map(place, words))
                    counts.pop(None, None)
                    terms.extend(counts)
                    tfs.extend(counts.values())
                    kept.append(i)
                    n.append(len(words))
                    ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(kept, pa.int64())), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
            ], ["doc_id", "n", "terms", "tfs"])

    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType())),
    ])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def _gather(starts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of rows taken in ``order``, and the new starts."""
    lengths = np.diff(starts)[order]
    new = _starts(lengths)
    return np.arange(new[-1]) + np.repeat(starts[:-1][order] - new[:-1], lengths), new


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds per unit of weight: rises with ``tf``, falls with ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Tree:
    """The trie of some documents' vectors, as arrays over its nodes."""

    def __init__(self, ids: list, m: np.ndarray, starts: np.ndarray, ranks: np.ndarray, tfs: np.ndarray, n_terms: int, k: int) -> None:
        """Entries of document i are those from ``starts[i]``; ``ranks`` are places by falling frequency."""
        owner = np.repeat(np.arange(len(ids)), np.diff(starts))
        by_rank = np.lexsort((ranks, owner))
        ranks, tfs = ranks[by_rank], tfs[by_rank]
        paths, counts = ranks.astype(">u4").tobytes(), tfs.astype("<i8").tobytes()
        cuts = starts.tolist()
        groups: dict[tuple, list] = {}
        for i, norm in enumerate(m.tolist()):
            a, b = cuts[i], cuts[i + 1]
            if a < b:
                groups.setdefault((paths[4 * a : 4 * b], norm, counts[8 * a : 8 * b]), []).append(i)
        keys = sorted(groups)
        first = np.array([groups[key][0] for key in keys], dtype=np.int64)
        self.ids = [sorted((ids[i] is None, ids[i]) if ids[i] is not None else (True, 0) for i in groups[key])[:k] for key in keys]
        self.m = m[first]
        taken, self.starts = _gather(starts, first)
        self.ranks, self.tfs = ranks[taken], tfs[taken]
        self.size = len(first)
        self._make_nodes(n_terms)

    def _make_nodes(self, n_terms: int) -> None:
        lengths = np.diff(self.starts)
        doc = np.repeat(np.arange(self.size), lengths)
        depth = np.arange(len(doc)) - self.starts[:-1][doc]
        # An entry opens a node where the path differs from that of the document before.
        before = np.maximum(self.starts[:-1][np.maximum(doc - 1, 0)] + depth, 0)
        inside = (doc > 0) & (depth < np.concatenate([[0], lengths[:-1]])[doc])
        same = inside & (self.ranks[np.where(inside, before, 0)] == self.ranks) if len(doc) else inside
        shared = np.where(same, np.iinfo(np.int64).max, depth)
        common = np.minimum.reduceat(shared, self.starts[:-1]) if len(doc) else shared
        opens = depth >= common[doc]
        by_depth = np.argsort(depth, kind="stable")
        at = np.flatnonzero(opens[by_depth])
        if not len(at):
            at = np.zeros(0, dtype=np.int64)
            term = at
            self.low = self.high = self.gain = at
        else:
            term = self.ranks[by_depth][at]
            low = doc[by_depth]
            self.low, self.high = low[at], low[np.concatenate([at[1:], [len(low)]]) - 1] + 1
            self.gain = gain(np.maximum.reduceat(self.tfs[by_depth], at), np.minimum.reduceat(self.m[low], at))
        # Nodes of one term lie together, in the order of their documents.
        order = np.lexsort((self.low, term))
        self.low, self.high, self.gain = self.low[order], self.high[order], self.gain[order]
        self.links = np.searchsorted(term[order], np.arange(n_terms + 1))

    def score(self, doc: int, ranks: np.ndarray, weights: np.ndarray) -> int:
        a, b = self.starts[doc], self.starts[doc + 1]
        own = self.ranks[a:b]
        at = np.minimum(np.searchsorted(own, ranks), b - a - 1)
        held = own[at] == ranks
        return int((weights[held] * gain(self.tfs[a:b][at[held]], self.m[doc])).sum())

    def search(self, ranks: np.ndarray, weights: np.ndarray, best: list, k: int) -> list:
        """``best`` (-score, id) with the documents of this tree that belong among the first ``k``.

        ``ranks`` rise.
        """
        spans = [(self.links[r], self.links[r + 1]) for r in ranks]
        nodes = np.concatenate([np.arange(a, b) for a, b in spans])
        if not len(nodes):
            return best
        low, high = self.low[nodes], self.high[nodes]
        added = (self.gain[nodes] * np.repeat(weights, [b - a for a, b in spans])).astype(np.float64)
        # Sums of integers far below 2**53: exact.
        steps = np.bincount(low, added, self.size + 1) - np.bincount(high, added, self.size + 1)
        bound = np.cumsum(steps)[: self.size].astype(np.int64)
        seen: set[int] = set()

        def take(docs) -> int:
            """Score ``docs``; the bar that a further document has to reach."""
            nonlocal best
            for doc in docs:
                if doc not in seen:
                    seen.add(doc)
                    if (got := self.score(doc, ranks, weights)) > 0:
                        best += [(-got, id) for id in self.ids[doc]]
            best = sorted(best)[:k]
            return max(-best[-1][0], 1) if len(best) == k else 1

        bar = take(np.argpartition(bound, -k)[-k:].tolist() if self.size > k else range(self.size))
        reach = np.concatenate([[0], np.cumsum(bound >= bar)])
        open_ = np.flatnonzero(reach[high] > reach[low])
        # Preorder: by the first document, the wider run first.
        open_ = open_[np.lexsort((-high[open_], low[open_]))]
        low, high = low[open_].tolist(), high[open_].tolist()
        skip = np.searchsorted(low, high).tolist()
        node = at = 0
        while at < self.size:
            # Documents up to the next node hang on the nodes that are open here.
            upto = low[node] if node < len(low) else self.size
            if upto > at and reach[upto] > reach[at]:
                bar = take((at + np.flatnonzero(bound[at:upto] >= bar)).tolist())
            if node == len(low):
                break
            if int(bound[low[node] : high[node]].max()) < bar:
                at, node = max(at, high[node]), max(skip[node], node + 1)
            else:
                at, node = max(at, low[node]), node + 1
        return best


def search_block(vectors: DataFrame, asked: list[list[tuple[int, int]]], id_type: T.DataType, k: int) -> DataFrame | None:
    """``item`` (place in ``asked``), ``doc_id``, ``score``: each task's ``k`` best for each item."""
    totals = vectors.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    if not totals.docs:
        return None
    docs, length = int(totals.docs), int(totals.length)
    df = {r.term: r["count"] for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    falling = sorted(df, key=lambda t: (-df[t], t))
    rank_of = np.full(1 + max([-1, *(t for terms in asked for t, _ in terms), *falling]), -1, dtype=np.int64)
    rank_of[falling] = np.arange(len(falling))
    weight = {t: math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for t, n in df.items()}
    queries = []
    for terms in asked:
        found = sorted((int(rank_of[t]), weight[t] * times) for t, times in terms if t in df and weight[t] > 0)
        queries.append((np.array([r for r, _ in found], dtype=np.int64), np.array([w for _, w in found], dtype=np.int64)))
    held = vectors.sparkSession.sparkContext.broadcast((queries, rank_of, len(falling)))
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])

    def run(batches):
        queries, rank_of, n_terms = held.value
        best: list[list] = [[] for _ in queries]
        ids, n, sizes, terms, tfs, entries = [], [], [], [], [], 0
        arrow_id = None

        def close() -> None:
            nonlocal ids, n, sizes, terms, tfs, entries
            norms = 100 - PIVOT + np.array([(PIVOT * x * docs) // length for x in n], dtype=np.int64)
            tree = Tree(ids, norms, _starts(np.concatenate(sizes)), rank_of[np.concatenate(terms)], np.concatenate(tfs), n_terms, k)
            for i, (ranks, weights) in enumerate(queries):
                if len(ranks):
                    best[i] = tree.search(ranks, weights, best[i], k)
            ids, n, sizes, terms, tfs, entries = [], [], [], [], [], 0

        for batch in batches:
            arrow_id = batch.column("doc_id").type
            for part in (batch.slice(i, TREE_DOCS) for i in range(0, len(batch), TREE_DOCS)):
                lists = part.column("terms")
                if len(ids) + len(part) > TREE_DOCS or entries > TREE_ENTRIES:
                    if ids:
                        close()
                ids += part.column("doc_id").to_pylist()
                n += part.column("n").to_pylist()
                sizes.append(np.diff(lists.offsets.to_numpy()))
                terms.append(lists.flatten().to_numpy())
                tfs.append(part.column("tfs").flatten().to_numpy())
                entries += len(terms[-1])
        if ids:
            close()
        rows = [(i, None if id[0] else id[1], -score) for i, found in enumerate(best) for score, id in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], arrow_id), pa.array([r[2] for r in rows], pa.int64())],
                ["item", "doc_id", "score"],
            )

    return vectors.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    entries = stored(item_terms(items), "item-terms")
    blocks = max(1, -(-entries.count() // BLOCK_ENTRIES))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    out = None
    for i in range(blocks):
        terms: dict[bytes, int] = {}
        asked: dict = {}
        for r in entries.where(block == i).collect():
            asked.setdefault(r.item_id, []).append((terms.setdefault(bytes(r.term), len(terms)), r.asked))
        if not terms:
            continue
        vectors = stored(restricted_vectors(docs, list(terms)), "vectors")
        found = search_block(vectors, list(asked.values()), docs.schema["doc_id"].dataType, k)
        if found is None:
            break
        names = spark.createDataFrame(list(enumerate(asked)), T.StructType([T.StructField("item", T.LongType()), items.schema["item_id"]]))
        best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
        top = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = top if out is None else out.unionByName(top)
    if out is None:
        empty = T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())])
        return spark.createDataFrame([], empty)
    return out
