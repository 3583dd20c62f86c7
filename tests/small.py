"""A three-document collection with scores worked out in plain Python."""

import math
from collections import Counter

from trawl import build_index

DOCUMENTS = {
    "d1": "apple banana apple cherry",
    "d2": "banana cherry cherry date elder",
    "d3": "apple fig",
    "d4": "",
}
TOPICS = {1: "apple cherry", 2: "banana banana zebra", 3: "zebra"}


def make_index(spark, path, documents=DOCUMENTS, **settings):
    raw = spark.createDataFrame(list(documents.items()), "docno string, text string")
    return build_index(raw, path, settings.pop("stop_words", []), stem=False, **settings)


def make_topics(spark, topics=TOPICS):
    return spark.createDataFrame(list(topics.items()), "qid int, text string")


def dense_scores(documents=DOCUMENTS, topics=TOPICS):
    """``{(model, qid, docno): score}`` by the textbook sums over every topic term."""
    tfs = {d: Counter(t.split()) for d, t in documents.items()}
    lengths = {d: len(t.split()) for d, t in documents.items()}
    n, total = len(documents), sum(lengths.values())
    mean = total / n
    df = Counter(t for tf in tfs.values() for t in tf)
    ttf = sum(tfs.values(), Counter())
    scores = {}
    for qid, text in topics.items():
        query = {t: q for t, q in Counter(text.split()).items() if t in df}
        for d, tf in tfs.items():
            if not any(t in tf for t in query):
                continue
            dl = lengths[d]
            out = Counter()
            for t, q in query.items():
                okapi = tf[t] / (tf[t] + 0.5 + 1.5 * dl / mean)
                out["okapi_tf"] += q * okapi
                out["tf_idf"] += q * okapi * math.log(n / df[t])
                out["okapi_bm"] += (
                    math.log((n + 0.5) / (df[t] + 0.5))
                    * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * dl / mean))
                    * q * 101 / (q + 100)
                )
                out["laplace"] += q * math.log((tf[t] + 1) / (dl + len(df)))
                out["jm"] += q * math.log(0.5 * tf[t] / dl + 0.5 * ttf[t] / total)
            for model, score in out.items():
                scores[model, qid, d] = round(score, 6)
    return scores
