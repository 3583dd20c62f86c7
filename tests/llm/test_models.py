"""The trained operators: held-out accuracy, exact parts by brute force, defined cases."""

import math
import pathlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import language, pitman_yor, quality
from trawl.llm.common import fold

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "eng", "ürz", "ott"], "cc": ["дом", "кот", "лес", "мы"]}


def prose(lang, rng, n=60):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(1)
    rows = [(i, prose(lang := rng.choice(sorted(SYLLABLES)), rng), lang, 9.0, "x") for i in range(240)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, other string")


def test_language_of_held_out_texts(spoken):
    network = language.fit(spoken.where(fold("doc_id", 4) != 2))
    told = language.predict(spoken, network)
    assert told.columns == ["doc_id", "text", "lang", "other", "lang_pred", "score"]
    held = told.where(fold("doc_id", 4) == 2).collect()
    assert len(held) > 30 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)
    kept = language.keep_identified(spoken, network)
    assert kept.columns == spoken.columns and kept.count() >= 230


def test_language_defined_cases(spark, spoken):
    network = language.fit(spoken)
    texts = [None, "", "123 ... !", "ka" * 400_000, "ka", "ka"]
    rows = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(rows, network).collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3 and got[3][0] == "aa" and got[4] == got[5]
    assert language.predict(rows.limit(0), network).collect() == []
    unlabelled = language.fit(spoken.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.predict(rows, unlabelled).collect()} == {"und"}


def test_windows_hold_every_byte():
    data = bytes(range(1, 256)) * 5
    rows = language.as_windows(data)
    assert rows.tobytes().rstrip(b"\0") == data


def graded(n=200):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        lines = [prose("aa", rng, 9).capitalize() + "." if good or rng.random() < 0.3 else rng.choice(["BUY NOW!!! $$$ ", "aa aa aa aa "]) * 5 for _ in range(6)]
        rows.append((i, "\n".join(lines), 1.5))
        labels.append((i, int(good)))
    return rows, labels


def test_quality_of_held_out_texts(spark):
    rows, labels = graded()
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marked = spark.createDataFrame(labels, "doc_id long, quality int")
    field = quality.fit(docs, marked.where(fold("doc_id", 3) != 1))
    got = {r.doc_id: r.score for r in quality.score(docs, field).collect()}
    held = [(got[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(s >= 0.5) == y for s, y in held]) >= 0.95 and all(0 <= s <= 1 for s, _ in held)
    kept = quality.keep_good(docs, field)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)


def test_quality_defined_cases(spark):
    rows, labels = graded(60)
    field = quality.fit(spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, quality int"))
    texts = [None, "", "\n\n", "word " * 100_000, "a\n" * 50_000, "same", "same"]
    odd = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.score(odd, field).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[0] == got[1] and got[5] == got[6]
    assert quality.score(odd.limit(0), field).collect() == []
    alone = quality.fit(odd, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int"))
    assert {r.score for r in quality.score(odd, alone).collect()} == {1.0}


def test_scoring_works_on_little_text_at_once():
    """Six MB of text: neither its copies nor its features are held together."""
    import tracemalloc

    rng = np.random.default_rng(5)
    text = "\n".join(prose("aa", random.Random(6), 9) for _ in range(400))
    field = quality.LineField(rng.normal(size=(quality.N_FEATURES, 2)), np.zeros((2, 2)))
    network = language.train([prose(x, random.Random(7)).encode() for x in SYLLABLES] * 3, [*SYLLABLES] * 3, epochs=1)
    tables, n = network.pair_tables(), 6_000_000 // len(text)
    scorers = [lambda t: field.scores(x.encode() for x in t), lambda t: language.score_texts(network, t, n, tables)[1]]
    for scores, most in zip(scorers, (48, 24)):
        tracemalloc.start()
        got = scores(text[i:] + text[:i] for i in range(n))
        peak = tracemalloc.get_traced_memory()[1] / 2**20
        tracemalloc.stop()
        assert len(got) == n and peak < most


def test_marginals_are_sums_over_all_labellings():
    from itertools import product

    rng = np.random.default_rng(4)
    sizes, moves = np.array([3, 1, 4]), rng.normal(size=(2, 2))
    scores = rng.normal(size=(8, 2))
    got, _, total = quality.chain_sums(scores, moves, sizes)
    at, logs = 0, 0.0
    for n in sizes:
        own = scores[at : at + n]
        weights = {y: math.exp(sum(own[i, s] for i, s in enumerate(y)) + sum(moves[a, b] for a, b in zip(y, y[1:]))) for y in product((0, 1), repeat=int(n))}
        z = sum(weights.values())
        logs += math.log(z)
        for i in range(n):
            assert got[at + i, 1] == pytest.approx(sum(w for y, w in weights.items() if y[i]) / z)
        at += n
    assert total == pytest.approx(logs)


def chained(n=300):
    """Texts in which the ending of a word tells much about the next one."""
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "ptkm" for b in ("an", "or", "il", "us")]
    rows = []
    for i in range(n):
        text, at = [], "pan"
        for _ in range(40):
            at = rng.choice([w for w in words if (w[0] == at[-1].replace("n", "p").replace("r", "t").replace("l", "k").replace("s", "m")) or rng.random() < 0.05])
            text.append(at)
        rows.append((i, " ".join(text) + (f" rare{i}" if i % 7 == 0 else ""), "x"))
    return rows + [(n, None, ""), (n + 1, "", ""), (n + 2, "PAN\tpan\x0bPan", ""), (n + 3, "pan " * 20_000, "")]


def test_language_model_counts_and_gains(spark):
    rows = chained()
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in pitman_yor.fit_and_score(docs, fold("doc_id", 5) != 1).collect()}
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t, _ in rows}
    held = {i for i in tokens if zlib.crc32(str(i).encode()) % 5 == 1}
    counts = Counter(w for i, ws in tokens.items() if i not in held for w in ws)
    total = sum(counts.values())
    gains = []
    for i, ws in tokens.items():
        r = got[i]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(ws), sum(counts[w] > 0 for w in ws), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
        if i in held and i < 300:
            gains.append(r.score - base)
    assert len(gains) > 30 and np.mean(gains) > 5


def test_language_model_does_not_depend_on_partitions(spark):
    docs = spark.createDataFrame(chained(60), "doc_id long, text string, score string")
    one, many = ({r.doc_id: r.score for r in pitman_yor.fit_and_score(docs.repartition(n), fold("doc_id", 5) != 1).collect()} for n in (1, 7))
    assert one == pytest.approx(many, rel=1e-5)


def test_pairs_of_words_are_shuffled_to_their_words_alone(spark):
    """Totals of contexts are joined to bare words, not to rows with all their pairs."""
    docs = spark.createDataFrame(chained(30), "doc_id long, text string, score string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pitman_yor.fit_and_score(docs, F.lit(True))._jdf.queryExecution()
        text = plan.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    moved = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((\w+)#", text)
    assert sum("excess" in columns for columns, key in moved if key == "word") == 1
    assert any(key == "own" for _, key in moved) and not any("excess" in columns for columns, key in moved if key == "own")


def test_pairs_seen_once_are_not_sent_by_name(spark, monkeypatch):
    """They reach their words and contexts as numbers; each other pair is passed on by one chunk."""
    rows = [(i, t, learn) for i, (t, learn) in enumerate([
        ("a b a b c", True), ("a b d only", True), ("c a b", False), ("d c", True), ("x a", False), (None, True), ("a b a b c", True)])]
    seen = []
    seat = pitman_yor.seat_words
    monkeypatch.setattr(pitman_yor, "seat_words", lambda words, sweeps, loners: seen.append((words.collect(), loners)) or seat(words, sweeps, loners))
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3, "doc_id")
    pitman_yor.fit_and_score(docs, F.col("learn"))
    pairs = Counter()
    for _, text, learn in rows:
        words = [b"", *(text or "").encode().split(), b""]
        pairs.update(zip(words[1:], words) if learn else ())
    (words, loners), got = seen[0], {}
    for r in words:
        for context, n in zip(np.frombuffer(r.contexts, "<u8"), np.frombuffer(r.counts, "<u8")):
            got[bytes(r.word), int(context)] = got.get((bytes(r.word), int(context)), 0) + int(n)
    assert got == {(w, pitman_yor.context_id(u)): n for (w, u), n in pairs.items() if n > 1}
    alone = int(loners.sum())
    assert alone == 1 and b"only" not in {bytes(r.word) for r in words}
    assert sum(int(np.frombuffer(r.singles, "<u8").sum()) for r in words) + alone == sum(n == 1 for n in pairs.values())
    assert {bytes(r.word): r.after for r in words} == {w: sum(n == 1 and u == w for (_, u), n in pairs.items()) for w in {w for w, _ in pairs} - {b"only"}}


def test_tables_that_are_used_up_are_deleted(spark):
    folder = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    docs = spark.createDataFrame(chained(30), "doc_id long, text string, score string")
    pitman_yor.fit_and_score(docs, fold("doc_id", 5) != 1).collect()
    left = [x for x in set(folder.iterdir()) - before if any(x.rglob("*.parquet"))]
    assert sorted(x.name.split("-")[0] for x in left) == ["chunks", "codes", "totals", "words"]


def test_sealed_rows_come_back():
    import pyarrow as pa

    table = pa.table({"n": [3, -1, 1 << 40], "word": pa.array([b"a", b"", b"xyz"], pa.binary()), "asked": pitman_yor.cells(np.arange(5, dtype="<u2"), np.array([0, 4, 1]))})
    assert pitman_yor.opened(pitman_yor.sealed(table)).equals(table)
    assert pitman_yor.opened(pitman_yor.sealed(table.slice(1, 2))).equals(table.slice(1, 2))


def test_language_model_without_training_rows_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "")], "doc_id long, text string, score string")
    row = pitman_yor.fit_and_score(docs, F.lit(False)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)
    assert pitman_yor.fit_and_score(docs.limit(0), F.lit(True)).collect() == []


def test_probabilities_of_a_context_sum_to_one():
    """All known words and the unknown one, after any context, by the model's own parts."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    words = [b"", b"xa", b"ya", b"b", b"zzz"]
    contexts = np.unique([pitman_yor.context_of(w) for w in words])
    counts = rng.integers(0, 30, (len(words), len(contexts)))
    counts[:, 0] += 1
    kept = [np.flatnonzero(c) for c in counts]
    batch = pa.RecordBatch.from_arrays([
        pa.array(words, pa.binary()), pa.array(counts.sum(1)),
        pitman_yor.cells(np.concatenate([contexts[k] for k in kept]).astype("<u2"), np.array([len(k) for k in kept])),
        pitman_yor.cells(np.concatenate([c[k] for c, k in zip(counts, kept)]).astype("<u8"), np.array([len(k) for k in kept])),
    ], ["word", "c", "contexts", "counts"])
    customers = np.zeros(pitman_yor.CONTEXTS)
    customers[contexts] = counts.sum(0)
    model = pitman_yor.Model((0.7, 0.6, 0.5), customers, len(words), [])
    for _ in range(4):
        sums = np.zeros(pitman_yor.CONTEXTS + pitman_yor.PARENTS)
        for out in pitman_yor._sum_tables(model)(iter([batch])):
            sums[out.column("key").to_numpy()] += out.column("n").to_numpy()
        model.sweeps.append(pitman_yor.Totals(sums[: pitman_yor.CONTEXTS], sums[pitman_yor.CONTEXTS :]))
    told = next(pitman_yor._predict(model)(iter([batch])))
    asked = np.append(contexts, 77)  # and a context never seen
    rows = pa.RecordBatch.from_arrays(
        [pa.array([0] * len(words)), pa.array(range(len(words))), pitman_yor.cells(np.tile(asked, len(words)).astype("<u2"), np.full(len(words), len(asked)))]
        + [told.column(c) for c in ("c", "contexts", "log_p", "parents", "parent_p", "root_p")],
        ["chunk", "place", "asked", "c", "contexts", "log_p", "parents", "parent_p", "root_p"])
    answers = next(pitman_yor._answer(model)(iter([rows])))
    p = 10 ** pitman_yor.flat(answers.column("log_p"), "<f4")[0].reshape(len(words), len(asked)).astype(float)
    assert p.sum(0) + model.unseen(asked) == pytest.approx(np.ones(len(asked)), abs=1e-5)


def test_contexts_are_whole_words_not_their_endings(spark):
    """``nation`` and ``lion`` end alike, but different words follow them."""
    rows = [(i, "nation alpha" if i % 2 else "lion omega", True) for i in range(200)]
    rows += [(1000, "nation alpha", False), (1001, "nation omega", False), (1002, "lion alpha", False), (1003, "lion omega", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    score = {r.doc_id: r.score for r in pitman_yor.fit_and_score(docs, F.col("learn")).collect()}
    assert score[1000] - score[1001] > 1.5 and score[1003] - score[1002] > 1.5
    assert abs(score[1000] - score[1003]) < 0.1


def test_seated_words_sum_to_one_after_every_context(spark):
    """Customers less discounts and what goes to the parent, over all words of a context."""
    import pyarrow as pa

    draw = np.random.default_rng(3)
    words = [b"", b"xon", b"yon", b"b", b"zzz"]
    ids = np.sort(np.array([pitman_yor.context_id(w) for w in words], dtype="<u8"))
    counts = draw.integers(1, 40, (5, 5)) * draw.integers(0, 2, (5, 5)) + np.eye(5, dtype=int)
    kept = [np.flatnonzero(c) for c in counts]
    rows = [(w, ids[k].tobytes(), c[k].astype("<u8").tobytes(), int(c.sum())) for w, c, k in zip(words, counts, kept)]
    table = spark.createDataFrame([tuple(bytearray(v) if isinstance(v, bytes) else v for v in r) for r in rows], pitman_yor.UPPER_COLUMNS)
    seated, totals, discount = pitman_yor.seat_words(table)
    held, total = np.zeros(5), {r.own: r.total for r in totals.collect()}
    tables = np.zeros(5)
    for r in seated.collect():
        at = np.searchsorted(ids, np.frombuffer(r.contexts, "<u8"))
        held[at] += np.frombuffer(r.excess, "<f4")
        n, t = np.frombuffer(r.counts, "<u8"), np.frombuffer(r.tables, "<u8")
        assert (t >= 1).all() and (t <= n).all() and (t[n == 1] == 1).all()
        tables[at] += 1
    for i, own in enumerate(ids.view("<i8")):
        assert total[own] >= tables[i]
        assert held[i] + discount * total[own] == pytest.approx(counts.sum(0)[i], rel=1e-5)
