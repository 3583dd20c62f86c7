"""The registered queries as SQL over the given tables.

Written apart from the Spark jobs where that gives an independent check: scores are the
dense sums over every topic term, cleaning uses character-class patterns, stems are
built per distinct word by nested cases and joined to the words.
"""

from __future__ import annotations

from trawl.functions.cleaning import TOPIC_PREAMBLES
from trawl.functions.stemming import STEP_2, STEP_3, STEP_4
from trawl.operators.features import FEATURES
from workload.fixtures import MARKS, POOL_DEPTH, SEED, STOP_WORDS
from workload.learner_sql import forest_sql, line_sql
from workload.queries import BROWSE_SIZE, SHALLOW_K, SMALL_FORESTS
from trawl.plans.retrieval import TOP_K


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_STOP = ", ".join(_quoted(w) for w in STOP_WORDS)
_DOCNO = "'AP' || lpad(doc_id::varchar, 11, '0')"
_WORD = r"[\p{L}\p{N}\p{M}_]+(?:[''’][\p{L}\p{N}\p{M}_]+)*"


def _words(text: str) -> str:
    return (
        rf"list_filter(regexp_extract_all(lower({text}), '{_WORD}'),"
        r" lambda w: regexp_matches(w, '[\p{L}\p{N}]'))"
    )


# --- cleaning ---------------------------------------------------------------------


def _without_stop_words(text: str) -> str:
    squeezed = rf"trim(regexp_replace({text}, '[ \t\n\x0b\f\r]+', ' ', 'g'))"
    return (
        f"array_to_string([CASE WHEN t IN ({_STOP}) THEN '' ELSE t END "
        f"FOR t IN string_split({squeezed}, ' ')], ' ')"
    )


def _clean_document(text: str) -> str:
    return (
        f"replace(regexp_replace(lower({_without_stop_words(text)}), "
        rf"'[!-&(-,./:-@\[-^`{{-~]', ' ', 'g'), '  ', ' ')"
    )


def _clean_topic(text: str) -> str:
    for phrase in TOPIC_PREAMBLES:
        text = f"replace({text}, {_quoted(phrase)}, '')"
    bare = rf"regexp_replace({text}, '[!-,./:-@\[-^`{{-~]', ' ', 'g')"
    return f"lower(replace({_without_stop_words(bare)}, '  ', ' '))"


# --- words of several scripts -----------------------------------------------------


def _replaced(text: str, pairs: tuple) -> str:
    for old, new in pairs:
        text = f"replace({text}, {_quoted(old)}, {_quoted(new)})"
    return text


_MARKED = _replaced("translate(lower(text), 'aeo', '123')", ((" 1", ".1"), (" 2", ",2"), (" t", ":t"), (" s", ".s"), (" 3", "\u066b3")))
_ATTACHED = _replaced("lower(text)", (("a", "a\u0301"), (" b", "\u0301b"), ("e ", "e\u200d "), ("n", "n\u00ad"), ("o", "オ\u3099")))
# Character by character: a class for each, then whether it is inside a word, then whether
# it opens one. Kinds: R run of letters and digits, K Katakana, S south-east Asian, I single.
_SEGMENTS = f"""
WITH texts AS (
  SELECT {_DOCNO} AS docno, lower(CASE doc_id % 6
    WHEN 1 THEN translate(lower(text), 'aeioutsn', '日本語中文のとカ')
    WHEN 2 THEN translate(lower(text), 'aeioustnr', 'アイウエオストンー')
    WHEN 3 THEN translate(lower(text), 'aeiourst', 'กขคงจ\u0e31\u0e34\u0e48')
    WHEN 4 THEN {_MARKED} WHEN 5 THEN {_ATTACHED}
    ELSE text || {_quoted(MARKS)} END) AS t FROM documents),
chars AS (SELECT docno, unnest(cs) AS c, unnest(range(len(cs))) AS i
  FROM (SELECT docno, regexp_extract_all(t, '(?s).') AS cs FROM texts)),
classes AS (SELECT c, CASE
    WHEN regexp_matches(c, '[\\p{{Han}}\\p{{Hiragana}}]') THEN 'I'
    WHEN regexp_matches(c, '[\\p{{Katakana}}ー]') THEN 'K'
    WHEN regexp_matches(c, '[\\p{{Thai}}\\p{{Lao}}\\p{{Khmer}}\\p{{Myanmar}}]') AND regexp_matches(c, '[\\p{{L}}\\p{{M}}]') THEN 'S'
    WHEN regexp_matches(c, '\\p{{M}}') THEN 'M'
    WHEN regexp_matches(c, '\\p{{Cf}}') THEN 'F'
    WHEN regexp_matches(c, '\\p{{L}}') THEN 'L'
    WHEN regexp_matches(c, '\\p{{Nd}}') THEN 'D'
    WHEN regexp_matches(c, '[\\p{{N}}\\p{{Pc}}]') THEN 'E'
    WHEN c IN (chr(39), '’') THEN 'Q' WHEN c = '.' THEN 'B' WHEN c IN (':', '·') THEN 'A'
    WHEN c IN (',', ';', '\u066b') THEN 'C' ELSE 'O' END AS k
  FROM (SELECT DISTINCT c FROM chars)),
bases AS (SELECT docno, c, i, k, lag(k) OVER w AS before, lead(k) OVER w AS after,
    last_value(CASE WHEN k NOT IN ('M', 'F') THEN k END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base
  FROM chars JOIN classes USING (c) WINDOW w AS (PARTITION BY docno ORDER BY i)),
inside AS (SELECT docno, c, i, k, CASE
    WHEN k IN ('I', 'K', 'S') THEN k
    WHEN k IN ('L', 'D', 'E') THEN 'R'
    WHEN k = 'M' AND base IN ('I', 'K', 'S') THEN base
    WHEN k = 'M' THEN 'R'
    WHEN k = 'F' AND before IN ('I', 'K', 'S') THEN before
    WHEN k = 'F' AND before IN ('L', 'D', 'E') THEN 'R'
    WHEN k = 'F' AND before = 'M' THEN CASE WHEN base IN ('I', 'K', 'S') THEN base ELSE 'R' END
    WHEN before IN ('I', 'K', 'S') OR (before IN ('M', 'F') AND base IN ('I', 'K', 'S'))
      OR (before = 'F' AND base NOT IN ('L', 'D', 'E')) THEN NULL
    WHEN k = 'Q' AND before IN ('L', 'D', 'E', 'M', 'F') AND after IN ('L', 'D', 'E', 'M') THEN 'R'
    WHEN k IN ('A', 'B') AND before IN ('L', 'M', 'F') AND after = 'L' THEN 'R'
    WHEN k IN ('C', 'B') AND before = 'D' AND after = 'D' THEN 'R' END AS kind
  FROM bases),
opened AS (SELECT docno, c, i, kind, sum(CASE WHEN k = 'I' OR kind IS DISTINCT FROM last THEN 1 ELSE 0 END)
    OVER (PARTITION BY docno ORDER BY i) AS word_no
  FROM (SELECT *, lag(kind) OVER (PARTITION BY docno ORDER BY i) AS last FROM inside)),
found AS (SELECT docno, word_no, string_agg(c, '' ORDER BY i) AS word FROM opened WHERE kind IS NOT NULL GROUP BY ALL)
SELECT docno, (row_number() OVER (PARTITION BY docno ORDER BY word_no) - 1)::int AS pos, word
FROM found WHERE regexp_matches(word, '[\\p{{L}}\\p{{N}}]')
"""

# --- stemming ---------------------------------------------------------------------

_OVER_0 = "^[^aeiouy]*[aeiouy]+[^aeiouy]"
_OVER_1 = "^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]"
_SHORT = "[^aeiouy][aeiouy][^aeiouywxY]$"


def _has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{pattern}')"


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _longest_suffix(rules: dict[str, str], measure: str) -> str:
    """A case per suffix, longest first; a failed measure ends the search."""
    cases = []
    for suffix in sorted(rules, key=len, reverse=True):
        base = _cut(len(suffix))
        cases.append(
            f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {_has(base, measure)} "
            f"THEN {base} || '{rules[suffix]}' ELSE w END"
        )
    return "CASE " + " ".join(cases) + " ELSE w END"


def _step_4() -> str:
    """``ion`` goes only after s or t, which then belongs to the base."""
    plain = {s: "" for s in STEP_4} | {"sion": "s", "tion": "t"}
    cases = []
    for suffix in sorted(plain, key=len, reverse=True):
        kept = len(suffix) - len(plain[suffix])
        cases.append(
            f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {_has(_cut(kept), _OVER_1)} "
            f"THEN {_cut(kept)} ELSE w END"
        )
    return "CASE " + " ".join(cases) + " ELSE w END"


_STEM_STEPS = [
    "CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN " + _cut(2)
    + " WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN " + _cut(1)
    + " ELSE w END",
    f"CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {_has(_cut(3), _OVER_0)} THEN {_cut(1)}"
    f" ELSE w END WHEN ends_with(w, 'ed') AND {_has(_cut(2), '[aeiouy]')} THEN {_cut(2)}"
    f" || '#' WHEN ends_with(w, 'ing') AND {_has(_cut(3), '[aeiouy]')} THEN {_cut(3)}"
    " || '#' ELSE w END",
    "CASE WHEN NOT ends_with(w, '#') THEN w"
    f" WHEN {_has(_cut(1), '(at|bl|iz)$')} THEN {_cut(1)} || 'e'"
    f" WHEN length(w) > 2 AND w[-2] = w[-3] AND {_has(_cut(1), '[^aeiouylsz]$')}"
    f" THEN {_cut(2)}"
    f" WHEN {_has(_cut(1), _OVER_0)} AND NOT {_has(_cut(1), _OVER_1)}"
    f" AND {_has(_cut(1), _SHORT)} THEN {_cut(1)} || 'e' ELSE {_cut(1)} END",
    f"CASE WHEN lower(w[-1]) = 'y' AND {_has(_cut(1), '[aeiouy]')}"
    f" THEN {_cut(1)} || 'i' ELSE w END",
    _longest_suffix(STEP_2, _OVER_0),
    _longest_suffix(STEP_3, _OVER_0),
    _step_4(),
    f"CASE WHEN ends_with(w, 'e') AND ({_has(_cut(1), _OVER_1)} OR ("
    f"{_has(_cut(1), _OVER_0)} AND NOT {_has(_cut(1), _SHORT)})) THEN {_cut(1)}"
    " ELSE w END",
    f"CASE WHEN ends_with(w, 'll') AND {_has('w', _OVER_1)} THEN {_cut(1)} ELSE w END",
]


def _stems() -> str:
    """Nested selects, one per step, over the distinct words."""
    inner = (
        "SELECT DISTINCT word, replace(regexp_replace(word, '(^|[aeiou])y', '\\1Y', 'g'),"
        " 'yy', 'yY') AS w FROM bare_words"
    )
    for step in _STEM_STEPS:
        inner = f"SELECT word, {step} AS w FROM ({inner})"
    return (
        "SELECT word, CASE WHEN length(word) < 3 THEN word ELSE lower(w) END AS stem "
        f"FROM ({inner})"
    )


# --- building blocks ---------------------------------------------------------------


def _bare(word: str) -> str:
    return f"regexp_replace({word}, '[''’]s$', '')"


def _ranked(scores: str, k: int, group: str = "qid") -> str:
    """Cut at k by the rounded score, drop what is zero unrounded, rank again."""
    return f"""
SELECT * EXCLUDE (cut, raw), row_number() OVER (
         PARTITION BY {group} ORDER BY score DESC, docno)::bigint AS rank
FROM (SELECT *, row_number() OVER (
               PARTITION BY {group} ORDER BY score DESC, docno) AS cut
      FROM ({scores}))
WHERE cut <= {k} AND raw <> 0"""


_OKAPI = "tf / (tf + 0.5::double + 1.5::double * dl / avg_dl)"
_MODEL_SQL = {
    "okapi_tf": f"sum(qtf * {_OKAPI})",
    "tf_idf": f"sum(qtf * {_OKAPI} * ln(n_docs::double / df))",
    "okapi_bm": (
        "sum(ln((n_docs + 0.5::double) / (df + 0.5::double))"
        " * tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * dl / avg_dl))"
        " * qtf * 101::double / (qtf + 100::double))"
    ),
    "laplace": "sum(qtf * ln((tf + 1::double) / (dl + vocab)))",
    "jm": "sum(qtf * ln(0.5::double * tf / dl + 0.5::double * ttf / sum_dl))",
    "damped": (
        "sum(qtf * ln(1::double + tf) / sqrt(dl::double) * ln(1::double + n_docs::double / df))"
    ),
    "tiny": "sum(tf / 1e9::double)",
}


def _scores(model: str) -> str:
    digits = 12 if model == "tiny" else 6
    return (
        f"SELECT qid, docno, {_MODEL_SQL[model]} AS raw, round(raw, {digits}) AS score "
        "FROM dense GROUP BY qid, docno"
    )


_MODELS = [m for m in _MODEL_SQL if m not in ("damped", "tiny")]
_ALL_SCORES = " UNION ALL ".join(
    f"SELECT '{m}' AS model, * FROM ({_scores(m)})" for m in _MODELS
)

_PREAMBLE = "[" + ", ".join(_quoted(p) for p in TOPIC_PREAMBLES) + "][item_id % 5 + 1]"

_VIEWS: dict[str, tuple[list[str], str]] = {
    "docs": (
        [],
        f"SELECT {_DOCNO} AS docno, {_clean_document('marked')} AS text FROM (SELECT doc_id,"
        f" CASE WHEN doc_id % 3 = 0 THEN text || {_quoted(MARKS)} ELSE text END AS marked FROM documents)",
    ),
    "lengths": (
        ["docs"],
        r"SELECT docno, text, len(regexp_extract_all(text, '\S+'))::bigint AS dl FROM docs",
    ),
    "topics": ([], f"SELECT item_id::integer AS qid, {_clean_topic('text')} AS text FROM benchmark"),
    "doc_words": (
        ["docs"],
        f"SELECT docno, {_bare('word')} AS word, pos FROM (SELECT docno, unnest(l) AS word,"
        f" generate_subscripts(l, 1) - 1 AS pos FROM (SELECT docno,"
        f" {_words('text')} AS l FROM docs))",
    ),
    "topic_words": (
        ["topics"],
        f"SELECT qid, {_bare('word')} AS word FROM (SELECT qid,"
        f" unnest({_words('text')}) AS word FROM topics)",
    ),
    "bare_words": (
        ["doc_words", "topic_words"],
        "SELECT word FROM doc_words UNION SELECT word FROM topic_words",
    ),
    "stems": (["bare_words"], _stems()),
    "postings": (
        ["doc_words", "stems"],
        f"SELECT docno, stem AS term, count(*) AS tf FROM doc_words JOIN stems USING (word)"
        f" WHERE word NOT IN ({_STOP}) GROUP BY ALL",
    ),
    "terms": (
        ["postings"],
        "SELECT term, count(*) AS df, sum(tf)::bigint AS ttf FROM postings GROUP BY term",
    ),
    "topic_terms": (
        ["topic_words", "stems"],
        f"SELECT qid, stem AS term, count(*) AS qtf FROM topic_words JOIN stems USING (word)"
        f" WHERE word NOT IN ({_STOP}) GROUP BY ALL",
    ),
    "weighed": (["topic_terms", "terms"], "SELECT * FROM topic_terms JOIN terms USING (term)"),
    "stats": (
        ["lengths", "terms"],
        "SELECT count(*) AS n_docs, avg(dl) AS avg_dl, sum(dl)::bigint AS sum_dl,"
        " (SELECT count(*) FROM terms) AS vocab FROM lengths",
    ),
    "matched": (
        ["weighed", "postings"],
        "SELECT qid, docno, count(*) AS matched_terms FROM weighed JOIN postings USING (term)"
        " GROUP BY ALL",
    ),
    "dense": (
        ["matched", "weighed", "postings", "lengths", "stats"],
        "SELECT m.qid, m.docno, dl, qtf, df, ttf, coalesce(tf, 0) AS tf, stats.*"
        " FROM matched m JOIN weighed w USING (qid) JOIN lengths USING (docno)"
        " LEFT JOIN postings p ON p.docno = m.docno AND p.term = w.term, stats",
    ),
    "pool": (["dense"], _ranked(_scores("okapi_bm"), POOL_DEPTH)),
    "judged": (
        [],
        f"SELECT {_DOCNO} AS docno, doc_id,"
        " (quality = 1 AND toxic = 0)::integer AS label FROM labels",
    ),
    "qrels": (
        ["pool", "judged"],
        "SELECT qid, docno, label FROM pool JOIN judged USING (docno) UNION"
        " SELECT item_id::integer, docno, label FROM judged JOIN benchmark"
        " ON item_id = doc_id % (SELECT count(*) FROM benchmark)",
    ),
    "sums": (
        ["qrels", "weighed", "postings"],
        "SELECT qid, docno, coalesce(sum(qtf * tf), 0)::bigint AS sum_tf,"
        " coalesce(sum(qtf * df) FILTER (tf IS NOT NULL), 0)::bigint AS sum_df,"
        " coalesce(sum(qtf * ttf) FILTER (tf IS NOT NULL), 0)::bigint AS sum_ttf"
        " FROM qrels LEFT JOIN weighed USING (qid) LEFT JOIN postings USING (docno, term)"
        " GROUP BY qid, docno",
    ),
    "kept": (["dense"], _ranked(_ALL_SCORES, TOP_K, "model, qid")),
    "test_ids": (
        [],
        f"SELECT item_id::integer AS qid FROM benchmark"
        f" ORDER BY md5('{SEED}:' || item_id), item_id LIMIT 5",
    ),
    "feature_rows": (
        ["qrels", "lengths", "sums", "kept"],
        'SELECT qid, docno, dl AS "DL", coalesce(max(score) FILTER (model = \'jm\'), 0) AS "JM", '
        + ", ".join(
            f"coalesce(max(score) FILTER (model = '{m}'), 0) AS {m}"
            for m in ("tf_idf", "laplace", "okapi_bm", "okapi_tf")
        )
        + ", sum_df, sum_tf, sum_ttf, label FROM qrels JOIN lengths USING (docno)"
        " JOIN sums USING (qid, docno) LEFT JOIN kept USING (qid, docno) GROUP BY ALL",
    ),
}


def _with(views: list[str], select: str, source: str = "documents") -> str:
    """Prefix ``select`` by the views it needs, each after those it needs itself."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in _VIEWS[name][0]:
                add(needed)
            ordered.append(name)

    for view in views:
        add(view)
    if not ordered:
        return select
    body = ",\n".join(
        f"{n} AS ({_VIEWS[n][1].replace('FROM documents', f'FROM {source}')})" for n in ordered
    )
    return f"WITH {body}\n{select}"


def _retrieved(model: str, k: int, source: str = "documents") -> str:
    return _with(["dense"], _ranked(_scores(model), k), source)


_FEATURE_COLUMNS = 'qid, docno, "DL", "JM", tf_idf, laplace, okapi_bm, okapi_tf, sum_df, sum_tf, sum_ttf'

_REVISED = (
    "(SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels)"
    " THEN 'Revised editions: ' || text ELSE text END AS text FROM documents)"
)

_LINES = (
    "SELECT model, qid || ' Q0 ' || docno || ' ' || rank || ' '"
    " || score::decimal(18, 6)::varchar || ' Exp' AS line"
    " FROM ({ranked})"
)
_RUN_LINES = _with(["dense"], _LINES.format(ranked=_ranked(_ALL_SCORES, TOP_K, "model, qid")))

_SPLITS = (
    "train_rows AS MATERIALIZED (SELECT * FROM feature_rows WHERE qid NOT IN (SELECT qid FROM test_ids)),\n"
    "test_rows AS MATERIALIZED (SELECT * FROM feature_rows WHERE qid IN (SELECT qid FROM test_ids))"
)


def _learned(tables: str, name: str) -> str:
    """Ranked predictions of table ``name``, made by ``tables`` from the split rows."""
    views = _with(["feature_rows", "test_ids"], "")
    ranked = f"SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY prediction DESC, docno) AS rank, prediction FROM (SELECT qid, docno, round(prediction, 6) + 0.0 AS prediction FROM {name})"
    return f"{views},\n{_SPLITS},\n{tables}\n{ranked}"


def _small_forest(kind: str) -> str:
    return _learned(forest_sql(SMALL_FORESTS[kind], "train_rows", "test_rows", [0, 1] if kind == "classifier" else None), "forest")


ORACLE: dict[str, str] = {
    "ingest_tagged": _with(["lengths"], "SELECT docno, text, dl AS doclength FROM lengths"),
    "ingest_mixed": (
        f"SELECT {_DOCNO} AS docno, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN"
        " replace(text[1:(length(text) // 2)], chr(10), ' ') || ' ' || replace(text[(length(text) // 2 + 1):], chr(10), ' ') || ' '"
        " ELSE replace(text, chr(10), ' ') || ' ' END AS text"
        f" FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || {_quoted(MARKS)} ELSE text END AS text FROM documents) WHERE doc_id % 5 <> 2"
    ),
    "ingest_upsert": _with(["lengths"], "SELECT docno, text, dl AS doclength FROM lengths"),
    "reindex_lengths": _with(
        ["lengths"], "SELECT docno, dl AS doclength FROM lengths", _REVISED
    ),
    "reindex_term_stats": _with(["terms"], "SELECT term, df, ttf FROM terms", _REVISED),
    "reindex_merged_lengths": _with(
        ["lengths"], "SELECT docno, dl AS doclength FROM lengths", _REVISED
    ),
    "reindex_merged_term_stats": _with(["terms"], "SELECT term, df, ttf FROM terms", _REVISED),
    "reindex_retrieve": _retrieved("okapi_bm", SHALLOW_K, _REVISED),
    "vocab_sketched": _with(["terms"], "SELECT count(*) AS vocab, true AS close FROM terms", _REVISED),
    "topic_parse": (
        f"SELECT item_id::integer AS qid, {_clean_topic('part')} AS text FROM (SELECT item_id,"
        f" string_split(item_id || '.' || {_PREAMBLE} || replace(text, chr(10), ' '), '.')[2]"
        " AS part FROM benchmark)"
    ),
    "qrels_parse": _with(["qrels"], "SELECT qid, docno, label FROM qrels"),
    "browse_docs": _with(
        ["lengths"],
        f"SELECT docno, text, dl AS doclength FROM lengths ORDER BY docno LIMIT {BROWSE_SIZE}",
    ),
    "clean_docs": _with(["lengths"], "SELECT docno, text, dl AS doclength FROM lengths"),
    "stop_list_file": _with(["lengths"], "SELECT docno, text, dl AS doclength FROM lengths"),
    "stop_list_table": _with(["lengths"], "SELECT docno, text, dl AS doclength FROM lengths"),
    "doc_length": _with(["lengths"], "SELECT docno, dl AS doclength FROM lengths"),
    "length_stats": _with(
        ["lengths"],
        "SELECT count(*) AS n_docs, avg(dl) AS avg_dl, sum(dl)::bigint AS sum_dl FROM lengths",
    ),
    "vocab_exact": _with(["terms"], "SELECT count(*) AS vocab FROM terms"),
    "vocab_approx": _with(["terms"], "SELECT count(*) AS vocab, true AS close FROM terms"),
    "analyze_tokens": _with(
        ["doc_words"],
        f"SELECT docno, word AS term, count(*) AS n FROM doc_words WHERE word NOT IN ({_STOP})"
        " GROUP BY ALL",
    ),
    "stem_vocab": _with(
        ["stems"],
        f"SELECT v.word, stem FROM (SELECT DISTINCT unnest({_words('text')}) AS word FROM docs) v JOIN stems s ON s.word = {_bare('v.word')}",
    ),
    "segment_words": _SEGMENTS,
    "query_terms": _with(["topic_terms"], "SELECT qid, term, qtf FROM topic_terms"),
    "postings": _with(["postings"], "SELECT docno, term, tf FROM postings"),
    "postings_positions": _with(
        ["doc_words", "stems"],
        f"SELECT docno, stem AS term, count(*) AS tf, string_agg(pos::varchar, ',' ORDER BY pos)"
        f" AS positions FROM doc_words JOIN stems USING (word) WHERE word NOT IN ({_STOP})"
        " GROUP BY ALL",
    ),
    "term_stats": _with(["terms"], "SELECT term, df, ttf FROM terms"),
    "term_vector_lookup": _with(
        ["qrels", "terms", "postings"],
        "SELECT docno, term, tf, df, ttf FROM postings JOIN terms USING (term)"
        " WHERE docno IN (SELECT docno FROM qrels)",
    ),
    "match_candidates": _with(["matched"], "SELECT qid, docno, matched_terms FROM matched"),
    "matched_term_sums": _with(
        ["sums"], "SELECT qid, docno, sum_tf, sum_df, sum_ttf FROM sums"
    ),
    "retrieve_okapi_tf": _retrieved("okapi_tf", TOP_K),
    "retrieve_tf_idf": _retrieved("tf_idf", TOP_K),
    "retrieve_bm25": _retrieved("okapi_bm", TOP_K),
    "retrieve_laplace": _retrieved("laplace", TOP_K),
    "retrieve_jm": _retrieved("jm", TOP_K),
    "retrieve_all_models": _with(["kept"], "SELECT qid, docno, model, score, rank FROM kept"),
    "retrieve_top_k": _retrieved("okapi_bm", SHALLOW_K),
    "custom_scorer": _retrieved("damped", TOP_K),
    "tiny_scorer": _retrieved("tiny", TOP_K),
    "run_lines": _RUN_LINES,
    "run_files": _RUN_LINES,
    "run_append": _with(
        ["dense"],
        _LINES.format(ranked=_ranked(f"SELECT 'okapi_bm' AS model, * FROM ({_scores('okapi_bm')})", TOP_K)),
    ),
    "judged_only": _with(
        ["lengths", "qrels"],
        "SELECT docno, dl AS doclength FROM lengths WHERE docno IN (SELECT docno FROM qrels)",
    ),
    "topic_split": _with(["test_ids"], "SELECT qid FROM test_ids"),
    "train_topics": _with(
        ["test_ids"],
        "SELECT item_id::integer AS qid FROM benchmark"
        " WHERE item_id NOT IN (SELECT qid FROM test_ids)",
    ),
    "pair_lengths": _with(
        ["qrels", "lengths"],
        "SELECT qid, docno, dl AS doclength, dl IS NOT NULL AS indexed"
        " FROM qrels LEFT JOIN lengths USING (docno)",
    ),
    "feature_table_train": _with(
        ["feature_rows", "test_ids"],
        f"SELECT {_FEATURE_COLUMNS}, label FROM feature_rows"
        " WHERE qid NOT IN (SELECT qid FROM test_ids)",
    ),
    "feature_table_test": _with(
        ["feature_rows", "test_ids"],
        f"SELECT {_FEATURE_COLUMNS} FROM feature_rows"
        " WHERE qid IN (SELECT qid FROM test_ids)",
    ),
    "ltr_linear_test": _learned(line_sql(FEATURES, "train_rows", "test_rows"), "line"),
    "ltr_linear_train": _learned(line_sql(FEATURES, "train_rows", "train_rows"), "line"),
    "ltr_small_classifier": _small_forest("classifier"),
    "ltr_small_regressor": _small_forest("regressor"),
    "ltr_small_run_files": " UNION ALL ".join(
        f"SELECT '{kind}' AS learner, qid || ' Q0 ' || docno || ' ' || rank || ' ' || prediction::decimal(18, 6)::varchar || ' Exp' AS line"
        f" FROM ({_small_forest(kind)})"
        for kind in SMALL_FORESTS
    ),
}
