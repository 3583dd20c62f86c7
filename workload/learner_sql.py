"""SQL of the learners: forests level by level, least squares by written-out elimination."""

from __future__ import annotations

from trawl.operators.forest import BOOTSTRAP, SPAN, Plan
from trawl.operators.least_squares import LEAST_SHARE


def forest_sql(plan: Plan, train: str, test: str, classes: list[int] | None) -> str:
    """``qid, docno, prediction`` of ``test`` rows by a forest of limited depth.

    ``train`` and ``test`` name tables with the features, ``train`` with ``label``.
    """
    x = ", ".join(f'"{f}"::DOUBLE' for f in plan.features)
    n = len(plan.features)
    trees = ", ".join(f"({t}, {a}::BIGINT, {b}::BIGINT)" for t in range(plan.trees) for a, b in [plan.multipliers(t)])
    kinds = ", ".join(f"({f}, {m}::BIGINT)" for f, m in enumerate(plan.feature_numbers()))
    own = f"CAST('0x' || substr(md5('{plan.seed}:' || qid || ':' || docno), 1, 15) AS BIGINT) % {SPAN}"
    w = " + ".join(f"(u >= {bar})::BIGINT" for bar in BOOTSTRAP)
    targets = [f"w * (y = {c})::BIGINT" for c in classes] if classes else ["w * y"]
    sums = range(len(targets))

    def square(part: str, weight: str) -> str:
        return f"{part}::DOUBLE * {part}::DOUBLE / {weight}"

    gain = " + ".join(f"({square(f'l{k}', 'lw')} + {square(f'(t{k} - l{k})', '(tw - lw)')})" for k in sums)
    tables = [
        f"forest_trees(tree, a, b) AS (VALUES {trees})",
        f"forest_kinds(f, m) AS (VALUES {kinds})",
        f"bag AS (SELECT tree, label::BIGINT AS y, x, {w} AS w FROM (SELECT label, [{x}] AS x, tree, ({own} * a + b) % {SPAN} AS u FROM {train}, forest_trees))",
        "level0 AS MATERIALIZED (SELECT tree, 1::BIGINT AS node, y, x, w FROM bag WHERE w > 0)",
        f"at0 AS MATERIALIZED (SELECT tree, 1::BIGINT AS node, qid, docno, [{x}] AS x FROM {test}, forest_trees)",
    ]
    for d in range(plan.depth):
        tables += [
            f"mixed{d} AS (SELECT tree, node FROM level{d} GROUP BY ALL HAVING min(y) < max(y))",
            f"sums{d} AS (SELECT tree, node, f, x[f + 1] AS v, sum(w)::BIGINT AS w, {', '.join(f'sum({t})::BIGINT AS s{k}' for k, t in enumerate(targets))} "
            f"FROM level{d} JOIN mixed{d} USING (tree, node), forest_kinds GROUP BY ALL)",
            f"runs{d} AS (SELECT tree, node, f, v, lead(v) OVER o AS beyond, sum(w) OVER o AS lw, sum(w) OVER g AS tw, "
            f"{', '.join(f'sum(s{k}) OVER o AS l{k}, sum(s{k}) OVER g AS t{k}' for k in sums)} FROM sums{d} "
            "WINDOW o AS (PARTITION BY tree, node, f ORDER BY v), g AS (PARTITION BY tree, node, f))",
            f"gains{d} AS (SELECT tree, node, f, v, beyond, {gain} AS gain FROM runs{d} WHERE beyond IS NOT NULL "
            "QUALIFY row_number() OVER (PARTITION BY tree, node, f ORDER BY gain DESC, v) = 1)",
            f"tried{d} AS (SELECT g.* FROM gains{d} g JOIN forest_trees USING (tree) JOIN forest_kinds USING (f) "
            f"QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY ((node % {SPAN} * a + b) % {SPAN} * m + f) % {SPAN}, f) <= {plan.tries})",
            f"split{d} AS MATERIALIZED (SELECT tree, node, f, CASE WHEN (v + beyond) / 2 >= v AND (v + beyond) / 2 < beyond THEN (v + beyond) / 2 ELSE v END AS bar "
            f"FROM tried{d} QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, f) = 1)",
        ]
        for name, columns in (("level", "y, x, w"), ("at", "qid, docno, x")):
            tables.append(
                f"{name}{d + 1} AS MATERIALIZED (SELECT tree, 2 * node + (x[f + 1] > bar)::BIGINT AS node, {columns} FROM {name}{d} JOIN split{d} USING (tree, node))"
            )
    values = ", ".join(f"sum({t})::DOUBLE / sum(w) AS p{k}" for k, t in enumerate(targets))
    ended = " UNION ALL ".join(
        f"SELECT qid, docno, tree, {', '.join(f'p{k}' for k in sums)} FROM at{d} JOIN (SELECT tree, node, {values} FROM level{d} "
        f"{f'ANTI JOIN split{d} USING (tree, node)' if d < plan.depth else ''} GROUP BY ALL) USING (tree, node)"
        for d in range(plan.depth + 1)
    )
    tables.append(f"leaves AS ({ended})")
    # Added up in the order of the trees, as doubles are not exact.
    added = [f"list_reduce([0.0::DOUBLE] || list(p{k} ORDER BY tree), lambda s, p: s + p)" for k in sums]
    if classes is None:
        value = f"{added[0]} / {plan.trees}"
    else:
        shares = f"[{', '.join(added)}]"
        value = f"[{', '.join(f'{c}::DOUBLE' for c in classes)}][list_position({shares}, list_max({shares}))]"
    return ",\n".join(tables) + f",\nforest AS (SELECT qid, docno, {value} AS prediction FROM leaves GROUP BY qid, docno)"


def line_sql(features: list[str], train: str, rows: str) -> str:
    """A table ``line`` (qid, docno, prediction): least squares fitted on ``train``."""
    n = len(features)
    means = ", ".join(f'avg("{f}"::DOUBLE) AS m{i}' for i, f in enumerate(features))
    centred = ", ".join(f'"{f}"::DOUBLE - m{i} AS c{i}' for i, f in enumerate(features))
    spread = ", ".join(f"CASE WHEN sum(c{i} * c{i}) > 0 THEN sqrt(sum(c{i} * c{i})) ELSE 1 END AS d{i}" for i in range(n))
    cells = [(i, j) for i in range(n) for j in range(n + 1)]
    name = lambda i, j: f"a{i}_{j}"
    scaled = ", ".join(
        (f"sum(c{i} * c{j}) / any_value(d{i}) / any_value(d{j})" if j < n else f"sum(c{i} * cy) / any_value(d{i})") + f" AS {name(i, j)}" for i, j in cells
    )
    tables = [
        f"line_means AS (SELECT {means}, avg(label::DOUBLE) AS my FROM {train})",
        f"line_rows AS MATERIALIZED (SELECT {centred}, label::DOUBLE - my AS cy FROM {train}, line_means)",
        f"line_spread AS (SELECT {spread} FROM line_rows)",
        f"line0 AS MATERIALIZED (SELECT {scaled} FROM line_rows, line_spread)",
    ]
    for p in range(n):
        pivot = name(p, p)
        kept = [
            f"{name(i, j)} - CASE WHEN {pivot} > {LEAST_SHARE} THEN {name(i, p)} / {pivot} ELSE 0 END * {name(p, j)} AS {name(i, j)}" if i > p and j > p else name(i, j)
            for i, j in cells
        ]
        tables.append(f"line{p + 1} AS MATERIALIZED (SELECT {', '.join(kept)} FROM line{p})")
    step = f"line{n}"
    for p in reversed(range(n)):
        rest = " - ".join([name(p, n), *[f"{name(p, j)} * b{j}" for j in range(p + 1, n)]])
        tables.append(f"back{p} AS MATERIALIZED (SELECT *, CASE WHEN {name(p, p)} > {LEAST_SHARE} THEN ({rest}) / {name(p, p)} ELSE 0 END AS b{p} FROM {step})")
        step = f"back{p}"
    value = " + ".join(["my", *[f'b{i} / d{i} * ("{f}"::DOUBLE - m{i})' for i, f in enumerate(features)]])
    tables.append(f"line AS (SELECT qid, docno, {value} AS prediction FROM {rows}, line_means, line_spread, {step})")
    return ",\n".join(tables)
