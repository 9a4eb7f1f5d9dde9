"""DuckDB twin of the batched decision trees (oracle side only).

Split candidates come from a recursive scan over each part's distinct values;
then every level is one chain of CTEs: class counts by (impurity, part, node,
feature, bin), running sums for the rows left of each split, the first split
of the largest gain, and the rows' next nodes.
"""

from __future__ import annotations

import json

from maillens.operators import tree as TREE
from maillens.plans.sgd_oracle import selection_ctes


def _impurity(kind: str, p: str, n: str) -> str:
    gini = f"1.0 - (({n} - {p}) / {n}) * (({n} - {p}) / {n}) - ({p} / {n}) * ({p} / {n})"
    bits = lambda q: f"case when {q} > 0 then {q} * ln({q}) / ln(2.0) else 0.0 end"
    entropy = f"0.0 - ({bits(f'(({n} - {p}) / {n})')}) - ({bits(f'({p} / {n})')})"
    return f"(case when {kind} = 'gini' then {gini} else {entropy} end)"


def tree_ctes(grid: list[dict], feats: list[str], k: int) -> list[tuple[str, str]]:
    """CTEs over ``learn(doc_id, label, part, feats...)`` ending in ``cv``,
    ``best`` and ``fin`` (as ``sgd_oracle``)."""
    bins = {int(g["max_bins"]) for g in grid}
    if len(bins) != 1:
        raise ValueError("one number of bins")
    bins = bins.pop()
    depths = sorted({int(g["max_depth"]) for g in grid})
    kinds = sorted({g["impurity"] for g in grid})
    values = ", ".join(
        f"({g['grid_index']}, '{g['impurity']}', {int(g['max_depth'])}, "
        f"'{json.dumps({a: b for a, b in g.items() if a != 'grid_index'}, sort_keys=True)}')" for g in grid)
    cells = " union all ".join(f"select doc_id, part, label, {j} f, {c}::DOUBLE v from learn"
                               for j, c in enumerate(feats))
    out = [
        ("grid", f"select * from (values {values}) v(grid_index, kind, depth, params)"),
        ("parts", f"select range::INTEGER m from range(0, {k + 1})"),
        ("cell", cells),
        ("vals", f"select m, f, v, count(*)::DOUBLE c from cell, parts where part < {k} and part <> m group by all"),
        ("seq", "select *, row_number() over (partition by m, f order by v) i, sum(c) over (partition by m, f) total, "
                "sum(c) over (partition by m, f order by v) run, lead(v) over (partition by m, f order by v) nxt, "
                "count(*) over (partition by m, f) nd from vals"),
        # the running count at value i against the next target; a split moves the target on
        ("scan(m, f, i, target, cut)",
         f"select m, f, 0::BIGINT, total / {bins}, null::DOUBLE from seq where i = 1 and nd > {bins} union all "
         "select s.m, s.f, s.i, "
         "case when abs(s.run - p.target) < abs(s.run + n.c - p.target) "
         f"then p.target + s.total / {bins} else p.target end, "
         "case when abs(s.run - p.target) < abs(s.run + n.c - p.target) then (s.v + s.nxt) / 2.0 end "
         "from scan p join seq s on s.m = p.m and s.f = p.f and s.i = p.i + 1 "
         "join seq n on n.m = s.m and n.f = s.f and n.i = s.i + 1"),
        ("cuts", "select m, f, cut, (row_number() over (partition by m, f order by cut) - 1)::INTEGER s from "
                 "(select m, f, cut from scan where cut is not null union all "
                 f"select m, f, (v + nxt) / 2.0 from seq where nd <= {bins} and nxt is not null)"),
        ("binned", "select c.doc_id, c.f, c.v, parts.m, count(cuts.cut)::INTEGER b from cell c cross join parts "
                   f"left join cuts on cuts.m = parts.m and cuts.f = c.f and c.v > cuts.cut "
                   f"where c.part < {k} or c.part = parts.m group by all"),
        ("rows0", f"select kind, m, doc_id, label, part < {k} and part <> m tr, 1::BIGINT node, true open "
                  f"from learn, parts, (select unnest({kinds!r}) kind) where part < {k} or part = m"),
    ]
    for level in range(depths[-1]):
        gain = (f"{_impurity('kind', 'p', 'n')} - (ln_ / n) * {_impurity('kind', 'lp', 'ln_')} "
                f"- ((n - ln_) / n) * {_impurity('kind', '(p - lp)', '(n - ln_)')}")
        out += [
            (f"hist{level}", "select kind, m, node, f, b, count(*)::DOUBLE c, sum(label) q "
                             f"from rows{level} join binned using (m, doc_id) where tr and open group by all"),
            (f"run{level}", "select *, sum(c) over w ln_, sum(q) over w lp, sum(c) over t n, sum(q) over t p "
                            f"from hist{level} window w as (partition by kind, m, node, f order by b), "
                            "t as (partition by kind, m, node, f)"),
            (f"split{level}", f"select kind, m, node, f, b s from (select *, round({gain}, {TREE.GAIN_DECIMALS}) g "
                              f"from run{level} where ln_ < n) where g > 0 "
                              "qualify row_number() over (partition by kind, m, node order by g desc, f, b) = 1"),
            (f"rows{level + 1}", "select r.kind, r.m, r.doc_id, r.label, r.tr, "
                                 "case when x.s is null then r.node else 2 * r.node + (x.b > x.s)::INT end node, "
                                 "r.open and x.s is not null open "
                                 f"from rows{level} r left join (select z.*, y.doc_id, y.b from split{level} z "
                                 "join binned y on y.m = z.m and y.f = z.f) x "
                                 "on r.open and x.kind = r.kind and x.m = r.m and x.node = r.node "
                                 "and x.doc_id = r.doc_id"),
        ]
    evals = " union all ".join(
        f"select kind, {d} depth, m, label, one from rows{d} join (select kind, m, node, "
        f"sum(label) > count(*) - sum(label) one from rows{d} where tr group by all) using (kind, m, node) "
        "where not tr" for d in depths)
    out += [
        ("scored", evals),
        ("ev", "select grid_index, params, m part, count(*) n, count(*) filter (where one and label = 1) tp, "
               "count(*) filter (where one and label <> 1) fp, count(*) filter (where not one and label = 1) fn "
               "from scored join grid using (kind, depth) group by all"),
        ("errs", "select g.grid_index, g.params, p.m part, (e.fp + e.fn) / e.n error from grid g "
                 f"cross join (select m from parts where m < {k}) p "
                 "left join ev e on e.grid_index = g.grid_index and e.part = p.m"),
        ("fin_conf", f"select grid_index, n, tp, fp, fn, n - tp - fp - fn tn from ev where part = {k}"),
    ]
    return out + selection_ctes()
