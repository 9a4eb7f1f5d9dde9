"""DuckDB twin of the batched SGD grid search (oracle side only).

A recursive CTE carries every model's weights from iteration to
iteration: one join of the state with its training rows (mini-batch rows
chosen by the same md5 bucket as the Spark job), one aggregate of the
gradients, the same update, intercept and stopping rules. Snapshots at
the grid's iteration counts are scored on each model's evaluation part.
"""

from __future__ import annotations

import json

from maillens.operators import linear as LIN

TOL = LIN.CONVERGENCE_TOL


def _grid_rows(grid: list[dict]):
    """Models in the grid's own terms: points that differ in iterations only
    share one; a zero penalty is trained as the penalty it names (the job
    under test merges those)."""
    trajs: list[LIN.Trajectory] = []
    rows = []
    for g in grid:
        kind = g.get("reg_type") or "none"
        traj = LIN.Trajectory(float(g["step"]), kind, 0.0 if kind == "none" else float(g["reg_param"]),
                              bool(g["intercept"]), float(g.get("mini_batch", 1.0)))
        iters = int(g["iterations"])
        if traj not in trajs:
            trajs.append(traj)
        params = json.dumps({k: v for k, v in g.items() if k != "grid_index"}, sort_keys=True)
        rows.append((g["grid_index"], trajs.index(traj), iters, params))
    return trajs, rows


def _lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"{float(v)!r}::DOUBLE" if isinstance(v, float) else str(v)


def selection_ctes() -> list[tuple[str, str]]:
    """``cv``, ``best`` and ``fin`` from ``errs(grid_index, params, part,
    error)`` and ``fin_conf(grid_index, n, tp, fp, fn, tn)``."""
    cv = ("select grid_index, params, round(avg(error) * 1000000.0) / 1000000.0 mean_error, "
          "count(error) n_folds from errs group by 1, 2")
    best = ("select grid_index from (select grid_index, avg(error) me from errs group by 1) "
            "order by round(me, 12) nulls last, grid_index limit 1")

    def r6(x: str) -> str:
        return f"round(({x}) * 1000000.0) / 1000000.0"

    fin = (
        "select grid_index, n, tp, fp, fn, tn, "
        + r6("(fp + fn) / n") + " error, " + r6("(1 - (fp + fn) / n) * 100") + " accuracy, "
        + r6("case when tp + fp > 0 then t1 * (tp / (tp + fp)) + (t0 - t1) * "
             "((tp / (tp + fp)) + p0) / 2 else t0 * p0 end") + " aupr, "
        + r6("f1 * t1 / 2 + (f0 - f1) * (t1 + t0) / 2 + (1 - f0) * (t0 + 1) / 2") + " auroc "
        "from (select *, case when tp + fn > 0 then tp / (tp + fn) else 0.0 end t1, "
        "case when fp + tn > 0 then fp / (fp + tn) else 0.0 end f1, "
        "case when tp + fn > 0 then 1.0 else 0.0 end t0, "
        "case when fp + tn > 0 then 1.0 else 0.0 end f0, (tp + fn) / n p0 from fin_conf "
        "where grid_index = (select grid_index from best))")
    return [("cv", cv), ("best", best), ("fin", fin)]


def sgd_ctes(kind: str, grid: list[dict], feats: list[str], k: int) -> list[tuple[str, str]]:
    """CTEs over ``lin(doc_id, label, part, feats...)`` ending in
    ``cv(grid_index, params, mean_error, n_folds)``."""
    trajs, grid_rows = _grid_rows(grid)
    T = max(it for _, _, it, _ in grid_rows)
    P = k + 1
    d = len(feats)
    ws = [f"w{j}" for j in range(d)] + ["wb"]
    traj_vals = ", ".join(
        f"({i}, {_lit(t.step)}, {_lit(t.reg_type)}, {_lit(t.reg)}, {_lit(t.intercept)}, "
        f"{_lit(t.batch)})" for i, t in enumerate(trajs))
    grid_vals = ", ".join(f"({gi}, {ti}, {it}, {_lit(p)})" for gi, ti, it, p in grid_rows)

    margin = " + ".join([f"s.w{j} * r.{c}" for j, c in enumerate(feats)] + ["s.wb"])
    if kind == "logistic":
        coef = (f"(1.0 / (1.0 + exp(-least(greatest({margin}, -700.0), 700.0))) - r.label)")
    else:
        coef = (f"(case when (2.0 * r.label - 1.0) * ({margin}) < 1.0 "
                f"then -(2.0 * r.label - 1.0) else 0.0 end)")
    bucket = ("('0x' || substr(md5('batch' || (s.i + 1) || ':' || r.doc_id::VARCHAR), 1, 8))"
              "::BIGINT")
    batch = f"(s.batch >= 1.0 or {bucket} % 2 = 0)"
    state = "s.i + 1 ni, s.model, s.part, s.step, s.rtype, s.reg, s.icpt, s.batch, s.active, s.n_upd, " \
        + ", ".join(f"s.{w}" for w in ws)
    grads = ", ".join([f"sum({coef} * r.{c}) g{j}" for j, c in enumerate(feats)]
                      + [f"sum(case when s.icpt then {coef} else 0.0 end) gb"])
    agg = (f"select {state}, count(r.doc_id) cnt, {grads} "
           f"from sgd s left join lin r on s.active and r.part < {k} and r.part <> s.part "
           f"and {batch} where s.i < {T} group by all")
    gs = [f"g{j}" for j in range(d)] + ["gb"]

    def new_w(w: str, g: str) -> str:
        a = "(step / sqrt(ni))"
        gm = f"({g} / cnt)"
        plain = f"({w} - {a} * {gm})"
        l2 = f"({w} * (1.0 - {a} * reg) - {a} * {gm})"
        l1 = f"(sign({plain}) * greatest(0.0, abs({plain}) - {a} * reg))"
        v = f"case when rtype = 'l2' then {l2} when rtype = 'l1' then {l1} else {plain} end"
        if w == "wb":
            v = f"case when icpt then {v} else 0.0 end"
        return f"case when active and cnt > 0 then {v} else {w} end"

    upd = ("select ni, model, part, step, rtype, reg, icpt, batch, active, n_upd, "
           "active and cnt > 0 upd, "
           + ", ".join(f"{w} o_{w}, {new_w(w, g)} n_{w}" for w, g in zip(ws, gs))
           + f" from ({agg})")
    diff2 = " + ".join(f"(n_{w} - o_{w}) * (n_{w} - o_{w})" for w in ws)
    norm2 = " + ".join(f"n_{w} * n_{w}" for w in ws)
    step_sql = (
        "select ni i, model, part, step, rtype, reg, icpt, batch, "
        f"active and not (upd and n_upd >= 1 and sqrt({diff2}) < {TOL!r} * "
        f"greatest(sqrt({norm2}), 1.0)) active, "
        "n_upd + case when upd then 1 else 0 end n_upd, "
        + ", ".join(f"n_{w} {w}" for w in ws) + f" from ({upd})")
    anchor = ("select 0 i, t.traj * " + str(P) + " + p.part model, p.part, t.step, t.rtype, "
              "t.reg, t.icpt, t.batch, true active, 0 n_upd, "
              + ", ".join("0.0::DOUBLE " + w for w in ws[:-1])
              + ", case when t.icpt then 1.0 else 0.0 end::DOUBLE wb "
              f"from traj t, (select range::INTEGER part from range(0, {P})) p")
    snap_iters = sorted({it for _, _, it, _ in grid_rows})
    pred_margin = " + ".join([f"s.w{j} * r.{c}" for j, c in enumerate(feats)] + ["s.wb"])
    evals = ("select s.i, s.model, count(*) n, "
             f"count(*) filter (where ({pred_margin}) > 0 and r.label = 1) tp, "
             f"count(*) filter (where ({pred_margin}) > 0 and r.label <> 1) fp, "
             f"count(*) filter (where not (({pred_margin}) > 0) and r.label = 1) fn "
             f"from sgd s join lin r on r.part = s.part "
             f"where s.i in ({', '.join(map(str, snap_iters))}) group by 1, 2")
    errs = (f"select g.grid_index, g.params, p.part, "
            f"case when coalesce(e.n, 0) > 0 then (e.fp + e.fn) / e.n end error "
            f"from grid g cross join (select range::INTEGER part from range(0, {k})) p "
            f"left join ev e on e.i = g.iterations and e.model = g.traj * {P} + p.part")
    fin_conf = (f"select g.grid_index, e.n, e.tp, e.fp, e.fn, e.n - e.tp - e.fp - e.fn tn "
                f"from grid g join ev e on e.i = g.iterations and e.model = g.traj * {P} + {k}")
    predicted = (f"select r.doc_id, r.label, case when {pred_margin} > 0 then 1.0 else 0.0 end::DOUBLE prediction "
                 f"from best b join grid g using (grid_index) "
                 f"join sgd s on s.i = g.iterations and s.model = g.traj * {P} + {k} "
                 f"join lin r on r.part = {k}")
    return [
        ("traj", f"select * from (values {traj_vals}) v(traj, step, rtype, reg, icpt, batch)"),
        ("grid", f"select * from (values {grid_vals}) v(grid_index, traj, iterations, params)"),
        ("sgd", f"{anchor} union all {step_sql}"),
        ("ev", evals),
        ("errs", errs),
        ("fin_conf", fin_conf),
        *selection_ctes(),
        ("predicted", predicted),
        ("margins", "select g.grid_index, s.part, r.label, "
                    f"round(({pred_margin}) * 1000000000.0) / 1000000000.0 score from grid g "
                    f"join sgd s on s.i = g.iterations and s.model = g.traj * {P} + s.part join lin r on r.part = s.part"),
        ("levels", "select grid_index, part, score, count(*) filter (where label = 1) pos, "
                   "count(*) filter (where label <> 1) neg from margins group by all"),
        ("steps", "select *, sum(pos) over w tp, sum(neg) over w fp from levels "
                  "window w as (partition by grid_index, part order by score desc)"),
        ("areas", "select grid_index, part, sum(pos) + sum(neg) n, "
                  "case when sum(pos) = 0 then 0.0 when sum(neg) = 0 then 1.0 "
                  "else sum((2 * tp - pos) * neg) / 2.0 / sum(pos) / sum(neg) end auroc, "
                  "case when sum(pos) = 0 then 0.0 else sum(pos * (tp / (tp + fp) + case when tp - pos + fp - neg > 0 "
                  "then (tp - pos) / (tp - pos + fp - neg) else tp / (tp + fp) end) / 2) / sum(pos) end aupr "
                  "from steps group by all"),
    ]


def ridge_ctes(regs: list[float], feats: list[str], k: int, rounds: int, step: float) -> list[tuple[str, str]]:
    """CTEs over ``lin(doc_id, label, part, feats...)`` ending in ``conf(grid_index,
    part, n, tp, fp, fn, tn)``: logistic regression with an L2 penalty (not on the
    intercept) by full gradient descent, run until it stands still."""
    ws = [f"w{j}" for j in range(len(feats))]
    margin = " + ".join([f"s.w{j} * r.{c}" for j, c in enumerate(feats)] + ["s.wb"])
    grads = ", ".join([f"avg((1.0 / (1.0 + exp(-({margin}))) - r.label) * r.{c}) g{j}" for j, c in enumerate(feats)]
                      + [f"avg(1.0 / (1.0 + exp(-({margin}))) - r.label) gb"])
    moved = ", ".join([f"w{j} - {step} * (g{j} + reg * w{j})" for j in range(len(feats))] + [f"wb - {step} * gb"])
    start = ", ".join("0.0::DOUBLE " + w for w in [*ws, "wb"])
    values = ", ".join(f"({i}, {r!r}::DOUBLE)" for i, r in enumerate(regs))
    held = ", ".join(f"s.{w}" for w in [*ws, "wb"])
    return [
        ("reg_grid", f"select * from (values {values}) v(grid_index, reg)"),
        ("ridge", f"select 0 i, grid_index, reg, range::INTEGER part, {start} from reg_grid, range(0, {k + 1}) "
                  f"union all select i + 1, grid_index, reg, part, {moved} from ("
                  f"select s.i, s.grid_index, s.reg, s.part, {held}, {grads} from ridge s join lin r "
                  f"on r.part < {k} and r.part <> s.part where s.i < {rounds} group by all)"),
        ("conf", "select s.grid_index, s.part, count(*) n, "
                 f"count(*) filter (where ({margin}) > 0 and r.label = 1) tp, "
                 f"count(*) filter (where ({margin}) > 0 and r.label <> 1) fp, "
                 f"count(*) filter (where not (({margin}) > 0) and r.label = 1) fn, "
                 f"count(*) filter (where not (({margin}) > 0) and r.label <> 1) tn "
                 f"from ridge s join lin r on r.part = s.part where s.i = {rounds} group by all"),
    ]
