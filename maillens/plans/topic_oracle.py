"""DuckDB twin of the topic model (oracle side only): every round of the EM
as one CTE over whole-number counts, after the term statistics."""

from __future__ import annotations

from maillens.operators import lda as LDA
from maillens.operators import selection as SE


def topic_ctes(k: int, rounds: int, top: int) -> list[tuple[str, str]]:
    """CTEs over ``per_doc``, ``stats`` and ``vocab`` ending in ``tops(topic,
    rank, term_index, term, weight)`` and ``held(doc_id, j, n)``."""
    n_docs, size = "(select count(*) from documents)", "(select count(*) from vocab)"
    step = lambda x: f"1 + ((({x}) * ({x}) + 3) % {LDA.PRIME})"
    first = f"(a + 65537 * (w::BIGINT + 1) + 40503 * j::BIGINT) % {LDA.PRIME}"
    mixed = f"((({first}) * ({first}) + 11) % {LDA.PRIME} * 48271 + 7) % {LDA.PRIME}"
    topics = f"range(1, {k + 1})"
    out = [
        ("cell", "select doc_id, term_index w, "
                 f"round(n * ln(({n_docs} + 1.0) / (df + 1.0)) * {LDA.UNIT})::BIGINT u, "
                 f"{SE.bucket_sql('doc_id', LDA.SALT)} % {LDA.PRIME} a "
                 "from per_doc join vocab using (term) join stats using (term)"),
        ("share0", f"select doc_id, w, u, list_transform({topics}, lambda j: ({step(mixed)})::DOUBLE) s from cell"),
    ]
    for t in range(rounds + 1):
        if t:
            out.append((f"share{t}", f"select doc_id, w, u, list_transform({topics}, lambda j: q[j] * "
                                     f"(h[j] / {LDA.UNIT}::DOUBLE + {LDA.alpha(k) - 1.0!r}::DOUBLE)) s from cell "
                                     f"join term{t - 1} using (w) join doc{t - 1} using (doc_id)"))
        out += [
            (f"got{t}", f"select doc_id, w, unnest({topics}) j, unnest(list_transform(s, "
                        f"lambda x: round(u * (x / list_sum(s)))::BIGINT)) n from share{t}"),
            (f"doc{t}", f"select doc_id, list(n order by j) h from (select doc_id, j, sum(n)::BIGINT n from got{t} "
                        "group by all) group by 1"),
            (f"count{t}", f"select w, j, sum(n)::BIGINT n from got{t} group by all"),
            (f"term{t}", f"select w, list((n / {LDA.UNIT}::DOUBLE + {LDA.ETA - 1.0!r}::DOUBLE) / "
                         f"(z / {LDA.UNIT}::DOUBLE + {size} * {LDA.ETA - 1.0!r}::DOUBLE) order by j) q "
                         f"from count{t} join (select j, sum(n)::BIGINT z from count{t} group by 1) using (j) group by 1"),
        ]
    out += [
        ("tops", "select topic, rank, term_index, term, weight from ("
                 "select (j - 1)::INTEGER topic, w term_index, n / z::DOUBLE weight, "
                 "(row_number() over (partition by j order by n desc, w) - 1)::INTEGER rank "
                 f"from count{rounds} join (select j, sum(n)::BIGINT z from count{rounds} group by 1) using (j)) "
                 f"join vocab using (term_index) where rank < {top}"),
        ("held", f"select doc_id, j, sum(n)::BIGINT n from got{rounds} group by all"),
    ]
    return out
