"""Personal data: base patterns plus weakly supervised spans.

Four base kinds are found by their patterns and always stay. Beyond them a
looser generator proposes candidates: tokens around an ``@`` and runs of
seven or more digits with separators. Labelers vote on each candidate: the
patterns of the base kinds, gazetteers (mail domains, card issuers) and the
words in front. Expectation-maximisation (two classes, labelers independent
within a class) estimates from the counts of vote patterns how reliable each
labeler is. The posteriors then train the final span classifier, a naive
Bayes over the candidate's shape and surroundings; a candidate it finds more
likely personal than not, and that touches no base span, is added as kind
``contact`` (with ``@``) or ``number``.

Everything runs in SQL expressions; what reaches the driver are the counts
by vote pattern and by feature value, both from fixed finite sets.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillens.llm.common import NO_MATCHES, matches

BASE = ("email", "ip", "card", "phone")
ADDED = ("contact", "number")
MIN_DIGITS = 7
ROUNDS = 60                 # of expectation-maximisation
FEW = 64                    # base spans of a text that are compared one by one

# Fixed patterns of the base kinds. Possessive forms: a failing long run costs
# its length once; (?:\G|(?<!..)) lets a match start at the begin of a run or
# where the match before ended, as leftmost non-overlapping search does.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_CANDIDATE = r"(?:\G|(?<![^\s@]))[^\s@]++@[^\s@]++|[0-9](?:[\x20().-]{0,2}[0-9])++"

# Fixed gazetteers.
_DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu"
_ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65"
_CUES = "e-?mail|mail|contact|call|phone|tel|mobile|fax|card|visa|account|iban|ssn|address|ip|from|to|reach"
_AGAINST = "page|pages|vol|version|isbn|issn|no|id|line|chapter|token|password|key|sha|license|figure"


def luhn(digits: Column) -> Column:
    """Luhn check of a string of digits."""
    def value(d: Column, i: Column) -> Column:
        v = d.cast("int")
        twice = v * 2
        return F.when(i % 2 == 0, v).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    each = F.transform(F.split(F.reverse(digits), "", -1),
                       lambda d, i: F.when(d == "", F.lit(0)).otherwise(value(d, i)))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def _valid(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return text.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)(?:\.|$)){4}$")
    n = F.length(_digits(text))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(_digits(text))).otherwise(F.lit(False))
    return n.between(9, 15)


def _valid_match(kind: str):
    return lambda m: _valid(kind, m["text"])


def _as_span(kind: int):
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))


def _spans(df: DataFrame) -> DataFrame:
    """``df(text, ...)`` plus ``base`` (kind, start, end) and ``candidates``."""
    text = F.col("text")
    none = F.array().cast(NO_MATCHES)
    may = {"email": F.instr(text, "@") > 0, "ip": text.rlike("[0-9]"), "card": text.rlike("[0-9]"),
           "phone": F.instr(text, "+") > 0}
    for kind in BASE:
        found = F.when(may[kind], matches(text, PATTERNS[kind])).otherwise(none)
        df = df.withColumn(f"__{kind}", F.filter(found, _valid_match(kind)))
    loose = F.when(text.rlike("[0-9@]"), matches(text, _CANDIDATE)).otherwise(none)
    loose = F.filter(loose, lambda m: (F.instr(m["text"], "@") > 0)
                     | (F.length(_digits(m["text"])) >= MIN_DIGITS))
    df = df.withColumn("__loose", loose)
    listed = F.concat(*[F.transform(f"__{kind}", _as_span(i)) for i, kind in enumerate(BASE)])
    return df.withColumn("base", listed).withColumn("candidates", F.transform("__loose", _described)).drop(
        "__loose", *[f"__{k}" for k in BASE])


def _described(m: Column) -> Column:
    """A candidate with its votes (1 for, 2 against, 0 none) and features."""
    text, before, after = m["text"], m["before"], m["after"]
    at = F.instr(text, "@") > 0
    digits = _digits(text)
    n = F.length(digits)
    plus = before.endswith("+")
    word = F.lower(F.regexp_extract(before, r"([A-Za-z-]+)[^A-Za-z]*$", 1))
    vote = lambda yes, no=None: (F.when(yes, 1) if no is None else F.when(yes, 1).when(no, 2)).otherwise(0)
    quad = text.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$")
    votes = [
        vote(at & text.rlike(rf"^{_LOCAL}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)+"), at),
        vote(quad & _valid("ip", text), quad),
        F.when(~at & n.between(13, 19), F.when(luhn(digits), 1).otherwise(2)).otherwise(0),
        vote(plus & n.between(9, 15), ~at & (n > 19)),
        vote(F.when(at, text.rlike(rf"\.(?:{_DOMAINS})\b")).otherwise(
            n.between(13, 19) & digits.rlike(f"^(?:{_ISSUERS})"))),
        vote(word.rlike(f"^(?:{_CUES})$"), word.rlike(f"^(?:{_AGAINST})$")),
    ]
    edge = lambda c: (F.when(c == "", 0).when(c.rlike(r"^\s"), 1).when(c.rlike(r"^[A-Za-z]"), 2)
                      .when(c.rlike(r"^[0-9]"), 3).otherwise(4))
    features = [
        F.when(at, 0).when(n < 9, 1).when(n < 13, 2).when(n < 16, 3).when(n == 16, 4).when(n < 20, 5).otherwise(6),
        F.when(at, 0).when(text.rlike("^[0-9]+$"), 1).when(text.rlike("^[0-9 ]+$"), 2)
        .when(text.rlike("^[0-9-]+$"), 3).when(text.rlike("^[0-9.]+$"), 4).otherwise(5),
        F.when(plus, 1).otherwise(0),
        edge(F.right(before, F.lit(1))), edge(after),
        F.when(~at, 0).when(text.rlike(r"@[^.]+\.[A-Za-z]"), 1).otherwise(2),
    ]
    code = lambda parts, base: sum((p * base ** i for i, p in enumerate(parts)), F.lit(0))
    return F.struct(m["start"].alias("start"), m["end"].alias("end"), F.when(at, 0).otherwise(1).alias("kind"),
                    code(votes, 3).cast("int").alias("votes"), code(features, 7).cast("int").alias("features"))


N_VOTES, N_FEATURES = 6, 6


def _unpack(code: int, base: int, n: int) -> tuple[int, ...]:
    return tuple(code // base ** i % base for i in range(n))


def reliabilities(patterns: dict[int, int]) -> tuple[float, list[list[list[float]]], dict[int, float]]:
    """EM over counts of vote patterns: (share of personal candidates,
    P(vote | class) per labeler, posterior of every pattern)."""
    rows = [(_unpack(p, 3, N_VOTES), n) for p, n in sorted(patterns.items())]
    post = []
    for votes, _ in rows:                                  # start: the majority of the votes
        yes, no = votes.count(1), votes.count(2)
        post.append((yes + 0.5) / (yes + no + 1.0))
    share, table = 0.5, []
    for _ in range(ROUNDS):
        total = sum(n for _, n in rows)
        mass = [sum(n * (1 - q) for (_, n), q in zip(rows, post, strict=True)),
                sum(n * q for (_, n), q in zip(rows, post, strict=True))]
        share = (mass[1] + 1) / (total + 2)
        table = []
        for j in range(N_VOTES):
            seen = [[1.0, 0.5, 1.0], [1.0, 1.0, 0.5]]      # labelers are better than chance
            for (votes, n), q in zip(rows, post, strict=True):
                seen[0][votes[j]] += n * (1 - q)
                seen[1][votes[j]] += n * q
            table.append([[v / sum(side) for v in side] for side in seen])
        post = []
        for votes, _ in rows:
            odds = math.log(share / (1 - share)) + sum(
                math.log(table[j][1][v] / table[j][0][v]) for j, v in enumerate(votes))
            post.append(1 / (1 + math.exp(-max(-50.0, min(50.0, odds)))))
    return share, table, {p: q for p, q in zip(sorted(patterns), post, strict=True)}


def span_weights(counts: dict[tuple[int, int], int]) -> tuple[float, list[dict[int, float]]]:
    """Naive Bayes log-odds from soft labels: (bias, weight by feature value);
    ``counts`` by (vote pattern, feature code)."""
    patterns: dict[int, int] = defaultdict(int)
    for (votes, _), n in counts.items():
        patterns[votes] += n
    _, _, post = reliabilities(dict(patterns)) if patterns else (0.5, [], {})
    mass = [1.0, 1.0]
    seen = [defaultdict(lambda: [0.5, 0.5]) for _ in range(N_FEATURES)]
    for (votes, code), n in sorted(counts.items()):
        q = post[votes]
        mass[0] += n * (1 - q)
        mass[1] += n * q
        for i, v in enumerate(_unpack(code, 7, N_FEATURES)):
            seen[i][v][0] += n * (1 - q)
            seen[i][v][1] += n * q
    bias = math.log(mass[1] / mass[0])
    weights = [{v: math.log(yes / (mass[1] + 2)) - math.log(no / (mass[0] + 2))
                for v, (no, yes) in f.items()} for f in seen]
    return bias, weights


def _overlaps(spans: Column, c: Column) -> Column:
    """Does ``c`` touch any of the sorted, disjoint ``spans``? A binary search
    for the first one that ends behind ``c``'s start."""
    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        behind = F.get(spans, middle)["end"] > c["start"]
        return F.when(at["lo"] >= at["hi"], at).otherwise(F.struct(
            F.when(behind, at["lo"]).otherwise(middle + 1).alias("lo"),
            F.when(behind, middle).otherwise(at["hi"]).alias("hi")))

    whole = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    first = F.aggregate(F.sequence(F.lit(1), F.lit(32)), whole, halve, lambda at: F.get(spans, at["lo"]))
    return F.coalesce(first["start"] < c["end"], F.lit(False))


def find(docs: DataFrame) -> DataFrame:
    """Personal data of ``docs(doc_id, text, ...)``: ``doc_id, base, added``.

    ``base`` and ``added`` are arrays of (kind, start, end), kind an index
    into ``BASE`` and ``ADDED``, positions in code points, end exclusive. A
    null text is empty; an empty one has no spans; other columns are ignored;
    repeated rows give repeated rows; an empty table gives an empty one.
    Whole texts are searched whatever their length.
    """
    rows = _spans(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).drop("text")
    seen = (rows.select(F.explode("candidates").alias("c")).groupBy("c.votes", "c.features").count())
    counts = {(r["votes"], r["features"]): r["count"] for r in seen.collect()}
    bias, weights = span_weights(counts)

    def score(code: Column) -> Column:
        total = F.lit(bias)
        for i, by_value in enumerate(weights):
            value = F.floor(code / 7 ** i) % 7
            part = F.lit(0.0)
            for v, weight in sorted(by_value.items()):
                part = F.when(value == v, F.lit(weight)).otherwise(part)
            total = total + part
        return total

    of_kind = lambda i: lambda b: b["kind"] == i
    by_kind = [F.filter("base", of_kind(i)) for i in range(len(BASE))]
    rows = rows.withColumn("__sorted", F.when(F.size("base") > FEW, F.array(*by_kind)))

    def touches(c: Column) -> Column:
        some = F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        return F.when(F.col("__sorted").isNull(), some).otherwise(
            F.exists("__sorted", lambda spans: _overlaps(spans, c)))

    fresh = F.filter("candidates", lambda c: (score(c["features"]) > 0) & ~touches(c))
    return rows.select("doc_id", "base", F.transform(
        fresh, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))).alias("added"))


def listing(spans: str, names: tuple[str, ...]) -> Column:
    """``kind:start:end`` by kind, then start."""
    name = F.array(*[F.lit(n) for n in names])
    return F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
