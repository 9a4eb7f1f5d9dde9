"""URL filter: rules first, then a word model of hosts and paths.

Names such as ``cheappills`` are split into words by a Viterbi search over
a unigram model (counts of all words in the pages' own markup and a fixed
list of web words). The words of host and path feed a multinomial naive
Bayes that is learned from two fixed lists of labelled names, segmented the
same way. Words that no labelled name holds are no evidence.

The model has no size limit and is never held in one place: every distinct
name meets, in a join, the counts of those words that are part of it (at most
its length times ``LONGEST_WORD``), is split once, and its words go back to
the urls that hold it. Frequent names, words and urls are salted.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillens.llm.common import release, staged
from maillens.operators.joins import hot_keys, salted

LONGEST_WORD = 24       # letters of a word that a name is split into, at most
SMOOTH = 0.5
PRIOR = 0.2             # share of blocked names

# The rules, longest match wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))

# Labelled names that teach the block class.
BLOCKED_NAMES = (
    "casinowin", "onlinecasino", "casinobonus", "pokerwin", "bestcasino", "slotsbonus", "freebet",
    "betwin", "cheappills", "pillsonline", "cheapviagra", "buypills", "pharmacycheap", "dietpills",
    "spamfarm", "linkfarm", "clickfarm", "spamlinks", "adultx", "xadult", "adultvideo", "xxxvideo",
    "adultchat", "sexcam", "hotadult", "payday", "paydayloan", "cheaploan", "fastloan", "replicawatch",
    "warezcrack", "crackserial", "getrichfast", "freemoney", "winmoney", "lottowin")
# Labelled names that teach the allow class.
ALLOWED_NAMES = (
    "dailynews", "worldnews", "localnews", "sportnews", "techblog", "foodblog", "travelblog", "musicblog",
    "openwiki", "gamewiki", "codedocs", "opendocs", "onlineshop", "bookshop", "gamestore", "musicstore",
    "webmail", "homepage", "mysite", "schoolhealth", "schoolonline", "publiclibrary", "openlibrary",
    "healthfood", "healthcare", "bestfood", "besttravel", "worldtravel", "freecode", "opendata",
    "datacloud", "cloudstore", "videogames", "fasttrack", "watchmaker", "farmfood", "linklibrary",
    "loanlibrary", "cheaptravel", "winter")
# Words that names are made of.
WEB_WORDS = (
    "casino win online bonus poker slots free bet cheap pills viagra buy pharmacy diet spam farm link "
    "links click adult x video xxx chat sex cam hot payday loan fast replica watch warez crack serial "
    "get rich money lotto best news blog wiki docs shop store mail web site home page world daily "
    "times school library health travel food music game games sport tech data cloud open code").split()
_WEB_COUNT = 50

_TOKEN = re.compile(r"[^\W_]+")


class Words:
    """Unigram model: log-probabilities of known words, a length penalty else.
    ``total`` counts all words, also those not in ``counts``."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = total or sum(counts.values()) or 1
        self.logp = {w: math.log(n / total) for w, n in counts.items()}
        self.unknown = math.log(10.0 / total)

    def split(self, name: str) -> list[str]:
        """Most probable words of a name (ties: the longer last word)."""
        best, cut = [0.0], [0]
        for end in range(1, len(name) + 1):
            top, at = -math.inf, end - 1
            for begin in range(max(0, end - LONGEST_WORD), end):
                word = name[begin:end]
                p = self.logp.get(word, self.unknown - math.log(10.0) * len(word))
                if best[begin] + p > top:
                    top, at = best[begin] + p, begin
            best.append(top)
            cut.append(at)
        words: list[str] = []
        end = len(name)
        while end:
            words.append(name[cut[end]:end])
            end = cut[end]
        return words[::-1]

    def tokens(self, host: str, path: str) -> list[str]:
        """Words of all host labels and path parts; numbers count as ``0``."""
        out = []
        for part in _TOKEN.findall(f"{host} {path}".lower()):
            out += ["0"] if part.isdigit() else self.split(part)
        return out


class Judge:
    """Multinomial naive Bayes: log-odds of block against allow."""

    def __init__(self, block: dict[str, int], allow: dict[str, int]):
        vocabulary = set(block) | set(allow)
        size = SMOOTH * len(vocabulary)
        b, a = sum(block.values()) + size, sum(allow.values()) + size
        self.odds = {t: math.log((block.get(t, 0) + SMOOTH) / b) - math.log((allow.get(t, 0) + SMOOTH) / a)
                     for t in vocabulary}
        self.prior = math.log(PRIOR / (1 - PRIOR))

    def log_odds(self, tokens: list[str]) -> float:
        return self.prior + sum(self.odds.get(t, 0.0) for t in tokens)


def parts(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path); both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), upper, upper.lower()),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def decided(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(longest fitting rule as ``host/path``, its verdict); null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _name_counts(words: Words, names: tuple[str, ...]) -> dict[str, int]:
    counts: dict[str, int] = {}
    for name in names:
        for t in words.split(name):
            counts[t] = counts.get(t, 0) + 1
    return counts


def word_counts(pages: DataFrame) -> DataFrame:
    """(w, n) of all words of two or more letters in the markup of ``pages(html)``."""
    word = F.explode(F.regexp_extract_all(F.lower(F.coalesce("html", F.lit(""))), F.lit(r"\p{L}{2,}+"), F.lit(0)))
    return pages.select(word.alias("w")).groupBy("w").agg(F.count("*").alias("n"))


def _floor(counts: dict[str, int], total: int) -> dict[str, int]:
    """``counts`` with the web words at a usual count at least."""
    usual = max(_WEB_COUNT, total // 20_000)
    return counts | {w: max(counts.get(w, 0), usual) for w in WEB_WORDS}


def _labelled(words: Words) -> Judge:
    return Judge(_name_counts(words, BLOCKED_NAMES), _name_counts(words, ALLOWED_NAMES))


def fit(pages: DataFrame) -> tuple[Words, Judge]:
    """Both models of a small table in one place (to look at; ``judge_urls``
    keeps the counts distributed)."""
    counts = {r["w"]: r["n"] for r in word_counts(pages).collect()}
    total = sum(counts.values())
    words = Words(_floor(counts, total), max(1, total))
    return words, _labelled(words)


def _substrings(name: Column) -> Column:
    """All distinct pieces of a name of up to ``LONGEST_WORD`` characters."""
    n = F.length(name)
    pieces = F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), n - i + 1)), lambda k: F.substring(name, i, k)))
    return F.array_distinct(F.flatten(pieces))


def _met(left: DataFrame, key: str, right: DataFrame, how: str) -> DataFrame:
    """``left`` joined with ``right`` (unique by ``key``), hot keys salted."""
    hot = hot_keys(left, key)
    if not hot:
        return left.join(right, key, how)
    spread, copied = salted(left, key, hot, right.withColumnRenamed(key, "__key"), "__key")
    on = (spread[key] == copied["__key"]) & (spread["__salt"] == copied["__salt"])
    return spread.join(copied, on, how).drop("__key", "__salt")


def _split(judge: Judge, total: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, known words) to (name, words, odds), each name with its own counts."""
    for batch in batches:
        names = batch.column(0).to_pylist()
        split = []
        for name, known in zip(names, batch.column(1).to_pylist(), strict=True):
            counts = _floor({k["w"]: k["n"] for k in known}, total)
            split.append(Words(counts, max(1, total)).split(name))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(split, pa.list_(pa.string())),
             pa.array([sum(judge.odds.get(t, 0.0) for t in ts) for ts in split], pa.float64())],
            names=["name", "parts", "odds"])


def _segmented(counts: DataFrame, total: int, judge: Judge, names: DataFrame) -> DataFrame:
    """(name, parts, odds) of distinct names."""
    pieces = names.select("name", F.explode(_substrings(F.col("name"))).alias("w")).where("length(w) > 1")
    known = (_met(pieces, "w", counts, "inner").groupBy("name")
             .agg(F.collect_list(F.struct("w", "n")).alias("known")))       # at most length x LONGEST_WORD
    none = F.array().cast("array<struct<w:string,n:bigint>>")
    return (names.join(known, "name", "left").select("name", F.coalesce("known", none).alias("known"))
            .mapInArrow(partial(_split, judge, total), "name string, parts array<string>, odds double"))


def judge_urls(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html, ...)`` judged: ``page_id, host, path, rule,
    verdict, words, log_odds`` (natural log of block against allow).

    The verdict is the longest rule's, else ``block`` when the log-odds are
    positive and ``allow`` otherwise (so without evidence, and for null urls
    or urls without ``://``, whose host and path are empty). Numbers count as
    ``0``. Null html teaches nothing; repeated rows give repeated rows; other
    columns are ignored; an empty table gives an empty one.
    """
    spark = pages.sparkSession
    counts, count_path = staged(word_counts(pages), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    taught = {name[i:j] for name in BLOCKED_NAMES + ALLOWED_NAMES
              for i in range(len(name)) for j in range(i + 2, min(len(name), i + LONGEST_WORD) + 1)}
    few = F.broadcast(spark.createDataFrame([(w,) for w in sorted(taught)], "w string"))   # pieces of the fixed lists
    own = {r["w"]: r["n"] for r in counts.join(few, "w").collect()}
    judge = _labelled(Words(_floor(own, total), max(1, total)))

    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", F.xxhash64("host", "path"))
    token = F.regexp_extract_all(F.lower(F.concat_ws(" ", "host", "path")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    held, held_path = staged(rows.dropDuplicates(["key"]).select("key", F.posexplode(token).alias("pos", "name")),
                             "url-names")
    digits = F.col("name").rlike(r"\A\p{Nd}+\z")
    split, split_path = staged(_segmented(counts.where(F.length("w") <= LONGEST_WORD), total, judge,
                                          held.where(~digits).select("name").distinct()), "url-words")
    number = F.array(F.lit("0"))
    found = _met(held.where(~digits), "name", split, "inner").select("key", "pos", "parts", "odds").unionByName(
        held.where(digits).select("key", "pos", number.alias("parts"), F.lit(judge.odds.get("0", 0.0)).alias("odds")))
    listed = F.array_sort(F.collect_list(F.struct("pos", "parts", "odds")))       # the names of one url
    judged, _ = staged(found.groupBy("key").agg(listed.alias("l")).select(
        "key", F.array_join(F.flatten(F.transform("l", lambda x: x["parts"])), " ").alias("words"),
        F.aggregate("l", F.lit(judge.prior), lambda a, x: a + x["odds"]).alias("log_odds")), "url-verdicts")
    release(spark, count_path, held_path, split_path)
    rule, verdict = decided(F.col("host"), F.col("path"))
    scored = _met(rows, "key", judged, "left")
    log_odds = F.coalesce("log_odds", F.lit(judge.prior))
    by_model = F.when(log_odds > 0, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, by_model).alias("verdict"),
                         F.coalesce("words", F.lit("")).alias("words"), log_odds.alias("log_odds"))
