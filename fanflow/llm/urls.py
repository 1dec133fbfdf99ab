"""URL filter: rules first, then naive Bayes over words that a unigram Viterbi finds in hosts and paths."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fanflow.llm.common import written

#: Rules (verdict, host/path prefix).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Letters up to which words and names are their own keys in joins (longer ones go by their MD5), and rows of a table that is sent to every task.
PLAIN, SMALL_TABLE = 32, 200_000
_A, _Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column; both empty for null and without `://`."""
    part = lambda k: F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), _A, _Z), part(2)


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule whose host is the URL's or a parent of it and whose path begins the URL's; else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, prefix = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _small(df: DataFrame) -> DataFrame:
    """df for a join: sent to every task if its counted rows are few."""
    return F.broadcast(df) if df.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE else df


def page_words(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, c) of all letter runs in the pages' text, tags left out, lower-cased."""
    text = F.lower(F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), "<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, "[^\\p{L}]+")).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("c"))


def _key(text: str) -> str:
    return text if len(text) <= PLAIN else "#" + hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()


def _key_of(column: str) -> Column:
    return F.when(F.char_length(column) <= PLAIN, F.col(column)).otherwise(F.concat(F.lit("#"), F.md5(F.col(column).cast("binary"))))


def viterbi(name: str, cost: dict[str, float], total: int, lengths: list[int] | None = None) -> list[str]:
    """The likeliest split of a name into words, given by _key(); a part that is no known word of n letters has probability 1 / (10^n (total + 1)).

    lengths are those of the known words (by default, of the keys). Work grows with the name's length times their number.
    """
    lengths = sorted({len(k) for k in cost}) if lengths is None else sorted(lengths)
    unknown, letter = math.log(total + 1), math.log(10)
    best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
    lead, start = 0.0, 0  # the best place for an unknown part to start
    for e in range(1, len(name) + 1):
        if best[e - 1] - letter * (e - 1) < lead:
            lead, start = best[e - 1] - letter * (e - 1), e - 1
        best[e], back[e] = lead + letter * e + unknown, start
        for n in lengths:
            if n > e:
                break
            c = cost.get(_key(name[e - n : e]))
            if c is not None and best[e - n] + c < best[e]:
                best[e], back[e] = best[e - n] + c, e - n
    words, e = [], len(name)
    while e:
        words.append(name[back[e] : e])
        e = back[e]
    return words[::-1]


def segments(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, parts) of distinct names: substrings of each name meet the word counts by a join, then a helper splits the name.

    No vocabulary is held: a name brings its own possible words, of all lengths that words have, so its rows grow with its
    length times the number of such lengths (which alone go to the driver). Names of no letter aren't expected here.
    """
    words = written(words.select(_key_of("word").alias("word"), "c", F.char_length("word").alias("n")), "url-words")
    by_length = words.groupBy("n").agg(F.sum("c").alias("c")).collect()
    total, lengths = sum(r.c for r in by_length), sorted(r.n for r in by_length)
    keyed = names.select(_key_of("name").alias("key"), "name")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, name in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for n in lengths:
                    if n > len(name):
                        break
                    found = {_key(name[i : i + n]) for i in range(len(name) - n + 1)}
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(found)), pa.array(sorted(found))], ["key", "word"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in cut(batches):
            held.append(b)
            rows += b.num_rows
            if rows > 10_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    known = keyed.mapInArrow(merged, "key string, word string").join(words, "word").groupBy("key").agg(F.collect_list(F.struct("word", "c", "n")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [viterbi(n, {k["word"]: -math.log(k["c"] / total) for k in known or []}, total, list({k["n"] for k in known or []})) for n, known in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(parts, pa.list_(pa.string()))], ["name", "parts"])

    return keyed.join(known, "key", "left").select("name", "known").mapInArrow(run, "name string, parts array<string>")


def judge(pages: DataFrame, url_col: str = "url", html_col: str = "html", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row for each distinct URL (null too): (url, host, path, rule, verdict, score).

    The verdict is the longest fitting rule's; else block if score > 0. score is the log odds of block by multinomial
    naive Bayes, learned from the pages whose URLs a rule judges (repeats counted, add-one smoothing), over the words
    of the host and of the path; digits count as a token by their number. Without any rule-judged page score is 0 and the
    verdict allow. URLs without tokens have the prior's odds.
    """
    host, path = host_and_path("url")
    urls = pages.groupBy(F.col(url_col).alias("url")).agg(F.count(F.lit(1)).alias("n"))
    urls = urls.withColumn("host", host).withColumn("path", path).withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    urls = written(urls.select("url", "n", "host", "path", "found.rule", F.col("found.verdict").alias("said"), F.xxhash64("url").alias("key")), "url-parts")
    split = lambda c: F.split(F.translate(F.col(c), _A, _Z), "[^\\p{L}\\p{N}]+|(?<=\\p{L})(?=\\p{N})|(?<=\\p{N})(?=\\p{L})")
    tagged = lambda c: F.transform(split(c), lambda x: F.struct(F.lit(c[0]).alias("of"), x.alias("name")))
    names = F.concat(tagged("host"), tagged("path"))
    each = urls.filter("host <> '' or path <> ''").select("url", "key", "n", "said", F.explode(names).alias("t")).select("url", "key", "n", "said", "t.of", "t.name").filter("name <> ''")
    letters = F.col("name").rlike("^\\p{L}")
    split_names = written(segments(each.filter(letters).select("name").distinct(), page_words(pages, html_col)), "url-names")
    parts = F.when(letters, F.col("parts")).otherwise(F.array(F.concat(F.lit("#"), F.char_length("name").cast("string"))))
    tokens = each.join(_small(split_names), "name", "left").select("url", "key", "n", "said", "of", F.explode(parts).alias("part"))
    tokens = written(tokens.select("url", "key", "n", "said", F.concat_ws(":", "of", "part").alias("token")), "url-tokens")
    by_class = [F.coalesce(F.sum(F.when(F.col("said") == v, F.col("n"))), F.lit(0)).alias(v) for v in ("block", "allow")]
    counts = tokens.groupBy("token").agg(*by_class)
    totals = counts.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count(F.lit(1)).alias("v")).first()
    prior = urls.agg(*by_class).first()
    if not ((prior.block or 0) + (prior.allow or 0)):
        return urls.select("url", "host", "path", "rule", F.coalesce("said", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))
    start = math.log((prior.block + 1) / (prior.allow + 1))
    size = totals.v or 0
    odds = F.log((F.col("block") + 1.0) / float((totals.block or 0) + size + 1)) - F.log((F.col("allow") + 1.0) / float((totals.allow or 0) + size + 1))
    sums = tokens.join(_small(counts.select("token", odds.alias("odds"))), "token").groupBy("url", "key").agg(F.sum(F.round("odds", 9).cast("decimal(20,9)")).alias("odds"))
    sums = sums.select(F.col("url").alias("u"), "odds")
    score = F.lit(start) + F.coalesce(F.col("odds").cast("double"), F.lit(0.0))
    both = urls.join(sums, F.col("url") == F.col("u"), "left").withColumn("score", score)
    return both.select("url", "host", "path", "rule", F.coalesce("said", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns for every page: page_id, host, path, rule, verdict, and the score."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    said = written(judge(pages), "url-judged").withColumnRenamed("url", "u")
    rows = pages.select("page_id", "url").join(said, F.col("url").eqNullSafe(F.col("u")))
    return rows.select("page_id", "host", "path", "rule", "verdict", "score")
