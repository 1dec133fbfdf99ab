"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters; each pair verified once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanflow.llm.common import written
from fanflow.llm.components import components
from fanflow.llm.sets import distinct_sets, join_links, named, prefixes


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, likeness: float = 0.9) -> DataFrame:
    """One row for each row of docs: (id_col, n: distinct n-grams, component: the smallest id that links reach, itself included).

    Rows whose sets of word n-grams (A-Z lower-cased) have a Jaccard likeness of likeness or more link, all of them and no others, as far
    as their components show; n-grams and sets are told apart by 64-bit hashes. A text of fewer words is one n-gram. Null,
    empty and wordless texts link with nothing: each is its own component. Null ids keep their row, and are a component's
    smallest only where it has no other; rows of equal ids are rows of their own, other columns are left out, and an
    empty table gives none. docs is read up to four times.
    """
    rows = written(prefixes(docs, id_col, text_col, words, likeness), "ngrams-prefixes")
    some = rows.filter("n > 0")
    distinct = written(distinct_sets(some), "ngrams-distinct")
    roots = components(join_links(distinct, docs, text_col, words, likeness))
    found = named(some.select("id", "fp"), distinct.select("fp", "least"), roots).join(distinct.select("fp", "n"), "fp").select("id", "n", "component")
    return found.unionByName(rows.filter("n = 0").select("id", "n", F.col("id").alias("component"))).withColumnRenamed("id", id_col)


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns for all documents: doc_id, n_shingles, component_id."""
    found = jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


OP13_SQL = r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM t),
f AS (SELECT r, id, s, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS fp FROM s),
c AS (SELECT fp, any_value(s) AS s, any_value(n) AS n, min(id) AS least FROM f WHERE n > 0 GROUP BY fp),
x AS (SELECT fp, n, unnest(s) AS g FROM c),
l AS (SELECT a.fp AS a, b.fp AS b FROM x a JOIN x b ON a.g = b.g AND a.fp <> b.fp AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
      GROUP BY a.fp, b.fp, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT fp AS a, fp AS b FROM c UNION SELECT e.a, l.b FROM e JOIN l ON l.a = e.b),
m AS (SELECT e.a, min(c.least) AS component_id FROM e JOIN c ON c.fp = e.b GROUP BY e.a)
SELECT f.id AS doc_id, f.n AS n_shingles, CASE WHEN f.n = 0 THEN f.id ELSE m.component_id END AS component_id FROM f LEFT JOIN m ON m.a = f.fp
"""
