"""Language identification by hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanflow.llm.common import crc_mod, pieces

#: Symbols: 0 is any run of what is no letter, a-z have one each, other letters share the rest by their code point.
SYMBOLS = 128
#: Training weight of a document, shared among its trigrams, in whole units so that sums don't depend on their order.
UNITS = 2**24
#: More labels than this aren't languages: fit() refuses them, as prototypes go to every task.
MAX_LANGUAGES = 4096
UNKNOWN = "und"


@cache
def _symbol_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            low = ord(s.lower()[0])
            table[c] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 7) % (SYMBOLS - 27)
    return table


@cache
def _letters(dims: int) -> np.ndarray:
    """Random +1/-1 vector of each symbol, and its permutations (rotations) for the three places of a trigram."""
    base = np.random.default_rng(20240229).integers(0, 2, (SYMBOLS, dims), np.int8) * 2 - 1
    return np.stack([np.roll(base, 2, 1), np.roll(base, 1, 1), base])


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and code of each trigram, and which documents have a letter. Ends of a text count as no letter."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), lengths)
    symbols = np.zeros(len(codes) + 2 * len(texts), np.int32)
    symbols[np.arange(len(codes)) + 2 * doc + 1] = _symbol_table()[codes]
    doc = np.repeat(np.arange(len(texts)), lengths + 2)
    kept = symbols != 0
    letters = np.bincount(doc[kept], minlength=len(texts)) > 0
    kept[1:] |= symbols[:-1] != 0
    kept[np.cumsum(lengths + 2) - lengths - 2] = True
    symbols, doc = symbols[kept], doc[kept]
    whole = doc[:-2] == doc[2:]
    return doc[:-2][whole], ((symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:])[whole], letters


def _bound(codes: np.ndarray, dims: int) -> np.ndarray:
    """The vector of each trigram: its letters' vectors, permuted by place and multiplied."""
    at = _letters(dims)
    return (at[0][codes // SYMBOLS**2] * at[1][codes // SYMBOLS % SYMBOLS] * at[2][codes % SYMBOLS]).astype(np.float32)


def _dense(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, and each code's place among them, without sorting."""
    seen = np.zeros(SYMBOLS**3, bool)
    seen[codes] = True
    distinct = np.flatnonzero(seen)
    place = np.zeros(SYMBOLS**3, np.int32)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[codes]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dims: int = 1024) -> dict[str, np.ndarray]:
    """Prototype (unit vector) of each language: the bundle of the trigram vectors of all its texts, each text with equal weight.

    Rows with a null language are left out; texts that are null or have no letter add nothing. Partial bundles leave
    each partition as one row for each language and are summed by dimension; the driver gets languages x dims numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundles: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            values = np.array(list(bundles.values()))
            return pa.RecordBatch.from_arrays([pa.array(list(bundles), pa.string()), pa.array(list(values), pa.list_(pa.int64()))], ["lang", "bundle"])

        for b, _, _ in pieces(batches, "text"):
            doc, codes, _ = _trigrams(b.column("text").fill_null("").to_pylist())
            if not len(doc):
                continue
            langs, lang_of = np.unique(np.array(b.column("lang").to_pylist(), object), return_inverse=True)
            distinct, place = _dense(codes)
            share = 1 / np.maximum(1, np.bincount(doc, minlength=b.num_rows))
            weight = np.bincount(lang_of[doc] * len(distinct) + place, share[doc], len(langs) * len(distinct)).reshape(len(langs), -1)
            weight = np.rint(weight * UNITS)
            for at in range(0, len(distinct), 4096):
                part = weight[:, at : at + 4096] @ _bound(distinct[at : at + 4096], dims).astype(np.float64)
                for lang, v in zip(langs, part, strict=True):
                    bundles[lang] = bundles.get(lang, 0) + np.rint(v).astype(np.int64)
            if len(bundles) > 256:
                yield out()
                bundles.clear()
        if bundles:
            yield out()

    rows = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    parts = rows.mapInArrow(run, "lang string, bundle array<bigint>").select("lang", F.posexplode("bundle").alias("dim", "v"))
    sums = parts.groupBy("lang", "dim").agg(F.sum("v").alias("v")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("dim", "v"))).alias("v"))
    found = sums.select("lang", F.col("v.v").alias("v")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has over {MAX_LANGUAGES} values")
    return {r.lang: v / (np.linalg.norm(v) or 1) for r in sorted(found, key=lambda r: r.lang) for v in [np.array(r.v, np.float64)]}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) for each row of docs: the language of the prototype with the largest cosine, and that cosine (0 at least).

    Ties go to the first language in code point order. A text that is null, empty or has no letter, and any text when
    nothing was learned, is `und` with score 0. Whole texts count; rows aren't shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = sorted(prototypes)
    table = np.array([prototypes[k] for k in names], np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, _ in pieces(batches, "text"):
            n = b.num_rows
            doc, codes, letters = _trigrams(b.column("text").fill_null("").to_pylist())
            best, score = np.zeros(n, np.int64), np.zeros(n)
            if len(doc) and names:
                distinct, place = _dense(codes)
                vectors = np.zeros((n, table.shape[1]), np.float32)
                step = max(1, 4_000_000 // n)
                for at in range(0, len(distinct), step):
                    here = (place >= at) & (place < at + step) if len(distinct) > step else slice(None)
                    width = min(step, len(distinct) - at)
                    counts = np.bincount(doc[here] * width + (place[here] - at), minlength=n * width).reshape(n, width)
                    vectors += counts.astype(np.float32) @ _bound(distinct[at : at + step], table.shape[1])
                cosine = (vectors @ table.T) / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                best, score = cosine.argmax(1), np.clip(cosine.max(1).astype(np.float64), 0, 1)
            known = letters & bool(names)
            said = [names[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(said, pa.string()), pa.array(np.where(known, score, 0.0))], ["id", "lang_pred", "score"])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns: doc_id, held_out, lang_pred, score; learned from the rows that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prototypes = fit(docs.filter(crc_mod("doc_id", 3) != 1))
    found = identify(docs, prototypes)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
