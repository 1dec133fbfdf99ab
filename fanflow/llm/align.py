"""Cross-tokenizer alignment: tokens of two tokenizers over the same bytes, grouped by pointer jumping, and how often ids overlap."""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanflow.llm.common import buffers, pieces, ragged, written

#: Folder of the tokenizers' files, which every executor has, and the files.
TOKENIZERS, BYTE_LEVEL, RANKS, PIECES = "/opt/tokenizers", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Fixed value: how the byte-level tokenizer splits a text before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text that are aligned at once (a longer text alone), and id pairs that one task sums before it passes them on.
CHUNK, SUMMED = 500_000, 1_000_000
#: Id pairs that go to all tasks (about 40 MB); more are joined by shuffle.
SENT = 2_000_000


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level piece stands for: printable ones for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + n): b for n, b in enumerate(rest)}


class Bytes:
    """The bytes of each id of a vocabulary, laid end to end."""

    def __init__(self, of: dict[int, bytes]):
        each = [of.get(k, b"") for k in range(max(of, default=-1) + 1)]
        self.length = np.array([len(x) for x in each], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(each), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        token, place = ragged(self.length[ids])
        return self.flat[self.start[ids][token] + place]


class ByteLevel:
    """Tokenizer A. Texts of characters whose classes have not changed since Unicode 3.2 take the fast encoder of the same merges, all others the tokenizer's own file."""

    def __init__(self, folder: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(f"{folder}/{BYTE_LEVEL}")
        self.slow.encode_special_tokens = True  # their strings in a text are plain text
        byte_of = _byte_of()
        self.bytes = Bytes({n: bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode() for piece, n in self.slow.get_vocab(True).items()})
        self.fast, self.stable = self._fast(folder)

    @staticmethod
    def _fast(folder: str):
        import tiktoken

        with open(f"{folder}/{RANKS}", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        kind = lambda c, of: "?" if of.category(c) in ("Cn", "Cs", "Co") else of.category(c)[0] if of.category(c)[0] in "LN" else "S" if c.isspace() else "-"
        stable = np.array([(k := kind(chr(n), unicodedata)) != "?" and k == kind(chr(n), unicodedata.ucd_3_2_0) for n in range(0x10000)])
        stable[0x1C:0x20] = False  # separators that not every engine takes for white space
        return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), stable

    def __call__(self, text: str) -> np.ndarray:
        units = np.frombuffer(text.encode("utf-16-le"), np.uint16)
        if self.stable[units].all():
            return np.array(self.fast.encode_ordinary(text), np.int64)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """Tokenizer B, which adds the space itself."""

    def __init__(self, folder: str):
        from sentencepiece import SentencePieceProcessor

        self.model = p = SentencePieceProcessor(model_file=f"{folder}/{PIECES}")
        self.bytes = Bytes({n: bytes([int(p.id_to_piece(n)[3:5], 16)]) if p.is_byte(n) else p.id_to_piece(n).replace("▁", " ").encode() for n in range(p.get_piece_size())})

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


@cache
def _both(folder: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(folder), Pieces(folder)


def groups(ends_a: np.ndarray, ends_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the tokens of A and of B, the number of their group: pointers to the farthest-right overlapping token, doubled until they stand.

    ends_*: byte offsets where tokens end; at_*: the token over each byte. A token of A points to B's token over its last
    byte, which ends there or farther right; one of B points to A's over its last byte if that ends farther right, else to
    itself: it is its component's terminal token. Each round makes all pointers reach twice as far, so their number is
    the logarithm of the longest chain.
    """
    n = len(ends_a)
    over = at_a[ends_b - 1]
    to = np.concatenate([n + at_b[ends_a - 1], np.where(ends_a[over] > ends_b, over, n + np.arange(len(ends_b)))])
    while not np.array_equal(far := to[to], to):
        to = far
    number = np.cumsum(to[n:] == n + np.arange(len(ends_b))) - 1
    label = number[to - n]  # of a terminal, which is B's
    return label[:n], label[n:]


_DIGITS = np.zeros((0, 0), np.uint8)


def _digits(ids: int) -> np.ndarray:
    """Row n: n's decimal digits, then zeros."""
    global _DIGITS
    if len(_DIGITS) < ids:
        _DIGITS = np.array([str(n) for n in range(ids)], "S").view(np.uint8).reshape(ids, -1)
        _DIGITS = np.hstack([_DIGITS, np.zeros((ids, 1), np.uint8)])
    return _DIGITS


class Aligned:
    """What a stretch of texts (not empty) has, given both tokenizers' ids laid end to end and how many each text has of them."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, vocab_a: Bytes, vocab_b: Bytes):
        self.a, self.b, self.n_a, self.n_b, self.width = a, b, n_a, n_b, len(vocab_b.length)
        self.ends_a, self.ends_b = np.cumsum(vocab_a.length[a]), np.cumsum(vocab_b.length[b])
        size = int(self.ends_a[-1])
        mark_a, mark_b = np.zeros(size, bool), np.zeros(size, bool)
        mark_a[self.ends_a - 1] = True
        mark_b[self.ends_b - 1] = True
        at_a, at_b = np.cumsum(mark_a) - mark_a, np.cumsum(mark_b) - mark_b
        self.group_a, self.group_b = groups(self.ends_a, self.ends_b, at_a, at_b)
        link = np.flatnonzero(mark_a | mark_b)  # each stretch between two ends is one pair's overlap
        text_a = np.repeat(np.arange(len(n_a)), n_a)
        self.links = text_a[at_a[link]], a[at_a[link]] * self.width + b[at_b[link]]
        last = np.cumsum(n_b) - 1
        self.n_groups = np.diff(self.group_b[last] + 1, prepend=0)
        self.n_links = np.bincount(self.links[0], minlength=len(n_a))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text's id pairs, in ascending order: text, pair (a * width + b) and number of links."""
        order = np.lexsort((self.links[1], self.links[0]))
        text, key = self.links[0][order], self.links[1][order]
        first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1])]))
        return text[first], key[first], np.diff(first, append=len(key))

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups, `a1,a2|b1;a3|b2,b3`."""
        n = int(self.group_b[-1]) + 1
        many_a, many_b = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)
        place_a = np.arange(len(self.a)) + (np.cumsum(many_b) - many_b)[self.group_a]
        place_b = np.arange(len(self.b)) + np.cumsum(many_a)[self.group_b]
        total = len(self.a) + len(self.b)
        ids, sign = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        sign[place_a[np.cumsum(many_a) - 1]] = ord("|")
        sign[place_b[np.cumsum(many_b) - 1]] = ord(";")
        shown = _digits(int(ids.max()) + 1)[ids]
        length = np.count_nonzero(shown, axis=1)
        shown[np.arange(total), length] = sign
        flat = shown[shown > 0].tobytes()
        stop = np.cumsum(length + 1)[np.cumsum(self.n_a + self.n_b) - 1]
        return [hashlib.sha256(flat[s : e - 1]).hexdigest() for s, e in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True)]


def _whole(ids: list[np.ndarray], vocab: Bytes, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text whether its tokens' joined bytes are a space and the text. raw has all of these, text by text."""
    sizes = np.array([int(vocab.length[x].sum()) for x in ids])
    same = sizes == np.diff(offsets)
    if not same.any():
        return same
    some = np.flatnonzero(same)
    joined = vocab.joined(np.concatenate([ids[k] for k in some]))
    text, place = ragged(sizes[some])
    same[some[np.unique(text[joined != raw[offsets[some][text] + place]])]] = False
    return same


_COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<int>"


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, links) of each row of docs; pairs are a * (ids of B) + b, links how many of each.

    Null and empty texts, and those whose tokens' joined bytes are not a space and the text, have zeros and no pairs.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, encode_b = _both(folder)
        for part, data, offsets in pieces(batches, "text", CHUNK):
            some = np.flatnonzero(np.diff(offsets) > 0)
            texts = [part.column("text")[k].as_py() for k in some.tolist()]
            a, b = [encode_a(" " + t) for t in texts], encode_b(texts) if texts else []
            raw, cut = buffers(pa.array([" " + t for t in texts], pa.large_string()))
            keep = np.flatnonzero(_whole(a, encode_a.bytes, raw, cut) & _whole(b, encode_b.bytes, raw, cut)) if texts else some[:0]
            counts, digest = np.zeros((4, part.num_rows), np.int64), [""] * part.num_rows
            text, key, links = (np.zeros(0, np.int64),) * 3
            if len(keep):
                n_a, n_b = (np.array([len(x[k]) for k in keep]) for x in (a, b))
                found = Aligned(np.concatenate([a[k] for k in keep]), np.concatenate([b[k] for k in keep]), n_a, n_b, encode_a.bytes, encode_b.bytes)
                counts[:, some[keep]] = n_a, n_b, found.n_groups, found.n_links
                for k, d in zip(some[keep].tolist(), found.digests(), strict=True):
                    digest[k] = d
                text, key, links = found.pairs()
                text = some[keep][text]
            to = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(to, pa.array(x)) for x in (key, links.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([part.column("id"), *map(pa.array, counts), pa.array(digest, pa.string()), *lists], ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, {_COLUMNS}")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column end to end, and each row's offsets in them."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count) of all rows' pairs: summed in each task before the shuffle."""

    def summed(keys: list[np.ndarray], links: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(where, np.concatenate(links), len(key)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, links, fresh, least = [], [], 0, SUMMED
        for b in batches:
            keys.append(_flat(b.column(0))[0])
            links.append(_flat(b.column(1))[0])
            fresh += len(keys[-1])
            if fresh > least:
                key, n = summed(keys, links)
                if len(key) > SUMMED:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["pair", "n"])
                    keys, links, fresh = [], [], 0
                else:
                    keys, links, fresh, least = [key], [n], 0, max(SUMMED, len(key))
        if keys:
            key, n = summed(keys, links)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["pair", "n"])

    return rows.select("pairs", "links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("count"))


def token_map(rows: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """(a, b, pair, count, best): of the corpus's id pairs in rows (see aligned()), whether the count is its B id's highest, ties included."""
    width = len(_both(folder)[1].bytes.length)
    counts = written(pair_counts(rows), "align-counts")
    counts = counts.select(F.floor(F.col("pair") / width).alias("a"), (F.col("pair") % width).alias("b"), "pair", "count")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "pair", "count", (F.col("count") == F.col("most")).alias("best"))


def scored(rows: DataFrame, table: DataFrame, sent: int = SENT) -> DataFrame:
    """rows (see aligned()) with n_best and count_sum in place of pairs and links. A table of up to sent pairs goes to all tasks."""
    columns = ["id", "n_a", "n_b", "n_groups", "n_links"]
    kind = rows.schema["id"].dataType.simpleString()
    if table.count() > sent:
        rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "align-rows")
        each = rows.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select("row", "p.pairs", "p.links")
        sums = each.join(table, each["pairs"] == table["pair"]).groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("count")).alias("count_sum"))
        return rows.join(sums, "row", "left").select(*columns, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
    all_pairs = table.select("pair", "count", "best").toArrow().sort_by("pair")
    pair, count, best = (all_pairs.column(c).to_numpy() for c in ("pair", "count", "best"))
    held = rows.sparkSession.sparkContext.broadcast((pair, count, best.astype(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = held.value
        for b in batches:
            (keys, offsets), (links, _) = _flat(b.column("pairs")), _flat(b.column("links"))
            at, links = np.searchsorted(pair, keys), links.astype(np.int64)
            sums = []
            for x in (np.where(best[at], links, 0), links * count[at]):
                total = np.concatenate([[0], np.cumsum(x)])
                sums.append(pa.array(total[offsets[1:]] - total[offsets[:-1]]))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), *sums, b.column("groups_sha256")], [*columns, "n_best", "count_sum", "groups_sha256"])

    return rows.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """One row for each row of docs: (id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    Both tokenizers encode a space and the text, without special tokens. Offsets where tokens of both end cut the tokens
    into groups; a link is a pair of tokens whose bytes overlap. n_best counts the links whose id pair is the commonest
    of its B id in all docs (ties included), count_sum sums the pairs' counts in all docs over the links. Texts that are null
    or empty, or that a tokenizer doesn't give back, have zeros and an empty digest. Repeated rows and ids stay and count
    each time; null ids stay; other columns are left out; an empty table gives none. Texts are encoded once: what is
    found in them is written to the shared folder and read twice.
    """
    rows = written(aligned(docs, id_col, text_col, folder), "align-rows")
    return scored(rows, written(token_map(rows, folder), "align-map")).withColumnRenamed("id", id_col)


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns for all documents."""
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
