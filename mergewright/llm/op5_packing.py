"""Packing of documents into training sequences along a space-filling curve.

A document's hashed token vector is projected to four dimensions; its place on a Hilbert curve is its sort key.
Documents are range-sorted by the key (ties by row, so one hot key spreads), laid end to end along the curve and cut
every `seq_len` tokens; what remains at the end is cut into powers of two. So only neighbours share sequences and
nothing is padded. Only narrow rows are sorted; token ids move once, to meet their place.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import by_value
from .common import n_shuffle, small_batches, stash, tidy

by_value(__name__)

DIMS, BITS = 4, 10
TOKENS = "uid long, doc_id long, key long, n long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str | None):
    """The byte-level BPE of byte_bpe_50k.json, by its ranks: the same ids (tested), four times as fast. encode_ordinary takes
    strings of added tokens as text; encode_added gives them their ids, as the tokenizer does with its default settings."""
    import public_tokenizers
    import tiktoken

    path = path or vocabulary_path()
    with open(os.path.splitext(path)[0] + ".json", encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


def encode_added(enc, text: str) -> list[int]:
    """The ids of text, which is split at added tokens first."""
    return enc.encode(text, allowed_special="all")


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows, dimensions) below 2**bits, by Skilling's transform (2004)."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def tokenised(docs: DataFrame, path: str | None = None) -> DataFrame:
    """uid (unique), doc_id, key, n and ids (unsigned, of 16 bits or, for larger vocabularies, 32; with the closing 0) of each row."""

    def run(batches):
        from pyspark import TaskContext

        enc = encoder(path)
        table = np.random.default_rng(5).standard_normal((enc.max_token_value + 1, DIMS)).astype(np.float32)
        kind = np.uint16 if enc.max_token_value < 1 << 16 else np.uint32
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, n, at = [], [], []
            for text in batch.column(1).to_pylist():
                got = np.array(encode_added(enc, text) if text else [], kind)
                c = table[got].sum(0) / np.sqrt(max(1, len(got)) * 40.0) if len(got) else np.zeros(DIMS)
                at.append(np.tanh(c))
                n.append(len(got) + 1)
                ids.append(np.append(got, kind(0)).tobytes())
            grid = np.clip((np.array(at).reshape(-1, DIMS) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            rows = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + rows)), batch.column(0), pa.array(hilbert_key(grid)), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                ["uid", "doc_id", "key", "n", "ids"],
            )
            uid += rows

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(tidy(run), TOKENS)


def tail_cuts(total: int, seq_len: int) -> list[int]:
    """Where the sequences after the last full one start: what remains, in powers of two."""
    at, cuts = total - total % seq_len, []
    for b in range((total % seq_len).bit_length() - 1, -1, -1):
        if (total % seq_len) >> b & 1:
            cuts.append(at)
            at += 1 << b
    return cuts


def pack(docs: DataFrame, seq_len: int = 1024, path: str | None = None) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text has the one id 0. Rows with null or repeated doc_id are documents like others. An empty table
    gives an empty result; columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tokens = stash(tokenised(docs, path), "tokens")

    def running(batches):
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            ends = at + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n), pa.array(n)], ["uid", "part", "at", "n"]
            )
            at = int(ends[-1]) if len(n) else at

    order = tokens.select("key", "uid", "n").repartitionByRange(n_shuffle(spark), "key", "uid").sortWithinPartitions("key", "uid")
    places = stash(order.select("uid", "n").mapInArrow(tidy(running), "uid long, part int, at long, n long"), "places")
    # One row for each partition of the sort.
    sums = {r.part: r.n for r in places.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    firsts, total = {}, 0
    for part in sorted(sums):
        firsts[part] = total
        total += sums[part]
    cuts = tail_cuts(total, seq_len)
    full = total // seq_len
    body = full * seq_len

    def cut(batches):
        for batch in batches:
            out = []
            for doc, part, at, n, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "at", "n", "ids")), strict=True):
                u32 = np.frombuffer(ids, np.uint16 if len(ids) == 2 * n else np.uint32).astype("<u4")
                pos, done = firsts[part] + at, 0
                while done < n:
                    if pos < body:
                        seq, begin = divmod(pos, seq_len)
                        end = pos - begin + seq_len
                    else:
                        k = bisect_right(cuts, pos) - 1
                        seq, begin = full + k, pos - cuts[k]
                        end = cuts[k + 1] if k + 1 < len(cuts) else total
                    length = min(n - done, end - pos)
                    out.append((doc, done, length, zlib.crc32(u32[done : done + length]), n, seq, begin))
                    done, pos = done + length, pos + length
            cols = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], PIECES.replace(" long", "").split(", "))

    return tokens.select("uid", "doc_id", "ids").join(places, "uid").select("doc_id", "part", "at", "n", "ids").mapInArrow(tidy(cut), PIECES)


def op5_hilbert_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
