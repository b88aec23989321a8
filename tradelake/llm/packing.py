"""Vector bin packing of documents into training sequences.

Documents are tokenised and cut into pieces of at most one sequence.  A full
piece is a sequence of its own; the rest is packed by the dot-product
heuristic: the open sequence takes, again and again, the piece whose demand
vector (tokens, segments, loss-bearing tokens) has the largest dot product with
what the sequence still has room for, each dimension weighted by its total
demand.  Pieces are dealt at random into groups of about ``group_size``, and
each group is packed by one task, so memory is bounded and the padding of a
group's last sequences is a small share.

Defined results: a null text counts as empty and gives one piece, the end id;
null ids and repeated rows are packed like any other row; an item that alone
exceeds a limit raises an error; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import stored


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048


class PieceEncoder:
    """Ids of the byte-level BPE as little-endian 32-bit bytes.

    Words are cut off at single blanks and line ends, where the tokenizer's
    pattern always cuts, and their ids are kept in a bounded cache; texts with
    two blanks in a row go to the tokenizer whole, and so do texts that hold
    its special token, through the ``tokenizers`` library itself."""

    SPECIAL = "<|endoftext|>"
    TWO_BLANKS = re.compile(r"\s\s")
    CACHED = 300_000

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        self.path = public_tokenizers.path(f"{vocabulary}.json")
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN,
                                     mergeable_ranks=ranks, special_tokens={})
        self.full = None
        self.cache: dict[str, bytes] = {}
        self.line_end = self.plain("\n")

    def plain(self, text: str) -> bytes:
        return np.array(self.bpe.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.SPECIAL in text:
            if self.full is None:
                from tokenizers import Tokenizer
                self.full = Tokenizer.from_file(self.path)
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if "\0" in text or self.TWO_BLANKS.search(text):
            return self.plain(text)
        out, cache = [], self.cache
        for n, line in enumerate(text.split("\n")):
            if n:
                out.append(self.line_end)
            for word in line.replace(" ", "\0 ").split("\0"):
                ids = cache.get(word)
                if ids is None:
                    ids = self.plain(word)
                    if len(word) <= 64:
                        if len(cache) >= self.CACHED:
                            cache.clear()
                        cache[word] = ids
                out.append(ids)
        return b"".join(out)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(vocabulary: str) -> PieceEncoder:
    """One encoder for each worker process."""
    if vocabulary not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[vocabulary] = PieceEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def token_pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k", end_id: int = 1,
                 longest: int = 2048, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``longest`` ids: doc_id, start, length, ids_crc32,
    doc_tokens, and the ids themselves if asked for."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches):
        enc, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                buf = memoryview(enc.encode(text or "") + end)
                n = len(buf) // 4
                for a in range(0, n, longest):
                    b = min(n, a + longest)
                    row.append(at)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(buf[4 * a:4 * b]))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(buf[4 * a:4 * b], "<u4").astype(np.int32))
            cols = [batch.column(0).take(pa.array(row, pa.int64())),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names)

    spec = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .mapInArrow(run, spec + ", ids array<int>" * with_ids))


def fill(demand: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dot-product heuristic for one group.  ``demand``: items by dimensions, as
    shares of the limits.  Gives each item's sequence number and its place in it."""
    n = len(demand)
    order = np.lexsort(demand.T)[::-1]
    rest = demand[order]
    bin_of, place = np.empty(n, np.int64), np.empty(n, np.int64)
    number = 0
    while len(order):
        weight = rest.sum(0)
        room, taken, count = np.ones(rest.shape[1]), np.zeros(len(order), bool), 0
        fits = np.ones(len(order), bool)
        while True:
            fits &= (rest <= room + 1e-12).all(1)
            if not fits.any():
                break
            score = rest @ (weight * room)
            score[~fits] = -1.0
            best = int(score.argmax())
            bin_of[order[best]], place[order[best]] = number, count
            room -= rest[best]
            fits[best], taken[best], count = False, True, count + 1
        if not count:
            raise ValueError("an item exceeds the limits of a sequence")
        order, rest, number = order[~taken], rest[~taken], number + 1
    return bin_of, place


def pack(items: DataFrame, limits: Limits = Limits(), group_size: int = 4096) -> DataFrame:
    """``items`` (columns tokens and loss_tokens, any others) with sequence_id
    and offset (tokens before the item in its sequence)."""
    for c in ("sequence_id", "offset", "_uid", "_group"):
        if c in {x.lower() for x in items.columns}:
            raise ValueError(f"column {c} is there already")
    rows = stored(items.withColumn("_uid", F.monotonically_increasing_id()), "items")
    whole = F.col("tokens") >= limits.tokens
    loose = rows.where(~whole)
    groups = max(1, -(-loose.count() // group_size))
    top = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)

    def run(table: pa.Table) -> pa.Table:
        tokens = table["tokens"].to_numpy()
        demand = np.column_stack([tokens, np.ones(len(tokens)), table["loss_tokens"].to_numpy()]) / top
        bins, place = fill(demand)
        frame = pd.DataFrame({"bin": bins, "place": place, "tokens": tokens, "uid": table["_uid"].to_numpy()})
        by_place = frame.sort_values(["bin", "place"])
        offset = by_place.groupby("bin")["tokens"].cumsum() - by_place["tokens"]
        seq = frame.groupby("bin")["uid"].transform("min")
        return (table.select([c for c in table.column_names if c not in ("_uid", "_group")])
                .append_column("sequence_id", pa.array(seq.to_numpy(), pa.int64()))
                .append_column("offset", pa.array(offset.sort_index().to_numpy(), pa.int64())))

    schema = items.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    packed = (loose.withColumn("_group", F.pmod(F.xxhash64("_uid"), F.lit(groups)))
              .groupBy("_group").applyInArrow(run, schema))
    alone = rows.where(whole).select(*items.columns, F.col("_uid").alias("sequence_id"),
                                     F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(packed)


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k", limits: Limits = Limits(),
                   end_id: int = 1) -> DataFrame:
    """Every piece of every document with its sequence; all tokens bear loss."""
    pieces = token_pieces(docs, vocabulary, end_id, min(limits.tokens, limits.loss_tokens))
    items = pieces.withColumn("tokens", F.col("length")).withColumn("loss_tokens", F.col("length"))
    return pack(items, limits).select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                      "sequence_id", "offset")
