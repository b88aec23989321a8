"""SimHash near-duplicates: pigeonhole blocks, then Hamming distance.

Every document gets a 64-bit fingerprint of its word shingles.  Fingerprints
are collapsed to distinct ones before anything is joined, so exact copies
never meet each other.  A fingerprint is cut into ``blocks`` blocks; two that
differ in at most ``max_bits`` bits agree in at least ``blocks - max_bits``
blocks, so every choice of that many blocks is one join key and the pairs that
meet are verified by their bit distance.

Blocks shared by more than ``hot`` fingerprints are not paired up.  Their
fingerprints are linked through midpoints instead, which is exact as well: at
two bits or fewer two fingerprints have a common neighbour at one bit or none,
and at most 65 different ones share such a neighbour.  Both ways are linear in
the number of fingerprints.

Defined results: a null text counts as empty; no words give fingerprint zero,
linked like any other; a text shorter than a shingle is hashed as a whole.  A
null document id takes part, but never names a component while another id is
there.  Repeated rows give repeated results.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import clear_name, stored
from tradelake.llm.components import connected_components

BITS = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42, step: int = 50_000) -> int:
    """Signed 64-bit SimHash; words are split at ASCII blanks, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    lo, hi = starts[: len(words) - n + 1].tolist(), ends[n - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(lo), step):  # bounded memory for very long texts
        h = np.array([digest(joined[a:b], seed) for a, b in zip(lo[at:at + step], hi[at:at + step])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(lo), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` and a column ``name`` with the fingerprint of its ``text``."""
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches):
        for batch in batches:
            fps = pa.array([fingerprint(t, shingle) for t in batch.column(at).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, fps], [*batch.schema.names, name])
    from pyspark.sql.types import LongType, StructType
    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, LongType()))


def masks(blocks: int, agree: int) -> list[int]:
    """Signed bit masks of every choice of ``agree`` out of ``blocks`` blocks."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    part = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    out = []
    for chosen in combinations(part, agree):
        m = sum(chosen)
        out.append(m - (1 << BITS) if m >= 1 << (BITS - 1) else m)
    return out


def fingerprint_links(fps: DataFrame, max_bits: int = 2, blocks: int = 4, hot: int = 64) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b), enough of them that every
    pair at ``max_bits`` or fewer bits is connected, and none beyond."""
    if not 0 < max_bits < blocks:
        raise ValueError("pigeonhole blocks need 0 < max_bits < blocks")
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("block"))
                     for i, m in enumerate(masks(blocks, blocks - max_bits))])
    rows = fps.select("fp", F.explode(keys).alias("k")).select("k.choice", "k.block", "fp")
    sizes = (rows.groupBy("choice", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = stored(rows.join(sizes, ["choice", "block"]), "blocks")
    cold = shared.where(F.col("n") <= hot).drop("n")
    other = cold.withColumnRenamed("fp", "fp2")
    links = (cold.join(other, ["choice", "block"])
             .where((F.col("fp") < F.col("fp2"))
                    & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= max_bits))
             .select(F.col("fp").alias("a"), F.col("fp2").alias("b")))
    big = shared.where(F.col("n") > hot).select("fp").distinct()
    return links.unionByName(midpoint_links(big, max_bits))


def midpoint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links between fingerprints with a common neighbour, one star for each
    neighbour: at two bits all bits flipped once, at one bit on one side."""
    if max_bits > 2:
        raise ValueError("midpoints are for one or two bits")
    flips = [0, *(1 << i for i in range(BITS - 1)), -(1 << (BITS - 1))]
    near = F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips]))
    groups = (fps.select("fp", near.alias("mid")).groupBy("mid")
              .agg(F.collect_list("fp").alias("own"))  # 65 at most
              .where(F.size("own") > 1))
    stars = (groups.select(F.array_min("own").alias("a"), F.explode("own").alias("b"), "mid")
             if max_bits == 2 else
             groups.where(F.array_contains("own", F.col("mid")))
             .select(F.col("mid").alias("a"), F.explode("own").alias("b"), "mid"))
    return stars.where("a <> b").select("a", "b").distinct()


def fingerprint_components(docs: DataFrame, first, max_bits: int, blocks: int, hot: int) -> DataFrame:
    """``docs`` with ``fp`` -> (fp, first): the smallest ``first`` (an ordered
    expression over ``docs``) that is reachable from each fingerprint."""
    classes = stored(docs.groupBy("fp").agg(F.min(first).alias("first")), "classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), max_bits, blocks, hot))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    linked = stored(named.select("fp", "root").join(least, "root").select("fp", "least"), "linked")
    return classes.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("first"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, blocks: int = 4,
                    hot: int = 64) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    fps = with_fingerprint(docs.select("doc_id", F.col("text").cast("string").alias("text")), shingle)
    fps = stored(fps.select("doc_id", "fp"), "fingerprints")
    parts = stored(fingerprint_components(fps, F.col("doc_id"), max_bits, blocks, hot), "components")
    return (fps.join(parts, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("first").alias("component_id")))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, blocks: int = 4,
             hot: int = 64) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest
    doc_id (of repeated ones the first); columns as they were."""
    fp, uid = clear_name(docs.columns, "fp"), clear_name(docs.columns, "uid")
    all_rows = stored(with_fingerprint(docs, shingle, fp).withColumn(uid, F.monotonically_increasing_id()),
                      "fingerprinted")
    slim = all_rows.select(F.col(fp).alias("fp"), F.col(uid).alias("uid"), F.col("doc_id").alias("id"))
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("uid"))
    parts = fingerprint_components(slim, first, max_bits, blocks, hot)
    kept = parts.select(F.col("first.uid").alias(uid)).distinct()
    return all_rows.join(kept, uid, "left_semi").select(*docs.columns)
