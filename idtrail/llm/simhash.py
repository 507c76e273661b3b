"""SimHash near-duplicates by pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idtrail.llm.common import components, ids_and_texts, per_batch, unused
from idtrail.session import staged

SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of one text as a signed integer; 0 for a text without words."""
    words = text.lower().split()  # bytes: folds A-Z only and cuts at the six ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1 :]
    hashes = np.array([
        xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)
    ], dtype="<u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        block = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (signed long), a row for each row of ``docs``."""

    def make(batch: pa.RecordBatch) -> dict[str, list]:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        return {"doc_id": batch.column("doc_id"), "fingerprint": [fingerprint(x, shingle) for x in texts]}

    return per_batch(ids_and_texts(docs, id_col, text_col), make, "doc_id long, fingerprint long")


def as_hex(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def block_masks(blocks: int) -> list[int]:
    """Masks, as signed longs, of ``blocks`` runs of bits that make up the 64."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [((1 << b) - (1 << a)) - (1 << 64 if b == 64 else 0) for a, b in zip(cuts, cuts[1:], strict=False)]


def links(prints: DataFrame, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """All pairs ``a < b`` of distinct values of ``prints.fingerprint`` that differ in 1 to ``max_bits`` bits, once each.

    Of ``blocks`` blocks, ``max_bits`` differing bits leave ``blocks - max_bits`` untouched, so one of the combinations
    of so many blocks agrees as a whole. 3 bits of 6 blocks: 20 keys of about 32 bits, which spreads far more than 4 keys
    of 16. A pair is taken at the first combination that agrees, as the join's own condition, so that it is made once.
    """
    masks = block_masks(blocks)
    chosen = list(combinations(range(blocks), blocks - max_bits))
    first = [next((k for k, c in enumerate(chosen) if all(same >> i & 1 for i in c)), -1) for same in range(1 << blocks)]
    combined = [sum(masks[i] for i in c) for c in chosen]
    keyed = prints.select("fingerprint").distinct().select(
        "fingerprint", F.posexplode(F.array(*[F.lit(m).cast("long") for m in combined])).alias("t", "mask")
    ).select("fingerprint", "t", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"))
    left, right = keyed.withColumnRenamed("fingerprint", "a"), keyed.withColumnRenamed("fingerprint", "b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    same = sum(
        (F.when(differ.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(1 << i)).otherwise(0) for i, m in enumerate(masks)),
        F.lit(0),
    )
    on = (
        (left.t == right.t) & (left.key == right.key) & (F.col("a") < F.col("b")) & (F.bit_count(differ) <= max_bits)
        & (F.element_at(F.array(*[F.lit(k) for k in first]), same + 1) == left.t)
    )
    return left.join(right, on).select("a", "b")


def near_groups(
    docs: DataFrame, max_bits: int = 3, shingle: int = 3, blocks: int = 6, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    ``fingerprint``: 16 hex digits; ``component_id``: the smallest id that chains of links of at most ``max_bits`` bits reach.

    Equal fingerprints are one node, so copies never make pairs. Null or empty text: fingerprint zero, linked like any other.
    Null id: its row gets the component's smallest id that is not null, null if there is none. Repeated rows: each comes
    out. Empty table: no rows. Other columns of ``docs`` are not read.
    """
    prints = staged(fingerprints(docs, shingle, id_col, text_col))
    smallest = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    named = named_groups(smallest, max_bits, blocks).select(F.col("fingerprint").alias("print"), F.col("least").alias("component_id"))
    return prints.join(named, prints.fingerprint == named["print"]).select(
        "doc_id", as_hex("fingerprint").alias("fingerprint"), "component_id"
    )


def named_groups(smallest: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """``fingerprint, component, least`` for each row of ``smallest (fingerprint, least)``: the smallest ``least`` of its component."""
    nodes = components(links(smallest, max_bits, blocks))
    member = smallest.join(nodes, smallest.fingerprint == nodes.node, "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    return member.drop("least").join(member.groupBy("component").agg(F.min("least").alias("least")), "component")


def keep_one(
    docs: DataFrame, max_bits: int = 3, shingle: int = 3, blocks: int = 6, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each group of :func:`near_groups`: that of the smallest id, of equal ids that of the smallest MD5 of the text.

    Rows without an id come after all others. Rows of equal id and text (null texts count as empty) are repeated rows, of which one
    stays. Different texts of one id are different documents: each stays or goes with its own group. Null or empty texts
    are one group. Empty table: no rows. Columns stay as they are, whatever their names.
    """
    text, number = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col).cast("long")
    key = {"none": number.isNull(), "id": F.coalesce(number, F.lit(0)), "md5": F.md5(text)}  # without nulls: one shuffle for all below
    own = {c: unused(docs, f"row_{c}") for c in key}
    given = docs.withColumns({own[c]: x for c, x in key.items()})
    prints = staged(keyed_prints(given.select(*(F.col(own[c]).alias(c) for c in key), text.alias("text")), shingle))
    least = prints.groupBy("fingerprint").agg(F.min(F.struct(*key)).alias("least"))
    stays = named_groups(least, max_bits, blocks).select(*(F.col(f"least.{c}").alias(own[c]) for c in key)).distinct()
    return given.join(stays, list(own.values()), "left_semi").dropDuplicates(list(own.values())).select(*docs.columns)


def keyed_prints(given: DataFrame, shingle: int) -> DataFrame:
    """``none, id, md5, fingerprint`` for each row of ``given (none, id, md5, text)``."""

    def make(batch: pa.RecordBatch) -> dict[str, list]:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        return {c: batch.column(c) for c in ("none", "id", "md5")} | {"fingerprint": [fingerprint(x, shingle) for x in texts]}

    return per_batch(given, make, "none boolean, id long, md5 string, fingerprint long")
