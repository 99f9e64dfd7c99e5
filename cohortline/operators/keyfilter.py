"""Runtime key filter: drop rows whose key cannot be among a given set, before they are shuffled.

The set becomes a bitmap of ``2^bits`` bits, one per hash value; a row stays if its
key's bit is set. All rows with a key of the set stay, and of the others about (keys of the
set) / 2^bits: 7 % for ten million keys and the default. The bitmap is broadcast, and its
size does not grow with the data: 2^27 bits are 16 MB (18 as rows), however many keys were
put in. With more keys it drops less and is never wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 27
#: Bits in one broadcast row: 64 words.
PIECE_BITS = 12


def _place(key: str, bits: int) -> tuple[Column, Column, Column]:
    """(piece, word in the piece, bit in the word) of a key's hash."""
    at = F.xxhash64(F.col(key)).bitwiseAND(F.lit((1 << bits) - 1))
    return (F.shiftright(at, PIECE_BITS).cast("int"),
            F.shiftright(at, 6).bitwiseAND(F.lit(2 ** (PIECE_BITS - 6) - 1)).cast("int"),
            at.bitwiseAND(F.lit(63)).cast("int"))


def key_bitmap(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """``(piece, words)``: the bitmap of a key column, at most 2^(bits - 12) rows. Null keys are left out."""
    if not PIECE_BITS <= bits <= 30:
        raise ValueError(f"bits: {PIECE_BITS} to 30")
    piece, word, bit = _place(key, bits)
    rows = keys.where(F.col(key).isNotNull()).select(
        piece.alias("piece"), word.alias("word"), F.expr("1L").alias("one"), bit.alias("bit"))
    mask = F.expr("shiftleft(one, bit)")
    words = [F.coalesce(F.bit_or(F.when(F.col("word") == w, mask)), F.lit(0).cast("long"))
             for w in range(2 ** (PIECE_BITS - 6))]
    return rows.groupBy("piece").agg(F.array(*words).alias("words"))


def keep_keys(df: DataFrame, key: str, keys: DataFrame, key_of: str, bits: int = BITS) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be among ``keys.key_of``; rows with a null key go.

    A filter for what a join on that key would discard anyway: the result of the join
    does not change. The broadcast has the bound above.
    """
    piece, word, bit = _place(key, bits)
    maps = key_bitmap(keys, key_of, bits).select(F.col("piece").alias("__piece"), F.col("words").alias("__words"))
    seen = df.withColumns({"__at": piece, "__word": word, "__bit": bit}).join(
        F.broadcast(maps), F.col("__at") == F.col("__piece"))
    hit = F.expr("shiftright(__words[__word], __bit) & 1L") == 1
    return seen.where(F.col(key).isNotNull() & hit).select(*df.columns)
