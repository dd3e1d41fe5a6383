"""Joins against dictionaries of unknown size and uneven keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.session import Workspace

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
SALTS = 32
#: Part of all rows from which on a key is frequent.
HOT_SHARE = 0.002
#: A key filter has this many bits a key, and from a least to a largest number of bits; a block of them is one row.
KEY_BITS, LEAST_BITS, MOST_BITS, BLOCK_BITS = 16, 2**15, 2**29, 2**15


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """Measure a dictionary: rows, and bytes of all its values plus a row overhead. A frame is measured once."""
    known = df.__dict__.setdefault("_casewright_size", [])
    if not known:
        width = reduce(
            lambda a, b: a + b,
            [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in df.columns],
        )
        known += df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    rows, size = known
    return rows <= max_rows and size <= max_bytes


def frequent_hashes(frames: DataFrame | list[DataFrame], on: list[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of all rows of a frame, from one pass with sketches of fixed size.

    A sketch's counts are too large by a small part of the rows at most, so no
    frequent key is missed; there are ``1 / share`` of them at most, and as many that nearly are.
    """
    frames = [frames] if isinstance(frames, DataFrame) else frames
    hashes = reduce(DataFrame.unionByName, [df.select(F.lit(i).alias("frame"), F.xxhash64(*on).alias("hash")) for i, df in enumerate(frames)])
    top = F.call_function("approx_top_k", F.col("hash"), F.lit(int(2 / share)), F.lit(int(100 / share)))
    found = hashes.groupBy("frame").agg(F.count(F.lit(1)).alias("n"), top.alias("top")).collect()  # a row per frame
    # Half the share leaves room for what the sketch is off.
    return sorted({r["item"] for f in found for r in f["top"] if r["count"] > share / 2 * f["n"]})


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "left", salts: int = SALTS, share: float = HOT_SHARE
) -> DataFrame:
    """Equi-join that spreads the frequent keys of ``big`` over ``salts`` tasks.

    Only these have their rows of ``small`` repeated, once per salt; all others
    meet theirs under one. The salt comes from the row's own values: a task that
    is run again after a lost executor sends each row where the first run sent
    it. (A row number would also spread equal rows, but after a shuffle rows come
    in another order when a task is repeated.)
    """
    hot = frequent_hashes(big, on, share)
    is_hot = F.xxhash64(*on).isin(hot) if hot else F.lit(False)
    hashable = [f.name for f in big.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    left = big.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*hashable), F.lit(salts))).otherwise(F.lit(0).cast("long")))
    last = F.when(is_hot, F.lit(salts - 1)).otherwise(0).cast("long")
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    df: DataFrame, dim: DataFrame, on: list[str], how: str = "left", measured: bool = False
) -> DataFrame:
    """Join a dictionary: broadcast if it measures small, else with frequent keys salted.

    ``measured`` says the size is known already, as for the fixed built-in lists.
    """
    if measured or fits_broadcast(dim):
        return df.join(F.broadcast(dim), on, how)
    return salted_join(df, dim, on, how)


class KeyFilter:
    """Keeps the rows whose key may be among some keys, before they are moved for the join that decides.

    One bit per hash of a key, in blocks that are broadcast: 64 MB at most, however
    many keys there are. Every row whose key is among them passes; of the others about
    one in sixteen, and more only beyond ``MOST_BITS / KEY_BITS`` keys.
    """

    def __init__(self, keys: DataFrame, on: str, work: Workspace):
        n = keys.count()
        self.on, self.bits = on, min(max(LEAST_BITS, 1 << (KEY_BITS * n).bit_length()), MOST_BITS)
        words = keys.select(self._place().alias("_place")).select(F.shiftright("_place", 6).alias("word"), F.expr("shiftleft(1L, cast(_place & 63 AS INT))").alias("bits"))
        # Words without a bit hold their place in the block.
        none = keys.sparkSession.range(self.bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
        words = words.unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        blocks = words.groupBy(F.expr(f"word div {BLOCK_BITS // 64}").alias("_block")).agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("_bits"))
        self.blocks = work.stage(blocks, "keys")

    def _place(self) -> Column:
        return F.pmod(F.xxhash64(self.on), F.lit(self.bits))

    def __call__(self, df: DataFrame) -> DataFrame:
        placed = df.withColumn("_place", self._place()).withColumn("_block", F.expr(f"_place div {BLOCK_BITS}"))
        word = F.get("_bits", F.expr(f"cast(_place % {BLOCK_BITS} div 64 AS INT)"))
        met = placed.join(F.broadcast(self.blocks), "_block").filter(F.getbit(word, F.expr("cast(_place & 63 AS INT)")) == 1)
        return met.select(*df.columns)
