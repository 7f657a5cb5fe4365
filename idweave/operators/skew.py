"""Explicit salting of hot join keys, for clusters that run without AQE.

With AQE (the default) a skewed shuffle partition is split at run time and
nothing here is needed. ``salted_join`` does the same work up front. A
sample of the large side finds the keys that hold a large share of its rows.
That set is small (at most about ``1 / min_share`` keys) and written once, so
both sides see the same set. Rows of the large side with a hot key get a salt
from a hash of the row. Rows of the small side with a hot key are copied
once per salt, and the join runs on (keys, salt). Other keys keep salt 0.
The result equals the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialize


def hot_keys(df: DataFrame, keys: Sequence[str], min_share: float | None = None,
             fraction: float = 0.001, seed: int = 17) -> DataFrame:
    """Keys holding more than a shuffle partition's share of ``df``'s rows, estimated from a
    sample, with the number of partitions their rows fill (``_salts``).

    One job reads the sample, counts it (observed, no extra pass) and writes
    the keys seen more than once. The hot set, at most as many keys as there are
    shuffle partitions (``1 / min_share``), is then a filter over those written
    candidates, so every later use sees the same set. NULL keys are left out.
    """
    share = min_share or 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    obs = Observation("hot_key_sample")
    sample = (df.select(*keys).sample(fraction=fraction, seed=seed)
              .observe(obs, F.count(F.lit(1)).alias("n")))
    candidates = materialize(
        sample.dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= 2),
        "hotkeys")
    floor = max(2, int(obs.get["n"] * share))
    salts = F.ceil(F.col("_n") / F.lit(max(obs.get["n"] * share, 1.0))).cast("int") + 1
    return candidates.where(F.col("_n") >= floor).select(*keys, salts.alias("_salts"))


def salted_join(big: DataFrame, small: DataFrame, big_keys: Sequence[str],
                small_keys: Sequence[str], how: str = "inner", condition: Column | None = None,
                min_share: float | None = None) -> DataFrame:
    """``big.join(small, big_keys == small_keys [and condition], how)`` with hot keys salted.

    ``how`` is ``inner`` or ``left`` (``big`` is the preserved side). Output:
    the columns of both sides; the key columns of both sides are kept. A row of
    the big side with a NULL key matches nothing, so it gets any salt. A hot key
    gets as many salts as its rows fill shuffle partitions.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(big, big_keys, min_share)  # one row per hot key: at most 1 / min_share
    hot_b = F.broadcast(hot)
    hot_s = F.broadcast(hot.select(*[F.col(b).alias(s) for b, s in zip(big_keys, small_keys)],
                                   "_salts"))
    row = F.xxhash64(*[F.col(c) for c in big.columns])
    no_key = F.lit(False)
    for k in big_keys:
        no_key = no_key | F.col(k).isNull()
    salt_b = (F.when(no_key, F.pmod(row, F.lit(max(parts, 2))))
              .otherwise(F.pmod(row, F.coalesce("_salts", F.lit(1)))))
    b = big.join(hot_b, list(big_keys), "left").select(*big.columns, salt_b.alias("_salt"))
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    s = (small.join(hot_s, list(small_keys), "left")
         .select(*small.columns, F.explode(copies).alias("_salt_s")))
    cond = [b[bk] == s[sk] for bk, sk in zip(big_keys, small_keys)] + [b["_salt"] == s["_salt_s"]]
    if condition is not None:
        cond.append(condition)
    joined = b.join(s, cond, how)
    return joined.drop("_salt", "_salt_s")
