"""Row sampling.

``sample_bernoulli`` is Spark's sampler (seeded; the row set depends on the
input layout). ``sample_by_key`` keeps a row when a hash of its key falls
under the fraction: the same keys are kept whatever the layout, engine or
run, and all rows of a key stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepulse import schemas as S

HASH_RANGE = 1 << 32


def sample_bernoulli(df: DataFrame, fraction: float = S.SAMPLE_FRACTION, seed: int = S.SAMPLE_SEED) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def key_hash(key_cols: Sequence[str]) -> Column:
    """The first 32 bits of md5 over the key text (nulls and separators made explicit)."""
    text = F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in key_cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def sample_by_key(df: DataFrame, key_cols: Sequence[str], fraction: float = S.SAMPLE_FRACTION) -> DataFrame:
    """Rows whose key hash is below ``fraction * 2**32`` (deterministic, layout-free; null keys are keys)."""
    return df.where(key_hash(key_cols) < F.lit(int(round(fraction * HASH_RANGE))))
