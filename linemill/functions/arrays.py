"""Masked-LM example arrays (F5–F8) and the learning-rate plan (F9) as native
higher-order expressions (``transform``, ``slice``, ``array_repeat``); masks of
many rows at a time by an Arrow function beside them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import hex_threshold, key_string, md5_draws

# --- fixed values -----------------------------------------------------------
# Special tokens in id order: <s>, <pad>, </s>, <unk>, <mask>.
SPECIAL_TOKENS = ["<s>", "<pad>", "</s>", "<unk>", "<mask>"]
BOS_ID, PAD_ID, EOS_ID, UNK_ID, MASK_ID = 0, 1, 2, 3, 4
NEVER_MASKED = (0, 1, 2)
# -----------------------------------------------------------------------------


def _c(col) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def frame_truncate(ids, max_length: int = 512) -> Column:
    """``<s>`` + ids + ``</s>``, cut so the whole frame is ``max_length``."""
    if max_length < 2:
        raise ValueError("max_length must leave room for <s> and </s>")
    return F.concat(F.array(F.lit(BOS_ID)), F.slice(_c(ids), 1, max_length - 2),
                    F.array(F.lit(EOS_ID)))


def pad_to(ids, max_length: int, pad_id: int = PAD_ID) -> Column:
    """right-pad with ``pad_id`` to exactly ``max_length``."""
    c = _c(ids)
    return F.concat(c, F.array_repeat(F.lit(pad_id),
                                      F.greatest(F.lit(max_length) - F.size(c), F.lit(0))))


def attention_mask(n_real, max_length: int) -> Column:
    """1 for the ``n_real`` real tokens, 0 for padding."""
    n = _c(n_real)
    return F.concat(F.array_repeat(F.lit(1), n),
                    F.array_repeat(F.lit(0), F.greatest(F.lit(max_length) - n, F.lit(0))))


def mlm_mask(ids, key_parts, epoch, seed, p: float = 0.15, draw: str = "md5") -> Column:
    """F8: each id outside {0,1,2} becomes 4 with probability ``p``.

    The draw for position ``i`` is ``md5(seed:epoch:key...:i)``, so it is
    fixed for a (row, epoch) and new for every epoch, and SQL engines can
    repeat it. ``draw="xxhash64"`` uses Spark's 64-bit hash of the same
    fields instead: the same guarantees at a fraction of the cost, without
    the cross-engine oracle. Specials and padding skip the hash entirely."""
    epoch_col = epoch if isinstance(epoch, Column) else F.lit(epoch)
    if draw == "xxhash64":
        limit = F.lit(int(math.floor(p * 2 ** 32)))
        parts = [F.lit(str(seed)), epoch_col.cast("string"),
                 *[c if isinstance(c, Column) else F.col(c) for c in key_parts]]

        def one(x, i):
            h = F.pmod(F.xxhash64(*parts, i), F.lit(2 ** 32))
            return F.when(~x.isin(*NEVER_MASKED) & (h < limit), F.lit(MASK_ID)).otherwise(x)

        return F.transform(_c(ids), one)
    if draw != "md5":
        raise ValueError(f"draw must be 'md5' or 'xxhash64', not {draw!r}")
    thr = F.lit(hex_threshold(p))

    def masked(head):
        def one(x, i):
            d = F.substring(F.md5(F.concat(head, i.cast("string"))), 1, 8)
            return F.when(~x.isin(*NEVER_MASKED) & (d < thr), F.lit(MASK_ID)).otherwise(x)
        return F.transform(_c(ids), one)

    # The outer transform binds the row's part of the key: as a plain column it
    # would be made again for every position.
    return F.element_at(F.transform(F.array(_draw_key(key_parts, epoch, seed)), masked), 1)


def _draw_key(key_parts, epoch, seed) -> Column:
    """The row's part of the md5 key of its draws."""
    epoch_col = epoch if isinstance(epoch, Column) else F.lit(epoch)
    return F.concat(F.concat_ws(":", F.lit(str(seed)), epoch_col.cast("string"), key_string(*key_parts)), F.lit(":"))


def mlm_mask_many(ids, key_parts, epoch, seed, p: float = 0.15) -> Column:
    """F8 as :func:`mlm_mask` with md5 draws, which are made for many rows at
    once in an Arrow function. Ids are of type int."""
    limit = int(hex_threshold(p), 16)

    @F.arrow_udf("array<int>")
    def masked(heads: pa.Array, ids: pa.Array) -> pa.Array:
        size = np.asarray(ids.value_lengths().fill_null(0), np.int64)
        flat = ids.flatten()
        known = np.asarray(flat.is_valid())
        x = np.array(flat.fill_null(0), np.int32)
        at = np.flatnonzero(~np.isin(x, NEVER_MASKED) & known)
        ends = np.cumsum(size)
        row = np.searchsorted(ends, at, side="right")
        hit = md5_draws([h.encode() for h in heads.to_pylist()], row, at - (ends - size)[row]) < np.uint32(limit)
        x[at[hit]] = MASK_ID
        offsets = pa.array(np.append(0, ends).astype(np.int32), mask=np.append(np.asarray(ids.is_null()), False))
        return pa.ListArray.from_arrays(offsets, pa.array(x, mask=~known), type=pa.list_(pa.int32()))

    return masked(_draw_key(key_parts, epoch, seed), _c(ids).cast("array<int>"))


def lr_at(step, base: float, warmup: int, total) -> Column:
    """linear warm-up to ``base``, then linear decay to 0 at ``total``."""
    s = _c(step).cast("double")
    t = total if isinstance(total, Column) else F.lit(total)
    w = F.lit(float(warmup))
    up = F.lit(base) * s / F.greatest(F.lit(1.0), w)
    down = F.lit(base) * F.greatest(F.lit(0.0), (t - s) / F.greatest(F.lit(1.0), t - w))
    return F.when(s < w, up).otherwise(down)
