"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each padded
to 23 and decoded to its nearest Golay codeword. A segment with one wrong bit
may decode elsewhere, so one side of the join carries the codewords of all its
one-bit neighbours (one or six different ones). Of at most four wrong bits
over three segments, either two segments have at most one each, or one has
none and the others two each. Hence two kinds of keys:

* a pair of segments (three choices): the index side writes (near codewords of
  the first, own codeword of the second), the probe side (own codeword of the
  first, near codewords of the second); two fingerprints within one bit on
  both segments meet under exactly one key;
* a whole segment and the near codewords of the next (three choices), written
  by both sides: two words at two differing bits are both one bit from a word
  between them, so they share its codeword.

Keys have 33 and 34 bits, so candidates other than links grow with the square
of the distinct fingerprints over some 10^10.

Every link is verified by its bit distance and is emitted under one key only
(the first kind that its own error pattern promises). Copies of a fingerprint
are joined once; links are cut to a spanning forest inside each task before
the next shuffle; components come from rounds of label passing between
checkpoints.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .common import SLICE_BYTES, fresh, pieces, stored, text_pass
from .golay import Golay

SHINGLE_WORDS = 4
MAX_BITS = 4
# Fingerprints of more rows get their label by broadcast (there are fewer than
# rows / HOT_ROWS of them), so that no task gets the rows of a hot one.
HOT_ROWS = 20_000
SEED = 42
# Segments as (lowest bit, bits).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BLANK = re.compile(rb"[\x09-\x0D ]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text (no words: zero). Texts are read
    and shingles hashed in blocks, so a long text needs little memory."""
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    words: list[bytes] = []                # those that begin the next piece's shingles
    for p in pieces(text.translate(_LOWER), SLICE_BYTES, _BLANK):
        words += _WORD.findall(p)
        m = len(words) - shingle + 1
        if m <= 0:
            continue
        total += _bit_sums(words, shingle, digest, seed)
        n += m
        words = words[m:]
    if not n:
        if not words:
            return 0
        total, n = _bit_sums(words, len(words), digest, seed), 1
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _bit_sums(words: list[bytes], k: int, digest, seed: int) -> np.ndarray:
    """How many of the ``k``-word shingles have each bit of their hash set."""
    flat, total = b" ".join(words), np.zeros(64, np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    starts, ends = starts[:len(words) - k + 1], ends[k - 1:]
    for i in range(0, len(starts), 1 << 16):
        h = np.array([digest(flat[a:b], seed) for a, b in
                      zip(starts[i:i + (1 << 16)].tolist(), ends[i:i + (1 << 16)].tolist())],
                     dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return total


def fingerprints(df: DataFrame, text_col: str = "text", shingle: int = SHINGLE_WORDS,
                 fp_col: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus the fingerprint as a signed 64-bit integer."""
    def make():
        return lambda texts: [np.array([fingerprint(t, shingle) for t in texts],
                                       np.uint64).view(np.int64)]
    return text_pass(df, text_col, [T.StructField(fp_col, T.LongType())], make, keep)


def _keys(fps: DataFrame) -> DataFrame:
    """(kind, key, side, fp): index rows have side 0, probe rows side 1, rows
    of the last kinds both (side 2). Their keys are a whole segment and the
    nearby codewords of the next: two segments at two differing bits have a
    word between them, and so a codeword that is nearby to both."""
    schema = "kind int, key long, side int, fp long"

    def run(batches):
        import pyarrow as pa
        code = Golay()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1 << 14):
                fp = batch.column(0).slice(lo, 1 << 14).to_numpy(zero_copy_only=False)
                u = fp.view(np.uint64)
                seg = [((u >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
                own = [code.index(s) for s in seg]
                near = []
                for s, (_, n) in zip(seg, SEGMENTS):
                    cols = np.sort(np.stack(code.near(s, n)), axis=0)
                    new = np.ones(cols.shape, bool)
                    new[1:] = cols[1:] != cols[:-1]
                    at = np.nonzero(new)
                    near.append((at[1], cols[at]))
                parts = []
                for kind, (a, b) in enumerate(PAIRS):
                    i, c = near[a]
                    parts.append((kind, c << 12 | own[b][i], 0, fp[i]))
                    i, c = near[b]
                    parts.append((kind, own[a][i] << 12 | c, 1, fp[i]))
                for s in range(3):
                    i, c = near[(s + 1) % 3]
                    parts.append((3 + s, seg[s][i] << 12 | c, 2, fp[i]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([np.full(len(p[1]), p[j], np.int32) for p in parts]))
                     if j in (0, 2) else pa.array(np.concatenate([p[j] for p in parts]))
                     for j in range(4)], names=["kind", "key", "side", "fp"])

    return fps.select("fp").mapInArrow(run, schema)


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: every two different fingerprints of ``fps(fp)`` (distinct,
    no nulls) at ``max_bits`` (at most 4) or fewer differing bits, once."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the segment plan covers up to four bits")
    keys = stored(_keys(fps), "simhash-keys")
    left = keys.filter("side <> 1").select("kind", "key", F.col("fp").alias("a"))
    right = keys.filter("side <> 0").select("kind", "key", F.col("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    d = [F.bit_count(x.bitwiseAND(F.lit(_signed(((1 << n) - 1) << lo)))) for lo, n in SEGMENTS]
    # The first kind of key that the pair's own error pattern promises.
    promised = [(d[i] <= 1) & (d[j] <= 1) for i, j in PAIRS] + [(d[s] == 0) & (d[(s + 1) % 3] <= 2) for s in range(3)]
    kind = F.coalesce(*[F.when(p, k) for k, p in enumerate(promised)])
    cond = ((left["kind"] == right["kind"]) & (left["key"] == right["key"])
            & (F.col("a") < F.col("b")) & (F.bit_count(x) <= max_bits)
            & (left["kind"] == kind))
    # Kinds 0 to 2 give a pair one key; it can share several of the last ones.
    found = left.join(right, cond).select(left["kind"], "a", "b")
    return found.filter("kind < 3").select("a", "b").unionByName(found.filter("kind > 2").select("a", "b").distinct())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(edges: DataFrame) -> DataFrame:
    """Inside each task, only links that join two trees go on (a, b: long)."""
    def run(batches):
        import pyarrow as pa
        root: dict[int, int] = {}

        def find(v):
            r = v
            while (p := root.get(r, r)) != r:
                r = p
            while root.get(v, v) != r:
                root[v], v = r, root[v]
            return r

        for batch in batches:
            a, b = [], []
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                p, q = find(u), find(v)
                if p != q:
                    root[max(p, q)] = min(p, q)
                    a.append(u)
                    b.append(v)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                                 names=["a", "b"])
    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest node of
    its component. Large-star and small-star rounds: every node hands its
    larger, then all its, neighbours to the smallest one until nothing
    changes; each round ends in a checkpoint. Hot nodes: minima are combined
    in the map tasks, and skewed joins are split."""
    checkpoint_dir(edges.sparkSession)
    e = stored(edges, "links").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
                                      ).filter("u <> v").distinct()
    e = e.checkpoint()
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = large.filter("u <> v").distinct().checkpoint()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        small = e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct().checkpoint()
        now = tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                                                   F.lit(0).cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select("v", "v").distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(id, fingerprint, component_id)`` for every row of ``df``.

    ``component_id`` is the smallest id reachable over links. A null or empty
    text has fingerprint zero and is linked like any other. Ids may repeat;
    null ids take part but never name a component unless it has no other id.
    An empty table gives no rows; other columns are not read.
    """
    fps = stored(fingerprints(df, text_col, shingle, "fp", [id_col]).select(
        F.col(f"`{id_col}`").alias("id"), "fp"), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("id").alias("low"), F.count("*").alias("n")), "fingerprint-nodes")
    comp = stored(components(forest(links(nodes.select("fp"), max_bits))), "components")
    linked = nodes.join(comp, nodes["fp"] == comp["node"]).select("fp", "low", "root")
    least = linked.groupBy("root").agg(F.min("low").alias("least"))
    label = linked.join(least, "root").select("fp", "least")
    label = stored(nodes.join(label, "fp", "left").select("fp", "n", F.coalesce("least", "low").alias("component_id")),
                   "fingerprint-labels")
    hot, rest = F.broadcast(label.filter(F.col("n") > HOT_ROWS)), label.filter(F.col("n") <= HOT_ROWS)
    out = fps.join(hot, "fp").unionByName(fps.join(hot, "fp", "left_anti").join(rest, "fp"))
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group stays: the one whose id names the component.
    Rows with a null id stay only where no row of their group has an id.
    Repeated rows with the staying id all stay."""
    near = near_duplicates(df, id_col, text_col, shingle, max_bits)
    keep = fresh(df, "_keep")
    stay = near.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).select(
        F.col(id_col).alias(keep)).distinct()
    return df.join(stay, df[id_col].eqNullSafe(stay[keep]), "left_semi")
