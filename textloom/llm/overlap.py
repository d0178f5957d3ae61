"""Same or near-same records across splits: every training text against every held-out text of a length that allows it.

Two texts that share SHARE of the words of both in the same order share them in any order too, so what either has and the
other lacks is bounded by their lengths. A text's bits say of each of some 2 n buckets whether its words fall into it an
odd number of times. A bucket in which two texts differ takes a word that one of them lacks, so counting those buckets
rules out most pairs and never one that counts. An exact longest common subsequence decides the rest.

Equal texts are folded before any of it. Lengths fall into bands of a factor 1.25, of which only neighbours meet, and
bands into cells of a bounded size; a pair meets in one cell.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.words import WordIds, lcs_length, words
from textloom.operators import turns
from textloom.operators.forest import spanning_forest
from textloom.session import materialize, release, ship

SHARE = 0.8  # of the words of both
LEAST_BITS = 256  # of a text; longer ones have the power of two from twice their words on
SPAN = 4  # words of a shared span
CELL = 1 << 19  # members of a cell on either side, of 512 bits each; fewer of longer ones
BAND = 1.2500001  # texts of neighbouring bands at most: a shade over 1 / SHARE, so rounding puts no pair further apart


def _joined(ws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(record, word) of all words of a batch of records as one sorted number each, and how many words each record has."""
    lens = np.array([len(w) // 4 for w in ws], np.int64)
    return np.sort((np.repeat(np.arange(len(ws), dtype=np.uint64), lens) << np.uint64(32)) | np.frombuffer(b"".join(ws), np.uint32)), lens


def _mix(x: np.ndarray, c) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x * np.uint64(0x9E3779B97F4A7C15)) ^ c
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _bits(ws: list[bytes]) -> list[bytes]:
    """Of each record a bit per bucket: whether an odd number of its words fall into it; a word's second occurrence is another word."""
    out = []
    for at in range(0, len(ws), 1000):
        pairs, lens = _joined(ws[at : at + 1000])
        i = np.arange(len(pairs))
        start = np.concatenate([[True], pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, bool)
        times = i - np.maximum.accumulate(np.where(start, i, 0))
        width = np.array([max(LEAST_BITS, 1 << int(2 * n - 1).bit_length()) for n in lens.tolist()], np.int64)
        end = np.cumsum(width)
        h = _mix(pairs & np.uint64(0xFFFFFFFF), times.astype(np.uint64)).view(np.int64)
        row = np.repeat(np.arange(len(lens)), lens)
        odd = np.bincount((h & (width - 1)[row]) + (end - width)[row], minlength=int(end[-1])) & 1
        packed = np.packbits(odd.astype(np.uint8)).tobytes()
        out += [packed[(e - w) // 8 : e // 8] for e, w in zip(end.tolist(), width.tolist(), strict=True)]
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, side, text) to (id, side, fp, n, w, bits): w holds the words as 32-bit numbers."""
    known = WordIds()
    for b in batches:
        cols: list[list] = [[], [], [], [], []]
        for i, side, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            ids = known.ids(words(text or ""))
            if ids:
                w = np.array(ids, np.uint64)
                for c, v in zip(cols, (i, side, xxhash.xxh128_digest(w.tobytes()), len(ids), w.astype(np.uint32).tobytes()), strict=True):
                    c.append(v)
        kinds = (pa.string(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*cols, _bits(cols[4])], kinds, strict=True)], ["id", "side", "fp", "n", "w", "bits"])


def _folded(bits: list[np.ndarray], width: int) -> np.ndarray:
    """The rows of all matrices with ``width`` numbers each: halves laid over each other have the bits of half as many buckets."""
    out = []
    for x in bits:
        while x.shape[1] > width:
            x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
        out.append(x)
    return np.concatenate(out)


def _matrices(rows: list[bytes]) -> list[np.ndarray]:
    """Bits of successive rows as 64-bit numbers, a matrix for every run of equal widths."""
    size = np.array([len(r) for r in rows])
    cut = [0, *(np.flatnonzero(size[1:] != size[:-1]) + 1).tolist(), len(rows)]
    return [np.frombuffer(b"".join(rows[i:j]), np.uint64).reshape(j - i, -1) for i, j in zip(cut, cut[1:], strict=False)]


def _possible(n: np.ndarray, bits: np.ndarray, m: np.ndarray, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the held-out texts (m, other) and the training texts (n, bits; a column each) that may share SHARE of the words of both; n and m rise."""
    n, m = n.astype(np.int32), m.astype(np.int32)
    need, need2 = (4 * n + 4) // 5, (4 * m + 4) // 5  # SHARE of the words, rounded up
    half = max(1, len(bits) // 2)
    kind = np.uint16 if len(bits) < 1024 else np.uint32
    for at in range(0, len(m), 16):  # tiles that stay in the processor's cache
        k, y = m[at : at + 16], other[at : at + 16]
        lo, hi = np.searchsorted(n, need2[at]), np.searchsorted(n, k[-1] * 5 // 4, "right")
        for a in range(lo, hi, 4096):
            b = min(hi, a + 4096)
            apart = np.zeros((len(k), b - a), kind)
            for c in range(half):
                apart += np.bitwise_count(bits[c, a:b] ^ y[:, c, None])
            # words that either may have and the other lack
            spare = n[a:b] + k[:, None] - 2 * np.maximum(need[a:b], need2[at : at + 16, None])
            i, j = np.nonzero(apart <= spare)
            if len(i) and half < len(bits):
                rest = np.bitwise_count(bits[half:, a + j] ^ y[i, half:].T).sum(axis=0, dtype=np.int64)
                ok = apart[i, j] + rest <= spare[i, j]
                i, j = i[ok], j[ok]
            if len(i):
                yield i + at, j + a


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, side, key, n, bits) by cell, side and n to the (key, key2) of each cell's training and held-out texts that may be alike."""
    cell, train = None, []
    table = None  # of the training texts of the cell: key, n, matrices
    for b in batches:
        cells, sides, keys, ns = (b.column(k).to_numpy() for k in range(4))
        cut = np.flatnonzero((cells[1:] != cells[:-1]) | (sides[1:] != sides[:-1])) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows], strict=True):
            if i == j:
                continue
            if cells[i] != cell:
                cell, train, table = cells[i], [], None
            here = (keys[i:j], ns[i:j], _matrices(b.column(4).slice(i, j - i).to_pylist()))
            if sides[i] == 1:
                train.append(here)
                continue
            if not train:
                continue
            width = min(x.shape[1] for x in here[2])
            if table is None or table[2].shape[0] > width:
                width = min([width, *(x.shape[1] for t in train for x in t[2])])
                table = (np.concatenate([t[0] for t in train]), np.concatenate([t[1] for t in train]), np.ascontiguousarray(_folded([x for t in train for x in t[2]], width).T))
            for x, y in _possible(table[1], table[2], here[1], _folded(here[2], table[2].shape[0])):
                key, key2 = table[0][y], here[0][x]
                other = pa.array(key != key2)
                yield pa.RecordBatch.from_arrays([pa.array(key).filter(other), pa.array(key2).filter(other)], ["key", "key2"])


def _candidates(texts: DataFrame) -> DataFrame:
    """(key, key2): the training and held-out texts that may share SHARE of the words of both, every such pair once.

    Each cell of a band's training texts meets each cell of the held-out texts of the bands beside it. A band of any size
    falls into cells by the hash of its members, so no group holds more than two cells.
    """
    x = texts.select("key", "side", "n", "bits", F.floor(F.log("n") / F.log(F.lit(BAND))).cast("long").alias("band"))
    # a band has cells of a side only where it has texts of it; there are some hundred bands whatever the lengths
    cells = lambda bit, name: F.ceil(F.sum(F.when(F.col("side").bitwiseAND(bit) > 0, F.length("bits"))) / (CELL * 64)).alias(name)
    size = materialize(x.groupBy("band").agg(cells(1, "rows"), cells(2, "cols")), "bands")
    hashed, spread = (lambda c: F.pmod(F.xxhash64("key"), F.col(c))), (lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)))
    beside = F.explode(F.array(*(F.col("band") + k for k in (-1, 0, 1))))
    number = lambda t, h, i, j: F.shiftleft(t * 128 + h, 48) + F.shiftleft(i, 24) + j
    sides = []
    for bit, own, far in ((1, "rows", "cols"), (2, "cols", "rows")):
        mine = F.broadcast(size.filter(f"{own} > 0").select("band", own))
        others = F.broadcast(size.filter(f"{far} > 0").select(F.col("band").alias("beside"), far))
        y = x.filter(F.col("side").bitwiseAND(bit) > 0).join(mine, "band").withColumn("at", hashed(own)).withColumn("beside", beside).join(others, "beside").withColumn("to", spread(far))
        place = [F.col(c) for c in (("band", "beside", "at", "to") if bit == 1 else ("beside", "band", "to", "at"))]
        sides.append(y.select(number(*place).alias("cell"), F.lit(bit).alias("side"), "key", "n", "bits"))
    return sides[0].unionByName(sides[1]).repartition("cell").sortWithinPartitions("cell", "side", "n").mapInArrow(_close, "key long, key2 long")


def shared_spans(x: list[int], y: list[int], least: int = SPAN) -> list[tuple[int, int]]:
    """Spans [pos, upto) of ``x`` that stand in ``y`` as well, each as long as it gets; spans under ``least`` words are left out."""
    where: dict[tuple, list[int]] = {}
    for j in range(len(y) - least + 1):
        where.setdefault(tuple(y[j : j + least]), []).append(j)
    out, i = [], 0
    while i <= len(x) - least:
        best = 0
        for j in where.get(tuple(x[i : i + least]), ()):
            k = least
            if best and (i + best >= len(x) or j + best >= len(y) or x[i + best] != y[j + best]):
                continue  # no longer than the one at hand
            while i + k < len(x) and j + k < len(y) and x[i + k] == y[j + k]:
                k += 1
            best = max(best, k)
        if best:
            out.append((i, i + best))
        i += max(best, 1)
    return out


_SPANS = pa.list_(pa.struct([("pos", pa.int32()), ("upto", pa.int32())]))
_LINK = "key long, key2 long, shared int, spans array<struct<pos:int,upto:int>>"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, key2, w, w2) to (key, key2, shared, spans) where the common subsequence is long enough; the spans are those of the held-out record."""
    for b in batches:
        out: list[tuple] = []
        last, y, known = None, [], frozenset()
        for f, g, w, v in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            n, m = len(w) // 4, len(v) // 4
            least = SHARE * max(n, m)
            if min(n, m) < least:
                continue
            if g != last:  # the join leaves the candidates of a text together
                last, y = g, memoryview(v).cast("I").tolist()
                known = frozenset(y)
            x = memoryview(w).cast("I").tolist()
            if sum(map(known.__contains__, x)) < least:  # not even words in common
                continue
            if (Counter(x) & Counter(y)).total() < least:
                continue
            k = lcs_length(x, y)
            if k >= least - 1e-9:
                out.append((f, g, k, [{"pos": a, "upto": c} for a, c in shared_spans(y, x)]))
        cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], _SPANS)], ["key", "key2", "shared", "spans"])


def links(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, key2, shared, spans): training and held-out texts that share SHARE of the words of both, and (id, side, key, n): the records' texts.

    ``records``: id, side (1 training, 2 held out), text. Null and wordless texts take part in nothing; an id with both
    sides stands on both. Copies are one text, which is linked to itself where it stands on both sides.
    """
    ship(records.sparkSession)
    read = materialize(records.select("id", "side", "text").mapInArrow(_fingerprint, "id string, side int, fp binary, n int, w binary, bits binary"), "records")
    # a text goes by 64 bits of its fingerprint; that two of a table meet in them is as good as excluded
    key = F.xxhash64("fp")
    texts = materialize(read.groupBy("fp").agg(F.bit_or("side").alias("side"), F.first("n").alias("n"), F.first("w").alias("w"), F.first("bits").alias("bits")).select(key.alias("key"), "side", "n", "w", "bits"), "texts")
    rec = materialize(read.select("id", "side", key.alias("key"), "n"), "ids")
    release(read)
    found = materialize(_candidates(texts), "candidates")
    w1, w2 = texts.select("key", "w"), texts.select(F.col("key").alias("key2"), F.col("w").alias("w2"))
    near = found.join(w1, "key").join(w2, "key2").select("key", "key2", "w", "w2").mapInArrow(_verify, _LINK)
    whole = F.array(F.struct(F.lit(0).alias("pos"), F.col("n").alias("upto")))
    same = texts.filter("side = 3").select("key", F.col("key").alias("key2"), F.col("n").alias("shared"), whole.alias("spans"))
    out = materialize(near.unionByName(same), "links")
    release(found)
    return out, rec


def cross_split_pairs(records: DataFrame) -> DataFrame:
    """(id_a, id_b, shared, n_a, n_b), id_a < id_b: pairs of a training and a held-out record that share SHARE of the words of both."""
    linked, rec = links(records)
    a = rec.filter("side = 1").select("key", F.col("id").alias("x"), F.col("n").alias("nx")).distinct()
    b = rec.filter("side = 2").select(F.col("key").alias("key2"), F.col("id").alias("y"), F.col("n").alias("ny")).distinct()
    j = linked.drop("spans").join(a, "key").join(b, "key2").filter("x <> y")
    less = F.col("x") < F.col("y")
    return j.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "shared", F.when(less, F.col("nx")).otherwise(F.col("ny")).alias("n_a"), F.when(less, F.col("ny")).otherwise(F.col("nx")).alias("n_b")).distinct()


def covered(spans: Column) -> Column:
    """Words under the union of (pos, upto) spans."""
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    step = lambda s, x: F.struct((s["total"] + F.greatest(x["upto"] - F.greatest(x["pos"], s["end"]), F.lit(0))).alias("total"), F.greatest(x["upto"], s["end"]).alias("end"))
    return F.aggregate(F.sort_array(spans), start, step, lambda s: s["total"])


def coverage(records: DataFrame) -> DataFrame:
    """(id, n, covered, share): held-out records with a twin other than themselves; covered: their words under the merged spans shared with any twin; share: the longest common subsequence, as a share of their words."""
    linked, rec = links(records)
    ids = rec.select("id", "side", "key", "n").distinct()
    # a copy is a twin only of records of another id
    owners = ids.filter("side = 1").groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    each = linked.groupBy("key2").agg(F.flatten(F.collect_set(F.when(F.col("key") != F.col("key2"), F.col("spans")))).alias("spans"), F.max(F.when(F.col("key") != F.col("key2"), F.col("shared"))).alias("shared"), F.bool_or(F.col("key") == F.col("key2")).alias("copied"))
    x = ids.filter("side = 2").join(each.withColumnRenamed("key2", "key"), "key").join(owners, "key", "left")
    copied = F.col("copied") & ((F.col("lo") != F.col("id")) | (F.col("hi") != F.col("id")))
    x = x.withColumn("copied", F.coalesce(copied, F.lit(False))).filter("copied OR shared IS NOT NULL")
    return x.select("id", "n", F.when(F.col("copied"), F.col("n")).otherwise(covered(F.col("spans"))).alias("covered"), (F.when(F.col("copied"), F.col("n")).otherwise(F.col("shared")) / F.col("n")).alias("share"))


def classes(records: DataFrame) -> DataFrame:
    """(id, class_id, twins): one row per record with words: the class of texts that links hold together, and the number of linked texts of the other side."""
    linked, rec = links(records)
    members, _ = spanning_forest(linked.select(F.col("key").cast("string").alias("u"), F.col("key2").cast("string").alias("v")))
    members = members.select(F.col("node").cast("bigint").alias("key"), "root")
    sides = linked.select(F.col("key").alias("key"), F.lit(1).alias("side")).unionByName(linked.select(F.col("key2").alias("key"), F.lit(2).alias("side")))
    twins = sides.groupBy("key", "side").agg(F.count("*").alias("twins"))
    x = rec.select("id", "side", "key").distinct().join(members, "key", "left").join(twins, ["key", "side"], "left")
    return x.groupBy("id").agg(F.min(F.coalesce("root", F.col("key").cast("string"))).alias("class_id"), F.coalesce(F.sum("twins"), F.lit(0)).alias("twins"))


def conversation_texts(messages: DataFrame) -> DataFrame:
    """(conversation_id, text): user and assistant contents in turn order, each message once, without system messages.

    Rows whose number isn't whole stand behind the others; conversations without such text give no row. A conversation is
    one text, so a single one has to fit into a task.
    """
    ev = turns.events(messages).filter("role IN ('user', 'assistant') AND content <> ''")
    msg = F.struct(F.coalesce("turn", F.lit(2**63 - 1)).alias("turn"), "role", "content")
    got = ev.groupBy("conversation_id").agg(F.sort_array(F.collect_list(msg)).alias("m"))
    once = F.filter("m", lambda x, i: (i == 0) | (x != F.col("m")[F.greatest(i - 1, F.lit(0))]))
    return got.select("conversation_id", F.array_join(F.transform(once, lambda x: x["content"]), "\n").alias("text"))
