"""Substring dedup on bytes, by suffix arrays of shards of repeated passages."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm import repeats
from tally.llm import words as w
from tally.llm.storage import mapped

LENGTH = 200
GRAM = 32
# Bytes of corpus behind a shard, and occurrences of one anchor that a shard holds.
SHARD_BYTES = 4 << 20
SHARD_PIECES = 4096
# Bytes whose grams are worked out together.
STEP = 1 << 20


def gram_values(data: np.ndarray) -> np.ndarray:
    """A value for every ``GRAM`` bytes in a row."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, reach = w._VALUES[False][data], 1
    while reach < GRAM:
        factor = np.uint64(pow(w.BASE, reach, 1 << 64))
        out = out[:-reach] * factor + out[reach:]
        reach *= 2
    return w.mix(out)


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = w.buffers(column)
    for row, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
        yield row, data[a:b]


def _steps(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Cut a long text where no window of ``length`` is lost; cuts do not touch the result."""
    for at in range(0, max(len(data) - length + 1, 0), STEP):
        yield at, data[at : at + STEP + length - 1]


def _anchors(length: int):
    width = length - GRAM + 1

    def find(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        for row, data in _texts(column):
            found, past = [], -1
            for at, part in _steps(data, length):
                grams = gram_values(part)
                place = repeats.anchors(grams, width)[1]
                place = place[place + at > past]
                if len(place):
                    past = int(place[-1]) + at
                    found.append(grams[place])
            if found:
                yield row, np.concatenate(found)

    return find


def _pieces(length: int, frequent: bool, with_bytes: bool = True):
    """Passages of windows around one anchor: where they start, how many windows they have.

    Those of frequent anchors (over ``SHARD_PIECES`` occurrences) and the others are asked
    for separately.
    """
    width = length - GRAM + 1

    def passages(data: np.ndarray, values: np.ndarray, totals: np.ndarray):
        for at, part in _steps(data, length):
            least = repeats.sliding_min(gram_values(part), width)
            slot = np.minimum(np.searchsorted(values, least), len(values) - 1)
            # A passage ends where the least gram changes, or after as many windows as one
            # place of a gram can be in.
            firsts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
            lasts = np.append(firsts[1:], len(least))
            hit = values[slot[firsts]] == least[firsts]
            for a, b in zip(firsts[hit].tolist(), lasts[hit].tolist()):
                for x in range(a, b, width):
                    yield slot[a], at + x, min(width, b - x), part[x : min(x + width, b) + length - 1].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for row, data in _texts(batch.column(2)):
                known = batch.column(3)[row].values
                values = known.field("hash").to_numpy(zero_copy_only=False)
                totals = known.field("total").to_numpy(zero_copy_only=False)
                some = (totals > SHARD_PIECES) == frequent
                if not some.any():
                    continue
                order = np.argsort(values[some].view(np.uint64))
                values, totals = values[some][order], totals[some][order]
                for slot, at, n, piece in passages(data, values.view(np.uint64), totals):
                    digest = hashlib.sha256(piece).digest()[:16] if frequent else None
                    fields = (row, values[slot], totals[slot], digest, at, n, piece if with_bytes else None)
                    for column, value in zip(out, fields):
                        column.append(value)
            at = pa.array(out[0], pa.int64())
            yield pa.record_batch(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.int64()),
                    pa.array(out[3], pa.binary()),
                    pa.array(out[4], pa.int64()),
                    pa.array(out[5], pa.int32()),
                    pa.array(out[6], pa.binary()),
                ],
                ["_id", "_row", "hash", "total", "digest", "at", "n", "piece"],
            )

    return run


def suffix_array(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All suffixes of the pieces in ``data`` in order; each ends where its piece ends.

    Suffixes equal to their ends stay in the order of their places.
    """
    order, rank = ranked_suffixes(data, ends, len(data))
    return order[np.lexsort((order, rank[order]))]


def ranked_suffixes(data: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` bytes (7 at least), and the rank of each
    place; those that are equal so far share a rank.

    Suffixes are sorted by their first 7 bytes, then groups that are still equal are refined
    by the rank of what follows, to 14, 28, ... bytes (Larsson and Sadakane). The last step
    reaches back into bytes already compared, so that it ends at ``depth``.
    """
    n = len(data)
    left = (ends - np.arange(n)).astype(np.int32)
    padded = np.append(data, np.zeros(8, np.uint8))
    key = np.ndarray(n, ">u8", padded, strides=(1,)).astype(np.uint64)
    known = np.minimum(left, 7)
    key &= np.array([(1 << 64) - (1 << 64 - 8 * k) for k in range(8)], np.uint64)[known]
    key |= known.astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    head = np.arange(n, dtype=np.int32)
    head[1:][same] = 0
    head = np.maximum.accumulate(head)
    rank = np.empty(n, np.int32)
    rank[order] = head
    reach, most = 7, min(depth, int(left.max(initial=0)))
    active = np.flatnonzero(np.append(same, False) | np.append(False, same))
    while len(active) and reach < most:
        step = min(reach, most - reach)
        places = order[active]
        after = np.where(left[places] > step, rank[np.minimum(places + step, n - 1)] + 1, 0)
        value = rank[places].astype(np.int64) * (n + 1) + after
        inner = np.argsort(value)
        places, value = places[inner], value[inner]
        order[active] = places
        same = value[1:] == value[:-1]
        head = active.astype(np.int32)
        head[1:][same] = 0
        head = np.maximum.accumulate(head)
        rank[places] = head
        active = active[np.append(same, False) | np.append(False, same)]
        reach += step
    return order, rank


def common_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order.

    Kasai's rule (one byte on, the common prefix is at most one shorter) is applied to all
    pieces side by side, one place of each at a time.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    end_of = np.repeat(ends, ends - starts)
    prefix = np.zeros(n, np.int64)
    sizes = ends - starts
    have = np.zeros(len(starts), np.int64)
    for t in range(int(sizes.max(initial=0))):
        live = np.flatnonzero(sizes > t)
        at = starts[live] + t
        other = before[at]
        h = np.where(other >= 0, np.maximum(have[live] - 1, 0), 0)
        going = np.flatnonzero(other >= 0)
        while len(going):
            x, y = at[going] + h[going], other[going] + h[going]
            room = (x < end_of[at[going]]) & (y < end_of[other[going]])
            going, x, y = going[room], x[room], y[room]
            going = going[data[x] == data[y]]
            h[going] += 1
        prefix[at] = h
        have[live] = h
    return prefix


class Shard:
    """Pieces of one shard and the suffix array over them."""

    def __init__(self, pieces: list[bytes], length: int):
        sizes = np.array([len(p) for p in pieces], np.int64)
        self.length = length
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        ends = np.repeat(self.ends, sizes)
        order, self.rank = ranked_suffixes(self.data, ends, length)
        self.windows = order[ends[order] - order >= length]

    def repeated(self) -> np.ndarray:
        """Places whose window occurs at another place of this shard."""
        rank = self.rank[self.windows]
        same = rank[1:] == rank[:-1]
        out = np.zeros(len(self.data), bool)
        out[self.windows[1:][same]] = True
        out[self.windows[:-1][same]] = True
        return out

    def keys(self) -> np.ndarray:
        """Windows in order, as byte strings of the full length."""
        view = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        return np.ascontiguousarray(view[self.windows]).view(f"V{self.length}").ravel()

    def shared(self, other: Shard) -> tuple[np.ndarray, np.ndarray]:
        """Places of both shards whose window occurs in the other, by binary search."""
        out = np.zeros(len(self.data), bool), np.zeros(len(other.data), bool)
        if not len(self.windows) or not len(other.windows):
            return out
        mine = self.keys().view(f"S{self.length}")
        theirs = other.keys().view(f"S{self.length}")
        for mark, a, b, shard in ((out[0], mine, theirs, self), (out[1], theirs, mine, other)):
            slot = np.minimum(np.searchsorted(b, a), len(b) - 1)
            mark[shard.windows[b[slot] == a]] = True
        return out


def _runs(mark: np.ndarray) -> np.ndarray:
    """First and end of each run of marked places, one after the other."""
    edges = np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8))
    return np.flatnonzero(edges).astype(np.int32)


def _within(length: int):
    """Runs of repeated windows of each passage of a shard; equal passages are sorted once."""

    def run(group: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        of = np.array([number.setdefault(p, len(number)) for p in group.column("piece").to_pylist()])
        places = set(zip(of.tolist(), *(group.column(c).to_pylist() for c in ("_id", "_row", "at"))))
        often = np.bincount([k for k, *_ in places], minlength=len(number)) > 1
        anchor = np.empty(len(number), np.int64)
        anchor[of] = group.column("hash").to_numpy()
        # An anchor whose passages are all equal needs no sorting: all their windows repeat.
        _, which, different = np.unique(anchor, return_inverse=True, return_counts=True)
        pieces = list(number)
        runs = [np.array([0, len(p) - length + 1], np.int32) for p in pieces]
        rest = np.flatnonzero((different[which] > 1) | ~often)
        shard = Shard([pieces[k] for k in rest.tolist()], length)
        mark = shard.repeated()
        for k, a, b in zip(rest.tolist(), shard.starts.tolist(), shard.ends.tolist()):
            if not often[k]:
                runs[k] = _runs(mark[a : b - length + 1])
        some = np.flatnonzero(np.array([len(r) for r in runs])[of])
        return pa.table(
            {
                **{c: group.column(c).take(pa.array(some)) for c in ("_id", "_row", "at")},
                "runs": pa.array([runs[k] for k in of[some].tolist()], pa.list_(pa.int32())),
            }
        )

    return run


def _between(length: int):
    """Runs of repeated windows of the passages of one part of an anchor, or of two parts."""

    def run(group: pa.Table) -> pa.Table:
        parts = group.column("part").to_numpy()
        pieces = group.column("piece").to_pylist()
        rows = [np.flatnonzero(parts == p) for p in np.unique(parts)]
        shards = [Shard([pieces[i] for i in some], length) for some in rows]
        # Two parts of one anchor meet to be compared with each other only.
        marks = [shards[0].repeated()] if len(shards) == 1 else shards[0].shared(shards[1])
        found = [
            (i, runs)
            for shard, some, mark in zip(shards, rows, marks)
            for i, a, b in zip(some.tolist(), shard.starts.tolist(), shard.ends.tolist())
            if len(runs := _runs(mark[a : b - length + 1]))
        ]
        at = pa.array([i for i, _ in found], pa.int64())
        return pa.table(
            {
                "hash": group.column("hash").take(at),
                "digest": group.column("digest").take(at),
                "runs": pa.array([r for _, r in found], pa.list_(pa.int32())),
            }
        )

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(2)
            n_bytes, n_removed, n_spans, digests, spans = [], [], [], [], []
            for row, data in _texts(batch.column(1)):
                joined = np.zeros((0, 2), np.int64)
                if found[row].is_valid:
                    lists = found[row].values
                    at, runs = lists.field("at").to_numpy(zero_copy_only=False), lists.field("runs")
                    sizes = np.diff(runs.offsets.to_numpy())
                    edges = np.repeat(at, sizes) + runs.flatten().to_numpy(zero_copy_only=False)
                    joined = repeats.merged(edges[::2], edges[1::2] + length - 1)
                digest, place, raw = hashlib.sha256(), 0, data.tobytes()
                for a, b in joined.tolist():
                    digest.update(raw[place:a])
                    place = b
                digest.update(raw[place:])
                n_bytes.append(len(data))
                n_removed.append(int((joined[:, 1] - joined[:, 0]).sum()))
                n_spans.append(len(joined))
                digests.append(digest.hexdigest())
                spans.append([{"first": a, "end": b} for a, b in joined.tolist()])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string()), pa.array(spans, kind)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
            )

    return run


def remove_repeated_bytes(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Bytes inside strings of ``length`` bytes that occur elsewhere: doc_id, n_bytes,
    n_removed, n_spans, kept_sha256, removed (spans of bytes).

    Each string of ``length`` bytes has an anchor, the 32 bytes in it of least hash; equal
    strings agree on it. Only passages around anchors that occur again are looked at. They
    are dealt to shards by anchor, equal passages once. A shard sorts its suffixes by their
    first ``length`` bytes (``ranked_suffixes``); strings that share a rank are repeated. The
    passages of an anchor that occurs over ``SHARD_PIECES`` times
    are spread over several shards, each different passage once, which are then compared in pairs by binary search of the one's windows
    in the other's suffix array.

    Null text is empty. Null doc_id and rows that repeat a doc_id are told apart by their
    texts; rows equal in both are one document, and each gets its result. Other columns are
    not read. Equal passages are known by 128 bits of their SHA-256.
    """
    base = repeats.keyed(docs, id_col, text_col)
    total = docs.select(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    n_shards = max(1, -(-int(total) // SHARD_BYTES))
    hits = repeats.repeated_anchors(base, _anchors(length))
    source = repeats.joined(base, hits, "inner").select("_id", "_row", "_text", "hits")
    kind = "_id bigint, _row bigint, hash bigint, total bigint, digest binary, at bigint, n int, piece binary"
    place = "_id bigint, _row bigint, at bigint, runs array<int>"

    dealt = mapped(source, _pieces(length, frequent=False), kind).select(
        "_id", "_row", "at", "hash", "piece", F.pmod(F.xxhash64("hash"), F.lit(n_shards)).alias("task")
    )
    found = dealt.groupBy("task").applyInArrow(_within(length), place)

    # Frequent anchors: one row for each different passage, in parts that meet in pairs.
    passages = mapped(source, _pieces(length, frequent=True), kind)
    spot = F.struct("_id", "_row", "at")
    distinct = passages.groupBy("hash", "digest").agg(
        F.max("total").alias("total"),
        F.min(spot).alias("least"),
        F.max(spot).alias("most"),
        F.first("piece").alias("piece"),
        F.max("n").alias("n"),
    )
    n_parts = F.ceil(F.col("total") / SHARD_PIECES).cast("int")
    pair = F.array(F.least("part", "other"), F.greatest("part", "other"))
    tasks = (
        distinct.withColumn("n_parts", n_parts)
        .withColumn("part", F.pmod(F.xxhash64("digest"), F.col("n_parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
        .select("hash", "digest", "piece", "part", F.array_join(pair, "/").alias("pair"))
    )
    judged = tasks.groupBy("hash", "pair").applyInArrow(_between(length), "hash bigint, digest binary, runs array<int>")
    twice = distinct.filter(F.col("least") != F.col("most")).select(
        "hash", "digest", F.array(F.lit(0), F.col("n")).alias("runs")
    )
    spots = mapped(source, _pieces(length, frequent=True, with_bytes=False), kind).select("_id", "_row", "hash", "digest", "at")
    known = judged.unionByName(twice).groupBy("hash", "digest").agg(
        F.flatten(F.collect_set("runs")).alias("runs")
    )
    frequent = spots.join(known, ["hash", "digest"]).select("_id", "_row", "at", "runs")
    lists = repeats.gather(found.unionByName(frequent), F.col("at"), F.col("runs"))
    final = repeats.joined(base, lists, "left").select(repeats.doc_id(), "_text", "found")
    return mapped(
        final,
        _cut(length),
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, removed array<struct<first:bigint,end:bigint>>",
    )
