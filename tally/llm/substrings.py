"""Substring dedup on words, by level-wise doubling of repeated windows."""

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

WINDOW = 20
# Bytes of corpus behind a shard of candidates, and occurrences of a half window in a shard.
SHARD_BYTES = 4 << 20
SHARD_RUNS = 4096


def _runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, w.Words]]:
    """Word values of each text: (row, values, run of texts that it lies in)."""
    for i, _, run in w.each_run(column, w.SPACES):
        values = run.hashes(fold=False)
        for k, (a, b) in enumerate(zip(run.first.tolist(), run.first[1:].tolist())):
            yield i + k, values[a:b], run


def _half_anchors(window: int):
    half = window // 2

    def find(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        for row, values, _ in _runs(column):
            if len(values) >= window:
                grams = w.mix(w.grams(values, half))
                yield row, grams[repeats.anchors(grams, window - half + 1)[1]]

    return find


def _whole_windows(window: int, frequent: bool):
    """Windows of twice the length around a repeated one, in runs that share it.

    Those around frequent ones (over ``SHARD_RUNS`` occurrences) and the others are asked for
    separately.
    """
    half = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column(3)
            rows, anchor, totals, places, keys = [], [], [], [], []
            for row, values, _ in _runs(batch.column(2)):
                known = hits[row].values.field("hash").to_numpy(zero_copy_only=False).view(np.uint64)
                total = hits[row].values.field("total").to_numpy(zero_copy_only=False)
                some = (total > SHARD_RUNS) == frequent
                if not some.any():
                    continue
                order = np.argsort(known[some])
                known, total = known[some][order], total[some][order]
                short = w.grams(values, half)
                whole = w.longer(short, half) if window == 2 * half else w.grams(values, window)
                least = repeats.anchors(w.mix(short), window - half + 1)[0]
                new = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
                end = np.append(new[1:], len(least))
                slot = np.minimum(np.searchsorted(known, least[new]), len(known) - 1)
                hit = known[slot] == least[new]
                whole = w.mix(whole).view(np.int64)
                for a, b, n in zip(new[hit].tolist(), end[hit].tolist(), total[slot[hit]].tolist()):
                    rows.append(row)
                    totals.append(n)
                    anchor.append(least[a])
                    places.append(a)
                    keys.append(whole[a:b])
            at = pa.array(rows, pa.int64())
            yield pa.record_batch(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(np.array(anchor, np.uint64).view(np.int64)),
                    pa.array(totals, pa.int64()),
                    pa.array(places, pa.int32()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["_id", "_row", "hash", "total", "at", "keys"],
            )

    return run


def _split(doc, text, at, value) -> tuple[np.ndarray, np.ndarray]:
    """Windows that are not the first of their words, and those that are."""
    order = np.lexsort((at, text, doc, value))
    if not len(order):
        return order, order
    same = np.append(False, value[order][1:] == value[order][:-1])
    start = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    # Rows that repeat a document repeat its places, and are as early as it.
    late = (doc[order] != doc[start]) | (text[order] != text[start]) | (at[order] != at[start])
    return np.sort(order[late]), order[~same]


def _windows(group: pa.Table) -> tuple[np.ndarray, ...]:
    """(document, text, place, value) of the windows of a group of runs."""
    keys = group.column("keys").combine_chunks()
    sizes = np.diff(keys.offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    doc, text, at = (group.column(c).to_numpy()[row] for c in ("_id", "_row", "at"))
    return doc, text, at + step, keys.flatten().to_numpy(zero_copy_only=False)


def _lists(doc: np.ndarray, text: np.ndarray, at: np.ndarray) -> dict[str, pa.Array]:
    """Places by document."""
    order = np.lexsort((at, text, doc))
    doc, text, at = doc[order], text[order], at[order]
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]))) if len(doc) else order
    offsets = pa.array(np.append(new, len(doc)), pa.int32())
    return {
        "_id": pa.array(doc[new]),
        "_row": pa.array(text[new]),
        "at": pa.ListArray.from_arrays(offsets, pa.array(at.astype(np.int32))),
    }


def _later(group: pa.Table) -> pa.Table:
    doc, text, at, value = _windows(group)
    late, _ = _split(doc, text, at, value)
    return pa.table(_lists(doc[late], text[late], at[late]))


FIELDS = ("_ids", "_rows", "_ats", "_values")


def _later_here(n_shards: int):
    """As ``_later`` within one part of a frequent half window. The part's own first ones
    are handed on, packed by shard of their words, to be compared with those of others."""

    def run(group: pa.Table) -> pa.Table:
        doc, text, at, value = columns = _windows(group)
        late, first = _split(*columns)
        lists = _lists(doc[late], text[late], at[late])
        shard = (value[first].view(np.uint64) % np.uint64(n_shards)).astype(np.int64)
        first, shard = first[np.argsort(shard, kind="stable")], np.sort(shard)
        new = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
        offsets = pa.array(np.append(new, len(shard)), pa.int32())
        n, m = len(lists["_id"]), len(new)
        none = [None] * m
        out = {k: pa.concat_arrays([v, pa.array(none, v.type)]) for k, v in lists.items()}
        out["shard"] = pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(shard[new])])
        for name, column in zip(FIELDS, columns):
            packed = pa.ListArray.from_arrays(offsets, pa.array(column[first].astype(np.int64)))
            out[name] = pa.concat_arrays([pa.nulls(n, packed.type), packed])
        return pa.table(out)

    return run


def _later_of_firsts(group: pa.Table) -> pa.Table:
    columns = [group.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False) for name in FIELDS]
    late, _ = _split(*columns)
    return pa.table(_lists(*(c[late] for c in columns[:3])))


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(2)
            n_words, n_removed, digests, spans = [], [], [], []
            for i, j, words in w.each_run(batch.column(1), w.SPACES):
                for row in range(i, j):
                    a, b = words.first[row - i], words.first[row - i + 1]
                    cover = np.zeros(b - a + 1, np.int32)
                    joined: np.ndarray = np.zeros((0, 2), np.int64)
                    if found[row].is_valid:
                        at = np.unique(found[row].values.field("at").flatten().to_numpy(zero_copy_only=False))
                        joined = repeats.spans_array(at, window)
                        cover[joined[:, 0]] += 1
                        np.add.at(cover, joined[:, 1], -1)
                    keep = np.cumsum(cover[:-1]) == 0
                    raw = words.data.tobytes() if row == i else raw
                    kept = b" ".join(
                        raw[x:y] for x, y in zip(words.starts[a:b][keep].tolist(), words.ends[a:b][keep].tolist())
                    )
                    n_words.append(b - a)
                    n_removed.append(b - a - int(keep.sum()))
                    digests.append(hashlib.sha256(kept).hexdigest())
                    spans.append([{"first": int(x), "end": int(y)} for x, y in joined])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
            yield pa.record_batch(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(spans, kind)],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"],
            )

    return run


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Words inside windows that occur earlier: doc_id, n_words, n_removed, kept_sha256,
    removed (spans of word numbers).

    A window is ``window`` words in a row of one document. It is removed if the same words
    also start earlier: in a document of smaller doc_id, or before it in the same one.

    Level one looks at half windows. Of those inside a window only the one of least hash is
    counted; equal windows agree on it. Where it occurs once only, no window around it
    repeats. What is left is extended to whole windows, and all but their first occurrence
    are removed. Half windows that are chosen by content are a sixth of all words, and only
    candidates are extended.

    Texts are shuffled once, by id, and read from that shuffle again. Whole windows are dealt
    to shards by their half window. Windows around one that occurs over ``SHARD_RUNS`` times
    are first dealt to parts of about that many by document; only the first ones of a part go
    on to a shard for their words, so a window of a third of all documents arrives there
    once for each part.

    Null or empty text has no words. Null doc_id counts as the smallest. Rows equal in id and
    text are one document, of which each row gets the result; where rows of one id differ,
    their texts are told apart, in a fixed order. Other columns are not read. Words are
    compared by 64-bit values of their sequences.
    """
    base = repeats.keyed(docs, id_col, text_col)
    total = docs.select(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    n_shards = max(1, -(-int(total) // SHARD_BYTES))
    hits = repeats.repeated_anchors(base, _half_anchors(window))
    source = repeats.joined(base, hits, "inner").select("_id", "_row", "_text", "hits")
    kind = "_id bigint, _row bigint, hash bigint, total bigint, at int, keys array<bigint>"
    place = "_id bigint, _row bigint, at array<int>"

    rare = mapped(source, _whole_windows(window, frequent=False), kind)
    dealt = rare.withColumn("task", F.pmod(F.xxhash64("hash"), F.lit(n_shards)))
    later = dealt.groupBy("task").applyInArrow(_later, place)

    common = mapped(source, _whole_windows(window, frequent=True), kind)
    part = F.pmod(F.xxhash64("_id", "_row"), F.ceil(F.col("total") / SHARD_RUNS))
    packed = ", ".join(f"{name} array<bigint>" for name in FIELDS)
    here = common.withColumn("part", part).groupBy("hash", "part").applyInArrow(
        _later_here(n_shards), f"{place}, shard bigint, {packed}"
    )
    among = here.filter(F.col("shard").isNotNull()).groupBy("shard").applyInArrow(_later_of_firsts, place)
    often = here.filter(F.col("shard").isNull()).select("_id", "_row", "at").unionByName(among)
    lists = repeats.gather(later.unionByName(often), F.col("at"))
    final = repeats.joined(base, lists, "left").select(repeats.doc_id(), "_text", "found")
    kind = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, removed array<struct<first:int,end:int>>"
    return mapped(final, _remove(window), kind)
