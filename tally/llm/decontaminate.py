"""Benchmark decontamination by suffix arrays of the training texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm import words as w
from tally.llm.storage import mapped

WINDOW = 13
BLOCK_BYTES = 8 << 20

MATCH = "struct<item_id:bigint,doc_word:int,item_word:int,n_words:int>"
RESULT = f"doc_id bigint, n_words bigint, matches array<{MATCH}>"


def _left(first: np.ndarray) -> np.ndarray:
    """Words from each one to the end of its text, itself included."""
    return np.repeat(first[1:], np.diff(first)) - np.arange(first[-1] if len(first) else 0)


class SuffixArray:
    """All suffixes of a shard of texts, in the order of their words; each ends with its text.

    Words go by their 64-bit values. Suffixes are sorted by their first word, then those that
    are still equal by the rank of what follows, to 2, 4, 8, ... words (Larsson and Sadakane).
    """

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        self.hashes, self.left = hashes, _left(first)
        n = len(hashes)
        order = np.argsort(hashes, kind="stable")
        same = hashes[order[1:]] == hashes[order[:-1]]
        rank = np.empty(n, np.int64)
        places, active, reach = order, np.arange(n), 1
        while len(active):
            head = active.copy()
            head[1:][same] = 0
            rank[places] = np.maximum.accumulate(head)
            still = np.append(same, False) | np.append(False, same)
            active, places = active[still], places[still]
            if not len(active) or reach >= self.left[places].max():
                break
            after = np.where(self.left[places] > reach, rank[np.minimum(places + reach, n - 1)] + 1, 0)
            step = rank[places] * (n + 1) + after
            inner = np.argsort(step, kind="stable")
            places, step = places[inner], step[inner]
            order[active] = places
            same = step[1:] == step[:-1]
            reach *= 2
        self.order, self.firsts = order, hashes[order]

    def _bound(self, low, high, word, depth: int, over: bool) -> np.ndarray:
        """Where ``word`` belongs among the words ``depth`` after suffixes ``low`` to ``high``,
        after equal ones if ``over``. A suffix that has ended comes first."""
        low, high = low.copy(), high.copy()
        some = np.flatnonzero(low < high)
        while len(some):
            mid = (low[some] + high[some]) // 2
            at = self.order[mid]
            value = self.hashes[np.minimum(at + depth, len(self.hashes) - 1)]
            less = (value <= word[some]) if over else (value < word[some])
            less |= self.left[at] <= depth
            low[some[less]] = mid[less] + 1
            high[some[~less]] = mid[~less]
            some = some[low[some] < high[some]]
        return low

    def ranges(self, words: np.ndarray, starts: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with the ``need`` words at each of ``starts``, by binary
        search, a word at a time, within those that begin with the words before."""
        low = np.searchsorted(self.firsts, words[starts], side="left")
        high = np.searchsorted(self.firsts, words[starts], side="right")
        for depth in range(1, int(need.max(initial=0))):
            some = np.flatnonzero((low < high) & (need > depth))
            if not len(some):
                break
            word = words[starts[some] + depth]
            first = self._bound(low[some], high[some], word, depth, over=False)
            high[some] = self._bound(first, high[some], word, depth, over=True)
            low[some] = first
        return low, np.maximum(low, high)


class Benchmark:
    """The suffixes of a block of test items that can begin a match."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        column = pa.array([t for _, t in items], pa.large_string())
        data, offsets = w.buffers(column)
        found = w.words_of(data, offsets, w.NOT_ALPHANUMERIC)
        self.hashes, self.left = found.hashes(fold=True), _left(found.first)
        sizes = np.diff(found.first)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(len(owner)) - found.first[owner]
        self.item = np.array([i for i, _ in items], np.int64)[owner]
        # A match has this many words at least: a window, or a whole item of fewer.
        need = np.minimum(sizes, window)[owner]
        self.starts = np.flatnonzero(self.left >= need)
        self.need = need[self.starts]

    def matches(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Longest matches in a shard: (word of the shard, item id, word of the item, length).

        Every test suffix is looked up in the shard's suffix array. Of the places found those
        count that no match goes on to from the word before, and each is followed to its end.
        """
        if not len(hashes) or not len(self.starts):
            return (np.zeros(0, np.int64),) * 4
        shard = SuffixArray(hashes, first)
        low, high = shard.ranges(self.hashes, self.starts, self.need)
        count = high - low
        which = np.repeat(np.arange(len(count)), count)
        step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        at, test = shard.order[low[which] + step], self.starts[which]
        begins = np.zeros(len(hashes), bool)
        begins[first[:-1][np.diff(first) > 0]] = True
        new = begins[at] | (self.place[test] == 0) | (hashes[at - 1] != self.hashes[test - 1])
        at, test, size = at[new], test[new], self.need[which[new]]
        room = np.minimum(shard.left[at], self.left[test])
        some = np.flatnonzero(size < room)
        while len(some):
            some = some[hashes[at[some] + size[some]] == self.hashes[test[some] + size[some]]]
            size[some] += 1
            some = some[size[some] < room[some]]
        order = np.lexsort((at, at - self.place[test], self.item[test]))
        at, test = at[order], test[order]
        return at, self.item[test], self.place[test], size[order]


def _searcher(items: list[tuple[int, str]], window: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = Benchmark(items, window)
        for batch in batches:
            counts, rows = [], []
            for _, _, shard in w.each_run(batch.column(1), w.NOT_ALPHANUMERIC):
                text_of = shard.text_of()
                hits = benchmark.matches(shard.hashes(fold=True), shard.first)
                counts.append(np.diff(shard.first))
                lists: list[list] = [[] for _ in range(len(shard.first) - 1)]
                for at, item, place, size in zip(*(x.tolist() for x in hits)):
                    text = int(text_of[at])
                    lists[text].append(
                        {"item_id": item, "doc_word": at - int(shard.first[text]), "item_word": place, "n_words": size}
                    )
                rows += lists
            n_words = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            kind = pa.list_(
                pa.struct([("item_id", pa.int64()), ("doc_word", pa.int32()), ("item_word", pa.int32()), ("n_words", pa.int32())])
            )
            yield pa.record_batch(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(rows, kind)],
                ["doc_id", "n_words", "matches"],
            )

    return search


def blocks(items: DataFrame, most: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of at most ``most`` bytes of text, or of one longer item."""
    block: list[tuple[int, str]] = []
    size = 0
    for item_id, text in items.toLocalIterator():
        n = len(text.encode())
        if block and size + n > most:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += n
    if block:
        yield block


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Longest verbatim matches of benchmark items in each document.

    Words are runs of ASCII digits and letters (A-Z as a-z) and non-ASCII characters. A match
    is at least ``window`` words long, or a whole item of fewer words. Returns one row per
    input row: doc_id, n_words, matches (item_id, first word in document and item, length).

    Each task builds the suffix arrays of its shards of documents, looks every test suffix up
    by binary search, and follows what it finds to the end. The benchmark goes to all tasks in blocks of at most ``block_bytes`` of
    text; a larger benchmark takes several passes over the documents, whose matches are then
    put together by text. A match over 64-bit word values stands for one over words.

    Null text has no words; null doc_id is carried along. Repeated rows are searched one by
    one and all come back, whatever the number of passes. Items without id or words match
    nothing. Other columns are not read.
    """
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text")).dropna()
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    first, *others = list(blocks(items, block_bytes)) or [[]]
    if not others:
        return mapped(source, _searcher(first, window), RESULT)
    return _gathered(source, first, others, window).drop("_digest")


def _gathered(source: DataFrame, first, others, window: int) -> DataFrame:
    """Matches of several blocks in each row of ``source``, with the digest of its text."""
    rest = None
    for k, block in enumerate(others):
        found = _with_digest(source, block, window).select("_digest", "matches", F.lit(k).alias("_pass"))
        rest = found if rest is None else rest.unionByName(found)
    # Matches follow from the text alone, so rows of one text have the same in each pass.
    rest = (
        rest.groupBy("_digest", "_pass")
        .agg(F.first("matches").alias("matches"))
        .groupBy("_digest")
        .agg(F.flatten(F.collect_list("matches")).alias("_more"))
    )
    return (
        _with_digest(source, first, window, all_rows=True)
        .join(rest, "_digest", "left")
        .select("doc_id", "_digest", "n_words", F.when(F.col("_more").isNull(), F.col("matches")).otherwise(F.concat("matches", "_more")).alias("matches"))
    )


def _digest(text) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def _with_digest(source: DataFrame, block, window: int, all_rows: bool = False) -> DataFrame:
    """As one pass, with a digest of the text, by which passes are put together."""
    search = _searcher(block, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in search(iter([batch])):
                whole = pa.record_batch([*out.columns, batch.column(2)], [*out.schema.names, "_digest"])
                keep = pa.array([all_rows or bool(x) for x in out.column(2).to_pylist()], pa.bool_())
                yield whole.filter(keep)

    return mapped(source.select("doc_id", "_text", _digest(F.col("_text")).alias("_digest")), run, f"{RESULT}, _digest string")


def judged(matches: DataFrame) -> DataFrame:
    """Counts over ``find_matches``: doc_id, n_words, n_hit, n_items, items, contaminated.

    A word inside any match is hit once. A document is contaminated when at least one word in
    twenty is hit.
    """
    spans = F.array_sort(
        F.transform("matches", lambda m: F.struct(m["doc_word"].alias("at"), (m["doc_word"] + m["n_words"]).alias("to")))
    )
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("reach"))
    total = F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct(
            (acc["hit"] + F.greatest(F.lit(0), s["to"] - F.greatest(s["at"], acc["reach"]))).alias("hit"),
            F.greatest(acc["reach"], s["to"]).alias("reach"),
        ),
        lambda acc: acc["hit"],
    )
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string"))))
    n_hit = F.col("n_hit")
    return (
        matches.withColumn("n_hit", total)
        .withColumn("items", items)
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            "items",
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without contaminated rows; the other rows and all columns stay as they are.

    A row is judged by its text alone. For a benchmark of one block that happens within the
    task that holds it, so nothing is shuffled. For several blocks hits are gathered in one
    pass after another, and rows are told by a digest of their text: neither a null doc_id
    nor one shared with a contaminated row costs a clean row.
    """
    items = list(blocks(benchmark.select(F.col("item_id").cast("long"), F.col("text")).dropna(), block_bytes))
    if len(items) > 1:
        text = F.col(f"`{text_col}`")
        source = docs.select(F.lit(None).cast("long").alias("doc_id"), text.cast("string").alias("_text"))
        found = _gathered(source, items[0], items[1:], window)
        found = judged(found.select(F.col("_digest").alias("doc_id"), "n_words", "matches"))
        bad = found.filter("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
        row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
        rows = docs.select(row, _digest(text).alias("_of"))
        return rows.join(bad, F.col("_of") == F.col("_bad"), "left_anti").select("_row.*")
    block = items[0] if items else []
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Benchmark(block, window)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for i, _, shard in w.each_run(batch.column(place), w.NOT_ALPHANUMERIC):
                text_of = shard.text_of()
                at, _, _, size = index.matches(shard.hashes(fold=True), shard.first)
                hit = np.zeros(len(shard.starts) + 1, np.int64)
                np.add.at(hit, at, 1)
                np.add.at(hit, at + size, -1)
                n_hit = np.bincount(text_of[np.cumsum(hit[:-1]) > 0], minlength=len(shard.first) - 1)
                bad = (n_hit > 0) & (20 * n_hit >= np.diff(shard.first))
                clean[i : i + len(bad)] = ~bad
            yield batch.filter(pa.array(clean))

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    return mapped(docs, keep, schema)
