"""Similarity join on word n-gram sets, by partitions of the universe of n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm import words as w
from tally.llm.components import components
from tally.llm.storage import cut, discard, mapped, table

WORDS = 5
# Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
# Shingles to a segment at the upper end of a size band, in lists at large and in long ones.
# Sets of fewer than ``SMALL`` shingles have each shingle for a segment: hashed into few
# segments they could fill too few of them.
SEGMENT = 3
FINE_SEGMENT = 1
SMALL = 128
# Sets that share a signature and are compared with each other without further ado.
SHORT_LIST = 32

_SEGMENT_SALT = np.uint64(0xA0761D6478BD642F)
_BAND_SALT = np.uint64(0xE7037ED1A0B428DB)
_MEMBER_SALT = np.uint64(0x8EBC6AF09C88C6E3)

# What a signature of the index stands for: a segment, a segment less one, a member.
WHOLE, LESS, MEMBER = range(3)


def shingle_sets(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sorted distinct shingle values of each text, by row."""
    for i, _, run in w.each_run(column, w.SPACES):
        hashes = run.hashes(fold=True)
        grams = w.mix(w.grams(hashes, length))
        for k, (a, b) in enumerate(zip(run.first.tolist(), run.first[1:].tolist())):
            n = b - a
            if n >= length:
                yield i + k, np.unique(grams[a : b - length + 1])
            elif n:
                yield i + k, w.mix(w.grams(hashes[a:b], n) + np.uint64(n))
            else:
                yield i + k, np.zeros(0, np.uint64)


def most_different(size: int, percent: int = PERCENT) -> int:
    """How many shingles a set of ``size`` and one linked with it can differ in."""
    partner = 100 * size // percent
    return (size + partner) * (100 - percent) // (100 + percent)


def bands(size: int, percent: int = PERCENT) -> range:
    """Size bands, by powers of two, that hold the set and sets it can link with as the smaller."""
    return range(size.bit_length() - 1, (100 * size // percent).bit_length())


def _band_salt(band: int) -> np.uint64:
    return np.uint64((band + 1) * int(_BAND_SALT) & ((1 << 64) - 1))


def _one_each(band: int) -> bool:
    """Whether each shingle is a segment of its own in a band."""
    return (2 << band) - 1 < SMALL


def segment_of(values: np.ndarray, band: int, percent: int, per: int) -> np.ndarray:
    """The segment of each of the sorted values, in order."""
    if _one_each(band):
        return values
    top = (2 << band) - 1
    m = max(top // per, most_different(top, percent) + 1)
    return ((values >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)


def segments(
    values: np.ndarray, band: int, percent: int = PERCENT, per: int = SEGMENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a sorted set that hold something: (signature, size, first place)."""
    number = segment_of(values, band, percent, per)
    first = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    sums = np.add.reduceat(w.mix(values), first)
    salt = number[first] * _SEGMENT_SALT + _band_salt(band)
    return w.mix(sums + salt), np.diff(np.append(first, len(values))), first


def allocate(values: np.ndarray, band: int, percent: int = PERCENT) -> np.ndarray:
    """Signatures of the segments that the set is indexed by in a band.

    Linked sets differ in at most ``d`` shingles, so in at most ``d`` segments. Of all
    signatures in one fixed order each keeps the first ``d + 1``; the first that both have
    is then among what both keep. Long segments come first: they are the rare ones, so the
    ones left out are those whose lists would cost most.
    """
    signature, size, _ = segments(values, band, percent)
    keep = most_different(len(values), percent) + 1
    if keep >= len(signature):
        return signature
    return signature[np.lexsort((signature, -size))[:keep]]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _describe(length: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, rows = [], [], []
            seen: set[int] = set()
            named = batch.column(0).is_valid().to_pylist()
            for row, values in shingle_sets(batch.column(1), length):
                sizes.append(len(values))
                name = w.mix(np.add.reduce(w.mix(values + np.uint64(1)), keepdims=True) + np.uint64(len(values)))
                names.append(int(_signed(name)[0]))
                parts = []
                # Copies within a batch are indexed once.
                if len(values) and named[row] and names[-1] not in seen:
                    seen.add(names[-1])
                    parts = [allocate(values, band, percent) for band in bands(len(values), percent)]
                rows.append(_signed(np.concatenate(parts)) if parts else np.zeros(0, np.int64))
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(rows, pa.list_(pa.int64()))],
                ["doc_id", "digest", "n", "set", "signatures"],
            )

    return run


def most_lacking(size: int, percent: int = PERCENT) -> int:
    """How many shingles of a set of ``size`` a linked set that is not smaller can lack."""
    return size - -(-2 * percent * size // (100 + percent))


def _neighbours(length: int, percent: int):
    """All segments of a set, all of their one-deletion neighbourhoods, and their subsets of
    one member. Segments are numbered within their set and band. Where every shingle has a
    segment of its own, whole segments are the members, and only these are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(5)]
            for row, values in shingle_sets(batch.column(1), length):
                for band in bands(len(values), percent) if len(values) else ():
                    whole, size, first = segments(values, band, percent, FINE_SEGMENT)
                    number = np.repeat(np.arange(len(whole)), size)
                    alone = _one_each(band)
                    # A segment's sum without one member, under the same salt. What is left
                    # of a single member is an empty segment, which is not indexed.
                    mixed = w.mix(values)
                    place = segment_of(values, band, percent, FINE_SEGMENT)
                    salt = place * _SEGMENT_SALT + _band_salt(band)
                    less = w.mix(np.add.reduceat(mixed, first)[number] - mixed + salt)
                    some = size[number] > 1
                    kinds = (
                        (WHOLE, number[first], whole),
                        (LESS, number[some], less[some]),
                        (MEMBER, number, w.mix(mixed + _MEMBER_SALT + _band_salt(band))),
                    )
                    for kind, segment, signature in kinds[2:] if alone else kinds:
                        n = len(signature)
                        for column, value in zip(
                            out,
                            (np.full(n, row), np.full(n, band), segment, np.full(n, kind), _signed(signature)),
                        ):
                            column.append(value)
            flat = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
            yield pa.record_batch(
                [batch.column(0).take(pa.array(flat[0])), *(pa.array(c.astype(np.int32)) for c in flat[1:4]), pa.array(flat[4])],
                ["set", "band", "segment", "kind", "signature"],
            )

    return run


def _choose(percent: int):
    """Cost-based allocation of one set, band by band: which of its signatures it looks up
    (``asks``), whether with the neighbourhood (``deep``), and what that costs (``price``);
    and which can be met by another set's looking up (``offers``).

    Members have one order in all sets, by cost and then by signature. Of two linked sets
    the one that is not larger lacks few of the other's members, and the other few of its
    own: in that order the first members of the one, which it looks up, and the first of the
    other, which alone it offers, have one in common. So a set with rare members of its own
    is not met through a passage that many sets hold.
    """

    def in_band(group: pa.Table, n: int) -> pa.Table:
        segment = group.column("segment").to_numpy()
        kind = group.column("kind").to_numpy()
        cost = group.column("cost").to_numpy()
        need = most_different(n, percent) + 1
        names, at = np.unique(segment, return_inverse=True)
        one = np.bincount(at, np.where(kind == WHOLE, cost, 0), len(names))
        two = np.bincount(at, np.where(kind == LESS, cost, 0), len(names))
        # A single member has no neighbourhood to look up.
        two[np.bincount(at, kind == LESS, len(names)) == 0] = np.inf
        # Each segment can first be looked up whole, then with its neighbourhood as well.
        steps = np.concatenate([one, np.maximum(two, one)])
        order = np.argsort(steps, kind="stable")[:need]
        level = np.bincount(order % len(names), minlength=len(names))
        # Or single members: all but ``most_lacking`` of them are in the partner.
        members = np.flatnonzero(kind == MEMBER)
        ordered = members[np.lexsort((group.column("signature").to_numpy()[members], cost[members]))]
        members = ordered[: most_lacking(n, percent) + 1]
        offers = kind != MEMBER
        offers[ordered[: n - -(-percent * n // 100) + 1]] = True
        by_segment, by_member = float(steps[order].sum()), float(cost[members].sum())
        if not (kind == WHOLE).any():
            # As many members as this, or more, would be looked up as segments.
            by_segment = np.inf
        if by_member <= by_segment:
            asks = np.zeros(len(kind), bool)
            asks[members] = True
        else:
            asks = ((kind == WHOLE) & (level[at] >= 1)) | ((kind == LESS) & (level[at] == 2))
        # A member that no other set has meets none.
        met = (kind != MEMBER) | (cost > 1)
        return (
            group.select(["set", "band", "kind", "signature"])
            .append_column("asks", pa.array(asks))
            .append_column("offers", pa.array(offers))
            .append_column("deep", pa.array(level[at] == 2))
            .append_column("price", pa.array(np.full(len(kind), min(by_segment, by_member))))
            .filter(pa.array((asks | offers) & met))
        )

    def run(index: pa.Table, sets: pa.Table) -> pa.Table:
        n, component = (int(sets.column(c)[0].as_py()) for c in ("n", "component"))
        band = index.column("band").to_numpy()
        chosen = pa.concat_tables([in_band(index.filter(pa.array(band == b)), n) for b in np.unique(band)])
        for name, value in (("n", n), ("component", component)):
            chosen = chosen.append_column(name, pa.array(np.full(chosen.num_rows, value, np.int64)))
        return chosen

    return run


def _verify(length: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = {row: v for row, v in shingle_sets(batch.column(2), length)}
            linked = np.zeros(batch.num_rows, bool)
            for row, b in shingle_sets(batch.column(3), length):
                a = left[row]
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked[row] = 100 * both >= percent * (len(a) + len(b) - both)
            yield pa.record_batch(batch.columns[:2], ["one", "other"]).filter(pa.array(linked))

    return run


def _lists(described: DataFrame) -> DataFrame:
    """Sets under each signature that two or more of them keep: (signature, set, n)."""
    rows = described.filter(F.col("doc_id").isNotNull()).select("set", "n", F.explode("signatures").alias("signature"))
    again = rows.groupBy("signature").agg(F.count("*").alias("_times")).filter(F.col("_times") > 1)
    return table(rows.join(again.select("signature"), "signature").distinct())


def similar_sets(
    docs: DataFrame, length: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", count_links: bool = True
) -> DataFrame:
    """Documents linked by n-gram similarity: doc_id, n_shingles, n_links, component_id.

    Two documents link when ``100 * intersection >= percent * union`` of their sets of
    ``length``-word shingles (A-Z as a-z). A text of fewer words is one shingle; one without
    words has an empty set and no link. component_id is the smallest doc_id reachable over
    links, the document's own included. n_links is the number of other documents that a
    document links with, copies included. To count them every candidate pair of different
    sets is checked, as many as the square of a group of near copies; without
    ``count_links`` the column is left out, and components need far fewer checks.

    Equal sets are one node. Sets are cut into segments by hash, as many for each size band
    that linked sets must agree in one of those kept (``allocate``). Sets in one list are
    first compared with one of them only; lists that are then within one component are done,
    which keeps large groups of near copies linear. Short lists left are compared in full.
    In a long list left, which many unlinked sets share, each set weighs what its segments,
    their one-deletion neighbourhoods and their subsets of one member would cost, gives up
    the dear ones and looks up the cheap ones (``_choose``). Of two sets, one looks the other
    up. All candidates are checked on the texts.

    Rows of null doc_id get no link and no component. Rows that repeat a doc_id are one
    document: links of all its texts count, n_shingles is the largest, one row comes back.
    Other columns are not read. Shingles are compared by 64-bit values.
    """
    answer, links = _nodes(docs, length, percent, id_col, text_col, count_links)
    one_row = answer.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("n").alias("n_shingles"),
        F.min(F.coalesce("_least", "doc_id")).alias("component_id"),
    )
    without = answer.filter(F.col("doc_id").isNull()).select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    found = one_row.unionByName(without)
    if not count_links:
        return found
    n_links = F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    return found.join(_count_links(answer, links), "doc_id", "left").select("doc_id", "n_shingles", n_links, "component_id")


def _count_links(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """How many other documents each document links with: (doc_id, n_links).

    A document with one set counts as its set, so copies are not expanded: a linked set
    stands for as many documents as have it alone. Documents with several sets are counted
    one by one, as they can be linked by more than one of them.
    """
    held = nodes.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).select("doc_id", "set").distinct()
    many = held.groupBy("doc_id").agg((F.count("*") > 1).alias("_many"))
    held = cut(held.join(many, "doc_id"))
    alone = held.filter(~F.col("_many")).groupBy("set").agg(F.count("*").alias("_alone"))
    several = held.filter("_many").select(F.col("doc_id").alias("_several"), "set")
    # A set is linked with itself: copies link.
    linked = links.unionByName(links.select(F.col("other").alias("one"), F.col("one").alias("other")))
    own = held.select(F.col("set").alias("one"), F.col("set").alias("other")).distinct()
    linked = cut(linked.unionByName(own).distinct())

    def reached(ends: DataFrame) -> DataFrame:
        """Documents that the sets of a unit reach, its own included: (_unit, _reached)."""
        pairs = cut(ends.join(linked, ends["set"] == linked["one"]).select("_unit", "other").distinct())
        by_set = pairs.join(alone, pairs["other"] == alone["set"]).select("_unit", F.col("_alone").alias("_n"))
        by_doc = pairs.join(several, pairs["other"] == several["set"]).select("_unit", "_several").distinct()
        both = by_set.unionByName(by_doc.select("_unit", F.lit(1).cast("long").alias("_n")))
        return both.groupBy("_unit").agg(F.sum("_n").alias("_reached"))

    of_set = reached(alone.select("set", F.col("set").alias("_unit")))
    of_doc = reached(several.select("set", F.col("_several").alias("_unit")))
    n_links = (F.col("_reached") - 1).alias("n_links")
    single = held.filter(~F.col("_many")).join(of_set, F.col("set") == F.col("_unit")).select("doc_id", n_links)
    return single.unionByName(of_doc.select(F.col("_unit").alias("doc_id"), n_links))


def _columns(id_col: str, text_col: str) -> list[Column]:
    text = F.col(text_col).cast("string")
    return [F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"), F.xxhash64(text).alias("digest")]


def _nodes(
    docs: DataFrame, length: int, percent: int, id_col: str, text_col: str, every_link: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Each row with its set: doc_id, digest of the text, n, set, and the smallest doc_id of
    the set's component (_least) where that holds more than this row. And links between
    sets (one, other): with ``every_link`` all, else as many as give the components."""
    source = docs.select(*_columns(id_col, text_col))
    described = table(
        mapped(
            source.select("doc_id", "_text", "digest"),
            _describe(length, percent),
            "doc_id bigint, digest bigint, n bigint, set bigint, signatures array<bigint>",
        )
    )
    members = _lists(described)
    # The signatures, most of the table, are in the lists now.
    slim = table(described.select("doc_id", "digest", "n", "set"))
    discard(described)
    described = slim
    known = described.filter(F.col("doc_id").isNotNull())
    sets = (
        known.filter(F.col("n") > 0)
        .groupBy("set", "n")
        .agg(F.min(F.struct("doc_id", "digest")).alias("_first"))
    )
    repeated = not known.groupBy("doc_id", "digest").agg(F.count("*").alias("_times")).filter(F.col("_times") > 1).isEmpty()

    base = source.filter(F.col("doc_id").isNotNull())
    named = sets.select("set", F.col("_first.doc_id").alias("_owner"), F.col("_first.digest").alias("_of"))

    def texts(wanted: DataFrame) -> DataFrame:
        """One text for each set: of its owner's texts the one that has this set."""
        owned = wanted.join(named, "set")
        on = (owned["_owner"] == base["doc_id"]) & (owned["_of"] == base["digest"])
        found = owned.join(base, on)
        # Rows equal in doc_id and text would each give it.
        found = found.dropDuplicates(["doc_id", "digest", "set"]) if repeated else found
        return found.select("set", "_text")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = table(pairs.distinct())
        wanted = pairs.select(F.explode(F.array("one", "other")).alias("set")).distinct()
        text = texts(wanted)
        left = pairs.join(text.select(F.col("set").alias("one"), F.col("_text").alias("_left")), "one")
        both = left.join(text.select(F.col("set").alias("other"), F.col("_text").alias("_right")), "other")
        linked = mapped(both.select("one", "other", "_left", "_right"), _verify(length, percent), "one bigint, other bigint")
        linked = cut(linked.distinct())
        discard(pairs)
        return linked

    def near(a, b):
        return (100 * F.least(a, b) >= percent * F.greatest(a, b))

    # The set that lies in most lists leads them: what many sets are copies of, with changes
    # of their own, shares more of its segments than any of them.
    degree = members.groupBy("set").agg(F.count("*").alias("_degree"))
    lead = members.join(degree, "set").groupBy("signature").agg(F.max(F.struct("_degree", "set", "n")).alias("lead"))
    lead = table(lead)
    led = members.join(lead, "signature").filter(F.col("set") != F.col("lead.set"))
    links = verified(
        led.filter(near(F.col("n"), F.col("lead.n"))).select(
            F.least("lead.set", "set").alias("one"), F.greatest("lead.set", "set").alias("other")
        )
    )
    found = components(links, "one", "other")

    placed = members.join(found.select(F.col("node").alias("set"), "component"), "set", "left").withColumn(
        "component", F.coalesce("component", "set")
    )
    if every_link:
        # No pair is known to need no check.
        placed = members.withColumn("component", F.col("set"))
    state = placed.groupBy("signature").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("_size")
    )
    open_lists = state.filter(F.col("_low") != F.col("_high")).join(
        lead.select("signature", F.col("lead.set").alias("_lead")), "signature"
    ).select("signature", "_lead", "_size")
    unsettled = table(placed.join(open_lists, "signature"))
    short = unsettled.filter((F.col("_size") <= SHORT_LIST) & (F.col("set") != F.col("_lead")))
    a, b = short.alias("a"), short.alias("b")
    pairs = a.join(b, F.col("a.signature") == F.col("b.signature")).filter(
        (F.col("a.set") < F.col("b.set")) & (F.col("a.component") != F.col("b.component")) & near(F.col("a.n"), F.col("b.n"))
    ).select(F.col("a.set").alias("one"), F.col("b.set").alias("other"))

    long = unsettled.filter(F.col("_size") > SHORT_LIST).select("set", "n", "component").distinct()
    long = table(long)
    done = [members, lead, unsettled, long]
    if not long.isEmpty():
        index = mapped(texts(long.select("set")), _neighbours(length, percent), "set bigint, band int, segment int, kind int, signature bigint")
        # What a set has only one of comes to it at the end: rows of the index are many.
        index = table(index)
        # Looking a segment up whole meets whole ones; its neighbours meet whole ones, and
        # with them it also meets the neighbours of others. Members meet members.
        cost = index.groupBy("signature").agg(F.sum((F.col("kind") != LESS).cast("long")).alias("cost"))
        priced = index.join(cost, "signature").select("set", "band", "segment", "kind", "signature", "cost")
        asked = table(
            priced.groupBy("set").cogroup(long.groupBy("set")).applyInArrow(
                _choose(percent),
                "set bigint, band int, kind int, signature bigint, asks boolean, offers boolean, deep boolean, price double, n bigint, component bigint",
            )
        )
        discard(index)
        done.append(asked)
        # One of two sets looks the other up: the smaller, or of equal ones that with the
        # lower price. A set that differs much from all others in its lists then meets none.
        p, q = asked.filter("asks").alias("p"), asked.filter("offers").alias("q")
        meets = (F.col("q.kind") != LESS) | (F.col("p.deep") & (F.col("p.kind") == WHOLE))
        turn = F.struct("p.n", "p.price", "p.set") < F.struct("q.n", "q.price", "q.set")
        on = (F.col("p.signature") == F.col("q.signature")) & (F.col("p.band") == F.col("q.band"))
        more = p.join(q, on).filter(
            (F.col("p.component") != F.col("q.component")) & meets & turn & near(F.col("p.n"), F.col("q.n"))
        ).select(F.least("p.set", "q.set").alias("one"), F.greatest("p.set", "q.set").alias("other"))
        pairs = pairs.unionByName(more)
    pairs = cut(pairs.distinct())
    discard(*done)
    if not pairs.isEmpty():
        links = cut(links.unionByName(verified(pairs)).distinct())
        found = components(links, "one", "other")

    nodes = (
        described.join(found.select(F.col("node").alias("set"), F.col("component").alias("_found")), "set", "left")
        .withColumn("_group", F.when(F.col("n") > 0, F.coalesce("_found", "set")))
    )
    smallest = nodes.filter(F.col("_group").isNotNull()).groupBy("_group").agg(F.min("doc_id").alias("_least"), F.count("*").alias("_many"))
    return nodes.join(smallest.filter(F.col("_many") > 1), "_group", "left"), links


def keep_one(
    docs: DataFrame, length: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest doc_id.

    Where a doc_id repeats, each text is judged by its own set: one goes when its component
    has a smaller doc_id, the others under that id stay. Rows without doc_id stay. Other
    columns come back as they were.
    """
    found, _ = _nodes(docs, length, percent, id_col, text_col)
    lost = found.filter(F.col("doc_id") != F.col("_least")).select(F.col("doc_id").alias("_lost"), F.col("digest").alias("_of")).distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    doc_id, _, digest = _columns(id_col, text_col)
    rows = docs.select(row, doc_id.alias("_id"), digest.alias("_digest"))
    on = (F.col("_id") == F.col("_lost")) & (F.col("_digest") == F.col("_of"))
    return rows.join(lost, on, "left_anti").select("_row.*")
