"""Spelling variants: words one edit apart, found by composing acceptors with an edit transducer."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.storage import cut, mapped

# Words of one group, which one step holds at once. Larger groups are split, see _groups().
GROUP_WORDS = 32768

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The characters of a word.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"


def word_counts(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    change: Callable[[Column, Column], Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Words of whole texts and how often they occur: (word, n).

    A word is a maximal run of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z lower-cased. It
    has ``least_length`` code points and ``least_count`` occurrences at least. ``change``
    makes another word of an id and a word before counting; it must not make words longer.
    Null texts have no words. Counts combine within tasks before the shuffle, so a word that
    is a third of all words sends one row a task.
    """
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    runs = docs.select(F.col(id_col).alias("id"), F.explode(found).alias("run"))
    folded = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(
        F.translate("run", UPPER, UPPER.lower())
    )
    runs = runs.select("id", folded.alias("run"))
    word = F.col("run") if change is None else change(F.col("id"), F.col("run"))
    return (
        runs.select(word.alias("word"))
        .filter(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= least_count)
    )


class Acceptor:
    """The minimal acyclic acceptor of sorted, distinct words: equal ends share their states.

    ``arcs[state]`` maps a character to the next state; ``final`` holds accepting states.
    """

    def __init__(self, words: Iterable[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: set[int] = set()
        known: dict[tuple, int] = {}
        path, before = [0], ""
        for word in words:
            same = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                same += 1
            self._settle(path, before, same, known)
            for c in word[same:]:
                self.arcs.append({})
                self.arcs[path[-1]][c] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final.add(path[-1])
            before = word
        self._settle(path, before, 0, known)

    def _settle(self, path: list[int], word: str, keep: int, known: dict[tuple, int]) -> None:
        """Replace the states after ``keep`` characters by equal ones that are known."""
        for depth in range(len(path) - 1, keep, -1):
            state = path.pop()
            shape = (state in self.final, tuple(self.arcs[state].items()))
            self.arcs[path[-1]][word[depth - 1]] = known.setdefault(shape, state)


def both(a: Acceptor, p: int, b: Acceptor, q: int, without: str = "") -> Iterator[str]:
    """What ``a`` accepts from state ``p`` and ``b`` from ``q``, first character not ``without``."""
    stack = [(p, q, 0, "")]
    path: list[str] = []
    while stack:
        p, q, depth, c = stack.pop()
        if depth:
            path[depth - 1 :] = [c]
        if p in a.final and q in b.final:
            yield "".join(path[:depth])
        after = b.arcs[q]
        for c, r in a.arcs[p].items():
            if c in after and (depth or c != without):
                stack.append((r, after[c], depth + 1, c))


def compose(a: Acceptor, b: Acceptor, longer: bool, only_first: bool) -> Iterator[tuple[str, str]]:
    """Pairs of ``a``'s and ``b``'s words through a transducer of one edit.

    Without ``longer`` the edit replaces a character, and both acceptors are the same; each
    pair comes once. With ``longer`` it inserts one into ``a``'s word. The edit is taken where
    the words first differ, so no pair has two ways; with ``only_first``, at the start alone.
    """
    stack = [(0, 0, 0, "")]
    path: list[str] = []
    while stack:
        p, q, depth, c = stack.pop()
        if depth:
            path[depth - 1 :] = [c]
        after = b.arcs[q]
        found = []
        if longer:
            for d, r in after.items():
                found += [("", d, rest) for rest in both(a, p, b, r, d)]
        else:
            arcs = list(after.items())
            for i, (c, r) in enumerate(arcs):
                for d, t in arcs[i + 1 :]:
                    found += [(c, d, rest) for rest in both(a, r, b, t)]
        if found:
            head = "".join(path[:depth])
            for c, d, rest in found:
                yield head + c + rest, head + d + rest
        if not only_first:
            for c, r in a.arcs[p].items():
                if c in after:
                    stack.append((r, after[c], depth + 1, c))


def _near(side: int, length: int, first: bool, prefix: str, words: dict[str, int]) -> dict:
    """For each word of a group: how many near words it has there, and the best of them."""
    at = len(prefix)
    ends = sorted(w[at:] for w in words if len(w) == length)
    more = sorted(w[at:] for w in words if len(w) == length + 1)
    short = Acceptor(ends)
    pairs = list(compose(short, short, False, first))
    if ends and more:
        pairs += compose(short, Acceptor(more), True, first)
    out: dict[str, list] = {}
    half = length // 2
    for x, y in pairs:
        x, y = prefix + x, prefix + y
        n, m = words[x], words[y]
        if side:
            x, y = x[::-1], y[::-1]
            if x[:half] == y[:half]:  # found from the front already
                continue
        for word, k, other in ((x, m, y), (y, n, x)):
            mine = out.get(word)
            if mine is None:
                out[word] = [1, k, other]
            else:
                mine[0] += 1
                if k > mine[1] or k == mine[1] and other < mine[2]:
                    mine[1:] = k, other
    return out


NEAR = "word string, n_near bigint, form_n bigint, form string"
_NEAR = pa.schema(
    [("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())]
)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups come one after the other; only one is held."""
    key, prefix, words = None, "", {}

    def ended():
        if len(words) > 1:
            found = _near(*key[:3], prefix, words)
            for at in range(0, len(found), 4096):
                part = list(found.items())[at : at + 4096]
                columns = [[w for w, _ in part], *([v[i] for _, v in part] for i in range(3))]
                yield pa.record_batch(columns, schema=_NEAR)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("side", "length", "first", "key", "prefix", "s", "n"))
        for *here, start, s, n in zip(*columns):
            if here != key:
                yield from ended()
                key, prefix, words = here, start, {}
            words[s] = n
    yield from ended()


def _groups(words: DataFrame, least_length: int, most: int) -> DataFrame:
    """Rows (side, length, key, prefix, first, s, n) of groups that hold all near pairs.

    Two words one edit apart, the shorter of ``length`` code points, share the first half of
    it or, read backwards (``side`` 1), the last half. Such a half is the initial state of a
    group, which gets words of ``length`` and one more. A group of over ``most`` words is
    split: pairs that first differ right after what all its words share get groups of their
    own, of words that are equal without that one character (``first``; as many words as the
    alphabet at most); all others share one character more, and make groups by that. This is
    repeated until no group is too large.
    """
    size = F.length("word")
    forms = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(side).alias("side"),
                    (size - less).alias("length"),
                    (F.reverse("word") if side else F.col("word")).alias("s"),
                )
                for side in (0, 1)
                for less in (0, 1)
            )
        )
    )
    rows = (
        words.select("n", forms.alias("f"))
        .select("f.side", "f.length", "f.s", "n")
        .filter(F.col("length") >= least_length)
        .withColumn("prefix", F.expr("substring(s, 1, length div 2)"))
        .withColumn("first", F.lit(False))
        .withColumn("key", F.col("prefix"))
    )
    group = ["side", "length", "key"]
    columns = [*group, "prefix", "first", "s", "n"]
    done = []
    while True:
        sizes = rows.groupBy(*group).agg(F.count("*").alias("_size"), F.min("s").alias("_a"), F.max("s").alias("_b"))
        sized = rows.join(sizes.filter("_size > 1"), group)
        done.append(sized.filter(F.col("_size") <= most).select(*columns))
        large = sizes.filter(F.col("_size") > most)
        if large.isEmpty():
            break
        # What the least and the greatest word share at their start, all words share.
        shared = F.expr(
            "aggregate(sequence(1, least(length(_a), length(_b))), 0, "
            "(n, i) -> if(n = i - 1 and substring(_a, i, 1) = substring(_b, i, 1), i, n))"
        )
        large = large.select(*group, F.expr("_a").alias("_a"), shared.alias("_at"))
        hot = cut(rows.join(large, group).withColumn("prefix", F.expr("substring(_a, 1, _at)")))
        without = F.expr("concat(prefix, substring(s, _at + 2))")
        same = hot.filter("length(s) = length").withColumn("key", F.concat(F.lit("="), without))
        whole = hot.filter("length(s) = length").withColumn("key", F.concat(F.lit("+"), F.col("s")))
        more = hot.filter("length(s) > length").withColumn("key", F.concat(F.lit("+"), without))
        crossing = same.unionByName(whole).unionByName(more).withColumn("first", F.lit(True))
        # One key string may come from several prefixes; their lengths tell them apart.
        crossing = crossing.withColumn("key", F.concat_ws("/", F.col("_at").cast("string"), "key"))
        alone = crossing.groupBy(*group).agg(F.count("*").alias("_size")).filter("_size > 1")
        done.append(crossing.join(alone, group, "left_semi").select(*columns))
        rows = (
            hot.filter(F.length("s") > F.col("_at"))
            .withColumn("prefix", F.expr("substring(s, 1, _at + 1)"))
            .withColumn("key", F.col("prefix"))
            .select(*columns)
        )
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def spelling_variants(
    words: DataFrame, least_length: int = 6, times: int = 5, group_words: int = GROUP_WORDS
) -> DataFrame:
    """Spelling forms of words: (word, form, root, n, n_near, form_n), one row a word.

    ``words`` has distinct ``word`` and its count ``n``; shorter words than ``least_length``
    code points, nulls and other columns are left out. Two words are near if one inserted,
    deleted or replaced code point makes one of the other. ``form`` is the near word of
    largest ``n`` (ties: least in code-point order) if its ``n`` is ``times`` the word's at
    least, else null; ``root`` is where following forms ends. ``n_near`` counts near words.

    The vocabulary's acceptor is partitioned by initial states (halves of words); in each
    partition the minimal acceptor is composed with a one-edit transducer and the acceptor
    again. Partitions of more than ``group_words`` words are split until none is left, so no
    step holds more; nothing is left out by that.
    """
    words = cut(words.select("word", "n").filter(F.length("word") >= least_length))
    rows = _groups(words, least_length, group_words)
    group = ["side", "length", "first", "key"]
    dealt = rows.repartition(*group).sortWithinPartitions(*group)
    near = mapped(dealt, _composed, NEAR)
    best = near.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"),
    )
    strong = -F.col("best.less") >= times * F.col("n")
    judged = cut(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(strong, F.col("best.form")).alias("form"),
            F.when(strong, -F.col("best.less")).alias("form_n"),
        )
    )
    # A form's count is a multiple of its word's, so chains are short; each round doubles
    # what a word has followed.
    roots = judged.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = cut(
            roots.join(further, "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")
            )
        )
        if roots.filter("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return judged.join(roots.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
