"""Toxicity by the nearest labelled examples under exact TF-IDF cosine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm import words as w
from tally.llm.storage import cut, mapped

# Labelled examples of each class that the index holds, terms it knows, and neighbours asked.
EXAMPLES = 3000
TERMS = 512
NEIGHBOURS = 15
FOLDS = 5

BLOCK = 64
LEAST_CONTEXTS = 3
LEAST_ODDS = 4.0
PRIOR_VOTES = 0.5


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from: a fixed fifth by doc_id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass
class Index:
    """Postings of examples by term, in blocks of examples, with each block's largest weight."""

    terms: np.ndarray
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    votes: np.ndarray
    first: np.ndarray
    postings: np.ndarray
    weights: np.ndarray
    block_max: np.ndarray
    prior: float
    silent: float

    @property
    def n_blocks(self) -> int:
        return self.block_max.shape[1]

    def nearest(self, terms: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` most similar examples and their cosines; ties go to the smaller number.

        A block's bound is what the query's terms could add up to in it. Blocks are read in
        the order of their bounds, until no bound is over the k-th best cosine.
        """
        bounds = q @ self.block_max[terms]
        order = np.argsort(-bounds, kind="stable")
        best, near = np.zeros(0), np.zeros(0, np.int64)
        step, i = 4, 0
        while i < len(order):
            some = order[i : i + step]
            if bounds[some[0]] <= 0 or (len(best) >= k and bounds[some[0]] < best[k - 1]):
                break
            base = some * len(self.terms)
            scores = np.zeros((len(some), BLOCK))
            for term, weight in zip(terms.tolist(), q.tolist()):
                for row, at in enumerate((base + term).tolist()):
                    low, high = self.first[at], self.first[at + 1]
                    if low < high:
                        scores[row, self.postings[low:high] % BLOCK] += weight * self.weights[low:high]
            number = (some[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            best, near = np.append(best, scores.ravel()), np.append(near, number)
            top = np.lexsort((near, -best))[:k]
            best, near = best[top], near[top]
            i += step
        return near[best > 0], best[best > 0]

    def score(self, terms: np.ndarray, q: np.ndarray, k: int) -> tuple[float, np.ndarray]:
        """Share of toxic votes, by closeness, and the examples that voted."""
        if not len(terms):
            return self.silent, np.zeros(0, np.int64)
        near, cosines = self.nearest(terms, q, k)
        votes = cosines * self.votes[near]
        toxic = (votes * self.toxic[near]).sum() + PRIOR_VOTES * self.prior
        return float(toxic / (votes.sum() + PRIOR_VOTES)), near


def vectors(run: w.Words, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the known terms of a run of texts."""
    hashes = run.hashes(fold=True)
    if not len(terms) or not len(hashes):
        none = np.zeros(0, np.int64)
        return none, none, none
    slot = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    known = np.flatnonzero(terms[slot] == hashes)
    code, count = np.unique(run.text_of()[known] * len(terms) + slot[known], return_counts=True)
    return code // len(terms), code % len(terms), count


def unit(text: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = (1 + np.log(np.maximum(count, 1))) * idf[term]
    norm = np.sqrt(np.bincount(text, weight**2)) if len(text) else np.ones(1)
    return weight / norm[text]


def examples(labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` training ids of each class, first in hash order: (_id, toxic)."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("_id")
    )
    known = known.groupBy("_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("_id"), F.col("_id")]
    some = [known.filter(F.col("toxic") == c).orderBy(*order).limit(most) for c in (0, 1)]
    return cut(some[0].unionByName(some[1]))


def build_index(
    docs: DataFrame,
    labels: DataFrame,
    most: int = EXAMPLES,
    n_terms: int = TERMS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Index:
    """Choose terms and examples, and count the terms over all documents.

    The index holds up to ``most`` examples a class. Its terms are the ``n_terms`` that are
    most telling of toxic texts; all other words are left out of the vectors and their
    norms. What counts is after how many different words a term
    stands, not how often: copies of one text repeat its contexts and add nothing. Document
    frequencies for the weights are of all of ``docs``.
    """
    chosen = examples(labels, most)
    text = F.col(text_col).cast("string").alias("_text")
    source = docs.select(F.col(id_col).alias("_id"), text)
    sample = source.join(F.broadcast(chosen), "_id").select(F.col("_id").cast("long"), "toxic", "_text")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False)
            for i, _, run in w.each_run(batch.column(1), w.NOT_ALPHANUMERIC):
                term = run.hashes(fold=True)
                before = np.zeros_like(term)
                before[1:] = term[:-1]
                yield pa.record_batch(
                    [pa.array(toxic[i + run.text_of()], pa.int32()), pa.array(term.view(np.int64)), pa.array(before.view(np.int64))],
                    ["toxic", "term", "before"],
                )

    seen = mapped(sample.select("toxic", "_text"), contexts, "toxic int, term bigint, before bigint").distinct()
    per_term = seen.groupBy("term").agg(
        F.sum(F.col("toxic").cast("long")).alias("t"), F.count("*").alias("n")
    )
    totals = per_term.agg(F.sum("t"), F.sum(F.col("n") - F.col("t"))).first()
    all_toxic, all_clean = (max(int(x or 0), 1) for x in totals)
    toxic_rate = (F.col("t") + 0.5) / all_toxic
    clean_rate = (F.col("n") - F.col("t") + 0.5) / all_clean
    odds = F.log2(toxic_rate / clean_rate)
    telling = (
        per_term.filter(F.greatest("t", F.col("n") - F.col("t")) >= LEAST_CONTEXTS)
        .select("term", (odds * F.col("t")).alias("gain"), odds.alias("odds"))
        .filter(F.col("odds") >= np.log2(LEAST_ODDS))
        .orderBy(F.desc("gain"), "term")
        .limit(n_terms)
    )
    terms = np.sort(np.array([r[0] for r in telling.collect()], np.int64).view(np.uint64))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, rows = np.zeros(len(terms), np.int64), 0
            for _, _, run in w.each_run(batch.column(0), w.NOT_ALPHANUMERIC):
                total += np.bincount(vectors(run, terms)[1], minlength=len(terms))
                rows += len(run.first) - 1
            yield pa.record_batch(
                [pa.array(np.arange(-1, len(terms)), pa.int32()), pa.array(np.append(rows, total))], ["term", "n"]
            )

    counted = mapped(docs.select(text), frequencies, "term int, n bigint").groupBy("term").agg(F.sum("n")).collect()
    frequency = dict((r[0], r[1]) for r in counted)
    n_docs = frequency.get(-1, 0)
    idf = np.array([np.log((n_docs + 1) / (frequency.get(i, 0) + 1)) + 1 for i in range(len(terms))])

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, run in w.each_run(batch.column(2), w.NOT_ALPHANUMERIC):
                text_of, term, count = vectors(run, terms)
                cuts = np.searchsorted(text_of, np.arange(j - i + 1))
                rows = [term[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:])]
                sizes = [count[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:])]
                yield pa.record_batch(
                    [pa.array(ids[i:j], pa.int64()), pa.array(toxic[i:j], pa.int32()), pa.array(rows, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32()))],
                    ["doc_id", "toxic", "terms", "counts"],
                )

    found = mapped(sample, postings, "doc_id bigint, toxic int, terms array<int>, counts array<int>")
    held = found.groupBy("doc_id", "toxic", "terms", "counts").agg(F.count("*").alias("rows")).orderBy("doc_id", "terms")
    # All classes' rates in the labels, by which the votes of the bounded examples count.
    rates = labels.filter(~held_out() & F.col("toxic").isin(0, 1)).groupBy("toxic").count().collect()
    rates = {int(r[0]): r[1] for r in rates}
    return assemble(terms, idf, held.limit(4 * most).collect(), rates)


def assemble(terms: np.ndarray, idf: np.ndarray, rows: list, rates: dict[int, int]) -> Index:
    toxic_all = np.array([r["toxic"] for r in rows], np.int64)
    share = [rates.get(c, 0) / max((toxic_all == c).sum(), 1) for c in (0, 1)]
    vote_of = np.array(share)[toxic_all] if len(rows) else np.zeros(0)
    total = rates.get(0, 0) + rates.get(1, 0)
    prior = rates.get(1, 0) / total if total else 0.5
    mute = np.array([not r["terms"] for r in rows], bool)
    weight = vote_of[mute]
    silent = ((weight * toxic_all[mute]).sum() + PRIOR_VOTES * prior) / (weight.sum() + PRIOR_VOTES)
    some = [r for r in rows if r["terms"]]
    # Examples of one class and with like terms lie in one block, which keeps bounds tight.
    some.sort(key=lambda r: (r["toxic"], list(r["terms"]), r["doc_id"]))
    n_blocks = -(-len(some) // BLOCK)
    text = np.repeat(np.arange(len(some)), [len(r["terms"]) for r in some])
    term = np.array([t for r in some for t in r["terms"]], np.int64)
    count = np.array([c for r in some for c in r["counts"]], np.int64)
    weights = unit(text, term, count, idf) if len(some) else np.zeros(0)
    key = text // BLOCK * max(len(terms), 1) + term
    order = np.argsort(key, kind="stable")
    first = np.searchsorted(key[order], np.arange(n_blocks * max(len(terms), 1) + 1))
    block_max = np.zeros((len(terms), n_blocks))
    np.maximum.at(block_max, (term, text // BLOCK), weights)
    return Index(
        terms=terms,
        idf=idf,
        ids=np.array([r["doc_id"] for r in some], np.int64),
        toxic=np.array([r["toxic"] for r in some], np.int64),
        votes=np.array([share[r["toxic"]] for r in some]),
        first=first,
        postings=text[order],
        weights=weights[order],
        block_max=block_max,
        prior=prior,
        silent=float(silent),
    )


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame | None = None,
    index: Index | None = None,
    neighbours: int = NEIGHBOURS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Toxicity of each document: doc_id, held_out, score, predicted, evidence (example ids).

    The nearest examples vote with their cosine, each class with the weight of all its
    labelled rows, and half a vote goes to the share of toxic labels. A text without known
    terms scores as such examples do. Give ``labels`` (doc_id, toxic) to build the index
    here, or an ``index``; labels of held-out rows are not used, nor are labels other than
    0 and 1. Of labels that repeat a doc_id, toxic wins.

    One row per input row. Null text counts as empty; a row of null doc_id is scored and not
    held out. Without labels all scores are 0.5. Other columns are not read.
    """
    model = index or build_index(docs, labels, id_col=id_col, text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, evidence = [], []
            for i, j, words in w.each_run(batch.column(2), w.NOT_ALPHANUMERIC):
                text_of, term, count = vectors(words, model.terms)
                weight = unit(text_of, term, count, model.idf) if len(text_of) else np.zeros(0)
                cuts = np.searchsorted(text_of, np.arange(j - i + 1)).tolist()
                for a, b in zip(cuts, cuts[1:]):
                    score, near = model.score(term[a:b], weight[a:b], neighbours)
                    scores.append(score)
                    evidence.append(model.ids[near])
            score = np.array(scores, float)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(evidence, pa.list_(pa.int64()))],
                ["doc_id", "held_out", "score", "predicted", "evidence"],
            )

    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("_text")
    )
    return mapped(source, run, "doc_id bigint, held_out boolean, score double, predicted int, evidence array<bigint>")
