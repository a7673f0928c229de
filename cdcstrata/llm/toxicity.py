"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words in lower case and, for words of over five letters, their first five. The vector space holds every term
of a bounded sample of labelled rows (``PER_LABEL`` of either label, of at most ``MOST_CHARS`` characters, near copies
left out); a term that no example has can match none. Document frequencies are counted over all documents. The examples
are indexed: a matrix for the terms that many of them hold, and postings by term for the others. Short lists of postings
are added as they are, as a bound would cost no less; long ones lie in blocks of 64 examples, each with its greatest
weight. Queries go 64 at a time. The bounds of all blocks are one product of matrices; a query opens its likeliest blocks
first and then those alone whose bound reaches its k-th best cosine, so the neighbours are exact; what comes into
question is summed anew in double precision.

A neighbour's vote grows with its cosine, and with the part of it that lies in terms that go with a label, by the
likelihood ratio; either label is weighted to its share among all labelled rows. Votes are calibrated by a logistic fit
to the examples' own votes, each without itself and its copies. A text without any term, null and empty ones among them,
gets the share of label 1 among examples like it. Evidence is the nearest examples with their cosines.

Without a labelled row the score is the smoothed share, a half, for every row; likewise with one label only, their share.
Repeated rows are scored alike.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcstrata.llm.batches import bound_batches, give_back
from cdcstrata.llm.labelled import Sample, held_out, labelled_sample
from cdcstrata.sources.scratch import materialise

PER_LABEL, MOST_CHARS = 2000, 20_000
LEAST_RATIO = 10.0  # from which a term says something of a label: by chance, one in some 600
BLOCK = 64
QUERIES, TOGETHER, FIRST_BLOCKS = 64, 16, 12  # queries that share a pass over the matrix, and over the postings
SLACK = 2e-4  # single precision over at most MOST_COMMON products of weights whose squares sum to one
COMMON, MOST_COMMON = 16, 2048  # a term that one example in so many holds is common; at most so many terms are
LONG, MOST_LONG = 2 * BLOCK, 16_384  # postings from which a list has bounds; at most so many lists have
NEIGHBOURS, EVIDENCE = 30, 3
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_BETWEEN = r"[^\p{L}\p{Nl}\p{No}]+"  # what lies between such words, as Arrow's expressions put it
STEM = 5


def terms(text: str | None) -> Counter[str]:
    """How often each word and each stem of a text occurs."""
    words = Counter(_WORD.findall((text or "").lower()))
    stems: Counter[str] = Counter()
    for word, n in words.items():
        if len(word) > STEM:
            stems[word[:STEM] + "*"] += n
    return words + stems


def independent(sample: Sample) -> Sample:
    """The sample without texts half of whose long words stand in one earlier text: copies are not more evidence."""
    holders: dict[str, list[int]] = {}
    kept: tuple[list[int], list[int]] = ([], [])
    for label, k in sorted(((v, k) for v in (0, 1) for k in range(len(sample.texts[v]))), key=lambda x: (x[1], x[0])):
        words = {w for w in _WORD.findall(sample.texts[label][k].lower()) if len(w) > STEM}
        shared = Counter(h for w in words for h in holders.get(w, ()))
        if shared and max(shared.values()) * 2 >= len(words):
            continue
        kept[label].append(k)
        for w in words:
            # A word of many texts tells nothing about copies.
            if len(known := holders.setdefault(w, [])) < 20:
                known.append(2 * k + label)
    texts, ids = (tuple([some[v][k] for k in kept[v]] for v in (0, 1)) for some in (sample.texts, sample.ids))
    return Sample(texts, ids, sample.rows)


def sample_terms(sample: Sample) -> tuple[list[str], np.ndarray]:
    """All terms of the sample, in order, and the likelihood ratio of each term's presence and the label."""
    clean, toxic = (Counter(t for x in some for t in terms(x)) for some in sample.texts)
    n0, n1 = map(len, sample.texts)

    def part(a: float, of: float) -> float:
        return a * math.log(a / of) if a else 0.0

    def ratio(term: str) -> float:
        a, b = toxic[term], clean[term]
        have, n = a + b, n0 + n1
        cells = ((a, have, n1), (b, have, n0), (n1 - a, n - have, n1), (n0 - b, n - have, n0))
        return 2 * sum(part(x, row * column / n) for x, row, column in cells)

    known = sorted(clean.keys() | toxic.keys())
    return known, np.array([ratio(t) for t in known])


Vector = Sequence[tuple[int, float]] | np.ndarray  # terms, in order, with their weights


def _split(vector: Vector) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.asarray(vector, np.float64).reshape(-1, 2)
    return pairs[:, 0].astype(np.int64), pairs[:, 1]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class Space:
    """How rare each term is among all documents, and how much it tells of a label."""

    idf: np.ndarray
    telling: np.ndarray

    def vector(self, found: Sequence[int], counts: Sequence[int]) -> np.ndarray:
        """Weights by term, of length one; empty without a term."""
        found, counts = np.asarray(found, np.int64), np.asarray(counts, np.float64)
        order = np.argsort(found)
        weights = ((1 + np.log(counts)) * self.idf[found])[order]
        return np.stack([found[order], weights / math.sqrt(weights @ weights) if len(found) else weights], axis=1)

    def telling_part(self, vector: np.ndarray) -> np.ndarray:
        """Of a vector, the terms that go with a label: their numbers and weights."""
        return vector[self.telling[vector[:, 0].astype(np.int64)] > 0]


def hits(number: dict[str, int], text: str | None) -> dict[int, int]:
    """Counts of the known terms in a text."""
    found: dict[int, int] = {}
    for word, n in Counter(_WORD.findall((text or "").lower())).items():
        for term in (word, word[:STEM] + "*") if len(word) > STEM else (word,):
            if (t := number.get(term)) is not None:
                found[t] = found.get(t, 0) + n
    return found


class Known:
    """The terms that have a number, as the tasks get them: words and stems, each with their numbers, in Arrow's form."""

    def __init__(self, number: dict[str, int]):
        self.size = max(1, len(number))
        self.sets = []
        for ending in ("", "*"):
            some = {t.removesuffix("*"): k for t, k in number.items() if t.endswith("*") == bool(ending)}
            self.sets.append((pa.array(some, pa.large_string()), np.array([*some.values()], np.int64)))


class Finder:
    """The known terms of many texts at once: words are told apart by Arrow, and the known ones looked up among them.

    The other way round, Arrow would put all known terms in a table anew for every portion of text.
    """

    CHARS = 1_000_000  # so much text at a time, or one text, which bounds the memory

    def __init__(self, known: Known):
        self.size, self.sets = known.size, known.sets

    def columns(self, texts: Sequence[str | None]) -> tuple[pa.Array, pa.Array]:
        """Terms and counts of each text as two columns of lists."""
        parts, few, chars = [], [], 0
        for k, x in enumerate(texts):
            few.append(x)
            chars += len(x or "")
            if chars > self.CHARS or k == len(texts) - 1:
                parts.append(self._hits(few))
                few, chars = [], 0
        sizes, terms, counts = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 3
        ends = pa.array(np.cumsum([0, *sizes.tolist()]), pa.int32())
        return tuple(pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (terms, counts))

    def _hits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many terms each text has, all terms, their counts."""
        split = pc.split_pattern_regex(pa.array([(x or "").lower() for x in texts], pa.large_string()), pattern=_BETWEEN)
        words = split.flatten().dictionary_encode()
        code, text = words.indices.to_numpy(), np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy())
        asked = words.dictionary
        stems = pc.if_else(pc.greater(pc.utf8_length(asked), STEM), pc.utf8_slice_codeunits(asked, 0, STEM), None)
        stems = stems.dictionary_encode()
        stem = pc.fill_null(stems.indices, -1).to_numpy()[code]
        keys = []
        for some, at, known in zip((asked, stems.dictionary), (code, stem), self.sets, strict=True):
            found = self._numbers(some, *known)[at]
            keys.append(text[found >= 0] * self.size + found[found >= 0])
        key, counts = np.unique(np.concatenate(keys), return_counts=True)
        return np.bincount(key // self.size, minlength=len(texts)), key % self.size, counts

    @staticmethod
    def _numbers(asked: pa.Array, known: pa.Array, numbers: np.ndarray) -> np.ndarray:
        """The number of each string asked for, -1 without one; and -1 at the end, for no string."""
        places = pc.index_in(known, value_set=asked)
        found = np.full(len(asked) + 1, -1)
        found[places.drop_null().to_numpy()] = numbers[places.is_valid().to_numpy(zero_copy_only=False)]
        return found


def _rows(terms: pa.ListArray, counts: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The two columns as an array of terms and one of counts for each row."""
    ends = np.cumsum([0, *(n or 0 for n in terms.value_lengths().to_pylist())])
    t, c = terms.flatten().to_numpy(), counts.flatten().to_numpy()
    return [(t[a:b], c[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


class BlockMaxIndex:
    """Exact nearest neighbours by cosine among vectors of length one.

    Vectors are sorted, so that a block holds similar ones and its greatest weights are tight.
    """

    def __init__(self, vectors: list[Vector]):
        split = [_split(v) for v in vectors]
        heaviest = [tuple(t[np.argsort(-w, kind="stable")[:8]].tolist()) for t, w in split]
        self.order = np.array(sorted((k for k, (t, _) in enumerate(split) if len(t)), key=lambda k: (heaviest[k], k)), np.int64)
        held = [split[k] for k in self.order]
        terms = np.concatenate([t for t, _ in held]) if held else np.zeros(0, np.int64)
        places = np.repeat(np.arange(len(held), dtype=np.int32), [len(t) for t, _ in held])
        weights = np.concatenate([w for _, w in held]) if held else np.zeros(0)
        by_term = np.lexsort((places, terms))
        terms, places, weights = terms[by_term], places[by_term], weights[by_term]
        self.terms = int(terms[-1]) + 1 if len(terms) else 0
        held_by = np.bincount(terms, minlength=self.terms)
        common = np.argsort(-held_by, kind="stable")[:MOST_COMMON]
        common = common[held_by[common] * COMMON >= len(held)]
        self.column = np.full(self.terms, -1)
        self.column[common] = np.arange(len(common))
        dense = self.column[terms] >= 0
        # The weights of common terms in double precision, example by example; ``row`` tells where each begins.
        by_row = np.nonzero(dense)[0][np.argsort(places[dense], kind="stable")]
        self.rows = self.column[terms[by_row]].astype(np.int32), weights[by_row]
        self.row = np.searchsorted(places[by_row], np.arange(len(held) + 1))
        self.columns = len(common)
        terms, self.places, self.weights = terms[~dense], places[~dense].astype(np.int64), weights[~dense]
        self.blocks = -(-len(held) // BLOCK)
        self.first = np.searchsorted(terms, np.arange(self.terms + 1))  # posting of each term
        sizes = np.diff(self.first)
        long = np.argsort(-sizes, kind="stable")[:MOST_LONG]
        long = np.sort(long[sizes[long] >= LONG])
        self.line = np.full(self.terms, -1)
        self.line[long] = np.arange(len(long))
        # Of every long list, the greatest weight in each block, and where the block's postings begin.
        line = self.line[terms]
        at = line[line >= 0] * self.blocks + self.places[line >= 0] // BLOCK
        self.most = np.zeros((len(long), self.blocks))
        np.maximum.at(self.most.ravel(), at, self.weights[line >= 0])
        counts = np.bincount(at, minlength=self.most.size).reshape(self.most.shape)
        self.begins = np.zeros((len(long), self.blocks + 1), np.int32)
        np.cumsum(counts, axis=1, out=self.begins[:, 1:])
        self.begins += self.first[long, None].astype(np.int32)

    @cached_property
    def matrix(self) -> np.ndarray:
        """The common terms' weights as a matrix in single precision."""
        found = np.zeros((len(self.order), self.columns), np.float32)
        found[np.repeat(np.arange(len(self.order)), np.diff(self.row)), self.rows[0]] = self.rows[1]
        return found

    def lean(self) -> None:
        """Let the matrix go, the larger part of the index: the driver needs it no more, and tasks make it anew."""
        self.__dict__.pop("matrix", None)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "matrix"}

    def nearest(self, query: Vector, k: int) -> list[tuple[float, int]]:
        """The k greatest cosines with their vectors' numbers; vectors without a common term are not listed."""
        return self.nearest_all([query], k)[0]

    def nearest_all(self, queries: Sequence[Vector], k: int) -> list[list[tuple[float, int]]]:
        """The nearest ones of each query; so many queries at once share each pass over matrix and postings."""
        result = []
        for at in range(0, len(queries), QUERIES):
            split = [_split(q) for q in queries[at : at + QUERIES]]
            split = [(t[t < self.terms], w[t < self.terms]) for t, w in split]
            dense = np.zeros((len(split), self.columns))
            for row, (t, w) in zip(dense, split, strict=True):
                column = self.column[t]
                row[column[column >= 0]] = w[column >= 0]
            # The matrix' part of each cosine in single precision: SLACK is more than that can be off.
            parts = dense.astype(np.float32) @ self.matrix.T
            for few in range(0, len(split), TOGETHER):
                some = slice(few, few + TOGETHER)
                result += self._nearest(split[some], dense[some], parts[some], k)
        return result

    def _nearest(
        self, split: list[tuple[np.ndarray, np.ndarray]], dense: np.ndarray, cosine: np.ndarray, k: int
    ) -> list[list[tuple[float, int]]]:
        count, n = len(split), len(self.order)
        if not n:
            return [[] for _ in split]
        q = np.repeat(np.arange(count), [len(t) for t, _ in split])
        t, w = (np.concatenate(x) for x in zip(*split, strict=True))
        line = self.line[t]
        rest = np.zeros(count * n)
        some = line < 0
        self._add(rest, self.first[t[some]], self.first[t[some] + 1], q[some], w[some])
        if not some.all():
            line, q, w = line[~some], q[~some], w[~some]
            asked = np.zeros((count, len(self.most)))
            asked[q, line] = w
            known = cosine + rest.reshape(count, n)
            bound = asked @ self.most + np.maximum.reduceat(known, np.arange(0, n, BLOCK), axis=1)
            first = np.zeros(bound.shape, bool)
            best = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST_BLOCKS]
            np.put_along_axis(first, best, True, axis=1)
            self._open(rest, first, q, line, w)
            # With the likeliest blocks known, no other is opened than those that may hold one of the k best.
            least = self._least(cosine + rest.reshape(count, n), k)
            self._open(rest, ~first & (bound >= least[:, None]), q, line, w)
        rest = rest.reshape(count, n)
        cosine = cosine + rest
        least = np.maximum(self._least(cosine, k), 0)
        who, found = np.nonzero((cosine > 0) & (cosine >= least[:, None]))
        # Summed anew in double precision, example by example, so that no query depends on those beside it.
        sizes = self.row[found + 1] - self.row[found]
        at = _ranges(self.row[found], sizes)
        products = dense[np.repeat(who, sizes), self.rows[0][at]] * self.rows[1][at]
        exact = np.bincount(np.repeat(np.arange(len(found)), sizes), products, len(found)) + rest[who, found]
        numbers = self.order[found]
        order = np.lexsort((numbers, -exact, who))
        ends = np.searchsorted(who, np.arange(count + 1))
        listed = list(zip(exact[order].tolist(), numbers[order].tolist(), strict=True))
        return [listed[a : min(a + k, b)] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _open(self, rest: np.ndarray, blocks: np.ndarray, q: np.ndarray, line: np.ndarray, w: np.ndarray) -> None:
        """Add the postings that long lists have in some blocks, chosen by query."""
        begins = self.begins[line]
        which, block = np.nonzero(blocks[q] & (begins[:, 1:] > begins[:, :-1]))
        self._add(rest, begins[which, block], begins[which, block + 1], q[which], w[which])

    def _add(self, rest: np.ndarray, begins: np.ndarray, ends: np.ndarray, q: np.ndarray, w: np.ndarray) -> None:
        """Add ranges of postings to the cosines of the queries that ask for them, with their weights there."""
        sizes = ends - begins
        at = _ranges(begins, sizes)
        to = np.repeat(q * len(self.order), sizes) + self.places[at]
        rest += np.bincount(to, self.weights[at] * np.repeat(w, sizes), len(rest))

    @staticmethod
    def _least(cosine: np.ndarray, k: int) -> np.ndarray:
        """The k-th best of each query, less what rounding may take from it."""
        n = cosine.shape[1]
        return np.partition(cosine, n - k, axis=1)[:, n - k] - SLACK if n > k else np.full(len(cosine), -1.0)


@dataclass
class Model:
    space: Space
    index: BlockMaxIndex
    told: np.ndarray  # of each example, its weight of every telling term times how telling that is
    column: np.ndarray  # of each term, where ``told`` has it, if it does
    ids: list[int]
    toxic: np.ndarray
    weight: np.ndarray  # of an example: rows of its label that it stands for
    share: float  # of label 1 among all
    bare: float  # of label 1 among texts without a term
    slope: float = 1.0
    shift: float = 0.0

    def vote(self, own: np.ndarray, found: list[tuple[float, int]]) -> float:
        """The log-odds of label 1 among neighbours; the whole sample's share counts as a far one.

        ``own`` is the telling part of the text.
        """
        cosine, at = np.array([c for c, _ in found]), np.array([i for _, i in found])
        told = self.told[np.ix_(at, self.column[own[:, 0].astype(np.int64)])] @ own[:, 1]
        w = self.weight[at] * (cosine**2 * _near(cosine) + _near(told))
        yes, no = float(w[self.toxic[at] == 1].sum()), float(w[self.toxic[at] == 0].sum())
        far = 0.1 * self.mean
        return math.log((yes + far * self.share) / (no + far * (1 - self.share)))

    @cached_property
    def mean(self) -> float:
        return float(self.weight.mean())

    def scores(self, rows: Sequence[tuple[Sequence[int], Sequence[int]]]) -> list[tuple[float, list[tuple[float, int]]]]:
        """Score and evidence of texts, given as their terms and counts."""
        vectors = [self.space.vector(*row) for row in rows]
        return [
            self._score(v, found) if len(v) else (self.bare, [])
            for v, found in zip(vectors, self.index.nearest_all(vectors, NEIGHBOURS), strict=True)
        ]

    def _score(self, vector: np.ndarray, found: list[tuple[float, int]]) -> tuple[float, list[tuple[float, int]]]:
        if not found:
            return self.share, []
        x = self.slope * self.vote(self.space.telling_part(vector), found) + self.shift
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x)))), found[:EVIDENCE]


def _near(likeness: np.ndarray) -> np.ndarray:
    likeness = np.minimum(likeness, 1.0)
    return likeness / (1.05 - likeness)


def _calibrated(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic fit, by Newton steps with a weak pull to slope 1."""
    x = np.stack([votes, np.ones_like(votes)], axis=1)
    beta = np.array([1.0, 0.0])
    weight = weight / weight.mean()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        pull = np.array([1.0, 1.0])
        gradient = x.T @ (weight * (p - toxic)) + pull * (beta - [1.0, 0.0])
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        beta = beta - np.linalg.solve(hessian, gradient)
    return (float(beta[0]), float(beta[1])) if np.isfinite(beta).all() and beta[0] > 0 else (1.0, 0.0)


def build(sample: Sample, space: Space, number: dict[str, int]) -> Model:
    texts, ids = [x for some in sample.texts for x in some], [i for some in sample.ids for i in some]
    toxic = np.repeat([0, 1], [len(some) for some in sample.texts])
    each = [sample.rows[k] / max(1, len(sample.texts[k])) for k in (0, 1)]
    weight = np.repeat(each, [len(some) for some in sample.texts])
    vectors = [space.vector(list(c), list(c.values())) for c in (hits(number, x) for x in texts)]
    telling = np.nonzero(space.telling > 0)[0]
    column = np.full(len(space.telling), -1)
    column[telling] = np.arange(len(telling))
    told = np.zeros((len(vectors), len(telling)))
    for row, part in zip(told, map(space.telling_part, vectors), strict=True):
        row[column[part[:, 0].astype(np.int64)]] = part[:, 1] * space.telling[part[:, 0].astype(np.int64)]
    bare = np.array([not len(v) for v in vectors])
    yes, no = (float(weight[bare & (toxic == k)].sum()) for k in (1, 0))
    model = Model(
        space, BlockMaxIndex(vectors), told, column, ids, toxic, weight, sample.share, (yes + sample.share) / (yes + no + 1)
    )
    votes, truth, weights = [], [], []
    copies = Counter(texts)
    most = NEIGHBOURS + max(copies.values(), default=0)
    listed = (f for at in range(0, len(vectors), QUERIES) for f in model.index.nearest_all(vectors[at : at + QUERIES], most))
    for k, (v, found) in enumerate(zip(vectors, listed, strict=True)):
        if len(v):
            if others := [(c, i) for c, i in found if texts[i] != texts[k]][:NEIGHBOURS]:
                votes.append(model.vote(space.telling_part(v), others))
                truth.append(toxic[k])
                weights.append(weight[k])
    if len(set(truth)) == 2:
        model.slope, model.shift = _calibrated(np.array(votes), np.array(truth), np.array(weights))
    model.index.lean()
    return model


def _known_terms(docs: DataFrame, known: Known, carry: Sequence[Column], text: str) -> DataFrame:
    """The known terms of every document, stored: what both the frequencies and the scores are made from.

    Returns ``terms``, ``counts`` and the carried columns as ``c0``, ``c1`` and so on, whatever they were called.
    """
    rows = docs.select(F.col(text).cast("string").alias("text"), *[c.alias(f"c{k}") for k, c in enumerate(carry)])
    schema = T.StructType(
        [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("terms", "counts")] + list(rows.schema)[1:]
    )

    def run(batches):
        finder = Finder(known)
        for batch in batches:
            found = finder.columns(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*found, *batch.columns[1:]], names=schema.names)

    return materialise(rows.mapInArrow(run, schema), "toxic-terms")


def _frequencies(column: DataFrame, n: int, known: Known | None = None) -> tuple[int, np.ndarray]:
    """How many rows there are and how many hold each of n terms: from lists of terms, or with ``known`` from texts.

    Texts are read and counted by one function, so that a task has one Python worker.
    """

    def run(batches):
        held, rows = np.zeros(n, np.int64), 0
        finder = known and Finder(known)
        for batch in batches:
            lists = finder.columns(batch.column(0).to_pylist())[0] if finder else batch.column(0)
            held += np.bincount(lists.flatten().to_numpy(), minlength=n)[:n]
            rows += len(batch)
        give_back()  # the worker lives on
        some = np.nonzero(held)[0]
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([rows], pa.int64())], names=["term", "held"])
        for at in range(0, len(some), 10_000):
            part = some[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(held[part])], names=["term", "held"])

    counted = column.mapInArrow(run, "term int, held bigint").groupBy("term").agg(F.sum("held").alias("held"))
    found = counted.toArrow()  # a row for each term of the sample at most, and one for the rows
    term, count = found["term"].to_numpy(), found["held"].to_numpy()
    frequency = np.zeros(n)
    frequency[term[term >= 0]] = count[term >= 0]
    return int(count[term < 0].sum()), frequency


@dataclass
class Judge:
    """The fitted model, or the flat score where there is nothing to learn from; the known terms."""

    model: Model | None
    flat: float
    known: Known

    def evidence(self, near: Sequence[tuple[float, int]]) -> list[dict]:
        """Neighbours by the ids of their documents."""
        return [{"doc_id": self.model.ids[i], "cosine": c, "toxic": int(self.model.toxic[i])} for c, i in near]

    def scorer(self):
        """A function from texts, as terms and their counts, to (score, neighbours) of each, which remembers what it has seen."""
        model, flat = self.model, self.flat
        seen: dict[bytes, tuple] = {}

        def of(terms: pa.ListArray, counts: pa.ListArray) -> list[tuple[float, Sequence]]:
            rows = _rows(terms, counts)
            if not model:
                return [(flat, ())] * len(rows)
            if len(seen) > 10_000:
                seen.clear()
            keys = [hashlib.blake2b(t.tobytes() + c.tobytes(), digest_size=16).digest() for t, c in rows]
            new = {key: row for key, row in zip(keys, rows, strict=True) if key not in seen}
            for key, (s, near) in zip(new, model.scores(list(new.values())), strict=True):
                seen[key] = (s, tuple(near))
            return [seen[key] for key in keys]

        return of


def fit(
    docs: DataFrame,
    labels: DataFrame,
    modulus: int = 4,
    remainder: int = 2,
    text: str = "text",
    carry: Sequence[Column] | None = None,
) -> tuple[Judge, DataFrame | None]:
    """The fitted model; with columns to ``carry``, also the stored terms of all documents beside them."""
    bound_batches(docs.sparkSession, "4m")  # a task holds the model beside its batches
    sample = independent(
        labelled_sample(docs, labels, "toxic", modulus, remainder, PER_LABEL, MOST_CHARS, text)
    )
    terms_, ratio = sample_terms(sample) if all(sample.texts) else ([], np.zeros(0))
    number = {t: k for k, t in enumerate(terms_)}
    known, rows = Known(number), None
    if carry is None:
        total, held = _frequencies(docs.select(F.col(text).cast("string")), len(number), known)
    else:
        rows = _known_terms(docs, known, carry, text)
        total, held = _frequencies(rows.select("terms"), len(number))
    idf = np.log((total + 1) / (held + 1)) + 1
    space = Space(idf, np.where(ratio >= LEAST_RATIO, ratio / LEAST_RATIO, 0.0))
    judge = Judge(build(sample, space, number) if number else None, sample.share, known)
    del sample, terms_, number, held
    give_back()  # the driver goes on with the next stage, and is smaller than what the sample took
    return judge, rows


def _sent(docs: DataFrame, judge: Judge) -> Broadcast[Judge]:
    """The model for the tasks: each worker reads it once. Within a task's function it would be read for each task, and
    be held a second time as bytes."""
    return docs.sparkSession.sparkContext.broadcast(judge)


def _received(sent: Broadcast[Judge]) -> Judge:
    give_back()  # what the worker did before may be of another stage
    return sent.value


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))


def score(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``evidence`` of every row."""
    carry = [F.col("doc_id").cast("bigint"), held_out(modulus, remainder)]
    judge, rows = fit(docs, labels, modulus, remainder, text, carry)
    sent = _sent(docs, judge)

    def run(batches):
        judge = _received(sent)
        of = judge.scorer()
        for batch in batches:
            found = of(batch.column(0), batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2),
                    batch.column(3),
                    pa.array([s for s, _ in found], pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s, _ in found], pa.int32()),
                    pa.array([judge.evidence(near) for _, near in found], _EVIDENCE),
                ],
                names=["doc_id", "held_out", "score", "predicted", "evidence"],
            )
        give_back()  # the worker lives on

    return rows.mapInArrow(
        run,
        "doc_id bigint, held_out boolean, score double, predicted int, "
        "evidence array<struct<doc_id:bigint,cosine:double,toxic:int>>",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, that are not predicted toxic; nothing of them is stored.

    Their terms are taken twice, for the frequencies and for the scores, which costs less than a copy of the corpus.
    """
    judge, _ = fit(docs, labels, text=text)
    sent, at = _sent(docs, judge), docs.columns.index(text)

    def run(batches):
        judge = _received(sent)
        of, finder = judge.scorer(), Finder(judge.known)
        for batch in batches:
            clean = [s < THRESHOLD for s, _ in of(*finder.columns(batch.column(at).to_pylist()))]
            yield batch.filter(pa.array(clean, pa.bool_()))
        give_back()  # the worker lives on

    return docs.mapInArrow(run, docs.schema)
