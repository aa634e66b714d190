"""Toxicity: misspelled lexicon terms by Levenshtein automata over a trie, weighed by context.

* The lexicon is learned from labelled documents: words (and stems, the first ``STEM`` letters of longer
  words, if a family of words shares them) that are in toxic documents far more often than chance allows.
* Each distinct word of a text runs a Levenshtein automaton against the trie of the lexicon: a trie node is
  entered with the automaton's state (the edit distances to all beginnings of the word), and a
  branch ends when no distance is within the bound. Every learned term is in the trie. Words that share
  no deletion neighbour with a term are screened out before, at a cost that does not grow with the terms.
* A hit counts less where its context quotes it (quotation marks around it, or a word of
  reporting or naming close before) and more where other hits are near.
* A logistic model over a few sums of hits turns them into a score.

Learning runs in one task on a bounded sample of labelled rows; scoring reads every text whole, without a
shuffle.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.llm import textbatch
from passbook.llm.columns import one_text, quoted
from passbook.workspace import stored

LABELLED_ROWS = 20_000
STEM = 5
NEAR = 8  # words on either side that make a context
QUOTED = 0.25  # weight of a quoted hit
CROWDED = 0.5  # added to a hit's weight for another one near
CHANCE = 1e-9  # a term is learned if chance explains its share of toxic documents no better
LEVEL = 0.3
FAMILY = 4  # words with one stem that make a family
CLEAR = 1 << 20  # words without hit that a task remembers
MERGE = 1 << 18  # rows of counted words that wait to be added up
PIECE = 1 << 18  # shortened words that are looked up at a time
# Words that report, name or define what follows.
REPORTING = frozenset(
    "said says wrote called calling named word words term terms quote quoted means slur insult "
    "sagte nannte wort begriff zitat dit disait mot terme citation dijo palabra cita".split()
)
_OPEN = '"\'“”„«»‘’'
_QUOTES = re.compile(f"[{_OPEN}]")


def allowed(length: int) -> int:
    """Edits a term of that many letters may have."""
    return 0 if length < 5 else 1 if length < 9 else 2


@dataclass
class Node:
    next: dict[str, Node] = field(default_factory=dict)
    term: int = -1
    most: int = 0  # edits that a term at or below the node may have


class Lexicon:
    """A trie of terms with a search for the term nearest to a word."""

    def __init__(self, terms: list[str], bound: list[int] | None = None):
        self.terms = terms
        self.bound = bound or [allowed(len(t)) for t in terms]
        self.index: dict[int, Neighbours] | None = None  # by edits; made when first needed
        self.root = Node()
        for k, term in enumerate(terms):
            node = self.root
            node.most = max(node.most, self.bound[k])
            for letter in term:
                node = node.next.setdefault(letter, Node())
                node.most = max(node.most, self.bound[k])
            node.term = k

    def nearest(self, word: str) -> tuple[int, int] | None:
        """The term within its bound of edits, least edits first, then first in order: (term, edits).

        The automaton's state is three bit sets: bit i of the j-th says that the letters on the way to the node are
        at most j edits from the first i letters of the word. A step is a few shifts of whole sets.
        """
        best: tuple[int, int] | None = None
        accepting, full = 1 << len(word), (2 << len(word)) - 1
        masks: dict[str, int] = {}
        for i, letter in enumerate(word):
            masks[letter] = masks.get(letter, 0) | 1 << i
        stack = [(self.root, 1, 3 & full, 7 & full)]
        while stack:
            node, none, one, two = stack.pop()
            if node.term >= 0 and two & accepting:
                edits = 0 if none & accepting else 1 if one & accepting else 2
                if edits <= self.bound[node.term] and (best is None or (edits, node.term) < (best[1], best[0])):
                    best = (node.term, edits)
            for letter, child in node.next.items():
                same = masks.get(letter, 0)
                a = (none & same) << 1
                # the letter is new, stands for another one, or letters of the word are left out
                b = ((one & same) << 1 | none | none << 1 | a << 1) & full
                c = ((two & same) << 1 | one | one << 1 | b << 1) & full
                if c if child.most == 2 else b if child.most else a:
                    stack.append((child, a, b, c))
        return best

    def neighbours(self) -> dict[int, Neighbours]:
        """By the edits that terms may have: the terms with up to so many letters deleted."""
        if self.index is None:
            self.index = {}
            for bound in sorted(set(self.bound)):
                own = [t.encode() for t, b in zip(self.terms, self.bound, strict=True) if b == bound]
                sizes = np.array([len(r) for r in own], dtype=np.int64)
                data = np.frombuffer(b"".join(own), dtype=np.uint8)
                letters = Letters(data, np.cumsum(sizes) - sizes, sizes)
                found = [h.ravel() for d in range(bound + 1) for _, h in letters.shortened(np.arange(len(own)), d)]
                self.index[bound] = Neighbours(np.concatenate([np.empty(0, dtype=np.uint64), *found]), letters.counts)
        return self.index

    def screened(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which words may be near a term: an exact necessary condition, for all words at once.

        A word and a term that are no more than n edits apart are equal after up to n deletions from each.
        """
        letters = Letters(data, starts, sizes)
        may = np.zeros(len(starts), dtype=bool)
        for bound, known in self.neighbours().items():
            near = known.sizes[np.minimum(letters.counts, len(known.sizes) - 1)]
            for deleted in range(bound + 1):
                for which, hashes in letters.shortened(np.flatnonzero(near & ~may), deleted):
                    may[which[known.have(hashes).any(axis=1)]] = True
        return may


class Neighbours:
    """A set of hashes, and which numbers of letters a word near one of its terms can have."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        self.hashes = np.unique(hashes)
        # some bits of a hash screen out most others before the search
        self.bits = np.uint64(64 - max(16, min(24, int(len(self.hashes)).bit_length() + 5)))
        self.table = np.zeros(1 << (64 - int(self.bits)), dtype=bool)
        self.table[self._slots(self.hashes)] = True
        # the last entry stands for all words too long for any term
        self.sizes = np.zeros(int(counts.max(initial=0)) + 4, dtype=bool)
        for n in np.unique(counts).tolist():
            self.sizes[max(0, n - allowed(n)) : n + allowed(n) + 1] = True

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> self.bits).astype(np.int64)

    def have(self, hashes: np.ndarray) -> np.ndarray:
        found = self.table[self._slots(hashes)]
        some = hashes[found]
        if len(some):
            at = np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)
            found[found] = self.hashes[at] == some
        return found


class Letters:
    """Words' letters (first bytes tell them), for hashes of the words with some letters deleted."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        first = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        own = data[np.repeat(starts - first, sizes) + np.arange(total)]
        self.sums = np.zeros(total + 1, dtype=np.uint64)
        np.cumsum(textbatch._SEEDS[own] * textbatch._powers(total, textbatch._FACTOR), dtype=np.uint64, out=self.sums[1:])
        self.inverse = textbatch._powers(total + 1, textbatch._INVERSE)
        self.borders = np.append(np.flatnonzero((own & 0xC0) != 0x80), total)
        self.at = np.searchsorted(self.borders, first)  # each word's first letter
        self.counts = np.searchsorted(self.borders, first + sizes) - self.at

    def shortened(self, which: np.ndarray, deleted: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Some of the words ``which`` and the hashes of each with any ``deleted`` (0 to 2) letters out."""
        for n in np.unique(self.counts[which]).tolist():
            same = which[self.counts[which] == n]
            i, j = np.triu_indices(n, 1) if deleted == 2 else (np.arange(n), np.arange(n))
            step = max(1, PIECE // max(1, len(i)))
            for part in (same[k : k + step] for k in range(0, len(same), step)):
                if n < deleted:
                    continue
                border = self.borders[self.at[part][:, None] + np.arange(n + 1)]
                sums = self.sums[border]
                back = self.inverse[border[:, :1]]
                if deleted == 0:
                    yield part, (sums[:, -1:] - sums[:, :1]) * back
                    continue
                moved = self.inverse[border[:, i + 1] - border[:, i]]
                hashes = sums[:, i] - sums[:, :1]
                if deleted == 2:
                    hashes += (sums[:, j] - sums[:, i + 1]) * moved
                    moved = moved * self.inverse[border[:, j + 1] - border[:, j]]
                hashes += (sums[:, -1:] - sums[:, j + 1]) * moved
                yield part, hashes * back


def hashes_of(words: list[str]) -> np.ndarray:
    """The hashes that ``textbatch`` gives words of letters and digits."""
    blocks = textbatch.blocks(pa.array([" ".join(words)]), textbatch.ALPHANUMERIC)
    return np.concatenate([b.hashes() for b in blocks])


def stem_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of more than ``STEM`` letters, and for each word where its stem ends."""
    letters = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of letters
    at = np.searchsorted(letters, starts) + STEM
    stops = np.where(at < len(letters), letters[np.minimum(at, len(letters) - 1)], len(data))
    return np.flatnonzero(stops < ends), stops


def is_quoted(words: textbatch.Words, k: int) -> bool:
    """Whether word ``k`` stands between quotation marks or soon after a word of reporting."""
    first, last = max(0, k - NEAR), min(len(words.starts) - 1, k + NEAR)
    while words.doc[first] != words.doc[k]:
        first += 1
    while words.doc[last] != words.doc[k]:
        last -= 1
    begin, end = words.starts[first], words.ends[last]
    if first == 0 or words.doc[first - 1] != words.doc[k]:
        begin = words.text_starts[words.doc[k]]
    if last + 1 == len(words.starts) or words.doc[last + 1] != words.doc[k]:
        end = words.text_ends[words.doc[k]]
    before = words.data[begin : words.starts[k]].tobytes().decode("utf-8", "replace")
    after = words.data[words.ends[k] : end].tobytes().decode("utf-8", "replace")
    if _QUOTES.search(before) and _QUOTES.search(after):
        return True
    return any(words.word(j) in REPORTING for j in range(max(first, k - 4), k))


@dataclass
class Model:
    terms: dict[str, float]  # weights of the words
    stems: dict[str, float]  # weights of stems with a family of words
    lexicon: Lexicon  # the terms that may be misspelled
    harmless: frozenset[str]  # near a term, but at home in other documents
    coefficients: np.ndarray
    seen: dict[int, tuple[float, float]] = field(default_factory=dict)  # by word hash: (exact or near, stem)
    clear: np.ndarray | None = None  # word hashes without hit, by their last bits

    def __post_init__(self):
        self.exact, self.beginnings = hashes_of(list(self.terms)), hashes_of(list(self.stems))

    def _weigh(self, word: str) -> tuple[float, float]:
        weight = self.terms.get(word, 0.0)
        if not weight and word not in self.harmless:
            hit = self.lexicon.nearest(word)
            if hit is not None:
                weight = self.terms[self.lexicon.terms[hit[0]]] / (1 + hit[1])
        return weight, self.stems.get(word[:STEM], 0.0) if len(word) > STEM else 0.0

    def hits(self, words: textbatch.Words) -> list[tuple[int, float, float]]:
        """(word, weight of its term, weight of its stem) for every word that has one."""
        hashes = words.hashes()
        if not len(hashes):
            return []
        # words known to have no hit are passed over; a slot that another word took is only looked up again
        if self.clear is None:
            self.clear = np.zeros(CLEAR, dtype=np.uint64)
        slots = (hashes & np.uint64(CLEAR - 1)).astype(np.int64)
        open_ = np.flatnonzero(self.clear[slots] != hashes)
        if not len(open_):
            return []
        distinct, first = np.unique(hashes[open_], return_index=True)
        first = open_[first]
        starts, ends = words.starts[first], words.ends[first]
        may = np.isin(distinct, self.exact) | self.lexicon.screened(words.data, starts, ends - starts)
        long, stops = stem_ends(words.data, starts, ends)
        may[long] |= np.isin(words.span_hashes(starts[long], stops[long]), self.beginnings)
        self.clear[slots[first[~may]]] = distinct[~may]
        if len(self.seen) > 200_000:  # what a worker remembers is bounded
            self.seen.clear()
        found = {}
        for h, k in zip(distinct[may].tolist(), first[may].tolist(), strict=True):
            if h not in self.seen:
                self.seen[h] = self._weigh(words.word(k))
            if any(self.seen[h]):
                found[h] = self.seen[h]
            else:
                self.clear[slots[k]] = h
        if not found:
            return []
        places = np.flatnonzero(np.isin(hashes, np.array(list(found), dtype=np.uint64)))
        return [(k, *found[int(hashes[k])]) for k in places.tolist()]

    def features(self, words: textbatch.Words) -> np.ndarray:
        """Sums of hits by text; see ``NAMES``."""
        rows = np.zeros((words.n, len(NAMES)))
        counts = words.counts()
        hits = self.hits(words)
        for n, (k, term, stem) in enumerate(hits):
            text = words.doc[k]
            near = sum(
                1 for j in (n - 1, n + 1)
                if 0 <= j < len(hits) and words.doc[hits[j][0]] == text and abs(hits[j][0] - k) <= NEAR
            )
            factor = (QUOTED if is_quoted(words, k) else 1.0) * (1 + CROWDED * near)
            rows[text, 0] += factor * term
            rows[text, 1] = max(rows[text, 1], factor * term)
            rows[text, 2] += factor * stem
        size = np.maximum(counts, 1)
        rows[:, 3] = rows[:, 0] / np.sqrt(size)
        rows[:, 4] = rows[:, 2] / np.sqrt(size)
        rows[:, 5] = np.log1p(rows[:, 0])
        rows[:, 6] = np.log1p(rows[:, 2])
        rows[:, 7] = np.log1p(counts) / 10
        rows[:, 8] = 1
        rows[:, [0, 2]] = np.minimum(rows[:, [0, 2]], 50) / 10
        return rows

    def scores(self, words: textbatch.Words) -> np.ndarray:
        return 0.5 * (1 + np.tanh(0.5 * (self.features(words) @ self.coefficients)))


NAMES = ("terms", "strongest", "stems", "terms_by_size", "stems_by_size", "log_terms", "log_stems", "log_words", "one")


def learned(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> tuple[np.ndarray, np.ndarray]:
    """Which terms' documents are toxic far beyond chance, and the log odds ratio of each as its weight.

    ``toxic, other``: documents with the term. The chance of so many toxic ones among all its
    documents is bounded by Chernoff's inequality.
    """
    share = n_toxic / max(1, n_toxic + n_other)
    p = toxic / np.maximum(toxic + other, 1)
    q = np.maximum(1 - p, 1e-12)
    exponent = (toxic + other) * (
        p * np.log(np.maximum(p, 1e-12) / share) + np.where(other > 0, q * np.log(q / (1 - share)), 0.0)
    )
    chosen = (toxic >= 3) & (p > share) & (exponent > -0.5 * np.log(CHANCE) + 0.5 * np.log(max(1, (toxic > 0).sum())))
    weights = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    return chosen, weights


class Vocabulary:
    """Documents by word and label, counted by word hash; words are read back from where they first stood."""

    def __init__(self):
        self.blocks: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, ...]] = []  # hash, toxic documents, documents, place, start, end

    def add(self, words: textbatch.Words, ends: np.ndarray, which: np.ndarray, toxic: np.ndarray) -> None:
        """Counts the words ``which`` up to ``ends``: once for each text."""
        starts, ends, doc = words.starts[which], ends[which], words.doc[which]
        hashes = words.span_hashes(starts, ends)
        order = np.lexsort((doc, hashes))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        once = order[new]
        place, one = np.full(len(once), len(self.blocks), dtype=np.int32), np.ones(len(once), dtype=np.int32)
        self.blocks.append(words.data)
        part = hashes[once], toxic[words.first + doc[once]].astype(np.int32), one, place, starts[once], ends[once]
        self.parts.append(self._merged([part]))
        # what is held grows with the distinct words, not with the words
        if sum(len(p[0]) for p in self.parts[1:]) > max(MERGE, len(self.parts[0][0])):
            self.parts = [self._merged(self.parts)]

    @staticmethod
    def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        """One row for each hash, in order, with the place that came first."""
        hashes, toxic, every, *place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        if not len(first):
            return hashes, toxic, every, *place
        return hashes[first], np.add.reduceat(toxic[order], first), np.add.reduceat(every[order], first), *(x[order[first]] for x in place)

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Toxic and other documents of each distinct word, and its row."""
        self.parts = [self._merged(self.parts)]
        hashes, toxic, every = self.parts[0][:3]
        return toxic.astype(np.int64), (every - toxic).astype(np.int64), np.arange(len(hashes))

    def words(self, rows: np.ndarray) -> list[str]:
        *_, place, start, end = self.parts[0]
        return [self.blocks[place[r]][start[r] : end[r]].tobytes().decode("utf-8", "replace") for r in rows.tolist()]


def fit(texts: pa.Array, toxic: np.ndarray) -> Model:
    """The model of labelled texts; the same rows give the same model."""
    vocabulary, beginnings = Vocabulary(), Vocabulary()
    for words in textbatch.blocks(texts, textbatch.ALPHANUMERIC):
        if len(words.starts):
            vocabulary.add(words, words.ends, np.arange(len(words.starts)), toxic)
            long, stops = stem_ends(words.data, words.starts, words.ends)
            beginnings.add(words, stops, long, toxic)
    sizes = int(toxic.sum()), len(toxic) - int(toxic.sum())
    terms: dict[str, float] = {}
    stems: dict[str, float] = {}
    families: Counter = Counter()
    others: list[str] = []
    if vocabulary.parts:
        for found, counted in ((terms, vocabulary), (stems, beginnings)):
            a, b, first = counted.counts()
            chosen, weights = learned(a, b, *sizes)
            found |= sorted(zip(counted.words(first[chosen]), weights[chosen].tolist(), strict=True))
            if counted is vocabulary:
                families.update(w[:STEM] for w in counted.words(first[a > 0]) if len(w) > STEM)
                others = sorted(counted.words(first[(b > 1) & ~chosen]))
    stems = {s: w for s, w in stems.items() if families[s] >= FAMILY}
    lexicon = Lexicon(sorted(terms))
    # a word that several other documents use is no misspelling, however near a term it is; all other words near
    # the term still are
    near = near_words(lexicon, others)
    model = Model(terms, stems, lexicon, frozenset(w for w, _ in near), np.zeros(len(NAMES)))
    x = np.concatenate([model.features(w) for w in textbatch.blocks(texts, textbatch.ALPHANUMERIC)])
    model.coefficients = logistic(x, toxic.astype(float))
    model.seen.clear()
    model.clear = model.lexicon.index = None
    return model


def near_words(lexicon: Lexicon, words: list[str]) -> list[tuple[str, int]]:
    """Those of ``words`` that are near a term, with the term."""
    raw = [w.encode() for w in words]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    may = np.flatnonzero(lexicon.screened(data, np.cumsum(sizes) - sizes, sizes)).tolist()
    found = ((words[k], lexicon.nearest(words[k])) for k in may)
    return [(word, hit[0]) for word, hit in found if hit is not None]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton's method with halved steps."""
    w = np.zeros(x.shape[1])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * ridge * v @ v)

    for _ in range(rounds):
        p = 0.5 * (1 + np.tanh(0.5 * (x @ w)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        scale = 1.0
        while loss(w - scale * step) > loss(w) and scale > 1e-6:
            scale /= 2
        w = w - scale * step
        if np.abs(scale * step).max() < 1e-6:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_id: str = "doc_id",
    label_column: str = "toxic",
    labelled_rows: int = LABELLED_ROWS,
) -> Model | None:
    """The model learned from labels that are not held out; None without toxic or without other documents.

    The sample is the ``labelled_rows`` labelled ids of least hash. An id with labels that disagree
    counts as toxic. Null ids and null labels are left out.
    """
    own = labels.select(quoted(label_id).alias("_id"), quoted(label_column).alias("_toxic")).dropna()
    own = own.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    chosen = own.orderBy(F.xxhash64("_id"), "_id").limit(labelled_rows)
    texts = docs.select(quoted(id_column).alias("_doc"), quoted(text_column).alias("_text"))
    # at most labelled_rows ids go to the scan of the texts
    sample = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_doc", "_text", "_toxic")
    # an id counts once, however many rows repeat it
    sample = stored(one_text(sample, "_doc", "_text", "_toxic"), "labelled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.concat_tables(parts).combine_chunks()
        texts, toxic = rows.column("_text").combine_chunks(), rows.column("_toxic").to_numpy() > 0
        if 0 < toxic.sum() < len(toxic):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, toxic))], pa.binary())], ["model"])

    found = sample.repartition(1).sortWithinPartitions("_doc", "_text").mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0][0]) if found else None


def score(
    docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text", level: float = LEVEL
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Null, empty and blank texts get the score of a text without hits. Without a model every score is 0.
    Repeated rows score alike, null ids stay null, an empty table gives an empty one.
    """
    if model is None:
        value = F.lit(0.0)
    else:
        @F.arrow_udf(T.DoubleType())
        def run(texts: pa.Array) -> pa.Array:
            found = np.zeros(len(texts))
            for words in textbatch.blocks(texts, textbatch.ALPHANUMERIC):
                found[words.first : words.first + words.n] = model.scores(words)
            return pa.array(found)

        value = run(quoted(text_column))
    rows = docs.select(quoted(id_column).alias("doc_id"), value.alias("score"))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= level).cast("int").alias("predicted")
    )
