"""Toxicity by a learned lexicon, its misspellings, and the context they stand in.

Terms are learned from labelled texts: words, and stems of word families, that
stand in toxic texts far more often than chance, in contexts of their own (so
that copies of one text count once). All terms, and the toxic words of a stem's
family, make one automaton, the trie of the lexicon intersected with Levenshtein
automata: exact for stems, one edit for words of five letters, two for words of
eight. It is built as far as words lead into it, so that the lexicon needs no
limit. Words of texts run through it side by side. A term in a quotation is held
apart from one that is used, and so is one with a reporting word in the window
before it, whose weight the labelled texts decide.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from skylog.llm.common import arrow_rows, free_name, importable

# Labelled rows that are learned from, about; which ones, a hash of the id decides.
TRAIN_ROWS = 12_000
# Bytes of states that an automaton holds before it starts anew.
HELD = 64 << 20
# A term is taken when chance would bring about fewer than this many of its strength in the whole vocabulary.
CHANCE = 0.01
PRECISION, STEM_PRECISION = 0.9, 0.5
# A word of a family is judged by its own counts and this many of its stem's.
SHRINK = 4.0
STEMS = range(4, 9)
THRESHOLD = 0.3
# Words before a term among which a reporting word tells that it may be reported.
WINDOW = 6
# Characters of a text that are looked through at once.
PIECE = 1 << 20

WORD = re.compile(r"\w+")
# Quotation marks and what closes them. Fixed values.
CLOSED_BY = {
    '"': '"', "'": "'", "“": "”\"", "„": "“”\"", "”": "”", "«": "»", "»": "«»", "‹": "›", "›": "‹›", "‘": "’'", "‚": "‘’'", "’": "’",
}
_MARKS = "".join(CLOSED_BY)
# A mark opens before what it quotes and closes behind it, so that apostrophes and inches do neither; an empty line ends a paragraph.
_PARTS = re.compile(
    rf"(?P<word>\w+)|(?P<opens>(?:(?<=[\s(\[{{—–-])|\A)(?:[{_MARKS}](?=\S)|[«‹](?=\s)))"
    rf"|(?P<closes>(?<=\S)[{_MARKS}](?!\w)|(?<=\s)[»›](?!\w))|(?P<ends>\n[ \t\r]*\n)"
)
# Words that report what others say. Fixed values.
REPORTING = frozenset("said says say wrote writes called calls calling quote quoted quotes word words term terms insult insults slur".split())


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Automaton:
    """All terms at once. ``run`` gives each word's term, or -1, and the edits it took.

    A state is a set of trie nodes, each with the edits spent on the way to it;
    one trie per number of edits allowed. A stem is found with its last letter,
    whatever follows. States are made when a word first comes to them.
    """

    def __init__(self, words: list[str], stems: list[str], fuzzy: set[str]) -> None:
        self.terms = words + stems
        self.made_of = tuple(words), tuple(stems), frozenset(fuzzy)
        children: list[dict[str, int]] = [{}, {}, {}]
        ends: dict[int, tuple[int, bool]] = {}
        for number, term in enumerate(self.terms):
            stem = number >= len(words)
            node = allowed_edits(term) if term in fuzzy and not stem else 0
            for letter in term:
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                node = children[node][letter]
            if node not in ends or stem:
                ends[node] = (number, stem)
        self.children, self.ends = children, ends
        self.letters = [*sorted(set("".join(self.terms))), None]
        self.code = np.full(1 << 16, len(self.letters) - 1, np.int64)
        for i, letter in enumerate(self.letters[:-1]):
            if ord(letter) < 1 << 16:
                self.code[ord(letter)] = i
        self._begin()

    def __reduce__(self) -> tuple:
        """A process makes it once, and its tasks go on with the states that are there."""
        return automaton_of, self.made_of

    def _begin(self) -> None:
        self.number: dict[bytes, int] = {}
        self.states: list[bytes] = []
        self.held = 0
        self.table = np.zeros((256, len(self.letters)), np.int32)
        self.term, self.edits = np.full(256, -1, np.int64), np.zeros(256, np.int64)
        self._place({})
        self._place(self._closed({0: (0, 0), 1: (0, 1), 2: (0, 2)}))
        self.table[0] = 0

    def _place(self, found: dict[int, tuple[int, int]]) -> int:
        """The number of a state, whose followers are not known at first."""
        state = array("Q", sorted(node << 4 | edits << 2 | most for node, (edits, most) in found.items())).tobytes()
        if state not in self.number:
            at = self.number[state] = len(self.states)
            self.states.append(state)
            if at == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.term, self.edits = np.concatenate([self.term, self.term]), np.concatenate([self.edits, self.edits])
            self.table[at] = -1
            self.edits[at], self.term[at] = min(((edits, self.ends[n][0]) for n, (edits, _) in found.items() if n in self.ends), default=(0, -1))
            self.held += len(state) + self.table[at].nbytes
        return self.number[state]

    def _closed(self, found: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
        """With what is reached by leaving letters of the term out; a node keeps its fewest edits."""
        waiting = list(found.items())
        while waiting:
            node, (edits, most) = waiting.pop()
            if found[node][0] == edits and edits < most:
                for child in self.children[node].values():
                    if child not in found or found[child][0] > edits + 1:
                        found[child] = (edits + 1, most)
                        waiting.append((child, (edits + 1, most)))
        return found

    def _step(self, state: int, letter: str | None) -> int:
        found: dict[int, tuple[int, int]] = {}

        def put(node: int, edits: int, most: int) -> None:
            if edits <= most and (node not in found or found[node][0] > edits):
                found[node] = (edits, most)

        for entry in array("Q", self.states[state]):
            node, edits, most = entry >> 4, entry >> 2 & 3, entry & 3
            if node in self.ends and self.ends[node][1] and edits == 0:
                return self._place({node: (0, most)})
            # With no edit left, only the letter itself leads on.
            nexts = self.children[node]
            if edits < most:
                for other, child in nexts.items():
                    put(child, edits + (other != letter), most)
                put(node, edits + 1, most)
            elif letter in nexts:
                put(nexts[letter], edits, most)
        return self._place(self._closed(found))

    def run(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(points < 1 << 16, self.code[points & 0xFFFF], self.table.shape[1] - 1)
        starts = np.cumsum(lengths) - lengths
        state = np.ones(len(words), np.int32)
        if self.held > HELD:
            self._begin()
        alive, at = np.arange(len(words)), 0
        while len(alive):
            alive = alive[lengths[alive] > at]
            before, code = state[alive], codes[starts[alive] + at]
            new = self.table[before, code] < 0
            if new.any():
                for s, c in set(zip(before[new].tolist(), code[new].tolist())):
                    after = self._step(s, self.letters[c])
                    self.table[s, c] = after
            state[alive] = self.table[before, code]
            alive = alive[state[alive] > 0]
            at += 1
        return self.term[state], self.edits[state]


@lru_cache(maxsize=2)
def automaton_of(words: tuple[str, ...], stems: tuple[str, ...], fuzzy: frozenset[str]) -> Automaton:
    return Automaton(list(words), list(stems), set(fuzzy))


@dataclass
class Model:
    """What was learned: all significant terms."""

    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    weight: dict[str, float] = field(default_factory=dict)  # probability that a use of the term is toxic
    member: dict[str, float] = field(default_factory=dict)  # the same of single words of a family
    fuzzy: dict[str, float] = field(default_factory=dict)  # share of it that a misspelling keeps
    innocent: frozenset[str] = frozenset()  # words near a term that clean texts have
    bias: float = -4.0
    slopes: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, 0.0)  # of what ``_features`` gives
    quoted: float = 0.25  # score of a text that only quotes
    automaton: Automaton | None = None

    def prepare(self) -> Model:
        self.automaton = Automaton(self.words, self.stems, set(self.fuzzy))
        return self

    def hits(self, words: list[str]) -> dict[str, float]:
        """Of distinct words, those that are terms or misspell one, with their probability."""
        term, edits = self.automaton.run(words)
        found = {}
        for i in np.flatnonzero(term >= 0):
            name = self.automaton.terms[term[i]]
            if edits[i] == 0:
                found[words[i]] = self.member.get(words[i], self.weight[name])
            elif words[i] not in self.innocent:
                found[words[i]] = self.weight[name] * self.fuzzy.get(name, 0.0) / edits[i]
        return found


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and (text[end].isalnum() or text[end] == "_"):
            end += 1
        yield text[at:end]
        at = end


@dataclass
class Uses:
    """The terms a text uses, those it only reports, and how many times it quotes one."""

    used: dict[str, float] = field(default_factory=dict)
    reported: dict[str, float] = field(default_factory=dict)
    quotes: int = 0

    @property
    def only_quoted(self) -> bool:
        return bool(self.quotes and not self.used and not self.reported)

    def settle(self, paragraph: list[list], hits: dict[str, float]) -> None:
        for word, reported, quoted in paragraph:
            if quoted:
                self.quotes += 1
            else:
                (self.reported if reported else self.used)[word] = hits[word]
        paragraph.clear()


def _uses(text: str, hits: dict[str, float]) -> Uses:
    """What a text does with its terms.

    A term is quoted between a mark and the one that closes it in the same
    paragraph, however far they are apart; a mark that nothing closes quotes
    nothing. It is reported if one of the ``WINDOW`` words before it reports. A
    term that is also used counts as used.
    """
    found = Uses()
    paragraph: list[list] = []  # word, reported, quoted
    opened: dict[str, int] = {}  # by what closes it, the terms that stand before
    n_words, last_report = 0, -WINDOW - 1
    for match in _PARTS.finditer(text):
        part, kind = match.group(), match.lastgroup
        if kind == "word":
            if part in hits:
                paragraph.append([part, n_words - last_report <= WINDOW, False])
            if part in REPORTING:
                last_report = n_words
            n_words += 1
        elif kind == "opens":
            opened[CLOSED_BY[part]] = len(paragraph)
        elif kind == "closes":
            for closing in [c for c in opened if part in c]:
                for term in paragraph[opened.pop(closing) :]:
                    term[2] = True
        else:
            found.settle(paragraph, hits)
            opened.clear()
    found.settle(paragraph, hits)
    found.reported = {w: p for w, p in found.reported.items() if w not in found.used}
    return found


def _read(texts: list[str], model: Model) -> list[Uses]:
    """What each text does with its terms."""
    lowered = [t.lower() for t in texts]
    owned = [set().union(*(WORD.findall(p) for p in _pieces(t))) for t in lowered]
    hits = model.hits(list(set().union(*owned)))
    return [_uses(t, here) if (here := {w: hits[w] for w in hits.keys() & own}) else Uses() for t, own in zip(lowered, owned)]


def _features(uses: Uses) -> list[float]:
    """Evidence of all terms used, of the strongest, and how many there are; evidence of those reported, and how many."""
    made = []
    for terms in (uses.used, uses.reported):
        odds = [math.log(p / (1.0 - p)) for p in (min(max(p, 0.01), 0.99) for p in terms.values())]
        made.append([min(sum(odds), 20.0), max(odds, default=0.0), math.log1p(len(odds))])
    used, reported = made
    return [*used, reported[0], reported[2]]


def score_texts(texts: list[str], model: Model) -> list[float]:
    """Probability that each text is toxic."""
    made = []
    for uses in _read(texts, model):
        odds = model.bias + sum(w * x for w, x in zip(model.slopes, _features(uses)))
        score = 1.0 / (1.0 + math.exp(-max(min(odds, 30.0), -30.0)))
        made.append(max(score, model.quoted) if uses.only_quoted else score)
    return made


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression, the bias first, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def learning_rows(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", rows: int = TRAIN_ROWS) -> DataFrame:
    """``text, toxic`` of about ``rows`` labelled documents; none whose id is held out.

    A document with several labels is toxic if one says so.
    """
    ids = labels.select(F.col(id_column).alias("id"), (F.col(label_column) == 1).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    ids = ids.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = ids.count()
    part = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1_000_000)) < int(1_000_000 * min(1.0, rows / max(known, 1)))
    chosen = ids.where(part)
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    return texts.join(chosen, "id").select("text", "toxic")


def held_out(key):
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _significant(rows: DataFrame, vocabulary: int, share: float) -> list[Row]:
    """The rows whose part in toxic texts chance would hardly bring about (Chernoff's bound on the binomial tail), the strongest first."""
    total = F.col("toxic") + F.col("clean")
    part = F.col("toxic") / total
    other = F.when(part >= 1.0, 0.0).otherwise((1 - part) * F.log((1 - part) / F.lit(1 - share)))
    evidence = total * (part * F.log(part / F.lit(share)) + other)
    strong = rows.where((part > share) & (evidence >= math.log(max(vocabulary, 1) / CHANCE))).collect()
    return sorted(strong, key=lambda r: (-r.toxic, r.term))


def train(rows: DataFrame) -> Model:
    """A model from ``text, toxic``. Without toxic rows it has no terms, and every text gets the same score.

    Word counts are made on the cluster. The driver gets the significant terms
    alone: those that chance would hardly bring about, no more than the learning rows can hold, and five numbers per learning row to weigh them by.
    """
    rows = rows.cache()

    def count(block: dict[str, list]) -> dict[str, list]:
        clean: Counter[str] = Counter()
        contexts: set[tuple[str, int]] = set()
        for text, toxic in zip(block["text"], block["toxic"]):
            words = WORD.findall(text.lower())
            if toxic:
                contexts.update((w, hash_of(v)) for v, w in zip(["", *words], words))
            else:
                clean.update(set(words))
        listed = list(contexts)
        return {
            "term": [*clean.keys(), *(w for w, _ in listed)],
            "clean": [*clean.values(), *[0] * len(listed)],
            "context": [*[None] * len(clean), *(c for _, c in listed)],
        }

    counted = arrow_rows(rows.select("text", "toxic"), count, "term string, clean long, context long")
    words = counted.groupBy("term", "context").agg(F.sum("clean").alias("clean"))
    words = words.groupBy("term").agg(F.count("context").alias("toxic"), F.sum("clean").alias("clean")).cache()
    total = words.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    if not total.n or not total.toxic:
        rows.unpersist()
        words.unpersist()
        return Model().prepare()
    share = max(1e-6, total.toxic / (total.toxic + total.clean)) if total.clean else 0.5
    precise = F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean"))
    likely = F.col("toxic") >= STEM_PRECISION * (F.col("toxic") + F.col("clean"))
    enough = F.col("toxic") >= 3
    own = _significant(words.where(precise & enough & (F.length("term") >= 3)), total.n, share)
    sizes = F.array(*[F.lit(n) for n in STEMS])
    begun = words.select("toxic", "clean", F.explode(F.transform(F.filter(sizes, lambda n: n <= F.length("term")), lambda n: F.substring("term", F.lit(1), n))).alias("term"))
    begun = begun.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count(F.when(F.col("toxic") > 0, 1)).alias("family"))
    families = _significant(begun.where(likely & enough & (F.col("family") >= 3)), total.n, share)

    # A stem as long as its family allows: a longer one that keeps nine tenths goes before it, and covers what is longer still.
    stems: dict[str, Row] = {}
    longer: dict[str, int] = {}
    for r in families:
        longer[r.term[:-1]] = max(longer.get(r.term[:-1], 0), r.toxic)
    for r in sorted(families, key=lambda r: len(r.term)):
        if longer.get(r.term, 0) < 0.9 * r.toxic and not any(r.term[:n] in stems for n in STEMS):
            stems[r.term] = r
    single = {r.term: r for r in own if not any(r.term[:n] in stems and r.term != r.term[:n] for n in STEMS)}
    model = Model(words=sorted(single), stems=sorted(stems))
    for r in [*stems.values(), *single.values()]:
        model.weight[r.term] = (r.toxic + 1.0) / (r.toxic + r.clean + 2.0)
    # Words of the learning rows that begin with a stem: no more than those rows have.
    stem = F.coalesce(*[F.when(F.substring("term", 1, n).isin(here), F.substring("term", 1, n)) for n in STEMS if (here := [s for s in stems if len(s) == n])], F.lit(None).cast("string"))
    for r in words.select("term", "toxic", "clean", stem.alias("stem")).where("stem IS NOT NULL").collect():
        model.member[r.term] = (r.toxic + SHRINK * model.weight[r.stem]) / (r.toxic + r.clean + SHRINK)
        # Its misspellings need not begin with the stem.
        if r.toxic and r.term not in model.weight and model.member[r.term] >= STEM_PRECISION:
            model.weight[r.term] = model.member[r.term]
            model.words.append(r.term)
    model.words.sort()
    fuzzy = [w for w in model.words if allowed_edits(w)]
    model.fuzzy = dict.fromkeys(fuzzy, 1.0)
    model.prepare()

    # Words of clean texts that the edits reach: they are no misspellings, and a term with such neighbours is trusted less.
    def near(block: dict[str, list]) -> dict[str, list]:
        term, edits = model.automaton.run(block["term"])
        at = np.flatnonzero((term >= 0) & (edits > 0))
        return {"word": [block["term"][i] for i in at], "term": [model.automaton.terms[term[i]] for i in at]}

    # No more than the words of the learning rows.
    neighbours = arrow_rows(words.where("clean > 0").select("term"), near, "word string, term string", rows=10_000).collect()
    model.innocent = frozenset(r.word for r in neighbours)
    crowd = Counter(r.term for r in neighbours)
    model.fuzzy = {t: 0.9 / (1 + crowd[t]) for t in fuzzy}

    def judged(block: dict[str, list]) -> dict[str, list]:
        read = _read(block["text"], model)
        return {"features": [_features(u) for u in read], "quotes": [u.only_quoted for u in read], "toxic": [float(t) for t in block["toxic"]]}

    # A line of five numbers per learning row.
    seen = arrow_rows(rows.select("text", "toxic"), judged, "features array<double>, quotes boolean, toxic double").toPandas()
    plain = seen[~seen["quotes"]]
    if len(plain):
        bias, *slopes = _logistic(np.array(plain["features"].tolist()), plain["toxic"].to_numpy())
        model.bias, model.slopes = float(bias), tuple(map(float, slopes))
    model.quoted = (seen["toxic"][seen["quotes"]].sum() + 1.0) / (seen["quotes"].sum() + 4.0)
    rows.unpersist()
    words.unpersist()
    return model


def hash_of(word: str) -> int:
    """Alike in every process, unlike ``hash``."""
    value = 0
    for byte in word.encode("utf-8", "surrogatepass"):
        value = (value * 1000003 ^ byte) & 0x7FFFFFFFFFFF
    return value


def with_score(docs: DataFrame, model: Model, column: str, text_column: str = "text") -> DataFrame:
    """All columns of the rows, and the score of the text; null counts as empty."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                scores = score_texts([t or "" for t in part.column(place).to_pylist()], model)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, column])

    importable(docs.sparkSession)
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def score_documents(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One line per row: ``doc_id, held_out, score, predicted``.

    ``held_out`` ids (crc32 of the id as text leaves 2 modulo 4) are never
    learned from; a null id is not held out. Null and empty texts get the score
    of a text without terms. Repeated rows get a line each.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    scored = with_score(rows, model, "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows not predicted toxic, with all their columns, whatever their names."""
    score = free_name("_toxicity", docs)
    return with_score(docs, model, score, text_column).where(F.col(score) < THRESHOLD).drop(score)
