"""Toxicity scoring with a weighted finite-state pattern grammar.

The words of a sentence are read as tags: insult, threat verb, target, negation,
reporting verb, other; commas, colons and semicolons are pauses, and quotation
marks are tags too.  One small transducer reads the tags from the right, then
four composed ones from the left.

* The speech transducer (from the right) puts a reporting verb before quoted words
  that are followed by one, as in ``"…", he said``.
* The negation transducer rewrites an insult or threat within ``REACH`` words
  after a negation to its negated form.  A pause ends its reach, but what stands
  between two pauses right after the negation is skipped (``not, I think, an …``);
  a negation between pauses is an interjection and negates nothing.
* The target transducer rewrites an insult or threat near a target (before it
  in the clause, or directly after it) to its aimed form.  A pause ends the clause,
  but a target right before it aims at the word right after it.
* The threat transducer drops threat verbs that are aimed at nobody.
* The report transducer marks whatever follows a reporting verb as reported, to
  the end of the sentence.

What the machine emits over a sentence is its match: a pattern for each insult or
threat, such as ``insult``, ``insult+aimed`` or ``threat+aimed+reported``.  A
text's score is a logistic function of the weights of the patterns it matches,
and of whether it has several matches that are not negated.  The weights start
from :data:`PRIOR` and are fitted to labelled rows: all of them, added up on
Spark by their set of patterns.

The insults are the plain list below and what labelled rows show: words, and
word beginnings of 4 to 6 letters, that occur in toxic texts far more often than
their number can explain by chance.  That search reads a bounded sample
(``SAMPLE`` labelled rows of each label, drawn by a hash of the id) from which near copies
of one text are left out, since their words would all look alike.  All that it finds is
kept, unless ``most`` limits it.

Only sentences that hold an insult or a threat are read, found by one pass of a
multi-pattern automaton over the whole lower-cased text.

Defined results: a null, empty or harmless text scores what the intercept
gives; repeated rows are scored each; of several labels of an id the largest
holds; labels that are null or belong to no document are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import durable, unused
from tallyfold.session import ship_package

REACH = 4   # words over which a negation or a target works
SAMPLE = {1: 2000, 0: 8000}   # labelled rows that the search for insults reads
STEMS = (4, 5, 6)             # letters of the word beginnings it considers

# the grammar's word classes: plain lists, lower case
LEXICON: dict[str, frozenset[str]] = {
    "insult": frozenset(
        "idiot idiots idiotic moron morons moronic stupid dumb imbecile cretin loser losers scum scumbag trash"
        " garbage pathetic worthless disgusting clown clowns vermin filth filthy scoundrel bastard jerk creep"
        " coward pig swine freak lowlife parasite degenerate"
        " dummkopf blöd dumm abschaum versager trottel depp wertlos ekelhaft arschloch"
        " imbécile crétin débile ordure minable dégoûtant connard salaud"
        " estúpido imbécil tonto basura patético asqueroso inútil escoria".split()),
    "threat": frozenset(
        "kill killing murder hurt destroy beat smash stab shoot strangle burn hang punish crush"
        " töten umbringen tuer frapper matar golpear".split()),
    "target": frozenset(
        "you your yours yourself u ur he she they him her them his their these those this that people all everyone"
        " du dich dir ihr euch sie tu toi te vous ils elles usted ustedes ellos él ella".split()),
    "negation": frozenset(
        "not no never none neither nor isn't aren't wasn't weren't don't doesn't didn't won't can't cannot without"
        " nicht kein keine nie pas jamais aucun no nunca ningún".split()),
    "report": frozenset(
        "said says say saying told tells called calls calling wrote writes claimed claims reported quoted"
        " sagte nannte schrieb dit disait appelé dijo llamó escribió".split()),
}
#: weights before any label is seen, by what the match has besides its kind
PRIOR = {"intercept": -2.0, "insult": 2.0, "threat": 0.0, "aimed": 1.0, "negated": -1.5, "reported": -1.0,
         "several": 0.5}
PENALTY = 0.1

_QUOTES, _PAUSES = '"“”„«»', ",;:"
# a full stop inside quotation marks does not end the sentence around them
_SENTENCE_END = re.compile(rf"[.!?](?![.!?]{{0,3}}[{_QUOTES}])|[|\n]")
_WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_TOKENS = re.compile(rf"{_WORDS.pattern}|[{_PAUSES}{_QUOTES}]")

Emit = list[str]
Step = Callable[[object, str], tuple[object, Emit]]


class Transducer:
    """A finite-state machine over tags: ``step(state, tag) -> (state, tags)``.

    ``finish(state)`` gives what is still held back at the end of a clause.
    """

    def __init__(self, start, step: Step, finish: Callable[[object], Emit] = lambda state: []):
        self.start, self.finish = start, finish
        self._step, self._known = step, {}

    def step(self, state, tag: str) -> tuple[object, Emit]:
        if (state, tag) not in self._known:
            self._known[state, tag] = self._step(state, tag)
        return self._known[state, tag]

    def __rshift__(self, after: "Transducer") -> "Transducer":
        """Composition: the output of this one is the input of ``after``."""
        def step(state, tag):
            first, second = state
            first, tags = self.step(first, tag)
            out: Emit = []
            for t in tags:
                second, more = after.step(second, t)
                out += more
            return (first, second), out

        def finish(state):
            first, second = state
            out: Emit = []
            for t in self.finish(first):
                second, more = after.step(second, t)
                out += more
            return out + after.finish(second)

        return Transducer((self.start, after.start), step, finish)

    def run(self, tags: list[str]) -> Emit:
        state, out = self.start, []
        for tag in tags:
            state, more = self.step(state, tag)
            out += more
        return out + self.finish(state)


def _is_match(tag: str) -> bool:
    return tag.startswith(("insult", "threat"))


def _speech(state: tuple[int, bool, bool], tag: str) -> tuple[tuple[int, bool, bool], Emit]:
    """From the right.  State: words since a reporting verb that still count; inside quotation marks; reported."""
    left, inside, reported = state
    if tag == "quote":
        if inside:
            return (0, False, False), [tag, "report"] if reported else [tag]
        return (0, True, left > 0), [tag]
    if tag == "report":
        return (REACH, inside, reported), [tag]
    return (left if tag == "pause" else max(0, left - 1), inside, reported), [tag]


def _negate(state: int | str, tag: str) -> tuple[int | str, Emit]:
    """State: words that the negation still reaches (below zero: skipping what is between two
    pauses); ``open`` at the start and after a pause, ``no`` after a negation there."""
    if tag == "quote":
        return state, [tag]
    left = state if isinstance(state, int) else REACH if state == "no" else 0
    if tag == "negation":
        return "no" if state == "open" else REACH, [tag]
    if tag == "pause":
        return -left if left < 0 or state == REACH else "open", [tag]
    if left < 0:
        return left, [tag]
    if _is_match(tag) and left:
        return 0, [f"{tag}+negated"]
    return max(0, left - 1), [tag]


def _aim(state: tuple[int, str], tag: str) -> tuple[tuple[int, str], Emit]:
    """State: words since a target that still count; a match that waits one word for its target."""
    left, held = state
    if tag == "quote":
        return state, [tag]
    if held and tag == "target":
        return (REACH, ""), [f"{held}+aimed", tag]
    out = [held] if held else []
    if tag == "target":
        return (REACH, ""), [*out, tag]
    if tag == "pause":
        return (int(left == REACH), ""), [*out, tag]
    if _is_match(tag):
        return ((0, ""), [*out, f"{tag}+aimed"]) if left else ((0, tag), out)
    return (max(0, left - 1), ""), [*out, tag]


def _threats(state: int, tag: str) -> tuple[int, Emit]:
    return 0, [] if tag.startswith("threat") and "aimed" not in tag else [tag]


def _report(inside: bool, tag: str) -> tuple[bool, Emit]:
    if tag == "report":
        return True, []
    return inside, [f"{tag}+reported" if inside else tag] if _is_match(tag) else []


def grammar() -> Transducer:
    """The composed machine from the left: tags in, matched patterns out."""
    return (Transducer("open", _negate)
            >> Transducer((0, ""), _aim, lambda state: [state[1]] if state[1] else [])
            >> Transducer(0, _threats) >> Transducer(False, _report))


PATTERNS = [f"{kind}{negated}{aimed}{reported}" for kind in ("insult", "threat")
            for negated in ("", "+negated") for aimed in ("", "+aimed") for reported in ("", "+reported")
            if kind == "insult" or aimed]
FEATURES = [*PATTERNS, "several"]


@dataclass(frozen=True)
class Insults:
    """Words and word beginnings that count as insults."""

    words: frozenset[str] = LEXICON["insult"]
    stems: frozenset[str] = frozenset()

    def __contains__(self, word: str) -> bool:
        return word in self.words or any(word[:n] in self.stems for n in STEMS if len(word) > n)


class Matcher:
    """Finds the matched patterns of whole texts."""

    def __init__(self, insults: Insults = Insults(), lexicon: dict[str, frozenset[str]] = LEXICON):
        self.insults = insults
        self.tags = {word: kind for kind in ("report", "negation", "target", "threat")
                     for word in lexicon[kind]}
        self.tags |= dict.fromkeys(_PAUSES, "pause") | dict.fromkeys(_QUOTES, "quote")
        self.speech, self.machine = Transducer((0, False, False), _speech), grammar()
        self.finder = ahocorasick.Automaton()
        for word in [*lexicon["threat"], *insults.words, *insults.stems]:
            self.finder.add_word(word, len(word))
        self.finder.make_automaton()

    def tag(self, word: str) -> str:
        return "insult" if word in self.insults else self.tags.get(word, "other")

    def sentences(self, text: str) -> Iterator[str]:
        """Sentences of a lower-cased text that hold the start of an insult or threat."""
        done = 0
        for last, size in self.finder.iter(text):
            start = last - size + 1
            if start < done or text[start - 1:start].isalpha():
                continue
            begin = max((m.end() for m in _SENTENCE_END.finditer(text, done, start)), default=done)
            stop = _SENTENCE_END.search(text, last + 1)
            done = stop.end() if stop else len(text)
            yield text[begin:done]

    def match(self, text: str | None) -> Counter:
        found: Counter = Counter()
        for sentence in self.sentences((text or "").lower()):
            tags = [self.tag(w) for w in _TOKENS.findall(sentence)]
            found.update(self.machine.run(self.speech.run(tags[::-1])[::-1]))
        return found

    def features(self, text: str | None) -> list[int]:
        """1 for each of :data:`FEATURES` that the text has, 0 for the others."""
        found = self.match(text)
        plain = sum(n for pattern, n in found.items() if "negated" not in pattern)
        return [*(int(found[p] > 0) for p in PATTERNS), int(plain > 1)]


def prior_weights() -> np.ndarray:
    """Intercept, then a weight for each feature, from its parts."""
    return np.array([PRIOR["intercept"], *(sum(PRIOR[part] for part in p.split("+")) for p in FEATURES)])


def _near_copy_mark(words: list[str]) -> int:
    """Smallest hash of the text's word triples: near copies mostly share it."""
    triples = (" ".join(t) for t in zip(words, words[1:], words[2:])) if len(words) > 2 else [" ".join(words)]
    return min(xxhash.xxh64_intdigest(t) for t in triples) >> 1


def learn_insults(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", most: int | None = None) -> Insults:
    """Insults of the plain list and of a bounded sample of the labelled rows of ``docs``.

    ``most`` keeps only so many patterns, the most telling first.
    """
    spark = docs.sparkSession
    ship_package(spark)
    truth = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max(F.col(label_col).cast("int")).alias("__label"))
    drawn = None
    for label, n in SAMPLE.items():
        # at most the sum of SAMPLE rows of two numbers: small enough to broadcast
        part = truth.where(F.col("__label") == label).orderBy(F.xxhash64(id_col), id_col).limit(n)
        drawn = part if drawn is None else drawn.unionByName(part)
    rows = docs.join(F.broadcast(drawn), id_col).select("__label", F.col(text_col).alias("text"))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_WORDS.findall((t.as_py() or "").lower()) for t in batch.column(1)]
            sets = [sorted({p for w in ws for p in (w + "$", *(w[:n] for n in STEMS if len(w) > n))})
                    for ws in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_near_copy_mark(ws) for ws in words], pa.int64()),
                 pa.array(sets, pa.list_(pa.string()))], ["label", "mark", "patterns"])

    # stored: the sizes, the number of patterns and the patterns are all read from it
    sample = durable(rows.mapInArrow(marked, "label int, mark long, patterns array<string>").groupBy("mark").agg(
        F.max(F.struct("label", "patterns")).alias("one")).select("one.*"))
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Insults()
    share = toxic / (toxic + clean)
    counts = sample.select("label", F.explode("patterns").alias("pattern")).groupBy("pattern").agg(
        F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")).where("t >= 3")
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    surprise = t * F.log(t / ((t + c) * share)) + F.when(
        c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0)
    counts = counts.select("pattern", "t", "c", surprise.alias("surprise"))
    tried = counts.agg(F.count(F.lit(1))).first()[0]
    # chance alone gives about one pattern in e of the whole search
    found = counts.where((t / toxic > 10 * c / clean) & (F.col("surprise") > math.log(max(tried, 1)) + 1))
    if most is not None:
        found = found.orderBy(F.col("surprise").desc(), "pattern").limit(most)
    learned = [r["pattern"] for r in found.collect()]
    return Insults(LEXICON["insult"] | {p[:-1] for p in learned if p.endswith("$")},
                   frozenset(p for p in learned if not p.endswith("$")))


def matches(docs: DataFrame, columns: list[str | Column], insults: Insults = Insults(),
            text_col: str = "text") -> DataFrame:
    """``columns`` of docs and ``matches`` (array of int, as :data:`FEATURES`); no shuffle."""
    ship_package(docs.sparkSession)
    kept = docs.select(*columns)
    names = kept.columns
    rows = docs.select(*columns, F.col(text_col).alias(unused("__text", names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(insults)
        for batch in batches:
            found = [matcher.features(t.as_py()) for t in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(found, pa.list_(pa.int32()))], [*names, "matches"])

    schema = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes)
    return rows.mapInArrow(run, f"{schema}, matches array<int>")


def fit(matched: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> np.ndarray:
    """Weights from all labelled rows of ``matched``.

    Rows meet their label by a join on the id and are added up by their
    features: at most 2 ** len(FEATURES) = 8192 sums reach the driver, however
    many rows there are.  The fit is a logistic regression held near the prior
    weights.
    """
    truth = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max(F.col(label_col).cast("int")).alias("__label"))
    sums = matched.select(id_col, "matches").join(truth, id_col).groupBy("matches").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("__label").cast("long")).alias("toxic")).collect()
    start = prior_weights()
    if not sums:
        return start
    x = np.array([[1, *r["matches"]] for r in sums], float)
    n, toxic = (np.array([r[c] for r in sums], float) for c in ("n", "toxic"))
    weights = start.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ weights))
        slope = x.T @ (toxic - n * p) - PENALTY * (weights - start)
        curve = x.T @ (x * (n * p * (1 - p))[:, None]) + PENALTY * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 2.0 / max(float(np.abs(step).max()), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return weights


def scored(matched: DataFrame, weights: np.ndarray) -> DataFrame:
    """``matched`` with score (0 to 1) and predicted (score >= 0.5)."""
    total = F.lit(float(weights[0]))
    for i, w in enumerate(weights[1:]):
        total = total + F.col("matches")[i] * F.lit(float(w))
    return matched.withColumn("score", 1 / (1 + F.exp(-total))).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
