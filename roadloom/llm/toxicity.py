"""Toxicity: a weighted finite-state pattern grammar over clauses.

A spelling transducer reads a word letter by letter and writes its weight as an insult; a lexical one maps words to
classes: insults, threats, targets, objects, negation and reported speech. Scope transducers, some of which read a
clause from its end, rewrite an insult next to a target, a threat with its victim, and both within a negation or
reported speech; the last one weighs what comes out. So a threat counts only with its victim ("i will kill you", not
"you kill time"), and a denied or reported insult or threat counts little ("you are not a ...", "he said you ...").
The best matched clause and the number of clauses that are neither denied nor reported make the score.

The insult lexicon is learned from at most FIT_POSITIVE + FIT_NEGATIVE labelled rows (drawn by id hash): candidates
are words and beginnings of words found in toxic texts and hardly in others, each as such and as recurring (twice
within SPARSE words, wherever in the text: a beginning that any text may hold once tells by its recurrence). Toxic texts that are
near copies count as one family. Every candidate that more families hold than chance explains is kept, also where
another one explains the same texts; of the weaker ones a greedy cover keeps those that explain families not yet
explained, so that chance words of copied texts are left out. The grammar's function words are no candidates. Defined
cases: null, empty and wordless texts score the base rate of unmatched texts (0.01); without toxic labels no insult is
known and only threats count; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fold, small_batches, text_rows
from .grammar import Cascade, compose, scope, spelling
from .quality import labelled_sample

FIT_POSITIVE = 3000
FIT_NEGATIVE = 9000
PREFIXES = (4, 5, 6, 7)
#: Words within which an entry stands twice to recur, however long the text.
SPARSE = 125
#: Share of toxic texts among the sample's texts that hold a lexicon entry, at least.
PRECISION = 0.9
BASE = 0.01
#: Entries that chance may add to the strongly supported ones, in the mean, over all candidates.
CHANCE = 0.05
#: Families of toxic texts that a weakly supported entry explains, at least.
LEAST = 2
#: Words to a shingle, smallest shingle hashes of a text, and how many of them near copies share.
SHINGLE, SKETCH, SHARED = 5, 8, 4

# Function words of the grammar's classes.
TARGETS = "you your yours he him his she her they them this these those du dir ihr sie er tu il elle ils tú usted él ella ellos".split()
#: Objects, which may stand before their verb.
OBJECTS = "dich euch ihn te toi vous".split()
NEGATIONS = "not never no none neither nor cannot isn't aren't don't nicht kein keine nie pas jamais ne nunca ni".split()
REPORTS = "said says saying wrote quoted reported claims claimed according called heißt sagte schrieb disait écrit dijo escribió".split()
THREATS = "kill murder destroy töten umbringen tuer matar".split()

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;\n\"“”]")
_ONLY = re.compile(r"[^\W\d_]+")


def word_features(text: str | None) -> set[str]:
    """Words (marked ``$``) and beginnings of words of a text, and once more marked ``*`` those that recur."""
    words = _ONLY.findall((text or "").lower())
    forms = {w: [w + "$", *(w[:k] for k in PREFIXES if len(w) >= k)] for w in set(words)}
    return {f for fs in forms.values() for f in fs} | {f + "*" for f in recurring(words, forms)}


def recurring(words: list[str], forms: dict[str, list[str]]) -> set[str]:
    """The forms, among those of each word, that two words less than SPARSE apart have."""
    last: dict[str, int] = {}
    out = set()
    for i, w in enumerate(words):
        for f in forms.get(w, ()):
            if i - last.get(f, -SPARSE) < SPARSE:
                out.add(f)
            last[f] = i
    return out


def grammar() -> Cascade:
    """Target, victim, negation and reported-speech scopes and the weights of what they write."""
    aimed = {"insult": "aimed"}
    victim = aimed | {"threat": "aimed-threat"}
    denied = {"insult": "denied", "aimed": "denied", "threat": "denied", "aimed-threat": "denied-threat"}
    told = denied | {"insult": "told", "aimed": "told", "aimed-threat": "told-threat"}
    ahead = compose(scope("target", 4, aimed), scope("object", 4, victim))
    behind = compose(scope("target", 3, victim), scope("object", 3, victim))
    context = compose(scope("negation", 4, denied), scope("report", 0, told))
    return Cascade([(ahead, False), (behind, True), (context, False)])


#: Share of an insult's weight that counts in each class, and what the class adds.
GAINS = {"insult": (1.0, 0.0), "aimed": (1.0, 0.5), "denied": (0.15, 0.0), "told": (0.15, 0.0), "aimed-threat": (1.0, 4.0), "denied-threat": (0.15, 0.5), "told-threat": (0.15, 0.5)}
PLAINLY = frozenset(["insult", "aimed", "aimed-threat"])


class Lexicon:
    """Insult weights by word and by beginning, and the classes of function words."""

    def __init__(self, entries: dict[str, float]):
        self.entries = entries
        self.known = {w: "report" for w in REPORTS} | {w: "negation" for w in NEGATIONS} | {w: "target" for w in TARGETS} | {w: "object" for w in OBJECTS} | {w: "threat" for w in THREATS}
        self._cache: dict[str, tuple[float, list[str]]] = {}
        self._grammar = grammar()
        self._spelling = spelling({f: w for f, w in entries.items() if f[-1:] != "*"})

    def __getstate__(self):
        return self.entries

    def __setstate__(self, entries):
        self.__init__(entries)

    def matched(self, word: str) -> tuple[float, list[str]]:
        """Weight of the heaviest entry that the word matches, else 0, and the entries that count if they recur."""
        got = self._cache.get(word)
        if got is None:
            if len(self._cache) > 300_000:
                self._cache.clear()
            forms = [word + "$", *(word[:k] for k in PREFIXES if len(word) >= k)]
            got = self._cache[word] = max(0.0, self._spelling.run([*word, "$"])[1]), [f + "*" for f in forms if f + "*" in self.entries]
        return got

    def insults(self, words: list[str]) -> dict[str, float]:
        """The insults among a text's words and their weights."""
        seen = {w: self.matched(w) for w in set(words)}
        live = recurring(words, {w: fs for w, (_, fs) in seen.items() if fs})
        return {w: x for w, (own, fs) in seen.items() if (x := max([own, *(self.entries[f] for f in fs if f in live)]))}

    def clauses(self, text: str, insults: dict[str, float]) -> Iterator[tuple[list[str], list[float]]]:
        """Classes and insult weights of each clause that holds an insult or threat."""
        classes, found, quoted, hit = [], [], False, False
        for w in _WORD.findall(text):
            if w in ".!?;\n":
                if hit:
                    yield classes, found
                classes, found, hit = (["report"] if quoted else []), ([0.0] if quoted else []), False
                continue
            if w in "\"“”":
                quoted = not quoted
                classes.append("report" if quoted else "end")
                found.append(0.0)
                continue
            x = insults.get(w, 0.0)
            c = "insult" if x else self.known.get(w, "other")
            hit = hit or c in ("insult", "threat")
            classes.append(c)
            found.append(x)
        if hit:
            yield classes, found

    def score(self, text: str | None) -> float:
        """Probability that a whole text is toxic."""
        text = (text or "").lower()
        words = _ONLY.findall(text)
        insults = self.insults(words)
        if not insults and THREATS_SET.isdisjoint(words):
            return BASE
        best, n = -math.inf, 0
        for classes, found in self.clauses(text, insults):
            said = [(o, share * x + more) for o, x in zip(self._grammar.run(classes), found, strict=True) if o in GAINS for share, more in (GAINS[o],)]
            if said:
                best = max(best, max(w for _, w in said))
                n += any(o in PLAINLY for o, _ in said)
        return max(BASE, 1 / (1 + math.exp(2.0 - best - 0.3 * math.log(max(1, n))))) if best > -math.inf else BASE


THREATS_SET = frozenset(THREATS)
FUNCTION_SET = frozenset(TARGETS + OBJECTS + NEGATIONS + REPORTS)


def sketch(text: str | None) -> list[int]:
    """The smallest hashes of a text's shingles; a shorter text is one shingle."""
    w = _ONLY.findall((text or "").lower())
    return sorted({zlib.crc32(" ".join(w[i : i + SHINGLE]).encode()) for i in range(max(1, len(w) - SHINGLE + 1))})[:SKETCH]


def families(texts: list[tuple[list[str], list[int]]]) -> list[list[str]]:
    """Entries held by each family of near copies among (entries, sketch) of texts: a text joins the first family whose first text shares enough."""
    out: list[set[str]] = []
    sizes: list[int] = []
    leads: dict[int, list[int]] = {}
    for held, marks in texts:
        shared = Counter(k for m in marks for k in leads.get(m, ()))
        k = min((k for k, n in shared.items() if n >= min(SHARED, len(marks), sizes[k])), default=None)
        if k is None:
            k = len(out)
            out.append(set())
            sizes.append(len(marks))
            for m in marks:
                leads.setdefault(m, []).append(k)
        out[k].update(held)
    return [sorted(h) for h in out]


def beyond_chance(n: int, clean: int, share: float, candidates: int) -> bool:
    """Whether chance hardly gives any of so many candidates ``n`` toxic texts next to ``clean`` ones, if ``share`` of texts are toxic (Chernoff's bound)."""
    q = n / (n + clean)
    if q <= share:
        return False
    gain = q * math.log(q / share) + ((1 - q) * math.log((1 - q) / (1 - share)) if clean else 0.0)
    return (n + clean) * gain >= math.log(candidates / CHANCE)


def wider(f: str) -> list[str]:
    """The shorter beginnings that any word of an entry has, and the entry without its recurrence."""
    form = f.rstrip("*")
    word = form.rstrip("$")
    return [word[:k] for k in PREFIXES if k < len(word) or k == len(word) and form != word] + ([form] if form != f else [])


def choose(texts: list[tuple[list[str], list[int]]], counts: dict[str, tuple[int, int]], good: set[str], share: float) -> list[str]:
    """Entries of the lexicon: all that are strongly supported, and those that cover families which these leave.

    An entry that narrows an imprecise one to some of its toxic texts must beat that one's share of toxic texts, or
    else parts of a stem of any text would pass one by one.
    """
    hits = families(texts)
    support = Counter(f for h in hits for f in h)

    def strong(f: str) -> bool:
        narrows = [counts[g] for g in wider(f) if g in counts and g not in good and counts[f][0] < PRECISION * counts[g][0]]
        base = max([share, *(n / (n + clean) for n, clean in narrows)])
        return beyond_chance(support[f], counts[f][1], base, len(counts))

    kept = {f for f in support if strong(f)}
    return sorted(kept) + cover([h for h in hits if kept.isdisjoint(h)], counts, LEAST)


def cover(hits: list[list[str]], counts: dict[str, tuple[int, int]], least: int) -> list[str]:
    """Greedy choice of entries: each explains ``least`` or more texts that earlier ones don't; ties to precision, then shorter, then first."""
    where: dict[str, list[int]] = {}
    for i, h in enumerate(hits):
        for f in h:
            where.setdefault(f, []).append(i)
    left, open_, chosen = {f: set(v) for f, v in where.items()}, set(range(len(hits))), []
    while left:
        f = max(left, key=lambda f: (len(left[f]), -counts[f][1], -len(f), f))
        new = left.pop(f)
        if len(new) < least:
            break
        chosen.append(f)
        open_ -= new
        for g in {g for i in new for g in hits[i]}:
            if g in left:
                left[g] -= new
                if not left[g]:
                    del left[g]
    return chosen


def fit(docs: DataFrame, labels: DataFrame, positives: int = FIT_POSITIVE, negatives: int = FIT_NEGATIVE) -> Lexicon:
    """Learn the lexicon from labelled documents whose fold (crc32 of the id, mod 4) is not 2."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "toxicity")
    parts = [labelled_sample(docs, labels.filter(f"toxic = {y}"), "toxic", 4, 2, most, 5) for y, most in ((1, positives), (0, negatives))]
    sample = scratch.cut(parts[0].unionByName(parts[1]).select("text", "y"))

    def tally(wanted):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            c: Counter = Counter()
            for f in frames:
                for t in f["text"]:
                    w = word_features(t)
                    c.update(w if wanted is None else w & wanted.value)
            if c:
                yield pd.DataFrame({"f": list(c), "n": list(c.values())})

        return run

    one, zero = sample.filter("y = 1"), sample.filter("y = 0")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    pos = {r["f"]: r["n"] for r in one.mapInPandas(tally(None), "f string, n long").groupBy("f").agg(F.sum("n").alias("n")).filter("n >= 2").collect()}
    wanted = spark.sparkContext.broadcast(frozenset(pos))
    neg = {r["f"]: r["n"] for r in zero.mapInPandas(tally(wanted), "f string, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()}
    counts = {f: (n, neg.get(f, 0)) for f, n in pos.items()}
    good = {f for f, (n, clean) in counts.items() if f.rstrip("$*") not in FUNCTION_SET and n * n_neg >= PRECISION / (1 - PRECISION) * clean * max(1, n_pos) and n >= (PRECISION / (1 - PRECISION)) * clean}
    kept = spark.sparkContext.broadcast(frozenset(good))

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"hits": [sorted(word_features(t) & kept.value) for t in f["text"]], "marks": [sketch(t) for t in f["text"]]})

    texts = sorted((list(r["hits"]), list(r["marks"])) for r in one.mapInPandas(held, "hits array<string>, marks array<long>").collect()) if good else []
    chosen = choose(texts, counts, good, n_pos / max(1, n_pos + n_neg))
    scratch.drop(sample)
    wanted.destroy()
    kept.destroy()
    return Lexicon({f: float(np.log((counts[f][0] + 0.5) / (n_pos + 1)) - np.log((counts[f][1] + 0.5) / (n_neg + 1))) for f in chosen})


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    out = text_rows(docs).withColumn("score", scored("text"))
    return out.select("doc_id", (F.coalesce(fold("doc_id", 4), F.lit(0)) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
