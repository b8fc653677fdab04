"""Toxicity by a weighted finite-state pattern grammar.

Words become classes: insult, threat, harm, intent, target, negation, reported speech, parts of insulting phrases, clause
border, other. A transducer that reads from right to left marks what a target follows (its object). Five that read from left
to right are composed into one machine: insults of several words ("piece of ..."), harm that becomes a threat by intent and
object ("will ... you", "werde dich ..."), negation, reported speech, a target before. It rewrites a clause into
readings: plain, targeted, negated, reported. What is scored is the readings of whole clauses, each with a weight.

The insult lexicon is learned from labelled rows: words and word beginnings that stand in many different contexts of
toxic documents and hardly ever in others. Contexts, not occurrences, are counted, so that copies of a document are
no evidence. The weights of the readings start at hand-set values and are fitted by a penalised logistic regression, in which
sampled rows stand for all labelled rows of their kind. A reading found n times adds its weight log2(1 + n) times: a
text is not toxic by its length alone.

Rows: null and empty texts get the score of a text without insults. Labels that repeat count once, the worse one.
Without labels the hand-set weights and the fixed lexicon are used. Very long texts are read whole, every
reading counts. Repeated rows and null ids are judged row by row, an empty table gives an empty result, and other columns may have any name.
Reruns agree.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, in_arrow, keep, only_ids, read

#: Labelled documents learned from, at most about so many of each kind, chosen by a hash of the id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2500, 20_000
#: Lengths of word beginnings that may enter the lexicon, and what an entry needs.
STEMS = range(3, 8)
MIN_CONTEXTS, MIN_CONTEXT_SHARE, MIN_WEIGHT = 5, 0.004, 4.0
#: Words after a negation within which an insult counts as negated, and after an insult or threat within which a target is its object.
REACH, OBJECT_REACH = 2, 3
THRESHOLD = 0.5
#: Words whose class a worker remembers, and texts that it holds at a time.
CACHE_WORDS, TEXTS = 60_000, 256

# Fixed lexicon by class.
INSULT = "idiot idiots moron morons imbecile cretin scum vermin loser losers dumbass bastard bastards idiota imbécil estúpido cabrón connard salaud crétin imbécile dummkopf arschloch vollidiot".split()
THREAT = "kill murder strangle stab lynch behead umbringen töten ermorden tuer assassiner matar asesinar".split()
TARGET = "you your yours yourself u he she they them him her his their du dich dir ihr euch sie tu te toi vous ils elles tú usted ustedes ellos vosotros".split()
NEGATION = "not never no isn aren wasn don doesn didn won nicht kein keine niemals pas jamais nunca jamás ningún".split()
REPORTED = "said says saying wrote writes quoted quotes quote reported reportedly alleged allegedly claimed sagte schrieb zitierte berichtete déclaré affirmé écrit dijo escribió citó afirmó".split()
INTENT = "will shall gonna going ll werde werden wirst vais va vamos voy".split()
HARM = "hurt hit beat destroy break burn shoot crush smash verletzen schlagen zerstören verbrennen erschießen frapper détruire brûler casser golpear destruir quemar romper".split()
# Insults of several words: a piece (of) dirt; shut up, drop dead.
PIECE = "piece waste pile sack stück haufen tas sac pedazo montón".split()
OF = "of de".split()
DIRT = "garbage trash filth dirt rubbish space dreck mist merde ordure basura mierda".split()
ORDER, WAY = "shut drop".split(), "up dead".split()
BORDER = "|"
#: Hand-set weight of each reading, and of a text as such.
READINGS = {"plain": 1.5, "targeted": 2.5, "negated": 0.4, "reported": 0.5, "threat": 1.5, "targeted threat": 3.0}
BIAS = -3.0
_TOKENS = re.compile(r"[^\W\d_]+|[.!?;:\n]+")


class Transducer:
    """States and arcs (state, symbol) -> (state, output); a symbol without an arc is passed on in the same state."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def step(self, state, symbol: str):
        return self.arcs.get((state, symbol), (state, symbol))


def compose(a: Transducer, b: Transducer, symbols: str) -> Transducer:
    """The machine that reads what ``a`` reads and writes what ``b`` makes of a's output."""
    start, arcs, todo, seen = (a.start, b.start), {}, [(a.start, b.start)], {(a.start, b.start)}
    while todo:
        s, t = todo.pop()
        for x in symbols:
            s2, y = a.step(s, x)
            t2, z = b.step(t, y)
            arcs[(s, t), x] = ((s2, t2), z)
            if (s2, t2) not in seen:
                seen.add((s2, t2))
                todo.append((s2, t2))
    return Transducer(start, arcs)


#: Inputs: I insult, T threat, H harm, M intent, P piece, F of, D dirt, E order, X way, Y target, N negation, R reported speech, O other, | border.
WORDS = "ITHMPFDEXYNRO|"
#: What a target follows: J insult, U threat, h harm, d dirt, x way.
WITH_OBJECT = dict(zip("ITHDX", "JUhdx"))
INPUTS = WORDS + "".join(WITH_OBJECT.values())


def _phrases() -> Transducer:
    """Insults of several words become one at their last word."""
    arcs = {}
    for state in ("", "P", "PF", "E"):
        arcs |= {(state, x): ("", x) for x in INPUTS} | {(state, "P"): ("P", "P"), (state, "E"): ("E", "E")}
    arcs["P", "F"] = ("PF", "F")
    for state, last in (("P", "D"), ("PF", "D"), ("E", "X")):
        arcs |= {(state, last): ("", "I"), (state, WITH_OBJECT[last]): ("", "J")}
    return Transducer("", arcs)


@lru_cache(maxsize=1)
def objects() -> Transducer:
    """From right to left: what has a target at most OBJECT_REACH words after it."""
    arcs = {(k, "Y"): (OBJECT_REACH, "Y") for k in range(OBJECT_REACH + 1)}
    for k in range(1, OBJECT_REACH + 1):
        arcs |= {(k, x): (k - 1, WITH_OBJECT.get(x, x)) for x in WORDS if x not in "Y|"} | {(k, BORDER): (0, BORDER)}
    return Transducer(0, arcs)


@lru_cache(maxsize=1)
def grammar() -> Transducer:
    intent = {("", "M"): ("will", "M"), ("will", "Y"): ("whom", "Y"), ("will", "h"): ("will", "V"), ("whom", "h"): ("whom", "V"), ("whom", "H"): ("whom", "V"), ("will", BORDER): ("", BORDER), ("whom", BORDER): ("", BORDER)}
    abusive = "IJTUV"
    negation = {(0, "N"): (REACH, "N")}
    for k in range(1, REACH + 1):
        negation |= {(k, x): (k - 1, x) for x in "OYMHhDdEXx"} | {(k, x): (0, "i") for x in abusive}
        negation |= {(k, "R"): (0, "R"), (k, BORDER): (0, BORDER), (k, "N"): (REACH, "N")}
    reported = {("open", "R"): ("said", "R"), ("said", BORDER): ("open", BORDER)} | {("said", x): ("said", "r") for x in abusive}
    target = {("none", "Y"): ("one", "Y"), ("one", "I"): ("one", "J"), ("one", "T"): ("one", "U"), ("one", BORDER): ("none", BORDER)}
    machine, outputs = _phrases(), INPUTS
    for start, arcs in (("", intent), (0, negation), ("open", reported), ("none", target)):
        machine = compose(machine, Transducer(start, arcs), outputs)
    return machine


_READ = {"I": "plain", "J": "targeted", "i": "negated", "r": "reported", "T": "threat", "V": "threat", "U": "targeted threat"}
#: A clause without all classes of one of these has no reading and is not walked.
_NEEDED = ("I", "T", "HM", "PD", "EX")


def walk(machine: Transducer, symbols) -> list[str]:
    state, out = machine.start, []
    for x in symbols:
        state, y = machine.step(state, x)
        out.append(y)
    return out


def readings(classes: str) -> np.ndarray:
    """How often each reading occurs in a text given as classes."""
    out = dict.fromkeys(READINGS, 0)
    for clause in classes.split(BORDER):
        if any(all(x in clause for x in needed) for needed in _NEEDED):
            for y in walk(grammar(), reversed(walk(objects(), reversed(clause)))):
                if y in _READ:
                    out[_READ[y]] += 1
    return np.array(list(out.values()), dtype=float)


class Lexicon(dict):
    """Class of a word, looked up once and then remembered; ``stems`` are word beginnings, ``words`` whole words."""

    def __init__(self, stems: frozenset, words: frozenset):
        self.stems, self.insults = stems, words | frozenset(INSULT)
        self.fixed = {w: c for c, ws in (("F", OF), ("P", PIECE), ("D", DIRT), ("E", ORDER), ("X", WAY), ("M", INTENT), ("H", HARM), ("R", REPORTED), ("N", NEGATION), ("Y", TARGET), ("T", THREAT)) for w in ws}

    def __missing__(self, w: str) -> str:
        if w[0] in ".!?;:\n":
            c = BORDER
        elif w in self.insults or any(w[:k] in self.stems for k in STEMS if k <= len(w)):
            c = "I"
        else:
            c = self.fixed.get(w, "O")
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[w] = c
        return c

    def classes(self, text: str) -> str:
        return "".join(map(self.__getitem__, _TOKENS.findall(text.lower())))


@lru_cache(maxsize=1)
def _lexicon(stems: frozenset, words: frozenset) -> Lexicon:
    return Lexicon(stems, words)


def _parts(b: pa.RecordBatch, size: int = TEXTS) -> Iterator[pa.RecordBatch]:
    for s in range(0, b.num_rows, size):
        yield b.slice(s, size)


def _features(counts: np.ndarray) -> np.ndarray:
    return np.log2(1 + counts)


def _forms(rows: DataFrame) -> DataFrame:
    """Distinct (form, document, context) of the rows' words; a form is '=word' or a word beginning."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _parts(b, 64):
                seen = set()
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    w = ["", *re.findall(r"[^\W\d_]+", text.lower()), ""]
                    for p, x, n in zip(w, w[1:], w[2:]):
                        context = hash_text(p + " " + n)
                        seen.add(("=" + x, i, context))
                        seen.update((x[:k], i, context) for k in STEMS if k <= len(x))
                form, doc, context = zip(*seen) if seen else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(form, pa.string()), pa.array(doc, pa.int64()), pa.array(context, pa.int64())], names=["form", "doc", "context"])

    return in_arrow(rows.select("_id", "_text"), run, "form string, doc long, context long")


def hash_text(s: str) -> int:
    return xxhash.xxh64_intdigest(s) - 2**63


def _clean_counts(rows: DataFrame, forms: frozenset) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for text in (t for b in batches for part in _parts(b) for t in part.column(0).to_pylist()):
            found = set()
            for x in set(re.findall(r"[^\W\d_]+", text.lower())):
                found.update(f for f in ("=" + x, *(x[:k] for k in STEMS if k <= len(x))) if f in forms)
            for f in found:
                total[f] = total.get(f, 0) + 1
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["form", "n"])

    return in_arrow(rows.select("_text"), run, "form string, n long").groupBy("form").agg(F.sum("n").alias("clean"))


def labelled(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, list[float]]:
    """_id, _text, _y of the bounded sample of labelled training rows, equal texts once; share of the rows of label 0 and 1 in it."""
    y = labels.filter(training & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("_y"))
    sizes = {r[0]: r[1] for r in y.groupBy("_y").count().collect()}  # two rows
    shares = [min(1.0, most / max(sizes.get(k, 0), 1)) for k, most in enumerate((SAMPLE_CLEAN, SAMPLE_TOXIC))]
    share = F.when(F.col("_y") == 1, shares[1]).otherwise(shares[0])
    y = keep(y.filter(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < share * 1_000_000), "labels")
    rows = only_ids(docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col), F.col(text_col).cast("string").alias("_text")), y.select(id_col), id_col, True)
    rows = rows.join(y, id_col).groupBy(F.sha2("_text", 256).alias("_h")).agg(F.min_by(F.struct(F.xxhash64(id_col).alias("_id"), "_text", "_y"), F.col(id_col)).alias("r"))
    return keep(rows.select("r.*"), "labelled"), shares


def learn(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict:
    """Lexicon and weights. What reaches the driver is bounded by the sample: forms of at most SAMPLE_TOXIC documents,
    and one row of counts per sampled document."""
    rows, shares = labelled(docs, labels, training, id_col, text_col, label_col)
    toxic, clean = rows.filter("_y = 1"), rows.filter("_y = 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    stems, words = set(), set()
    if n_toxic and n_clean:
        need = max(MIN_CONTEXTS, MIN_CONTEXT_SHARE * n_toxic)
        found = _forms(toxic).groupBy("form").agg(F.count_distinct("context").alias("contexts"), F.count_distinct("doc").alias("docs")).filter(F.col("contexts") >= need).filter(F.col("docs") >= need / 2)
        found = {r["form"]: r["docs"] for r in found.select("form", "docs").collect()}
        seen = {r["form"]: r["clean"] for r in _clean_counts(clean, frozenset(found)).collect()}
        good = {f for f, d in found.items() if np.log((d + 0.5) / (n_toxic + 1)) - np.log((seen.get(f, 0) + 0.5) / (n_clean + 1)) >= MIN_WEIGHT}
        for f in good:
            if f[0] == "=":
                if not any(f[1 : 1 + k] in good for k in STEMS):
                    words.add(f[1:])
            elif not any(f[:k] in good for k in STEMS if k < len(f)):
                stems.add(f)
    model = {"stems": frozenset(stems), "words": frozenset(words), "bias": BIAS, "weights": np.array(list(READINGS.values()))}
    if n_toxic and n_clean:
        got = counts(rows, model, "_id", "_text", "_y").select("_counts", "_y").collect()  # bounded by the sample
        model["bias"], model["weights"] = _fit(np.array([r["_counts"] for r in got]), np.array([float(r["_y"]) for r in got]), shares)
    return model


def _fit(counts: np.ndarray, y: np.ndarray, shares: list[float], penalty: float = 2.0, steps: int = 25) -> tuple[float, np.ndarray]:
    """Logistic regression by Newton's method, drawn to the hand-set weights. A row weighs 1 / the share of its kind that was
    sampled (1 on average), so that both kinds weigh as among all labelled rows."""
    weight = 1 / np.where(y == 1, shares[1], shares[0])
    weight = weight / weight.mean()
    x = np.hstack([np.ones((len(y), 1)), _features(counts)])
    prior = np.array([BIAS, *READINGS.values()])
    t, pull = prior.copy(), np.diag([1e-3, *[penalty] * len(READINGS)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + pull + 1e-9 * np.eye(len(t)), x.T @ (weight * (p - y)) + pull @ (t - prior))
        t = t - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(t[0]), np.maximum(t[1:], 0.0)


def counts(docs: DataFrame, model: dict, id_col: str, text_col: str, *more: str) -> DataFrame:
    """``id_col``, the columns ``more`` and _counts, the readings of each text."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (id_col, *more))
    stems, words = model["stems"], model["words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(stems, words)
        for part in (p for b in batches for p in _parts(b)):
            found = pa.array([readings(lexicon.classes(t or "")) for t in part.columns[-1].to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], found], names=[id_col, *more, "_counts"])

    return in_arrow(docs.select(id_col, *more, F.col(text_col).cast("string").alias("_text")), run, f"{kinds}, _counts array<double>")


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` and the number of each reading."""
    rows = counts(docs, model, id_col, text_col)
    line = F.lit(float(model["bias"]))
    for k, w in enumerate(model["weights"]):
        line = line + F.lit(float(w)) * F.log2(1 + F.get("_counts", F.lit(k)))
    s = 1 / (1 + F.exp(-line))
    return rows.select(id_col, s.alias("score"), (s >= THRESHOLD).cast("int").alias("predicted"), *[F.get("_counts", F.lit(k)).cast("long").alias("n_" + r.replace(" ", "_")) for k, r in enumerate(READINGS)])


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    model = learn(docs, read(spark, sf, "labels"), fold("doc_id", 5) != 0)
    return score(docs, model).withColumn("held_out", fold("doc_id", 5) == 0)


def reject(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are predicted toxic, whatever their ids; all columns pass as they are."""
    model = learn(docs, labels, fold(id_col, 5) != 0, id_col, text_col)
    stems, words, bias, weights = model["stems"], model["words"], float(model["bias"]), [float(w) for w in model["weights"]]
    place = docs.columns.index(text_col)

    def stays(found: np.ndarray) -> bool:
        line = bias
        for w, n in zip(weights, found.tolist()):
            line += w * math.log2(1 + n)
        return 1 / (1 + math.exp(-line)) < THRESHOLD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(stems, words)
        for part in (p for b in batches for p in _parts(b)):
            texts = part.column(place).cast(pa.string()).to_pylist()
            yield part.filter(pa.array([stays(readings(lexicon.classes(t or ""))) for t in texts], pa.bool_()))

    return in_arrow(docs, run, docs.schema)
