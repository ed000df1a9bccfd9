"""Toxicity by a weighted lexicon: folding, Aho-Corasick, exception phrases, length."""

import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tierlake.llm.common import Scratch, hash_sample
from tierlake.llm.words import words

# Letters of other alphabets, and digits, that look like the Latin letter.
LOOKALIKES = {
    "а": "a", "ɑ": "a", "α": "a", "4": "a", "в": "b", "ь": "b", "β": "b", "8": "b", "с": "c", "ϲ": "c",
    "ԁ": "d", "е": "e", "ё": "e", "є": "e", "ε": "e", "3": "e", "ɡ": "g", "9": "g", "һ": "h", "н": "h",
    "і": "i", "ї": "i", "ι": "i", "ı": "i", "1": "i", "ј": "j", "к": "k", "κ": "k", "ӏ": "l", "м": "m",
    "п": "n", "η": "n", "о": "o", "ο": "o", "σ": "o", "ө": "o", "0": "o", "р": "p", "ρ": "p", "ԛ": "q",
    "г": "r", "ѕ": "s", "5": "s", "т": "t", "τ": "t", "7": "t", "υ": "u", "ц": "u", "ѵ": "v", "ν": "v",
    "ѡ": "w", "ԝ": "w", "ω": "w", "х": "x", "χ": "x", "у": "y", "γ": "y", "ζ": "z", "2": "z", "ß": "ss",
    "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "ł": "l", "ħ": "h", "þ": "th",
}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e"}  # letters only between two letters
SIGN = re.compile(r"(?<=[^\W_])[@$!|€]+(?=[^\W_])")
OTHERS = re.compile(r"[\W\d_]+")
STEMS = (4, 5, 6, 7)  # lengths of word beginnings that can stand for a family of words


def _table():
    """Translation of single characters: look-alikes, compatibility forms, letters without marks.

    ``l`` and ``i`` become one letter, since ``1`` and ``I`` stand for either.
    """
    table = {}
    ranges = [(0xA0, 0x250), (0x1E00, 0x1F00), (0x2100, 0x2150), (0x2460, 0x2500), (0xFF01, 0xFF5F),
              (0x1D400, 0x1D800), (0x1F130, 0x1F16A)]
    for low, high in ranges:
        for code in range(low, high):
            plain = unicodedata.normalize("NFKD", chr(code))
            plain = "".join(c for c in plain if not unicodedata.combining(c)).lower()
            if plain.isalnum() and plain != chr(code):
                table[code] = plain
    table.update({code: "" for code in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)})
    table.update({code: "" for code in range(0x300, 0x370)})
    table.update({ord(c): letter for c, letter in LOOKALIKES.items()})
    for code, plain in list(table.items()):
        table[code] = "".join(LOOKALIKES.get(c, c) for c in plain).replace("l", "i")
    table[ord("l")] = "i"
    return table


TABLE = _table()


def fold(text):
    """The folded words of a text, each with one space on both sides; no words: one space."""
    text = (text or "").lower()
    if SIGN.search(text):
        text = SIGN.sub(lambda m: "".join(SIGNS[c] for c in m[0]), text)
    text = OTHERS.sub(" ", text.translate(TABLE)).strip()
    return f" {text} " if text else " "


class Lexicon:
    """Weights of folded words (`` word ``) and stems (`` stem``), exception phrases, and the score's line."""

    def __init__(self, weights, exceptions=(), line=(0.0, 1.0)):
        self.weights, self.exceptions, self.line = dict(weights), tuple(exceptions), tuple(line)
        self.machine = None

    def __getstate__(self):
        return self.weights, self.exceptions, self.line

    def __setstate__(self, state):
        self.__init__(*state)

    def _automaton(self):
        if self.machine is None:
            self.machine = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self.machine.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                folded = fold(phrase)
                self.machine.add_word(folded, (len(folded), None))
            if len(self.machine):
                self.machine.make_automaton()
        return self.machine

    def hits(self, folded):
        """``(start, entry length, weight)`` of the hits outside exception phrases; one per word."""
        machine = self._automaton()
        if not len(machine):
            return []
        found, excused = {}, []
        for end, (size, weight) in machine.iter(folded):
            start = end - size + 1
            if weight is None:
                excused.append((start, end))
            elif start not in found or weight > found[start][1]:
                found[start] = size, weight
        # Both in the order of their starts: one sweep, with the farthest end of a phrase so far.
        kept, reach, excused = [], 0, sorted(excused, reverse=True)
        for start in sorted(found):
            while excused and excused[-1][0] <= start:
                reach = max(reach, excused.pop()[1])
            if start >= reach:
                kept.append((start, *found[start]))
        return kept

    def density(self, text):
        """Weight of the hits per thousand words, on a log scale: 0 without a hit."""
        folded = fold(text)
        words = folded.count(" ") - 1
        weight = sum(w for _, _, w in self.hits(folded))
        return math.log1p(1000 * weight / max(words, 1))

    def score(self, text):
        base, slope = self.line
        return 1 / (1 + math.exp(-(base + slope * self.density(text))))


# --- learning ------------------------------------------------------------------


def train(docs, labels, id_column="doc_id", text_column="text", label="toxic", labelled=20_000,
          least=4, purity=3.0, exceptions=()):
    """A :class:`Lexicon` from documents with a 0/1 label.

    Learns from about ``labelled`` labelled documents, those with the smallest hash of the
    id; conflicting labels of an id and nulls are left out. Entries are words and word
    beginnings of 4 to 7 letters whose smoothed log-odds of being in a toxic document are
    at least ``purity``, in ``least`` or more toxic documents. Of the sampled documents that share the least hash of their five-word
    shingles, copies as a rule, only the smallest id counts, so that the chance words of a
    copied text do not look toxic. A beginning replaces its words only if it is in clearly more documents.
    Exception phrases are a hit with the word before or after it that is in more clean
    than toxic documents; those given in ``exceptions`` are added.

    Counting is done in tasks; the driver gets the entries that the bounded sample yields, and one
    number per document of it. Of rows that repeat an id the least label and text counts. Without labels of both kinds the lexicon is empty.
    """
    given = labels.where(f"{id_column} IS NOT NULL AND {label} IS NOT NULL").groupBy(id_column).agg(
        F.min(label).alias("y"), F.max(label).alias("_y")).where("y = _y").drop("_y")
    sample = hash_sample(given, id_column, labelled)
    sampled = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text")).join(
        sample.select(F.col(id_column).alias("_id"), "y"), "_id")
    kind = sampled.schema["_id"].dataType.simpleString()
    sketched = sampled.select("_id", F.col("y").cast("int").alias("y"), "_text").mapInArrow(
        _sketch, f"_id {kind}, y int, _text string, sketch long")
    rows = sketched.groupBy("sketch").agg(
        F.min(F.struct("_id", "y", "_text")).alias("r")).select("r.y", "r._text")
    rows = Scratch(docs.sparkSession).write(rows, "toxicity-sample")

    sizes = {row["y"]: row["n"] for row in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return Lexicon({}, exceptions, (math.log((toxic + 0.5) / (clean + 0.5)), 1.0))

    counted = "entry string, clean long, toxic long"
    counts = rows.mapInArrow(_count(entries), counted).groupBy("entry").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    strong = counts.withColumn("odds", odds).where((F.col("toxic") >= least) & (F.col("odds") >= purity))
    weights = _families({row["entry"]: (row["toxic"], row["odds"]) for row in strong.collect()})

    bare = Lexicon(weights)
    phrases = rows.mapInArrow(_count(lambda folded: _phrases(folded, bare)), counted).groupBy("entry").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    mild = phrases.where("clean >= 3 AND clean > 2 * toxic").collect()
    learned = Lexicon(weights, [*exceptions, *sorted(row["entry"] for row in mild)])

    def densities(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([learned.density(t) for t in batch.column(1).to_pylist()], pa.float64())],
                names=["y", "x"])

    pairs = rows.mapInArrow(densities, "y int, x double").collect()
    learned.line = fit_line(np.array([p["x"] for p in pairs]), np.array([p["y"] for p in pairs], float))
    return learned


def _sketch(batches):
    """Adds the least hash of the five-word shingles of each text."""
    for batch in batches:
        least = []
        for text in batch.column(2).to_pylist():
            own = words(text)
            shingles = {b" ".join(own[i:i + 5]) for i in range(max(len(own) - 4, 1))}
            least.append(min(map(xxhash.xxh64_intdigest, shingles)))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.array(least, np.uint64).view(np.int64))],
            names=["_id", "y", "_text", "sketch"])


def entries(folded):
    """The words and word beginnings of a folded text, each once."""
    words = set(folded.split())
    stems = {" " + w[:n] for w in words for n in STEMS if len(w) > n}
    return stems | {f" {w} " for w in words}


def _phrases(folded, lexicon):
    """The hits of a folded text, each with the word before it and with the word after it."""
    found = set()
    for start, _, _ in lexicon.hits(folded):
        after = folded.index(" ", start + 1)
        word = folded[start:after + 1]
        before = folded.rfind(" ", 0, start)
        if before >= 0:
            found.add(folded[before:start] + word)
        following = folded.find(" ", after + 1)
        if following >= 0:
            found.add(word + folded[after + 1:following + 1])
    return found


def _count(of):
    """Documents of each label that an entry is in, added up over the batch."""

    def run(batches):
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[1 if y else 0].update(of(fold(text)))
            names = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array([counts[y][n] for n in names], pa.int64()) for y in (0, 1)]],
                names=["entry", "clean", "toxic"])

    return run


def _families(found):
    """Weights of the entries, without those that another one makes superfluous.

    Of a word and its beginnings the shortest wins among those that are in at least half
    again as many toxic documents as what it replaces; else the longer one stays.
    """
    chosen = {}
    for entry, (toxic, odds) in sorted(found.items(), key=lambda x: (-len(x[0].strip()), x[0])):
        stem = not entry.endswith(" ")
        covered = [e for e in chosen if stem and e.startswith(entry)]
        if covered and toxic < 1.5 * max(found[e][0] for e in covered):
            continue
        if stem and not covered:
            continue  # a beginning alone, without a word or longer beginning that is strong as well
        for e in covered:
            del chosen[e]
        chosen[entry] = odds
    return chosen


def fit_line(x, y, ridge=1e-3, rounds=50):
    """Intercept and slope (not below 0) of a logistic regression by Newton's method."""
    beta, design = np.zeros(2), np.column_stack([np.ones(len(x)), x])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - ridge * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def score(docs, lexicon, id_column="doc_id", text_column="text"):
    """``(id, score, predicted)`` of every row; null is an empty text, which has a score as well."""
    given = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
    kind = given.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            scores = pa.array([lexicon.score(t) for t in batch.column(1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["_id", "score"])

    scored = given.mapInArrow(run, f"_id {kind}, score double")
    return scored.select(
        F.col("_id").alias(id_column), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
