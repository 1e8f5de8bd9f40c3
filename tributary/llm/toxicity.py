"""Toxicity by a weighted lexicon that is learned from labels and matched with Aho-Corasick."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import crc_remainder, free_name
from tributary.llm.wordhash import text_chunks

# Letters of other scripts that look like a Latin one, and digits or signs written for a letter.
_CYRILLIC = dict(zip("авекмнорстухіјѕԁԛԝ", "abekmhopctyxijsdqw"))
_GREEK = dict(zip("αβεικνορτυχ", "abeiknoptux"))
_FULLWIDTH = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
_HOMOGLYPHS = str.maketrans(_CYRILLIC | _GREEK | _FULLWIDTH | {"ı": "i", "ɑ": "a", "ɡ": "g", "ѵ": "v", "​": "", "­": ""})
_SUBSTITUTES = str.maketrans("013457@$!", "oieastasi")
_SUBSTITUTED = re.compile(r"[013457@$!]+(?=[^\W\d_])|(?<=[^\W\d_])[013457@$]+")
_WORDS = re.compile(r"[^\W_]+")
STEM_LENGTHS = range(3, 8)
# Innocent phrases that hold a word which insults elsewhere.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "class clown", "pond scum", "sore loser")


def fold(text: str) -> list[str]:
    """The words of a text in lower case, look-alike letters and digits written for letters undone."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_HOMOGLYPHS).lower()
    return _WORDS.findall(_SUBSTITUTED.sub(lambda m: m.group().translate(_SUBSTITUTES), text))


@dataclass
class Lexicon:
    """Whole words and word stems with weights, exception phrases, and the scale from weight to score."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: Sequence[str] = EXCEPTIONS
    scale: Sequence[tuple[float, float]] = ((0.0, 0.05), (0.05, 0.5), (1.0, 0.95))

    def matcher(self) -> ahocorasick.Automaton | None:
        """Finds the longest entry at each place. Words stand between two blanks each, so that entries
        of neighbouring words do not share one; an exception phrase outlasts the words within it.
        """
        automaton = ahocorasick.Automaton()
        for stem, weight in self.stems.items():
            automaton.add_word(f" {stem}", (weight, stem))
        for word, weight in self.words.items():
            automaton.add_word(f" {word} ", (weight, word))
        for phrase in self.exceptions:
            automaton.add_word(f" {'  '.join(phrase.split())} ", (0.0, ""))
        if not len(automaton):
            return None
        automaton.make_automaton()
        return automaton

    def weigh(self, words: list[str], automaton: ahocorasick.Automaton | None) -> tuple[float, int]:
        """Sum of weights over the root of the length, and the number of entries found."""
        if not words or automaton is None:
            return 0.0, 0
        found = [w for _, (w, _) in automaton.iter_long(f" {'  '.join(words)} ") if w]
        return sum(found) / math.sqrt(len(words)), len(found)

    def score(self, weight: float) -> float:
        x, y = zip(*self.scale)
        return float(0.999 * np.interp(weight, x, y) + 0.001 * weight / (1 + weight))


def _evidence(pos: float, n: float, base: float) -> float:
    """How surely a term marks toxic texts: n times the divergence of its rate from the base rate."""
    rate = pos / n
    if rate <= base:
        return 0.0
    return n * (rate * math.log(rate / base) + ((1 - rate) * math.log((1 - rate) / (1 - base)) if rate < 1 else 0))


def _terms(words: list[str]) -> Iterator[tuple[str, str]]:
    """Each word (with an end mark) and its stems, with the neighbouring words."""
    for i, word in enumerate(words):
        around = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
        if len(word) >= 3:
            yield word + "$", around
        for n in STEM_LENGTHS:
            if len(word) > n:
                yield word[:n], around


def _sites(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in text_chunks(batches, "text"):
        found = {(term, hash_of(around)) for t in texts for term, around in _terms(fold(t.decode()))}
        terms, places = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(places, pa.int64())], names=["term", "place"])


def hash_of(text: str) -> int:
    """A number of a text that is the same in every process."""
    import zlib

    data = text.encode()
    return zlib.crc32(data) << 31 | zlib.adler32(data) >> 1


def _counter(kind: str, wanted: frozenset[str], lexicon: Lexicon | None):
    """Arrow stage: per task, in how many toxic and clean texts each wanted term (or phrase, or weight) occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.matcher() if lexicon else None
        toxic, clean = Counter(), Counter()
        for batch, texts in text_chunks(batches, "text"):
            for label, t in zip(batch.column("toxic").to_pylist(), texts):
                words = fold(t.decode())
                if kind == "terms":
                    found = {term for term, _ in _terms(words)} & wanted
                elif kind == "phrases":
                    hit = [w in wanted for w in words]
                    found = {f"{a} {b}" for a, b, h, k in zip(words, words[1:], hit, hit[1:]) if h or k}
                else:
                    weight = lexicon.weigh(words, automaton)[0]
                    found = [str(round(math.log(weight) * 4)) if weight > 0 else "none"]
                (toxic if label else clean).update(found)
        terms = sorted(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64())],
            names=["term", "pos", "neg"],
        )

    return run


def _counted(train: DataFrame, kind: str, wanted: frozenset[str] = frozenset(), lexicon: Lexicon | None = None) -> DataFrame:
    rows = train.select("text", "toxic").mapInArrow(_counter(kind, wanted, lexicon), "term string, pos long, neg long")
    return rows.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def learn_lexicon(train: DataFrame, max_terms: int = 20_000, evidence: float = 12.0, exceptions: Sequence[str] = EXCEPTIONS) -> Lexicon:
    """Lexicon from labelled rows (text, toxic).

    Candidates are words and stems found in toxic texts at five places or more that differ in the words
    around them, so that copies of one text count once; the ``max_terms`` most frequent are weighed.
    A term is taken if its evidence against the base rate suffices (about a 1 in 160,000 chance for 12), and
    weighs the log of its odds. A stem is taken only for what it finds beyond its words. Phrases of an
    entry and a neighbour that prove clean are exceptions. The scale is the share of toxic rows by
    weight, made monotone. The driver sees aggregates only: terms, phrases, and bins of weights.
    """
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    positives, negatives = sizes.get(1, 0), sizes.get(0, 0)
    if not positives or not negatives:
        return Lexicon(exceptions=exceptions)
    base = positives / (positives + negatives)
    sites = train.where("toxic = 1").select("text").mapInArrow(_sites, "term string, place long").distinct()
    frequent = sites.groupBy("term").agg(F.count(F.lit(1)).alias("places")).where("places >= 5")
    places = {r["term"]: r["places"] for r in frequent.orderBy(F.desc("places"), "term").limit(max_terms).collect()}
    counts = {r["term"]: (min(r["pos"], places[r["term"]]), r["pos"], r["neg"]) for r in _counted(train, "terms", frozenset(places)).collect()}

    def weight(pos: int, neg: int) -> float:
        return math.log((pos + 0.5) / (positives + 1)) - math.log((neg + 0.5) / (negatives + 1))

    sure = {t: (p, n) for t, (p, p_all, n) in counts.items() if p_all and p >= 5 and _evidence(p, p + n * p / p_all, base) >= evidence and weight(p_all, n) > 1.5}
    words = {t[:-1]: weight(p, n) for t, (p, n) in sure.items() if t.endswith("$")}
    stems: dict[str, float] = {}
    for stem, (p, n) in sorted(sure.items(), key=lambda x: (len(x[0]), x[0])):
        if stem.endswith("$") or any(stem[:k] in stems for k in STEM_LENGTHS if k < len(stem)):
            continue
        own = max((sure[w + "$"][0] for w in words if w.startswith(stem)), default=0)
        if _evidence(max(p - own, 0), max(p - own, 0) + n or 1, base) >= evidence:
            stems[stem] = weight(p, n)
    words = {w: x for w, x in words.items() if not any(w[:k] in stems and stems[w[:k]] >= 0.75 * x for k in STEM_LENGTHS)}
    phrases = _counted(train, "phrases", frozenset(words)).where(F.col("neg") >= 5).orderBy(F.desc("neg"), "term").limit(max_terms)
    clean = [r["term"] for r in phrases.collect() if r["pos"] / (r["pos"] + r["neg"]) < 0.5 * base]
    lexicon = Lexicon(words, stems, [*exceptions, *clean])

    bins = {r["term"]: (r["pos"], r["neg"]) for r in _counted(train, "weights", lexicon=lexicon).collect()}
    places = sorted((0.0 if t == "none" else math.exp(int(t) / 4), p, p + n) for t, (p, n) in bins.items())
    merged: list[list[float]] = []  # pool adjacent violators: weight sum, toxic, all, least, most
    for x, p, n in places:
        merged.append([x, x, p + base, n + 1])
        while len(merged) > 1 and merged[-2][2] / merged[-2][3] > merged[-1][2] / merged[-1][3]:
            _, most, p2, n2 = merged.pop()
            merged[-1] = [merged[-1][0], most, merged[-1][2] + p2, merged[-1][3] + n2]
    lexicon.scale = [point for least, most, p, n in merged for point in ((least, p / n), (most, p / n))]
    return lexicon


def toxicity(text: str | Column, lexicon: Lexicon) -> Column:
    """Struct (score, hits, n_words) of a text column; null and empty texts score as without any entry."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.matcher()
        for texts in batches:
            rows = []
            for t in texts:
                words = fold(t) if t else []
                weight, hits = lexicon.weigh(words, automaton)
                rows.append((lexicon.score(weight), hits, len(words)))
            yield pd.DataFrame(rows, columns=["score", "hits", "n_words"])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "score double, hits int, n_words int")(text)


def labelled_sample(df: DataFrame, labels: DataFrame, fit_rows: int = 40_000, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (text, toxic) to learn from: at most ``fit_rows`` labelled ids whose crc32 leaves no 2 modulo 4.

    They are drawn by the hash of the id, so any part of the id range is as likely, and only their ids and
    labels, bounded by ``fit_rows``, are broadcast. An id with several labels counts as toxic if any is.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (crc_remainder(F.col("doc_id"), 4) != 2))
    ids = usable.groupBy(F.col("doc_id").cast("long").alias("_label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    ids = ids.orderBy(F.xxhash64("_label_id"), "_label_id").limit(fit_rows)
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(ids), F.col("_id") == F.col("_label_id")).select("text", "toxic")


def score_toxicity(df: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = 40_000, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row of ``df``: doc_id, held_out, score, predicted, hits, n_words.

    Labels teach the lexicon only through rows whose crc32(doc_id) mod 4 is not 2; the others are held
    out. Null texts count as empty and score like any text without an entry; a null id is not held out;
    repeated rows get the same score. Without labels of both kinds the lexicon is empty. Other columns are ignored.
    """
    lexicon = learn_lexicon(labelled_sample(df, labels, fit_rows, text, doc_id))
    scored = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), toxicity(F.col(f"`{text}`"), lexicon).alias("s"))
    return scored.select(
        "doc_id", F.coalesce(crc_remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "s.score",
        (F.col("s.score") >= threshold).cast("int").alias("predicted"), "s.hits", "s.n_words",
    )


def drop_toxic(df: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = 40_000, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that score below ``threshold``, whole, where they are.

    A text without any entry of the lexicon stays, whatever share of the labelled rows is toxic. Other columns
    are handed on, whatever their names.
    """
    lexicon = learn_lexicon(labelled_sample(df, labels, fit_rows, text, doc_id))
    found = free_name(df, "toxicity")
    scored = df.withColumn(found, toxicity(F.col(f"`{text}`"), lexicon))
    return scored.where((F.col(f"{found}.score") < threshold) | (F.col(f"{found}.hits") == 0)).drop(found)
