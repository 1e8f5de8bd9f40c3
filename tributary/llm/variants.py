"""Spelling variants: words one edit apart, found by search schemes over bidirectional FM-indexes."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tributary.llm.wordhash import text_chunks
from tributary.operators.joins import own_exchange
from tributary.session import kept_table

LETTER = "[A-Za-zÀ-ÿ]"
DELIMITER = 1  # symbol before and after every word; 0 ends the text, letters follow in code-point order
HELD_WORDS = 300_000


def _count_words(least_chars: int, slip_every: int):
    """Arrow stage: (word, n) over the texts of a task, in parts of bounded size."""

    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs_of, counts = re.compile(f"{LETTER}{{{least_chars},}}").findall, Counter()
        for batch, texts in text_chunks(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                start = zlib.crc32(f"{doc_id}:".encode())
                # bytes.lower changes A-Z alone
                for run, n in Counter(runs_of(text.lower().decode("utf-8", "replace"))).items():
                    if slip_every and not (h := zlib.crc32(run.encode(), start)) % slip_every:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least_chars:
                            continue
                    counts[run] += n
            if len(counts) > HELD_WORDS:
                yield emit(counts)
                counts = Counter()
        yield emit(counts)

    return stage


def vocabulary(docs: DataFrame, least_chars: int = 6, least_count: int = 5, slip_every: int = 0) -> DataFrame:
    """Rows (word, n): the runs of Latin letters of all whole texts with at least so many code points and occurrences.

    A-Z are lower-cased, nothing else. With ``slip_every`` a run is a misspelling where that number divides the crc32 of
    ``<doc_id>:<run>`` (a null id is no characters): it loses the code point at that crc32 modulo its length. Null texts
    have no words, repeated rows count each, other columns are ignored.
    """
    source = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    counted = source.mapInArrow(_count_words(least_chars, slip_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Ranks:
    """A wavelet matrix over the symbols that precede a text's sorted suffixes."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.zeros, self.before, self.bits = [], [], bits
        n = len(symbols)
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.before.append(np.concatenate(([0], np.cumsum(1 - bit))))
            self.zeros.append(n - int(bit.sum()))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))
        known = np.arange(1 << bits)
        self.starts = self._descend(known, np.zeros(len(known), np.int64), np.zeros(len(known), np.int64))[0]

    def _descend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        smaller = np.zeros(len(lo), np.int64)
        for i, (before, zeros) in enumerate(zip(self.before, self.zeros)):
            one = (c >> (self.bits - 1 - i)) & 1 == 1
            l0, h0 = before[lo], before[hi]
            smaller += np.where(one, h0 - l0, 0)
            lo, hi = np.where(one, zeros + lo - l0, l0), np.where(one, zeros + hi - h0, h0)
        return lo, hi, smaller

    def of(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per interval: occurrences of ``c`` before ``lo`` and before ``hi``, and of smaller symbols between them."""
        a, b, smaller = self._descend(c, lo, hi)
        return a - self.starts[c], b - self.starts[c], smaller

    def present(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All symbols that occur in each interval: interval, symbol, and what ``of`` gives for them."""
        which, c, smaller = np.arange(len(lo)), np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for before, zeros in zip(self.before, self.zeros):
            l0, h0 = before[lo], before[hi]
            left, right = h0 > l0, hi - h0 > lo - l0
            which = np.concatenate((which[left], which[right]))
            c = np.concatenate((c[left] << 1, (c[right] << 1) | 1))
            smaller = np.concatenate((smaller[left], (smaller + h0 - l0)[right]))
            lo, hi = np.concatenate((l0[left], (zeros + lo - l0)[right])), np.concatenate((h0[left], (zeros + hi - h0)[right]))
        return which, c, lo - self.starts[c], hi - self.starts[c], smaller


def _sorted_suffixes(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling."""
    rank, width = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        ahead = np.zeros(len(text), np.int64)
        ahead[: max(0, len(text) - width)] = rank[width:] + 1
        key = rank * (len(text) + 1) + ahead
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(text), np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        if rank[order[-1]] == len(text) - 1:
            return order
        width *= 2


class Index:
    """A bidirectional FM-index over sorted distinct words, each between delimiters.

    A state is (lo, back, size): the interval of the pattern among the text's sorted suffixes, and the start of the
    interval of equal size of the mirrored pattern among those of the mirrored text. A symbol put before or after the
    pattern moves both: one by ranks, the other by the number of smaller symbols.
    """

    def __init__(self, words: list[str]) -> None:
        points = self.points("".join(words))
        self.letters = np.unique(points)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.full(len(points) + len(words) + 2, DELIMITER, np.int64)
        text[np.arange(len(points)) + np.repeat(np.arange(len(words)), lengths) + 1] = np.searchsorted(self.letters, points) + 2
        text[-1] = 0
        mirrored = np.concatenate((text[-2::-1], [0]))
        bits = max(1, int(len(self.letters) + 1).bit_length())
        self.n, self.first = len(text), np.concatenate(([0], np.cumsum(np.bincount(text, minlength=1 << bits))))
        self.front, self.back = (Ranks(t[_sorted_suffixes(t) - 1], bits) for t in (text, mirrored))

    @staticmethod
    def points(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.letters, points) + 2

    def extend(self, state: tuple, c: np.ndarray, forward: bool) -> tuple:
        lo, back, size = state
        at, other, ranks = (back, lo, self.back) if forward else (lo, back, self.front)
        a, b, smaller = ranks.of(c, at, at + size)
        at, other = self.first[c] + a, other + smaller
        return (other, at, b - a) if forward else (at, other, b - a)

    def children(self, state: tuple, forward: bool) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Every letter that goes on from each state: its number, the letter, the new state."""
        lo, back, size = state
        at, other, ranks = (back, lo, self.back) if forward else (lo, back, self.front)
        which, c, a, b, smaller = ranks.present(at, at + size)
        keep = c > DELIMITER
        which, c, a, b, smaller = which[keep], c[keep], a[keep], b[keep], smaller[keep]
        at, other = self.first[c] + a, other[which] + smaller
        return which, c, (other, at, b - a) if forward else (at, other, b - a)

    def one_edit(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray, lo: np.ndarray, hi: np.ndarray, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) that differ by one edit at query places ``lo`` to ``hi``.

        ``flat[start:start + length]`` are a query's symbols. Forward: its first half is matched exactly with the
        delimiter before it, then the search runs across the second half to the right; else the other way round,
        the second half first, then to the left.
        """
        half = length // 2
        exact, far = (half, length - half) if forward else (length - half, half)
        # Symbol at distance i from the middle: the exact half towards the outside, the far half in search direction.
        near_at = (lambda i: start + half - 1 - i) if forward else (lambda i: start + half + i)
        far_at = (lambda q, i: start[q] + half[q] + i) if forward else (lambda q, i: start[q] + half[q] - 1 - i)
        first, last = (lo - half, hi - half) if forward else (half - hi, half - lo)
        q = np.arange(len(start))
        state = (np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), self.n))
        for i in range(int(exact.max(initial=0)) + 1):
            live = (i <= exact[q]) & (state[2] > 0)
            c = np.where(i < exact[q], flat[np.where(i < exact[q], near_at(i)[q], 0)], DELIMITER)
            moved = self.extend(tuple(s[live] for s in state), c[live], not forward)
            for s, m in zip(state, moved):
                s[live] = m
        keep = state[2] > 0
        q, state = q[keep], tuple(s[keep] for s in state)
        wq, wstate = q[:0], tuple(s[:0] for s in state)  # states behind their error
        found = []
        for j in range(int(far.max(initial=0)) + 1):
            here = (first[q] <= j) & (j <= last[q])
            which, c, grown = self.children(tuple(s[here] for s in state), forward)
            hq = q[here][which]
            wq, wstate = np.concatenate((wq, hq)), tuple(map(np.concatenate, zip(wstate, grown)))  # one letter too many
            over = far[wq] == j
            ended = self.extend(tuple(s[over] for s in wstate), np.full(int(over.sum()), DELIMITER), forward)
            hit = ended[2] > 0
            found.append((wq[over][hit], ended[0][hit]))
            wq, wstate = wq[~over], tuple(s[~over] for s in wstate)
            on = far[q] > j
            inside = here & on & (j < last[q])
            other = far[hq] > j
            other &= j < last[hq]
            other[other] = c[other] != flat[far_at(hq[other], j)]
            changed = hq[other], tuple(s[other] for s in grown)
            missed = q[inside], tuple(s[inside] for s in state)
            q, state = q[on], tuple(s[on] for s in state)
            state, wstate = self.extend(state, flat[far_at(q, j)], forward), self.extend(wstate, flat[far_at(wq, j)], forward)
            q, state = q[state[2] > 0], tuple(s[state[2] > 0] for s in state)
            wq = np.concatenate((wq[wstate[2] > 0], changed[0], missed[0]))
            wstate = tuple(map(np.concatenate, zip(tuple(s[wstate[2] > 0] for s in wstate), changed[1], missed[1])))
        pairs = np.unique(np.concatenate([a * self.n + b for a, b in found])) if found else np.zeros(0, np.int64)
        # Suffixes that begin with a delimiter come in the order of the words; the one before the end is first.
        return pairs // self.n, pairs % self.n - self.first[DELIMITER] - 1


def _search(_: tuple, shard: pa.Table) -> pa.Table:
    """Near words among the words of one shard, for those of its rows that ask."""
    words = shard.column("word").to_pylist()
    counts = dict(zip(words, shard.column("n").to_pylist()))
    known = sorted(counts)
    index = Index(known)
    asked = shard.filter(shard.column("asks"))
    result = [(pa.array([], pa.string()), pa.array([], pa.string()))]
    for forward in (True, False):
        some = asked.filter(pa.compute.equal(asked.column("forward"), forward))
        queries = some.column("word").to_pylist()
        length = np.fromiter(map(len, queries), np.int64, len(queries))
        lo, hi = (some.column(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
        flat = index.symbols(index.points("".join(queries)))
        of, near = index.one_edit(flat, np.cumsum(length) - length, length, lo, hi, forward)
        result.append((pa.array(queries, pa.string()).take(pa.array(of)), pa.array(known, pa.string()).take(pa.array(near))))
    word, near = (pa.concat_arrays([r[i] for r in result]) for i in (0, 1))
    return pa.table({"word": word, "near": near, "near_n": pa.array([counts[w] for w in near.to_pylist()], pa.int64())})


def _with_key(rows: DataFrame) -> DataFrame:
    """Adds the hash of all that words must share to be one edit within ``lo`` to ``hi`` away from a query of ``asked`` code points."""
    tail = F.col("asked") - F.col("hi")
    rest = F.expr("substring(word, char_length(word) - asked + hi + 1)")
    return rows.withColumn("key", F.xxhash64("asked", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")), F.when(tail > 0, rest)))


def near_words(words: DataFrame, least_chars: int = 6, rows_per_shard: int = 8_000, most_per_key: int = 4_000) -> DataFrame:
    """Rows (word, near, near_n): all pairs of distinct words that differ by one inserted, deleted or replaced code point.

    ``words`` is a written table of (word, n) without repeated words. One edit leaves one half of a word as it is. So words are dealt by
    halves: a query of given length meets all words that have its first half in front, and all that end with its second half.
    A half that more than ``most_per_key`` words share is refined: the window in which the edit may be is halved, and what
    lies outside it must agree too. A window of one code point ends this, since few words differ there alone, so every shard is
    bounded. Each shard builds a bidirectional FM-index of its words in numpy and runs the two searches of ``Index.one_edit`` for all
    its queries at once.
    """
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(*[size + d for d in (-1, 0, 1)])).alias("asked")).where(F.col("asked") >= least_chars)
    half = F.floor(F.col("asked") / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(True).alias("forward"), half.alias("lo"), F.col("asked").alias("hi")),
        F.struct(F.lit(False).alias("forward"), F.lit(0).alias("lo"), half.alias("hi")),
    )
    rows = _with_key(rows.select("word", "n", "asked", (F.col("asked") == size).alias("asks"), F.inline(sides)))
    while True:
        rows = kept_table(rows, "variant-rows")
        wide = rows.where(F.col("hi") - F.col("lo") > 1).groupBy(F.col("key").alias("hot")).agg(F.count(F.lit(1)).alias("held"))
        wide = kept_table(wide.where(F.col("held") > most_per_key).select("hot", F.lit(True).alias("split")), "variant-keys")
        if wide.isEmpty():
            break
        marked = rows.join(wide, own_exchange(["key"], ["hot"]), "left")
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(F.struct(F.col("lo").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("hi").alias("b")))
        split = (F.col("hi") - F.col("lo") > 1) & F.coalesce("split", F.lit(False))
        whole = F.array(F.struct(F.col("lo").alias("a"), F.col("hi").alias("b")))
        rows = _with_key(
            marked.select("word", "n", "asked", "asks", "forward", F.inline(F.when(split, halves).otherwise(whole))).select(
                "word", "n", "asked", "asks", "forward", F.col("a").alias("lo"), F.col("b").alias("hi")
            )
        )
    shards = max(1, -(-rows.count() // rows_per_shard))
    dealt = rows.select(F.pmod("key", F.lit(shards)).alias("shard"), "word", "n", "asks", "forward", "lo", "hi")
    return dealt.groupBy("shard").applyInArrow(_search, "word string, near string, near_n long").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) from rows (word, form) that form no cycle: the last form on the way, by pointer doubling."""
    pointing = forms.select("word", F.col("form").alias("root"))
    while True:
        pointing, seen = kept_table(pointing, "forms"), Observation()
        ahead = pointing.select(F.col("word").alias("known"), F.col("root").alias("next"))
        moved = pointing.join(ahead, own_exchange(["root"], ["known"]), "left").observe(seen, F.count("next").alias("moved"))
        pointing = kept_table(moved.select("word", F.coalesce("next", "root").alias("root")), "forms")
        if not seen.get["moved"]:
            return pointing


def group_variants(words: DataFrame, least_chars: int = 6, times: int = 5) -> DataFrame:
    """Per word: root, form, n, n_near, form_n.

    A word's form is its near word with the largest count (ties: the smallest by code points), if that is at least
    ``times`` its own; its root is where the forms lead. ``words`` holds (word, n) with distinct words of at least ``least_chars`` code
    points. An empty table gives an empty one.
    """
    words = kept_table(words.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("best")
    found = near_words(words, least_chars).groupBy(F.col("word").alias("of")).agg(F.count(F.lit(1)).alias("found"), best)
    takes: Column = -F.col("best.m") >= times * F.col("n")
    judged = words.join(found, F.col("word") == F.col("of"), "left").select(
        "word", "n", F.coalesce("found", F.lit(0)).alias("n_near"), F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.m")).alias("form_n")
    )
    judged = kept_table(judged, "judged")
    roots = _roots(judged.where("form is not null")).select(F.struct(F.col("word").alias("k")).alias("at"), "root")
    whole = judged.join(roots, F.struct(F.col("word").alias("k")) == F.col("at"), "left")
    return whole.select("word", F.coalesce("root", "word").alias("root"), "form", "n", "n_near", "form_n")
