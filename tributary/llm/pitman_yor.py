"""A hierarchical Pitman-Yor language model, sampled by Gibbs over all training texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import crc_remainder, discard, literal_table
from tributary.llm.wordhash import Words, mix, text_chunks, word_hash
from tributary.session import kept_table

CONTEXTS = 256  # context 0: start of a text; the others: classes of the word before, by its last two bytes
UNKNOWN_SHARE = 0.5  # of the base distribution; the known words share the rest evenly
BY_TABLE = 1024  # tables of a dish that are drawn one by one, for all dishes at once
END = np.uint64(word_hash(b"\0end of text\0"))
COUNTED = "word long, ctx int, n long"
STATE = "word long, ctxs array<int>, ns array<long>, ts array<long>, root_tables long, t_sums array<long>, roots array<double>"
DOCUMENTS = "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, words array<long>, ctxs array<int>"


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text with an end token; their contexts; and where each text begins."""
    w = Words(texts)
    n = len(texts)
    starts = w.offsets + np.arange(n + 1)
    words = np.empty(starts[-1], dtype=np.uint64)
    contexts = np.zeros(starts[-1], dtype=np.int64)
    at = np.arange(len(w.hashes)) + np.searchsorted(w.offsets[1:], np.arange(len(w.hashes)), side="right")
    words[at] = w.hashes
    words[starts[1:] - 1] = END
    last = w.data[w.ends - 1].astype(np.uint64)
    second = np.where(w.ends - w.starts > 1, w.data[np.maximum(w.ends - 2, 0)], 0).astype(np.uint64)
    contexts[at + 1] = (mix(last << np.uint64(8) | second) % np.uint64(CONTEXTS - 1)).astype(np.int64) + 1
    return words, contexts, starts


def _combined(words: np.ndarray, contexts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((contexts, words))
    words, contexts, n = words[order], contexts[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (words[1:] != words[:-1]) | (contexts[1:] != contexts[:-1]))))
    return words[first], contexts[first], np.add.reduceat(n, first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow stage: (word, context, count), summed over some 16 MB of text at a time."""

    def given(parts: list) -> pa.RecordBatch:
        words, contexts, n = _combined(*(np.concatenate(x) for x in zip(*parts)))
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(contexts, pa.int32()), pa.array(n, pa.int64())], names=["word", "ctx", "n"])

    parts, held = [], 0
    for _, texts in text_chunks(batches, "text"):
        words, contexts, _ = tokens(texts)
        parts.append(_combined(words, contexts, np.ones(len(words), dtype=np.int64)))
        held += sum(map(len, texts))
        if held > 1 << 24:
            yield given(parts)
            parts, held = [], 0
    if parts:
        yield given(parts)


def seat(n: np.ndarray, new: np.ndarray, discount: float, draw: np.random.Generator) -> np.ndarray:
    """Tables that ``n`` customers of one dish take, seated one after the other by the Chinese restaurant process.

    With m seated at t tables the next opens a table with chance new / (new + m - discount t), where
    ``new`` is the weight of a new table for the dish. Until one is opened these are the chances of an urn, so
    the customers up to the next that opens one are geometric with a chance from Beta(new, m - discount t):
    a draw per table in place of one per customer, with the same distribution.
    """
    tables = np.minimum(n, 1)
    left = np.flatnonzero(n > 1)
    last, weight, t = n[left].astype(np.float64), new[left], 1
    m = np.ones(len(left))
    with np.errstate(divide="ignore", over="ignore"):
        while len(left) and t < BY_TABLE:  # rows that are left have t tables each
            chance = draw.beta(weight, m - discount * t)
            m += 1 + np.floor(draw.standard_exponential(len(left)) / -np.log1p(-chance))
            more = m <= last
            left, last, weight, m = left[more], last[more], weight[more], m[more]
            t += 1
            tables[left] = t
    for i, present, w in zip(left.tolist(), m.astype(np.int64).tolist(), weight.tolist()):
        tables[i] = _seat_on(int(n[i]), w, discount, present, t, draw)
    return tables


def _seat_on(n: int, new: float, discount: float, m: int, t: int, draw: np.random.Generator) -> int:
    """Tables after customers m to n - 1 have followed, for a dish of many tables.

    The chance only falls from one customer to the next, so of a stretch of customers each is drawn by the chance of the first
    and kept by the ratio of its own, which depends on those kept before: found by repetition, as nothing depends on later ones.
    """
    while m < n:
        stretch = min(n - m, max(64, m // 4))
        chance = new / (new + m - discount * t)
        at = np.sort(draw.choice(stretch, draw.binomial(stretch, chance), replace=False, shuffle=False))
        drawn, opened = draw.random(len(at)) * chance, np.zeros(len(at), dtype=bool)
        while True:
            before = t + np.cumsum(opened) - opened
            now = drawn < new / (new + m + at - discount * before)
            if (now == opened).all():
                break
            opened = now
        t += int(opened.sum())
        m += stretch
    return t


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


class Level:
    """Strength and discount of a level of restaurants, with customers and tables per restaurant."""

    def __init__(self, strength: float, discount: float, customers: np.ndarray, tables: np.ndarray) -> None:
        self.strength, self.discount = strength, discount
        self.customers, self.tables = customers.astype(np.float64), tables.astype(np.float64)

    def new_weight(self) -> np.ndarray:
        return self.strength + self.discount * self.tables


def _sweep(turn: int, sample: bool, children: Level, root: Level, base: float):
    """Arrow stage: one Gibbs sweep. Rows are words; a word's customers in every context restaurant are seated
    anew given the root's predictive probability, and the tables that result are its customers in the root.
    Totals of restaurants are those of the sweep before, so words are independent of each other and of the
    partition they are in. A ``sample`` sweep adds to the sums that are averaged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("word").to_numpy()
            offsets = np.concatenate(([0], np.cumsum(batch.column("ctxs").value_lengths().to_numpy())))
            flat = lambda c: batch.column(c).flatten().to_numpy()
            ctxs, ns, ts, sums = flat("ctxs"), flat("ns"), flat("ts"), flat("t_sums")
            draw = np.random.default_rng([turn, int(words[0]) & 0x7FFFFFFF, len(words)])
            customers, tables = np.add.reduceat(ts, offsets[:-1]), batch.column("root_tables").to_numpy()
            root_new = float(root.new_weight()[0])
            predictive = (customers - root.discount * tables + root_new * base) / (root.strength + root.customers[0])
            of_word = np.repeat(np.arange(len(words)), np.diff(offsets))
            ts = seat(ns, children.new_weight()[ctxs] * predictive[of_word], children.discount, draw)
            customers = np.add.reduceat(ts, offsets[:-1])
            tables = seat(customers, np.full(len(words), root_new * base), root.discount, draw)
            roots = batch.column("roots")
            if sample:
                sums = sums + ts
                old = roots.flatten().to_numpy().reshape(len(words), -1)
                now = (customers - root.discount * tables)[:, None]  # divided once the sweep's totals are known
                grown = np.concatenate((old, now), axis=1)
                roots = _lists(grown.ravel(), np.arange(len(words) + 1) * grown.shape[1], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word"), batch.column("ctxs"), batch.column("ns"), _lists(ts, offsets, pa.int64()),
                    pa.array(tables, pa.int64()), _lists(sums, offsets, pa.int64()), roots,
                ],
                names=["word", "ctxs", "ns", "ts", "root_tables", "t_sums", "roots"],
            )

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow stage: per task, sums over its words by context, and of the root (context -1)."""
    kinds = ("customers", "tables", "ones", "twos", "words")
    sums = np.zeros((CONTEXTS + 1, len(kinds)), dtype=np.int64)
    for batch in batches:
        ctxs, ns, ts = (batch.column(c).flatten().to_numpy() for c in ("ctxs", "ns", "ts"))
        for place, x in enumerate((ns, ts, ns == 1, ns == 2)):
            sums[:CONTEXTS, place] += np.bincount(ctxs, weights=x, minlength=CONTEXTS).astype(np.int64)
        per_word = np.add.reduceat(ts, np.concatenate(([0], np.cumsum(batch.column("ctxs").value_lengths().to_numpy())))[:-1]) if batch.num_rows else ts
        tables = batch.column("root_tables").to_numpy()
        sums[CONTEXTS] += [per_word.sum(), tables.sum(), (per_word == 1).sum(), (per_word == 2).sum(), batch.num_rows]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(np.arange(CONTEXTS), -1), pa.int32()), *[pa.array(sums[:, i]) for i in range(len(kinds))]], names=["ctx", *kinds]
    )


def _summed(state: DataFrame) -> np.ndarray:
    """Restaurant totals: a row per context, the last for the root; columns customers, tables, ones, twos, words."""
    rows = state.select("ctxs", "ns", "ts", "root_tables").mapInArrow(_totals, "ctx int, customers long, tables long, ones long, twos long, words long")
    found = np.zeros((CONTEXTS + 1, 5), dtype=np.int64)
    for r in rows.groupBy("ctx").agg(*[F.sum(c) for c in ("customers", "tables", "ones", "twos", "words")]).collect():
        found[r[0]] = r[1:]
    return found


def _discount(ones: float, twos: float) -> float:
    return min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5


class Frequent:
    """Counts and averaged probabilities of the most frequent words, for lookup without a shuffle."""

    def __init__(self, rows: pa.Table, weights: np.ndarray) -> None:
        words = rows.column("word").to_numpy().view(np.uint64)
        order = np.argsort(words)
        self.words, self.counts = words[order], rows.column("c").to_numpy()[order]
        self.roots = np.array(rows.column("roots").to_pylist(), dtype=np.float64).reshape(len(words), weights.shape[1])[order]
        self.own = np.zeros((len(words), CONTEXTS), dtype=np.float32)
        back = np.empty(len(words), dtype=np.int64)
        back[order] = np.arange(len(words))
        ctxs = rows.column("ctxs").combine_chunks()
        row = np.repeat(back, ctxs.value_lengths().to_numpy())
        self.own[row, ctxs.flatten().to_numpy()] = rows.column("own").combine_chunks().flatten().to_numpy()
        self.weights = weights  # context x sample: share of the root's probability

    def probability(self, at: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        return self.own[at, ctx] + (self.weights[ctx] * self.roots[at]).sum(axis=1)


def _score(shared, base_all: float):
    """Arrow stage: per text the sums over frequent words; all other tokens are handed on with their contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        top = Frequent.__new__(Frequent)
        top.__dict__.update(shared.value)
        uid = TaskContext.get().partitionId() << 36
        for batch, texts in text_chunks(batches, "text"):
            words, contexts, starts = tokens(texts)
            at = np.searchsorted(top.words, words)
            at[at == len(top.words)] = 0
            known = top.words[at] == words if len(top.words) else np.zeros(len(words), dtype=bool)
            base, score = np.zeros(len(words)), np.zeros(len(words))
            hit = at[known]
            base[known] = np.log10((top.counts[hit] + 0.5) / base_all)
            score[known] = np.log10(top.probability(hit, contexts[known]))
            per_text = lambda x: np.add.reduceat(x, starts[:-1])  # noqa: E731  every text has an end token at least
            rest = ~known
            offsets = np.concatenate(([0], np.cumsum(per_text(rest.astype(np.int64)))))
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(uid, uid + n)), batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(starts)),
                    pa.array(per_text(known.astype(np.int64))), pa.array(per_text(base)), pa.array(per_text(score)),
                    _lists(words[rest].view(np.int64), offsets, pa.int64()), _lists(contexts[rest], offsets, pa.int32()),
                ],
                names=[c.split()[0] for c in DOCUMENTS.split(", ")],
            )
            uid += n

    return run


def score_texts(
    df: DataFrame, burn_in: int = 2, samples: int = 3, strength: float = 20.0, root_strength: float = 100.0,
    broadcast_words: int = 32_768, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """Per row of ``df``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Texts whose crc32(doc_id) mod 5 is not 1 train the model (a null id does too). Two levels of Pitman-Yor
    restaurants: one per context, the class of the word before by its last two bytes, and the root that is
    parent to all of them. Seating is sampled by Gibbs: in every sweep all customers of every restaurant
    are seated anew, given the parent's probabilities; each sweep is one pass over the counts in
    place, with the totals of at most 257 restaurants passed between sweeps. After ``burn_in`` sweeps the
    predictive probabilities of ``samples`` sweeps are averaged. Unknown words are one class of the base
    distribution, with half of it.

    The counts follow the corpus and stay distributed by word. Scores of about ``broadcast_words`` most frequent words (at most
    twice as many, 256 contexts each) are broadcast, so that they need no shuffle and no hot key is left; the other tokens are
    joined by word. Null texts count as empty: the end token alone. Repeated rows are scored each; training
    counts them each. Without training rows all words are unknown. Other columns are ignored.
    """
    spark = df.sparkSession
    source = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
    ).withColumn("held_out", F.coalesce(crc_remainder(F.col("doc_id"), 5) == 1, F.lit(False)))
    counted = source.where("not held_out").select("text").mapInArrow(_count, COUNTED)
    pairs = counted.groupBy("word", "ctx").agg(F.sum("n").alias("n"))
    gathered = pairs.groupBy("word").agg(F.collect_list(F.struct("ctx", "n")).alias("x"))
    one = F.lit(1).cast("long")
    state = kept_table(
        gathered.select(
            "word", F.col("x.ctx").alias("ctxs"), F.col("x.n").alias("ns"), F.transform("x", lambda _: one).alias("ts"), one.alias("root_tables"),
            F.transform("x", lambda _: one * 0).alias("t_sums"), F.array().cast("array<double>").alias("roots"),
        ),
        "restaurants-0",
    )
    totals = _summed(state)
    train_tokens, vocabulary = int(totals[:CONTEXTS, 0].sum()), int(totals[CONTEXTS, 4])
    base = (1 - UNKNOWN_SHARE) / max(1, vocabulary)
    d_child = _discount(totals[:CONTEXTS, 2].sum(), totals[:CONTEXTS, 3].sum())
    d_root = _discount(totals[CONTEXTS, 2], totals[CONTEXTS, 3])
    weights, root_parts = [], []
    for turn in range(1, burn_in + samples + 1):
        children = Level(strength, d_child, totals[:CONTEXTS, 0], totals[:CONTEXTS, 1])
        root = Level(root_strength, d_root, totals[CONTEXTS:, 0], totals[CONTEXTS:, 1])
        after = kept_table(state.mapInArrow(_sweep(turn, turn > burn_in, children, root, base), STATE), f"restaurants-{turn}")
        discard(state)
        state, totals = after, _summed(after)
        if turn > burn_in:
            tables = totals[:CONTEXTS, 1]
            weights.append((strength + d_child * tables) / (strength + totals[:CONTEXTS, 0]) / samples)
            customers, root_tables = totals[CONTEXTS, :2]
            root_parts.append((1 / (root_strength + customers), (root_strength + d_root * root_tables) / (root_strength + customers)))
    weights = np.array(weights).T  # context x sample

    # Averaged model: own part of each (word, context), and the root's probability per sample.
    own = F.zip_with("ns", "t_sums", lambda n, t: n - t * (d_child / samples))
    totals_by_ctx = F.array(*[F.lit(float(strength + c)) for c in totals[:CONTEXTS, 0]])
    model = state.select(
        "word", F.aggregate("ns", F.lit(0).cast("long"), lambda a, x: a + x).alias("c"), "ctxs",
        F.zip_with(own, "ctxs", lambda o, x: (o / F.get(totals_by_ctx, x)).cast("float")).alias("own"),
        F.array(*[F.get("roots", F.lit(s)) * F.lit(float(a)) + F.lit(float(b * base)) for s, (a, b) in enumerate(root_parts)]).alias("roots"),
    )
    model = kept_table(model, "model")
    discard(state)
    share = max(0.0, 1 - broadcast_words / max(1, vocabulary))
    rare = model.agg(F.percentile_approx("c", share, 100_000)).first()[0] if vocabulary > broadcast_words else 0
    rare = rare or 0
    frequent = model.where(F.col("c") > rare).limit(2 * broadcast_words).toArrow()
    base_all = train_tokens + 0.5 * (vocabulary + 1)
    shared = spark.sparkContext.broadcast(vars(Frequent(frequent, weights)))
    scored = kept_table(source.mapInArrow(_score(shared, base_all), DOCUMENTS), "scored")

    by_ctx = literal_table(spark, [{"at": i, "w": [float(x) for x in row]} for i, row in enumerate(weights)], "at int, w array<double>")
    rest = scored.select("uid", F.explode(F.arrays_zip("words", "ctxs")).alias("x")).select("uid", F.col("x.words").alias("token"), F.col("x.ctxs").alias("ctx"))
    looked_up = rest.join(model.where(F.col("c") <= rare), F.col("token") == F.col("word"), "left").join(F.broadcast(by_ctx), F.col("ctx") == F.col("at"))
    unknown = F.array(*[F.lit(float(b * UNKNOWN_SHARE)) for _, b in root_parts])
    roots = F.coalesce("roots", unknown)
    shared_part = F.aggregate(F.zip_with("w", roots, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    own_part = F.coalesce(F.get("own", F.array_position("ctxs", F.col("ctx")).cast("int") - 1).cast("double"), F.lit(0.0))
    sums = looked_up.select(
        "uid", F.col("c").isNotNull().cast("long").alias("k"), F.log10((F.coalesce("c", F.lit(0)) + 0.5) / base_all).alias("b"),
        F.log10(own_part + shared_part).alias("s"),
    ).groupBy("uid").agg(F.sum("k").alias("k"), F.sum("b").alias("b"), F.sum("s").alias("s")).withColumnRenamed("uid", "r_uid")
    zero = F.lit(0)
    return scored.drop("words", "ctxs").join(sums, F.col("uid") == F.col("r_uid"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("k", zero)).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"),
    )
