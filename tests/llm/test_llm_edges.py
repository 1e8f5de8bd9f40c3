"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, beside brute force."""

import gzip
import io
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm import bayes_minhash, exact, lattice, linealign, mixing, packing, pitman_yor, token_files, toxicity, warc
from tributary.llm.bpe import Encoder
from tributary.llm.common import components
from tributary.llm.queries import TOKENIZER

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, block string, n string, length string, sha string, name string"
LONG = " ".join(f"w{i % 977}" for i in range(30000))
ODD = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "a b c d e f g"), (5, "a b c d e f g"), (6, "A B C D E F G"), (7, LONG), (8, LONG + " x"),
       (None, "a b c d e f g"), (None, None), (9, "a b c d e f h"), (10, "é <|endoftext|>  \t x ")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None if i == 4 else "src0", "x", "x", "x", "x", "x") for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")


def all_ops(labels):
    return {
        "mix": lambda d: mixing.mix_sources(d, {"src0": 3, "src1": 1}, 1, 2), "ordered": lambda d: mixing.mixed_order(d, {"src0": 3}, 1, 2),
        "toxicity": lambda d: toxicity.score_toxicity(d, labels), "clean": lambda d: toxicity.drop_toxic(d, labels),
        "align": linealign.drop_aligned_blocks, "pack": lambda d: packing.best_fit_pack(d, TOKENIZER), "model": pitman_yor.score_texts,
        "exact": exact.mark_copies, "tokens": lambda d: token_files.token_files_round_trip(d, TOKENIZER), "near": bayes_minhash.near_documents,
        "drop_exact": exact.drop_copies, "drop_near": bayes_minhash.drop_near_copies,
    }


@pytest.mark.parametrize("name", list(all_ops(None)))
def test_odd_rows_and_empty_tables(odd, none, labels, name):
    op = all_ops(labels)[name]
    assert op(none).count() == 0
    n = op(odd).count()
    if name not in ("pack", "drop_exact", "drop_near"):
        assert n == len(ODD)


CLASHING = ("s", "_key", "_md5", "_slice", "_sha", "_h", "_id", "_row", "_suspect", "_block", "_filter_block", "_keep", "_times", "_lost",
            "__lost", "_toxicity", "_Toxicity2", "_doc", "_text", "_span_key", "_gone", "a.b")
HANDS_ON = ("mix", "ordered", "clean", "align", "drop_exact", "drop_near")


@pytest.mark.parametrize("name", HANDS_ON)
def test_columns_with_clashing_names_are_handed_on(spark, labels, name):
    values = [f"v{i}" for i in range(len(CLASHING))]
    rows = [(1, "a b c d e f g h", "src0", *values), (2, "A B C D E F G H", None, *values), (3, None, "src1", *values)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", *CLASHING])
    result = all_ops(labels)[name](df)
    assert [c for c in result.columns if c in df.columns] == df.columns
    found = [tuple(r) for r in result.select(*[f"`{c}`" for c in CLASHING]).collect()]
    assert found == [tuple(values)] * {"drop_exact": 2, "drop_near": 2}.get(name, 3)


@pytest.mark.parametrize("name, column", [("mix", "Mix_slot"), ("ordered", "mix_place"), ("align", "N_lines")])
def test_result_columns_replace_those_of_the_same_name(spark, labels, name, column):
    df = spark.createDataFrame([(1, "a b c", "src0", "x")], ["doc_id", "text", "source", column])
    result = all_ops(labels)[name](df)
    assert [c.lower() for c in result.columns].count(column.lower()) == 1
    assert isinstance(result.first()[column.lower()], int)


def test_exact_copies(odd):
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in exact.drop_copies(odd).collect())
    assert [i for known, i in ids if known] == [2, 3, 4, 6, 7, 8, 9, 10] and len(ids) == 8
    marks = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.mark_copies(odd).collect()}
    assert {(5, 6, 4, False), (6, 6, 4, True), (None, 6, 4, False), (1, 2, 3, False), (None, 2, 3, False), (4, 4, 1, True)} <= marks


def test_near_copies(odd):
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in bayes_minhash.near_documents(odd).collect()}
    assert {(1, 0, 1, True), (4, 1, 4, True), (5, 3, 5, True), (6, 3, 5, False), (8, 978, 7, False), (None, 3, None, True), (9, 3, 9, True)} <= found


def test_large_band_is_not_cut(spark):
    """Two hundred texts around one core: links beyond the pivots' are found, against brute force."""
    draw = np.random.default_rng(5)
    core = [f"c{i}" for i in range(120)]
    texts = []
    for i in range(200):
        words = list(core)
        for p in draw.choice(120, draw.integers(1, 9), replace=False):
            words[p] = f"x{i}_{p}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(116)} for t in texts]
    low = list(range(200))
    for _ in range(200):
        new = [min(low[j] for j in range(200) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])) for i in range(200)]
        if new == low:
            break
        low = new
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in bayes_minhash.near_documents(frame).collect()} == dict(enumerate(low))


def test_components_of_a_chain(spark):
    links = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in components(links).collect()} == {0}


def test_a_star_with_repeated_links_and_loops_is_one_component(spark):
    links = spark.range(1, 500).selectExpr("id + 1000 as a", "cast(7 as long) as b")
    links = links.union(links.select("b", "a")).union(spark.range(3).selectExpr("id", "id")).union(spark.sql("select 3000L, 2000L"))
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {7: 7, **{1000 + i: 7 for i in range(1, 500)}, 2000: 2000, 3000: 2000}


def test_pfair_deviates_by_less_than_a_block():
    weights = {"a": 7, "b": 2, "c": 1, "d": 13}
    slots = mixing.pfair_period(weights)
    assert sorted(x for s in slots.values() for x in s) == list(range(23))
    for t in range(1, 24):
        assert all(abs(sum(x < t for x in slots[s]) - w * t / 23) < 1 for s, w in weights.items())
    rows = mixing.phases(weights, {"a": 5, "b": 40, "c": 0, "d": 1})
    given = {}
    for r in rows:
        given.setdefault(r["s"], []).append((r["first_block"], r["first_slot"]))
    assert set(given) == {"a", "b", "d"}


def test_mix_keeps_every_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.mix_sources(docs, {"src0": 3, "src1": 1}, 2, 4)
    assert mixed.count() == docs.count() == mixed.select("mix_slot", "mix_place").distinct().count()
    assert mixed.agg(F.max("mix_slot")).first()[0] + 1 == mixed.select("mix_slot").distinct().count()


def test_folding_and_exceptions():
    assert toxicity.fold("Y0u 1D10T, ｓｔｕｐｉｄ іdiоt 2024") == ["you", "idiot", "stupid", "idiot", "2024"]
    lexicon = toxicity.Lexicon({"trash": 3.0, "idiot": 4.0}, {"lowei": 2.0})
    weigh = lambda t: lexicon.weigh(toxicity.fold(t), lexicon.matcher())
    assert weigh("the trash can")[1] == 0 and weigh("trash trash")[1] == 2 and weigh("loweixyz idiot")[1] == 2 and weigh("idiots")[1] == 0
    assert 0 <= lexicon.score(0.0) < lexicon.score(1.0) <= 1


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id")
    clean = found.where("toxic = 0")
    assert clean.where("predicted = 1").count() <= 0.03 * clean.count()
    assert found.where("toxic = 1 and predicted = 1").count() >= 0.5 * found.where("toxic = 1").count()


def test_archives(spark, tmp_path):
    payload = "<p>é</p>"
    pages = [(3, "u\r\nX: y%", payload, "x"), (2, None, payload, "x"), (2, None, payload, "x"), (None, "n", payload, "x"), (5, "e", None, "x"), (6, "f", "", "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, payload string")
    found = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.url or "") for r in warc.archive_round_trip(frame).collect())
    full, empty = warc.base32_sha1(payload.encode()), warc.base32_sha1(b"")
    assert found == [(0, 9, full, "response", None, "n"), (2, 9, full, "response", None, ""), (2, 9, full, "response", None, ""),
                     (3, 9, full, "revisit", 2, "u\r\nX: y%"), (5, 0, empty, "response", None, "e"), (6, 0, empty, "revisit", 5, "f")]
    assert warc.archive_round_trip(frame.limit(0)).count() == 0
    records = [warc.record(i, "u", bytes([i]) * i * 70_000, None, warc.base32_sha1(bytes([i]) * i * 70_000)) for i in range(9)]
    whole, out = io.BytesIO(gzip.compress(b"".join(records[:5])) + gzip.compress(b"\r\n".join(records[5:]))), io.BytesIO()
    places = warc.normalise(whole, out)
    assert [gzip.decompress(out.getvalue()[o : o + n]) for o, n, _ in places] == records
    with pytest.raises(EOFError):
        warc.normalise(io.BytesIO(gzip.compress(b"".join(records))[:-2000]), io.BytesIO())


def test_patience():
    a, b = [1, 2, 3, 9, 4, 5], [7, 1, 2, 3, 8, 4, 5]
    assert linealign.patience(a, b) == [(0, 1), (1, 2), (2, 3), (4, 5), (5, 6)]
    assert linealign.common_blocks(a, b, [10] * 7, 25) == [(1, 4)]


def test_aligned_blocks_are_deleted_from_the_later(spark):
    shared = "\n".join(f"this is line {i} of a passage that is shared" for i in range(4))
    frame = spark.createDataFrame([(1, "own one\n" + shared), (2, "own two\n" + shared + "\ntail"), (3, shared), (4, "short"), (5, None)], "doc_id long, text string")
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in linealign.drop_aligned_blocks(frame).collect()}
    assert found == {1: ("own one\n" + shared, 5, 0), 2: ("own two\ntail", 6, 4), 3: ("", 4, 4), 4: ("short", 1, 0), 5: (None, 0, 0)}


def removed(spark, *texts):
    frame = spark.createDataFrame(list(enumerate("\n".join(t) for t in texts)), "doc_id long, text string")
    return {r.doc_id: r.text.split("\n") for r in linealign.drop_aligned_blocks(frame).collect()}


def test_passage_whose_lines_first_occur_singly(spark):
    p, q = "p" * 60, "q" * 60
    short = [f"short line {i}" for i in range(12)]
    docs = [[p, "a"], [q, "b"], ["c", p, q], [p, q, "d"], [*short, "e"], ["f", *short]]
    found = removed(spark, *docs)
    assert [found[i] for i in range(6)] == [*docs[:3], ["d"], docs[4], ["f"]]


def test_passage_twice_on_a_side_or_in_another_order(spark):
    p, q = [f"passage p, line {i} of a few" * 2 for i in range(4)], [f"passage q, line {i} of a few" * 2 for i in range(4)]
    docs = [[*p, "x", *p], ["a", *p, "b"], ["c", *p, "d", *p, "e"], [*p, "f", *q], [*q, "g"], ["h", *q, "i", *p, "j"]]
    found = removed(spark, *docs)
    assert [found[i] for i in range(6)] == [docs[0], ["a", "b"], ["c", "d", "e"], ["f", *q], ["g"], ["h", "i", "j"]]


def test_blocks_against_brute_force():
    draw = np.random.default_rng(4)
    size = [0, 3, 5, 9, 4]
    for _ in range(400):
        a, b = ([int(x) for x in draw.integers(1, 5, draw.integers(0, 14))] for _ in range(2))
        expected = set()
        for i in range(len(b)):
            for j in range(i + 1, len(b) + 1):
                if sum(size[x] for x in b[i:j]) >= 12 and any(a[k : k + j - i] == b[i:j] for k in range(len(a))):
                    expected |= set(range(i, j))
        assert {k for p, q in linealign.common_blocks(a, b, [size[x] for x in b], 12) for k in range(p, q)} == expected


def test_runs_against_brute_force():
    draw = np.random.default_rng(3)
    docs = [draw.integers(0, 4, draw.integers(0, 30)) for _ in range(60)]
    size = np.array([0, 3, 5, 9])
    first, last, hashes = linealign.runs(np.concatenate(docs), size[np.concatenate(docs)], np.cumsum([len(d) for d in docs]), 10)
    flat, expected, start = np.concatenate(docs), set(), 0
    for d in docs:
        n = size[d]
        for i in range(len(d)):
            down = [j for j in range(i, len(d)) if n[i : j + 1].sum() >= 10][:1] if n[i] else []
            up = [j for j in range(i, -1, -1) if n[j : i + 1].sum() >= 10][:1] if n[i] else []
            expected |= {(start + i, start + j) for j in down} | {(start + j, start + i) for j in up}
        start += len(d)
    assert sorted(zip(first.tolist(), last.tolist())) == sorted(expected)
    lines = [tuple(flat[i : j + 1]) for i, j in zip(first, last)]
    assert len(set(lines)) == len(set(hashes.tolist())) == len(set(zip(lines, hashes.tolist())))


@pytest.mark.parametrize("length, per_sequence", [(600, 1), (400, 2)])
def test_packing_ends_when_no_pieces_fit_each_other(spark, monkeypatch, length, per_sequence):
    kept, written = packing.kept_table, []

    def counted(df, name):
        written.append(name)
        assert len(written) < 20, "the same rows level after level"
        return kept(df, name)

    monkeypatch.setattr(packing, "kept_table", counted)
    pieces = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(length).cast("long").alias("length"))
    rows = packing.pack(pieces, 1024, rows_per_group=40).collect()
    assert sorted(r.doc_id for r in rows) == list(range(300))
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r.offset)
    assert all(sorted(o) == [length * k for k in range(len(o))] and len(o) <= per_sequence for o in by_sequence.values())
    assert len(by_sequence) <= 1.1 * 300 / per_sequence + 1


def test_packed_sequences_follow_the_mix(spark):
    draw = np.random.default_rng(5)
    places = draw.permutation(1200)
    rows = [(i, 0, int(n), int(p)) for i, (n, p) in enumerate(zip(draw.integers(20, 600, 1200), places))]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long, place long")
    sequences = {}
    for r in packing.pack(pieces, 1024, rows_per_group=100, ordered=True).collect():
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.place))
    assert sorted(p for s in sequences.values() for _, _, p in s) == list(range(1200))
    for number, s in sequences.items():
        s.sort()
        assert [o for o, _, _ in s] == [0, *np.cumsum([n for _, n, _ in s])[:-1]] and sum(n for _, n, _ in s) <= 1024
        assert [p for _, _, p in s] == sorted(p for _, _, p in s) and number >> packing.PIECE_BITS == s[0][2]
    assert np.median([s[-1][2] - s[0][2] for s in sequences.values()]) < 150


def test_packing_is_gapless_and_close_to_the_bound(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = packing.best_fit_pack(docs, TOKENIZER, rows_per_group=40).collect()
    tokenizer, texts, sequences = Tokenizer.from_file(TOKENIZER), {r.doc_id: r.text for r in docs.collect()}, {}
    for r in rows:
        ids = np.array([*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 2], dtype="<u4")[r.start : r.start + r.length]
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(sequences) <= 1.1 * sum(r.length for r in rows) / 1024 + 1


def test_encoder_agrees_with_the_library():
    tokenizer, texts = Tokenizer.from_file(TOKENIZER), [t or "" for _, t in ODD] + ["a\x85b c", "١٢ Ⅷ² x̂", "_a 1_2 ½x ²  it's", " a \n b "]
    for text, ids in zip(texts, Encoder(TOKENIZER, remembered=3, cuts_at_once=50)(texts)):
        assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text


def test_encoder_hands_cuts_to_the_merges_alone():
    library, letters = Tokenizer.from_file(TOKENIZER), "".join(map(chr, [*range(0x250), 0x20AC, 0x1F600, 0xFFFF]))
    texts = [letters, letters[::-1], " ".join(letters), "\n".join(letters), " \xad\xff\x00 ÿÿ", ""]
    encode = Encoder(TOKENIZER)
    encode._tokenizer = SimpleNamespace(model=encode._tokenizer.model)  # no pass through the whole of the library for each cut
    for text, ids in zip(texts, encode(texts)):
        assert ids == np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text


def test_token_file_reads_single_documents_and_checks_frames():
    out, documents = io.BytesIO(), [np.arange(n, dtype="<u4").tobytes() for n in (3, 0, 70_000, 5)]
    writer = token_files.TokenFileWriter(out, frame_bytes=64)
    for i, ids in enumerate(documents):
        writer.add(None if i == 1 else i, ids)
    writer.close()
    reader = token_files.TokenFileReader(pa.BufferReader(out.getvalue()))
    assert [reader.ids(k) for k in (2, 0, 3, 1)] == [documents[k] for k in (2, 0, 3, 1)]
    damaged = bytearray(out.getvalue())
    damaged[20] ^= 1
    with pytest.raises(Exception):  # noqa: B017  the decompressor's or the checksum's error
        token_files.TokenFileReader(pa.BufferReader(bytes(damaged))).ids(0)


def test_model_beats_the_base_and_sums_to_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = pitman_yor.score_texts(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]
    ns = np.array([1, 5, 4000])
    tables = pitman_yor.seat(ns, np.array([1.0, 1.0, 1.0]), 0.5, np.random.default_rng(1))
    assert tables[0] == 1 and (tables >= 1).all() and (tables <= ns).all()


@pytest.mark.parametrize("by_table", [1024, 8])
def test_seating_is_that_of_one_customer_after_the_other(monkeypatch, by_table):
    monkeypatch.setattr(pitman_yor, "BY_TABLE", by_table)
    for n, new, discount in ((10, 0.7, 0.5), (200, 30.0, 0.5), (400, 3.0, 0.9)):
        share = np.eye(n + 1)[1]  # chance of t tables
        t = np.arange(n + 1)
        for m in range(1, n):
            opens = share * new / (new + np.maximum(m - discount * t, 0))
            share = share - opens + np.roll(opens, 1)
        mean = share @ t
        deviation = np.sqrt(share @ (t - mean) ** 2)
        drawn = pitman_yor.seat(np.full(4000, n), np.full(4000, new), discount, np.random.default_rng(3))
        assert abs(drawn.mean() - mean) < 4 * deviation / np.sqrt(4000) and abs(drawn.std() / deviation - 1) < 0.06, (n, drawn.mean(), mean)


def test_probes_carry_sketches_that_lose_no_link(spark, monkeypatch):
    draw = np.random.default_rng(5)
    x = np.concatenate([c + 0.3 * draw.standard_normal((20, 24)) for c in draw.standard_normal((20, 24))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    most, cosine = lattice.most_cosine(lattice.sketches(x), lattice.sketches(x)), x @ x.T
    assert (most >= cosine).all() and (most <= cosine + 0.04).all()
    seen = []
    monkeypatch.setattr(lattice, "_in_blocks", lambda *a, of=lattice._in_blocks: seen.append(of(*a)) or seen[-1])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in lattice.near_vectors(rows, block_rows=7).collect()}
    wanted = (cosine >= 0.9).sum(axis=1) - 1
    assert all(found[i] <= n for i, n in enumerate(wanted)) and sum(found.values()) >= 0.9 * wanted.sum() > 0
    assert len(seen) == 3 and [any("unit" in c for c in s.columns) for s in seen] == [True, False, False]


def test_vectors_against_brute_force(spark):
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((30, 64))
    x = np.concatenate([c + 0.25 * draw.standard_normal((12, 64)) for c in centres])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, x[0].tolist()), (901, None), (902, [0.0] * 64), (903, [float("nan")] * 64), (904, [1.0]), (None, x[1].tolist())]
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = np.pad(unit @ unit.T >= 0.9, (0, 1))
    near[360, :360] = near[:360, 360] = near[0, :360]
    near[360, 360] = True
    found = {r.vec_id: r for r in lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    wanted = near.sum(axis=1) - 1
    got = np.array([found[i].n_links for i in [*range(360), 900]])
    assert len(found) == 366 and (got <= wanted).all() and got.sum() >= 0.9 * wanted.sum()
    assert all(found[i].n_links == 0 for i in (901, 902, 903, 904, None)) and found[None].component_id is None
    assert re.fullmatch(r"\d+", str(found[900].component_id)) and found[900].component_id == found[0].component_id


def test_warc_payloads_are_shuffled_once(spark, capsys, monkeypatch):
    pages = [(5, "u", "same"), (3, "v", "same"), (3, "w", "other"), (None, "x", "same"), (9, None, None), (7, "y", None), (3, "z", "same")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    found = warc.with_revisits(frame)
    rows = sorted((r.page_id or 0, r.url or "", bytes(r.payload).decode(), r.refers_to) for r in found.collect())
    assert rows == [
        (0, "x", "same", None), (3, "v", "same", None), (3, "w", "other", None), (3, "z", "same", None), (5, "u", "same", 3),
        (7, "y", "", None), (9, "", "", 7),
    ]
    written, write = [], warc.write_archives
    monkeypatch.setattr(warc, "write_archives", lambda given, folder: written.append(given) or write(given, folder))
    assert warc.archive_round_trip(frame).count() == len(pages)
    capsys.readouterr()
    written[0].explain(mode="formatted")
    steps = capsys.readouterr().out.split("\n\n")
    assert sum(") Exchange" in s and "payload" in s.split("Arguments")[0] and "html" not in s for s in steps) == 1
