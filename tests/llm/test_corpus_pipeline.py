"""The corpus pipeline stage by stage, each beside brute force on the stage's own input."""

import re
from collections import Counter
from itertools import combinations

import corpus_pipeline
import duckdb
import pytest
from tokenizers import Tokenizer

from tributary.llm.packing import PIECE_BITS
from tributary.llm.queries import MIX_BLOCK, OP1_SQL, TOKENIZER
from tributary.llm.toxicity import score_toxicity

SF = "/root/testdata/sf0.001"


def test_packing_follows_the_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = corpus_pipeline.kept_table(corpus_pipeline.mix(spark, docs, SF), "mixed")
    place = {r.doc_id: r.mix_slot * MIX_BLOCK + r.mix_place for r in mixed.collect()}
    sequences = {}
    for r in corpus_pipeline.pack(spark, mixed, SF).collect():
        sequences.setdefault(r.sequence_id, []).append((r.offset, (place[r.doc_id] << PIECE_BITS) + r.piece))
    assert {n >> PIECE_BITS for s in sequences.values() for _, n in s} == set(place.values())
    for number, s in sequences.items():
        numbers = [n for _, n in sorted(s)]
        assert numbers == sorted(numbers) and numbers[0] == number


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def steps(spark):
    """The rows after each stage, from the whole table on, as the pipeline hands them on."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = corpus_pipeline.kept_table(stage(spark, docs, SF), "stage")
    return found


def texts(df):
    return {r.doc_id: (r.text or "").translate(LOWER) for r in df.select("doc_id", "text").collect()}


def test_every_stage_but_the_last_returns_whole_documents(steps):
    whole = {r.doc_id: r for r in steps["documents"].collect()}
    for name, _ in corpus_pipeline.STAGES[:-1]:
        kept = steps[name].select(*steps["documents"].columns).collect()
        assert all(r == whole[r.doc_id] for r in kept) and len({r.doc_id for r in kept}) == len(kept)


def test_toxicity_drops_what_scores_high(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = score_toxicity(steps["documents"], labels).where("predicted = 0")
    assert set(texts(steps["toxicity"])) == {r.doc_id for r in scored.collect()}


def test_exact_dedup_keeps_the_largest_id(steps):
    keep = {}
    for i, t in texts(steps["toxicity"]).items():
        keep[t] = max(i, keep.get(t, i))
    assert set(texts(steps["exact dedup"])) == set(keep.values())


def test_near_dedup_keeps_the_smallest_id_of_each_component(steps):
    sets = {}
    for i, t in texts(steps["exact dedup"]).items():
        words = re.findall("[^\\x20\\x09-\\x0D]+", t)
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert set(texts(steps["near dedup"])) == {i for i in root if find(i) == i}


def test_the_mix_is_that_of_its_sql(steps):
    connection = duckdb.connect()
    documents = steps["near dedup"].select("doc_id", "source").toPandas()  # noqa: F841
    connection.register("documents", documents)
    wanted = {(r[0], r[3], r[4]) for r in connection.sql(OP1_SQL).fetchall()}
    assert {(r.doc_id, r.mix_slot, r.mix_place) for r in steps["source mix"].collect()} == wanted


def test_packing_holds_every_token_once(steps):
    tokenizer, wanted = Tokenizer.from_file(TOKENIZER), Counter()
    for r in steps["source mix"].collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
        wanted[r.doc_id] += n
    got, spans = Counter(), {}
    for r in steps["packing"].collect():
        got[r.doc_id] += r.length
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == wanted
    for s in spans.values():
        ends = 0
        for offset, length in sorted(s):
            assert offset == ends
            ends += length
        assert ends <= 1024


def test_run_returns_the_last_stage(spark, steps):
    places = lambda df: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert places(corpus_pipeline.run(spark, SF)) == places(steps["packing"])
