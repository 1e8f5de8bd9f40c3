"""Spelling variants, URL templates and the prefix trie beside brute force: odd rows, hot groups, long chains, empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F

from tributary.llm import trie, urltree, variants
from tributary.llm.queries import OP13_SQL, URL_DEPTH, URL_RULES, _url_sql, op11
from tributary.session import kept_table

SF = "/root/testdata/sf0.001"


def near(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def all_near(words):
    """Near pairs by deletion neighbourhoods, an unlike method."""
    shared, found = defaultdict(set), defaultdict(set)
    for w in words:
        for v in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            shared[v].add(w)
    for group in shared.values():
        for a in group:
            found[a].update(b for b in group if near(a, b))
    return found


def brute_variants(docs, least_chars=6, least_count=5):
    counts = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}
    around = all_near(words)
    form = {w: min(v, key=lambda x: (-words[x], x)) for w, v in around.items() if v}
    form = {w: f for w, f in form.items() if words[f] >= 5 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, root(w), form.get(w), n, len(around[w]), words.get(form.get(w))) for w, n in words.items()}


def result(df):
    return {tuple(r) for r in df.select("word", "root", "form", "n", "n_near", "form_n").collect()}


def test_variants_of_the_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op11(spark, SF)) == brute_variants(docs)


def test_variants_of_odd_rows(spark):
    long_word = "ab" * 5000
    docs = [(1, None), (2, ""), (None, "Straße straße strasse " * 60), (3, "ÀÉÎõü ÀÉÎõüx àÉÎõüx " * 40), (3, "ÀÉÎõü ÀÉÎõüx àÉÎõüx " * 40),
            (4, f"{long_word} " * 6), (5, f"{long_word}x " * 40), (6, "alphabet " * 500 + "alphabex " * 90 + "alphbbex " * 10 + "alphabets " * 500), (7, "a×b÷cd 日本語 x\ty")]
    frame = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], "doc_id long, text string, word string, n int, near string")
    got = result(variants.group_variants(variants.vocabulary(frame, slip_every=199)))
    assert got == brute_variants(docs) and any(r[0] == "alphbbex" and r[1] != r[2] for r in got)
    none = variants.group_variants(variants.vocabulary(frame.limit(0)))
    assert none.count() == 0 and none.columns == ["word", "root", "form", "n", "n_near", "form_n"]


@pytest.mark.parametrize("most", [4000, 20, 1])
def test_a_hot_half_is_refined_without_losing_pairs(spark, most):
    """All words share their first half, or their last; windows are halved down to one code point."""
    draw = random.Random(most)
    words = {"abcd" + "".join(draw.choice("xyzé") for _ in range(draw.randint(2, 5))) for _ in range(400)}
    words |= {"".join(draw.choice("xyzé") for _ in range(draw.randint(2, 5))) + "dcba" for _ in range(400)}
    frame = kept_table(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), "words")
    got = {(r.word, r.near) for r in variants.near_words(frame, rows_per_shard=500, most_per_key=most).collect()}
    assert got == {(w, v) for w, vs in all_near(words).items() for v in vs}


def url_connection(rows):
    connection = duckdb.connect()
    connection.sql("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    connection.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    return connection


def test_urls_of_odd_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM", "http://example.com?a=/en/x", "a://b://c/d", "http://É.com/É/ß", "x://net/es/1",
            "http://notnet/es/", "http://a.net/es", "http://a.net/es/", "http://a.b.net/fr/1#x", "http://example.com/en/" + "s/" * 3000 + "9.html",
            "http://www.example.com/en/1", "http://x.www.example.com/en/1", "http://u@example.com:80/en/1", "http://org/\n/\t1", "http://org/" + "7" * 20000]
    rows = [(i if i % 7 else None, u) for i, u in enumerate(urls * 2)]
    frame = spark.createDataFrame([(i, u, "h", "p", "r", 1, "s") for i, u in rows], "page_id long, url string, host string, path string, rule string, n int, prefix string")
    got = urltree.judge_urls(frame, URL_RULES, URL_DEPTH)
    assert differences(got, url_connection(rows).sql(_url_sql())) == ""
    seen = {(r.host, r.path[:5], r.rule, r.verdict) for r in got.collect()}
    assert {("", "", None, "allow"), ("www.example.com", "", None, "allow"), ("b:", "//c/d", None, "allow"), ("a.net", "/es", None, "allow"), ("a.net", "/es/", "net/es/", "block"),
            ("x.www.example.com", "/en/1", "www.example.com/en/", "allow"), ("notnet", "/es/", None, "allow"), ("u@example.com:80", "/en/1", None, "allow")} <= seen
    assert urltree.judge_urls(frame.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in urltree.judge_urls(frame, []).collect()} == {"allow"}


def test_templates_reach_pages_without_a_rule(spark):
    """Numbers become one template, so unlabelled ones follow the labelled; a clean branch beside them stays."""
    paths = [f"/promo/{i}" for i in range(1, 300)] + [f"/news/{i}" for i in range(1, 300)] + [f"/{a}/{i}.html" for a in ("red", "blue") for i in range(200)]
    frame = spark.createDataFrame([(i, f"http://shop.test{p}") for i, p in enumerate(paths)], "page_id long, url string")
    rules = [("block", "shop.test", f"/promo/{d}") for d in range(1, 9)] + [("allow", "shop.test", f"/news/{d}") for d in range(1, 9)]
    got = {r.path: (r.rule, r.verdict, r.template) for r in urltree.judge_urls(frame, rules).collect()}
    assert got["/promo/95"][:2] == (None, "block") and got["/news/95"][:2] == (None, "allow")
    assert got["/promo/95"][2] == got["/promo/15"][2] == "/promo/{0}"
    assert got["/red/5.html"][1:] == got["/blue/7.html"][1:] == ("allow", got["/red/5.html"][2]) and got["/red/5.html"][2].startswith("/*?")
    plan = urltree.judge_urls(frame, rules)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"))


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    turns = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - int(c - 5 * int(c / 5)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for k in members:
        if k:
            kids[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    digest = lambda k, m: hashlib.sha256(",".join(str(c) for c in m if len(rebuilt[c]) == len(k)).encode()).hexdigest()
    return Counter((m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k], digest(k, m)) for k, m in members.items())


def build(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x", 5) for r in rows], "conv_id long, turn long, role string, text string, pos int, digest string, depth int")
    turns = kept_table(trie.ordered_turns(frame), "turns")
    base = F.col("conv_id") - F.col("conv_id") % 5
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return trie.prefix_trie(*trie.shared_heads(turns, base, head, 8))


ORDER = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("slice_size", [trie.SLICE, 3])
def test_trie_of_odd_rows(spark, monkeypatch, slice_size):
    """Ties, repeated rows, nulls, absent bases, turnless and very long conversations, a common one, negative ids."""
    monkeypatch.setattr(trie, "SLICE", slice_size)
    monkeypatch.setattr(trie, "IDS_PER_BLOCK", 4)
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, 0, "user", "é" * 9), (1, 0, "user", "b"), (1, 0, "user", "b"), (2, 1, "", ""), (-3, 1, "user", "x"), (-7, 2, "a", "y")]
    rows += [(c, t, "user", f"same {t}") for c in range(20, 80) for t in range(4)]
    rows += [(c, t, "user", f"long {t}" + "z" * (t % 50 * 100)) for c in (100, 101, 102) for t in range(150 if c != 101 else 90)]
    rows += [(c, t, "user", f"{c % 3} {t if t < 2 else c}") for c in range(200, 240) for t in range(c % 7 + 1)]
    got = Counter(tuple(r) for r in build(spark, rows).select(*ORDER).collect())
    assert got == brute_trie(rows)


def test_trie_of_no_rows(spark):
    none = build(spark, [(None, 1, "user", "x")])
    assert none.count() == 0 and none.columns == ORDER


def test_totals_of_chains_and_bushes(spark):
    """A chain of 700 nodes, a caterpillar, a random tree: sums over subtrees, in rounds that grow with the logarithm."""
    draw = random.Random(1)
    parent = {i: i - 1 for i in range(1, 700)}
    parent |= {i: (700 + (i - 700) // 2 * 2 - 2 if i > 701 else 5) for i in range(700, 900)}
    parent |= {i: draw.randrange(i) for i in range(900, 1500)}
    kids = defaultdict(list)
    for c, p in parent.items():
        kids[p].append(c)
    key = {i: (draw.getrandbits(62), draw.getrandbits(62)) for i in range(1500)}
    rows = []
    for i in range(1500):
        x = [0, 0]
        for k in kids[i]:
            x = [x[0] ^ key[k][0], x[1] ^ key[k][1]]
        rows.append((*key[i], *(key[parent[i]] if i else (None, None)), len(kids[i]), *x, i))
    nodes = spark.createDataFrame(rows, "p1 long, p2 long, q1 long, q2 long, n_kids long, k1 long, k2 long, w long")
    want = [0] * 1500
    for i in range(1500):
        at = i
        while at is not None:
            want[at] += i
            at = parent.get(at)
    got = {(r.p1, r.p2): r.w for r in trie.subtree_totals(kept_table(nodes, "tree"), ["w"]).collect()}
    assert got == {key[i]: want[i] for i in range(1500)}


def test_trie_sql_reads_the_same_hash(spark):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    rows = connection.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    names = (columns := connection.sql(OP13_SQL)).columns
    assert Counter(tuple(r[names.index(c)] for c in ORDER) for r in columns.fetchall()) == brute_trie(rows)
