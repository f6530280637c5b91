"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing
column names: every operator against a brute-force version in plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def passage(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("w%d" % x for x in rng.integers(0, 400, n))


BASE = passage(1, 300)
ROWS = [
    (1, None, "en", "b", 0), (2, "", "en", None, 0), (3, " \t\n", "en", "a", 3), (4, "one", "en", "a", 3),
    (5, "ONE", "en", "a", 3), (6, "two words", "en", "b", 9), (7, BASE, "en", "b", 1), (8, BASE, "en", "b", 1),
    (8, BASE, "en", "b", 1), (9, BASE.replace(" w", "  w"), None, "c", 1), (10, BASE + " tail end", "en", "c", 1),
    (11, passage(2, 60) + " " + " ".join(BASE.split()[40:100]) + " " + passage(3, 60), "en", "c", 1),
    (12, "same line\n" * 40, "en", "c", 1), (13, "x " * 5000 + passage(4, 20000), "de", "c", 1),
    (14, "### !!! *** " * 60, "en", "é", 1), (None, "no id " + passage(5, 80), "en", "a", 1),
    (16, "emoji \U0001F600   nbsp é　wide Ünïcode " + passage(6, 70), "en", "a", 1),
    (17, "<|endoftext|> </turn> \\l <turn:user>", "en", "a", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(docs):
    """Extra columns named like the operators' own."""
    names = ["kept", "size", "target", "copies", "uid", "digest", "id", "n", "n_words", "_t", "_w", "block", "root",
             "component_id", "_kept_id", "_mix_copies", "held_out", "score", "base_failed", "keep_id"]
    return docs.withColumns({c: F.lit(1) for c in names})


def words(t):
    return WORD.findall(t or "")


def out(df):
    return Counter(tuple(r) for r in df.collect())


# ---- 7 ----------------------------------------------------------------------

def brute_exact(rows):
    groups = defaultdict(list)
    for k, r in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append((-len(r[1] or ""), r[0] is None, r[0] or 0, k, r[0]))
    want = Counter()
    for t, g in groups.items():
        g.sort()
        for m in g:
            want[m[4], g[0][4], len(g), m is g[0], hashlib.sha256(t.encode()).hexdigest()] += 1
    return want


def test_exact_dedup(docs, empty, clashing):
    from leadflow.llm.exact import exact_dedup, keep_first_copies
    assert out(exact_dedup(docs)) == brute_exact(ROWS)
    assert out(exact_dedup(clashing)) == brute_exact(ROWS)
    assert exact_dedup(empty).count() == 0
    kept = keep_first_copies(clashing)
    assert kept.columns == clashing.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in ROWS})
    assert keep_first_copies(empty).count() == 0


def test_perfect_hash_is_minimal_and_checks_bytes():
    from leadflow.llm.exact import PerfectHash
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    h = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(h.slots(keys)) == list(range(len(keys)))
    assert PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1, -1, -1]


# ---- 8 ----------------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
            free.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5}, {"a": 0, None: 7}, {"x": 3}, {"a": 0},
                                   {chr(97 + i): 7 ** (i % 5) for i in range(12)}])
def test_targets(spark, sizes):
    from leadflow.llm.mixing import targets
    got = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = brute_targets(sizes)
    assert {r.source: r.target for r in got} == pytest.approx(want)


def test_mixing(spark, docs, empty, clashing):
    from leadflow.llm.mixing import mix, mixed_documents
    a, b = out(mix(docs)), out(mix(clashing.repartition(7)))
    assert a == b and sum(a.values()) == len(ROWS)
    sizes, taken = Counter(), Counter()
    for r in mix(docs).collect():
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        sizes[r.source] += r["size"]
    assert sizes == Counter({s: sum(len(words(x[1])) for x in ROWS if x[3] == s) for s in {x[3] for x in ROWS}})
    assert mix(empty).count() == mixed_documents(empty).count() == 0
    mixed = mixed_documents(clashing)
    assert mixed.columns == clashing.columns
    want = Counter({(r.doc_id, r.source): 0 for r in mix(docs).collect()})
    for r in mix(docs).collect():
        want[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == +want
    many = spark.range(20000).selectExpr("id as doc_id", "repeat('w ', cast(id % 97 as int)) as text",
                                         "case when id % 3 = 0 then 'hot' else concat('s', id % 5) end as source")
    for r in mix(many).groupBy("source", "target").agg(F.sum("taken").alias("t")).collect():
        assert abs(r.t - r.target) <= 97


# ---- 10 ---------------------------------------------------------------------

def brute_quality(t):
    t = t or ""
    w = words(t)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep), failed)


def test_quality(docs, empty, clashing):
    from leadflow.llm.quality import RULES, RuleStats, cascade_order, judge, keep_good
    got = judge(clashing).collect()
    assert Counter((r.doc_id, *r[1:7]) for r in got) == Counter((r[0], *brute_quality(r[1])) for r in ROWS)
    kept = Counter(r.doc_id for r in got if r.kept)
    assert not any(r.kept and r.base_failed for r in got) and kept[7] == 1 and kept[14] == 0 and kept[12] == 0
    k = keep_good(clashing)
    assert k.columns == clashing.columns and Counter(r.doc_id for r in k.collect()) == kept
    assert judge(empty).count() == keep_good(empty).count() == 0
    stats = [RuleStats(r.name, 1.0 + i, 0.5 if i == 2 else 0.0) for i, r in enumerate(RULES)]
    assert cascade_order(RULES, stats)[0] is RULES[2]


def test_order_never_changes_the_verdict(docs):
    from leadflow.llm.quality import RULES, first_rejection, words as split
    t = F.coalesce("text", F.lit(""))
    d = docs.withColumn("w", split(F.col("text")))
    a, b = (first_rejection(r, t, F.col("w")).isNull() for r in (RULES, RULES[::-1]))
    assert all(r.a == r.b for r in d.select(a.alias("a"), b.alias("b")).collect())


# ---- 5, 6 -------------------------------------------------------------------

def encoded(file, end, plain=False):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path(file))
    t.encode_special_tokens = plain
    return P.path(file), [t.encode(r[1] or "", add_special_tokens=False).ids + [end] for r in ROWS]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(spark, docs, empty, clashing):
    from leadflow.llm.packing import pack, pieces
    path, ids = encoded("byte_bpe_50k.json", 0)
    for length, most in ((1024, 64), (16, 2)):
        got = pack(clashing, path, length=length, open_windows=most, min_cut=2).collect()
        total, sequences = Counter(), defaultdict(list)
        for r in got:
            assert 0 < r.length <= length and len(r.ids) == 4 * r.length
            total[r.doc_id, r.doc_tokens] += r.length
            sequences[r.sequence_id].append((r.offset, r.length))
        assert total == Counter({k: n * k[1] for k, n in Counter((r[0], len(i)) for r, i in zip(ROWS, ids)).items()})
        by_id = dict(zip((r[0] for r in ROWS), ids))
        for r in got:
            assert np.frombuffer(r.ids, "<u4").tolist() == by_id[r.doc_id][r.start:r.start + r.length]
        for s in sequences.values():
            at = 0
            for o, n in sorted(s):
                assert o == at
                at += n
            assert at <= length
    assert pieces(empty, path).count() == 0
    big = 2**60 + 1        # an id that a double cannot hold, beside a null id
    odd = spark.createDataFrame([(big, "a b c"), (None, "d")], "doc_id long, text string")
    assert {r.doc_id for r in pieces(odd, path).collect()} == {big, None}


def test_token_store(spark, docs, empty, clashing, tmpdir_path):
    from leadflow.llm.token_store import read_slice, read_store, token_output, write_store
    path, ids = encoded("word_bpe_49k.json", 2)
    got = token_output(clashing, path, segment_ids=2000).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (r[0], len(i), crc(i)) for r, i in zip(ROWS, ids))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted([x for x in order if x is not None]) + [None]
    assert token_output(empty, path).count() == 0
    folder = write_store(docs, f"{tmpdir_path}/store", path, segment_ids=500)
    for r, i in zip(ROWS, ids):
        if r[0] is not None:
            assert read_slice(spark, folder, r[0]).tolist() == i
    assert read_slice(spark, folder, 999) is None
    assert read_store(spark, folder).count() == len(ROWS)


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5, 5, 2**40], list(range(1000)),
                                    np.cumsum(np.random.default_rng(1).integers(0, 5000, 3000)).tolist()])
def test_elias_fano(values):
    from leadflow.llm.token_store import EliasFano
    e = EliasFano.from_bytes(EliasFano.encode(np.array(values, np.int64)).to_bytes())
    assert e.values().tolist() == values
    assert [e.select(i) for i in range(0, len(values), 7)] == values[::7]


# ---- 2 ----------------------------------------------------------------------

def brute_substring(rows, n):
    seen, want = set(), Counter()
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = words(text)
        gone = set()
        for i in range(len(w) - n + 1):
            k = tuple(w[i:i + n])
            if k in seen:
                gone.update(range(i, i + n))
            seen.add(k)
        want[doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return want


@pytest.mark.parametrize("window, base", [(20, 10), (20, 5), (4, 1)])
def test_substring(docs, empty, clashing, window, base):
    from leadflow.llm.substring import substring_dedup
    got = substring_dedup(clashing, window=window, base=base).collect()
    assert Counter(tuple(r[:4]) for r in got) == brute_substring([r[:2] for r in ROWS], window)
    assert all(r.n_removed == sum(z - a for a, z in r.removed) for r in got)
    assert substring_dedup(empty).count() == 0


def test_substring_blocks_meet(spark):
    """Passages shared across many small blocks and ranges."""
    import leadflow.llm.blocks as B
    from leadflow.llm import substring
    rng = np.random.default_rng(5)
    shared_ = [passage(100 + i, 60) for i in range(6)]
    rows = [(int(i), " ".join([passage(1000 + i, 30), shared_[rng.integers(6)], passage(2000 + i, 30)]))
            for i in rng.permutation(80)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keep = B.RANGE_KEYS
    whole = substring.word_blocks
    try:
        substring.word_blocks = lambda *a: whole(*a, block_words=300)
        substring.ranges_for = lambda n: 5
        got = Counter(tuple(r[:4]) for r in substring.substring_dedup(d).collect())
    finally:
        substring.word_blocks, substring.ranges_for, B.RANGE_KEYS = whole, B.ranges_for, keep
    assert got == brute_substring(rows, 20)


def test_levels():
    from leadflow.llm.substring import levels_up_to
    assert levels_up_to(20, 5) == [5, 10, 20]
    with pytest.raises(ValueError):
        levels_up_to(20, 8)


# ---- 1 ----------------------------------------------------------------------

def brute_join(rows, n, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = words((t or "").translate(low))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return Counter((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows))


def near_copies(n, words_, edits, seed=3):
    rng = np.random.default_rng(seed)
    base = passage(50, words_).split()
    rows = []
    for i in range(n):
        w = list(base)
        for p in rng.integers(0, words_, rng.integers(0, edits + 1)):
            w[p] = f"e{i}_{p}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80), (1, 50)])
def test_join(docs, empty, clashing, n, percent):
    from leadflow.llm.ngram_join import ngram_join
    assert out(ngram_join(clashing, shingle=n, percent=percent)) == brute_join([r[:2] for r in ROWS], n, percent)
    assert ngram_join(empty).count() == 0


@pytest.mark.parametrize("edits", [4, 14])
def test_join_large_group_in_chunks(spark, edits, monkeypatch):
    from leadflow.llm import ngram_join as J
    rows = near_copies(150, 200, edits)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = J.cluster_links
    monkeypatch.setattr(J, "cluster_links", lambda cand, percent: plain(cand, percent, chunk=20))
    monkeypatch.setattr(J, "PIVOTS", 2)
    assert out(J.ngram_join(d)) == brute_join(rows, 4, 85)


def test_one_of_each_stays(clashing, empty):
    from leadflow.llm.ngram_join import keep_one_of_each
    kept = keep_one_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 7 in ids and not ids & {8, 9, 10} and {1, 2, 3, None} <= ids
    assert keep_one_of_each(empty).count() == 0


def test_one_of_each_class_whatever_the_ids(spark):
    from leadflow.llm.ngram_join import keep_one_of_each
    texts = {c: passage(200 + i, 90) for i, c in enumerate("abcdef")}
    near = {c: t + " tail" for c, t in texts.items()}
    rows = [(None, texts["a"]), (None, near["a"]),          # near copies under a null id
            (5, texts["b"]), (5, near["b"]),                # and under a shared one
            (3, texts["c"]), (7, near["c"]), (7, texts["d"]),   # a loser whose id wins elsewhere
            (None, texts["e"]), (9, near["e"]),             # a null id loses to any other
            (8, texts["f"]), (8, texts["f"]), (8, texts["f"].upper()),
            (None, None), (None, None), (5, " "), (5, "")]
    got = keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    of = {t.lower(): c for d in (texts, near) for c, t in d.items()}
    assert sorted(of[r.text.lower()] for r in got if (r.text or "").strip()) == list("abcdef")
    assert {(of[r.text.lower()], r.doc_id) for r in got if (r.text or "").strip()} == {
        ("a", None), ("b", 5), ("c", 3), ("d", 7), ("e", 9), ("f", 8)}
    assert Counter((r.doc_id, r.text) for r in got if not (r.text or "").strip()) == Counter(
        [(None, None), (None, None), (5, " "), (5, "")])


def test_components(spark):
    from leadflow.llm.common import connected_components
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (200, 200), (302, 300), (301, 300)]
    got = {r.node: r.comp for r in connected_components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 300: 300, 301: 300, 302: 300}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
