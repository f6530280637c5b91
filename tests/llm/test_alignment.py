"""Alignment against byte-by-byte overlaps, and token ids against the plain
calls of the tokenizer libraries."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.mark.parametrize("steps", [1, 2, 7, 64, 1024])
def test_merge_pieces(steps):
    from leadflow.llm.alignment import merge_pieces
    rng = np.random.default_rng(steps)
    for _ in range(60):
        n = int(rng.integers(1, 150))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, rng.integers(1, n + 1)), n)) for _ in range(2))
        link_a, link_b, group_a, group_b = merge_pieces(a, b, steps)
        sa, sb = np.append(0, a[:-1]), np.append(0, b[:-1])
        assert sorted(zip(link_a.tolist(), link_b.tolist())) == [
            (i, j) for i in range(len(a)) for j in range(len(b)) if max(sa[i], sb[j]) < min(a[i], b[j])]
        both = np.intersect1d(a, b)
        assert (np.searchsorted(both, a) == group_a).all() and (np.searchsorted(both, b) == group_b).all()


def byte_table():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {**{chr(b): b for b in keep}, **{chr(256 + k): b for k, b in enumerate(rest)}}


def plain_alignment(rows):
    """The contract's rows: tokens as byte ranges, pairs by their overlap."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    t, m, letters = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), byte_table()
    t.encode_special_tokens = True

    def a_tokens(text):
        return [(k, bytes(letters[c] for c in t.id_to_token(k))) for k in
                t.encode(text, add_special_tokens=False).ids]

    def b_tokens(text):
        out = []
        for k in m.encode(text):
            piece = m.id_to_piece(k)
            out.append((k, bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x")
                        else piece.replace("▁", " ").encode()))
        return out

    docs, count = [], Counter()
    for doc, text in rows:
        full = (" " + (text or "")).encode()
        a, b = (a_tokens(" " + text), b_tokens(text)) if text else ([], [])
        if b"".join(x for _, x in a) != full or b"".join(x for _, x in b) != full:
            a = b = []
        spans = []
        for tokens in (a, b):
            at, out = 0, []
            for k, x in tokens:
                out.append((k, at, at + len(x)))
                at += len(x)
            spans.append(out)
        of_byte = {i: j for j, (_, s, e) in enumerate(spans[1]) for i in range(s, e)}
        links = sorted({(i, of_byte[x]) for i, (_, s, e) in enumerate(spans[0]) for x in range(s, e)})
        pairs = [(a[i][0], b[j][0]) for i, j in links]
        count.update(pairs)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, i, j = [], 0, 0
        for end in ends:
            ga, gb = [], []
            while i < len(a) and spans[0][i][2] <= end:
                ga.append(str(a[i][0]))
                i += 1
            while j < len(b) and spans[1][j][2] <= end:
                gb.append(str(b[j][0]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        docs.append((doc, len(a), len(b), len(groups), pairs, ";".join(groups)))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return Counter((doc, na, nb, ng, len(pairs), sum(count[p] == most[p[1]] for p in pairs),
                    sum(count[p] for p in pairs), listing) for doc, na, nb, ng, pairs, listing in docs)


TEXTS = [None, "", " ", "  ", "one", "Hello world, hello World!", " lead and trail \n", "a\tb\r\nc;\r x{\r\n", "▁under▁",
         "emoji \U0001F600\U0001F600 nbsp\xa0é　wide Ünïcode \u0085", "<s> </s> <unk> <|endoftext|> <0x41>", "\x00 zero",
         "indent\n    four\n        eight   three", "x" * 300 + "  " * 40 + "y", "的是不 ﬁ ﷺ ́ é",
         "the of and to " * 500, "日本語のテキスト " * 30, "ab" * 2500]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5]), (None, "no id, hello"), (3, "another three")]


def result(df):
    return Counter(tuple(r) for r in df.collect())


def test_documents(spark):
    from leadflow.llm.alignment import align
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    want = plain_alignment(ROWS)
    hashed = Counter({(*k[:-1], k[-1] and hashlib.sha256(k[-1].encode()).hexdigest()): n for k, n in want.items()})
    assert result(align(docs, A, B, listings=True)) == want
    assert result(align(docs, A, B, block_tokens=300)) == hashed          # texts longer than a block
    clash = docs.withColumns({c: F.lit(1) for c in ("pair", "pairs", "block", "n", "links", "answers", "groups", "best")})
    assert result(align(clash, A, B)) == hashed
    assert result(align(docs.toDF("the id", "t"), A, B, "the id", "t")) == hashed
    assert align(docs.limit(0), A, B).count() == 0
    bare = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert result(align(bare, A, B)) == Counter([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


@pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables missing")
def test_query(spark):
    from leadflow.llm.queries import QUERIES
    out = QUERIES["op13_token_alignment"](spark, SMALL)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {t for c, t in out.dtypes[:-1]} == {"bigint"}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert result(out) == Counter({(*k[:-1], k[-1] and hashlib.sha256(k[-1].encode()).hexdigest()): n
                                   for k, n in plain_alignment(rows).items()})


# ---- token ids --------------------------------------------------------------

@pytest.mark.parametrize("file,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_ids_are_the_tokenizers_own(file, kind):
    """Also with special strings in a text, which the plain call takes as such."""
    from tokenizers import Tokenizer

    from leadflow.llm.tokens import encoder
    rnd = random.Random(3)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", " ", "  ", "\n", "\t", "the", "Word",
             "it's", "é", "Ü", "ß", "\xa0", " ", "　", "12", "x9", "!?", "...", "日本", "\U0001F600", "'", "́", "İ", "ſ"]
    many = ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(4000)] + [t or "" for t in TEXTS]
    for plain in (False, True):
        t = Tokenizer.from_file(P.path(file))
        t.encode_special_tokens = plain
        for text, got in zip(many, encoder(P.path(file), kind, plain).encode(many)):
            assert got.tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_what_a_worker_keeps_is_bounded():
    """Packing's encoder keeps nothing of the texts; the other one keeps words
    up to its bytes, then starts anew with the same ids."""
    import leadflow.llm.tokens as T
    many = [" ".join(f"w{k}x{j}" for j in range(50)) for k in range(200)]
    packing = T.ByteEncoder(P.path("byte_bpe_50k.json"))
    before = {k: len(v) for k, v in vars(packing).items() if hasattr(v, "__len__")}
    ids = list(packing.encode(many))
    assert {k: len(v) for k, v in vars(packing).items() if hasattr(v, "__len__")} == before and len(ids) == 200
    path = P.path("word_bpe_49k.json")
    small, large = T.PieceEncoder(path, piece_bytes=100_000), T.PieceEncoder(path)
    for a, b in zip(small.encode(many, at_once=4), large.encode(many)):
        assert small.held() < 200_000 and a.tolist() == b.tolist()
    assert large.held() > 1_000_000
