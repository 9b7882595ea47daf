import collections
import functools
import random
import zlib

import numpy as np
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermart.llm import packing

from . import edges


@functools.cache
def _tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aBcé'’.,! \n\t12ßŒ|$s't", max_size=80)
       | st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "a", "é", "　", "\n"])).map("".join))
@example("<|endoftext|>")
@example("plain text <|endoftext|> goes on<|startoftext|>here")
def test_ids_equal_the_tokenizer(text):
    own = packing.ChunkTokenizer.get(packing.VOCABULARY)
    got = np.frombuffer(own.ids([text, "x " + text])[0], "<u4").tolist()
    assert got == _tokenizer().encode(text, add_special_tokens=False).ids


def test_plan_places_every_piece_once():
    r = random.Random(1)
    for top in (8, 64, 4096):
        h = collections.Counter(min(top, int(r.paretovariate(0.7))) for _ in range(5000))
        table, sequences = packing.plan(h, top)
        bins = collections.defaultdict(list)
        for i, (n, first, shift, offset) in enumerate(table.tolist()):
            stop = table[i + 1][1] if i + 1 < len(table) and table[i + 1][0] == n else h[n]
            for k in range(first, stop):
                bins[k + shift].append((offset, n))
        assert len(bins) == sequences
        for fill in bins.values():
            at = 0
            for offset, n in sorted(fill):
                assert offset == at
                at += n
            assert at <= top
        assert collections.Counter(n for f in bins.values() for _, n in f) == h
        assert sequences <= -(-sum(k * v for k, v in h.items()) // top) * 1.01 + 1


def test_two_replace_the_smallest():
    # greedy takes 60 + 30; 25 and 15 fill the gap of 40 that 30 leaves open
    table, sequences = packing.plan({60: 1, 30: 1, 25: 1, 15: 1}, 100)
    first = sorted((o, n) for n, _, shift, o in table.tolist() if shift == 0)
    assert sequences == 2 and [n for _, n in first] == [60, 25, 15]


def test_round_trip(spark):
    docs = edges.documents(spark)
    pieces = packing.pieces_of(docs, keep_ids=True).collect()
    tok = _tokenizer()
    want = collections.Counter()
    for d, t, *_ in edges.rows():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        for k in range(0, len(ids), packing.SEQUENCE):
            part = ids[k:k + packing.SEQUENCE]
            want[d, k // packing.SEQUENCE, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert collections.Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32, tuple(p.ids)) for p in pieces) == want
    placed = packing.pack(packing.pieces_of(docs)).collect()
    assert len(placed) == sum(want.values())
    fill = collections.defaultdict(list)
    for p in placed:
        fill[p.sequence_id].append((p.offset, p.length))
    for f in fill.values():
        at = 0
        for offset, n in sorted(f):
            assert offset == at
            at += n
        assert at <= packing.SEQUENCE


def test_columns_with_the_names_of_its_own(spark):
    pieces = packing.pieces_of(edges.documents(spark))
    plain = {(p.doc_id, p.piece, p.ids_crc32): p.length for p in packing.pack(pieces).collect()}
    for c in ("__uid", "__bucket", "__before", "__place", "__at", "a.b"):
        pieces = pieces.withColumn(c, F.lit(7))
    got = packing.pack(pieces)
    assert got.columns == [*pieces.columns, "sequence_id", "offset"]
    rows = got.collect()
    assert {(p.doc_id, p.piece, p.ids_crc32): p.length for p in rows} == plain and {p["__at"] for p in rows} == {7}


def test_empty_table(spark):
    assert packing.pack(packing.pieces_of(edges.empty(spark))).count() == 0


def test_word_cache_is_small():
    """A worker keeps its caches between stages: words in arrays, other chunks within CACHE_BYTES."""
    t = packing.ChunkTokenizer(packing.VOCABULARY)
    texts = [edges.words(s, 3_000) for s in range(20)]
    got = [t.ids([x])[0] for x in texts]
    assert got == t.ids(texts) and [list(np.frombuffer(b, "<u4")) for b in got[:3]] == [
        t.tokenizer.encode(x, add_special_tokens=False).ids for x in texts[:3]]
    assert len(t.known) > 30_000 and (t.known[1:] > t.known[:-1]).all()
    assert t.known.nbytes + t.at.nbytes + t.size.nbytes <= 20 * len(t.known)


def test_chunk_cache_is_bounded_by_bytes(monkeypatch):
    t = packing.ChunkTokenizer(packing.VOCABULARY)
    texts = ["数据 处理 " + chr(0x4E00 + i) * 50 for i in range(200)]
    want = [t.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    monkeypatch.setattr(packing, "CACHE_BYTES", 4_000)
    for x, ids in zip(texts, want):
        assert list(np.frombuffer(t.ids([x])[0], "<u4")) == ids
        assert t.chunk_bytes <= 5_000 and len(t.chunks) < 25
