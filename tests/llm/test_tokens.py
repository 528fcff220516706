"""Operators 4, 5, 9, 10 against the tokenizer libraries, and the Simple-8b round trip."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as vocab
import pytest
import sentencepiece
import tiktoken
from helpers import TEXTS, collected, no_documents, odd_documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from crawlweave.llm import bpe, packing, simple8b, token_count, token_files
from crawlweave.llm.hf_ids import IdEncoder
from crawlweave.session import scratch_dir

JSON, RANKS, PIECES = (vocab.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
TEXT = st.text(st.sampled_from("ab é#.'<|>endoftx\n \t\r ▁19"), max_size=60)


@pytest.fixture(scope="module")
def hf():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def tt():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def u32(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_piece_caches_match_the_libraries(texts):
    hf, sp = Tokenizer.from_file(JSON) if "hf" not in CACHE else CACHE["hf"], CACHE.get("sp")
    CACHE.setdefault("hf", hf)
    sp = CACHE.setdefault("sp", sp or sentencepiece.SentencePieceProcessor(model_file=PIECES))
    own = CACHE.setdefault("own", IdEncoder(JSON))
    assert own.encode(texts) == [u32(hf.encode(t, add_special_tokens=False).ids) for t in texts]
    cache = token_count.PieceCache(lambda k: token_count.count_keys(PIECES, k), alone=[token_count.SPACE_MARK])
    for t, keys in zip(texts, cache.learn(texts), strict=True):
        if keys is not None:
            assert sum(cache.known[k] for k in keys) == len(sp.encode(t))
    ranks = CACHE.setdefault("bpe", bpe.ByteBpe(RANKS, vocab.PATTERN))
    enc = tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})
    ids = ranks.encode(texts)
    assert ids == [u32(enc.encode_ordinary(t)) for t in texts]
    assert [ranks.decode(x) for x in ids] == [t.encode() for t in texts]


CACHE: dict = {}


def test_small_cache_starts_anew_and_stays_right(hf):
    own = IdEncoder(JSON)
    own.cache.limit = 3
    texts = ["the cat sat", "a dog ran far", "the cat ran", "x y z the cat"]
    for _ in range(3):
        assert [own.encode([t])[0] for t in texts] == [u32(hf.encode(t).ids) for t in texts]


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"k{i}".encode() for i in range(3001)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.index.tolist()) == list(range(len(keys)))
    assert table.find(keys) == list(range(len(keys)))
    assert table.find([b"absent", b""]) == [-1, -1]
    assert bpe.PerfectHash([]).find([b"x"]) == [-1]


def test_bpe_query_matches_library(spark, tt):
    out = collected(bpe.round_trip_digest(odd_documents(spark), RANKS, vocab.PATTERN))
    want = Counter()
    for doc_id, text, *_ in rows():
        ids = tt.encode_ordinary(text or "")
        want[doc_id, len(ids), hashlib.sha256(u32(ids)).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out) == want


def test_bpe_encode_and_decode_frames(spark):
    ids = bpe.encode_texts(odd_documents(spark), RANKS, vocab.PATTERN)
    back = collected(bpe.decode_ids(ids, RANKS, vocab.PATTERN))
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in back) == Counter(
        (r[0], (r[1] or "").encode()) for r in rows())


def test_token_counts_match_library(spark, sp):
    out = collected(token_count.count_tokens(odd_documents(spark), PIECES))
    want = Counter((d, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096)
                   for d, t, *_ in rows())
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out) == want


def test_token_files_round_trip(spark, hf):
    folder = scratch_dir(spark, "test-token-files")
    manifest = token_files.write_token_files(odd_documents(spark), JSON, folder, file_ids=5000)
    assert manifest.count() > 1
    out = sorted(collected(token_files.scan_token_files(manifest)), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in out]
    assert [i for i in ids if i is not None] == sorted(i for i in ids if i is not None)
    assert ids[:2] == [None, None]
    start = 0
    for r in out:
        assert r["start"] == start
        start += r["n_tokens"]
    want = Counter()
    for d, t, *_ in rows():
        x = hf.encode(t or "", add_special_tokens=False).ids + [0]
        want[d, len(x), zlib.crc32(u32(x))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 300), st.integers(0, 60_000), st.integers(0, 2**32 - 1)),
                max_size=400))
def test_simple8b_round_trip(values):
    a = np.array(values, np.uint32)
    assert (simple8b.decode_blocks(simple8b.encode_block(a)) == a).all()


def test_simple8b_packs():
    assert len(simple8b.encode_block(np.zeros(600, np.uint32))) == 10
    assert len(simple8b.encode_block(np.full(600, 20_000, np.uint32))) == 150


def check_packing(out, documents, hf, window):
    ids_of = Counter()
    whole = {}
    for r in out:
        whole.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for d, t, *_ in documents:
        x = hf.encode(t or "", add_special_tokens=False).ids + [1]
        ids_of[d, len(x)] += len(x)
    assert Counter({k: sum(r["length"] for r in v) for k, v in whole.items()}) == ids_of
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == members[0]["sequence_tokens"] <= window
        assert members[0]["padded_tokens"] in (at, window)


def test_packing(spark, hf):
    out = collected(packing.pack(odd_documents(spark), JSON, window=64, max_piece=16, block_windows=8))
    check_packing(out, rows(), hf, 64)
    text = {(d, len(hf.encode(t or "").ids) + 1): hf.encode(t or "").ids + [1] for d, t, *_ in rows()}
    for r in out:
        if r["doc_id"] is not None and r["doc_id"] != 5:
            assert bytes(r["ids"]) == u32(text[r["doc_id"], r["doc_tokens"]][r["start"]:r["start"] + r["length"]])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_differencing_deals_every_item_within_the_window(sizes):
    slots = packing.deal(sizes, 64)
    assert sorted(i for s in slots for i in s) == list(range(len(sizes)))
    assert max(sum(sizes[i] for i in s) for s in slots) <= 64


def test_differencing_is_even():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 512, 640).tolist()
    loads = [sum(sizes[i] for i in s) for s in packing.difference(sizes, 80)]
    assert max(loads) - min(loads) < 0.1 * np.mean(loads)


def test_empty_tables(spark):
    none = no_documents(spark)
    assert collected(bpe.round_trip_digest(none, RANKS, vocab.PATTERN)) == []
    assert collected(token_count.count_tokens(none, PIECES)) == []
    assert collected(token_files.token_files_round_trip(none, JSON)) == []
    assert collected(packing.pack(none, JSON)) == []


def test_texts_are_covered():
    assert None in TEXTS and "" in TEXTS


def test_a_carriage_return_of_the_text_is_no_mark_of_a_first_word(hf, sp):
    texts = ["a \rb", "a \rb c\nd", "\rfoo bar", "a b", "a\r b"]
    assert IdEncoder(JSON).encode(texts) == [u32(hf.encode(t, add_special_tokens=False).ids) for t in texts]
    cache = token_count.PieceCache(lambda k: token_count.count_keys(PIECES, k), alone=[token_count.SPACE_MARK])
    for t, keys in zip(texts, cache.learn(texts), strict=True):
        assert keys is None if "\r" in t else sum(cache.known[k] for k in keys) == len(sp.encode(t))


def test_words_of_letters_are_cut_at_spaces_only(hf, monkeypatch):
    own = IdEncoder(JSON)
    assert own.words is not None
    through = []
    real = own._whole
    monkeypatch.setattr(own, "_whole", lambda texts, tokenizer=None: through.append(tokenizer) or real(texts, tokenizer))
    texts = ["Word émentß Ünder ab", "x naïve\nnext line's", "mixed a1 b. ª º µm Дом ñandú", "a don't isn'T ÷ ×"]
    assert own.encode(texts) == [u32(hf.encode(t, add_special_tokens=False).ids) for t in texts]
    assert own.encode(texts[:1]) == [u32(hf.encode(texts[0], add_special_tokens=False).ids)]
    fresh = IdEncoder(JSON)
    monkeypatch.setattr(fresh, "_whole", lambda texts, tokenizer=None: through.append(tokenizer) or real(texts, tokenizer))
    through.clear()
    assert fresh.encode(texts[:1]) == own.encode(texts[:1])
    assert fresh.words in through
