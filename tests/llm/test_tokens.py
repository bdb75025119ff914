"""Token files, packing and BPE against the tokenizers library."""

import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import data
from parity.llm import common, op04_packing, op07_token_files, op08_bpe, word_tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


# ------------------------------------------------------------------- files --

@settings(max_examples=40, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2 ** 32 - 1), max_size=300))
def test_packing_bits_round_trip(width, numbers):
    ids = np.array([n & ((1 << width) - 1) for n in numbers], np.uint32)
    packed = op07_token_files.pack(ids, width)
    assert len(packed) == -(-len(ids) * width // 8)
    assert op07_token_files.unpack(packed, len(ids), width).tolist() == ids.tolist()


def test_width_is_the_least():
    assert [op07_token_files.width_of(n) for n in (0, 1, 2, 3, 256, 257, 49_408, 65_536, 65_537)] == [
        1, 1, 1, 2, 8, 9, 16, 16, 17]


@pytest.mark.parametrize("width,block", [(16, 8), (17, 5), (3, 1), (9, 1000)])
def test_file_random_access(width, block):
    rnd = random.Random(width)
    docs = [np.array([rnd.randrange(1 << width) for _ in range(rnd.choice([0, 1, 7, 40]))], np.uint32) for _ in range(30)]
    sink = io.BytesIO()
    w = op07_token_files.TokenFileWriter(sink, width, block)
    for i, d in enumerate(docs):
        w.add(None if i == 4 else i, d)
    assert w.close() == (30, sum(map(len, docs)))
    f = op07_token_files.TokenFile(io.BytesIO(sink.getvalue()), len(sink.getvalue()))
    everything = np.concatenate(docs)
    for _ in range(50):
        lo = rnd.randrange(len(everything))
        hi = rnd.randrange(lo, len(everything) + 1)
        assert f.ids(lo, hi).tolist() == everything[lo:hi].tolist()
    assert f.nulls.tolist() == [i == 4 for i in range(30)]
    with pytest.raises(ValueError):
        w2 = op07_token_files.TokenFileWriter(io.BytesIO(), 3)
        w2.add(1, np.array([8], np.uint32))


def test_token_files(spark, library):
    folder = common.shared_path(spark, "files")
    manifest = op07_token_files.write_token_files(data.docs(spark), PATH, folder, 2, block=64)
    got = [tuple(r) for r in op07_token_files.read_token_files(manifest).collect()]
    ordered = sorted(((d, t or "") for d, t, *_ in data.rows()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want, start = [], 0
    for d, t in ordered:
        ids = ids_of(library, t)
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=data.key) == sorted(want, key=data.key)


def test_token_files_of_nothing(spark):
    manifest = op07_token_files.write_token_files(data.empty(spark), PATH, common.shared_path(spark, "files"), 2)
    assert manifest.count() == 0 and op07_token_files.read_token_files(manifest).count() == 0


# ----------------------------------------------------------------- packing --

def test_best_fit_decreasing_against_a_plain_search():
    rnd = random.Random(5)
    for window in (8, 100, 4096):
        for _ in range(20):
            lengths = sorted((rnd.randint(1, window) for _ in range(rnd.randint(0, 80))), reverse=True)
            number, offset = op04_packing.best_fit_decreasing(np.array(lengths, np.int64), window)
            room = {}
            for length, n, at in zip(lengths, number.tolist(), offset.tolist()):
                fits = [c for c in room.values() if c >= length]
                before = room.get(n, window)
                assert before == (min(fits) if fits else window) and at == window - before
                assert (n in room) == bool(fits)
                room[n] = before - length


def check_packing(packed, library, some, window):
    per_doc, per_seq = defaultdict(list), defaultdict(list)
    for r in packed:
        per_doc[r.doc_id, r.doc_tokens].append(r)
        per_seq[r.sequence_id].append(r)
    want = Counter()
    for d, t, *_ in some:
        ids = ids_of(library, t)
        for at in range(0, len(ids), window):
            piece = ids[at:at + window]
            want[d, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in packed) == want
    for pieces in per_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window


@pytest.mark.parametrize("window,group", [(4096, 50_000), (64, 10), (7, 1000)])
def test_packing(spark, library, window, group):
    packed = op04_packing.pack_documents(data.docs(spark), PATH, 2, window, group).collect()
    check_packing(packed, library, data.rows(), window)


def test_packing_of_nothing(spark):
    assert op04_packing.pack_documents(data.empty(spark), PATH, 2).count() == 0


def test_padding_counts_powers_of_two_as_full(spark):
    df = spark.createDataFrame([(1, 8), (2, 5), (2, 3), (3, 5)], "sequence_id long, length long")
    r = op04_packing.padding(df, 16).first()
    assert (r.n_sequences, r.n_tokens, r.n_padding) == (3, 21, 11)


# --------------------------------------------------------------------- BPE --

ODD = ["a", "A", "é", "é", "Σ", "σ", "İ", "ǅ", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "\n", " ", " ", "1",
       "²", "½", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|", "中", "ß", "ẞ", "😀", "!!", "...", "aaaa", "K",
       "ſ", "\x00", "﻿", "ﬁ", "가", "가", "Ⅷ", "ª", "the", "River,", "don't", "֋"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=25).map("".join))
def test_encoders_equal_the_library(text):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    want = library.encode(text, add_special_tokens=False).ids
    bpe = op08_bpe.codec(PATH)
    got = bpe.encode([text])[0]
    assert got.tolist() == want
    assert bpe.decode(got).decode() == library.decode(want, skip_special_tokens=False)
    assert word_tokens.encoder(PATH).encode([text])[0].tolist() == want


def test_pairs_of_a_made_token_rank_after_it():
    """What lets all occurrences of a pair be merged at once."""
    bpe = op08_bpe.codec(PATH)
    first = np.full(bpe.size, len(bpe.left))
    np.minimum.at(first, bpe.left, np.arange(len(bpe.left)))
    np.minimum.at(first, bpe.right, np.arange(len(bpe.right)))
    assert (first[bpe.made] > np.arange(len(bpe.made))).all()


def test_small_word_tables_change_nothing(monkeypatch):
    texts = [t or "" for _, t, *_ in data.rows()]
    want = [x.tolist() for x in op08_bpe.PairIndexBpe(PATH).encode(texts)]
    monkeypatch.setattr(op08_bpe, "MAX_WORDS", 5)
    monkeypatch.setattr(op08_bpe, "MAX_SYMBOLS", 50)
    monkeypatch.setattr(word_tokens, "MAX_WORDS", 5)
    small, other = op08_bpe.PairIndexBpe(PATH), word_tokens.WordEncoder(PATH)
    for _ in range(2):
        assert [small.encode([t])[0].tolist() for t in texts] == want
        assert [other.encode([t])[0].tolist() for t in texts] == want


def test_round_trip(spark, library):
    got = sorted((tuple(r) for r in op08_bpe.round_trip(data.docs(spark), PATH).collect()), key=data.key)
    want = []
    for d, t, *_ in data.rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=data.key)
    assert op08_bpe.round_trip(data.empty(spark), PATH).count() == 0


# ------------------------------------------------------------ word encoder --

PARTS = ["'", "'S", "'re", "'LL", "don", "A", "b7", "42", "--", "...", "<|endoftext|>", "<", "É", "ß", "_", "\x7f", "\x1c", "x" * 150]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS) | st.text("aZ09'.-!é<|>", max_size=6), max_size=6).map("".join), max_size=12))
def test_words_of_several_pieces(words):
    enc = word_tokens.encoder(PATH)
    text = " ".join(words)
    assert [enc.encode([text])[0].tolist()] == [ids_of(enc.tok, text).tolist()[:-1]]


def test_plain_words_go_to_the_model_alone(library):
    """ASCII words never pass the library's normalizer and pattern, a chunk of texts is looked up at once."""
    enc = word_tokens.WordEncoder(PATH)
    asked = []
    direct = enc._direct
    enc._direct = lambda texts: asked.extend(texts) or direct(texts)
    texts = [f"The mill's wheel-{i} turned {i} times, it's said!" for i in range(600)]
    assert [x.tolist() for x in enc.encode(texts)] == [ids_of(library, t).tolist()[:-1] for t in texts]
    assert enc.plain and asked == []
