import collections
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import SF, messy_rows
from veilframe.llm import token_files
from veilframe.llm.queries import QUERIES
from veilframe.session import fresh_path


def vocabulary():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def test_encoder_equals_the_tokenizer(tokenizer, sample):
    enc = token_files.TextEncoder(vocabulary())
    assert enc.by_piece
    rng = random.Random(3)
    odd = ["".join(rng.choice("aB's'T 9 \n \t\r.,ßéŁ日́  'Ll#$\x1c\x85​　") for _ in range(40)) for _ in range(600)]
    odd += ["", " ", "\n", " a", "a ", "a<|endoftext|> b", " <|endoftext|>", "a\n\n  b \n", "x" * 5000, "  \n\n  ", "\n a", "don't won't\n'll", "a  b", "a \nb", "a\n b", "a\n\nb", "a\n\n\nb", "a \n\n", "a\n ", "\n\na", "  a", " \n", "\n\n", "a   b", "a\xa0b", " \u3000x", "a. <|endoftext|>"]
    odd += ["".join(rng.choice(["ab", "9", " ", "\n", " ", ".", "é"]) for _ in range(30)) for _ in range(1500)]
    texts = [t or "" for _, t in sample] + odd
    ids, counts = enc.encode(pa.array(texts))
    ends = np.cumsum(counts)
    for text, a, z in zip(texts, ends - counts, ends):
        assert ids[a:z].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_contractions_and_edges_of_texts(tokenizer):
    enc = token_files.TextEncoder(vocabulary())
    rng = random.Random(5)
    texts = ["".join(rng.choice(["'", "'", "s", "t", "r", "e", "v", "m", "l", "d", " ", "\n", "é", "×", "7", "日", '"']) for _ in range(rng.randrange(9))) for _ in range(6000)]
    ids, counts = enc.encode(pa.array(["cut off", *texts]).slice(1))
    ends = np.cumsum(counts)
    for text, a, z in zip(texts, ends - counts, ends):
        assert ids[a:z].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_equal_words_of_a_batch_are_looked_up_once():
    enc = token_files.TextEncoder(vocabulary())
    asked, words = [], enc.words
    enc.words = lambda keys: asked.append(list(keys)) or words(keys)
    enc.encode(pa.array(["house, house. (house) house's house", "a house; a house!\nhouse"]))
    assert len(asked) == 1 and len(set(asked[0])) == len(asked[0]) and " house" in asked[0]


def test_what_is_remembered_stays_bounded():
    made = []
    recent = token_files.Recent(4, lambda keys: made.extend(keys) or [k.encode() for k in keys])
    assert recent(["a", "b", "a", "c"]) == [b"a", b"b", b"a", b"c"] and made == ["a", "b", "c"]
    assert recent(["c", "d"]) == [b"c", b"d"] and recent(["a", "e"]) == [b"a", b"e"] and made == [*"abcde"]
    for i in range(50):
        recent([str(i)])
    assert len(recent.young) + len(recent.old) <= 8


def test_blocks_round_trip():
    rng = np.random.default_rng(5)
    big = np.iinfo(np.int64)
    for values in [np.zeros(0, np.int64), np.array([7]), np.full(1000, -3), rng.integers(0, 50257, 5000), rng.integers(big.min, big.max, 1000),
                   np.array([big.min, big.max] * 200), np.where(rng.random(3000) < 0.03, 1 << 40, rng.integers(0, 9, 3000)), np.arange(256), np.arange(257)]:
        for kept in (1, 50, 90, 100):
            parts = token_files.encode_blocks(values, kept)
            places = np.cumsum([0, *[len(p) for p in parts]])[:-1]
            assert token_files.decode_blocks(b"".join(parts), places).tolist() == values.tolist()


def test_outliers_do_not_widen_a_block():
    values = np.random.default_rng(1).integers(0, 16, 256)
    values[7], values[200] = 1 << 50, 99
    block, = token_files.encode_blocks(values)
    low, count, width, exceptions = struct.unpack_from(token_files.HEAD, block)
    assert (count, width, exceptions) == (256, 4, 2)
    assert len(block) == token_files.HEAD_SIZE + 256 * 4 // 8 + 2 * 9


def test_query_equals_the_tokenizer(spark, tokenizer, sample):
    got = sorted(tuple(r) for r in QUERIES["op12_token_files"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    at, want = 0, []
    for i, t in sorted(sample):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


def write(spark, docs, **params):
    path = fresh_path(spark, "token-files")
    token_files.write_tokens(docs, path, vocabulary(), **params)
    return path


def test_many_files_and_odd_rows(spark, messy, tokenizer):
    path = write(spark, messy, file_ids=500)
    files = token_files.manifest(spark, path).orderBy("start").collect()
    assert len(files) > 8 and [f.start for f in files] == np.cumsum([0, *[f.n for f in files]])[:-1].tolist()
    rows = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.id is not None for r in rows] == sorted(r.id is not None for r in rows)
    ids = [r.id for r in rows if r.id is not None]
    assert ids == sorted(ids)
    want = collections.Counter((i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in [r[:2] for r in messy_rows()])
    assert want == collections.Counter((r.id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens


def test_slices_of_the_corpus(spark, messy, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 700)
    path = write(spark, messy, file_ids=500)
    whole = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start)])
    wanted = [(0, 1), (3, 900), (499, 5000), (len(whole) - 5, 5), (len(whole) - 5, 50), (len(whole) + 1, 4), (256, 256), (0, len(whole)), (None, 3), (4, 0), (4, None)]
    got = token_files.read_slices(spark, path, spark.createDataFrame(wanted + wanted[:2], "start long, length long")).collect()
    assert {(r.start, r.length): np.frombuffer(r.ids, "<u4").tolist() for r in got} == {
        (s, n): whole[s:s + n].tolist() for s, n in wanted if s is not None and n and s < len(whole)}
    assert len(got) == 8 - 1


def test_empty_table_and_damaged_file(spark, empty):
    path = write(spark, empty)
    assert token_files.read_documents(spark, path).collect() == [] and token_files.manifest(spark, path).collect() == []
    with pytest.raises(ValueError):
        token_files.FileReader(b"PATCHFR1 cut off")


def test_other_kinds_of_tokenizers_go_whole(sample):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    enc, tokenizer = token_files.TextEncoder(path), Tokenizer.from_file(path)
    assert not enc.by_piece
    for _, t in sample[:20]:
        assert enc.encode(pa.array([t]))[0].tolist() == tokenizer.encode(t, add_special_tokens=False).ids
