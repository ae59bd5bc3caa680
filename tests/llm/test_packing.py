import collections
import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import messy_rows
from veilframe.llm import packing
from veilframe.llm.queries import word_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_tokenizer())


def test_word_encoder_equals_the_tokenizer(tokenizer, sample):
    enc = packing.WordEncoder(word_tokenizer())
    rng = random.Random(2)
    odd = ["".join(rng.choice("aB's'T 9\n\t.,<|endoftext|>ßÄéŁ日ı́  'Ll#$") for _ in range(40)) for _ in range(400)]
    for text in [t or "" for _, t in sample] + odd:
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert enc.encode(text.encode()) == want, text


def test_pieces_and_places(spark, messy, empty, tokenizer):
    found = packing.pack_documents(messy, word_tokenizer(), capacity=64).collect()
    want = collections.Counter()
    for i, t in [r[:2] for r in messy_rows()]:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for p, lo in enumerate(range(0, len(ids), 64)):
            want[i, p, lo, zlib.crc32(np.array(ids[lo:lo + 64], "<u4").tobytes())] += 1
    assert want == collections.Counter((r.id, r.piece, r.start, zlib.crc32(bytes(r.ids))) for r in found)
    check_places([(r.sequence_id, r.offset, r.length) for r in found], 64)
    assert packing.pack_documents(empty, word_tokenizer()).count() == 0


def check_places(rows, capacity):
    seq = collections.defaultdict(list)
    for s, offset, length in rows:
        seq[s].append((offset, length))
    for parts in seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seq)


def test_blocks_pack_about_as_well_as_the_bound(spark):
    rng = random.Random(9)
    size = [min(4096, int(rng.lognormvariate(6.3, 1.1)) + 1) for _ in range(6000)]
    items = spark.createDataFrame(list(enumerate(size)), "uid long, length long")
    got = packing.pack(items, block=1000).join(items, "uid").collect()
    assert sorted(r.uid for r in got) == list(range(len(size)))
    n = check_places([(r.sequence_id, r.offset, r.length) for r in got], 4096)
    assert n <= -(-sum(size) // 4096) + 2


def test_evolution_beats_best_fit_decreasing():
    rng = np.random.default_rng(6)
    size = rng.integers(1100, 1600, 180)
    plain = packing.best_fit(size, np.argsort(-size, kind="stable"), 4096, []).max() + 1
    best = packing.evolve(size, 4096, [], np.random.default_rng(1), 40)
    assert best.max() + 1 <= plain
    assert np.bincount(best, size).max() <= 4096
    child = packing.crossover(best, packing.best_fit(size, rng.permutation(180), 4096, []), size, 4096, rng)
    assert np.bincount(child, size).max() <= 4096 and sorted(set(child.tolist())) == list(range(child.max() + 1))
