import random
import re

import numpy as np

from tabflow.llm import shingles as S

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def odd_texts():
    rng = random.Random(1)
    texts = [b"", b" ", b"a", b" a", b"a ", b"a\x0bb\x0cc\x1cd \xc2\xa0 e", b"A" * 511, b"A" * 512, b"x" * 600_000, b"ab " * 200_000]
    texts += [bytes(rng.choice(b"abcAB \t\n\r\x85\xa0\xff") for _ in range(rng.randrange(1, 400))) for _ in range(300)]
    texts += [b"w" * 700 + b" z " + b"y" * (S.CHUNK + 5) + b" end", (b"q" * (S.CHUNK - 2)) + b" tail words here" * 40_000]
    return texts


def test_words_hash_alike_at_any_place_and_apart_otherwise():
    seen = {}
    for text in odd_texts():
        words = [w.translate(S.LOWER_BYTES) for w in WORD.findall(text)]
        hashes = S.word_hashes(text)
        assert len(hashes) == len(words)
        for w, h in zip(words, hashes.tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_sets_have_the_size_of_the_shingles():
    for text in odd_texts():
        words = [w.translate(S.LOWER_BYTES) for w in WORD.findall(text)]
        want = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        got = S.shingle_set(text)
        assert len(got) == len(want) and (np.diff(got) > 0).all()


def test_signatures_estimate_likeness():
    rng = np.random.default_rng(0)
    p, errors = S.Permutations(64), []
    for share in (0.1, 0.5, 0.75, 0.95):
        for _ in range(100):
            common = int(800 * share / (1 + share))
            a, b, c = (rng.integers(0, 2 ** 64, n, dtype=np.uint64) for n in (common, 400 - common, 400 - common))
            x, y = p.signature(np.r_[a, b]), p.signature(np.r_[a, c])
            errors.append((x == y).mean() - common / (800 - common))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06
