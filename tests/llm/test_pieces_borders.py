import random
import time

import pytest

from riskloom.llm import pieces

MODEL = None


@pytest.fixture(scope="module")
def model():
    with open(pieces.MODEL, "rb") as file:
        return pieces.Model(file.read())


def plain_merge(model, text):
    parts = list(text)
    while True:
        scored = [(model.score[x + y], -k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in model.score]
        if not scored:
            return parts
        k = -max(scored)[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]


def words(n, seed=1):
    rng = random.Random(seed)
    parts = ["the", "ing", "tion", "er", "ab", "é", "ß", "中", "文", "x", "q", "00", "-", "ation", "qu", "▁"[:0] or "s", "un"]
    return ["▁" + "".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_merging_with_a_heap_equals_plain_merging(model):
    for text in [*words(60), "▁" * 100 + "word", "a" * 90, "▁▁" + "ab" * 50]:
        assert model.merged(text) == model._merged_long(text) == plain_merge(model, text)


def test_both_kinds_of_state_give_what_merging_gives(model, monkeypatch):
    texts = words(100) + ["▁" + "ab" * k for k in range(28, 36)]
    assert {len(t) > pieces.LONG for t in texts} == {True, False}
    want = {t: b"".join(map(pieces.Encoder(model)._code, plain_merge(model, t))) for t in texts}
    for border in (pieces.LONG, 0, 10_000):
        monkeypatch.setattr(pieces, "LONG", border)
        encoder = pieces.Encoder(model)
        encoder.learn(set(texts))
        assert encoder.known == want


def test_small_bounds_change_nothing(model, monkeypatch):
    texts = words(100, 7)
    plain = pieces.Encoder(model)
    plain.learn(set(texts))
    monkeypatch.setattr(pieces, "KNOWN_PAIRS", 20)
    monkeypatch.setattr(pieces, "KNOWN_ENDINGS", 5)
    small = pieces.Encoder(model)
    small.learn(set(texts))
    assert small.known == plain.known


def test_an_indented_long_run_takes_time_near_its_length(model):
    encoder, start = pieces.Encoder(model), time.process_time()
    text = "  " + "aGVsbG8gd29ybGQ" * 13_000
    ids = encoder.encode([text])[0]
    assert time.process_time() - start < 30
    import numpy as np
    assert pieces.decoded(model, np.frombuffer(ids, np.int32)) == text
