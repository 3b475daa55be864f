from __future__ import annotations

import random

import public_tokenizers
import pytest
from helpers import documents
from tokenizers import Tokenizer

from celluloid.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [*"  \n\t'strvmlledST19!?., é漢😀ñ́²", " ", " ", "\x1c", "\x85", "'s", "'re", "'ll", "'", " the", "<|endoftext|>", "   ", "hello", "....", "aaaa", "=-"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library_on_random_texts(library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["a" * 3000, " " * 2000 + "x", "\n" * 777, "=" * 700, "é" * 500, "", "'r", "'", "x'l"]
    assert [n for _, n in token_counts.TokenMachine(PATH).count(texts)] == library(texts)


def test_character_classes_equal_the_library_for_every_code_point(library):
    machine = token_counts.TokenMachine(PATH)
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}a 1{chr(c)}1 !{chr(c)}!" for c in points]
    differing = [hex(c) for c, a, b in zip(points, machine.count(texts), library(texts)) if a[1] != b]
    assert not differing


def test_long_texts_are_cut_where_it_makes_no_difference(library, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE", 200)
    monkeypatch.setattr(token_counts, "CHUNK", 16)
    rng = random.Random(4)
    text = "".join(rng.choice(PIECES) for _ in range(9000))
    machine = token_counts.TokenMachine(PATH)
    assert [n for _, n in machine.count([text, text[:4000]])] == library([text, text[:4000]])


def test_the_counter_begun_anew_counts_the_same(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 10)
    texts = ["some words and more of them", "words again, with others", "überhaupt nicht"]
    machine = token_counts.TokenMachine(PATH)
    assert [machine.count([t])[0][1] for t in texts] == library(texts)


def test_state_maps_compose_to_the_whole_run():
    machine = token_counts.TokenMachine(PATH)
    import numpy as np

    kinds = np.random.default_rng(1).integers(0, 12, (9, 64)).astype(np.uint8)
    state, entered = token_counts.START, []
    for row in kinds:
        entered.append(state)
        for kind in row:
            state = machine.following[state, kind]
    assert token_counts.scan(machine.state_maps(kinds)).tolist() == entered


def test_nulls_repeats_and_clashing_columns(spark, library):
    docs = documents(spark, [(1, "one two"), (1, "one two"), (None, "three"), (4, None), (5, "")]).withColumnRenamed("n_chars", "n_tokens")
    got = token_counts.token_counts(docs, PATH).select("doc_id", "n_bytes", "n_tokens", "lang").collect()
    two, three = library(["one two", "three"])
    assert sorted(map(tuple, got), key=str) == sorted([(1, 7, two, "en")] * 2 + [(None, 5, three, "en"), (4, 0, 0, "en"), (5, 0, 0, "en")], key=str)
    assert token_counts.token_counts(docs.limit(0), PATH).count() == 0
