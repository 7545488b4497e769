"""Ids at given places of token files, held against the whole sequence."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martlet.llm import token_store

FILE = public_tokenizers.path("word_bpe_49k.json")
WORDS = ["the", "Zusammenhang", "x1", "naïve", "\n", "12345", "日本語", "of"]


@pytest.fixture(scope="module")
def stored(spark):
    rng = random.Random(4)
    texts = {i: " ".join(rng.choices(WORDS, k=rng.randint(0, 40))) for i in range(120)}
    texts[60] = " ".join(rng.choices(WORDS, k=4000))  # a document of many blocks and longer than a segment
    docs = spark.createDataFrame([*texts.items(), (500, None), (501, "")], "doc_id long, text string").repartition(3)
    path = token_store.write_tokens(docs, FILE, spaced=False, end_id=2, segment_tokens=300)
    tokenizer = Tokenizer.from_file(FILE)
    ids = []
    for text in [*texts.values(), "", ""]:
        ids += [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
    return path, ids


def asked(spark, places):
    return spark.createDataFrame([(p,) for p in places], "place long")


@pytest.mark.parametrize("block", [64, 1000, 1 << 20])
def test_every_place(spark, stored, block):
    path, ids = stored
    got = token_store.tokens_at(spark.range(len(ids)).withColumnRenamed("id", "place"), path, block=block)
    assert [r.token for r in sorted(got.collect())] == ids


def test_odd_places(spark, stored):
    path, ids = stored
    places = [0, len(ids) - 1, len(ids), -1, None, 7, 7, 7, 10**15]
    got = token_store.tokens_at(asked(spark, places), path).collect()
    want = [(p, ids[p] if p is not None and 0 <= p < len(ids) else None) for p in places]
    assert sorted(map(str, got)) == sorted(f"Row(place={p}, token={t})" for p, t in want)


def test_nothing_asked_and_nothing_stored(spark, stored):
    assert token_store.tokens_at(asked(spark, []), stored[0]).count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string")
    empty = token_store.write_tokens(docs, FILE, spaced=False, end_id=2)
    assert [tuple(r) for r in token_store.tokens_at(asked(spark, [0, 3]), empty).collect()] in ([(0, None), (3, None)], [(3, None), (0, None)])


def test_other_columns_do_not_clash(spark, stored):
    path, ids = stored
    places = asked(spark, [5, 9]).selectExpr("place AS part", "place AS segment", "'x' AS token", "place AS base", "place AS block")
    got = token_store.tokens_at(places, path, place_col="part")
    assert got.columns == ["place", "token"] and sorted(map(tuple, got.collect())) == [(5, ids[5]), (9, ids[9])]
