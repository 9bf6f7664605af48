"""Ranked search, collocations and pieces against plain Python versions and the tokenizer's library."""

import hashlib
import random

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from dealmill.llm import collocations, pieces, queries, ranked_search

DOCS = "doc_id long, text string, lang string, words string, place long, n long, w1 string"
ITEMS = "item_id long, text string, place long, score long"


def prose(rnd, vocabulary, n):
    return " ".join(rnd.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=n))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdÉß漢0") for _ in range(rnd.randint(1, 4))) for _ in range(80)]
    some = [prose(rnd, vocabulary, rnd.randint(1, 90)) for _ in range(120)]
    return [None, "", " .,;\t", "A", "a", *some, some[3], some[3], some[3], "the " * 4000 + "Word. word", prose(rnd, vocabulary, 30000), "x" * 50000]


def frame(spark, texts, lang=lambda i: None if i % 5 == 0 else "xy"[i % 2]):
    rows = [(None if i % 11 == 0 else i // 2, t, lang(i), "w", 1, 2, "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3), [(r[0], r[1]) for r in rows], [(r[2], r[1]) for r in rows]


@pytest.mark.parametrize(("postings", "block"), [(10**6, 10**6), (300, 60)])
def test_ranked_search(spark, texts, postings, block):
    docs, rows, _ = frame(spark, texts)
    asked = [None, "", "nothingofthekind", "A the WORD", texts[7], texts[8], texts[8], texts[-2]]
    items = spark.createDataFrame([(i if i != 6 else 5, t, 3, 4) for i, t in enumerate(asked)], ITEMS)
    got = ranked_search.search(docs, items, postings=postings, block=block).collect()
    want = brute.ranked(rows, asked)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((5 if p == 6 else p, *rest) for p, *rest in want), key=key)


def test_ranked_search_of_empty_tables(spark, texts):
    docs, _, _ = frame(spark, texts[:9])
    items = spark.createDataFrame([(1, "a word", 1, 1)], ITEMS)
    for left, right in ((docs.where("false"), items), (docs, items.where("false")), (docs.where("text is null"), items)):
        found = ranked_search.search(left, right)
        assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_best_positions_stop_early_and_lose_nothing():
    rnd = np.random.default_rng(3)
    n, size = 20_000, 4
    term = np.repeat(np.arange(size), n)
    doc = np.concatenate([rnd.permutation(n) for _ in range(size)])
    quality = rnd.integers(0, 100, n) ** 4  # good documents are good in every list
    share = quality[doc] + rnd.integers(0, 1000, n * size)
    share[doc == 5] = share[doc == 6] = share.max() * 2  # a tie at the top
    shard = ranked_search.Shard(term, doc, share, np.arange(n))
    docs, scores, read = shard.best(np.arange(size), 10)
    total = np.zeros(n, np.int64)
    np.add.at(total, doc, share)
    want = np.lexsort((np.arange(n), -total))[:10]
    assert docs.tolist() == want.tolist() and scores.tolist() == total[want].tolist()
    assert read < n * size / 4


def test_ties_at_the_last_place_are_all_read():
    n = 500  # all alike: the stopping sum equals the tenth score until all is read
    shard = ranked_search.Shard(np.zeros(n, np.int64), np.arange(n)[::-1].copy(), np.full(n, 7), np.arange(n))
    docs, _, read = shard.best(np.array([0]), 10)
    assert docs.tolist() == list(range(10)) and read == n


def test_ranked_query(spark, tmp_path, texts):
    docs, rows, _ = frame(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    asked = [texts[9], texts[10]]
    spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(asked)], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((r["item_id"], r["rank"], r["score"]) for r in queries.op11_ranked_search(spark, str(tmp_path)).collect())
    assert got == sorted((p, rank, score) for p, rank, _, score in brute.ranked(rows, asked))


@pytest.mark.parametrize("bits", [1, 27])
def test_collocations(spark, texts, monkeypatch, bits):
    monkeypatch.setattr(collocations, "SKETCH_BITS", 6 + bits if bits == 1 else bits)
    docs, _, rows = frame(spark, [*texts, "one Two\tthree  four five six? one two " * 9, "one two three. four! five;six"] * 2)
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=6, top=150).collect())
    want = brute.collocations(rows, 6, 150)
    assert got == want and {len(r[2].split(" ")) for r in got} == {2, 3, 4, 5}
    assert any(r[0] == "und" for r in got)


def test_scores_beyond_64_bits_are_exact(spark):
    """Sums of counts are longs; a thousand times their product is not."""
    a, n = 3_000_000_019, 9_000_000_000_000_001
    row = spark.createDataFrame([(a, n, a + 5, a + 7)], "a long, n long, l long, r long")
    got = row.selectExpr(
        "(1000bd * cast(a as decimal(38,0)) * cast(n as decimal(38,0))) div (cast(l as decimal(38,0)) * cast(r as decimal(38,0))) as s"
    ).first()["s"]
    assert got == 1000 * a * n // ((a + 5) * (a + 7))


def test_collocations_of_empty_tables(spark, texts):
    docs, _, _ = frame(spark, texts[:5])
    for df in (docs.where("false"), docs, docs.where("text is null")):
        assert collocations.collocations(df).collect() == []


@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path(queries.PIECES)
    with open(path, "rb") as file:
        return sentencepiece.SentencePieceProcessor(model_file=path), pieces.Codec(file.read())


def test_pieces_against_the_library(library):
    model, codec = library
    rnd = random.Random(2)
    known = [t.replace("▁", " ") for t in codec.vocabulary.text.values()]
    signs = [*" ab▁\n\t01.é漢🙂\x00　';\r{})", "  ", "�", "<s>", "<0x41>"]
    makers = [
        lambda: "".join(rnd.choices(known, k=rnd.randint(0, 12))),
        lambda: "".join(rnd.choices(signs, k=rnd.randint(0, 50))),
        lambda: "".join(chr(rnd.choice([rnd.randrange(1, 0x250), rnd.randrange(0x250, 0xD7FF), rnd.randrange(0xE000, 0x110000)])) for _ in range(20)),
        lambda: " " * rnd.randint(0, 60) + rnd.choice(["", "a"]) + " " * rnd.randint(0, 40),
    ]
    for i in range(6000):
        text = makers[i % 4]()
        want = model.encode(text, add_eos=True)
        assert codec.encode(text).tolist() == want, text
        assert codec.decode(np.array(want)) == model.decode(want)
        loose = [rnd.randrange(32000) if rnd.random() < 0.5 else rnd.randrange(300) for _ in range(rnd.randint(0, 8))]
        assert codec.decode(np.array(loose, np.int64)) == model.decode(loose), loose


def test_whole_parts_and_cut_parts_agree(library):
    """The prefix table over a whole text gives what it gives part by part."""
    _, codec = library
    text = "▁Ab{cd}▁▁▁x;\r\n▁naïve▁words▁▁12.5▁漢字🙂ab" * 20
    whole = [t for t in codec.vocabulary.encode(text)]
    parts = [t for part in codec.cut(text) for t in codec.vocabulary.encode(part)]
    assert whole == parts and "".join(codec.cut(text)) == text


def test_sentencepiece_query(spark, texts, library, tmp_path):
    model, _ = library
    docs, rows, _ = frame(spark, [*texts, "▁ two  blanks ", "\x00"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op13_sentencepiece(spark, str(tmp_path)).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc_id, text in rows:
        ids = model.encode(text or "", add_eos=True)
        want.append((str(doc_id), len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids))))
    assert got == sorted(want)
    assert pieces.encode_documents(docs.where("false"), public_tokenizers.path(queries.PIECES)).collect() == []
