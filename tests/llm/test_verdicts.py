"""Verdicts at their limits, and the toxicity kernel against a plain count of subsequences."""

import itertools

import duckdb
import numpy as np
import pytest

from dealmill.llm import quality_rules, queries, secrets, toxicity

KEY = "Zx9" * 9


def test_copies_within_one_source_in_query_and_sql(spark, tmp_path):
    """A value in 20 documents of one source is live, one in 21 is an example."""
    most = secrets.MAX_REPOSITORIES
    rows = [(i, f"secret={KEY}" if i <= most else "secret=Copied123456", "one", "en", 0) for i in range(2 * most + 1)]
    df = spark.createDataFrame([*rows, rows[0], (None, "secret=Null1234567", None, None, 0)], "doc_id long, text string, source string, lang string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.SQL["op1_secret_scan"])
    names, got = [c[0] for c in want.description], queries.op1_secret_scan(spark, str(tmp_path))
    found = sorted(map(str, map(tuple, got.select(*names).collect())))
    assert found == sorted(map(str, want.fetchall()))
    live = {r["doc_id"]: r["n_live"] for r in got.collect()}
    assert live[0] == live[most] == 0 and live[most + 1] == live[2 * most] == live[None] == 1


def test_redact_follows_the_limit_it_is_given(spark):
    rows = [(i, f"secret={KEY}", "one", 0) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    texts = lambda **limits: {r["text"] for r in secrets.redact(df, **limits).collect()}
    assert texts() == {f"secret={KEY}"} and texts(max_repositories=25) == {"<assign>"} and texts(max_repositories=24) == {f"secret={KEY}"}


def _kernel(a, b):
    """Normalised product of the weighted three-letter subsequences within SPAN letters, counted one by one."""
    def bag(word):
        out = {}
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if k - i < toxicity.SPAN:
                key = word[i] + word[j] + word[k]
                out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    # The word's own side is scaled by the weights of its places, the landmark's by its bag.
    x, y = bag(a), bag(b)
    places = sum(toxicity.DECAY ** (2 * (k - i + 1)) for i, _, k in itertools.combinations(range(len(a)), 3) if k - i < toxicity.SPAN)
    norm = np.sqrt(places * sum(v * v for v in y.values()))
    return min(1.0, sum(x[k] * y.get(k, 0) for k in x) / norm) if norm else 0.0


def test_nearness_is_the_counted_kernel():
    landmarks = ["worthless", "idiot", "banana", "aaa", "xy"]
    words = ["worthless", "worthxless", "wrthless", "idot", "iddiioott", "banana", "bandana", "aaaa", "zzz", "ab", "mississippi"]
    near = toxicity.Nearness(landmarks)
    for word in words:
        assert near.of(word) == pytest.approx([_kernel(word, z) for z in landmarks], abs=1e-5), word


def test_batches_and_single_texts_agree(monkeypatch):
    texts = ["", "one", "you worthless idiot", "w o r t h l e s s things", None or "", "idiot " * 50 + "banana", " ".join(f"word{i}" for i in range(500))] * 3
    landmarks = ["worthless", "idiot", "banana"]
    whole = toxicity.Nearness(landmarks).of_all(texts)
    assert (whole == np.stack([toxicity.Nearness(landmarks).of(t) for t in texts])).all()
    # Small pieces, and a memory that is emptied again and again.
    monkeypatch.setattr(toxicity, "_PIECE", 7)
    monkeypatch.setattr(toxicity, "REMEMBERED", 30)
    assert (whole == toxicity.Nearness(landmarks).of_all(texts)).all()


def test_a_labelled_id_on_many_rows_is_learnt_once(spark):
    rows = [(i % 40, "you worthless thing" if i % 2 else f"a fine day number {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    landmarks, weights, _ = toxicity.train(df, labels)
    assert "worthless" in landmarks and len(weights) == len(landmarks)
    scores = {r["doc_id"] % 2: r["score"] for r in toxicity.score(df, labels).collect()}
    assert scores[1] > 0.5 > scores[0]


def test_junk_in_a_source_does_not_hide_itself(spark):
    """A source with 40 % junk, and a source of one junk document, lose their junk and nothing else."""
    rnd = np.random.default_rng(1)
    words = ["".join(rnd.choice(list("abcdefghij"), rnd.integers(2, 9))) for _ in range(400)]
    prose = lambda: " ".join(rnd.choice(words, 80))
    junk = lambda: " ".join(w + "#$%" for w in rnd.choice(words, 80))
    rows = [(i, junk() if i < 40 else prose(), "en", "mixed") for i in range(100)]
    rows += [(100 + i, prose(), "en", f"s{i % 4}") for i in range(200)]
    rows += [(300, junk(), "en", "alone"), (301, prose(), "en", "alone too"), (302, junk(), "xx", "alone"), (303, junk(), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(df).collect()}
    assert [i for i, k in kept.items() if k != (not (i < 40 or i in (300, 302, 303)))] == []


def test_rows_without_ids_are_spread(spark):
    """A third of all rows without an id: each row has a salt of its own, and every row its verdict."""
    rows = [(None if i % 3 == 0 else i, f"word{i} " * 3 + "other words here " * 20, "en", "s") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    got = quality_rules.judge(df).collect()
    assert len(got) == 300 and sum(r["doc_id"] is None for r in got) == 100
