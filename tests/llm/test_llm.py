"""Training-data operators against plain Python versions on small tables with awkward rows."""

import math
import random
import zlib
from collections import defaultdict

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealmill.llm import bpe, fingerprints, mixing, near_dup, quality_model, quality_rules, queries, repeats, secrets, toxicity, url_filter
from dealmill.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kind string, h long, size long"
KEY = "Zx9" * 9


def _texts():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdeéß漢") for _ in range(rnd.randint(1, 7))) for _ in range(60)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    base = prose(300)
    words = base.split(" ")
    near = [" ".join(words[:i] + ["changed"] + words[i + 1 :]) for i in (7, 150, 299)]
    return [
        None, "", " \t\n", "a", "A b", prose(5000), base, base, *near, base[:900] + prose(50) + base[200:1000],
        "on he " * 400, "x" * 1500, "x" * 399 + "y" * 401, "line\nline\n\nline\nother", "ÀÉ 漢字 🙂\x00\x1c\x85 done",
        "password = hunter2hunter2 token=secret: abcdefgh1 TOKEN='" + KEY + "'", "AKIA" + "A1" * 8 + " " + "0f" * 20 + " 0f0f",
        "Api_Key:abc\npasswd==abcdefg " + KEY, "K" + KEY + "!", *(prose(rnd.randint(20, 120)) for _ in range(25)),
    ]


@pytest.fixture(scope="module")
def texts():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, None if i % 7 == 0 else f"s{i % 4}", len(t or ""), "k", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame([(None, *rows[6][1:]), rows[17], *rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    rows = df.collect()
    return rows, {r["doc_id"]: r for r in rows}


def test_secrets(docs, texts, empty):
    rows, got = by_id(secrets.digest(secrets.scan(docs)))
    assert len(rows) == len(texts) + 2
    for i, text in enumerate(texts):
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"], got[i]["base_sha256"]) == brute.secrets(text)
    assert "token:" not in got[18]["spans"] and got[20]["spans"] == f"token:0:{len(KEY) + 1}"
    assert secrets.digest(secrets.scan(empty)).collect() == []


def test_widely_copied_secret_is_an_example(spark):
    rows = [(i, f"secret={KEY}" if i < 5 else "secret=OnlyMine123", f"s{i}") for i in range(6)]
    _, got = by_id(secrets.digest(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string"))))
    assert [got[i]["n_live"] for i in range(6)] == [0] * 5 + [1] and got[0]["n_example"] == 1


def test_value_copied_within_one_source_is_an_example(spark):
    most = secrets.MAX_REPOSITORIES
    rows = [(i, f"secret={KEY}" if i <= most else "secret=Copied123456", "one", 0) for i in range(2 * most + 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    found = {r["doc_id"]: r["found"] for r in secrets.scan(df).collect()}
    assert {(s["live"], s["n_repositories"], s["n_owners"]) for i in range(most + 1) for s in found[i]} == {(False, most + 1, 1)}
    assert {(s["live"], s["n_repositories"], s["n_owners"]) for i in range(most + 1, 2 * most + 1) for s in found[i]} == {(True, most, 1)}
    got = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert got[0] == f"secret={KEY}" and got[2 * most] == "<assign>"


def test_redact(docs, texts):
    rows, got = by_id(secrets.redact(docs))
    assert len(rows) == len(texts) + 2
    assert got[17]["text"].startswith("<assign> token=secret: abcdefgh1") and got[5]["text"] == texts[5] and got[0]["text"] is None
    assert got[17]["n_chars"] == len(got[17]["text"])
    # The first two rows repeat an id or have none; each row is cut at its own spans.
    assert sorted(r["text"] or "" for r in rows if r["doc_id"] == 17) == [got[17]["text"]] * 2


def test_redact_cuts_every_row_at_its_own_spans(spark):
    rows = [(None, "secret=OnlyMine123", "a", 18), (1, "secret=OnlyMine456", "b", 18), (1, "now secret=OnlyMine789", "c", 22), (1, "none", "d", 4)]
    got = secrets.redact(spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long"))
    assert sorted(tuple(r) for r in got.collect() if r["doc_id"]) == [(1, "<assign>", "b", 8), (1, "none", "d", 4), (1, "now <assign>", "c", 12)]
    assert [tuple(r) for r in got.where("doc_id is null").collect()] == [(None, "<assign>", "a", 8)]


def test_mix(docs, texts, empty):
    rows = mixing.mix(docs).collect()
    sizes = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.WORD.findall(r["text"] or ""))
    want, taken = brute.targets(sizes), {}
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    positions = [r["position"] for r in rows if r["position"] is not None]
    assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(empty).collect() == []


def test_mix_parts_do_not_change_the_mix(docs, monkeypatch):
    whole = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "ROWS_PER_PART", 3)
    assert sorted(map(str, mixing.mix(docs).collect())) == whole


def test_mixed_documents(docs):
    size = lambda r: len(brute.WORD.findall(r["text"] or ""))
    given, sizes = docs.collect(), {}
    for r in given:
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r)
    want, words = brute.targets(sizes), {}
    for r in (rows := mixing.mixed_documents(docs).collect()):
        words[r["source"]] = words.get(r["source"], 0) + size(r)
    longest = max(map(size, given))
    assert all(want[s] - 0.5 <= words[s] <= want[s] + longest for s in want)
    # Repeated rows and one without an id are documents of their own: taken, but three times each at most.
    assert all(rows.count(r) <= 3 * given.count(r) for r in rows) and set(rows) <= set(given)
    full = [r for r in given if size(r) and round(want[r["source"]]) >= sizes[r["source"]]]
    assert full and all(rows.count(r) >= given.count(r) for r in full)


def test_fingerprints(docs, texts, empty):
    rows, got = by_id(fingerprints.edited_fingerprints(docs))
    assert len(rows) == len(texts) + 2
    order = [*range(len(texts) - 1, -1, -1), None]
    text = lambda i: (texts[6] if i is None else texts[i]) or ""
    for here, following in zip(order, order[1:] + order[:1], strict=True):
        x, y = text(here), text(following)
        edited = x[: len(x) - len(x) // 2] + y[: len(x) // 2]
        assert (got[here]["n_chars"], got[here]["edited_sha256"]) == (len(x), brute.sha(edited))
        bits = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
        assert got[here]["near_edited"] == bits(got[here]["fingerprint"], got[here]["edited_fingerprint"])
        assert got[here]["near_next"] == bits(got[here]["fingerprint"], got[following]["fingerprint"])
    assert got[6]["fingerprint"] == got[7]["fingerprint"] == got[None]["fingerprint"] and int(got[0]["fingerprint"], 16) == 0
    assert fingerprints.edited_fingerprints(empty).collect() == []


def test_long_texts_are_counted_in_pieces(spark, monkeypatch):
    df = spark.createDataFrame([(1, " ".join(f"w{i % 900}" for i in range(40_000)))], "id long, x string")
    whole = fingerprints.simhash(df, ["id"], "x").first()["fp"]
    monkeypatch.setattr(fingerprints, "_PIECE", 1000)
    assert fingerprints.simhash(df, ["id"], "x").first()["fp"] == whole


def test_fingerprint_search(spark):
    rnd = random.Random(2)
    values = [rnd.getrandbits(128) for _ in range(60)]
    values += [v ^ sum(1 << b for b in rnd.sample(range(128), k)) for v in values for k in (1, 3, 4, 5)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    pair = lambda v: [signed(v & (1 << 64) - 1), signed(v >> 64)]
    df = spark.createDataFrame([(pair(v),) for v in values], "fp array<long>")
    got = {(tuple(r["query"]), tuple(r["match"])) for r in fingerprints.within(df.limit(30), df, 3).collect()}
    want = {(tuple(pair(a)), tuple(pair(b))) for a in values[:30] for b in values if (a ^ b).bit_count() <= 3}
    assert got == want


def test_quality_rules(docs, texts, empty):
    rows, got = by_id(quality_rules.judge(docs))
    assert len(rows) == len(texts) + 2
    for i, text in enumerate(texts):
        counts = brute.rules(text)
        assert tuple(got[i][c] for c in quality_rules.COUNTS) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert got[i]["base_failed"] == failed and not (failed and got[i]["kept"])
    assert quality_rules.judge(empty).collect() == []


def test_quality_rules_follow_the_group(spark):
    rnd = random.Random(3)
    prose = lambda sign: " ".join(f"w{rnd.randint(0, 10**6)}{sign}" for _ in range(80))
    rows = [(i, prose("" if i % 2 else "#"), "en", "plain" if i % 2 else "code") for i in range(60)]
    rows += [(100, prose("#"), "en", "plain"), (101, prose("###&&&"), "en", "code")]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(60)) and not got[100] and not got[101]


@pytest.fixture(scope="module")
def codec():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return bpe.Codec(bpe.read_ranks(file.read()), public_tokenizers.PATTERN)


def test_bpe_equals_library(docs, texts, codec, empty):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=codec.vocabulary.ranks, special_tokens={})
    rows, got = by_id(bpe.encode_documents(docs, path, pattern))
    assert len(rows) == len(texts) + 2
    for i, text in enumerate(texts):
        assert np.frombuffer(bytes(got[i]["ids"]), "<u4").tolist() == library.encode_ordinary(text or "")
        assert bytes(got[i]["decoded"]) == (text or "").encode()
    assert bpe.encode_documents(empty, path, pattern).collect() == []
    rnd = random.Random(4)
    signs = ["a", "the", " ", "\n", "\t", "\x1c", "\x85", "　", "é", "漢", "🙂", "1", "²", "Ⅷ", "'s", "!!", "\x00", "ing", "ÀÉ"]
    for _ in range(3000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 14)))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_prefix_table_appends_and_edits(codec):
    rnd, v = random.Random(6), codec.vocabulary
    table = bpe.PrefixTable(v, b"the words of a text ")
    for _ in range(200):
        at = rnd.randint(0, len(table.data))
        removed = min(rnd.randint(0, 5), len(table.data) - at)
        inserted = bytes(rnd.choice(b"aeinorst  ") for _ in range(rnd.randint(0, 9)))
        if rnd.random() < 0.3:
            table.append(inserted)
        else:
            table.edit(at, removed, inserted)
        assert table.last == bpe.PrefixTable(v, table.data).last
        assert b"".join(v.tokens[i] for i in table.ids()) == table.data
    table = bpe.PrefixTable(v, b"stations and other things " * 200)
    assert table.edit(100, 3, b"xyz") < 1000


def test_quality_model(spark, empty):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abdeghiklmnorstu") for _ in range(rnd.randint(2, 8)))
    good = [". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(rnd.randint(3, 12))) + "." for _ in range(200)]
    bad = [" ".join(w + "###" for w in g.split()) for g in good[:25]] + [g.upper().replace(".", "!!") for g in good[25:50]]
    rows = [(i, t, i) for i, t in enumerate([*good, *bad, None, ""])]
    got = {r["doc_id"]: r["kept"] for r in quality_model.classify(spark.createDataFrame(rows, "doc_id long, text string, score long")).collect()}
    assert sum(got[i] for i in range(200)) >= 196 and sum(got[i] for i in range(200, 250)) <= 2 and len(got) == 252
    assert quality_model.classify(empty).collect() == []


def test_estimate_finds_accuracies():
    rnd = np.random.default_rng(1)
    truth = rnd.random(20_000) < 0.7
    right = np.array([0.95, 0.8, 0.6])
    votes = np.where(rnd.random((20_000, 3)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    good, table = quality_model.estimate(patterns, counts.astype(float))
    assert table[1, :, 2] == pytest.approx(right, abs=0.08)


def _repeats(texts):
    texts = [(t or "").encode() for t in texts]
    seen = {}
    for t in texts:
        for i in range(len(t) - 399):
            seen[t[i : i + 400]] = seen.get(t[i : i + 400], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - 399):
            if seen[t[i : i + 400]] > 1:
                gone[i + 1 : i + 401] = True
        kept = bytes(b for b, g in zip(t, gone[1:], strict=False) if not g)
        out.append((len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), brute.sha(kept)))
    return out


@pytest.mark.parametrize("hot", [50_000, 1])
def test_repeats(docs, texts, empty, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows, got = by_id(repeats.digest(repeats.remove_repeats(docs)))
    assert len(rows) == len(texts) + 2
    want = _repeats([*texts, texts[6], texts[17]])
    for i in range(len(texts)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == want[i], i
    assert repeats.digest(repeats.remove_repeats(empty)).collect() == []


def test_induced_order_in_small_chunks(docs, texts, monkeypatch):
    monkeypatch.setattr(repeats, "_CHUNK", 2)
    monkeypatch.setattr(repeats, "_PIECE", 64)
    places, values = repeats.anchors(texts[5].encode())
    monkeypatch.setattr(repeats, "_PIECE", 1 << 18)
    again = repeats.anchors(texts[5].encode())
    assert places.tolist() == again[0].tolist() and values.tolist() == again[1].tolist()


def test_near_duplicates(docs, texts, empty):
    rows, got = by_id(near_dup.near_duplicates(docs))
    assert len(rows) == len(texts) + 2
    fp = {i: brute.simhash(t or "") for i, t in enumerate(texts)}
    links = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3]
    want = brute.classes(links, fp)
    for i in fp:
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{fp[i]:016x}", want[i])
    assert got[None]["component_id"] == want[6]
    assert near_dup.near_duplicates(empty).collect() == []


def test_one_row_stays_of_each_group(docs, texts):
    got = near_dup.one_per_group(docs).collect()
    fp = {i: brute.simhash(t or "") for i, t in enumerate(texts)}
    links = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3]
    assert sorted(r["doc_id"] for r in got) == sorted(set(brute.classes(links, fp).values()))
    assert set(got) <= set(docs.collect()) and got[0].__fields__ == docs.columns
    alone = docs.where("doc_id is null")
    assert near_dup.one_per_group(alone.unionByName(alone)).collect() == alone.collect()


def test_covering_tables_lose_no_link(spark):
    rnd = random.Random(9)
    values = [rnd.getrandbits(64) for _ in range(80)]
    values += [v ^ sum(1 << b for b in rnd.sample(range(64), k)) for v in values for k in (1, 2, 3, 4)]
    values = sorted(set(values))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    want = brute.classes([(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3], values)
    for bucket in (1024, 2):
        found = [(r["a"] % 2**64, r["b"] % 2**64) for r in near_dup.links(df, bucket=bucket).collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in found)
        assert brute.classes(found, values) == want


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 560)] + [(rnd.randint(1000, 1400), rnd.randint(1000, 1400)) for _ in range(300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert got == brute.classes([e for e in edges if e[0] != e[1]], nodes)


def test_url_filter(spark):
    fixed = [
        (1, "http://A.Example.org/es/x?q#z", "a.example.org", "/es/x", "example.org/es/", "block"),
        (2, "https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        (3, "http://x.org", "x.org", "", None, None), (4, "http://notorg/fr/", "notorg", "/fr/", None, None),
        (5, "x://a.com/fr/1?u=http://b.com/de/", "a.com", "/fr/1", "com/fr/", "allow"), (6, "no scheme", "", "", None, None),
        (7, None, "", "", None, None), (8, "", "", "", None, None), (9, "p://h.org/a\nb", "h.org", "/a\nb", "org/", "allow"),
    ]
    rnd = random.Random(3)
    name = lambda signs: "".join(rnd.choice(signs) for _ in range(6))
    more = [(100 + i, f"http://{name('abcde')}.org/a/{name('abcde')}") for i in range(150)] + [(300 + i, f"http://{name('vwxyz')}.com/de/{name('vwxyz')}") for i in range(150)]
    more += [(500, "http://abcab.net/a/bcade"), (501, "http://zyxvw.net/de/wxyzv")]
    df = spark.createDataFrame([(r[0], r[1], "extra") for r in fixed] + [(*r, "extra") for r in more], "page_id long, url string, rule string")
    got = {r["page_id"]: r for r in url_filter.judge(df).collect()}
    assert len(got) == len(fixed) + len(more)
    for page, _, host, path, rule, verdict in fixed:
        r = got[page]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or r["verdict"])
    assert got[500]["verdict"] == "allow" and got[501]["verdict"] == "block"
    assert url_filter.judge(df.where("1 = 0")).collect() == []
    assert {r["verdict"] for r in url_filter.judge(df.where("page_id in (3, 4)")).collect()} == {"allow"}


def test_log_ratios_are_those_of_a_dictionary_model(spark):
    """Exact counts of more than 65 536 strings, held against models in plain dictionaries."""
    rnd = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789/-é"
    seen = [("http://x.org/" + "".join(rnd.choices(letters[: 12 if i % 2 else 39], k=rnd.randint(0, 90))), i % 2 == 0) for i in range(1500)]
    examples = [(u, a, 1 + i % 3) for i, (u, a) in enumerate(seen)]
    models = [defaultdict(int), defaultdict(int)]
    for url, accepted, n in examples:
        data = b"\0" * 4 + url.encode()
        for i in range(4, len(data)):
            for order in range(url_filter.ORDERS):
                models[accepted]["J", data[i - order : i + 1]] += n
                models[accepted]["C", order, data[i - order : i]] += n
    assert sum(len(m) for m in models) > 65_536

    def ratio(url):
        data, total = b"\0" * 4 + url.encode(), 0.0
        for i in range(4, len(data)):
            logs = []
            for model in models:
                p = 1 / 256
                for order in range(url_filter.ORDERS):
                    p = (model["J", data[i - order : i + 1]] + 2.0 * p) / (model["C", order, data[i - order : i]] + 2.0)
                assert 0 < p < 1
                logs.append(math.log(p))
            total += logs[1] - logs[0]
        return total / max(1, len(data) - 4)

    asked = ["", "q", "http://x.org/", "http://y.com/never/seen", seen[0][0], seen[1][0], "é" * 9, "a" * 30000]
    counts = url_filter.count_strings(spark.createDataFrame(examples, "url string, accepted boolean, n long").repartition(4))
    got = {r["url"]: r["log_ratio"] for r in url_filter.log_ratios(spark.createDataFrame([(u,) for u in asked], "url string"), counts).collect()}
    assert got == pytest.approx({u: ratio(u) for u in asked}, abs=1e-7)


def test_url_filter_of_repeated_and_long_rows(spark):
    rows = [(None if i % 4 == 0 else i % 50, f"https://a.{['org', 'com'][i % 2]}/{['x', 'de'][i % 2]}/{i % 70}", "h") for i in range(700)]
    rows += [(1, "ftp://open.net/" + "x" * 200_000, "h"), (1, None, None), (1, None, "h"), *[(7, "https://b.net/x/1", "h")] * 300]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("gram", F.lit("g")).withColumn("key", F.lit(1))
    got = url_filter.judge(df).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, url_filter.judge(df.repartition(7)).collect()))
    assert {r["log_ratio"] for r in got if r["host"] == ""} == {0.0}
    assert len({(r["verdict"], r["log_ratio"]) for r in got if r["host"] == "b.net"}) == 1


def test_toxicity(spark, empty):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abdeghiklmnorstu") for _ in range(rnd.randint(2, 9)))
    rows, labels = [], []
    for i in range(600):
        words, toxic = [word() for _ in range(rnd.randint(20, 90))], i % 5 == 0
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(["pathetic", "worthless", "disgusting"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    clean = " ".join(word() for _ in range(40))
    rows += [(1000, clean + " you are p-a-thetic"), (1001, clean + " WRTHLESS!! " + clean), (1002, clean), (1003, None), (1004, ""), (1005, "d i s g u s t i n g man"), (1006, clean + " worthxless")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    train = spark.createDataFrame([x for x in labels if zlib.crc32(str(x[0]).encode()) % 5] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, train).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == y for i, y in held]) > 0.95
    assert [got[i] >= 0.5 for i in range(1000, 1006)] == [True, True, False, False, False, True]
    # A strange letter within a word costs more, but lifts the text above all clean ones.
    assert got[1006] > max(got[i] for i, y in labels if not y)
    assert toxicity.score(empty, train).collect() == []
    assert {r["score"] < 1e-9 for r in toxicity.score(df, train.limit(0)).collect()} == {True}


def test_inserted_letters_do_not_hide_an_insult(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abdeghiklmnorstu") for _ in range(rnd.randint(2, 9)))
    rows = []
    for i in range(600):
        words = [word() for _ in range(rnd.randint(20, 90))]
        rows.append((i, " ".join([*words, *([rnd.choice(["pathetic", "worthless", "disgusting", "oaf"])] if i % 5 == 0 else [])])))
    clean = " ".join(word() for _ in range(40))
    hidden = [clean + " WORTHXLESS!! " + clean, clean + " worthxless", "you pathetixc " + clean, clean + " OAF", clean]
    df = spark.createDataFrame(rows + list(enumerate(hidden, 1000)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.score(df, labels).collect()}
    assert [got[i] for i in range(1000, 1005)] == [True, True, True, True, False]
    assert sum(got[i] for i in range(600) if i % 5) <= 5


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abdeghiklmnorstu") for _ in range(rnd.randint(2, 8)))
    prose = lambda: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(8)) + "."
    good = [prose() for _ in range(60)]
    texts = [*good, *good[:5], *(" ".join(w + "###" for w in prose().split()) for _ in range(15)), good[7] + " secret = " + KEY]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        kept[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == [f.name for f in T._parse_datatype_string(schema)]
    ids = lambda name: {r["doc_id"] for r in kept[name]}
    assert ids("quality") >= set(range(60)) - {0} and not ids("quality") & set(range(65, 80))
    assert not ids("near duplicates") & set(range(60, 65))
    assert all(KEY not in r["text"] for r in kept["secrets"])
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, final.collect())) == sorted(map(str, kept["tokens"]))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_gives_the_same_rows(spark, docs, tmp_path, name):
    docs.drop("kind", "h", "size").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    items = docs.select("doc_id", "text").where("doc_id between 3 and 20").withColumnRenamed("doc_id", "item_id")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    con.execute(f"create view benchmark as select * from '{tmp_path}/benchmark.parquet/*.parquet'")
    want = con.execute(queries.SQL[name])
    names, got = [c[0] for c in want.description], queries.QUERIES[name](spark, str(tmp_path))
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, want.fetchall()))
