from __future__ import annotations

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from millrace.llm import decontam as D
from millrace.llm import queries

symbols = st.lists(st.integers(0, 4), max_size=14)


@given(symbols, symbols)
def test_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    assert D.longest_common_subsequence(a, b) == row[-1]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    common = [f"f{i}" for i in range(30)]
    word = lambda: rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(4000)}"
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, f"{text(rng.randint(14, 50))}. {text(6)}.") for i in range(30)]
    clean = [(i, text(rng.randint(5, 400))) for i in range(200)]
    leaks = []
    for i, (item, t) in enumerate(items):
        body = text(rng.randint(0, 150)).split()
        at = rng.randint(0, len(body))
        if i % 3 == 2:  # a paraphrase: some words of the question exchanged, the answer kept
            head, tail = t.split(". ", 1)
            w = head.split()
            for k in rng.sample(range(len(w)), len(w) // 5):
                w[k] = f"other{k}"
            t = " ".join(w) + ". " + tail
        leaks.append((1000 + i, item, " ".join(body[:at]) + "\n" + (t.upper() if i % 3 == 1 else t) + " " + " ".join(body[at:])))
    docs = [*clean, *((d, t) for d, _, t in leaks), (5000, None), (5001, ""), (None, leaks[0][2]), (1000, leaks[0][2]), (5002, text(30000) + " " + items[3][1])]
    items += [(900, None), (901, ""), (902, "too short"), (None, text(30)), (0, items[0][1])]
    columns = "doc_id long, text string, tid long, codes string, item_id long, lcs double"
    return (
        spark.createDataFrame([(*d, None, None, None, None) for d in docs], columns),
        spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string"),
        {(d, i) for d, i, _ in leaks} | {(None, 0), (5002, 3)},
    )


def test_leaks_and_clean_documents(corpus):
    docs, items, leaks = corpus
    rows = D.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == leaks
    assert sum(r.doc_id == 1000 for r in rows) == 2  # a repeated row is found twice
    kept = D.without_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len(leaks) - 1


def test_blocks_of_the_benchmark(corpus, monkeypatch):
    docs, items, leaks = corpus
    monkeypatch.setattr(D, "BLOCK_BYTES", 3000)
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()} == leaks


def test_nothing_to_find(corpus):
    docs, items, _ = corpus
    assert D.contaminated(docs.filter("false"), items).count() == 0
    assert D.contaminated(docs, items.filter("false")).count() == 0
    assert D.without_contaminated(docs, items.filter("item_id = 900")).count() == docs.count()


def test_query_finds_the_verbatim_items(spark):
    sf = "/root/testdata/sf0.01"
    plain = lambda t: b" ".join(D.words_of(t))
    docs = [(r.doc_id, b" " + plain(r.text) + b" ") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, b" " + plain(r.text) + b" ") for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, x in items if x in t}
    assert want and {(r.doc_id, r.item_id) for r in queries.op6_benchmark_decontamination(spark, sf).collect()} == want


def test_short_item_wherever_it_starts(spark):
    rng = random.Random(8)
    text = lambda n, kind="w": [f"{kind}{rng.randrange(9000)}" for _ in range(n)]
    items = {n: text(n, "i") for n in (6, 7, 8, 11)}
    docs = [(100 * n + at, " ".join([*text(48 + at), *item, *text(60)])) for n, item in items.items() for at in range(16)]
    docs += [(5000 + k, " ".join(text(100))) for k in range(50)]
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(n, " ".join(i)) for n, i in items.items()], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(100 * n + at, n) for n in items for at in range(16)}


def test_items_of_few_words(spark):
    items = [(1, "東京は日本の首都です。富士山は高い。"), (2, "Capital of France?"), (3, "กรุงเทพเป็นเมืองหลวง"), (4, "?!")]
    docs = [(10, "昔、東京は日本の首都です。\n富士山は高い。と言う"), (11, "the CAPITAL of\nFrance, it is"), (12, "the capital of Frances"), (13, "capital of the France"), (14, "ที่กรุงเทพเป็นเมืองหลวงของ"), (15, "東京は日本の首都でした。富士山は高い。"), (16, None), (17, "?!"), (11, "capital of france")]
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.start_word) for r in found.collect()) == [(10, 1, 0), (11, 2, 0), (11, 2, 1), (14, 3, 0)]


def test_clashing_names_and_membership(spark, corpus):
    docs, items, _ = corpus
    odd = docs.select("doc_id", "text").selectExpr("*", "1 as __id", "2 as __tid", "3 as hit_id", "4 as hit_tid")
    kept = D.without_contaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == D.without_contaminated(docs, items).count()
    bench = D.Benchmark.build([(1, "a b c d e f g"), (2, "b c x y z u v w")])
    codes = {w: c for w, c in bench.vocab.items()}
    for k, item in enumerate(bench.items):
        keys = k * (bench.size + 1) + D.np.arange(bench.size + 1)
        assert D._among(bench.members(), keys).tolist() == [c in item.codes for c in range(bench.size + 1)]
    assert codes[b"a"] == 0


def paraphrases(rng, items, share, kind):
    """Each item with a share of its question's words exchanged (or left out, or moved), its answer kept."""
    out = []
    for item_id, text in items:
        head, tail = text.split(". ", 1)
        w = head.split()
        at = rng.sample(range(len(w)), round(share * len(w)))
        if kind == "exchange":
            w = [f"other{rng.randrange(999)}" if i in at else x for i, x in enumerate(w)]
        elif kind == "drop":
            w = [x for i, x in enumerate(w) if i not in at]
        else:
            for i in at:
                w.insert(min(len(w), i + 2), f"more{rng.randrange(999)}")
        out.append((item_id, " ".join(w) + ". " + tail))
    return out


def test_recall_of_paraphrases(spark):
    """Against the verification at every word of every document, without any candidate search."""
    rng = random.Random(12)
    common = [f"f{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(4000)}" for _ in range(n))
    items = [(i, f"{text(rng.randint(12, 60))}. {text(6)}.") for i in range(25)]
    docs, n = [(i, text(rng.randint(20, 300))) for i in range(60)], 1000
    for share in (0.1, 0.2, 0.3):
        for kind in ("exchange", "drop", "insert"):
            for _, t in paraphrases(rng, items, share, kind):
                docs.append((n, f"{text(rng.randint(0, 120))} {t} {text(rng.randint(0, 120))}"))
                n += 1
    bench = D.Benchmark.build(items)
    want = set()
    for doc_id, t in docs:
        codes = D.np.array([bench.vocab.get(w, bench.size) for w in D.words_of(t)], D.np.int64)
        for item in bench.items:
            for at in range(-8, len(codes), 4):
                _, ratio, answer = D._verify(codes, at, item)
                if ratio >= D.SURE or ratio >= D.LIKELY and answer >= D.LIKELY:
                    want.add((doc_id, item.id))
                    break
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    print(f"paraphrases by brute force {len(want)}, found {len(got & want)}, beyond {len(got - want)}")
    assert len(want) > 180 and got <= want and len(got) >= 0.97 * len(want)
