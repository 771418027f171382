"""Hard negatives, the filter audit and word BPE against brute force, the encoding library, and on odd rows."""

import hashlib
import itertools
import random
from array import array

import duckdb
import numpy as np
import pytest
from check_oracles import compare
from tokenizers import Tokenizer

from caseloom.llm import adscan, filteraudit, mixing, ordinal, wordbpe, zonemine

from .conftest import ODD

VECTORS = "vec_id long, embedding array<float>, label int"


def mined(rows):
    """Hard negatives by the definition; one row for each id."""
    kept = {}
    for i, v, label in sorted((r for r in rows if None not in r and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: (r[0], r[2], r[1])):
        kept.setdefault(i, ([int(np.floor(256 * np.float64(np.float32(x)))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (v, label) in kept.items():
        if a % 50 == 0:
            all_rows = sorted((-score(v, w), i, other) for i, (w, other) in kept.items() if i != a)
            for p, i, _ in [r for r in all_rows if r[2] == label][:5]:
                found = [(j, -n) for n, j, other in all_rows if other != label and 50 * -p <= 100 * -n <= 95 * -p][:3]
                out += [(a, i, k, j, -p, n) for k, (j, n) in enumerate(found, 1)]
    return sorted(out)


def found(frame):
    return sorted(map(tuple, zonemine.op11_zone_mining(frame).collect()))


@pytest.mark.parametrize("seed,labels,centres", [(1, 3, 1), (2, 2, 40), (3, 1000, 5)])
def test_hard_negatives(spark, monkeypatch, seed, labels, centres):
    monkeypatch.setattr(zonemine, "BLOCK_ROWS", 16)
    monkeypatch.setattr(zonemine, "ROUND_BYTES", 150)
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(size=(centres, 6))
    rows = [(k, (middle[k % centres] + 0.2 * rnd.normal(size=6)).tolist(), int(rnd.integers(labels))) for k in range(180)]
    rows += [(1000 + k, rows[5][1], 1) for k in range(60)]  # one vector many times: ties
    assert found(spark.createDataFrame(rows, VECTORS).repartition(3)) == mined(rows)


def test_blocks_are_skipped(spark):
    """Far clusters: an anchor's windows meet few zones."""
    rnd = np.random.default_rng(4)
    middle = np.eye(8)[np.arange(4000) % 8] * 3
    v = middle + 0.1 * rnd.normal(size=middle.shape)
    rows = [(k, v[k].tolist(), int(k // 8 % 2)) for k in range(4000)]
    frame = spark.createDataFrame(rows, VECTORS)
    table = zonemine.block_table(zonemine.usable(frame, "vec_id", "embedding", "label"), 4000, 8, 256.0)
    zones = [r | {k: np.frombuffer(r[k], "f8") for k in ("lo", "hi")} for r in table.select("size", "label_lo", "label_hi", "lo", "hi").toArrow().to_pylist()]
    anchor = np.floor(256 * v[:1])
    one = np.ones((1, 1), np.int64)
    windows = zonemine.Windows(one[0], one[0], anchor, one, one, one * 300_000, one * 10**6, 3, False)
    read = sum(z["size"] for z in zones if windows.wanted(z).any())
    assert 0 < read <= 2000 and sum(z["size"] for z in zones) == 4000


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        places = zonemine.hilbert_places(cells, bits)
        assert sorted(places) == list(range(len(cells)))
        assert set(np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(1)) == {1}


def test_odd_vectors(spark):
    rows = [(50, [1.0, 0.5], 1), (50, [1.0, 0.5], 1), (50, [2.0, 0.5], 1), (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 2), (4, [1.0, 1.0], None),
            (5, [1.0], 1), (6, [0.8, 0.1, 9.0], 2), (8, [], 2), (9, [0.7, 0.1], 2), (-50, [1e30, 1.0], 2), (10, [1e30, 0.0], 2), (11, [5e29, 0.0], 1), (12, [0.75, 0.0], 2)]
    plain = [r for r in rows if r[0] is None or 0 <= r[0] < 10 or r[0] in (12, 50)]
    assert found(spark.createDataFrame(plain, VECTORS)) == mined(plain) != []
    capped = found(spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS score", "2 AS block", "3 AS shelf"))
    assert (-50, 10, 1) == capped[0][:3] if capped and capped[0][0] == -50 else all(r[0] == 50 for r in capped)
    assert found(spark.createDataFrame([], VECTORS)) == []
    assert found(spark.createDataFrame([(1, [1.0], 1)], VECTORS)) == []
    assert found(spark.createDataFrame([(50, [], 1), (51, [], 2), (52, [], 1)], VECTORS)) == mined([(50, [], 1), (51, [], 2), (52, [], 1)])


def duck(docs, labels):
    connection = duckdb.connect()
    for name, frame in (("documents", docs), ("labels", labels)):
        connection.register(name, frame.toArrow())
    return connection


def audited(docs, labels):
    """The audit by the definition."""
    texts = [(d, part or "", text or "") for d, text, part in docs]
    good, toxic = ({r[0] for r in labels if r[0] is not None and r[k] == 1} for k in (1, 2))
    marked = []
    for d, part, text in texts:
        words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
                 "E": d is not None and any(e is not None and e < d and text == other for e, _, other in texts)}
        marked.append((part, {f for f in fails if fails[f]}, d in good, d in toxic))
    out = []
    for part in {p for p, *_ in marked}:
        own, removed = [m for m in marked if m[0] == part], {}
        rows = []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                removed[f] = removed.get(f, 0) + len(gone)
                rows.append((part, "".join(order), step, len(left), len(gone), sum(f in m[1] for m in own) - len(gone), sum(m[1] == {f} for m in own), sum(m[2] for m in gone), sum(m[3] for m in gone), f))
        out += [(*r[:-1], removed[r[-1]]) for r in rows]
    return sorted(out)


def test_filter_audit(spark):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice(["a", "b", "Cc", "d%", "é"]) + str(rnd.randrange(n)) for _ in range(rnd.choice([3, 199, 200, 260]))) for n in [5, 90, 400] * 5] + ["", " \t", "ABC", None, "x\x0by\x1cz"]
    docs = [(rnd.choice([None, *range(150)]), rnd.choice(base), rnd.choice(["en", "de", "", None])) for _ in range(220)]
    docs += [docs[0], docs[0]]
    labels = [(rnd.randrange(150), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(120)] + [(None, 1, 1)]
    frames = spark.createDataFrame(docs, "doc_id long, text string, lang string").selectExpr("*", "1 AS part", "2 AS mask", "'x' AS same").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, filteraudit.op12_filter_audit(*frames).collect())) == audited(docs, labels)
    assert compare(filteraudit.op12_filter_audit(*frames).toArrow(), duck(frames[0].drop("part", "mask", "same"), frames[1]).sql(filteraudit.ORACLE).to_arrow_table()) == ""
    assert filteraudit.op12_filter_audit(frames[0].limit(0), frames[1]).count() == 0
    assert filteraudit.op12_filter_audit(frames[0], frames[1].limit(0)).count() == 600 * 3


def test_word_bpe_equals_the_library(spark, odd):
    library = Tokenizer.from_file(wordbpe.default_vocabulary())
    rnd = random.Random(8)
    signs = [*"ab'sStrevmld 1!?\n\t  éÉÅΣσİ中ß", "̊", "́", "\U0001f600", "<|endoftext|>", "<|startoftext|>", "<|", "'ll", "x" * 40, chr(0x1C89), chr(0x558), chr(0x10D50), chr(0x323B0)]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(60))) for _ in range(800)]
    texts += [None, "", "  ", "ab" * 700, "".join(rnd.choice("abcdefghijklmnoprstu") for _ in range(3000)), "é" * 90, ("long text " * 30_000) + "z" * 300, " é" * 150_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    expected = {d: library.encode(t or "", add_special_tokens=False).ids for d, t in enumerate(texts)}
    got = {r["doc_id"]: r for r in wordbpe.op13_word_bpe(spark, frame).collect()}
    for d, ids in expected.items():
        text = library.decode(ids, skip_special_tokens=False)
        assert (got[d]["n_tokens"], got[d]["ids_sha256"], got[d]["decoded_sha256"]) == (len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    encoded = wordbpe.encode(frame, wordbpe.default_vocabulary())
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == expected
    assert {r["doc_id"]: r["text"] for r in wordbpe.decode(encoded, wordbpe.default_vocabulary()).collect()} == {d: library.decode(i, skip_special_tokens=False) for d, i in expected.items()}


def test_word_bpe_odd_rows(spark, odd, none):
    got = wordbpe.encode(odd, wordbpe.default_vocabulary())
    assert got.columns == [c for c in odd.columns if c not in ("text", "n_tokens")] + ["n_tokens", "ids"]
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(r[0]) for r in ODD)
    assert wordbpe.op13_word_bpe(spark, none).count() == 0
    model = wordbpe.Model(open(wordbpe.default_vocabulary(), "rb").read())
    for n in (2, 63, 64, 65):
        word = ("abcé" * n)[:n].encode()
        parts = [*(model.inner[x] for x in word[:-1]), model.last[word[-1]]]
        assert model.by_scan([*parts]) == model.by_heap([*parts])


def test_words_are_forgotten(spark, monkeypatch):
    monkeypatch.setattr(wordbpe, "MOST_WORDS", 3)
    model = wordbpe.Model(open(wordbpe.default_vocabulary(), "rb").read())
    fresh = wordbpe.Model(open(wordbpe.default_vocabulary(), "rb").read())
    for text in ("one two three four five six one two", "six five one seven"):
        whole = [x for word in text.split(" ") for x in fresh.merged(word.encode())]
        assert array("I", b"".join(x for x, _ in model.encode(text))).tolist() == whole
    assert len(model.known) <= 3 and len(model.older) <= 3


def test_mixing_of_documents_without_ids(spark):
    """A source whose documents share one id is mixed like any other."""
    docs = [(k, " ".join(["w"] * 20), "a") for k in range(100)] + [(None, f"word{k}", "b") for k in range(1000)]
    found = mixing.op6_mixing(spark.createDataFrame(docs, "doc_id long, text string, source string")).where("doc_id IS NULL")
    row = found.selectExpr("max(target) AS target", "sum(taken) AS taken", "max(taken - 3 * size) AS over").first()
    assert abs(row["target"] - row["taken"]) <= 1 and row["over"] <= 0


def test_repeated_vectors(spark):
    rnd = np.random.default_rng(2)
    rows = [(k, rnd.normal(size=4).tolist()) for k in range(71, 100)]
    rows += [(100, rnd.normal(size=4).tolist())] * 2 + rows[:5]
    found = [r["vec_id"] for r in adscan.op3_adscan(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).where("query_id = 100").orderBy("rank").collect()]
    query = rows[29][1]
    best = sorted((sum((x - y) ** 2 for x, y in zip(v, query)), k) for k, v in dict(rows[:29]).items())
    assert found == [k for _, k in best[:10]]


def test_one_text_for_a_rated_id(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(2, "other")], "doc_id long, text string")
    ratings = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert sorted(r["doc_id"] for r in ordinal.rated_sample(docs, ratings, 2).collect()) == [1, 2]
