"""Operators against brute force on small tables."""

import collections
import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from caseloom.llm import adscan, bagminhash, bpe, gearchunks, imatch, mixing, ordinal, ppm, prefixfree, templates

from .conftest import SCHEMA, words

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(3).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def made(spark, seed=5):
    """Texts with copies, edits, a shared passage and repetitions."""
    rnd = random.Random(seed)
    stems = ["the", "of", "and", "tion", "ère", "xyz", "qua"]

    def text(n):
        return " ".join(rnd.choice(stems) + rnd.choice(stems) for _ in range(n))

    base, passage, rows = [text(rnd.randint(0, 80)) for _ in range(40)], text(40), []
    for k in range(120):
        chance, t = rnd.random(), rnd.choice(base)
        if chance < 0.2:
            t = t[: len(t) // 2] + passage + t[len(t) // 2 :]
        elif chance < 0.4:
            t = text(20) + rnd.choice(base)[5:] + text(10)
        elif chance < 0.5:
            t = " ".join("CHANGED" if j == 9 else w for j, w in enumerate(t.split(" ")))
        elif chance < 0.6:
            t = text(60)
        rows.append((k, t))
    rows += [(200, "a" * 500), (201, "b" * 99 + "a" * 150), (202, "ab" * 200), (203, ""), (204, "abc" * 40 + "x" + "abc" * 60), (205, "a" * 100), (206, "abcdefg" * 50)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def repeated_bytes(rows, size):
    first, out = {}, {}
    for d, t in sorted(rows):
        raw = t.encode()
        for k in range(len(raw) - size + 1):
            first.setdefault(raw[k : k + size], (d, k))
    for d, t in rows:
        raw = t.encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - size + 1):
            if first[raw[k : k + size]] < (d, k):
                gone[k : k + size] = b"\1" * size
        kept = bytes(x for x, y in zip(raw, gone, strict=True) if not y)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[d] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("size", "many"), [(100, 4096), (100, 3), (24, 4096)])
def test_repeated_strings(spark, monkeypatch, size, many):
    monkeypatch.setattr(prefixfree, "MANY", many)
    rows, frame = made(spark)
    found = {r[0]: tuple(r)[1:5] for r in prefixfree.dedup(frame, size, texts=False).collect()}
    assert found == repeated_bytes(rows, size)


def test_repeated_strings_of_the_table(docs, texts):
    found = {r[0]: tuple(r)[1:5] for r in prefixfree.op8_prefix_free(docs).collect()}
    assert found == repeated_bytes(list(texts.items()), 100)


def test_chunks_find_shared_passages_and_survive_insertions(spark):
    rnd = random.Random(2)

    def text(n):
        return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(n))

    passage = text(60)
    rows = [(k, text(rnd.randint(20, 60)) + " " + passage + text(rnd.randint(0, 40))) for k in range(12)] + [(k, text(120)) for k in range(20, 30)]
    found = {r["doc_id"]: r for r in gearchunks.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    exact = repeated_bytes(rows, 100)
    assert found[0]["n_removed"] == 0 and all(found[k]["n_removed"] == 0 for k in range(20, 30))
    for k in range(1, 12):
        assert len(passage) * 0.6 <= found[k]["n_removed"] <= exact[k][1]
    assert all(r["text"] == dict(rows)[d] for d, r in found.items() if not r["n_removed"])


def test_chunks_of_copies(docs, texts):
    found = {r["doc_id"]: r for r in gearchunks.op10_gear_chunks(docs).collect()}
    seen = set()
    for d in sorted(texts):
        if texts[d] in seen and len(texts[d].encode()) >= 100:
            assert found[d]["n_removed"] == len(texts[d].encode())
        seen.add(texts[d])


def plain_ids(tokens, text):
    import regex
    from public_tokenizers import PATTERN

    model = bpe.Merges(tokens)
    return [i for w in regex.findall(PATTERN, text) for i in model.plain(w.encode())]


def test_bpe_matches_the_library(spark, docs, texts):
    import base64

    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.op2_bpe(spark, docs).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    rnd = random.Random(3)
    signs = [*"aab's tre'llve  \n\t12,.!é中  dm'", "'re", "'s", "  ", "aaaa", "\U0001f600", "́"]
    odd = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(1500)] + ["a" * 3000, " " * 50, "\n\n a", "x  ", "'s's're", " 's", "", "ha" * 500]
    frame = bpe.encode(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), path)
    assert all(r["ids"] == library.encode_ordinary(odd[r["doc_id"]]) for r in frame.collect())
    assert all(bytes(r["text"]).decode() == odd[r["doc_id"]] for r in bpe.decode(frame, path).collect())


def test_merges_that_come_up_late():
    # "abc" has a lower rank than "bc" but is only reached after it: words with such merges are done one by one.
    tokens = [bytes([k]) for k in range(256)] + [b"xa", b"abc", b"bc", b"bcd"]
    model = bpe.Merges(tokens)
    data = [b"abcd", b"abc", b"xabc", b"aabcbc", b"bcbc"]
    raw, offsets = np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in data])))
    ids, counts = model.replay(raw, offsets)
    cuts = np.concatenate(([0], np.cumsum(counts)))
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == [model.plain(x) for x in data]


def test_fingerprints(docs, texts):
    found = {r["doc_id"]: r for r in imatch.op1_imatch(docs).collect()}
    order = sorted(texts, reverse=True)
    for place, d in enumerate(order):
        following = texts[order[(place + 1) % len(order)]]
        half = len(texts[d]) // 2
        changed = texts[d][: len(texts[d]) - half] + following[:half]
        assert found[d]["n_chars"] == len(texts[d]) and found[d]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= found[d]["near_next"] <= 1 and 0 <= found[d]["near_edited"] <= 1
    prints = collections.defaultdict(set)
    for d, t in texts.items():
        prints[t].add(found[d]["fingerprint"])
    assert all(len(x) == 1 for x in prints.values()) and len({p for x in prints.values() for p in x}) > 0.97 * len(prints)
    assert np.mean([r["near_edited"] for r in found.values()]) > 10 * np.mean([r["near_next"] for r in found.values()])


def test_lexicon(docs, texts):
    counts = collections.Counter(w for t in texts.values() for w in set(words(t)))
    inside = sum(2 <= n and 0.01 * len(texts) <= n <= 0.1 * len(texts) for n in counts.values())
    assert len(imatch.lexicon(docs, len(texts), 0.01, 0.1)) == inside


def test_byte_model(spark, docs):
    rows = [(r["doc_id"], r["text"][:300]) for r in docs.limit(90).collect()] + [(1000, ""), (1001, "  \n"), (1002, "\0a b"), (1003, "ÀÉ Zß 中")]
    found = {r[0]: tuple(r)[1:] for r in ppm.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    trie, single = collections.defaultdict(collections.Counter), collections.Counter()

    def stream(t):
        return b"\0" * ppm.ORDER + b"".join(w.encode() + b" " for w in words(t)) + b"\n"

    for d, t in rows:
        if not ppm.is_held_out(d):
            raw = stream(t)
            for k in range(ppm.ORDER, len(raw)):
                for size in range(ppm.ORDER + 1):
                    trie[raw[k - size : k]][raw[k]] += 1
            single.update([*words(t), None])

    def log10(context, byte):
        out, ruled_out = 0.0, set()
        for size in range(ppm.ORDER, -1, -1):
            followers = trie.get(context[ppm.ORDER - size :])
            if not followers:
                continue
            left = {b: n for b, n in followers.items() if b not in ruled_out}
            total = sum(left.values())
            if byte in left:
                return out + math.log10((left[byte] - 0.5) / total)
            if left:
                out += math.log10(0.5 * len(left) / total)
            ruled_out |= set(followers)
        return out - math.log10(256 - len(ruled_out))

    n, v = sum(single.values()), len(single)
    for d, t in rows:
        raw, tokens = stream(t), [*words(t), None]
        assert found[d][:4] == (ppm.is_held_out(d), len(tokens), sum(single[w] > 0 for w in tokens), n)
        assert found[d][4] == pytest.approx(sum(math.log10((single[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens))
        assert found[d][5] == pytest.approx(sum(log10(raw[k - ppm.ORDER : k], raw[k]) for k in range(ppm.ORDER, len(raw))))
    # Predictions after one context add up to one.
    table = np.zeros((256, 256), np.int64)
    rnd = np.random.default_rng(1)
    sample = rnd.integers(97, 101, 400)
    np.add.at(table, (sample[:-1], sample[1:]), 1)
    data = ppm.grams_of(sample.astype(np.uint8))[ppm.ORDER :]
    seen, times = np.unique(data, return_counts=True)
    context = int(seen[0]) >> 8
    every = np.unique(np.concatenate((seen[(seen >> np.uint64(8)) & np.uint64(0xFFFF) == np.uint64(context & 0xFFFF)], np.uint64(context << 8) + np.arange(256, dtype=np.uint64))))
    weight = np.where(np.isin(every, seen), times[np.minimum(np.searchsorted(seen, every), len(seen) - 1)], 0)
    logs = ppm.log_probabilities(every, weight, table)
    assert (10 ** logs[every >> np.uint64(8) == context]).sum() == pytest.approx(1, abs=0.02)


def multiset(text):
    w = words(text)
    return collections.Counter([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])


def classes(rows):
    sets, root = [multiset(t) for _, t in rows], list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = sum((sets[a] & sets[b]).values())
            every = sum((sets[a] | sets[b]).values())
            if not every or both / every >= 0.8:
                root[find(a)] = find(b)
    smallest = {}
    for k, (d, _) in enumerate(rows):
        smallest[find(k)] = min(d, smallest.get(find(k), d))
    return {d: smallest[find(k)] for k, (d, _) in enumerate(rows)}


def test_near_copies(spark):
    rnd = random.Random(4)
    stock = [f"w{k}" for k in range(3000)]
    rows, base = [], [rnd.choice(stock) for _ in range(150)]
    for k in range(40):  # near copies of one text; many are less alike among themselves than to the text
        copy = list(base)
        for _ in range(rnd.randint(0, 3)):
            copy[rnd.randrange(150)] = rnd.choice(stock)
        rows.append((k, " ".join(copy)))
    rows += [(100 + k, " ".join(rnd.choice(stock) for _ in range(rnd.randint(0, 60)))) for k in range(40)]
    rows += [(200, "a b c d e " * 50), (201, "a b c d e " * 45), (202, "a b c d e " * 20), (203, "one"), (204, "One"), (205, "one two")]
    found = {r["doc_id"]: r for r in bagminhash.op9_bagminhash(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert {d: r["class_id"] for d, r in found.items()} == classes(rows)
    assert all(r["keep"] == (r["class_id"] == d) for d, r in found.items())


def test_stragglers_and_members_meet_once_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK_MEMBERS", 8)
    count = 100
    members = spark.createDataFrame([(1, k) for k in range(count)] + [(2, 0), (2, 1)], "bucket long, content long")
    contents = spark.createDataFrame([(k, 0 if k < 20 else k, b"", b"") for k in range(count)], "content long, root long, signature binary, shingles binary")
    sides = [collections.defaultdict(set) for _ in range(2)]
    for side, frame in zip(sides, bagminhash.straggler_blocks(members, contents), strict=True):
        for r in frame.collect():
            assert r["bucket"] == 1
            side[r["row"], r["block"]].add(r["content"])
    assert all(len(x) <= 4 * 8 for side in sides for x in side.values())  # of 100 members and 80 stragglers
    met = collections.Counter((a, b) for key in sides[0] for a in sides[0][key] for b in sides[1].get(key, ()))
    assert met == {(a, b): 1 for a in range(count) for b in range(20, count)}


def test_near_copies_without_ids(spark):
    rnd = random.Random(5)
    stock = [f"w{k}" for k in range(3000)]
    base = [rnd.choice(stock) for _ in range(150)]
    near, far = [*base[:-1], "changed"], [rnd.choice(stock) for _ in range(150)]
    frame = spark.createDataFrame([(None, " ".join(x)) for x in (base, near, far)], "doc_id long, text string").repartition(2)
    assert [r["links"] for r in bagminhash.op9_bagminhash(frame).orderBy("links").collect()] == [0, 1, 1]
    kept = [r["text"] for r in bagminhash.kept_documents(frame).collect()]
    assert len(kept) == 2 and " ".join(far) in kept


def test_one_row_of_each_class_is_kept(spark):
    text = "one text of more than five words that stands in several rows"
    rows = [(1, text, "en")] * 30 + [(1, text.upper(), "en"), (1, text.replace(" ", "  "), None), (2, text, "en"), (3, "another text with words of its own in it", "en")]
    rows += [(None, "a text without an id that has more than five words", None)] * 4
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = [sorted(map(str, bagminhash.kept_documents(frame.repartition(n)).collect())) for n in (3, 5)]
    assert found[0] == found[1] and sorted(str(r["doc_id"]) for r in bagminhash.kept_documents(frame).collect()) == ["1", "3", "None"]
    assert bagminhash.op9_bagminhash(frame).count() == len(rows)


def test_signatures_are_unbiased():
    rnd, off = np.random.default_rng(1), []
    for _ in range(20):
        one = {int(x): int(rnd.integers(1, 9)) for x in rnd.integers(1, 2**60, 60)}
        two = {x: int(rnd.integers(1, 12)) if rnd.random() < 0.4 else n for x, n in one.items()} | {int(x): 1 for x in rnd.integers(1, 2**60, 10)}
        who = np.repeat([0, 1], [len(one), len(two)])
        signature = bagminhash.signatures(2, who, np.array([*one, *two], np.uint64), np.array([*one.values(), *two.values()]), 1024)
        keys = {*one, *two}
        exact = sum(min(one.get(x, 0), two.get(x, 0)) for x in keys) / sum(max(one.get(x, 0), two.get(x, 0)) for x in keys)
        off.append((signature[0] == signature[1]).mean() - exact)
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.03


def test_query_blocks_are_bounded_and_change_nothing(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    frame = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(rnd.normal(size=(300, 6)))], "vec_id long, embedding array<float>")
    query = frame["vec_id"] % 5 == 0
    whole = sorted(tuple(r) for r in adscan.search(frame, query, 3).collect())
    assert len(whole) == 60 * 3
    monkeypatch.setattr(adscan, "QUERY_ROWS", 10)
    assert sorted(tuple(r) for r in adscan.search(frame, query, 3).collect()) == whole
    assert np.bincount(adscan.query_blocks_of(np.arange(0, 30_000, 5), 6)).max() < 1200


def test_templates(spark):
    rnd = random.Random(6)

    def line(n=8):
        return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))

    rows = []
    for k in range(30):
        body = [line() for _ in range(4)]
        rows.append((k, "\n".join(["Home page of the shared site", *body, f"Page number {k} was printed on paper for user {line(1)}", "All rights reserved"])))
    copied = "\n".join(line() for _ in range(5))
    rows += [(100 + k, copied) for k in range(20)]
    found = {r["doc_id"]: r["text"] for r in templates.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert found[0] == rows[0][1]
    for d, t in rows[1:30]:
        assert found[d].rstrip("\n").split("\n") == t.split("\n")[1:5]
    assert all(found[100 + k] == copied for k in range(20))


def test_templates_of_forms_and_logs(spark):
    rnd = random.Random(8)

    def word():
        return "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))

    def line(n=8):
        return " ".join(word() for _ in range(n))

    forms = [(k, f"Order form of the shop\nName of the person who ordered it : {word()}\nPaid on day {k} of the year") for k in range(40)]
    logs = [(100 + k, f"session opened for the user {word()} by the login service of host {k}") for k in range(40)]
    shared = [line() for _ in range(30)]
    blocks = [(200 + k, "\n".join([*shared, line()])) for k in range(50)]
    rows = forms + logs + blocks
    found = {r["doc_id"]: r["text"] for r in templates.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert all(found[d] == t for d, t in rows if d in (0, 100, 200))
    assert all(found[d] == "" for d, _ in forms[1:] + logs[1:])
    assert all(found[d].strip() == t.split("\n")[-1] for d, t in blocks[1:])


def test_lines_of_few_unrelated_documents(spark):
    rnd = random.Random(9)

    def line(n=8):
        return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))

    rows, shared = [], {}
    for n in range(2, 10):  # a line in n unrelated documents
        shared[n] = line(60 if n % 2 else 6)
        rows += [(10 * n + k, "\n".join([line(), line(), shared[n], line()])) for k in range(n)]
    base = [line() for _ in range(6)]
    near = [(200 + k, "\n".join([*base[:k], line(), *base[k + 1 :]])) for k in range(5)]  # near copies
    short = [(300 + k, "\n".join([line(), "see also", line(), line()])) for k in range(5)]
    rows += near + short + [(400, rows[0][1]), (401, rows[0][1])]  # copies
    found = {r["doc_id"]: r["text"] for r in templates.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for n, text in shared.items():
        for k in range(n):
            assert (text in found[10 * n + k]) == (k == 0) and len(found[10 * n + k].split("\n")) == 3 + (k == 0)
    assert all(found[d] == t for d, t in near + short)
    assert found[400] == found[401] == "\n".join(x for x in rows[0][1].split("\n") if x != shared[2])


def test_mixing(spark):
    rows = [(k, " ".join("w" * (k % 7 + 1)), "en", ["a", "b", None, "c"][k % 4 if k % 9 else 0], 0) for k in range(400)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = mixing.with_taken(frame).collect()
    again = mixing.op6_mixing(frame.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in found) == sorted((r["doc_id"], r["taken"]) for r in again)
    by, mixed = collections.defaultdict(list), collections.Counter()
    for r in found:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    for r in mixing.mixed_documents(frame).collect():
        mixed[r["source"]] += len(words(r["text"]))
    total = sum(r["size"] for r in found)
    assert sum(x[0]["target"] for x in by.values()) == pytest.approx(total)
    for source, x in by.items():
        assert sum(r["taken"] for r in x) == mixed[source] == math.floor(x[0]["target"])
        assert x[0]["target"] <= 3 * x[0]["source_size"]


def test_classifier_on_held_out_ratings(spark):
    docs, ratings = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = ratings.where("doc_id % 5 = 0")
    found = ordinal.op7_ordinal(docs, ratings.where("doc_id % 5 <> 0")).join(held, "doc_id").collect()
    good = [r["keep"] for r in found if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["keep"] for r in found if r["quality"] == 0 or r["toxic"] == 1]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.35


def test_nearest_neighbours(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = adscan.usable(vectors).toArrow()
    ids, points = np.asarray(table["vec_id"]), adscan.matrix(table["embedding"].combine_chunks())
    found = collections.defaultdict(list)
    for r in adscan.op3_adscan(vectors).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for k in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((points - points[k]) ** 2).sum(1))
        distance[k] = np.inf
        best = np.lexsort((ids, distance))[:10]
        mine = found[ids[k]]
        hits += len({d for d, _ in mine} & set(ids[best].tolist()))
        assert len(mine) == 10 and mine == sorted(mine, key=lambda x: (x[1], x[0]))
        assert all(s == pytest.approx(distance[np.flatnonzero(ids == d)[0]], abs=1e-12) for d, s in mine)
    assert hits >= 0.9 * 10 * len(found)


def test_byte_model_merges_a_part_in_slices(monkeypatch):
    """No merge of a part's keys sees more than a fraction of them; the requests are the same for any number of slices."""
    rnd = np.random.default_rng(5)
    texts = ["".join(chr(c) for c in rnd.integers(97, 123, 4000)) for _ in range(20)]
    squeeze = zstandard.ZstdCompressor(level=1)
    part = pa.table({"part": pa.array([0] * 20, pa.int64()), "doc_id": pa.array(range(20), pa.int64()), "tag": pa.array(range(20), pa.int64()), "text": pa.array([squeeze.compress(t.encode()) for t in texts], pa.binary())})

    class Documents:
        def groupBy(self, key):
            return self

        def applyInArrow(self, work, schema):
            return work

    sizes, merged = [], ppm.merged
    monkeypatch.setattr(ppm, "merged", lambda keys, counts: sizes.append(sum(map(len, keys))) or merged(keys, counts))
    monkeypatch.setattr(ppm, "STREAM_BYTES", 8000)
    asked = ppm.requests(Documents(), 64)(part).to_pylist()
    assert max(sizes) < sum(sizes) / 6
    monkeypatch.setattr(ppm, "SLICES", 1)
    key = lambda r: (r["kind"], r["bucket"])
    assert sorted(asked, key=key) == sorted(ppm.requests(Documents(), 64)(part).to_pylist(), key=key)
