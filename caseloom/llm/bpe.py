"""Byte-level BPE by corpus-level merge replay, and decoding.

Each task takes a slice of the corpus, splits it into words (matches of the pattern), and keeps every distinct word once. Over all
words of the slice it builds an inverted index from token pair to the positions where the pair stands, and replays the merges in rank
order: a merge visits just its pair's positions and updates the pairs with the left and right neighbours. Documents then look their
words up. Merges never cross a word, so slices give the same ids as the whole corpus and nothing has to be exchanged; words a task
already knows are not encoded again. All decoded bytes are compared with the texts.

Defined results: a null text is an empty one and has no ids; special tokens are never made; rows are encoded one by one, so repeated
rows, ids and further columns do not matter. A rank file must have all 256 single bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import blocks as B

# Unicode white space. Fixed values.
WHITE_SPACE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
OTHER, LETTER, NUMBER, SPACE = range(4)
SLICE_BYTES = 8 << 20
MOST_WORDS = 3_000_000

_classes: list[np.ndarray] = []
_models: dict[bytes, Merges] = {}


def character_classes() -> np.ndarray:
    """The class of every code point."""
    if not _classes:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        table[list(WHITE_SPACE)] = SPACE
        _classes.append(table)
    return _classes[0]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and where each starts."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    out = lead.copy()
    wide = np.flatnonzero(lead >= 0xC0)
    if len(wide):
        padded = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.int32)
        where, first = at[wide], lead[wide]
        one, two, three = (padded[where + k] & 0x3F for k in (1, 2, 3))
        out[wide] = np.where(first < 0xE0, (first & 0x1F) << 6 | one, np.where(
            first < 0xF0, (first & 0x0F) << 12 | one << 6 | two, np.minimum((first & 0x07) << 18 | one << 12 | two << 6 | three, 0x10FFFF)))
    return out, at


def split_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which the words of all texts start; they leave no byte out.

    The pattern takes contractions, then letters, numbers or other signs with one space before them, then white space; white space
    before a word leaves its last character to the word (a space joins it, any other stands alone)."""
    if not len(data):
        return np.zeros(0, np.int64)
    point, at = code_points(data)
    kind, count = character_classes()[point], len(point)
    first = np.zeros(count + 1, bool)
    first[np.searchsorted(at, offsets[:-1])] = True
    first[count] = True
    start = first.copy()
    start[1:count] |= kind[1:] != kind[:-1]
    # The last character of white space before something else in the same text.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:count])
    start[last] = True
    start[last[point[last] == 32] + 1] = False
    quote = np.flatnonzero((point == 0x27) & start[:count])
    if len(quote):
        follow = np.concatenate((point, [0, 0]))
        ends = np.concatenate((first, [True, True]))
        one, two = np.where(ends[quote + 1], 0, follow[quote + 1]), np.where(ends[quote + 1] | ends[quote + 2], 0, follow[quote + 2])
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for pair in ("re", "ve", "ll"):
            size[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        start[quote + size + 1] = True
    return at[np.flatnonzero(start[:count])]


def read_ranks(content: bytes) -> list[bytes]:
    """The bytes of each token, by rank, from the content of a rank file."""
    found = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in content.splitlines() if line.strip())}
    return [found[k] for k in range(len(found))]


class Merges:
    """The merges of a vocabulary."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.rank = {t: k for k, t in enumerate(tokens)}
        self.single = np.array([self.rank[bytes([k])] for k in range(256)], np.int64)
        pairs = {}
        for rank, token in enumerate(tokens):
            for k in range(1, len(token)):
                left, right = self.rank.get(token[:k]), self.rank.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.keys, self.ranks = np.append(keys, np.int64(1) << 62), np.array([*(pairs[k] for k in keys.tolist()), -1], np.int64)
        data = pa.array(tokens, pa.large_binary())
        self.bytes, self.offsets = B.buffers(data)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, -1 for pairs that never merge."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def plain(self, word: bytes) -> list[int]:
        """One word, merge by merge."""
        if word in self.rank:
            return [self.rank[word]]
        parts = [word[k : k + 1] for k in range(len(word))]
        while True:
            best = min(((r, k) for k in range(len(parts) - 1) if (r := self.rank.get(parts[k] + parts[k + 1])) is not None), default=None)
            if best is None:
                return [self.rank[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def replay(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (spans of ``data``), and the number of ids of each."""
        size, words = len(data), len(offsets) - 1
        token = self.single[data]
        nxt, prv = np.arange(1, size + 1), np.arange(-1, size - 1)
        nxt[offsets[1:] - 1] = -1
        prv[offsets[:-1]] = -1
        current = np.full(size, -1, np.int64)
        inner = np.flatnonzero(nxt >= 0)
        current[inner] = self.pair_ranks(token[inner], token[inner + 1])
        alive = np.ones(size, bool)
        index: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []
        odd: list[np.ndarray] = []

        def insert(ranks: np.ndarray, positions: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for a, b, r in zip(cuts[:-1], cuts[1:], ranks[cuts[:-1]].tolist(), strict=True):
                held = index.get(r)
                if held is None:
                    index[r] = [positions[a:b]]
                    heapq.heappush(waiting, r)
                else:
                    held.append(positions[a:b])

        some = np.flatnonzero(current >= 0)
        if len(some):
            insert(current[some], some)
        while waiting:
            rank = heapq.heappop(waiting)
            lists = index.pop(rank)
            at = np.sort(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            at = at[current[at] == rank]
            if len(at) > 1:
                at = at[np.concatenate(([True], at[1:] != at[:-1]))]
                # Of pairs that overlap (as in aaa) the first, third, ... are merged.
                chained = np.concatenate(([False], nxt[at[:-1]] == at[1:]))
                if chained.any():
                    place = np.arange(len(at))
                    at = at[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            token[at] = rank
            nxt[at] = after
            alive[gone] = False
            current[gone] = -1
            current[at] = -1
            right = after >= 0
            prv[after[right]] = at[right]
            here, there = at[right], after[right]
            before = prv[at]
            left = before >= 0
            lefts, mids = before[left], at[left]
            where = np.concatenate((here, lefts))
            made = self.pair_ranks(token[where], token[np.concatenate((there, mids))])
            current[where] = made
            fresh = made >= 0
            made, where = made[fresh], where[fresh]
            if len(made):
                if made.min() < rank:  # a lower merge became possible late: those words are done one by one
                    odd.append(where[made < rank])
                insert(made, where)
        ids = token[alive]
        owner = B.owners(offsets, np.flatnonzero(alive))
        counts = np.bincount(owner, minlength=words)
        late = set(B.owners(offsets, np.concatenate(odd)).tolist()) if odd else set()
        # A word that is itself a token is that token, even if no order of merges leads to it.
        late |= {k for k in np.flatnonzero(counts > 1).tolist() if data[offsets[k] : offsets[k + 1]].tobytes() in self.rank}
        if late:
            ends = np.cumsum(counts)
            parts, last = [], 0
            for k in sorted(late):
                new = np.array(self.plain(data[offsets[k] : offsets[k + 1]].tobytes()), np.int64)
                parts += [ids[last : ends[k] - counts[k]], new]
                last, counts[k] = ends[k], len(new)
            ids = np.concatenate([*parts, ids[last:]])
        return ids.astype(np.uint32), counts

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and where each id's bytes end."""
        sizes = np.diff(self.offsets)[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.offsets[ids] - (ends - sizes), sizes)
        return self.bytes[at], ends


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of the entries of many slices, one slice after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Words:
    """Ids of the words a task has met, by the words' hashes."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        return np.where(at < len(self.hashes), np.where(self.hashes[np.minimum(at, max(0, len(self.hashes) - 1))] == hashes, at, -1), -1) if len(self.hashes) else np.full(len(hashes), -1)

    def learn(self, hashes: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
        """Distinct new words and their bytes."""
        ids, counts = self.merges.replay(data, offsets)
        order = np.argsort(merged := np.concatenate((self.hashes, hashes)), kind="stable")
        starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(counts) - counts))
        self.hashes, self.starts, self.sizes = merged[order], starts[order], np.concatenate((self.sizes, counts))[order]
        self.ids = np.concatenate((self.ids, ids))


def _model(content: bytes) -> Merges:
    key = hashlib.sha256(content).digest()
    if key not in _models:
        _models.clear()
        _models[key] = Merges(read_ranks(content))
    return _models[key]


def encode_slice(words: Words, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For every block of texts: ids, offsets of the texts in them, decoded bytes, offsets of the texts in those."""
    cut, fresh = [], {}
    if len(words.hashes) > MOST_WORDS:  # only memory depends on it
        words.clear()
    for _, data, offsets in B.blocks(column):
        starts = split_words(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = B.span_hashes(B.prefix_sums(data), starts, ends) if len(starts) else np.zeros(0, np.uint64)
        kinds, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        for k in np.flatnonzero(words.places(kinds) < 0).tolist():
            fresh.setdefault(kinds[k], data[starts[where[k]] : ends[where[k]]])
        cut.append((data, offsets, starts, kinds, back))
    if fresh:
        order = sorted(fresh)
        spans = [fresh[h] for h in order]
        words.learn(np.array(order, np.uint64), np.concatenate(spans), np.concatenate(([0], np.cumsum([len(x) for x in spans]))))
    for data, offsets, starts, kinds, back in cut:
        at = words.places(kinds)[back]
        sizes = words.sizes[at]
        ids = words.ids[spread(words.starts[at], sizes)]
        cuts = np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(starts, offsets)]
        text, ends = words.merges.decode(ids)
        if not np.array_equal(text, data):
            raise ValueError("decoded bytes differ from the text")
        yield ids, cuts, text, np.concatenate(([0], ends))[cuts]


def encode(docs: DataFrame, ranks_path: str, digests: bool = False) -> DataFrame:
    """Adds n_tokens and ids, or with ``digests`` instead of ids their SHA-256 and that of the decoded bytes.

    ``ranks_path`` is a rank file that the driver can read; its content is broadcast (a vocabulary, not data). Columns of these
    names in ``docs`` are replaced. ``text`` itself is dropped."""
    with open(ranks_path, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    made = {"n_tokens": "bigint", **({"ids_sha256": "string", "decoded_sha256": "string"} if digests else {"ids": "array<int>"})}
    others = [c for c in docs.columns if c not in (*made, "text")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others), *(f"{c} {t}" for c, t in made.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(_model(content.value))
        for batch in batches:
            texts = B.as_bytes(batch.column(len(others)))
            offsets = B.buffers(texts)[1]
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
                counts, one, two = [], [], []
                for ids, cuts, text, ends in encode_slice(words, texts[first:last]):
                    counts.append(np.diff(cuts))
                    if digests:
                        raw = memoryview(ids.astype("<u4").tobytes())
                        plain = memoryview(text.tobytes())
                        one += [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                        two += [hashlib.sha256(plain[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                    else:
                        one.append(ids.astype(np.int32))
                sizes = np.concatenate(counts)
                new = [pa.array(sizes.astype(np.int64))]
                if digests:
                    new += [pa.array(one, pa.string()), pa.array(two, pa.string())]
                else:
                    new.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(np.concatenate(one))))
                kept = [batch.column(k).slice(first, last - first) for k in range(len(others))]
                yield pa.RecordBatch.from_arrays([*kept, *new], [*others, *made])
                first = last

    return docs.select(*others, "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds the text of ``ids`` (as bytes in ``text``) in place of the ids; null ids give an empty text."""
    with open(ranks_path, "rb") as file:
        content = encoded.sparkSession.sparkContext.broadcast(file.read())
    others = [c for c in encoded.columns if c not in ("ids", "text")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name in others), "text binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _model(content.value)
        for batch in batches:
            texts = []
            for ids in batch.column(len(others)).to_pylist():
                texts.append(merges.decode(np.array(ids or [], np.int64))[0].tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(others))), pa.array(texts, pa.binary())], [*others, "text"])

    return encoded.select(*others, "ids").mapInArrow(run, schema)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op2_bpe(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return encode(docs.select("doc_id", "text"), default_ranks(), digests=True)
