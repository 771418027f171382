"""BPE over words with an end mark: encoding by a contiguous rank array, and decoding.

A text is cut at special tokens, each piece is put in composed form and lower case, and words are matches of the pattern; white space is
dropped. A word's bytes are its first parts, the last one with the end mark. The merge holds one array of part boundaries and one of the
ranks of neighbouring parts: it scans the ranks for their minimum (the first of equals), deletes the boundary there and refreshes the two
ranks beside it, until no pair has a rank. Words of more than SHORT parts (a scan per merge would be quadratic) take the same minimum from a
heap over linked parts. Each task merges a distinct word once while it remembers it.

Nothing is shuffled; a row's result depends on its text alone. Long texts are handled in pieces that end before a space, so memory is
bounded by the longest run without a space. The vocabulary file (not data) is broadcast.

Defined results: a null text is an empty one and has no ids; special tokens in a text become their ids; rows are encoded one by one, so
repeated rows, ids and further columns do not matter. Decoding joins the tokens with spaces, end marks included, as the vocabulary's file
names no decoder; null ids give an empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Regex, normalizers

from . import blocks as B

SHORT = 64
PIECE = 1 << 18
MOST_WORDS = 200_000
# Bytes that stand for themselves in the vocabulary; the others follow, in order, from code point 256 on. Fixed values.
PLAIN = (*range(33, 127), *range(161, 173), *range(174, 256))
END = "</w>"

_models: dict[bytes, Model] = {}


def byte_letters() -> list[str]:
    """The character by which the vocabulary spells each byte."""
    others = [k for k in range(256) if k not in PLAIN]
    spelt = {k: chr(k) for k in PLAIN} | {k: chr(256 + n) for n, k in enumerate(others)}
    return [spelt[k] for k in range(256)]


def ranges(points: list[int]) -> str:
    """Code points in order, as the inside of a character set."""
    starts = [c for k, c in enumerate(points) if not k or points[k - 1] != c - 1]
    ends = [c for k, c in enumerate(points) if k + 1 == len(points) or points[k + 1] != c + 1]
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in zip(starts, ends, strict=True)) or r"\U0010ffff"


def young_letters() -> tuple[list[int], str, dict[int, str]]:
    """Letters and numbers that are younger than the standard character tables: all, those that the encoding library takes for signs, and
    lower cases. The libraries here follow different editions of Unicode; the encoding library's classes count."""
    letter = regex.compile(r"[\p{L}\p{N}]")
    young = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn" and letter.match(chr(c))]
    signs = normalizers.Replace(Regex(r"[\p{L}\p{N}]"), "").normalize_str("".join(map(chr, young)))
    lower = {c: x for c in young if (x := normalizers.Lowercase().normalize_str(chr(c))) != chr(c)}
    return young, ranges([*map(ord, signs)]), lower


class Model:
    """A vocabulary file: its tokens, ranks of merges, pattern, and the words merged so far."""

    def __init__(self, content: bytes) -> None:
        file = json.loads(content)
        vocabulary, letters = file["model"]["vocab"], byte_letters()
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = {i: t for t, i in (vocabulary | special).items()}
        self.special = {t: (array("I", [i]).tobytes(), t) for t, i in special.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        pattern = next(p["pattern"]["Regex"] for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        young, signs, self.lower = young_letters()
        self.words, self.young = regex.compile(pattern), regex.compile(f"[{ranges(young)}]")
        self.far = regex.compile(rf"[\U{min(young, default=0x80):08x}-\U0010ffff]")
        self.young_words = regex.compile(regex.sub(r"\\p\{([LN])\}", lambda m: rf"[\p{{{m[1]}}}--[{signs}]]", pattern), regex.V1)
        self.inner, self.last = [vocabulary[x] for x in letters], [vocabulary[x + END] for x in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        # Ranks by pair of tokens, a pair as one integer, and the token each merge makes; ``none`` is above all ranks.
        self.ranks = {vocabulary[a] << 32 | vocabulary[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made, self.none = [vocabulary[a + b] for a, b in pairs], len(pairs)
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    def merged(self, word: bytes) -> list[int]:
        """The ids of one word."""
        parts = [self.inner[x] for x in word]
        parts[-1] = self.last[word[-1]]
        return self.by_scan(parts) if len(parts) <= SHORT else self.by_heap(parts)

    def by_scan(self, parts: list[int]) -> list[int]:
        rank, none = self.ranks.get, self.none
        ranks = [rank(a << 32 | b, none) for a, b in itertools.pairwise(parts)]
        while ranks and (least := min(ranks)) < none:
            at = ranks.index(least)
            parts[at] = here = self.made[least]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] << 32 | here, none)
            if at < len(ranks):
                ranks[at] = rank(here << 32 | parts[at + 1], none)
        return parts

    def by_heap(self, parts: list[int]) -> list[int]:
        size, rank, none = len(parts), self.ranks.get, self.none
        token, after, before = array("q", parts), array("q", range(1, size + 1)), array("q", range(-1, size - 1))
        current = array("q", (rank(a << 32 | b, none) for a, b in itertools.pairwise(parts)))
        current.append(none)
        heap = [r << 32 | k for k, r in enumerate(current) if r < none]
        heapq.heapify(heap)
        while heap:
            least, at = divmod(heapq.heappop(heap), 1 << 32)
            if current[at] != least:
                continue
            gone = after[at]
            token[at], after[at], current[gone] = self.made[least], after[gone], none
            if after[at] < size:
                before[after[at]] = at
            for k in (before[at], at):
                if k >= 0:
                    current[k] = rank(token[k] << 32 | token[after[k]], none) if after[k] < size else none
                    if current[k] < none:
                        heapq.heappush(heap, current[k] << 32 | k)
        out, at = [], 0
        while at < size:
            out.append(token[at])
            at = after[at]
        return out

    def word(self, word: str) -> tuple[bytes, str]:
        """Ids as bytes, and the tokens joined by spaces; the words met last are remembered."""
        if not (found := self.older.get(word)):
            ids = self.merged(word.encode())
            found = array("I", ids).tobytes(), " ".join([self.tokens[i] for i in ids])
        if len(word) <= SHORT:
            if len(self.known) >= MOST_WORDS:  # only memory depends on it
                self.known, self.older = {}, self.known
            self.known[word] = found
        return found

    def encode(self, text: str) -> Iterator[tuple[bytes, str]]:
        """The ids and the decoded text, run by run (those without a word are left out)."""
        for piece in pieces(text):
            for run in self.cut.split(piece) if self.cut else (piece,):
                if run in self.special:
                    yield self.special[run]
                    continue
                run, pattern = lowered(run), self.words
                if not run.isascii() and self.far.search(run) and self.young.search(run):
                    run, pattern = run.translate(self.lower), self.young_words
                words = pattern.findall(run)
                known = self.known.get
                if found := [known(w) or self.word(w) for w in words]:
                    yield b"".join([x for x, _ in found]), " ".join([y for _, y in found])


def lowered(text: str) -> str:
    """Composed form, then lower case letter by letter (a final sigma is a sigma like any other)."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pieces(text: str) -> Iterator[str]:
    """A text in pieces of PIECE characters or more that end before a space: no word, token or composed character crosses such a cut."""
    first = 0
    while len(text) - first > PIECE and (cut := text.find(" ", first + PIECE)) > 0:
        yield text[first:cut]
        first = cut
    yield text[first:]


def _model(content: bytes) -> Model:
    key = hashlib.sha256(content).digest()
    if key not in _models:
        _models.clear()
        _models[key] = Model(content)
    return _models[key]


def _read(df: DataFrame, path: str):
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary_path: str, digests: bool = False) -> DataFrame:
    """Adds n_tokens and ids, or with ``digests`` instead of ids their SHA-256 and that of the decoded text. ``text`` is dropped.

    ``vocabulary_path`` is a file that the driver can read. Columns of these names in ``docs`` are replaced."""
    content = _read(docs, vocabulary_path)
    made = {"n_tokens": "bigint", **({"ids_sha256": "string", "decoded_sha256": "string"} if digests else {"ids": "array<int>"})}
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    others = [c for c in docs.columns if c not in (*made, "text")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others), *(f"{c} {t}" for c, t in made.items())])

    def row(model: Model, text: str) -> tuple:
        if not digests:
            ids = array("I", b"".join(x for x, _ in model.encode(text)))
            return len(ids), ids.tolist()
        one, two, count = hashlib.sha256(), hashlib.sha256(), 0
        for raw, words in model.encode(text):
            one.update(raw)
            two.update((" " * bool(count) + words).encode())
            count += len(raw) // 4
        return count, one.hexdigest(), two.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(content.value)
        for batch in batches:
            found = [row(model, text.as_py() or "") for text in batch.column(len(others))]
            new = [pa.array([r[k] for r in found], kinds[t]) for k, t in enumerate(made.values())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *new], [*others, *made])

    return docs.select(*others, docs["text"].cast("string").alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """Adds ``text``, the tokens of ``ids`` joined by spaces, in place of the ids."""
    content = _read(encoded, vocabulary_path)
    others = [c for c in encoded.columns if c not in ("ids", "text")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name in others), "text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _model(content.value).tokens
        for batch in batches:
            texts = [" ".join(tokens[i] for i in ids.as_py() or []) for ids in batch.column(len(others))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(texts, pa.string())], [*others, "text"])

    return encoded.select(*others, "ids").mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op13_word_bpe(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return encode(docs.select("doc_id", "text"), default_vocabulary(), digests=True)
