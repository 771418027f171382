"""Language-model scoring by prediction by partial matching over bytes.

A text is its words, A-Z as a-z, each followed by a space, and a line feed as the end. The context trie holds for every context of up to
six bytes how often each byte followed in the training texts. A byte is predicted in the longest context that has been seen; if it did not
follow there, an escape (as likely as the number of different bytes that did) leads to the next shorter context, in which the bytes
already ruled out no longer count. The model is pretrained: scores add up log10 probabilities under the counts of all training texts.

The trie is never in one place. Documents lie in parts; a part sends each distinct seven-byte string with its training count to the
bucket of the last two context bytes. There the counts of all parts meet, the contexts of two to six bytes are complete, and every
string of the part gets its log probability, which goes back to the part. Contexts of one byte and none are a table of 65,536
counts, the only thing that is broadcast. Log probabilities travel with 24 bits, their sums are kept in double precision. Words of the unigram base model take the same way.

Defined results: a null text is empty and has the end as its only token; a null id counts as an empty text for the split into
training and held-out documents; repeated rows are scored and learned one by one; without training texts every byte is equally likely
and the base score is that of unknown words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.sinks import stage
from . import blocks as B, spans as S

ORDER = 6
PART_BYTES = 16 << 20
STREAM_BYTES = 1 << 19
FOLDS, HELD_OUT_FOLD = 10, 0
ADDED = 0.1
END_WORD = np.uint64(0x60D0E0D0E0D0E0D0)
WORDS, GRAMS, PAIRS = 0, 1, 2
BUCKETS_PER_PART = 4
# A part's keys are merged and looked up in so many slices, each with buckets of its own, so that sorting takes little memory at once.
SLICES = 16
_ONE = np.uint64(1)


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT_FOLD


def byte_stream(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes the model sees, texts one after another with ORDER zeros before each; text bounds; which bytes are predicted."""
    rows = len(offsets) - 1
    sizes = ends - starts
    per_row = np.bincount(owner, sizes + 1, rows).astype(np.int64) + 1 + ORDER
    bounds = np.concatenate(([0], np.cumsum(per_row)))
    out = np.zeros(int(bounds[-1]), np.uint8)
    before = np.cumsum(sizes + 1) - (sizes + 1)  # bytes of all words before, spaces included
    at = before + (owner + 1) * ORDER + owner
    places = np.repeat(at - starts, sizes)
    inside = np.flatnonzero(~B.IS_SPACE[data])
    out[inside + places] = B.LOWER[data[inside]]
    out[at + sizes] = 32
    out[bounds[1:] - 1] = 10
    predicted = np.ones(len(out), bool)
    for k in range(ORDER):
        predicted[bounds[:-1] + k] = False
    return out, bounds, predicted


def grams_of(stream: np.ndarray) -> np.ndarray:
    """For each byte: itself in the lowest eight bits and the ORDER bytes before it above."""
    out, width = stream.astype(np.uint64), 1
    while width < ORDER + 1:  # twice as many bytes in each step
        wider = out.copy()
        wider[width:] |= out[:-width] << np.uint64(8 * width)
        out, width = wider, 2 * width
    return out & np.uint64((1 << 8 * (ORDER + 1)) - 1)


def counted(keys: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (of 63 bits) in order, and how often each occurs with ``learned`` set."""
    flagged = np.sort(keys << _ONE | learned)
    values = flagged >> _ONE
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    sums = np.concatenate(([0], np.cumsum((flagged & _ONE).astype(np.int64))))
    return values[at], sums[np.append(at[1:], len(values))] - sums[at] if len(at) else sums[:0]


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their summed counts."""
    every, times = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(every, kind="stable")
    every, sums = every[order], np.concatenate(([0], np.cumsum(times[order])))
    at = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.zeros(0, np.int64)
    return every[at], sums[np.append(at[1:], len(every))] - sums[at] if len(at) else sums[:0]


def buckets_of(keys: np.ndarray, kind: int, buckets: int) -> np.ndarray:
    """The bucket of each word or gram, that of a gram from its last two context bytes."""
    spot = keys if kind == WORDS else (keys >> np.uint64(8)) & np.uint64(0xFFFF)
    return (B.mix(spot + np.uint64(kind)) % np.uint64(buckets)).astype(np.int64)


def log_probabilities(grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each gram after the bytes before it.

    ``grams`` are distinct and in order and hold all training strings with the same last two context bytes; ``pairs`` has the
    training counts of all two-byte strings."""
    size = len(grams)
    out, done = np.zeros(size), np.zeros(size, bool)
    # What a longer context rules out: summed counts, in the next shorter one, of the bytes that followed it, and their number.
    out_sum = out_kinds = np.zeros(size, np.int64)

    def settle(count: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> None:
        left, free = total - out_sum, kinds - out_kinds
        seen = ~done & (total > 0)
        hit = seen & (count > 0)
        out[hit] += np.log10((count[hit] - 0.5) / left[hit])
        escape = seen & (count == 0) & (free > 0)
        out[escape] += np.log10(0.5 * free[escape] / left[escape])
        done[hit] = True

    def level(order: int) -> tuple:
        mask = np.uint64((1 << 8 * (order + 1)) - 1)
        strings, of_gram = np.unique(grams & mask, return_inverse=True)
        count = np.bincount(of_gram, counts, len(strings)).astype(np.int64)
        contexts, of_string = np.unique(strings >> np.uint64(8), return_inverse=True)
        return strings, of_gram, count, of_string, np.bincount(of_string, count, len(contexts)).astype(np.int64), np.bincount(of_string, count > 0, len(contexts)).astype(np.int64)

    singles = pairs.sum(axis=0)
    here = level(ORDER)
    for order in range(ORDER, 1, -1):
        strings, of_gram, count, of_string, total, kinds = here
        context = of_string[of_gram]
        settle(count[of_gram], total[context], kinds[context])
        if order > 2:
            here = level(order - 1)
            below = here[2][np.searchsorted(here[0], strings & np.uint64((1 << 8 * order) - 1))]
        else:
            below = pairs[((strings >> np.uint64(8)) & np.uint64(255)).astype(np.int64), (strings & np.uint64(255)).astype(np.int64)]
        out_sum = np.bincount(of_string, below * (count > 0), len(total)).astype(np.int64)[context]
        out_kinds = kinds[context]
    before, last = ((grams >> np.uint64(8)) & np.uint64(255)).astype(np.int64), (grams & np.uint64(255)).astype(np.int64)
    kinds = (pairs > 0).sum(axis=1)
    settle(pairs[before, last], pairs.sum(axis=1)[before], kinds[before])
    out_sum, out_kinds = ((pairs > 0) * singles[None, :]).sum(axis=1)[before], kinds[before]
    settle(singles[last], np.full(size, singles.sum()), np.full(size, (singles > 0).sum()))
    out[~done] -= np.log10(max(1, 256 - int((singles > 0).sum())))
    return out


def _streams(column: pa.Array) -> Iterator[tuple]:
    for row, data, offsets in B.blocks(column, STREAM_BYTES):
        starts, ends, owner = B.word_spans(data, offsets)
        words = B.span_hashes(B.prefix_sums(data, lower=True), starts, ends) >> _ONE
        stream, bounds, predicted = byte_stream(data, offsets, starts, ends, owner)
        yield row, len(offsets) - 1, words, owner, stream, bounds, predicted


def _texts(table: pa.Table) -> tuple[list, pa.Array]:
    part = S.Part(table)
    return part.doc_ids, part.column()


def requests(documents: DataFrame, buckets: int) -> DataFrame:
    """What each part asks for: its distinct words and grams with their training counts, dealt to buckets, and in one more row per
    part (``kind`` PAIRS, no bucket) the number of its training tokens and its training counts of two-byte strings."""
    schema = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("tokens", pa.int64())])

    def count(table: pa.Table) -> pa.Table:
        ids, texts = _texts(table)
        train = np.array([not is_held_out(d) for d in ids], bool)
        found: dict[tuple[int, int], list] = {}

        def keep(kind: int, values: np.ndarray, times: np.ndarray) -> None:
            for s, v, n in B.parted((buckets_of(values, kind, buckets) % SLICES).astype(np.uint8), values, times.astype(np.uint32)):
                found.setdefault((kind, s), []).append((v.copy(), n.copy()))

        for row, rows, words, owner, stream, bounds, predicted in _streams(texts):
            mine = train[row : row + rows]
            keep(WORDS, *counted(np.concatenate((words, np.full(rows, END_WORD))), np.concatenate((mine[owner], mine))))
            keep(GRAMS, *counted(grams_of(stream)[predicted], np.repeat(mine, np.diff(bounds))[predicted]))
        number, rows_out = table["part"][0].as_py(), []
        tokens, pairs = 0, np.zeros(1 << 16, np.int64)
        for kind, s in sorted(found):
            values, times = merged(*zip(*found.pop((kind, s)), strict=True))
            for b, v, n in B.parted(buckets_of(values, kind, buckets), values, times):
                rows_out.append((b, number, kind, B.squeezed(v, ordered=True), B.squeezed(n), 0))
            if kind == WORDS:
                tokens += int(times.sum())
            else:
                pairs += np.bincount((values & np.uint64(0xFFFF)).astype(np.int64), times, 1 << 16).astype(np.int64)
        some = np.flatnonzero(pairs)
        rows_out.append((-1, number, PAIRS, B.squeezed(some, ordered=True), B.squeezed(pairs[some]), tokens))
        return pa.Table.from_batches([B.packed(rows_out, schema)])

    return documents.groupBy("part").applyInArrow(count, "bucket long, part long, kind int, keys binary, counts binary, tokens long")


def pair_counts(asked: DataFrame) -> np.ndarray:
    """Training counts of all two-byte strings, 256 by 256."""

    def unpack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(B.expanded(keys, "i8", ordered=True)), pa.array(B.expanded(counts, "i8"))], ["pair", "n"])

    rows = B.per_batch(asked.where(F.col("kind") == PAIRS).select("keys", "counts"), unpack, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << 16, np.int64)
    for row in rows.collect():  # 65,536 rows at most
        out[row["pair"]] = row["n"]
    return out.reshape(256, 256)


def distinct_words(asked: DataFrame) -> int:
    """Number of different training words, the end included."""
    schema = pa.schema([("n", pa.int64())])

    def count(table: pa.Table) -> pa.Table:
        known = [B.expanded(k, "u8", ordered=True)[B.expanded(c, "i8") > 0] for k, c in zip(table["keys"].to_pylist(), table["counts"].to_pylist(), strict=True)]
        return pa.table([pa.array([len(np.unique(np.concatenate(known)))], pa.int64())], schema=schema)

    words = asked.where(F.col("kind") == WORDS).select("bucket", "keys", "counts")
    return int(words.groupBy("bucket").applyInArrow(count, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"])


def replies(asked: DataFrame, pairs: np.ndarray) -> DataFrame:
    """What each part gets from each bucket: the training counts of its words, the log probabilities of its grams."""
    told = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("found", pa.binary())])
    table_of_pairs = asked.sparkSession.sparkContext.broadcast(pairs)

    def meet(table: pa.Table) -> pa.Table:
        rows = []
        kinds = np.asarray(table["kind"])
        for kind in (WORDS, GRAMS):
            mine = table.filter(pa.array(kinds == kind))
            if not mine.num_rows:
                continue
            packed_keys = mine["keys"].to_pylist()
            keys = [B.expanded(k, "u8", ordered=True) for k in packed_keys]
            values, sums = merged(keys, [B.expanded(c, "i8") for c in mine["counts"].to_pylist()])
            found = sums if kind == WORDS else log_probabilities(values, sums, table_of_pairs.value).astype(np.float32)
            for number, raw, own in zip(mine["part"].to_pylist(), packed_keys, keys, strict=True):
                rows.append((number, kind, raw, B.squeezed(found[np.searchsorted(values, own)])))
        return pa.Table.from_batches([B.packed(rows, told)])

    return asked.where(F.col("kind") != PAIRS).drop("tokens").groupBy("bucket").applyInArrow(meet, "part long, kind int, keys binary, found binary")


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    base = B.normal_documents(docs)
    _, size = B.text_bytes(base)
    parts = B.part_count(docs.sparkSession, size, PART_BYTES)
    documents = S.dealt_documents(base, parts)
    buckets = BUCKETS_PER_PART * parts
    asked = stage(requests(documents, buckets), "ppm-requests")
    tokens = int(asked.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"])
    scale = np.log10(tokens + ADDED * (distinct_words(asked) + 1))
    result = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def known(table: pa.Table, kind: int, dtype: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Keys in order and what was found for them, for each slice."""
        mine = table.filter(pa.array(np.asarray(table["kind"]) == kind))
        told: dict[int, list] = {}
        for k, v in zip(mine["keys"], mine["found"], strict=True):
            keys = B.expanded(k.as_py(), "u8", ordered=True)
            told.setdefault(int(buckets_of(keys[:1], kind, buckets)[0]) % SLICES, []).append((keys, B.expanded(v.as_py(), dtype)))
        out = {}
        for s in list(told):
            keys, found = (np.concatenate(x) for x in zip(*told.pop(s), strict=True))
            order = np.argsort(keys)
            out[s] = keys[order], found[order]
        return out

    def looked_up(keys: np.ndarray, kind: int, answers: dict[int, tuple[np.ndarray, np.ndarray]], dtype: str) -> np.ndarray:
        out = np.empty(len(keys), dtype)
        for s, at in B.parted((buckets_of(keys, kind, buckets) % SLICES).astype(np.uint8), np.arange(len(keys))):
            of_slice, found = answers[s]
            out[at] = found[np.searchsorted(of_slice, keys[at])]
        return out

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return result.empty_table()
        ids, texts = _texts(left)
        word_counts, gram_logs = known(right, WORDS, "i8"), known(right, GRAMS, "f4")
        n_tokens, n_known, base_score, scored = [], [], [], []
        for _, rows, words, owner, stream, bounds, predicted in _streams(texts):
            every, who = np.concatenate((words, np.full(rows, END_WORD))), np.concatenate((owner, np.arange(rows)))
            times = looked_up(every, WORDS, word_counts, "i8")
            n_tokens.append(np.bincount(who, minlength=rows))
            n_known.append(np.bincount(who[times > 0], minlength=rows))
            base_score.append(np.bincount(who, np.log10(times + ADDED), rows) - n_tokens[-1] * scale)
            grams = grams_of(stream)[predicted]
            order = np.argsort(grams)
            grams = grams[order]
            new = np.concatenate(([True], grams[1:] != grams[:-1]))
            logs = np.empty(len(grams))
            logs[order] = looked_up(grams[new], GRAMS, gram_logs, "f4")[np.cumsum(new) - 1]
            sums = np.concatenate(([0.0], np.cumsum(logs)))
            cuts = bounds - ORDER * np.arange(rows + 1)
            scored.append(sums[cuts[1:]] - sums[cuts[:-1]])
        columns = [
            pa.array(ids, pa.int64()), pa.array([is_held_out(d) for d in ids]), pa.array(np.concatenate(n_tokens).astype(np.int64)), pa.array(np.concatenate(n_known).astype(np.int64)),
            pa.array(np.full(len(ids), tokens, np.int64)), pa.array(np.concatenate(base_score)), pa.array(np.concatenate(scored)),
        ]
        return pa.Table.from_arrays(columns, schema=result)

    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return documents.groupBy("part").cogroup(replies(asked, pair_counts(asked)).groupBy("part")).applyInArrow(score, kind)


def op5_ppm(docs: DataFrame) -> DataFrame:
    return scores(docs.select("doc_id", "text"))
